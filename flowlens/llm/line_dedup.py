"""Line dedup across documents over levelled sorted runs of line hashes.

A line's key is the line without blanks at both ends (20, 09-0D) and with A-Z lower-cased. Keys found in
at least ``min_docs`` documents lose all their lines everywhere; all other lines stay.

Keys are held as 128-bit hashes in runs: tables of key and document count, sorted by key. A new batch
of documents is merge-anti-joined with the runs' settled keys (those that have reached the limit
already; counting them on is of no use), and what is left becomes a run of the lowest level. When a level has
``FANOUT`` runs they are merged into one run of the next level. The keys to drop are those whose
counts over all runs reach the limit.

Every row is a document: repeated rows count each, and a null ``doc_id`` is judged like any other. A null or
empty text is one empty line, which is never dropped. Everything is built-in DataFrame functions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.session import scratch_path, stage

MIN_DOCS = 10
FANOUT = 2
BATCHES = 4
BLANKS = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """128-bit hash of a line's key; null for an empty key, which is never looked up."""
    bare = F.btrim(line, F.lit(BLANKS))
    lower = F.when(F.length(bare) == F.octet_length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))
    return F.when(bare != "", F.unhex(F.md5(lower.cast("binary"))))


def document_counts(docs: DataFrame, *by: str) -> DataFrame:
    """``key``, ``n``: in how many rows of ``docs`` each key is found."""
    keys = F.array_distinct(F.filter(F.transform(lines(F.col("text")), line_key), lambda k: k.isNotNull()))
    return docs.select(*by, F.explode(keys).alias("key")).groupBy(*by, "key").agg(F.count("*").alias("n"))


class LineRuns:
    """The runs of all batches so far, level by level, in the shared scratch folder or a given one."""

    def __init__(self, spark: SparkSession, min_docs: int = MIN_DOCS, fanout: int = FANOUT, path: str | None = None):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.path = path or scratch_path(spark, "line-runs")
        self.levels: list[list[DataFrame]] = []
        self.written = 0

    def _write(self, counts: DataFrame) -> DataFrame:
        path = f"{self.path}/run-{self.written}"
        self.written += 1
        # The grouping has placed equal keys together: sorting needs no further shuffle.
        counts.sortWithinPartitions("key").write.mode("overwrite").parquet(path)
        return self.spark.read.schema(counts.schema).parquet(path)

    def _runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def _merged(self, runs: list[DataFrame]) -> DataFrame:
        return reduce(DataFrame.union, runs).groupBy("key").agg(F.sum("n").alias("n"))

    def add(self, counts: DataFrame) -> None:
        """A batch's ``key`` and ``n``."""
        fresh = counts
        if self._runs():
            settled = reduce(DataFrame.union, [run.filter(F.col("n") >= self.min_docs).select("key") for run in self._runs()])
            fresh = counts.join(settled.hint("merge"), "key", "left_anti")
        self._place(self._write(fresh), 0)

    def _place(self, run: DataFrame, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            runs, self.levels[level] = self.levels[level], []
            self._place(self._write(self._merged(runs)), level + 1)

    def repeated(self) -> DataFrame:
        """The keys found in at least ``min_docs`` documents."""
        return self._merged(self._runs()).filter(F.col("n") >= self.min_docs).select("key")


def _repeated_keys(texts: DataFrame, min_docs: int, batches: int) -> DataFrame:
    """All batches of ``texts`` through the runs. One pass counts every batch on its own."""
    batch = F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(batches)).alias("batch")
    counted = document_counts(texts.select("text", batch), "batch")
    path = scratch_path(texts.sparkSession, "line-counts")
    counted.write.partitionBy("batch").parquet(path)
    runs = LineRuns(texts.sparkSession, min_docs)
    table = texts.sparkSession.read.schema("key binary, n long, batch int").parquet(path)
    for number in range(batches):
        runs.add(table.filter(F.col("batch") == number).select("key", "n"))
    return stage(runs.repeated(), "repeated-lines")


def cleaned(docs: DataFrame, min_docs: int = MIN_DOCS, batches: int = BATCHES) -> DataFrame:
    """``docs`` with ``__text``, ``__lines`` and ``__dropped`` added: the text left, lines before, lines dropped.

    Which lines go is looked up by document: only documents with a repeated line meet the table of
    their dropped places, found by ``doc_id`` and a hash of the text. All rows and columns stay.
    """
    whole = F.col("text").cast("string")
    texts = docs.select(F.col("doc_id"), whole.alias("text"), F.xxhash64(whole).alias("text_hash"))
    repeated = _repeated_keys(texts, min_docs, batches)
    placed = texts.select("doc_id", "text_hash", F.posexplode(F.transform(lines(F.col("text")), line_key)).alias("place", "key"))
    hit = placed.filter("key is not null").join(repeated, "key").select("doc_id", "text_hash", "place")
    dropped = hit.groupBy("doc_id", "text_hash").agg(F.collect_set("place").alias("__places"))
    dropped = dropped.withColumnsRenamed({"doc_id": "__id", "text_hash": "__hash"})
    joined = docs.join(dropped, F.col("doc_id").eqNullSafe(F.col("__id")) & F.xxhash64(whole).eqNullSafe(F.col("__hash")), "left")
    own = lines(whole)
    kept = F.filter(own, lambda line, place: ~F.array_contains(F.col("__places"), place))
    text = F.when(F.col("__places").isNull(), F.coalesce(whole, F.lit(""))).otherwise(F.array_join(kept, "\n"))
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns], text.alias("__text"), F.size(own).cast("long").alias("__lines"),
                         F.coalesce(F.size("__places"), F.lit(0)).cast("long").alias("__dropped"))


def digests(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``doc_id``, ``n_lines``, ``n_dropped``, ``kept_sha256`` of every row."""
    found = cleaned(docs.select("doc_id", "text"), min_docs)
    return found.select("doc_id", F.col("__lines").alias("n_lines"), F.col("__dropped").alias("n_dropped"),
                        F.sha2(F.col("__text").cast("binary"), 256).alias("kept_sha256"))


def drop_repeated_lines(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with its columns; ``text`` has lost its repeated lines, ``n_chars`` (if there) follows it.

    A null text stays null.
    """
    found = cleaned(docs, min_docs)
    new = {"text": F.when(F.col("text").isNotNull(), F.col("__text")),
           "n_chars": F.when(F.col("__dropped") > 0, F.length("__text")).otherwise(F.col("n_chars")).cast("long") if "n_chars" in docs.columns else None}
    return found.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns])


ORACLE = r"""
WITH lines AS (
    SELECT doc_id, place, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS place
          FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))),
repeated AS (SELECT key FROM lines WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
marked AS (SELECT doc_id, place, line, key IN (SELECT key FROM repeated) AS gone FROM lines)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""
