"""Merging many CSV files whose headers may differ.

Every file is a unit with its own header: its whole first record, read inside tasks. Files with equal headers are read
together, and the groups are united by column name. Every unit has a status; none is lost unseen.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from flowlens.functions import labels, text
from flowlens.operators import harmonise, sampling
from flowlens.session import stage
from flowlens.sources import files

UNIT = "_unit"
# True for rows that do not fit their file's header or schema.
MALFORMED = "_malformed"
_CORRUPT = "_corrupt_record"
BAD_ROWS = ("keep", "drop", "fail")


@dataclass
class UnitGroup:
    """Files that share one header."""

    header: tuple[str, ...]
    label: str | None
    paths: list[str]


@dataclass
class Merged:
    """Rows of all usable units, where their classes come from, the status of every unit, and rows read and malformed ones.

    ``counts``, if asked for, is filled by the first action that reads the whole table, such as writing it.
    """

    table: DataFrame
    source_labels: list[str]
    status: DataFrame
    counts: Observation | None = None


HEADER_STEP = 65536
# A header does not go on for longer; a quote that is never closed would otherwise take in the whole file.
HEADER_BYTES = 1 << 22


class NoHeader(ValueError):
    """The first record does not end within ``HEADER_BYTES``."""
# Names by which Spark and pyarrow call one store.
SCHEMES = {"s3a": "s3", "s3n": "s3"}


def _first_record(stream) -> str:
    """The text up to the first line end outside quotes, read step by step."""
    raw, at, quotes = b"", 0, 0
    while piece := stream.read(HEADER_STEP):
        raw += piece
        if len(raw) > HEADER_BYTES and raw.find(b"\n", at) < 0:
            raise NoHeader(f"no end of the first record within {HEADER_BYTES} bytes")
        while (end := raw.find(b"\n", at)) >= 0:
            quotes += raw.count(b'"', at, end)
            at = end + 1
            if quotes % 2 == 0:
                return raw[:end].decode("utf-8-sig", "replace").rstrip("\r")
            if at > HEADER_BYTES:
                raise NoHeader(f"a quote is open after {HEADER_BYTES} bytes of the first record")
    return raw.decode("utf-8-sig", "replace").rstrip("\r")


def read_header(path: str) -> tuple[list[str], str | None]:
    """Names in the first record of a file, or why it cannot be read.

    A scheme without a file system here raises: such files would be missing from the table without a word.
    """
    import csv
    import io
    import re

    from pyarrow import fs

    scheme, found, rest = path.partition(":")
    uri = re.sub("^file:/+", "file:///", f"{SCHEMES.get(scheme, scheme)}{found}{rest}")
    system, inner = fs.FileSystem.from_uri(uri)
    try:
        with system.open_input_stream(inner) as stream:
            record = _first_record(stream)
    except (OSError, NoHeader) as problem:
        return [], str(problem)
    return (next(csv.reader(io.StringIO(record), skipinitialspace=True), []) if record.strip() else []), None


def _read_headers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        parsed = [read_header(path) for path in batch["path"]]
        yield pd.DataFrame({"path": batch["path"], "header": [names for names, _ in parsed],
                            "error": [problem for _, problem in parsed]})


def unit_headers(spark: SparkSession, root: str) -> DataFrame:
    """Path, header and read error of every CSV file below ``root``; only the headers are read."""
    found = files.manifest(spark, root, files.CSV_GLOB).select("path")
    return found.mapInPandas(_read_headers, "path string, header array<string>, error string")


def label_status(headers: DataFrame, candidates: Sequence[str], fallback: str = "error") -> DataFrame:
    """Add ``label_column`` and ``status`` (ok, unreadable, empty, no label) to each unit."""
    names = F.transform("header", lambda name: F.trim(name))
    found = F.filter(F.array(*[F.lit(c) for c in candidates]),
                     lambda name: F.array_contains(names, name))
    label = F.get(found, F.lit(0))
    if fallback != "error":
        label = F.coalesce(label, F.get(names, F.lit(0)) if fallback == "first"
                           else F.element_at(names, -1))
    return headers.select(
        "path", names.alias("header"), F.when(F.size("header") > 0, label).alias("label_column"),
        F.when(F.col("error").isNotNull(), "unreadable").when(F.size("header") == 0, "empty")
        .when(label.isNull(), "no label").otherwise("ok").alias("status"))


def group_units(status: DataFrame) -> list[UnitGroup]:
    """Readable units by header; the driver, which must name the files to read, holds their paths."""
    usable = status.filter("status = 'ok'").select("header", "label_column", "path")
    groups: dict[tuple, UnitGroup] = {}
    for row in usable.toLocalIterator():
        key = (tuple(row["header"]), row["label_column"])
        groups.setdefault(key, UnitGroup(key[0], key[1], [])).paths.append(row["path"])
    for group in groups.values():
        group.paths.sort()
    return sorted(groups.values(), key=lambda group: group.paths[0])


def _kept_name(label: str) -> str:
    """Name of the source label in the merged table, which has its own ``class``."""
    return "source_label" if label.lower() == "class" else label


def merge_units(spark: SparkSession, root: str, candidates: Sequence[str], *,
                fallback: str = "error", normal_tokens: Sequence[str] = labels.IDS2025_TOKENS,
                passthrough: bool = False, drop: Sequence[str] = (), schema=None,
                unit_cap: int | None = None, total_cap: int | None = None,
                seed: int = 42, keep_unit: bool = False, bad_rows: str = "keep",
                count_rows: bool = False) -> Merged:
    """One table from all labelled units, with ``source_file`` and ``class`` last.

    The source labels stay in the table; ``source_labels`` names them for exclusion. ``status`` has a row for
    every file, those left out (unreadable, empty, no label) included; a file that fails later on ends the job.

    ``unit_cap`` bounds the rows per file and ``total_cap`` stops before the first file that
    starts at or above it; both are features of the sample build, off by default. ``keep_unit`` leaves the
    path of each row in ``_unit``, and whether it is malformed in ``_malformed``.

    A malformed row has more or fewer values than its header, or one that is not of its column's type. It is kept with what
    could be read (``keep``), left out (``drop``) or ends the job (``fail``). Telling them apart parses every column, so
    ``counts`` is there only with ``count_rows``.
    """
    if bad_rows not in BAD_ROWS:
        raise ValueError(f"bad_rows is one of {BAD_ROWS}")
    status = stage(label_status(unit_headers(spark, root), candidates, fallback), "units")
    parts, names = [], set()
    for group in group_units(status):
        raw = files.load_csv(spark, group.paths, schema, corrupt_column=_CORRUPT)
        # Only parsed columns can be found malformed. This test reads all of them and is always true, so that a row
        # is judged alike whichever columns a caller wants.
        parsed = F.xxhash64(*[text.col(c) for c in raw.columns if c != _CORRUPT]).bitwiseOR(F.lit(1)) != 0
        raw = files.with_source(raw, "source_file").select("*", F.col("_metadata.file_path").alias(UNIT), (F.col(_CORRUPT).isNotNull() & parsed).alias(MALFORMED))
        raw = harmonise.strip_headers(raw.drop(_CORRUPT)).drop(*drop)
        kept = _kept_name(group.label)
        names.add(kept)
        raw = raw.withColumnRenamed(group.label, kept)
        mapped = (labels.class_passthrough(text.col(kept)) if passthrough else
                  labels.class_of(text.col(kept), raw.schema[kept].dataType, normal_tokens))
        parts.append(raw.withColumn("class", mapped))
    if not parts:
        raise ValueError(f"no labelled CSV file below {root}")
    merged, counts = harmonise.union_by_name(*parts), Observation() if count_rows else None
    if counts:
        merged = merged.observe(counts, F.count(F.lit(1)).alias("rows"), F.count_if(F.col(MALFORMED)).alias("malformed"))
    if bad_rows == "drop":
        merged = merged.filter(~F.col(MALFORMED))
    if bad_rows == "fail":
        merged = merged.withColumn(MALFORMED, F.when(F.col(MALFORMED), F.raise_error(F.concat(F.lit("malformed row in "), F.col(UNIT)))).otherwise(F.lit(False)))
    if unit_cap is not None:
        merged = sampling.cap_rows(merged, unit_cap, group=[UNIT], seed=seed)
    if total_cap is not None:
        merged = sampling.cap_total(merged, total_cap, unit=UNIT)
    if bad_rows == "fail":
        # The check is part of every row's class, so that no choice of columns passes it by.
        merged = merged.withColumn("class", F.when(~F.col(MALFORMED), F.col("class")))
    table = harmonise.class_last(merged if keep_unit else merged.drop(UNIT, MALFORMED))
    return Merged(table, sorted(names), status.select("path", "label_column", "status"), counts)


def unit_report(merged: DataFrame, unit: str = "source_file") -> DataFrame:
    """Rows per unit of a merged table."""
    return merged.groupBy(unit).agg(F.count(F.lit(1)).alias("rows"))
