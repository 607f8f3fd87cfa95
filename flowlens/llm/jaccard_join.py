"""Near-duplicate join: documents whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Chosen-path join. A set is embedded as 64 min-hash tokens. A run starts with all sets in one bucket;
a bucket samples one or two of the tokens (1 / threshold on average) and sends each set to the
children its own values name, so that similar sets stay together along some path. Buckets of few
sets, and those a split does not take apart any more, are compared by brute force; a larger one is
split again. Runs are repeated until a pair at the threshold is met with the target recall.

What a bucket finds is kept as a forest of links, never as all its pairs. The forests of all runs
form candidate groups, each group is compared exactly on its whole shingle sets, and a group too
large for one task is compared block against block. So every pair is counted once.

Words are runs of non-blanks with A-Z lower-cased. A text of fewer than five words has one shingle, its
whole word sequence; a text without words (null, empty, blanks) is alike to nothing. Equal shingle
sets are one representative with a multiplicity. Rows that repeat a ``doc_id`` count as documents of
their own; a null ``doc_id`` is compared too, and its class is the least id of its class (null if
there is none).
"""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm import batches
from flowlens.llm.components import components
from flowlens.session import small, stage

TOKENS = 64
THRESHOLD = 0.8
SHINGLE = 5
RECALL = 0.99
DEPTH = 8
SMALL_BUCKET = 128
# A child that keeps more than this share of its bucket shows that the bucket's sets are alike.
ALIKE = 0.7
# Estimated similarity from which two sets of a bucket are linked: three deviations of 64 tokens below 0.8.
# Buckets compare one byte of every token; two different tokens share it once in 256 times.
LINK = 0.65
# A bucket larger than this is compared in parts whose leaders are then compared with each other,
# block against block where they are more than this as well.
PART = 4096
LEADER_REACH = 0.8
LEADER_LINK = 0.35
# A block of the exact comparison.
BLOCK_SETS = 1024
BLOCK_SHINGLES = 400_000

_MULTIPLY = np.random.default_rng(5).integers(1, 1 << 63, TOKENS).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = np.random.default_rng(6).integers(0, 1 << 63, TOKENS).astype(np.uint64)


def meeting_probability(depth: int, threshold: float = THRESHOLD) -> float:
    """Probability that a pair at the threshold shares a bucket ``depth`` splits down, in one run."""
    more = 1 / threshold - 1
    p = 1.0
    for _ in range(depth):
        one = threshold * p
        p = (1 - more) * one + more * (1 - (1 - one) ** 2)
    return p


def runs_needed(recall: float = RECALL, depth: int = DEPTH, threshold: float = THRESHOLD) -> int:
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - meeting_probability(depth, threshold))))


def minhash_tokens(shingles: np.ndarray) -> bytes:
    """64 tokens of 16 bits; equal with the probability of the sets' similarity."""
    low = np.full(TOKENS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 16384):
        part = shingles[None, at : at + 16384] * _MULTIPLY[:, None] + _ADD[:, None]
        np.minimum(low, part.min(axis=1), out=low)
    return (batches.mix(low) >> np.uint64(48)).astype("<u2").tobytes()


def set_key(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _shingle_sets(texts: pa.Array, size: int):
    for chunk in batches.chunks(texts):
        hashes, at = batches.words(chunk, lower=True)
        for k in range(len(chunk)):
            yield batches.shingles(hashes[at[k] : at[k + 1]], size)


def _sketches(size: int):
    def run(parts):
        for batch in parts:
            keys, counts, tokens, bytes_ = [], [], [], []
            for found in _shingle_sets(batch.column("text"), size):
                counts.append(len(found))
                keys.append(set_key(found) if len(found) else None)
                tokens.append(minhash_tokens(found) if len(found) else None)
                bytes_.append(tokens[-1][::2] if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), pa.array(keys, pa.binary()), pa.array(counts, pa.int64()), pa.array(tokens, pa.binary()), pa.array(bytes_, pa.binary())],
                ["row", "doc_id", "key", "n", "tokens", "sketch"])
    return run


def _token(place) -> object:
    return F.substring("tokens", place * 2 + 1, 2) if isinstance(place, int) else F.substr("tokens", place * 2 + F.lit(1), F.lit(2))


def _first_split(runs: int, seed: int):
    """Nodes of the first level: each run's root samples its tokens by the seed."""
    nodes = []
    for run in range(runs):
        draw = random.Random(seed * 1009 + run)
        for place in draw.sample(range(TOKENS), 2 if draw.random() < 1 / THRESHOLD - 1 else 1):
            nodes.append(F.xxhash64(F.lit(run), F.lit(place), _token(place)))
    return F.explode(F.array(*nodes))


def _next_split():
    """Children of a node: its own hash samples one token, or two with probability 1 / threshold - 1."""
    def child(k):
        place = F.pmod(F.xxhash64("node", F.lit(k)), F.lit(TOKENS)).cast("int")
        return F.xxhash64("node", place, _token(place))
    two = F.pmod(F.xxhash64("node", F.lit(7)), F.lit(1000)) < int(1000 * (1 / THRESHOLD - 1))
    return F.explode(F.when(two, F.array_distinct(F.array(child(1), child(2)))).otherwise(F.array(child(1))))


def _buckets(reps: DataFrame, runs: int, seed: int) -> list[DataFrame]:
    """``rep``, ``node``, ``count`` of the buckets to compare; one table per level."""
    frontier = reps.select("rep", F.lit(0).cast("long").alias("above"), _first_split(runs, seed).alias("node"))
    out = []
    for level in range(1, DEPTH + 1):
        sizes = frontier.groupBy("node").agg(F.count("*").alias("count")).filter("count > 1")
        held = stage(frontier.join(sizes, "node"), "buckets")
        final = F.lit(level == DEPTH) | (F.col("count") <= SMALL_BUCKET) | ((F.col("above") > 0) & (F.col("count") > ALIKE * F.col("above")))
        out.append(held.filter(final).select("rep", "node", "count"))
        large = held.filter(~final)
        if large.isEmpty():
            break
        frontier = (large.join(reps.select("rep", "tokens"), "rep")
                    .select("rep", F.col("count").alias("above"), _next_split().alias("node")))
    return out


def _similar(tokens: np.ndarray, least: float, others: np.ndarray | None = None) -> np.ndarray:
    """Which rows of a token matrix agree with which rows of it, or of another one, in at least that share of places."""
    others = tokens if others is None else others
    out = np.empty((len(tokens), len(others)), bool)
    columns = list(zip(np.ascontiguousarray(tokens.T), np.ascontiguousarray(others.T)))
    for at in range(0, len(tokens), 256):
        same = np.zeros((min(256, len(tokens) - at), len(others)), np.uint8)
        for own, other in columns:
            same += own[at : at + 256, None] == other[None, :]
        out[at : at + 256] = same >= least * TOKENS
    return out


def _groups(near: np.ndarray) -> np.ndarray:
    """Least member of the connected group of each row of a symmetric matrix."""
    label = np.full(len(near), -1)
    for seed in range(len(near)):
        if label[seed] >= 0:
            continue
        label[seed] = seed
        edge = np.array([seed])
        while len(edge):
            edge = np.flatnonzero(near[edge].any(axis=0) & (label < 0))
            label[edge] = seed
    return label


def _groups_across(near: np.ndarray) -> np.ndarray:
    """Least member of the connected group of each row and then of each column, numbered after the rows."""
    rows, columns = near.shape
    label = np.concatenate([np.full(rows, -1), np.arange(rows, rows + columns)])
    for seed in range(rows):
        if label[seed] >= 0:
            continue
        label[seed] = seed
        edge = np.array([seed])
        while len(edge):
            over = np.flatnonzero(near[edge].any(axis=0) & (label[rows:] >= rows))
            label[rows + over] = seed
            edge = np.flatnonzero(near[:, over].any(axis=1) & (label[:rows] < 0))
            label[edge] = seed
    return label


def _leaders(near: np.ndarray) -> list[int]:
    """Rows such that every row is near one of them."""
    left, out = np.ones(len(near), bool), []
    for k in range(len(near)):
        if left[k]:
            out.append(k)
            left &= ~near[k]
    return out


def _by_key(parts, keys: list[str]):
    """Consecutive rows of equal keys, over the bounds of batches, as one table each."""
    held, last = [], None
    for batch in parts:
        if not batch.num_rows:
            continue
        cuts = np.ones(batch.num_rows + 1, bool)
        cuts[1:-1] = False
        for key in keys:
            column = batch.column(key).to_numpy(zero_copy_only=False)
            cuts[1:-1] |= column[1:] != column[:-1]
        places = np.flatnonzero(cuts)
        for start, end in zip(places[:-1], places[1:]):
            now = tuple(batch.column(key)[start].as_py() for key in keys)
            if held and now != last:
                yield last, pa.Table.from_batches(held)
                held = []
            last = now
            held.append(batch.slice(start, end - start))
    if held:
        yield last, pa.Table.from_batches(held)


def _sketch_rows(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Sets and sketches of a group of rows, in the order of the sets."""
    reps = table.column("rep").to_numpy()
    order = np.argsort(reps, kind="stable")
    tokens = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(-1, TOKENS)
    return reps[order], tokens[order]


def _compare_part(parts):
    """Forest of links of each bucket part, and the leaders of parts of larger buckets."""
    for (node, _), table in _by_key(parts, ["node", "part"]):
        reps, tokens = _sketch_rows(table)
        label = _groups(_similar(tokens, LINK))
        moved = np.flatnonzero(label != np.arange(len(reps)))
        a, b, lead = reps[moved], reps[label[moved]], np.zeros(len(moved), bool)
        if table.column("parts")[0].as_py() > 1:
            own = reps[_leaders(_similar(tokens, LEADER_REACH))]
            a, b, lead = np.concatenate([a, own]), np.concatenate([b, own]), np.concatenate([lead, np.ones(len(own), bool)])
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(np.full(len(a), node, np.int64)), pa.array(lead)],
                                             ["a", "b", "node", "lead"])


def _compare_blocks(parts):
    """Forest of links of each pair of leader blocks, or within one block."""
    for (_, first, second), table in _by_key(parts, ["node", "first", "second"]):
        if first == second:
            reps, tokens = _sketch_rows(table)
            label = _groups(_similar(tokens, LEADER_LINK))
        else:
            side = pc.equal(table.column("block"), first)
            (own, tokens), (other, others) = _sketch_rows(table.filter(side)), _sketch_rows(table.filter(pc.invert(side)))
            reps = np.concatenate([own, other])
            label = _groups_across(_similar(tokens, LEADER_LINK, others))
        moved = np.flatnonzero(label != np.arange(len(reps)))
        if len(moved):
            yield pa.RecordBatch.from_arrays([pa.array(reps[moved]), pa.array(reps[label[moved]])], ["a", "b"])


LINKS = "a long, b long, node long, lead boolean"


def _compare_parts(buckets: DataFrame, reps: DataFrame) -> DataFrame:
    rows = (buckets.withColumn("parts", F.ceil(F.col("count") / PART).cast("int"))
            .withColumn("part", F.pmod(F.xxhash64("rep"), "parts").cast("int"))
            .join(reps.select("rep", "sketch"), "rep"))
    return rows.repartition("node", "part").sortWithinPartitions("node", "part").mapInArrow(_compare_part, LINKS)


def _compare_leaders(leaders: DataFrame, reps: DataFrame) -> DataFrame:
    """Links among the leaders of each node: no task holds more than two blocks of about ``PART`` leaders."""
    sizes = small(leaders.groupBy("node").agg(F.ceil(F.count("*") / PART).cast("int").alias("blocks")))
    placed = (leaders.join(sizes, "node").withColumn("block", F.pmod(F.xxhash64("rep"), "blocks").cast("int"))
              .join(reps.select("rep", "sketch"), "rep"))
    pairs = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "node", F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"), "block", "rep", "sketch")
    return pairs.repartition("node", "first", "second").sortWithinPartitions("node", "first", "second").mapInArrow(_compare_blocks, "a long, b long")


def _candidate_links(reps: DataFrame, runs: int, seed: int) -> DataFrame:
    """Links that connect all sets which a run found alike."""
    found = None
    for buckets in _buckets(reps, runs, seed):
        found = buckets if found is None else found.union(buckets)
    links = stage(_compare_parts(found, reps), "links")
    across = _compare_leaders(links.filter("lead").select(F.col("a").alias("rep"), "node"), reps)
    return links.filter("not lead").select("a", "b").union(across).distinct()


def _exact(threshold: float, size: int):
    """Of each block pair: for every set its links' weight and the least set it is connected to."""
    def run(parts):
        for (_, first, second), table in _by_key(parts, ["group", "first", "second"]):
            # A doc_id that stands for several texts brings rows of other sets; their keys tell.
            rows = {}
            for rep, side, key, weight, found in zip(table.column("rep").to_pylist(), table.column("block").to_pylist(),
                                                     table.column("key").to_pylist(), table.column("copies").to_pylist(),
                                                     _shingle_sets(table.column("text"), size)):
                if rep not in rows and len(found) and set_key(found) == key:
                    rows[rep] = (side, weight, found)
            if len(rows) < 2:
                continue
            reps = sorted(rows)
            side = np.array([rows[r][0] for r in reps])
            weight = np.array([rows[r][1] for r in reps])
            sets = [rows[r][2] for r in reps]
            near = _overlaps(sets, threshold)
            np.fill_diagonal(near, False)
            if first != second:
                near &= side[:, None] != side[None, :]
            linked = np.flatnonzero(near.any(axis=1))
            if not len(linked):
                continue
            reps, label = np.array(reps), _groups(near)
            yield pa.RecordBatch.from_arrays(
                [pa.array(reps[linked]), pa.array(reps[label[linked]]), pa.array((near @ weight)[linked].astype(np.int64))],
                ["rep", "least", "links"])
    return run


def _overlaps(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which sets have at least the threshold's Jaccard similarity, from products of 0/1 matrices."""
    sizes = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    values, place = np.unique(np.concatenate(sets), return_inverse=True)
    shared = np.bincount(place) > 1
    column = np.cumsum(shared) - 1
    keep = shared[place]
    owner, place = owner[keep], column[place[keep]]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    common = np.zeros((len(sets), len(sets)), np.float64)
    width = max(256, 2_000_000 // len(sets))
    for at in range(0, int(shared.sum()), width):
        low, high = np.searchsorted(place, [at, at + width])
        block = np.zeros((len(sets), width), np.float32)
        block[owner[low:high], place[low:high] - at] = 1
        common += block @ block.T
    union = sizes[:, None] + sizes[None, :] - common
    return common >= threshold * union - 1e-9


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, size: int = SHINGLE, recall: float = RECALL, seed: int = 3) -> DataFrame:
    """``doc_id``, ``class_id``, ``n_links``: one row per row of ``docs`` (``doc_id``, ``text``; more columns are ignored).

    ``class_id`` is the least ``doc_id`` of the documents connected by links, its own where there are none;
    ``n_links`` counts the other documents whose similarity to this one reaches the threshold. Rows are documents of their own, whether
    they repeat an id or have none.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return _classes(stage(rows, "numbered"), threshold, size, recall, seed).select("doc_id", "class_id", "n_links")


def _classes(texts: DataFrame, threshold: float = THRESHOLD, size: int = SHINGLE, recall: float = RECALL, seed: int = 3) -> DataFrame:
    """``row``, ``doc_id``, ``class`` (null for a text without words), ``class_id``, ``n_links`` of a stored table ``row``, ``doc_id``, ``text``."""
    sets = stage(texts.mapInArrow(_sketches(size), "row long, doc_id long, key binary, n long, tokens binary, sketch binary"), "sets")
    grouped = sets.filter("n > 0").groupBy("key", "n", "tokens", "sketch").agg(
        F.min("doc_id").alias("first_id"), F.min("row").alias("first_row"), F.count("*").alias("copies"))
    reps = stage(grouped.withColumn("rep", F.monotonically_increasing_id()), "representatives")
    groups = components(_candidate_links(reps, runs_needed(recall), seed)).select(F.col("node").alias("rep"), F.col("component").alias("group"))
    members = stage(groups.join(reps, "rep").select("rep", "group", "key", "n", "copies", "first_row"), "members")
    totals = members.groupBy("group").agg(
        F.ceil(F.greatest(F.sum("n") / BLOCK_SHINGLES, F.count("*") / BLOCK_SETS)).cast("int").alias("blocks"))
    # A representative is one row, so its text comes once, however many rows share its id or have none.
    placed = (members.join(totals, "group").withColumn("block", F.pmod(F.xxhash64("rep"), "blocks").cast("int"))
              .join(texts.select("row", "text").hint("merge"), F.col("first_row") == F.col("row")))
    pairs = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "group", F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"), "block", "rep", "key", "copies", "text")
    compared = stage(pairs.repartition("group", "first", "second").sortWithinPartitions("group", "first", "second")
                     .mapInArrow(_exact(threshold, size), "rep long, least long, links long"), "compared")
    links = compared.groupBy("rep").agg(F.sum("links").alias("links"))
    linked = components(compared.select(F.col("rep").alias("a"), F.col("least").alias("b")))
    named = linked.join(reps.select(F.col("rep").alias("node"), "first_id"), "node")
    ids = named.groupBy("component").agg(F.min("first_id").alias("class_id"))
    classes = named.join(ids, "component").select(F.col("node").alias("rep"), "component", "class_id")
    result = reps.join(links, "rep", "left").join(classes, "rep", "left").select(
        "key", F.coalesce("component", "rep").alias("class"), F.coalesce("class_id", "first_id").alias("class_id"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return (sets.select("row", "doc_id", "key").join(result, "key", "left")
            .select("row", "doc_id", "class", F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
                    F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")))


def keep_one(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` without all but one row of each class: the least ``doc_id`` stays, a row without an id only if the class has no other.

    Of rows with one id the first in the table stays, if they are near copies; rows of one id with different texts all stay. So do texts without words.
    """
    place = "_row"
    while place in docs.columns:
        place = "_" + place
    numbered = stage(docs.withColumn(place, F.monotonically_increasing_id()), "numbered")
    classes = _classes(numbered.select(F.col(place).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), **how)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")
    kept = classes.filter("class is not null").groupBy("class").agg(first).select(F.col("first.row").alias(place)).union(
        classes.filter("class is null").select("row"))
    return numbered.join(kept, place, "left_semi").drop(place)


# A document without a link is its own class; the classes grow over the links until nothing changes.
ORACLE = """
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w
    FROM documents),
sets AS (SELECT doc_id, list_distinct(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
             ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM words WHERE len(w) > 0),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, a.n AS nx, b.n AS ny, count(*) AS c
    FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM common WHERE 5 * c >= 4 * (nx + ny - c)),
reach AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
classes AS (SELECT x, least(x, min(y)) AS class_id FROM reach GROUP BY x),
counts AS (SELECT x, count(*) AS n_links FROM links GROUP BY x)
SELECT d.doc_id, coalesce(k.class_id, d.doc_id) AS class_id, coalesce(n.n_links, 0) AS n_links
FROM documents d LEFT JOIN classes k ON k.x = d.doc_id LEFT JOIN counts n ON n.x = d.doc_id"""
