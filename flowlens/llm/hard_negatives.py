"""Hard negatives by exact inner-product search over lists that clustered anchors share.

Anchors are clustered by direction. For a cluster with centroid ``c`` whose members are at most an angle ``w``
away from it, no member ``u`` scores a candidate ``x`` above ``|u| |x| cos(max(0, angle(x, c) - w))``. Candidates are
sorted by that bound once per cluster, and every member walks the same list until its bound is
below all it still looks for: then nothing further on can enter its result.

Candidates are dealt to shards of a bounded number of rows. Every shard has its own lists, meets all anchors in
blocks of one cluster, and ends its walks by itself; the results of the shards are merged. The first walk finds each
anchor's positives, the second, with their scores known, the negatives in the window below each of them.

Vectors become whole numbers, ``floor(scale * x)``, and scores are their exact inner products (below 2^63).
Rows without an id, label or vector, or with a null or non-finite component, take no part. A shorter vector is
read as if zeros followed. Rows that repeat an id are rows of their own, as anchors too; equal scores go by the lesser id.
Columns other than the three named ones are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlens.session import stage

ANCHOR_STEP = 100
POSITIVES = 5
NEGATIVES = 5
# Window of a negative's score, in per cent of the positive's.
LOW, HIGH = 80, 100
SCALE = 256
SHARD_ROWS = 8192
BLOCK_ANCHORS = 512
# Clusters grow with the anchors up to MOST_CLUSTERS; centroids are fitted on SAMPLE anchors at most.
ANCHORS_PER_CLUSTER = 64
MOST_CLUSTERS = 64
SAMPLE = 4096
STEP = 512
_EXACT = float(1 << 53)


def whole_vectors(vectors: DataFrame, label: Column, scale: int = SCALE) -> DataFrame:
    """``row``, ``vec_id``, ``label``, ``v`` of the rows that take part, ``v`` as whole numbers."""
    values = F.transform("embedding", lambda x: x.cast("double"))
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
    finite = F.forall("embedding", lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    return vectors.filter(usable & finite).select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"),
        F.transform(values, lambda x: F.floor(F.lit(float(scale)) * x).cast("long")).alias("v"))


def centroids(directions: np.ndarray, count: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    """Unit vectors around which the given unit vectors lie, by spherical k-means."""
    rng = np.random.default_rng(seed)
    found = directions[rng.choice(len(directions), min(count, len(directions)), replace=False)]
    for _ in range(rounds):
        nearest = (directions @ found.T).argmax(1)
        sums = np.zeros_like(found)
        np.add.at(sums, nearest, directions)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        found = np.where(norms > 0, sums / np.maximum(norms, 1e-300), found)
    return found


def _matrix(column: pa.Array) -> np.ndarray:
    """Equally long lists of whole numbers as the rows of a matrix."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int64)


def _unit(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    rows = rows.astype(np.float64)
    norms = np.linalg.norm(rows, axis=1)
    return rows / np.maximum(norms, 1e-300)[:, None], norms


def _assign(found: np.ndarray):
    """The cluster of each anchor: the centroid nearest by angle."""
    def run(parts):
        for batch in parts:
            units, _ = _unit(_matrix(batch.column("v")))
            nearest = (units @ found.T).argmax(1) if len(units) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nearest.astype(np.int32))], [*batch.schema.names, "cluster"])
    return run


def _products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows: in floating point where no sum can reach 2^53."""
    most = float(np.abs(left).max(initial=0)) * float(np.abs(right).max(initial=0)) * max(left.shape[1], 1)
    if most < _EXACT:
        return (left.astype(np.float64) @ right.astype(np.float64).T).astype(np.int64)
    return left @ right.T


@dataclass
class Shard:
    """Candidates of one shard, with their directions and lengths."""

    vec_id: np.ndarray
    row: np.ndarray
    label: np.ndarray
    v: np.ndarray

    def __post_init__(self):
        order = np.lexsort((self.row, self.vec_id))
        self.vec_id, self.row, self.label, self.v = (x[order] for x in (self.vec_id, self.row, self.label, self.v))
        self.units, self.norms = _unit(self.v)


@dataclass
class Walk:
    """What one look-up wants: ``keep`` best scores in [``low``, ``high``] for an anchor, of its label or of others."""

    anchor: np.ndarray  # place in the block
    low: np.ndarray
    high: np.ndarray
    same: bool
    keep: int


def shared_list(shard: Shard, centre: np.ndarray, width: float) -> tuple[np.ndarray, np.ndarray]:
    """Candidates of a shard by falling bound, and the bounds for an anchor of length one."""
    angle = np.arccos(np.clip(shard.units @ centre, -1, 1))
    # The slack covers rounding in angles and norms.
    bound = shard.norms * (np.cos(np.maximum(0, angle - width - 1e-7)) + 1e-9)
    order = np.argsort(-bound, kind="stable")
    return order, bound[order]


def walk(shard: Shard, anchors: np.ndarray, rows: np.ndarray, labels: np.ndarray, centre: np.ndarray, ask: Walk):
    """Places of look-ups and candidates, and scores, of the ``keep`` best per look-up; and the scores computed."""
    units, norms = _unit(anchors)
    near = np.clip(units @ centre, -1, 1)
    width = float(np.arccos(near).max(initial=0))
    order, bound = shared_list(shard, centre, width)
    best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    floor = ask.low.astype(np.float64)  # a score below it changes nothing any more
    computed = 0
    alive = np.flatnonzero(ask.low <= ask.high)
    for at in range(0, len(order), STEP):
        alive = alive[norms[ask.anchor[alive]] * bound[at] >= floor[alive]]
        if not len(alive):
            break
        chunk = order[at : at + STEP]
        members, place = np.unique(ask.anchor[alive], return_inverse=True)
        scores = _products(anchors[members], shard.v[chunk])
        computed += scores.size
        fits = labels[members][:, None] == shard.label[chunk][None, :]
        fits = fits & (rows[members][:, None] != shard.row[chunk][None, :]) if ask.same else ~fits
        scores, fits = scores[place], fits[place]
        hit, column = np.nonzero(fits & (scores >= floor[alive][:, None]) & (scores <= ask.high[alive][:, None]))
        if not len(hit):
            continue
        best = tuple(np.concatenate(pair) for pair in zip(best, (alive[hit], chunk[column], scores[hit, column])))
        # Candidates of a shard lie in order of their ids, so the lesser place wins a tie.
        sort = np.lexsort((best[1], -best[2], best[0]))
        asked = best[0][sort]
        rank = np.arange(len(sort)) - np.searchsorted(asked, asked, "left")
        kept = rank < ask.keep
        best = tuple(x[sort][kept] for x in best)
        last = rank[kept] == ask.keep - 1
        floor[best[0][last]] = np.maximum(floor[best[0][last]], best[2][last])
    return best, computed


_NEGATIVE = np.int64(np.iinfo(np.int64).min)
_POSITIVE = np.int64(np.iinfo(np.int64).max)
FOUND = "anchor_row long, anchor_id long, positive_row long, positive_id long, positive_score long, row long, vec_id long, score long, label long"


def _asks(positives: list, keep: int, low: int, high: int):
    """Look-ups of a block: one per anchor for positives, one per anchor and positive for negatives."""
    if positives is None:
        return None
    owner = np.repeat(np.arange(len(positives)), [len(p) for p in positives])
    flat = [p for own in positives for p in own]
    score = np.array([p["score"] for p in flat], np.int64)
    # low * positive <= 100 * negative <= high * positive, in whole numbers.
    return Walk(owner, -((-low * score) // 100), (high * score) // 100, False, keep), flat


def _search(found: np.ndarray, dims: int, keep: int, low: int | None = None, high: int | None = None):
    """Walks of all anchor blocks over the candidates of each shard; a shard's candidates come before its anchors."""
    def results(shard: Shard, block: list[pa.RecordBatch]):
        table = pa.Table.from_batches(block).combine_chunks()
        v = _matrix(table.column("v").combine_chunks())
        rows, ids, labels = (table.column(c).to_numpy() for c in ("row", "vec_id", "label"))
        centre = found[table.column("cluster")[0].as_py()]
        if low is None:
            count = len(rows)
            ask, flat = Walk(np.arange(count), np.full(count, _NEGATIVE), np.full(count, _POSITIVE), True, keep), None
        else:
            ask, flat = _asks(table.column("positives").to_pylist(), keep, low, high)
        (who, which, score), _ = walk(shard, v, rows, labels, centre, ask)
        anchor = ask.anchor[who]
        empty = pa.nulls(len(who), pa.int64())
        known = [empty] * 3 if flat is None else [pa.array([flat[k][name] for k in who], pa.int64()) for name in ("row", "vec_id", "score")]
        return pa.RecordBatch.from_arrays(
            [pa.array(rows[anchor]), pa.array(ids[anchor]), *known, pa.array(shard.row[which]), pa.array(shard.vec_id[which]),
             pa.array(score), pa.array(labels[anchor])], [part.split()[0] for part in FOUND.split(", ")])

    def run(parts):
        shard, gathered, block, at = None, [], [], None
        for batch in parts:
            keys = np.stack([batch.column(c).to_numpy() for c in ("shard", "kind", "cluster", "block")])
            edges = np.flatnonzero(np.any(keys[:, 1:] != keys[:, :-1], axis=0)) + 1 if batch.num_rows else np.zeros(0, int)
            for start, end in zip([0, *edges], [*edges, batch.num_rows]):
                if end == start:
                    continue
                key = tuple(keys[:, start].tolist())
                if key != at:
                    if block:
                        yield results(shard, block)
                    block = []
                    if at is None or key[0] != at[0]:
                        shard, gathered = None, []
                    at = key
                piece = batch.slice(start, end - start)
                if key[1] == 0:
                    gathered.append(piece)
                    continue
                if shard is None:
                    if gathered:
                        table = pa.Table.from_batches(gathered).combine_chunks()
                        shard = Shard(*(table.column(c).to_numpy() for c in ("vec_id", "row", "label")), _matrix(table.column("v").combine_chunks()))
                        gathered = []
                    else:
                        shard = Shard(*(np.zeros(0, np.int64) for _ in range(3)), np.zeros((0, dims), np.int64))
                block.append(piece)
        if block:
            yield results(shard, block)
    return run


def _met(rows: DataFrame, anchors: DataFrame, shards: int, extra: str) -> DataFrame:
    """Candidates, each in its shard, and all anchors in every shard, in the order a task reads them."""
    columns = ["shard", "kind", "cluster", "block", "row", "vec_id", "label", "v", "positives"]
    none = F.lit(None).cast(extra).alias("positives")
    candidates = rows.select(F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int").alias("shard"), F.lit(0).alias("kind"), F.lit(0).alias("cluster"),
                             F.lit(0).alias("block"), "row", "vec_id", "label", "v", none)
    anchors = anchors if "positives" in anchors.columns else anchors.withColumn("positives", F.lit(None).cast(extra))
    asked = anchors.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).withColumn("kind", F.lit(1)).select(*columns)
    return candidates.unionByName(asked).repartition(shards, "shard").sortWithinPartitions("shard", "kind", "cluster", "block", "row")


def _first(found: DataFrame, keys: list[str], keep: int) -> DataFrame:
    """Of the shards' results the ``keep`` best per look-up, with their rank."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= keep)


def mine(vectors: DataFrame, label: Column | None = None, anchor_step: int = ANCHOR_STEP, positives: int = POSITIVES,
         negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    ``vectors`` has ``vec_id``, ``embedding``, ``label``; ``label`` may be another expression of these. Anchors are rows whose id
    divides by ``anchor_step``, their positives the ``positives`` best other rows of the same label, and the negatives of a positive the
    best rows of other labels that score ``low`` to ``high`` per cent of it.
    """
    if not 0 <= low <= high:
        raise ValueError("a window from low to high per cent")
    rows = whole_vectors(vectors, F.col("label") if label is None else label, scale)
    rows = stage(rows, "vectors")
    count, dims = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    missing = F.array_repeat(F.lit(0).cast("long"), F.lit(max(dims, 1)) - F.size("v"))
    rows = rows.withColumn("v", F.concat("v", missing))
    asked = rows.filter(F.col("vec_id") % anchor_step == 0)
    sample = asked.orderBy(F.xxhash64("row"), "row").limit(SAMPLE).select("v").toArrow()
    directions = _unit(_matrix(sample.column("v").combine_chunks()))[0] if sample.num_rows else np.zeros((1, max(dims, 1)))
    anchors_there = asked.count()
    found = centroids(directions, max(1, min(MOST_CLUSTERS, anchors_there // ANCHORS_PER_CLUSTER)))
    schema = "row long, vec_id long, label long, v array<long>"
    clustered = asked.mapInArrow(_assign(found), f"{schema}, cluster int")
    # One row per cluster, so the sizes are few.
    sizes = {r["cluster"]: -(-r["count"] // BLOCK_ANCHORS) for r in clustered.groupBy("cluster").count().collect()}
    blocks = F.element_at(F.array(*[F.lit(sizes.get(k, 1)) for k in range(len(found))]), F.col("cluster") + 1)
    anchors = stage(clustered.withColumn("block", F.pmod(F.xxhash64("row"), blocks).cast("int")), "anchors")
    shards = max(1, -(-count // shard_rows))
    known = "array<struct<row:long,vec_id:long,score:long>>"

    near = _met(rows, anchors, shards, known).mapInArrow(_search(found, dims, positives), FOUND)
    best = _first(near, ["anchor_row"], positives).groupBy(F.col("anchor_row").alias("row")).agg(
        F.sort_array(F.collect_list(F.struct("row", "vec_id", "score"))).alias("positives"))
    paired = stage(anchors.join(best, "row"), "anchors-with-positives")
    hard = _met(rows, paired, shards, known).mapInArrow(_search(found, dims, negatives, low, high), FOUND)
    return _first(hard, ["anchor_row", "positive_row"], negatives).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))


def query_label() -> Column:
    """The labels of the registered query: every id that divides by 7 has the next of ten labels."""
    return F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))


ORACLE = """
WITH usable AS (SELECT row_number() OVER () AS row, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.row AS anchor_row, a.vec_id AS anchor_id, x.row, x.vec_id, a.label = x.label AS same,
        CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * x.v[i])) AS BIGINT) AS score
    FROM usable a, usable x WHERE a.vec_id % 100 = 0 AND a.row <> x.row),
positives AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_row ORDER BY score DESC, vec_id) AS place FROM scored WHERE same) WHERE place <= 5),
ranked AS (SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
        CAST(row_number() OVER (PARTITION BY p.anchor_row, p.row ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank
    FROM positives p JOIN scored n ON n.anchor_row = p.anchor_row AND NOT n.same AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 5"""
