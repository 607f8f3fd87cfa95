"""Prefix trie of conversations, with subtree totals by centroid decomposition of its parent-edge forest.

A node is a distinct sequence of first turns (role, text); its key is the exclusive or of one 128-bit hash per
place and turn, so keys of all prefixes come from running sums over blocks of turns. A node is named by its least
member and its depth, and ``paths`` tells for every conversation and depth which node that is.

Subtree totals are summed over balanced pieces. Each component of the forest is split at its centroid, the deepest node
that still has half of the component's weight below it (its members' turns, known from the grouping). The
component's total below the centroid is added to every node on the path from the centroid to the component's top; then
the centroid goes, and each of its children, and what is above it, become components of their own. Each pair of
node and ancestor is parted by exactly one centroid, so every node is counted once for each ancestor, and weights
at least halve, so few rounds do. Components of at most ``COMPONENT`` nodes are finished many to a task in the same way.

Rows without a conversation id are left out; null role or text is the empty one. Turns are ordered by ``turn`` (null first),
then role and text; repeated rows are turns of their own. No size of a conversation, node or component is assumed to fit a
task: conversations are ordered by a range sort, components split by Spark until they fit. An empty table gives no node.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowlens.session import small, stage

# Fixed values of the registered query's rebuilding.
FAMILY = 5
BORROWED = 9
BLOCK_TURNS = 1024
PIECE_IDS = 64
COMPONENT = 2048
BUNDLE = 16_384
KEY = ["depth", "k1", "k2"]


def turns_in_order(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``place`` (from 0), ``h1``, ``h2`` (hashes of role and text), ``bytes`` of the text."""
    order = ["conv_id", F.asc_nulls_first("turn"), "role", "text"]
    texts = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")])
    seated = stage(texts.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv_id", F.xxhash64(F.lit(1), "role", "text").alias("h1"), F.xxhash64(F.lit(2), "text", "role").alias("h2"),
        F.octet_length("text").cast("long").alias("bytes"), F.monotonically_increasing_id().alias("seat")), "turns")
    # Seats rise within a task; a conversation that spans tasks continues where the task before ended.
    seated = seated.withColumn("task", F.shiftright("seat", 33))
    earlier = Window.partitionBy("conv_id").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = seated.groupBy("conv_id", "task").agg(F.min("seat").alias("first"), F.count(F.lit(1)).alias("n")).select(
        "conv_id", "task", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift"))
    return seated.join(starts, ["conv_id", "task"]).select("conv_id", (F.col("seat") + F.col("shift")).alias("place"), "h1", "h2", "bytes")


def rebuilt(conversations: DataFrame, family: int = FAMILY, borrowed: int = BORROWED) -> DataFrame:
    """``conv_id``, ``turns``, ``depth``, ``h1``, ``h2``, ``bytes``: every conversation's rebuilt turns and, at depth 0, a row for its start.

    The first h turns come from the conversation ``conv_id - conv_id % family``, h being a hash of the id below ``borrowed``; the
    conversation's own turns after its first h follow.
    """
    own = stage(turns_in_order(conversations), "own-turns")
    heads = own.filter(F.col("place") < borrowed - 1).groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("place", "h1", "h2", "bytes"))).alias("head"))
    sizes = own.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    wanted = sizes.select("conv_id", "n", (F.col("conv_id") - F.col("conv_id") % family).alias("lender"),
                          (F.crc32(F.col("conv_id").cast("string").cast("binary")) % borrowed).cast("int").alias("skip"))
    lent = wanted.join(heads.withColumnRenamed("conv_id", "lender"), "lender", "left")
    lead = F.coalesce(F.slice("head", F.lit(1), F.col("skip")), F.array().cast("array<struct<place:long,h1:long,h2:long,bytes:long>>"))
    plan = stage(lent.select("conv_id", "skip", "n", lead.alias("lead")).withColumn("k", F.size("lead").cast("long"))
                 .withColumn("turns", F.col("k") + F.greatest(F.lit(0), F.col("n") - F.col("skip"))), "rebuilding")
    none = F.lit(0).cast("long")
    starts = plan.select("conv_id", "turns", none.alias("depth"), none.alias("h1"), none.alias("h2"), none.alias("bytes"))
    first = plan.select("conv_id", "turns", F.posexplode("lead").alias("at", "t")).select(
        "conv_id", "turns", (F.col("at") + 1).cast("long").alias("depth"), "t.h1", "t.h2", "t.bytes")
    rest = own.join(plan.select("conv_id", "skip", "k", "turns"), "conv_id").filter(F.col("place") >= F.col("skip")).select(
        "conv_id", "turns", (F.col("place") - F.col("skip") + F.col("k") + 1).alias("depth"), "h1", "h2", "bytes")
    return starts.unionByName(first).unionByName(rest)


def keyed(turns: DataFrame) -> DataFrame:
    """Turns with the key of the prefix that ends in them (``k1``, ``k2``) and of the one before (``p1``, ``p2``)."""
    start = F.col("depth") == 0
    rows = turns.select(
        "conv_id", "turns", "depth", "bytes", F.floor(F.col("depth") / BLOCK_TURNS).alias("block"),
        F.when(start, 0).otherwise(F.xxhash64(F.lit(3), "depth", "h1", "h2")).alias("z1"),
        F.when(start, 0).otherwise(F.xxhash64(F.lit(4), "depth", "h2", "h1")).alias("z2"))
    inside = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.select("*", F.bit_xor("z1").over(inside).alias("k1"), F.bit_xor("z2").over(inside).alias("k2"))
    rows = stage(rows, "block-keys")
    # One row per block of a conversation; conversations of one block need none.
    last = rows.filter((F.col("turns") >= BLOCK_TURNS) & ((F.col("depth") % BLOCK_TURNS == BLOCK_TURNS - 1) | (F.col("depth") == F.col("turns"))))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("conv_id", "block", F.bit_xor("k1").over(before).alias("c1"), F.bit_xor("k2").over(before).alias("c2")).filter("block > 0")
    whole = rows.join(small(carried), ["conv_id", "block"], "left")
    for n in ("1", "2"):
        whole = whole.withColumn(f"k{n}", F.col(f"k{n}").bitwiseXOR(F.coalesce(F.col(f"c{n}"), F.lit(0))))
        whole = whole.withColumn(f"p{n}", F.col(f"k{n}").bitwiseXOR(F.col(f"z{n}")))
    return whole.select("conv_id", "turns", *KEY, "p1", "p2", "bytes")


def nodes_of(rows: DataFrame) -> DataFrame:
    """One row per node: key, name (``conv_id``, ``depth``), parent's name, members, children, bytes and weight."""
    nodes = stage(rows.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("bytes").alias("bytes"), F.min("p1").alias("p1"),
        F.min("p2").alias("p2"), F.sum(F.col("turns") - F.col("depth") + 1).alias("weight")), "nodes")
    above = [(F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")]
    below_root = nodes.filter("depth > 0")
    children = below_root.select(*above).groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_children"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    return stage(nodes.join(parents, ["depth", "p1", "p2"], "left").join(children, KEY, "left").select(
        *KEY, "conv_id", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), "bytes", "weight"), "named-nodes")


def _digests(parts):
    """SHA-256 of the pieces of each node, joined by commas, as they pass by."""
    at, state = None, None
    for batch in parts:
        keys = list(zip(*(batch.column(c).to_pylist() for c in KEY)))
        done = []
        for key, piece in zip(keys, batch.column("piece").to_pylist()):
            if key == at:
                state.update(b"," + piece.encode())
                continue
            if at is not None:
                done.append((*at, state.hexdigest()))
            at, state = key, hashlib.sha256(piece.encode())
        yield _digest_rows(done)
    if at is not None:
        yield _digest_rows([(*at, state.hexdigest())])


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [(), (), (), ()]
    return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())], [*KEY, "ends_sha256"])


def ends_of(rows: DataFrame) -> DataFrame:
    """Key and digest of the nodes at which conversations end; ids travel as pieces of at most ``PIECE_IDS``."""
    pieces = rows.filter("depth = turns").groupBy(*KEY, F.floor(F.col("conv_id") / PIECE_IDS).alias("part")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda i: i.cast("string")), ",").alias("piece"))
    return pieces.repartition(*KEY).sortWithinPartitions(*KEY, "part").mapInArrow(_digests, "depth long, k1 long, k2 long, ends_sha256 string")


TOP = ["top_conv", "top_depth"]
CREDIT = "conv_id long, depth long, leaves long, saved long"


def _split_in_task(bundle: pd.DataFrame) -> pd.DataFrame:
    """Totals of the components of a bundle, all of them split at once round by round."""
    bundle = bundle.reset_index(drop=True)
    conv, depth = bundle["conv_id"].to_numpy(), bundle["depth"].to_numpy()
    weight = bundle["weight"].to_numpy().copy()
    value = bundle[["leaves", "saved"]].to_numpy()
    is_top = (conv == bundle["top_conv"].to_numpy()) & (depth == bundle["top_depth"].to_numpy())
    place = pd.Series(np.arange(len(bundle)), index=pd.MultiIndex.from_arrays([conv, depth]))
    parent = np.arange(len(bundle))
    inner = np.flatnonzero(~is_top)
    parent[inner] = place.loc[pd.MultiIndex.from_arrays([bundle["parent_conv_id"].to_numpy()[inner].astype(np.int64), depth[inner] - 1])].to_numpy()
    total = np.zeros_like(value)
    alive, up, top = np.ones(len(bundle), bool), parent.copy(), _tops(parent)
    while alive.any():
        heavy = np.flatnonzero(alive & (2 * weight >= weight[top]))
        deepest = np.full(len(bundle), -1)
        np.maximum.at(deepest, top[heavy], depth[heavy])
        centre = heavy[depth[heavy] == deepest[top[heavy]]]
        alive[centre] = False
        # A child of a centroid, and the centroid itself, are tops from now on.
        cut = ~alive[up]
        up[cut] = np.flatnonzero(cut)
        old_top, top = top, _tops(up)
        below = np.zeros_like(value)
        under = np.flatnonzero(alive & (top != old_top))
        np.add.at(below, parent[top[under]], value[under])
        gain, lost, at, end = below[centre] + value[centre], weight[centre], centre, old_top[centre]
        total[at] += gain
        while True:
            on = at != end
            if not on.any():
                break
            gain, lost, at, end = gain[on], lost[on], parent[at[on]], end[on]
            total[at] += gain
            weight[at] -= lost
    return pd.DataFrame({"conv_id": conv, "depth": depth, "leaves": total[:, 0], "saved": total[:, 1]})


def _tops(up: np.ndarray) -> np.ndarray:
    """The end of every chain of pointers, by doubling; a new array."""
    further = up[up]
    while (further != up).any():
        up, further = further, further[further]
    return further


def subtree_totals(nodes: DataFrame, paths: DataFrame, component: int = COMPONENT, bundle: int = BUNDLE) -> DataFrame:
    """``conv_id``, ``depth``, ``leaves``, ``saved``: sums of the two values over every node's subtree.

    ``nodes`` has names, ``parent_conv_id``, ``weight`` and the values; ``paths`` has for a node's ``conv_id`` and every depth
    the node there (``owner``) and the one above (``above``).
    """
    count, root = nodes.agg(F.count(F.lit(1)), F.min("conv_id")).first()
    left = nodes.select("conv_id", "depth", "parent_conv_id", "weight", "leaves", "saved", F.lit(root).cast("long").alias("top_conv"),
                        F.lit(0).cast("long").alias("top_depth"))
    closed, credits = [], []
    if count <= component:
        closed.append(left)
    while count > component:
        totals = small(left.groupBy(*TOP).agg(F.max("weight").alias("whole")))
        # Nodes with half of the weight lie on one path from the top.
        centres = small(left.join(totals, TOP).filter("2 * weight >= whole").groupBy(*TOP).agg(
            F.max(F.struct("depth", "conv_id", "weight")).alias("x")).select(
            *TOP, F.col("x.conv_id").alias("x_conv"), F.col("x.depth").alias("x_depth"), F.col("x.weight").alias("x_weight")))
        stepped = paths.select("conv_id", (F.col("depth") - 1).alias("x_depth"), "owner", "above")
        is_centre = (F.col("conv_id") == F.col("x_conv")) & (F.col("depth") == F.col("x_depth"))
        under = (F.col("depth") > F.col("x_depth")) & (F.col("above") == F.col("x_conv"))
        parted = stage(left.join(centres, TOP).join(stepped, ["conv_id", "x_depth"], "left").withColumn(
            "side", F.when(is_centre, "centre").when(under, "below").otherwise("above")), "parted")
        gains = small(parted.filter("side <> 'above'").groupBy(*TOP, "x_conv", "x_depth", "x_weight").agg(
            F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")))
        onto = stage(paths.join(gains.withColumnRenamed("x_conv", "conv_id"), "conv_id").filter("depth between top_depth and x_depth").select(
            F.col("owner").alias("conv_id"), "depth", "leaves", "saved", "x_weight"), "credits")
        credits.append(onto.drop("x_weight"))
        columns = ["conv_id", "depth", "parent_conv_id", "leaves", "saved"]
        upper = parted.filter("side = 'above'").join(onto.select("conv_id", "depth", F.col("x_weight").alias("gone")), ["conv_id", "depth"], "left").select(
            *columns, *TOP, (F.col("weight") - F.coalesce("gone", F.lit(0))).alias("weight"))
        lower = parted.filter("side = 'below'").select(
            *columns, F.col("owner").alias("top_conv"), (F.col("x_depth") + 1).alias("top_depth"), "weight")
        parts = stage(upper.unionByName(lower), "components")
        sizes = parts.groupBy(*TOP).agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > component)
        large = small(sizes.select(*TOP))
        closed.append(parts.join(large, TOP, "left_anti"))
        left = stage(parts.join(large, TOP, "left_semi"), "large-components")
        count = component + 1 if not left.isEmpty() else 0
    ready = closed[0]
    for part in closed[1:]:
        ready = ready.unionByName(part)
    ready = stage(ready, "small-components")
    bundles = max(1, -(-ready.count() // bundle))
    finished = ready.withColumn("bundle", F.pmod(F.xxhash64(*TOP), F.lit(bundles))).groupBy("bundle").applyInPandas(_split_in_task, CREDIT)
    for part in credits:
        finished = finished.unionByName(part)
    return finished.groupBy("conv_id", "depth").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def rollup(turns: DataFrame, component: int = COMPONENT, bundle: int = BUNDLE) -> DataFrame:
    """``conv_id``, ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256`` per node.

    ``turns`` is a table as ``rebuilt`` makes it. A node saves its text's bytes for every member but one.
    """
    rows = stage(keyed(turns), "keyed-turns")
    nodes = nodes_of(rows)
    owners = nodes.select("conv_id").distinct()
    paths = stage(rows.join(owners, "conv_id", "left_semi").select("conv_id", *KEY).join(
        nodes.select(*KEY, F.col("conv_id").alias("owner"), F.col("parent_conv_id").alias("above")), KEY).select("conv_id", "depth", "owner", "above"), "paths")
    values = nodes.select("conv_id", "depth", "parent_conv_id", "weight", (F.col("n_children") == 0).cast("long").alias("leaves"),
                          ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"))
    totals = subtree_totals(values, paths, component, bundle)
    nothing = hashlib.sha256(b"").hexdigest()
    return nodes.join(totals, ["conv_id", "depth"]).join(ends_of(rows), KEY, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"))


# crc32 in SQL: bit by bit over the digits of the id.
ORACLE = """
WITH RECURSIVE ordered AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS place,
        md5(concat(strlen(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS turn, strlen(coalesce(text, '')) AS bytes
    FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT conv_id, CAST(conv_id AS VARCHAR) AS digits, count(*) AS n FROM ordered GROUP BY ALL),
crc AS (SELECT conv_id, digits, 0 AS step, CAST(4294967295 AS UBIGINT) AS c FROM ids
    UNION ALL SELECT conv_id, digits, step + 1,
        CASE WHEN x % 2 = 1 THEN xor(x >> 1, CAST(3988292384 AS UBIGINT)) ELSE x >> 1 END
    FROM (SELECT conv_id, digits, step, CASE WHEN step % 8 = 0 THEN xor(c, CAST(ascii(substr(digits, CAST(step // 8 + 1 AS BIGINT), 1)) AS UBIGINT)) ELSE c END AS x
        FROM crc WHERE step < 8 * length(digits))),
skips AS (SELECT conv_id, CAST(xor(c, CAST(4294967295 AS UBIGINT)) % 9 AS BIGINT) AS skip, conv_id - conv_id % 5 AS lender FROM crc WHERE step = 8 * length(digits)),
lent AS (SELECT s.conv_id, o.place, o.turn, o.bytes FROM skips s JOIN ordered o ON o.conv_id = s.lender AND o.place < s.skip),
leads AS (SELECT s.conv_id, s.skip, count(l.place) AS k FROM skips s LEFT JOIN lent l ON l.conv_id = s.conv_id GROUP BY ALL),
turns AS (SELECT conv_id, place + 1 AS depth, turn, bytes FROM lent
    UNION ALL SELECT o.conv_id, o.place - l.skip + l.k + 1, o.turn, o.bytes FROM ordered o JOIN leads l ON l.conv_id = o.conv_id WHERE o.place >= l.skip
    UNION ALL SELECT conv_id, 0, '', 0 FROM ids),
lengths AS (SELECT conv_id, max(depth) AS turns FROM turns GROUP BY conv_id),
prefixes AS (SELECT conv_id, depth, bytes, string_agg(turn, '') OVER (PARTITION BY conv_id ORDER BY depth) AS prefix FROM turns),
nodes AS (SELECT depth, md5(prefix) AS key, min(conv_id) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes FROM prefixes GROUP BY depth, md5(prefix)),
paths AS (SELECT p.conv_id, p.depth, n.conv_id AS owner FROM prefixes p JOIN nodes n ON n.depth = p.depth AND n.key = md5(p.prefix)),
named AS (SELECT n.*, up.owner AS parent_conv_id FROM nodes n LEFT JOIN paths up ON up.conv_id = n.conv_id AND up.depth = n.depth - 1),
children AS (SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n FROM named WHERE depth > 0 GROUP BY ALL),
sized AS (SELECT n.*, coalesce(c.n, 0) AS n_children FROM named n LEFT JOIN children c ON c.conv_id = n.conv_id AND c.depth = n.depth),
totals AS (SELECT up.owner AS conv_id, up.depth, sum(CASE WHEN u.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((u.n_convs - 1) * u.bytes) AS saved_tokens
    FROM sized u JOIN paths up ON up.conv_id = u.conv_id AND up.depth <= u.depth GROUP BY ALL),
ends AS (SELECT p.owner AS conv_id, p.depth, sha256(string_agg(CAST(p.conv_id AS VARCHAR), ',' ORDER BY p.conv_id)) AS digest
    FROM paths p JOIN lengths l ON l.conv_id = p.conv_id AND l.turns = p.depth GROUP BY ALL)
SELECT s.conv_id, CAST(s.depth AS BIGINT) AS depth, s.parent_conv_id, s.n_convs, s.n_children, CAST(t.n_leaves AS BIGINT) AS n_leaves,
    CAST(t.saved_tokens AS BIGINT) AS saved_tokens, coalesce(e.digest, sha256('')) AS ends_sha256
FROM sized s JOIN totals t ON t.conv_id = s.conv_id AND t.depth = s.depth LEFT JOIN ends e ON e.conv_id = s.conv_id AND e.depth = s.depth"""
