import hashlib
import random
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from flowlens.llm import conversation_trie as trie
from flowlens.llm.shipping import ship

SCHEMA = "conv_id long, turn int, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows, rebuild=True):
    """Every prefix of every rebuilt conversation, one by one."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(role, text) for _, _, role, text in sorted(turns)] for c, turns in own.items()}
    whole = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9 if rebuild else 0
        remainder = abs(c) % 5 * (1 if c >= 0 else -1)
        whole[c] = own.get(c - remainder, [])[:h] + own[c][h:]
    members, kids = {}, {}
    for c in sorted(whole):
        for d in range(len(whole[c]) + 1):
            members.setdefault(tuple(whole[c][:d]), []).append(c)
            if d:
                kids.setdefault(tuple(whole[c][: d - 1]), set()).add(tuple(whole[c][:d]))
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node, those in members.items():
        size = len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in kids
            saved[node[:d]] += (len(those) - 1) * size
    out = []
    for node, those in members.items():
        ends = ",".join(str(c) for c in those if len(whole[c]) == len(node))
        out.append((those[0], len(node), members[node[:-1]][0] if node else None, len(those), len(kids.get(node, ())), leaves[node], saved[node],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()), key=repr)


def conversations(rng, count, turns, texts):
    return [(c, t, rng.choice(["user", "assistant"]), f"text {rng.randrange(texts)} é") for c in range(count) for t in range(rng.randrange(1, turns))]


@pytest.mark.parametrize("limits", [{}, {"component": 8, "bundle": 16}, {"component": 1, "bundle": 4}])
def test_equals_every_prefix_one_by_one(spark, limits):
    ship(spark)
    rows = conversations(random.Random(1), 60, 12, 2)
    assert found(trie.rollup(trie.rebuilt(spark.createDataFrame(rows, SCHEMA)), **limits)) == brute(rows)


def test_awkward_rows_have_a_defined_result(spark):
    ship(spark)
    rows = [(None, 0, "user", "x"), (7, None, "user", "first"), (7, None, None, None), (7, 1, "user", "same"), (7, 1, "user", "same"), (7, 1, "assistant", "tie"),
            (5, 0, "", ""), (5, 0, None, None), (5, 1, "user", "b" * 2_200_000), (6, 0, "a", "bc"), (8, 0, "ab", "c"), (-3, 0, "user", "minus"), (-5, 2, "user", "five"),
            (9, 3, "user", "漢字"), (10**12, 0, "user", "far"), (10**12 + 1, 0, "user", "far")]
    table = spark.createDataFrame(rows, SCHEMA).select("*", F.lit(1).alias("depth"), F.lit(2).alias("k1"), F.lit(3).alias("bytes"), F.lit(4).alias("place"))
    assert found(trie.rollup(trie.rebuilt(table))) == brute(rows)
    assert found(trie.rollup(trie.rebuilt(table), component=2, bundle=2)) == brute(rows)


def test_conversation_longer_than_a_block_and_a_task(spark, monkeypatch):
    ship(spark)
    monkeypatch.setattr(trie, "BLOCK_TURNS", 16)
    rows = [(1, t, "user", f"t{t}") for t in range(150)] + [(2, t, "user", f"t{t}" if t < 90 else "other") for t in range(120)] + [(3, 0, "user", "t0")]
    table = spark.createDataFrame(rows, SCHEMA).repartition(8)
    assert found(trie.rollup(trie.rebuilt(table, family=1, borrowed=1), component=40, bundle=64)) == brute(rows, rebuild=False)


def test_no_rows(spark):
    assert found(trie.rollup(trie.rebuilt(spark.createDataFrame([], SCHEMA)))) == []


def test_components_split_in_a_task_give_subtree_sums():
    rng = np.random.default_rng(5)
    # A chain, a star and a random tree; nodes are named (number, depth).
    parents = [list(range(-1, 299)), [-1] + [0] * 300, [-1] + [int(rng.integers(0, k)) for k in range(1, 400)]]
    frames, expected = [], {}
    for tree, up in enumerate(parents):
        depth, value, sums = [], rng.integers(0, 9, (len(up), 2)), np.zeros((len(up), 2), int)
        weight = np.ones(len(up), int)
        for k, p in enumerate(up):
            depth.append(0 if p < 0 else depth[p] + 1)
        sums += value
        for k in reversed(range(1, len(up))):
            sums[up[k]] += sums[k]
            weight[up[k]] += weight[k]
        name = np.arange(len(up)) + tree * 1000
        frames.append(pd.DataFrame({"conv_id": name, "depth": depth, "parent_conv_id": [None if p < 0 else p + tree * 1000 for p in up], "weight": weight,
                                    "leaves": value[:, 0], "saved": value[:, 1], "top_conv": tree * 1000, "top_depth": 0}))
        expected.update({(int(n), d): tuple(s) for n, d, s in zip(name, depth, sums.tolist())})
    got = trie._split_in_task(pd.concat(frames).sample(frac=1, random_state=1))
    assert {(r.conv_id, r.depth): (r.leaves, r.saved) for r in got.itertuples()} == expected
