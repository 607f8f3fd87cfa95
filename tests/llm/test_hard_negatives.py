import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlens.llm import hard_negatives
from flowlens.llm.shipping import ship

SCHEMA = "vec_id long, embedding array<float>, label int"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, step, positives=5, negatives=5, low=80, high=100):
    """Rows as (id, vector, label), compared one by one."""
    used = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows
            if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    score = lambda a, b: sum(x * y for x, y in zip(a[1], b[1]))
    out = []
    for k, a in enumerate(used):
        if a[0] % step:
            continue
        ranked = sorted(((score(a, x), x[0], n) for n, x in enumerate(used) if n != k), key=lambda t: (-t[0], t[1], t[2]))
        for p_score, p_id, _ in [t for t in ranked if used[t[2]][2] == a[2]][:positives]:
            hard = [t for t in ranked if used[t[2]][2] != a[2] and low * p_score <= 100 * t[0] <= high * p_score][:negatives]
            out += [(a[0], p_id, rank, n_id, p_score, n_score) for rank, (n_score, n_id, _) in enumerate(hard, 1)]
    return sorted(out)


def found(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()))


def vectors_around(rng, count, dims, centres=6):
    middle = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(centres)]
    rows = []
    for k in range(count):
        c = rng.choice(middle)
        rows.append((k, [float(np.float32(x + rng.gauss(0, 0.3))) for x in c], rng.randrange(3)))
    return rows


@pytest.mark.parametrize("shard_rows", [40, 8192])
def test_equals_comparing_all_pairs(spark, shard_rows, monkeypatch):
    ship(spark)
    monkeypatch.setattr(hard_negatives, "ANCHORS_PER_CLUSTER", 4)
    rows = vectors_around(random.Random(1), 300, 8)
    table = spark.createDataFrame(rows, SCHEMA)
    assert found(hard_negatives.mine(table, anchor_step=10, shard_rows=shard_rows)) == brute(rows, 10)


def test_awkward_rows_have_a_defined_result(spark):
    ship(spark)
    good = vectors_around(random.Random(2), 40, 3, 2)
    odd = [(None, [1.0, 1.0, 1.0], 1), (100, None, 1), (101, [1.0, None, 2.0], 1), (102, [1.0, float("nan"), 2.0], 2), (103, [float("inf"), 1.0, 1.0], 2),
           (104, [1.0, 1.0, 1.0], None), (110, [0.0, 0.0, 0.0], 1), (111, [], 2), (112, [0.5], 0), (120, [0.9, 0.8, 0.1], 0), (120, [0.9, 0.8, 0.1], 0),
           (121, [0.9, 0.8, 0.1], 1), (122, [0.9, 0.8, 0.1], 1), (-10, [0.9, 0.8, 0.1], 1)]
    table = spark.createDataFrame(good + odd, SCHEMA)
    clashing = table.select("*", F.lit(1).alias("row"), F.lit(2).alias("score"), F.lit(3).alias("shard"), F.lit(4).alias("v"), F.lit(5).alias("cluster"))
    expected = brute(good + odd, 10)
    assert found(hard_negatives.mine(clashing, anchor_step=10)) == expected
    assert found(hard_negatives.mine(table, anchor_step=10, shard_rows=5)) == expected


def test_many_copies_of_one_vector(spark):
    ship(spark)
    rows = [(k, [0.5, 0.25], k % 2) for k in range(400)]
    table = spark.createDataFrame(rows, SCHEMA)
    assert found(hard_negatives.mine(table, anchor_step=100, shard_rows=64)) == brute(rows, 100)


def test_no_rows(spark):
    assert found(hard_negatives.mine(spark.createDataFrame([], SCHEMA))) == []
    assert found(hard_negatives.mine(spark.createDataFrame([(1, [1.0], 1)], SCHEMA))) == []


def test_walk_ends_before_the_list_does():
    rng = np.random.default_rng(3)
    near, far = np.array([100, 0, 0, 0]) + rng.integers(-4, 5, (600, 4)), np.array([0, 100, 0, 0]) + rng.integers(-4, 5, (3000, 4))
    v = np.concatenate([near, far])
    shard = hard_negatives.Shard(np.arange(len(v)), np.arange(len(v)), np.zeros(len(v), np.int64), v)
    anchors = shard.v[:8]
    ask = hard_negatives.Walk(np.arange(8), np.full(8, np.iinfo(np.int64).min), np.full(8, np.iinfo(np.int64).max), True, 5)
    (who, which, score), computed = hard_negatives.walk(shard, anchors, shard.row[:8], shard.label[:8], np.array([1.0, 0, 0, 0]), ask)
    assert computed < 8 * len(v) / 2
    for k in range(8):
        own = sorted(((-int(anchors[k] @ shard.v[n]), n) for n in range(len(v)) if n != k))[:5]
        assert sorted(zip(-score[who == k], which[who == k])) == own


def test_no_bound_is_below_a_score():
    rng = np.random.default_rng(4)
    v = rng.integers(-50, 50, (500, 6))
    shard = hard_negatives.Shard(np.arange(500), np.arange(500), np.zeros(500, np.int64), v)
    centre = rng.normal(size=6)
    centre /= np.linalg.norm(centre)
    members = rng.integers(-50, 50, (20, 6))
    units = members / np.linalg.norm(members, axis=1)[:, None]
    order, bound = hard_negatives.shared_list(shard, centre, float(np.arccos(units @ centre).max()))
    scores = members @ shard.v[order].T
    assert (scores <= np.linalg.norm(members, axis=1)[:, None] * bound[None, :] + 1e-9).all()
    assert (np.diff(bound) <= 0).all()
