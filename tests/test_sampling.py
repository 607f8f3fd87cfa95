from collections import Counter

import pytest
from pyspark.sql import functions as F

from flowlens.operators import sampling


@pytest.fixture(scope="module")
def flows(spark):
    """5000 rows, one class holding most of them."""
    return spark.range(5000).select("id", F.when(F.col("id") % 17 == 0, "anomaly").when(F.col("id") % 501 == 1, None).otherwise("normal").alias("class"))


def rows(df):
    return sorted(map(repr, df.collect()))


def test_cap_is_exact_and_free_of_partitioning(flows):
    one = sampling.cap_rows(flows.coalesce(1), 300, ["class"], ["id"])
    many = sampling.cap_rows(flows.repartition(13), 300, ["class"], ["id"])
    assert rows(one) == rows(many)
    assert Counter(r["class"] for r in one.collect()) == {"normal": 300, "anomaly": 295, None: 9}


def test_buckets_do_not_change_the_result(flows):
    """Small buckets take the path that large data takes."""
    assert rows(sampling.cap_rows(flows, 700, ["class"], ["id"], bucket_rows=20)) == rows(sampling.cap_rows(flows, 700, ["class"], ["id"]))
    split = {b: rows(sampling.stratified_split(flows, "class", 0.2, 0.1, ["id"], bucket_rows=b)) for b in (20, 10**6)}
    assert split[20] == split[10**6]
    folds = {b: rows(sampling.stratified_folds(flows, 5, "class", ["id"], bucket_rows=b)) for b in (20, 10**6)}
    assert folds[20] == folds[10**6]


def test_seed_changes_the_draw(flows):
    assert rows(sampling.cap_rows(flows, 50, (), ["id"], 1)) != rows(sampling.cap_rows(flows, 50, (), ["id"], 2))


def test_hot_group_of_copies(spark):
    """A third of all rows are one copied row: it is counted, not ranked row by row."""
    copies = spark.range(1000).select(F.when(F.col("id") < 334, -1).otherwise(F.col("id")).alias("v"))
    capped = sampling.cap_rows(copies, 800)
    assert capped.count() == 800
    split = sampling.stratified_split(copies.withColumn("class", F.lit("normal")), "class", 0.2, 0.1, bucket_rows=30)
    assert Counter(r["split"] for r in split.collect()) == {"train": 700, "val": 100, "test": 200}
    assert split.filter("v = -1").count() == 334
    folds = sampling.stratified_folds(copies.withColumn("class", F.lit("normal")), 5)
    assert set(Counter(r["fold"] for r in folds.collect()).values()) == {200}
    assert folds.filter("v = -1").count() == 334


def test_repeat_rows_in_pieces(spark):
    df = spark.createDataFrame([("a", 0), ("b", 25), ("c", 1)], "v string, n long")
    assert Counter(r["v"] for r in sampling.repeat_rows(df, "n", 10).collect()) == {"b": 25, "c": 1}


def test_split_sizes_follow_two_step_rule(spark):
    """600 of 1000 rows: test is cut first, validation from the rest."""
    df = spark.range(1000).select("id", F.when(F.col("id") < 600, "normal").otherwise("anomaly").alias("class"))
    counts = Counter((r["class"], r["split"]) for r in sampling.stratified_split(df, "class", 0.2, 0.1, ["id"]).collect())
    assert counts == {("normal", "train"): 420, ("normal", "val"): 60, ("normal", "test"): 120,
                      ("anomaly", "train"): 280, ("anomaly", "val"): 40, ("anomaly", "test"): 80}


def test_split_remainders_add_up(spark):
    df = spark.range(103).select("id", F.when(F.col("id") < 41, "a").when(F.col("id") < 70, "b").otherwise("c").alias("class"))
    counts = Counter(r["split"] for r in sampling.stratified_split(df, "class", 0.2, 0.0, ["id"]).collect())
    assert counts == {"train": 82, "test": 21}


def test_folds_differ_by_one(flows):
    folds = sampling.stratified_folds(flows, 5, "class", ["id"])
    assert folds.count() == 5000
    assert set(Counter(r["fold"] for r in folds.collect()).values()) == {1000}
    for name in ("normal", "anomaly"):
        sizes = Counter(r["fold"] for r in folds.filter(F.col("class") == name).collect()).values()
        assert max(sizes) - min(sizes) <= 1


def test_balanced_quota_cases(spark):
    def build(normal, anomaly):
        return spark.range(normal + anomaly).select("id", F.when(F.col("id") < normal, "normal").otherwise("anomaly").alias("class"))

    def sizes(df):
        return Counter(r["class"] for r in sampling.balanced_quota(df, key=["id"]).collect())

    assert sizes(build(5000, 300)) == {"normal": 2000, "anomaly": 300}
    assert sizes(build(3000, 1000)) == {"normal": 3000, "anomaly": 1000}


def test_total_cap_overshoots_by_one_unit(spark):
    df = spark.range(120).select("id", F.floor(F.col("id") / 40).alias("unit"))
    assert Counter(r["unit"] for r in sampling.cap_total(df, 70, "unit").collect()) == {0: 40, 1: 40}


def test_fraction_is_a_filter(flows):
    sampled = sampling.fraction(flows, 0.1, ["id"])
    assert 400 < sampled.count() < 600
    assert "Exchange" not in sampled._jdf.queryExecution().executedPlan().toString()
    assert sampling.fraction(flows, 1.0, ["id"]).count() == 5000


def test_fraction_per_unit(flows):
    chunked = flows.withColumn("chunk", F.floor(F.col("id") / 1000))
    assert set(Counter(r["chunk"] for r in sampling.fraction_per_unit(chunked, 0.05, ["chunk"], ["id"]).collect()).values()) == {50}


def test_copies_unfold_in_many_partitions(spark):
    df = spark.range(40).select("id", F.lit(1500).cast("long").alias("n"))
    sizes = [n for n in sampling.repeat_rows(df, "n", 100).rdd.glom().map(len).collect() if n]
    assert sum(sizes) == 60_000 and len(sizes) >= 6 and max(sizes) < 20_000


def test_rows_that_share_a_key_have_one_order(spark):
    df = spark.range(400).select((F.col("id") % 4).alias("key"), "id")
    draws = [rows(sampling.cap_rows(df.repartition(n), 130, (), ["key"])) for n in (1, 7)]
    assert draws[0] == draws[1] and len(draws[0]) == 130


def test_cut_among_rows_of_one_key(spark):
    """Every cut falls among rows that share a key: sizes stay exact, the draw does not depend on partitions."""
    df = spark.range(900).select((F.col("id") % 3).alias("key"), "id", F.lit("normal").alias("class"))
    draws = [sampling.stratified_split(df.repartition(n), "class", 0.2, 0.1, ["key"], bucket_rows=b) for n, b in ((1, 10**6), (7, 10))]
    assert Counter(r["split"] for r in draws[0].collect()) == {"train": 630, "val": 90, "test": 180}
    assert rows(draws[0]) == rows(draws[1])
    assert draws[0].columns == ["key", "id", "class", "split"]
    assert rows(sampling.cap_rows(df, 450, ["class"], ["key"], bucket_rows=10)) == rows(sampling.cap_rows(df.repartition(5), 450, ["class"], ["key"]))


def test_copies_across_both_cuts(spark):
    df = spark.range(1000).select(F.lit(7).alias("v"), F.when(F.col("id") < 600, "normal").otherwise(None).alias("class"))
    split = sampling.stratified_split(df, "class", 0.2, 0.1)
    assert Counter((r["class"], r["split"]) for r in split.collect()) == {
        ("normal", "train"): 420, ("normal", "val"): 60, ("normal", "test"): 120, (None, "train"): 280, (None, "val"): 40, (None, "test"): 80}


def test_no_rows_to_sample(flows):
    none = flows.limit(0)
    assert sampling.cap_rows(none, 5, ["class"], ["id"]).count() == 0
    assert sampling.stratified_split(none, "class", 0.2, 0.1, ["id"]).count() == 0
    assert sampling.cap_rows(flows, 0, ["class"], ["id"]).count() == 0


def test_whole_rows_are_chosen_by_a_filter(flows):
    """Past the cuts the table is read once more and not shuffled."""
    plan = sampling.cap_rows(flows, 300, ["class"], ["id"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Aggregate" not in plan


def test_hashed_split_compares_whole_digits(spark):
    """Text and number order agree, at the ends as well."""
    df = spark.range(3000)
    position = F.conv(F.substring(sampling.order_hash(42, [F.col("id")]), 1, 8), 16, 10).cast("double") / 2.0 ** 32
    for test, val in ((0.2, 0.0), (0.3, 0.1), (0.0, 0.0), (1.0, 0.0)):
        wanted = F.when(position < 1 - test - val, "train").when(position < 1 - test, "val").otherwise("test")
        assert sampling.hashed_split(df, ["id"], test, val).filter(F.col("split") != wanted).isEmpty()
    plan = sampling.hashed_split(df, ["id"], 0.2)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("md5") == 1
