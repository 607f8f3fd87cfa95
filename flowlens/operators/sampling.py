"""Reproducible samples, quotas, splits and folds.

Rows are ordered inside their group by a hash of seed and key, so a result depends neither on
partitioning nor on task order. Quotas and splits read the table twice. The first pass keeps (group, hash) of every row;
counts by group and prefix of the hash say how large the groups are and in which prefix each cut falls, and of that prefix
alone the hashes are ordered, which gives the hash the cut lies at. The second pass compares each row's hash with the cuts of its
group: a filter, without a shuffle. Only where a cut falls among rows of one hash are those rows looked at again.

``key`` names columns that identify a row; rows that share a key are ordered by a hash of the whole
row. Without a key the whole row is the key. Equal rows then share a hash, and it does not matter which of them is taken: those a cut
divides are folded into one row with a multiplicity, so a large group of copies cannot load a task; they are unfolded again in bounded
pieces.

Folds need every rank. Their rows move to hash buckets of at most ``BUCKET_ROWS`` rows (a million buckets per group at most), and without a key
the whole table is folded first.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlens.functions import text
from flowlens.session import small, small_rows, stage

BUCKET_ROWS = 50_000
MOST_DIGITS = 5
MOST_BYTES = 3
PIECE_ROWS = 100_000
HASH_DIGITS = 8


def order_hash(seed: int, columns: Sequence[Column]) -> Column:
    """Hexadecimal text whose order is a seeded shuffle."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), text.row_text(columns)))


def _key_columns(df: DataFrame, key: Sequence[str] | None) -> list[Column]:
    nested = (T.ArrayType, T.MapType, T.StructType)
    return [F.to_json(text.col(f.name)) if isinstance(f.dataType, nested) else text.col(f.name)
            for f in df.schema if key is None or f.name in key]


def fraction(df: DataFrame, share: float, key: Sequence[str], seed: int = 42) -> DataFrame:
    """About ``share`` of the rows, chosen by hash: a filter, no shuffle."""
    cut = format(round(share * 16 ** HASH_DIGITS), f"0{HASH_DIGITS}x")
    if len(cut) > HASH_DIGITS:
        return df
    return df.filter(F.substring(order_hash(seed, _key_columns(df, key)), 1, HASH_DIGITS) < cut)


def repeat_rows(df: DataFrame, times: str, piece: int = PIECE_ROWS) -> DataFrame:
    """Each row ``times`` times. Long runs are cut into pieces, dealt by row and piece over a fixed number of tasks."""
    one = F.lit(1).cast("long")
    short = (df.filter((F.col(times) > 0) & (F.col(times) <= piece))
             .withColumn("_copy", F.explode(F.sequence(one, F.col(times)))))
    # Rows with so many copies are few, but each is worth many tasks.
    cut = (df.filter(F.col(times) > piece)
           .withColumn("_piece", F.explode(F.sequence(one, F.ceil(F.col(times) / piece))))
           .withColumn("_length", F.least(F.lit(piece).cast("long"), F.col(times) - (F.col("_piece") - 1) * piece))
           .repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64(*[text.col(c) for c in df.columns]), "_piece"))
    long = cut.withColumn("_copy", F.explode(F.sequence(one, F.col("_length")))).drop("_piece", "_length")
    return short.unionByName(long).drop("_copy", times)


def _group(columns: Sequence[str]) -> Column:
    """The group of a row as one struct; it compares its null fields as equal, so missing labels form a group of their own."""
    return F.struct(*[text.col(c).alias(f"g{i}") for i, c in enumerate(columns)] or [F.lit(0).alias("all")])


class Cuts:
    """Cuts through the hash order of each group.

    ``rows`` has the table with ``_group`` and ``_hash``; ``sizes`` has one row per group with ``_size``.
    """

    def __init__(self, df: DataFrame, group: Sequence[str] = (), key: Sequence[str] | None = None, seed: int = 42, bucket_rows: int = BUCKET_ROWS) -> None:
        self.df, self.group, self.key, self.seed, self.bucket_rows = df, list(group), key, seed, bucket_rows
        self.columns = [text.col(c) for c in df.columns]
        self.rows = df.select("*", _group(group).alias("_group"), F.unhex(order_hash(seed, _key_columns(df, key))).alias("_hash"))
        hashes = stage(self.rows.select("_group", "_hash"), "hashes")
        count, self.length = hashes.count(), 0
        while count > bucket_rows * 256 ** self.length and self.length < MOST_BYTES:
            self.length += 1
        self.hashes = hashes.withColumn("_prefix", F.substring("_hash", 1, self.length))
        self.counts = stage(self.hashes.groupBy("_group", "_prefix").agg(F.count(F.lit(1)).alias("_filled")), "hash-counts")
        self.sizes = small(self.counts.groupBy("_group").agg(F.sum("_filled").alias("_size")))

    def located(self, cuts: DataFrame, names: Sequence[str]) -> tuple[DataFrame, bool]:
        """Add the hash each cut lies at (``<name>_at``, null at the group's end) and how many rows of that hash come
        before it (``<name>_take``); and whether any do."""
        earlier = Window.partitionBy("_group").orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
        ordered = self.counts.withColumn("_before", F.coalesce(F.sum("_filled").over(earlier), F.lit(0)))
        each = cuts.select("_group", F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("cut")) for n in names])).alias("c")).select("_group", "c.*")
        hit = (F.col("_before") <= F.col("cut")) & (F.col("cut") < F.col("_before") + F.col("_filled"))
        wanted = small(ordered.join(each, "_group").filter(hit).select("_group", "_prefix", "_before", "name", "cut"))
        runs = self.hashes.join(wanted, ["_group", "_prefix"]).groupBy("_group", "name", "_before", "cut", "_hash").agg(F.count(F.lit(1)).alias("_run"))
        inside = Window.partitionBy("_group", "name").orderBy("_hash").rowsBetween(Window.unboundedPreceding, -1)
        start = F.col("_before") + F.coalesce(F.sum("_run").over(inside), F.lit(0))
        at = runs.withColumn("_start", start).filter((F.col("_start") <= F.col("cut")) & (F.col("cut") < F.col("_start") + F.col("_run")))
        found = []
        for n in names:
            mine = F.col("name") == n
            found += [F.max(F.when(mine, F.col("_hash"))).alias(f"{n}_at"), F.max(F.when(mine, F.col("cut") - F.col("_start"))).alias(f"{n}_take")]
        table, rows = small_rows(cuts.join(at.groupBy("_group").agg(*found), "_group", "left"))
        taken = [f"{n}_take" for n in names]
        divided = any(r[n] for r in rows for n in taken) if rows is not None else not table.filter(" OR ".join(f"{n} > 0" for n in taken)).isEmpty()
        return table, divided


class Ranked:
    """Rows spread over hash buckets of their group.

    ``rows`` carries ``_group`` (a struct of the group columns ``g0`` …), ``_weight`` (copies),
    ``_hash`` and ``_bucket``; ``sizes`` has one row per group with ``_size`` and ``_digits``.
    """

    def __init__(self, df: DataFrame, group: Sequence[str] = (), key: Sequence[str] | None = None,
                 seed: int = 42, bucket_rows: int = BUCKET_ROWS) -> None:
        self.columns = df.columns
        self.copies = self.folded = key is None
        self.ties = [text.col(f.name) for f in df.schema if "map<" not in f.dataType.simpleString()]
        hashed = order_hash(seed, _key_columns(df, key)).alias("_hash")
        if self.folded:
            # Folding shuffles every column and hashes whole rows, so it is done once and stored.
            plain = [text.col(c) for c in df.columns]
            rows = df.groupBy(*plain).agg(F.count(F.lit(1)).alias("_weight"))
            rows = stage(rows.select("*", hashed), "folded")
        else:
            rows = df.select("*", F.lit(1).cast("long").alias("_weight"), hashed)
        rows = rows.withColumn("_group", _group(group))
        distinct = F.greatest(F.lit(1.0), F.col("_distinct") / bucket_rows)
        self.sizes, found = small_rows(
            rows.groupBy("_group").agg(F.sum("_weight").alias("_size"), F.count(F.lit(1)).alias("_distinct"))
            .select("_group", "_size", F.least(F.lit(MOST_DIGITS), F.ceil(F.log2(distinct) / 4))
                    .cast("int").alias("_digits")))
        self.bucketed = (any(r["_digits"] for r in found) if found is not None
                         else not self.sizes.filter("_digits > 0").isEmpty())
        self.rows = (rows.join(self.sizes, "_group")
                     .withColumn("_bucket", F.substring(F.col("_hash"), F.lit(1), F.col("_digits"))))

    def buckets(self) -> DataFrame:
        """Rows before each bucket of a group."""
        earlier = (Window.partitionBy("_group").orderBy("_bucket")
                   .rowsBetween(Window.unboundedPreceding, -1))
        return (self.rows.groupBy("_group", "_bucket").agg(F.sum("_weight").alias("_filled"))
                .withColumn("_before", F.coalesce(F.sum("_filled").over(earlier), F.lit(0))))

    def ranked(self, rows: DataFrame, before: Column) -> DataFrame:
        """Add ``_start``: the rows of the group that come before this one."""
        tie = [F.xxhash64(*self.ties)] if self.ties and not self.copies else []
        inside = (Window.partitionBy("_group", "_bucket").orderBy("_hash", *tie)
                  .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        return rows.withColumn("_start", before + F.sum("_weight").over(inside) - F.col("_weight"))

    def all_ranked(self) -> DataFrame:
        if not self.bucketed:
            return self.ranked(self.rows, F.lit(0).cast("long"))
        known = small(self.buckets().select("_group", "_bucket", "_before"))
        return self.ranked(self.rows.join(known, ["_group", "_bucket"]), F.col("_before"))

    def finish(self, df: DataFrame, *added: Column) -> DataFrame:
        """Original columns plus ``added``; folded rows come back as often as ``_weight`` says."""
        columns = [text.col(c) for c in self.columns]
        if not self.folded:
            return df.filter(F.col("_weight") > 0).select(*columns, *added)
        return repeat_rows(df.select(*columns, *added, "_weight"), "_weight")


def take_quota(df: DataFrame, quota: Column, group: Sequence[str], key: Sequence[str] | None,
               seed: int, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """The first ``quota`` rows of each group in hash order.

    ``quota`` may use ``_size`` (rows of the group) and ``_group.g0`` … (its group columns).
    """
    cuts = Cuts(df, group, key, seed, bucket_rows)
    wanted = cuts.sizes.select("_group", F.least(quota.cast("long"), "_size").alias("_quota"))
    located, divided = cuts.located(wanted, ["_quota"])
    near = cuts.rows.join(located, "_group")
    before = near.filter(F.col("_quota_at").isNull() | (F.col("_hash") < F.col("_quota_at"))).select(*cuts.columns)
    if not divided:
        return before
    tied = near.filter((F.col("_hash") == F.col("_quota_at")) & (F.col("_quota_take") > 0))
    if key is not None:
        rest = tied.select(*cuts.columns, F.col("_quota_take").alias("_take"))
        return before.unionByName(take_quota(rest, F.col(f"_group.g{len(group)}"), [*group, "_take"], None, seed, bucket_rows).drop("_take"))
    folded = tied.groupBy(*cuts.columns, "_quota_take").agg(F.count(F.lit(1)).alias("_weight"))
    taken = folded.select(*cuts.columns, F.least("_weight", "_quota_take").alias("_weight"))
    return before.unionByName(repeat_rows(taken, "_weight"))


def cap_rows(df: DataFrame, cap: int, group: Sequence[str] = (), key: Sequence[str] | None = None,
             seed: int = 42, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """At most ``cap`` rows per group (source, file, scenario), all of them if there are fewer."""
    return take_quota(df, F.lit(cap), group, key, seed, bucket_rows)


def fraction_per_unit(df: DataFrame, share: float, unit: Sequence[str] = (),
                      key: Sequence[str] | None = None, seed: int = 42) -> DataFrame:
    """Exactly the rounded ``share`` of every unit (chunk or file)."""
    return take_quota(df, F.bround(F.col("_size") * share, 0), unit, key, seed)


def balanced_quota(df: DataFrame, class_column: str = "class", unit: Sequence[str] = (),
                   target: int = 4000, key: Sequence[str] | None = None, seed: int = 42) -> DataFrame:
    """Half of ``target`` rows per class in units larger than ``target``; others stay whole."""
    same_unit = Window.partitionBy(*[F.col(f"_group.g{i}") for i in range(len(unit))] or [F.lit(0)])
    quota = F.when(F.sum("_size").over(same_unit) > target, target // 2).otherwise(F.col("_size"))
    return take_quota(df, quota, [*unit, class_column], key, seed)


def cap_total(df: DataFrame, cap: int, unit: str) -> DataFrame:
    """Whole units in unit order until ``cap`` rows are reached; the last unit may overshoot."""
    running = (Window.partitionBy(F.lit(0)).orderBy(unit)
               .rowsBetween(Window.unboundedPreceding, -1))
    # One row per unit (file, chunk), so the window holds counts, never rows.
    counts = df.groupBy(unit).agg(F.count(F.lit(1)).alias("_rows"))
    kept = (counts.withColumn("_written", F.coalesce(F.sum("_rows").over(running), F.lit(0)))
            .filter(F.col("_written") < cap).select(unit))
    return df.join(small(kept), unit, "left_semi")


def _train_sizes(sizes: DataFrame, test_share: float) -> DataFrame:
    """Rows per group for training: the test side gets the rounded-up share of all rows.

    Groups get the floor of their proportional part; rows left over go to the largest
    remainders. One row per class, so the windows are tiny.
    """
    everything = Window.partitionBy(F.lit(0))
    total = F.sum("_size").over(everything)
    # Rounding first keeps 0.1 / 0.8 * n from landing just above a whole number.
    train = total - F.ceil(F.round(total * F.lit(test_share), 6))
    wide = "decimal(19,0)"
    product = F.col("_size").cast(wide) * train.cast(wide)
    base = (sizes.select("_group", "_size", train.alias("_train"), product.alias("_product"),
                         total.cast(wide).alias("_total"))
            .withColumn("_floor", F.expr("_product div _total"))
            .withColumn("_rest", F.expr("_product % _total")))
    left = F.col("_train") - F.sum("_floor").over(everything)
    place = F.row_number().over(everything.orderBy(F.desc("_rest"), "_group"))
    return (base.withColumn("_left", left).withColumn("_place", place)
            .select("_group", "_size",
                    (F.col("_floor") + F.when(F.col("_place") <= F.col("_left"), 1).otherwise(0)).alias("_take")))


def _place_by_cuts(cuts: Cuts, wanted: DataFrame, cut_names: Sequence[str], names: Sequence[str], column: str) -> DataFrame:
    """Name the part of every row in ``column``; ``cut_names`` are the ascending cut columns of ``wanted``."""
    located, divided = cuts.located(wanted, cut_names)
    rows = cuts.rows.join(located, "_group")
    passed = [F.coalesce(F.col("_hash") >= F.col(f"{n}_at"), F.lit(False)).cast("int") for n in cut_names]
    part = F.get(F.array(*[F.lit(n) for n in names]), sum(passed[1:], passed[0])).alias(column)
    if not divided:
        return rows.select(*cuts.columns, part)
    tied = [F.coalesce((F.col("_hash") == F.col(f"{n}_at")) & (F.col(f"{n}_take") > 0), F.lit(False)) for n in cut_names]
    crossed = tied[0]
    for flag in tied[1:]:
        crossed = crossed | flag
    whole = rows.filter(~crossed).select(*cuts.columns, part)
    # Cuts counted from the first row of the hash that is divided.
    start = F.coalesce(*[F.when(flag, F.col(n) - F.col(f"{n}_take")) for flag, n in zip(tied, cut_names)])
    inside = [F.greatest(F.lit(0).cast("long"), F.col(n) - start).alias(f"_in{i}") for i, n in enumerate(cut_names)]
    rest = rows.filter(crossed).select(*cuts.columns, F.col("_hash").alias("_run"), *inside)
    own = [f"_in{i}" for i in range(len(cut_names))]
    if cuts.key is not None:
        # Rows of one key are a group of their own, in the order of a hash of the whole row.
        again = Cuts(rest, [*cuts.group, "_run", *own], None, cuts.seed, cuts.bucket_rows)
        first = len(cuts.group) + 1
        bounds = again.sizes.select("_group", *[F.least("_size", f"_group.g{first + i}").alias(n) for i, n in enumerate(cut_names)])
        return whole.unionByName(_place_by_cuts(again, small(bounds), cut_names, names, column).drop("_run", *own))
    folded = rest.groupBy(*cuts.columns, *own).agg(F.count(F.lit(1)).alias("_weight"))
    bounds = [F.lit(0).cast("long"), *[F.least("_weight", c) for c in own], F.col("_weight")]
    shares = F.array(*[F.struct(F.lit(name).alias("part"), (bounds[i + 1] - bounds[i]).alias("weight")) for i, name in enumerate(names)])
    unfolded = folded.withColumn("_share", F.explode(F.filter(shares, lambda s: s["weight"] > 0))).select(
        *cuts.columns, F.col("_share.part").alias(column), F.col("_share.weight").alias("_weight"))
    return whole.unionByName(repeat_rows(unfolded, "_weight"))


def stratified_split(df: DataFrame, class_column: str = "class", test: float = 0.2, val: float = 0.0,
                     key: Sequence[str] | None = None, seed: int = 42, column: str = "split",
                     bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Add ``column`` with train, val and test; every class keeps its share.

    As in a two-step split, the test part is cut off first and the validation part is taken
    from the remaining rows, each part rounded up to whole rows.
    """
    cut = Cuts(df, [class_column], key, seed, bucket_rows)
    first = _train_sizes(cut.sizes.select("_group", "_size"), test)
    if val > 0:
        rest = first.select("_group", F.col("_take").alias("_size"))
        second = _train_sizes(rest, val / (1 - test)).select("_group", F.col("_take").alias("_cut0"))
        cuts = first.select("_group", "_size", F.col("_take").alias("_cut1")).join(second, "_group")
        cut_names, names = ["_cut0", "_cut1"], ["train", "val", "test"]
    else:
        cuts = first.select("_group", "_size", F.col("_take").alias("_cut0"))
        cut_names, names = ["_cut0"], ["train", "test"]
    return _place_by_cuts(cut, small(cuts), cut_names, names, column)


def hashed_split(df: DataFrame, key: Sequence[str], test: float = 0.2, val: float = 0.0, seed: int = 42,
                 column: str = "split") -> DataFrame:
    """Split by hash alone: no shuffle, sizes only close to the shares."""
    digits = F.substring(order_hash(seed, _key_columns(df, key)), 1, HASH_DIGITS)

    def before(share: float) -> Column:
        """Whether the digits as a fraction lie below ``share``, compared as text."""
        cut = math.ceil(share * 16 ** HASH_DIGITS)
        if not 0 < cut < 16 ** HASH_DIGITS:
            return F.lit(cut > 0)
        return digits < format(cut, f"0{HASH_DIGITS}x")

    parts = F.when(before(1 - test - val), "train")
    return df.withColumn(column, (parts.when(before(1 - test), "val") if val > 0 else parts).otherwise("test"))


def stratified_folds(df: DataFrame, folds: int = 5, class_column: str = "class",
                     key: Sequence[str] | None = None, seed: int = 42, column: str = "fold",
                     bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Add a fold number; fold sizes differ by at most one, overall and within a class."""
    spread = Ranked(df, [class_column], key, seed, bucket_rows)
    before = (Window.partitionBy(F.lit(0)).orderBy("_group")
              .rowsBetween(Window.unboundedPreceding, -1))
    starts = spread.sizes.select("_group", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_class_start"))
    rows = spread.all_ranked().join(small(starts), "_group").withColumn(
        "_position", F.col("_class_start") + F.col("_start"))
    if not spread.folded:
        return spread.finish(rows, (F.col("_position") % folds).cast("int").alias(column))
    # A folded row of w copies gives every fold w // folds copies, and one more to some.
    shares = F.transform(F.sequence(F.lit(0), F.lit(folds - 1)), lambda i: F.struct(
        ((F.col("_position") + i) % folds).cast("int").alias("fold"),
        F.floor((F.col("_weight") - i + folds - 1) / folds).alias("weight")))
    divided = (rows.withColumn("_share", F.explode(F.filter(shares, lambda s: s["weight"] > 0)))
               .withColumn("_fold", F.col("_share.fold")).withColumn("_weight", F.col("_share.weight")))
    return spread.finish(divided, F.col("_fold").alias(column))
