"""Counting and probing tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowlens.functions import text

PROOF_ROWS = 5000


def value_counts(df: DataFrame, column: str, top: int | None = None, keep_null: bool = False) -> DataFrame:
    """(value, count) by descending count; ties in value order."""
    counted = df.groupBy(text.col(column).alias("value")).agg(F.count(F.lit(1)).alias("count"))
    if not keep_null:
        counted = counted.filter(F.col("value").isNotNull())
    ordered = counted.orderBy(F.desc("count"), F.asc_nulls_last("value"))
    return ordered.limit(top) if top is not None else ordered


def class_distribution(df: DataFrame, column: str = "class", unit: str | None = None) -> DataFrame:
    """Count, total and share of each class, per unit if given."""
    keys = [unit] if unit else []
    counted = df.groupBy(*keys, column).agg(F.count(F.lit(1)).alias("count"))
    # The window runs over one row per unit and class.
    total = F.sum("count").over(Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0)))
    return counted.select(*keys, column, "count", total.alias("total"),
                          (F.col("count") / total).alias("share"))


def flat_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value) rows of several columns as text."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), text.col(c).cast("string").alias("value"))
                      for c in columns])
    return df.select(F.inline(cells))


def distinct_counts(df: DataFrame, columns: Sequence[str], count_null: bool = True) -> DataFrame:
    """(column, n_distinct), exact; copies collapse before the shuffle."""
    values = flat_values(df, columns).distinct()
    counted = F.count(F.lit(1)) if count_null else F.count("value")
    return values.groupBy("column").agg(counted.alias("n_distinct"))


def screen_columns(df: DataFrame, columns: Sequence[str], limit: int) -> list[str]:
    """Columns that may hold at most ``limit`` values; callers count the survivors exactly.

    Some rows with more than ``limit`` values prove a column too large. The others are
    sketched in one pass, with a margin of four times the limit: far beyond the error of the
    sketch, so no column within the limit is lost.
    """
    if not columns:
        return []
    head = df.select(*[text.col(c) for c in columns]).limit(PROOF_ROWS)
    seen = head.agg(*[F.size(F.collect_set(text.col(c).cast("string"))).alias(f"c{i}")
                      for i, c in enumerate(columns)]).first()
    open_columns = [c for c, n in zip(columns, seen) if n <= limit]
    if not open_columns:
        return []
    row = df.agg(*[F.approx_count_distinct(text.col(c)).alias(f"c{i}")
                   for i, c in enumerate(open_columns)]).first()
    return [c for c, estimate in zip(open_columns, row) if estimate <= 4 * limit]


def low_cardinality(df: DataFrame, columns: Sequence[str] | None = None, limit: int = 30) -> DataFrame:
    """(column, n_distinct) with at most ``limit`` non-null values, ascending."""
    candidates = screen_columns(df, list(columns or df.columns), limit)
    if not candidates:
        return df.sparkSession.createDataFrame([], "column string, n_distinct bigint")
    counted = distinct_counts(df, candidates, count_null=False)
    return counted.filter(F.col("n_distinct") <= limit).orderBy("n_distinct", "column")


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def distinct_labels(df: DataFrame, column: str, top: int = 20) -> DataFrame:
    """First labels in sorted order."""
    return df.select(column).distinct().orderBy(column).limit(top)
