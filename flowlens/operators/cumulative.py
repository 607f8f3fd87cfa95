"""Running totals over all values of a score, in score order.

Rows are first grouped by score. Where more distinct scores remain than one task should order,
they are cut into cells of about equal size at fixed bounds, so each cell is ordered on its own
and starts with the totals of the cells before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlens.session import small

CELL_VALUES = 500_000
MOST_CELLS = 4096


def cell_bounds(df: DataFrame, score: str, cell_values: int = CELL_VALUES) -> list[float]:
    """Upper bounds of all cells but the last; empty when one cell is enough.

    ``df`` should be a stored table: it is counted, sketched and read again.
    """
    if df.count() <= cell_values:
        return []
    distinct = df.agg(F.approx_count_distinct(score)).first()[0]
    cells = min(MOST_CELLS, -(-distinct // cell_values))
    if cells <= 1:
        return []
    marks = [i / cells for i in range(1, cells)]
    found = (df.select(score).distinct()
             .agg(F.percentile_approx(score, marks, max(10_000, 20 * cells)).alias("marks")).first()[0])
    return sorted(set(found or []))


def cell_of(value: Column, bounds: Sequence[float], first: int = 0) -> Column:
    """Number of bounds below ``value`` as a balanced tree of comparisons."""
    if not bounds:
        return F.lit(first)
    middle = len(bounds) // 2
    return F.when(value <= bounds[middle], cell_of(value, bounds[:middle], first)).otherwise(
        cell_of(value, bounds[middle + 1:], first + middle + 1))


def running_totals(counts: DataFrame, score: str, measures: Sequence[str], by: Sequence[str] = (),
                   bounds: Sequence[float] = (), descending: bool = True) -> DataFrame:
    """Add ``<measure>_upto``: the total of this and all earlier scores, per ``by`` group.

    ``counts`` has one row per group and score.
    """
    direction = F.desc if descending else F.asc
    cells = counts.withColumn("_cell", cell_of(F.col(score), bounds))
    inside = (Window.partitionBy(*by, "_cell").orderBy(direction(score))
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    if not bounds:
        return cells.select("*", *[F.sum(m).over(inside).alias(f"{m}_upto") for m in measures]).drop("_cell")
    earlier = (Window.partitionBy(*(by or [F.lit(0)])).orderBy(direction("_cell"))
               .rowsBetween(Window.unboundedPreceding, -1))
    totals = cells.groupBy(*by, "_cell").agg(*[F.sum(m).alias(m) for m in measures])
    starts = small(totals.select(*by, "_cell", *[
        F.coalesce(F.sum(m).over(earlier), F.lit(0)).alias(f"_{m}_start") for m in measures]))
    return (cells.join(starts, [*by, "_cell"])
            .select(*counts.columns, *[(F.col(f"_{m}_start") + F.sum(m).over(inside)).alias(f"{m}_upto")
                                       for m in measures]))


def with_next(counts: DataFrame, score: str, measures: Sequence[str], by: Sequence[str] = (),
              bounds: Sequence[float] = (), descending: bool = True) -> DataFrame:
    """Add ``<measure>_next``: the measure at the next score, null at the last one."""
    direction = F.desc if descending else F.asc
    cells = counts.withColumn("_cell", cell_of(F.col(score), bounds))
    inside = Window.partitionBy(*by, "_cell").orderBy(direction(score))
    following = cells.select("*", *[F.lead(m).over(inside).alias(f"{m}_next") for m in measures])
    if not bounds:
        return following.drop("_cell")
    # The last score of a cell is followed by the first score of the next cell in use.
    opening = F.max_by if descending else F.min_by
    firsts = cells.groupBy(*by, "_cell").agg(*[opening(F.col(m), F.col(score)).alias(m) for m in measures])
    over_cells = Window.partitionBy(*(by or [F.lit(0)])).orderBy(direction("_cell"))
    after = small(firsts.select(*by, "_cell", *[F.lead(m).over(over_cells).alias(f"_{m}_after") for m in measures]))
    return (following.join(after, [*by, "_cell"])
            .select(*counts.columns, *[F.coalesce(f"{m}_next", f"_{m}_after").alias(f"{m}_next") for m in measures]))
