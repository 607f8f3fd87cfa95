"""Exact order statistics of whole columns without sorting them.

A column longer than ``ORDER_ROWS`` is first narrowed: a sketch proposes an interval around the
wanted rank, exact counts confirm it, and the step repeats inside. Only the values of the last
interval are grouped and ordered. All requested columns are narrowed in the same passes.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlens.functions import numeric

ORDER_ROWS = 1_000_000
SKETCH_ACCURACY = 10_000


def lower_rank(q: float) -> Callable[[int], int]:
    """Zero-based rank floor(q · (n − 1))."""
    return lambda n: math.floor(q * (n - 1))


def upper_rank(q: float) -> Callable[[int], int]:
    """The same rank counted from the largest value."""
    return lambda n: n - 1 - math.floor(q * (n - 1))


@dataclass
class _Search:
    value: Column
    place: int
    rank: int
    rows: int
    low: float | None = None
    high: float | None = None
    narrowing: bool = True

    def holds(self, value: Column) -> Column:
        if self.low is None:
            return value.isNotNull()
        return (value >= self.low) & (value <= self.high)

    def is_wide(self, order_rows: int) -> bool:
        return self.narrowing and self.rows > order_rows and (self.low is None or self.low < self.high)


def order_statistics(df: DataFrame, wanted: Mapping[str, tuple[Column, Callable[[int], int]]],
                     order_rows: int = ORDER_ROWS) -> DataFrame:
    """(name, value, n) for each wanted (column, rank of n); value is null when n is 0.

    ``n`` counts the finite values of the column.
    """
    places: dict[str, int] = {}
    for column, _ in wanted.values():
        places.setdefault(str(column), len(places))
    distinct = {places[str(column)]: column for column, _ in wanted.values()}
    flat = df.select(*[numeric.missing_if_not_finite(column).alias(f"v{j}") for j, column in distinct.items()])
    counts = list(flat.agg(*[F.count(f"v{j}").alias(f"n{j}") for j in distinct]).first())
    searches = {}
    for name, (column, rank) in wanted.items():
        j = places[str(column)]
        if counts[j]:
            searches[name] = _Search(F.col(f"v{j}"), j, rank(counts[j]), counts[j])
    while wide := [s for s in searches.values() if s.is_wide(order_rows)]:
        _narrow(flat, wide)
    return _pick(flat, searches, {name: counts[places[str(column)]] for name, (column, _) in wanted.items()})


def _narrow(flat: DataFrame, searches: list[_Search]) -> None:
    margin = 3.0 / SKETCH_ACCURACY
    # Searches of one span (both middles of a median) share a sketch.
    spans: dict[tuple, list[int]] = {}
    for i, s in enumerate(searches):
        spans.setdefault((s.place, s.low, s.high), []).append(i)
    proposals = []
    for members in spans.values():
        shares = [(searches[i].rank + 0.5) / searches[i].rows for i in members]
        marks = F.array(*[F.lit(mark) for share in shares for mark in (max(0.0, share - margin), min(1.0, share + margin))])
        first = searches[members[0]]
        proposals.append(F.percentile_approx(F.when(first.holds(first.value), first.value), marks, SKETCH_ACCURACY))
    found = list(flat.agg(*[p.alias(f"p{i}") for i, p in enumerate(proposals)]).first())
    proposed = {i: marks[2 * k:2 * k + 2] for members, marks in zip(spans.values(), found) for k, i in enumerate(members)}
    intervals = [proposed[i] for i in range(len(searches))]
    checks = []
    for s, (low, high) in zip(searches, intervals):
        held = s.holds(s.value)
        checks += [F.count_if(held & (s.value < low)), F.count_if(held & (s.value >= low) & (s.value <= high))]
    found = list(flat.agg(*[c.alias(f"c{i}") for i, c in enumerate(checks)]).first())
    for s, (low, high), below, inside in zip(searches, intervals, found[::2], found[1::2]):
        confirmed = below <= s.rank < below + inside
        # An interval that misses the rank or hardly shrinks ends the search; the rows that
        # are left are then grouped by value as they are, which stays exact.
        s.narrowing = confirmed and inside < 0.9 * s.rows
        if confirmed:
            s.rank, s.rows, s.low, s.high = s.rank - below, inside, low, high


def _pick(flat: DataFrame, searches: dict[str, _Search], counts: Mapping[str, int]) -> DataFrame:
    """Group the values that are left and pick the one at each rank."""
    cells = []
    for j in sorted({s.place for s in searches.values()}):
        value = F.col(f"v{j}")
        mine = [s.holds(value) for s in searches.values() if s.place == j]
        cells.append(F.when(reduce(Column.__or__, mine), F.struct(F.lit(j).alias("_j"), value.alias("value"))))
    nothing = F.array(F.lit(None).cast("struct<_j: int, value: double>"))
    grouped = (flat.select(F.explode(F.array(*cells) if cells else nothing).alias("cell"))
               .filter("cell is not null").select("cell._j", "cell.value")
               .groupBy("_j", "value").agg(F.count(F.lit(1)).alias("_rows")))
    upto = Window.partitionBy("_j").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Searches over whole columns share one running total; narrowed ones count their interval.
    spans = {(s.place, s.low, s.high) if s.low is not None else None: s for s in searches.values()}
    running, totals = grouped, {}
    for i, (span, s) in enumerate(spans.items()):
        inside = F.col("_rows") if span is None else F.when((F.col("_j") == s.place) & s.holds(F.col("value")), F.col("_rows"))
        running, totals[span] = running.withColumn(f"_upto{i}", F.sum(inside).over(upto)), f"_upto{i}"
    found = {}
    for name, s in searches.items():
        total = F.col(totals[(s.place, s.low, s.high) if s.low is not None else None])
        here = ((F.col("_j") == s.place) & s.holds(F.col("value")) & (total > s.rank)
                & (total - F.col("_rows") <= s.rank))
        found[name] = F.max(F.when(here, F.col("value")))
    rows = [F.struct(F.lit(name).alias("name"), found.get(name, F.max(F.lit(None).cast("double"))).alias("value"),
                     F.lit(n).cast("long").alias("n")) for name, n in counts.items()]
    return running.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def lower_quantile(df: DataFrame, column: str, q: float) -> DataFrame:
    """One row (value, n): the element at floor(q · (n − 1)) of the sorted finite values."""
    return order_statistics(df, {"quantile": (F.col(column), lower_rank(q))}).select("value", "n")


def medians(df: DataFrame, columns: Mapping[str, Column], order_rows: int = ORDER_ROWS) -> dict[str, float | None]:
    """Exact medians; an even number of values gives the mean of the middle pair."""
    wanted = {}
    for name, column in columns.items():
        wanted[f"low {name}"] = (column, lower_rank(0.5))
        wanted[f"high {name}"] = (column, upper_rank(0.5))
    found = {r["name"]: r["value"] for r in order_statistics(df, wanted, order_rows).collect()}
    pairs = {name: (found[f"low {name}"], found[f"high {name}"]) for name in columns}
    return {name: None if low is None else (low + high) / 2 for name, (low, high) in pairs.items()}
