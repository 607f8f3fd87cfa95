"""Imputation, scaling and encoding, fitted with exact aggregates.

What is learned from data is small (a few numbers per column, the categories of low-cardinality
columns) and becomes a projection, so applying it needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import Transformer
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.functions import numeric, text
from flowlens.operators import profile, selection

# Fixed value: most categories a column may have to get dummy columns.
MAX_CATEGORIES = 50
MOST_LEVELS = 100_000
HASH_LEVELS = 1024


@dataclass
class Dummies:
    """Categories per encoded column, and the columns dropped for having too many."""

    categories: dict[str, list[str]]
    dropped: list[str] = field(default_factory=list)

    def columns(self) -> list[Column]:
        """``<column>_<value>`` indicators; missing values are 0 in all of them."""
        return [F.when(text.col(name).cast("string") == value, 1.0).otherwise(0.0).alias(f"{name}_{value}")
                for name, values in self.categories.items() for value in values]

    def names(self) -> list[str]:
        return [f"{name}_{value}" for name, values in self.categories.items() for value in values]


def fit_dummies(df: DataFrame, columns: Sequence[str], limit: int = MAX_CATEGORIES,
                count_null: bool = True) -> Dummies:
    """Categories of every column with at most ``limit`` values (missing counts as one)."""
    candidates = profile.screen_columns(df, list(columns), limit)
    found: dict[str, list[str | None]] = {name: [] for name in candidates}
    if candidates:
        # The screen bounds what can arrive here to a few hundred values per column.
        for row in profile.flat_values(df, candidates).distinct().collect():
            found[row["column"]].append(row["value"])
    kept = {}
    for name in columns:
        values = found.get(name)
        if values is not None and len([v for v in values if count_null or v is not None]) <= limit:
            kept[name] = sorted(v for v in values if v is not None)
    return Dummies(kept, [name for name in columns if name not in kept])


def encode(df: DataFrame, numbers: Sequence[str], dummies: Dummies, keep: Sequence[str] = (),
           bound: float = numeric.CLIP) -> DataFrame:
    """Numeric block, cleaned and clipped, next to the dummy block."""
    cleaned = [numeric.sanitise(numeric.to_number(text.col(c)), bound).alias(c) for c in numbers]
    return df.select(*[text.col(c) for c in keep], *cleaned, *dummies.columns())


@dataclass
class NumericFit:
    median: float
    mean: float
    deviation: float


def fit_numbers(df: DataFrame, columns: Sequence[str]) -> dict[str, NumericFit]:
    """Median, and mean and population deviation after imputing it; deviation 0 becomes 1."""
    cleaned = {name: numeric.missing_if_not_finite(numeric.to_number(text.col(name))) for name in columns}
    if not cleaned:
        return {}
    middle = {name: 0.0 if value is None else value for name, value in selection.medians(df, cleaned).items()}
    filled = {name: F.coalesce(value, F.lit(middle[name])) for name, value in cleaned.items()}
    row = df.agg(*[F.avg(v) for v in filled.values()], *[F.stddev_pop(v) for v in filled.values()]).first()
    half = len(filled)
    return {name: NumericFit(middle[name], row[i] or 0.0, row[half + i] or 1.0) for i, name in enumerate(filled)}


def fit_modes(df: DataFrame, columns: Sequence[str]) -> dict[str, str | None]:
    """Most frequent value of each column; the smallest wins a tie."""
    if not columns:
        return {}
    counted = (profile.flat_values(df, columns).filter(F.col("value").isNotNull())
               .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))
    best = counted.groupBy("column").agg(F.min_by("value", F.struct(-F.col("n"), "value")).alias("mode"))
    modes = {r["column"]: r["mode"] for r in best.collect()}
    return {name: modes.get(name) for name in columns}


def scaled(name: str, fit: NumericFit) -> Column:
    value = numeric.missing_if_not_finite(numeric.to_number(text.col(name)))
    return (F.coalesce(value, F.lit(fit.median)) - fit.mean) / fit.deviation


def impute_and_scale(df: DataFrame, fits: dict[str, NumericFit], keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*[text.col(c) for c in keep], *[scaled(n, f).alias(n) for n, f in fits.items()])


def _number(value: float) -> str:
    return f"double('{value!r}')"


def projection_stage(fits: dict[str, NumericFit], modes: dict[str, str | None]) -> Transformer:
    """The fitted numeric and categorical projection as a stage that is saved with a model.

    Adds ``num_<i>`` and ``cat_<i>`` in the order of ``fits`` and ``modes``.
    """
    parts = []
    for i, (name, fit) in enumerate(fits.items()):
        number = f"try_cast({text.quoted(name)} AS double)"
        finite = f"CASE WHEN abs({number}) < double('Infinity') THEN {number} END"
        parts.append(f"(coalesce({finite}, {_number(fit.median)}) - {_number(fit.mean)})"
                     f" / {_number(fit.deviation)} AS num_{i}")
    for i, (name, mode) in enumerate(modes.items()):
        shown = "''" if mode is None else "'" + mode.replace("\\", "\\\\").replace("'", "\\'") + "'"
        parts.append(f"coalesce(CAST({text.quoted(name)} AS string), {shown}) AS cat_{i}")
    return SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")


def settle_levels(df: DataFrame, columns: Sequence[str], wide: str = "fail", most: int = MOST_LEVELS) -> tuple[DataFrame, list[str]]:
    """The table and its categorical columns, after what the caller chose for columns of very many categories.

    One-hot encoding keeps a dictionary of each column on every executor. ``wide`` says what becomes of
    columns with more than ``most`` categories, counted exactly: ``fail``, or ``drop`` them; ``hash`` puts the values of
    every categorical column into ``HASH_LEVELS`` groups, whatever their number.
    """
    if wide == "hash":
        grouped = {c: F.when(text.col(c).isNotNull(), F.pmod(F.xxhash64(text.col(c)), F.lit(HASH_LEVELS)).cast("string")) for c in columns}
        return df.select(*[grouped[c].alias(c) if c in grouped else text.col(c) for c in df.columns]), list(columns)
    if not columns:
        return df, []
    # One pass sketches all columns; only those near the limit or above it are counted exactly, each by itself.
    sketched = df.agg(*[F.approx_count_distinct(text.col(c), 0.02).alias(str(i)) for i, c in enumerate(columns)]).first()
    near = [c for i, c in enumerate(columns) if sketched[i] > 0.8 * most]
    over = [c for c in near if df.select(text.col(c)).distinct().limit(most + 1).count() > most]
    if over and wide != "drop":
        raise ValueError(f"columns {over} hold more than {most} categories; choose drop or hash")
    return df, [c for c in columns if c not in over]


def label_code(label: Column, classes: Sequence[str]) -> Column:
    """Place of a label among the alphabetically ordered classes, null for other labels."""
    place = F.array_position(F.array(*[F.lit(c) for c in sorted(classes)]), label)
    return F.when(place > 0, place - 1).cast("int")


def label_of(code: Column, classes: Sequence[str]) -> Column:
    """The label of a code."""
    return F.get(F.array(*[F.lit(c) for c in sorted(classes)]), code)


MOST_CLASSES = 1000


def class_weights(df: DataFrame, target: str, most: int = MOST_CLASSES) -> dict[str, float]:
    """Balanced weight n / (k · n_c) per class; a target of more than ``most`` values is no class column."""
    counts = {r[target]: r["count"] for r in df.groupBy(target).count().limit(most + 1).collect()}
    if len(counts) > most:
        raise ValueError(f"column '{target}' holds more than {most} classes")
    total = sum(counts.values())
    return {label: total / (len(counts) * n) for label, n in counts.items()}


def with_weight(df: DataFrame, target: str, weights: dict[str, float], column: str = "_weight") -> DataFrame:
    chain = F.lit(1.0)
    for label, weight in weights.items():
        chain = F.when(F.col(target) == label, weight).otherwise(chain)
    return df.withColumn(column, chain)
