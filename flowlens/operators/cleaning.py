"""Cleaning of numeric columns and the report about it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlens.functions import numeric, text

INFINITY = float("inf")


def infinities_to_null(df: DataFrame) -> DataFrame:
    """±inf and NaN of every floating column become null."""
    floating = (T.DoubleType, T.FloatType)
    return df.select(*[
        numeric.missing_if_not_finite(text.col(f.name)).alias(f.name)
        if isinstance(f.dataType, floating) else text.col(f.name) for f in df.schema])


def coerce_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Doubles where the text is a number, null elsewhere; one projection."""
    return df.select(*[numeric.to_number(text.col(c)).alias(c) if c in columns else text.col(c)
                       for c in df.columns])


def sanitise_columns(df: DataFrame, columns: Sequence[str], bound: float = numeric.CLIP) -> DataFrame:
    return df.select(*[numeric.sanitise(text.col(c), bound).alias(c) if c in columns else text.col(c)
                       for c in df.columns])


def fill_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.fill(0.0, list(columns))


def finite(df: DataFrame, column: str) -> DataFrame:
    """Rows whose value is a finite number."""
    return df.filter(numeric.missing_if_not_finite(numeric.to_number(text.col(column))).isNotNull())


def quality_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, rows, infinite, missing) for many columns in one pass without a shuffle of rows."""
    def infinite(value: Column) -> Column:
        return F.count_if(F.abs(value) == INFINITY)

    def missing(value: Column) -> Column:
        return F.count_if(value.isNull() | F.isnan(value))

    cells = [F.struct(F.lit(c).alias("column"), F.count(F.lit(1)).alias("rows"),
                      infinite(numeric.to_number(text.col(c))).alias("infinite"),
                      missing(numeric.to_number(text.col(c))).alias("missing")) for c in columns]
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))
