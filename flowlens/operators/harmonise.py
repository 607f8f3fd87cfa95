"""Making tables from different sources look alike."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlens.functions import text

# Identifier columns that sources carry and features must not.
NFUQ_IDENTIFIERS = ("IPV6_SRC_ADDR", "IPV6_DST_ADDR")
LUFLOW_IDENTIFIERS = ("src_ip", "dest_ip", "time_start", "time_end")
NON_FEATURES = ("class", "Label", "label", "Attack", "Dataset", "source_file", "scenario",
                "Unnamed: 0", "IPV4_SRC_ADDR", "IPV4_DST_ADDR")


def strip_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.strip() for name in df.columns])


def normalise_headers(df: DataFrame, target: str) -> tuple[DataFrame, str]:
    """Trim headers and target name and turn white space into underscores."""
    return df.toDF(*[text.header_name(name) for name in df.columns]), text.header_name(target)


def require_column(df: DataFrame, name: str) -> None:
    if name not in df.columns:
        raise ValueError(f"column '{name}' not found among {df.columns}")


def drop_present(df: DataFrame, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    return df.drop(*[name for name in names if name in df.columns and name not in keep])


def class_last(df: DataFrame, name: str = "class") -> DataFrame:
    return df.select(*[text.col(c) for c in df.columns if c != name], text.col(name))


def union_by_name(*parts: DataFrame) -> DataFrame:
    """All rows; columns are matched by name, missing ones are null."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), parts)


def feature_types(df: DataFrame, exclude: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """(numeric, categorical) feature names; booleans are numeric."""
    numeric, categorical = [], []
    for field in df.schema:
        if field.name in exclude:
            continue
        is_number = isinstance(field.dataType, (T.NumericType, T.BooleanType))
        (numeric if is_number else categorical).append(field.name)
    return numeric, categorical


def features_and_target(df: DataFrame, target: str, provenance: Sequence[str] = ()) -> tuple[list[str], str]:
    """Feature names without the target and without columns the target was made from."""
    require_column(df, target)
    return [c for c in df.columns if c != target and c not in provenance], target


def side_by_side(df: DataFrame, *blocks: Sequence[Column]) -> DataFrame:
    """Column blocks of the same rows next to each other; needs no join."""
    return df.select(*[column for block in blocks for column in block])


def with_dataset(df: DataFrame, name: str, column: str = "dataset") -> DataFrame:
    return df.withColumn(column, F.lit(name))
