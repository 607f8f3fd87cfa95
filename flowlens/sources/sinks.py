"""Tables, metrics documents and dashboard exports written to files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.functions import text


def write_merged(df: DataFrame, path: str, partition: str = "dataset") -> None:
    """Merged flow table, one folder per dataset."""
    df.write.partitionBy(partition).mode("append").parquet(path)


def write_splits(df: DataFrame, path: str, column: str = "split", fmt: str = "parquet") -> None:
    """train, val and test rows, one folder per split."""
    writer = df.write.partitionBy(column).mode("overwrite")
    (writer.option("header", True) if fmt == "csv" else writer).format(fmt).save(path)


def write_predictions(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    writer = df.write.mode("overwrite")
    (writer.option("header", True) if fmt == "csv" else writer).format(fmt).save(path)


def write_metrics(document: DataFrame, path: str) -> None:
    """The one-row metrics document as JSON."""
    document.coalesce(1).write.mode("overwrite").json(path)


def alert_export(alerts: DataFrame, now: Column | None = None) -> DataFrame:
    return alerts.select(text.uk_time(F.col("time"), now).alias("Time"), F.col("label").alias("Label"),
                         F.col("anomaly_score").alias("Anomaly Score"),
                         F.col("severity").alias("Severity"), F.col("action").alias("Action"),
                         F.col("status").alias("Status"))


def log_export(logs: DataFrame, now: Column | None = None) -> DataFrame:
    return logs.select(text.uk_time(F.col("timestamp"), now).alias("Timestamp"),
                       F.col("type").alias("Type"), F.col("message").alias("Message"))


def write_export(df: DataFrame, path: str) -> None:
    """CSV with a header; values holding a comma are quoted."""
    df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)


def result_documents(results: DataFrame, summary: DataFrame, batch: Sequence[str] = ("batch_id",),
                     item: str = "item_no") -> DataFrame:
    """JSON lines of each batch: one ``summary`` row, one ``result`` row per item.

    The form is the same for a batch of any size, and no task ever holds a whole batch.
    """
    keys = list(batch)

    def lines(df: DataFrame, kind: str, number) -> DataFrame:
        fields = [c for c in df.columns if c not in keys]
        return df.select(*keys, F.lit(kind).alias("kind"), number.cast("long").alias(item), F.to_json(F.struct(*fields)).alias("document"))

    return lines(summary, "summary", F.lit(None)).unionByName(lines(results, "result", F.col(item)))
