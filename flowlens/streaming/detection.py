"""Streams of scored flows, alerts, windowed counts and adaptive thresholds."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from flowlens.functions import labels, scores, text
from flowlens.functions.scores import DEFAULT_THRESHOLD
from flowlens.operators import threshold
from flowlens.plans import analysis


# A batch reads the table of the one before it and writes its own; the third is for looking back.
KEPT_EPOCHS = 3


def file_stream(spark: SparkSession, folder: str, schema: T.StructType, pattern: str | None = None,
                files_per_batch: int | None = None) -> DataFrame:
    """New parquet files of a folder, or one file, as a stream.

    The path is given as a pattern that only it matches: Spark then takes a single file as well.
    """
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    path = folder.rstrip("/")
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


def score_stream(flows: DataFrame, score: Callable[[DataFrame], DataFrame], limit: Column | float = DEFAULT_THRESHOLD) -> DataFrame:
    """Scored and judged flows; ``score`` is a projection or a fitted model's transform."""
    return analysis.judge(score(flows), limit)


def alert_stream(judged: DataFrame, key: str, at: str) -> DataFrame:
    """Alert rows of judged flows; stateless, ids derive from the flow key."""
    return judged.filter(F.col("predicted_label") == scores.LABEL_ANOMALY).select(
        text.stable_id("alert", F.col(key)).alias("id"), F.col(key), F.col(at).alias("time"),
        F.col("predicted_label").alias("label"), "anomaly_score", "severity", "action",
        F.lit("New").alias("status"))


def status_stream(alerts: DataFrame, changes: DataFrame, key: str = "id", time: str = "time", changed: str = "changed_at",
                  horizon: str = "30 days", lateness: str = "1 hour") -> DataFrame:
    """Status changes (``key``, ``status``, ``changed``, ``seq``) of alerts, as both arrive.

    A change is joined to its alert if it is not earlier and at most ``horizon`` later; so each side waits for the other no longer than
    that plus ``lateness``, and what is kept between batches does not grow with the history. ``service_tables.current_status`` turns
    the alerts and these changes into the latest status.
    """
    known = alerts.select(F.col(key), F.col(time).cast("timestamp").alias("_time")).withWatermark("_time", lateness)
    moved = changes.select(F.col(key).alias("_key"), "status", changed, "seq", F.col(changed).cast("timestamp").alias("_changed")).withWatermark("_changed", lateness)
    near = (F.col("_changed") >= F.col("_time")) & (F.col("_changed") <= F.col("_time") + F.expr(f"INTERVAL {horizon}"))
    return known.join(moved, (F.col(key) == F.col("_key")) & near).select(key, "status", changed, "seq")


def window_stats(judged: DataFrame, at: str, length: str = "1 day", lateness: str = "1 hour") -> DataFrame:
    """Counts per closed event-time window; rows later than the watermark are dropped."""
    timed = judged.withColumn("_at", F.col(at).cast("timestamp")).withWatermark("_at", lateness)
    return timed.groupBy(F.window("_at", length)).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(labels.label_is(F.col("predicted_label"), scores.LABEL_ANOMALY)).alias("anomalies"),
        F.count_if(labels.label_is(F.col("predicted_label"), scores.LABEL_NORMAL)).alias("normal"),
    ).select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
             "total", "anomalies", "normal")


def to_parquet(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append a stream to a parquet folder exactly once, until the source is exhausted."""
    return (stream.writeStream.format("parquet").outputMode("append").option("path", path)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def to_batches(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write each micro-batch to its own folder; a repeated batch replaces itself."""
    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    return (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What ``foreachBatch`` wrote below ``path``; no rows where nothing was written."""
    marked = T.StructType([*schema.fields, T.StructField("epoch", T.LongType())])
    spark.createDataFrame([], schema).write.mode("append").parquet(f"{path}/epoch=-1")
    return spark.read.schema(marked).parquet(path).drop("epoch")


def adaptive_schema(scored: DataFrame) -> T.StructType:
    """Columns of the analyses an adaptive stream writes."""
    return analysis.judge(scored, F.lit(0.0)).withColumn("threshold", F.lit(0.0)).schema


def adaptive_stream(scored: DataFrame, path: str, checkpoint: str, at: str, key: str,
                    n: int = threshold.RECENT_SCORES, fallback: float = DEFAULT_THRESHOLD) -> StreamingQuery:
    """Judge each micro-batch by the smart threshold of the latest n scores before it.

    The latest n scores are carried from batch to batch as a small table, so the work of a
    batch does not grow with the history. The tables of ``KEPT_EPOCHS`` batches are kept in turn, however many there are; one that
    is not of the batch before ends the stream. Every write replaces itself when repeated.
    """
    schema = scored.schema
    kept = T.StructType([schema[key], schema[at], schema["anomaly_score"]])
    marked = T.StructType([*kept.fields, T.StructField("epoch", T.LongType())])

    def slot(epoch: int) -> str:
        return f"{path}/recent/slot={epoch % KEPT_EPOCHS}"

    def before(spark: SparkSession, epoch: int) -> DataFrame:
        if not epoch:
            return spark.createDataFrame([], kept)
        found = spark.read.schema(marked).parquet(slot(epoch - 1))
        if not found.filter(F.col("epoch") != epoch - 1).isEmpty():
            raise ValueError(f"the scores before batch {epoch} are not there any more")
        return found.select(kept.names)

    def step(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        recent = before(spark, epoch)
        limit = threshold.smart_threshold(recent, fallback=fallback).first()["threshold"]
        written = f"{path}/analyses/epoch={epoch}"
        judged = analysis.judge(batch, F.lit(limit)).withColumn("threshold", F.lit(limit))
        judged.write.mode("overwrite").parquet(written)
        # The latest scores are read from what was written, so the batch is scored once.
        latest = threshold.recent(recent.unionByName(spark.read.schema(kept).parquet(written)), n, at, key)
        latest.withColumn("epoch", F.lit(epoch).cast("long")).coalesce(1).write.mode("overwrite").parquet(slot(epoch))

    return (scored.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
