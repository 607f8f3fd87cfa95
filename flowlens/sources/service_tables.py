"""The four service tables: alerts, logs, settings, analyses.

Parquet has no update in place. Changes are appended as events, and the current state is the
latest event per key, which aggregates map-side and so survives a hot key.

Rows lie in a folder per month of their creation. Storing a batch looks for known ids in the months of its own rows alone, so its cost
does not grow with the history. Rows written under a commit become visible when its name is added to the table of
commits, in all tables at once; what a cut-off run has written is never seen, and ``compact`` removes it.
"""

from __future__ import annotations

import math
import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlens.functions import numeric, text
from flowlens.functions.scores import DEFAULT_THRESHOLD
from flowlens.session import small, small_rows, stage

# Table shapes, states and default settings.
ALERTS = (
    "id string, time timestamp, label string, anomaly_score double, severity string, "
    "action string, status string, features map<string, double>, created_at timestamp")
LOGS = (
    "id string, timestamp timestamp, type string, message string, metadata string, "
    "created_at timestamp")
SETTINGS = "id string, key string, value string, created_at timestamp"
ANALYSES = (
    "id string, input_features map<string, double>, predicted_label string, "
    "anomaly_score double, raw_proba map<string, double>, created_at timestamp")
TABLES = {"alerts": ALERTS, "logs": LOGS, "settings": SETTINGS, "analyses": ANALYSES}
STATUS_NEW = "New"
STATUSES = ("New", "Acknowledged", "Resolved")
DEFAULT_SETTINGS = {
    "anomalyThreshold": str(DEFAULT_THRESHOLD),
    "autoSmartThreshold": "true",
    "autoCreateAlert": "true",
    "apiUrl": '"http://localhost:8000/predict"',
}


COMMITS = "commits"
MOST_MONTHS = 4000
# Rows of a compacted file: some tens of MB.
FILE_ROWS = 200_000
# How rows are filed: by month of creation, under the commit that makes them visible (none: at once).
FILED = "commit string, month date"


def _filed(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.schema(f"{TABLES[name]}, {FILED}").parquet(f"{root}/{name}")


def _visible(rows: DataFrame, root: str) -> DataFrame:
    """Rows without a commit and rows of finished ones."""
    spark = rows.sparkSession
    commit(spark, root, None)
    # One row per stored batch.
    finished = small(spark.read.schema("commit string").parquet(f"{root}/{COMMITS}").filter("commit is not null").distinct())
    return rows.filter("commit is null").unionByName(rows.join(finished, "commit", "left_semi").select(rows.columns))


def commit(spark: SparkSession, root: str, name: str | None) -> None:
    """Make the rows of a commit visible; without a name only the table of commits is there afterwards."""
    rows = [(name,)] if name else []
    spark.createDataFrame(rows, "commit string").coalesce(1).write.mode("append").parquet(f"{root}/{COMMITS}")


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The visible rows of a service table."""
    return _visible(_filed(spark, root, name), root).select(T.StructType.fromDDL(TABLES[name]).names)


def read_database_table(spark: SparkSession, url: str, name: str, properties: dict[str, str],
                        newest: datetime, oldest: datetime, parts: int = 32) -> DataFrame:
    """A service table from a database, read in ``parts`` ranges of its creation time."""
    return spark.read.jdbc(url, name, column="created_at", lowerBound=oldest.isoformat(" "),
                           upperBound=newest.isoformat(" "), numPartitions=parts, properties=properties)


def _month() -> Column:
    return F.to_date(F.date_trunc("month", "created_at"))


def append_table(df: DataFrame, root: str, name: str, under: str | None = None) -> None:
    """Add rows, to be seen at once or when the commit ``under`` is finished."""
    schema = T.StructType.fromDDL(TABLES[name])
    typed = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema], F.lit(under).cast("string").alias("commit"))
    # Few files a month, however many tasks the rows come from; Spark splits a hot month.
    filed = typed.withColumn("month", _month()).hint("rebalance", "month")
    filed.write.partitionBy("month").mode("append").parquet(f"{root}/{name}")


def append_new(df: DataFrame, root: str, name: str, key: str = "id", under: str | None = None) -> None:
    """Append the rows whose key the table does not hold yet.

    A row that is stored again has the creation time it had, so only the months of ``df`` are searched.
    """
    spark = df.sparkSession
    spark.createDataFrame([], f"{TABLES[name]}, {FILED}").write.mode("append").partitionBy("month").parquet(f"{root}/{name}")
    # One row for each month that the batch touches; as constants they keep the other folders from being read.
    table, months = small_rows(df.select(_month().alias("month")).distinct(), MOST_MONTHS)
    near = _filed(spark, root, name)
    if months is None:
        near = near.join(table, near["month"].eqNullSafe(table["month"]), "left_semi")
    else:
        undated = F.col("month").isNull() if any(r["month"] is None for r in months) else F.lit(False)
        near = near.filter(F.col("month").isin([r["month"] for r in months if r["month"]]) | undated)
    append_table(df.join(_visible(near, root).select(key), key, "left_anti"), root, name, under)


def store_together(rows: dict[str, DataFrame], root: str) -> str:
    """Add the new rows of several tables under one commit: all of them are seen afterwards, or none."""
    name = uuid.uuid4().hex
    for table, found in rows.items():
        append_new(found, root, table, under=name)
    commit(next(iter(rows.values())).sparkSession, root, name)
    return name


def compact(spark: SparkSession, root: str, name: str, months: list[str], file_rows: int = FILE_ROWS) -> None:
    """Rewrite the visible rows of some months (each by its first day) into files of about ``file_rows`` rows; rows of unfinished commits go.

    A month gets as many files as its rows need, each written by a task of its own, so no task grows with a month. No writer may be
    at work on these months.
    """
    wanted = [datetime.fromisoformat(month).date() for month in months]
    rows = stage(_visible(_filed(spark, root, name).filter(F.col("month").isin(wanted)), root), "compacted")
    schema = T.StructType.fromDDL(TABLES[name])
    settled = rows.select(*schema.names, F.lit(None).cast("string").alias("commit"), "month")
    # One row per month; its files are numbered after those of the months before it.
    sizes = {r["month"]: r["count"] for r in rows.groupBy("month").count().collect()}
    place, files = F.when(F.col("month").isNull(), 0), 0
    for month, count in sizes.items():
        own = math.ceil(count / file_rows)
        place = place.when(F.col("month") == month, F.lit(files) + F.pmod(F.xxhash64("id"), F.lit(own)).cast("int"))
        files += own
    spread = settled.repartitionById(max(1, files), place)
    spread.write.partitionBy("month").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(f"{root}/{name}")


def clear_table(spark: SparkSession, root: str, name: str) -> None:
    """Empty a service table."""
    spark.createDataFrame([], f"{TABLES[name]}, {FILED}").write.mode("overwrite").partitionBy("month").parquet(f"{root}/{name}")


def current_status(alerts: DataFrame, changes: DataFrame, deleted: DataFrame | None = None) -> DataFrame:
    """Alerts with their latest status; ``changes`` has (id, status, changed_at, seq)."""
    latest = changes.groupBy("id").agg(
        F.max_by("status", F.struct("changed_at", "seq", "status")).alias("_status"))
    merged = (alerts.join(latest, "id", "left")
              .withColumn("status", F.coalesce("_status", "status")).drop("_status"))
    return merged.join(deleted.select("id").distinct(), "id", "left_anti") if deleted is not None else merged


def current_settings(changes: DataFrame, at: str = "created_at", seq: str | None = None) -> DataFrame:
    """Latest value per key of appended settings rows."""
    order = F.struct(at, seq) if seq else F.col(at)
    return changes.groupBy("key").agg(F.max_by("value", order).alias("value"))


def seed_settings(existing: DataFrame, at: Column | None = None) -> DataFrame:
    """Default settings rows whose key is not there yet."""
    spark = existing.sparkSession
    rows = [(key, value) for key, value in DEFAULT_SETTINGS.items()]
    defaults = spark.createDataFrame(rows, "key string, value string")
    missing = defaults.join(existing.select("key").distinct(), "key", "left_anti")
    return missing.select(text.stable_id("setting", F.col("key")).alias("id"), "key", "value",
                          (at if at is not None else F.current_timestamp()).alias("created_at"))


def settings_changes(updates: dict[str, object], spark: SparkSession, at: datetime) -> DataFrame:
    """Rows that set each key; text, numbers and booleans as text, the rest as JSON."""
    import json

    def shown(value: object) -> str:
        if isinstance(value, bool):
            return str(value).lower()
        return str(value) if isinstance(value, (str, int, float)) else json.dumps(value)

    rows = [(key, shown(value), at) for key, value in updates.items()]
    changed = spark.createDataFrame(rows, "key string, value string, created_at timestamp")
    return changed.select(text.stable_id("setting", F.col("key"), F.col("created_at")).alias("id"),
                          "key", "value", "created_at")


def calibrated_changes(calibrated: DataFrame, spark: SparkSession, at: datetime) -> DataFrame:
    """Settings rows that make a calibrated threshold the fixed one; without normal rows there is none to save."""
    found = calibrated.first()
    if not found["sample_count"]:
        raise ValueError("no normal rows found in the calibration data")
    return settings_changes({"anomalyThreshold": found["threshold"], "autoSmartThreshold": False}, spark, at)


def settings_logs(changes: DataFrame) -> DataFrame:
    """One log row per settings update; the rows of an update share their time."""
    updates = changes.groupBy("created_at").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", "value")))).alias("values"))
    return log_rows(updates, "settings", F.lit(text.SETTINGS_MESSAGE), F.to_json("values"), F.col("created_at"), F.col("created_at"))


def effective_settings(current: DataFrame) -> DataFrame:
    """One row of typed settings: stored values over defaults."""
    def stored(key: str) -> Column:
        return F.max(F.when(F.col("key") == key, F.col("value")))

    def flag(key: str) -> Column:
        return text.true_text(F.coalesce(stored(key), F.lit(DEFAULT_SETTINGS[key])))

    return current.agg(
        numeric.number_or(stored("anomalyThreshold"), DEFAULT_THRESHOLD).alias("anomaly_threshold"),
        flag("autoCreateAlert").alias("auto_create_alert"),
        flag("autoSmartThreshold").alias("auto_smart_threshold"),
        text.without_quotes(F.coalesce(stored("apiUrl"), F.lit(DEFAULT_SETTINGS["apiUrl"]))).alias("api_url"))


def log_rows(source: DataFrame, kind: str, message: Column, metadata: Column, at: Column,
             *keys: Column) -> DataFrame:
    """Log rows for ``source``; the id is derived from the kind and the keys."""
    return source.select(text.stable_id(f"log-{kind}", *keys).alias("id"), at.alias("timestamp"),
                         F.lit(kind).alias("type"), message.alias("message"),
                         metadata.alias("metadata"), at.alias("created_at"))


def linked_logs(logs: DataFrame, target: DataFrame, field: str) -> DataFrame:
    """Log rows with the alert or analysis that their metadata names in ``field``."""
    keyed = logs.select(F.col("id").alias("log_id"), "type", "message",
                        F.get_json_object("metadata", f"$.{field}").alias("id"))
    return keyed.filter(F.col("id").isNotNull()).join(target, "id")
