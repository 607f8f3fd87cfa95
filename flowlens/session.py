"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app: str = "flowlens", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings every job here relies on; ``conf`` wins (dots as ``__``)."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
        "spark.ui.showConsoleProgress": "false",
    }
    settings.update({name.replace("__", "."): value for name, value in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    A local temporary folder is made only where the cluster names none and Spark runs in
    local mode (tests, laptops).
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="flowlens-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for this application below the shared scratch folder."""
    return f"{scratch_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the scratch folder and read it back.

    Cuts the lineage in a way that outlives executors and keeps columns prunable.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


SMALL_ROWS = 100_000
SMALL_BYTES = 32 << 20


def _bounded(df: DataFrame, rows: int):
    """``df`` as an Arrow table if it is within the bounds of rows and bytes, else nothing."""
    table = df.limit(rows + 1).toArrow()
    return table if table.num_rows <= rows and table.nbytes <= SMALL_BYTES else None


def small_rows(df: DataFrame, rows: int = SMALL_ROWS) -> tuple[DataFrame, list[dict] | None]:
    """A table of few rows and bytes, computed once and broadcast, together with its rows.

    Its size is checked first: beyond ``rows`` or ``SMALL_BYTES`` it is staged instead, without rows on the
    driver, and Spark joins it like any other table.
    """
    table = _bounded(df, rows)
    if table is None:
        return stage(df, "small"), None
    return F.broadcast(df.sparkSession.createDataFrame(table, df.schema)), table.to_pylist()


def small(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """The table of ``small_rows`` alone."""
    table = _bounded(df, rows)
    return stage(df, "small") if table is None else F.broadcast(df.sparkSession.createDataFrame(table, df.schema))
