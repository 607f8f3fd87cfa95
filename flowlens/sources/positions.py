"""Row positions of files, and joining two files row by row.

Parquet knows the position of a row in its file; a table's rows are those of its files in path order. For CSV the position is the place inside a file block plus
the rows of the earlier blocks of the same file. A ledger of the blocks, counted once without reading a column, gives the positions on every later
reading; the rows themselves are never copied. A reading whose blocks or files are not those of the ledger ends with an error, so that no row gets a wrong place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowlens.session import small, stage

ROW = "row_idx"
FILE = "_file"


def parquet_rows(spark: SparkSession, path: str) -> DataFrame:
    """Parquet rows with their position in the whole table: files follow each other in path order.

    The rows of earlier files come from a count per file; no shuffle of the rows themselves.
    """
    rows = spark.read.parquet(path).select("*", F.col("_metadata.row_index").alias("_place"), F.col("_metadata.file_path").alias(FILE))
    counts = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias(FILE)).agg(F.count(F.lit(1)).alias("_rows"))
    # One row per file, so the window holds counts only.
    earlier = Window.partitionBy(F.lit(0)).orderBy(FILE).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(FILE, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))
    return rows.join(small(starts), FILE).withColumn(ROW, F.col("_place") + F.col("_start")).drop("_place", "_start")


def ledger(scan: DataFrame) -> DataFrame:
    """One row per file block of a bare CSV scan: rows, the number its first row gets, and the state of its file."""
    meta = F.col("_metadata")
    blocks = scan.select(meta["file_path"].alias(FILE), meta["file_block_start"].alias("_block"), meta["file_block_length"].alias("_bytes"),
                         meta["file_modification_time"].alias("_changed"), F.monotonically_increasing_id().alias("_order"))
    return stage(blocks.groupBy(FILE, "_block", "_bytes", "_changed").agg(F.count(F.lit(1)).alias("_rows"), F.min("_order").alias("_first")), "ledger")


def csv_rows(scan: DataFrame, last_row: int | None = None, whole: bool = False, blocks: DataFrame | None = None) -> DataFrame:
    """A bare CSV scan with the position of each row in its file, or in all files in path order (``whole``).

    ``blocks`` is a ledger of the same scan from before. With ``last_row`` only blocks that begin before that row are taken.
    """
    counted = ledger(scan) if blocks is None else blocks
    # One row per block, so a file's window stays small; over all files it holds one row per block as well.
    order = Window.partitionBy(F.lit(0)).orderBy(FILE, "_block") if whole else Window.partitionBy(FILE).orderBy("_block")
    before = F.coalesce(F.sum("_rows").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counted.withColumn("_start", before)
    meta = F.col("_metadata")
    numbered = scan.select("*", meta["file_path"].alias(FILE), meta["file_block_start"].alias("_block"), meta["file_block_length"].alias("_bytes"),
                           meta["file_modification_time"].alias("_changed"), F.monotonically_increasing_id().alias("_order"))
    placed = numbered.join(small(starts), [FILE, "_block", "_bytes", "_changed"], "left")
    inside = F.col("_order") - F.col("_first")
    known = F.coalesce((inside >= 0) & (inside < F.col("_rows")), F.lit(False))
    position = F.when(known, inside + F.col("_start")).otherwise(F.raise_error(F.concat(F.lit("not a block of the ledger: "), F.col(FILE))).cast("long"))
    found = placed.withColumn(ROW, position)
    if last_row is not None:
        found = found.filter((F.col(ROW) >= 0) & (F.col("_start") < last_row))
    return found.drop("_block", "_bytes", "_changed", "_order", "_first", "_rows", "_start")


def zip_rows(features: DataFrame, labels: DataFrame, label: str, keys: list[str] | None = None) -> DataFrame:
    """Rows of both sides with equal position (and pair ``keys``), cut to the shorter side.

    Without ``keys`` the positions must be those of whole tables (``parquet_rows``), not of single files. The
    label column replaces a feature of the same name.
    """
    on = [*(keys or []), ROW]
    return features.drop(label).join(labels.select(*on, label), on)
