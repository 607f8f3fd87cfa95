"""CSV scans, file manifests and label pairing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlens.functions import labels, text

# Fixed value: file name pattern of flow files, any case.
CSV_GLOB = "*.[cC][sS][vV]"


def load_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None,
             *, recursive: bool = False, bad_rows: str = "PERMISSIVE",
             corrupt_column: str | None = None, skip_unreadable: bool = False,
             sampling: float = 1.0) -> DataFrame:
    """CSV with a header row; a byte order mark is dropped, infinities are numbers.

    Give a schema for large inputs: without one Spark reads ``sampling`` of the file first
    to infer the types. ``bad_rows`` says what happens to malformed rows; ``corrupt_column`` is
    added to the schema, if it is not in it, and holds their text. ``skip_unreadable`` passes over
    files that cannot be read.
    """
    if corrupt_column and schema is None:
        schema = load_csv(spark, path, recursive=recursive, skip_unreadable=skip_unreadable, sampling=sampling).schema
    if corrupt_column:
        given = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        schema = given if corrupt_column in given.names else T.StructType([*given.fields, T.StructField(corrupt_column, T.StringType())])
    reader = (spark.read.option("header", True).option("quote", '"').option("escape", '"')
              .option("positiveInf", "inf").option("negativeInf", "-inf")
              .option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True)
              .option("mode", bad_rows).option("ignoreCorruptFiles", skip_unreadable))
    if recursive:
        reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", CSV_GLOB)
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", True).option("samplingRatio", sampling)
    return reader.csv(path)


def head(df: DataFrame, rows: int = 5000) -> DataFrame:
    """First rows for probing; reads as few partitions as it needs."""
    return df.limit(rows)


def with_source(df: DataFrame, file_column: str = "source_file",
                scenario_column: str | None = None) -> DataFrame:
    """Add the file name, and the parent folder as scenario, of each row."""
    path = F.col("_metadata.file_path")
    added = df.select("*", text.file_name(path).alias(file_column),
                      *([text.parent_name(path).alias(scenario_column)] if scenario_column else []))
    return added


def manifest(spark: SparkSession, root: str, pattern: str | None = None) -> DataFrame:
    """Data files below ``root`` with size and time; file contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    files = reader.load(root).select("path", "length", "modificationTime")
    if pattern is None:
        files = files.filter(F.lower("path").rlike(r"\.(csv|parquet)$"))
    return files


def pair_label_files(files: DataFrame, path: str = "path") -> DataFrame:
    """Data files with their label file, by folder and name; ``labels_path`` null = unpaired."""
    location = F.col(path)
    lowered = F.lower(text.file_name(location))
    data = (files.filter(lowered.contains("dataset"))
            .select(location.alias("dataset_path"), text.folder(location).alias("_folder"),
                    text.pair_key(location, "dataset").alias("pair_key")))
    label = (files.filter(lowered.contains("label") & ~lowered.contains("dataset"))
             .select(location.alias("labels_path"), text.folder(location).alias("_folder"),
                     text.pair_key(location, "labels").alias("pair_key")))
    return (data.join(label, ["_folder", "pair_key"], "left")
            .select("dataset_path", "labels_path", "pair_key",
                    text.parent_name(F.col("dataset_path")).alias("scenario")))


def load_calibration(spark: SparkSession, path: str, score: str = "anomaly_score",
                     label: str | None = None) -> DataFrame:
    """Calibration rows as (score, label); an absent label column means all rows normal."""
    raw = spark.read.csv(path, header=True, quote='"', escape='"')
    raw = raw.toDF(*[name.strip() for name in raw.columns])
    if score not in raw.columns:
        raise ValueError(f"calibration file must include '{score}' column")
    if raw.isEmpty():
        raise ValueError("calibration file is empty or has no data rows")
    # The header decides here: the leftmost candidate column wins.
    candidates = [label] if label else list(labels.LABEL_CANDIDATES["calibration"])
    name = next((c for c in raw.columns if c in candidates), None)
    labelled = text.col(name) if name else F.lit(labels.NORMAL)
    return raw.select(text.col(score).try_cast("double").alias("score"), labelled.alias("label"))


def upload_preview(spark: SparkSession, path: str) -> DataFrame:
    """Row count of an uploaded CSV."""
    return spark.read.csv(path, header=True).agg(F.count(F.lit(1)).alias("rows"))
