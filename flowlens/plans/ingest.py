"""Sample builds of the known flow datasets: one labelled table from many source files."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.functions import labels, text
from flowlens.operators import harmonise, sampling
from flowlens.session import small, stage
from flowlens.sources import files, positions, units

# The usual row caps and shares of the sample builds, for callers that want them.
IDS2025_FILE_CAP, IDS2025_TOTAL_CAP = 100_000, 600_000
KITSUNE_SCENARIO_CAP, KITSUNE_TOTAL_CAP = 50_000, 500_000
NFUQ_CHUNK, NFUQ_SHARE, NFUQ_TOTAL_CAP = 200_000, 0.05, 1_000_000
LUFLOW_FILE_ROWS, LUFLOW_TOTAL_CAP = 4000, 1_000_000

PAIR = ["_folder", "_pair"]


@dataclass
class Build:
    """A labelled table, the columns its classes come from, and what became of every source unit."""

    table: DataFrame
    source_labels: list[str]
    status: DataFrame

def build_ids2025(spark: SparkSession, root: str, file_cap: int | None = None, total_cap: int | None = None, seed: int = 42,
                  schema: str | None = None, bad_rows: str = "keep") -> Build:
    """All rows of all labelled files, unless the caller sets caps; ``bad_rows`` as in ``units.merge_units``."""
    merged = units.merge_units(spark, root, labels.LABEL_CANDIDATES["ids2025"], fallback="last",
                               normal_tokens=labels.IDS2025_TOKENS, schema=schema, keep_unit=True)
    kept = _fit_rows(merged.table, bad_rows)
    if file_cap is not None:
        kept = sampling.cap_rows(kept, file_cap, group=[units.UNIT], seed=seed)
    if total_cap is not None:
        kept = sampling.cap_total(kept, total_cap, unit=units.UNIT)
    return _built(merged, kept)


def build_luflow(spark: SparkSession, root: str, file_rows: int | None = None, total_cap: int | None = None, seed: int = 42,
                 bad_rows: str = "keep") -> Build:
    """All rows of all files; with ``file_rows`` a class-balanced sample of each larger file. A file is its whole path."""
    merged = units.merge_units(spark, root, labels.LABEL_CANDIDATES["luflow"], passthrough=True,
                               drop=harmonise.LUFLOW_IDENTIFIERS, keep_unit=True)
    kept = _fit_rows(merged.table, bad_rows)
    if file_rows is not None:
        kept = sampling.balanced_quota(kept, "class", [units.UNIT], file_rows, seed=seed)
    if total_cap is not None:
        kept = sampling.cap_total(kept, total_cap, units.UNIT)
    return _built(merged, kept)


def _fit_rows(table: DataFrame, bad_rows: str) -> DataFrame:
    """All rows, or those that fit their header and schema; both are counted in the status."""
    if bad_rows not in units.BAD_ROWS[:2]:
        raise ValueError(f"a build keeps or drops malformed rows, not {bad_rows}")
    return table.filter(~F.col(units.MALFORMED)) if bad_rows == "drop" else table


def _built(merged: units.Merged, kept: DataFrame) -> Build:
    """The table without its unit column; rows of each unit before and after sampling, and malformed ones among the first."""
    read = merged.table.groupBy(F.col(units.UNIT).alias("path")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col(units.MALFORMED)).alias("malformed"))
    left = kept.groupBy(F.col(units.UNIT).alias("path")).agg(F.count(F.lit(1)).alias("kept"))
    counted = [F.coalesce(c, F.lit(0)).alias(c) for c in ("rows", "malformed", "kept")]
    status = merged.status.join(read, "path", "left").join(left, "path", "left").select("path", "status", *counted)
    return Build(harmonise.class_last(kept.drop(units.UNIT, units.MALFORMED)), merged.source_labels, status)


def build_kitsune(spark: SparkSession, root: str, scenario_cap: int | None = None,
                  total_cap: int | None = None, seed: int = 42) -> Build:
    """Feature files joined row by row to their label files; unpaired files are left out and reported.

    All files with one header are read together; the join key is folder, pair and row. The label
    column of the label files comes first in ``source_labels``: it is never a feature.
    """
    headers = units.unit_headers(spark, root)
    pairs = small(files.pair_label_files(headers.select("path")).filter("labels_path is not null"))

    def checked(column: str) -> DataFrame:
        chosen = headers.join(pairs.select(F.col(column).alias("path")), "path", "left_semi")
        return units.label_status(chosen, labels.LABEL_CANDIDATES["kitsune"], "first")

    def located(group: units.UnitGroup, word: str) -> DataFrame:
        rows = harmonise.strip_headers(positions.csv_rows(files.load_csv(spark, group.paths)))
        path = F.col(positions.FILE)
        return rows.withColumns({"_folder": text.folder(path), "_pair": text.pair_key(path, word)}).drop(positions.FILE)

    data_units, label_units = stage(checked("dataset_path"), "units"), stage(checked("labels_path"), "units")
    data = [located(group, "dataset") for group in units.group_units(data_units)]
    if not data:
        raise ValueError(f"no pair of data and label files below {root}")
    features = harmonise.union_by_name(*data)
    parts, names = [], set()
    for group in units.group_units(label_units):
        known = located(group, "labels")
        kind = known.schema[group.label].dataType
        names.add(group.label)
        zipped = positions.zip_rows(features, known, group.label, PAIR)
        parts.append(zipped.withColumn("class", labels.class_of(text.col(group.label), kind, labels.KITSUNE_TOKENS)))
    merged = harmonise.union_by_name(*parts).withColumn("_unit", F.concat_ws("/", *PAIR))
    kept = merged
    if scenario_cap is not None:
        kept = sampling.cap_rows(kept, scenario_cap, ["_unit"], ["_unit", positions.ROW], seed)
    if total_cap is not None:
        kept = sampling.cap_total(kept, total_cap, "_unit")
    scenario = text.file_name(F.col("_folder"))
    table = harmonise.class_last(kept.withColumn("scenario", scenario).drop("_unit", positions.ROW, *PAIR))
    paired = data_units.select("path", "status").union(label_units.select("path", "status"))
    alone = headers.select("path").join(paired, "path", "left_anti").select("path", F.lit("no pair").alias("status"))
    return Build(table, sorted(names), paired.union(alone))


def build_nfuq(spark: SparkSession, path: str, share: float = NFUQ_SHARE, chunk: int = NFUQ_CHUNK,
               total_cap: int | None = None, seed: int = 42) -> Build:
    """The rounded share of every chunk of one large CSV, until ``total_cap`` (if given) is reached.

    The rows of a folder are those of its files in path order. They are counted per file block; from then on every reading knows
    its positions, and nothing is copied. ``status`` has the rows read and kept of every chunk.
    """
    scan = files.load_csv(spark, path)
    last_row = None if total_cap is None else chunk * (math.ceil(total_cap / max(1, round(share * chunk))) + 1)
    rows = harmonise.strip_headers(positions.csv_rows(scan, last_row, whole=True))
    label = labels.detect_label([c for c in rows.columns], labels.LABEL_CANDIDATES["nfuq"])
    rows = rows.withColumn("_chunk", F.floor(F.col(positions.ROW) / chunk)).drop(
        positions.FILE, *harmonise.NFUQ_IDENTIFIERS)
    kept = sampling.fraction_per_unit(rows, share, ["_chunk"], [positions.ROW], seed)
    if total_cap is not None:
        kept = sampling.cap_total(kept, total_cap, "_chunk")
    sizes = [part.groupBy(F.col("_chunk").alias("chunk")).agg(F.count(F.lit(1)).alias(name)) for part, name in ((rows, "rows"), (kept, "kept"))]
    status = sizes[0].join(sizes[1], "chunk", "left").select(
        F.lit(path).alias("path"), "chunk", F.lit("ok").alias("status"), "rows", F.coalesce("kept", F.lit(0)).alias("kept"))
    kept = kept.drop("_chunk", positions.ROW)
    mapped = kept.withColumn("class", labels.class_of(text.col(label), kept.schema[label].dataType, labels.NFUQ_TOKENS))
    return Build(harmonise.class_last(mapped), [label], status)
