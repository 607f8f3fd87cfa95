"""Label columns: where they are, and what class a label means."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Class names, label tokens and label column candidates in order of preference.
NORMAL = "normal"
ANOMALY = "anomaly"

IDS2025_TOKENS = ("benign", "normal", "background", "0")
KITSUNE_TOKENS = ("benign", "normal", "0")
NFUQ_TOKENS = ("benign", "normal")
LUFLOW_CLASSES = {"benign": NORMAL, "malicious": ANOMALY, "outlier": ANOMALY}
CALIBRATION_NORMAL = ("normal", "benign")
CALIBRATION_ANOMALY = ("anomaly", "malicious", "outlier", "attack")

LABEL_CANDIDATES = {
    "ids2025": ("label", "Label", "Label_", "class", "Class", "attack", "Attack",
                "Category", "category", "Output", "output", "y", "target"),
    "kitsune": ("label", "Label", "class", "Class", "attack", "Attack",
                "Category", "category", "Output", "output", "y"),
    "nfuq": ("Label", "label", "class", "Class", "Attack", "attack", "Category", "category"),
    "luflow": ("label",),
    "luflow_probe": ("label", "Label", "class", "Class", "attack", "Attack", "target", "Target",
                     "category", "Category", "is_malicious", "malicious", "anomaly", "Anomaly",
                     "type", "Type"),
    "inspect": ("label", "Label", "class", "Class", "attack", "Attack", "attack_type",
                "Attack_type", "category", "Category", "target", "Target", "outcome", "Outcome",
                "intrusion", "Intrusion"),
    "test_inspect": ("class", "Class", "label", "Label", "category", "Category"),
    "calibration": ("class", "label", "target", "ground_truth"),
    "evaluate": ("class", "Class", "label", "Label", "category", "Category"),
}
PREFERRED_TRUTH = ("class", "label", "attack", "target")


def found_labels(columns: Iterable[str], candidates: Sequence[str]) -> list[str]:
    """All candidates present, in candidate order."""
    present = {name.strip() for name in columns}
    return [name for name in candidates if name in present]


def detect_label(columns: Sequence[str], candidates: Sequence[str], fallback: str = "error") -> str:
    """First candidate present; ``fallback`` is ``error``, ``first`` or ``last`` column."""
    found = found_labels(columns, candidates)
    if found:
        return found[0]
    stripped = [name.strip() for name in columns]
    if fallback == "error" or not stripped:
        raise ValueError(f"no label column among {stripped}; tried {list(candidates)}")
    return stripped[0] if fallback == "first" else stripped[-1]


def find_target(columns: Sequence[str], requested: str) -> str | None:
    """The requested target, else the first common alternative, else None."""
    from flowlens.functions.text import header_name

    wanted = [header_name(name) for name in (requested, *LABEL_CANDIDATES["evaluate"])]
    return next((name for name in wanted if name in columns), None)


def label_by_difference(truth_columns: Sequence[str], prediction_columns: Sequence[str],
                        output_columns: Sequence[str] = ("prediction", "anomaly_score")) -> str:
    """The truth column that the predictions lack; well-known names first, else the last."""
    features = [c for c in prediction_columns if c not in output_columns]
    extra = [c for c in truth_columns if c not in features]
    if not extra:
        raise ValueError("truth has no column beyond the prediction features")
    return next((c for c in PREFERRED_TRUTH if c in extra), extra[-1])


def class_of(label: Column, dtype: T.DataType, normal_tokens: Sequence[str] = IDS2025_TOKENS,
             null_label: str | None = None) -> Column:
    """normal/anomaly class of a label column of type ``dtype``.

    Numbers are normal when 0, booleans when false, strings when their trimmed lower-case
    form is a normal token. Missing labels give ``null_label``.
    """
    if isinstance(dtype, T.BooleanType):
        missing, normal = label.isNull(), ~label
    elif isinstance(dtype, T.NumericType):
        missing = label.isNull()
        if isinstance(dtype, (T.DoubleType, T.FloatType)):
            missing = missing | F.isnan(label)
        normal = label == 0
    else:
        missing, normal = label.isNull(), clean_label(label).isin(*normal_tokens)
    return (F.when(missing, F.lit(null_label))
            .when(normal, F.lit(NORMAL))
            .otherwise(F.lit(ANOMALY)))


def class_passthrough(label: Column, classes: dict[str, str] = LUFLOW_CLASSES) -> Column:
    """Lower-case label mapped through ``classes``; unmapped labels pass through unchanged."""
    lowered = F.lower(label.cast("string"))
    mapped = F.lit(None).cast("string")
    for name, target in classes.items():
        mapped = F.when(lowered == name, F.lit(target)).otherwise(mapped)
    return F.coalesce(mapped, lowered)


def class_for_calibration(label: Column, normal: Sequence[str] = CALIBRATION_NORMAL,
                          anomaly: Sequence[str] = CALIBRATION_ANOMALY) -> Column:
    """normal, anomaly, or null for labels that calibration ignores."""
    cleaned = clean_label(label)
    return (F.when(cleaned.isin(*[t.strip().lower() for t in normal]), F.lit(NORMAL))
            .when(cleaned.isin(*[t.strip().lower() for t in anomaly]), F.lit(ANOMALY)))


def clean_label(label: Column) -> Column:
    return F.lower(F.trim(label.cast("string")))


def label_is(label: Column, name: str) -> Column:
    """Case-insensitive label test; a missing label equals nothing."""
    return F.upper(F.trim(F.coalesce(label, F.lit("")))) == name.upper()
