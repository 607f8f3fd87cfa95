"""Text, JSON, time and file name expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Export time format and message texts.
UK_TIME = "dd/MM/yyyy, HH:mm:ss"
ALERT_MESSAGE = "Alert created: %s (%s)"
STATUS_MESSAGE = "Alert status updated to: %s"
ANALYSIS_MESSAGE = "Analysis completed: %s (score: %.2f)"
REQUEST_MESSAGE = "Request received - analysing %d item(s)"
SETTINGS_MESSAGE = "Settings updated"


def header_name(name: str) -> str:
    """Trimmed header with every run of white space turned into one underscore."""
    return re.sub(r"\s+", "_", name.strip())


def quoted(name: str) -> str:
    """Column reference for a name that may hold dots or back-ticks."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quoted(name))


def true_text(value: Column) -> Column:
    return F.lower(F.trim(value)) == "true"


def without_quotes(value: Column) -> Column:
    return F.regexp_replace(value, r'^"|"$', "")


def uk_time(value: Column, now: Column | None = None) -> Column:
    """Time as dd/MM/yyyy, HH:mm:ss; unreadable text stays, missing text becomes now."""
    text = value.cast("string")
    moment = F.try_to_timestamp(text)
    current = F.date_format(now if now is not None else F.current_timestamp(), UK_TIME)
    return F.coalesce(F.date_format(moment, UK_TIME), text, current)


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def parent_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -2)


def folder(path: Column) -> Column:
    return F.regexp_replace(path, r"/[^/]*$", "")


def pair_key(path: Column, word: str) -> Column:
    """Lower-case file name without ``_word`` and ``word``: what a data and a label file share."""
    return F.regexp_replace(F.lower(file_name(path)), f"_{word}|{word}", "")


def row_text(columns: Sequence[Column]) -> Column:
    """One string for several columns; missing values keep their place."""
    return F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("\\N")) for c in columns])


def alert_message(label: Column, level: Column) -> Column:
    return F.format_string(ALERT_MESSAGE, label, level)


def status_message(status: Column) -> Column:
    return F.format_string(STATUS_MESSAGE, status)


def analysis_message(label: Column, score: Column) -> Column:
    return F.format_string(ANALYSIS_MESSAGE, label, F.round(score, 2))


def request_message(items: Column) -> Column:
    return F.format_string(REQUEST_MESSAGE, items)


def stable_id(kind: str, *keys: Column) -> Column:
    """Identifier in uuid form that a repeated run reproduces."""
    digest = F.md5(F.concat_ws("|", F.lit(kind), *[k.cast("string") for k in keys]))
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *[F.substring(digest, start, length) for start, length in cuts])
