"""Quality rules: base counts of every text, and a logistic regression over hashed word and character n-grams.

The model is trained on labelled quality rows and its probability is calibrated on rows held back from
the training. A text is kept if no base rule fails and its probability of label 1 reaches ``KEEP``.

A word is a run of non-blanks (20, 09-0D). A null or empty text has no words and fails. Without labelled rows
of both kinds the base rules decide alone. Rows are independent; repeated rows and null ids are judged like any other.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm import batches, features

LEAST_WORDS = 50
MOST_REPEATED = 50  # per cent of the words
KEEP = 0.5
# The classifier is fitted on at most so many rows of each label.
SAMPLE = 1000
HELD_BACK = 5

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


def base_counts(chunk: batches.Chunk) -> dict[str, np.ndarray]:
    """``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words`` of each text."""
    data, edges = chunk.data, chunk.edges
    words, at = batches.words(chunk)
    blank = batches.BLANK[data]
    own = np.append(edges[1:] - 1, 0)[:-1]  # ends of texts, before the line feed that closes each
    points = np.concatenate(([0], np.cumsum(batches.STARTS_POINT[data] & ~blank)))
    symbols = np.concatenate(([0], np.cumsum(_SYMBOL[data])))
    return {"n_words": np.diff(at), "word_chars": points[own] - points[edges[:-1]], "n_symbols": symbols[own] - symbols[edges[:-1]],
            "n_dup_lines": _duplicate_lines(chunk, blank), "n_repeat_words": _repeated_words(words, at)}


def _duplicate_lines(chunk: batches.Chunk, blank: np.ndarray) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text."""
    feeds = np.flatnonzero(chunk.data == 0x0A)
    starts = np.concatenate(([0], feeds[:-1] + 1))
    filled = np.concatenate(([0], np.cumsum(~blank)))
    worded = filled[feeds] > filled[starts]
    text = np.searchsorted(chunk.edges[1:], feeds, "right")
    hashes = batches.span_hashes(chunk.data, starts, feeds)
    # The length beside the hash; the text's number keeps texts apart.
    seen = pd.DataFrame({"text": text[worded], "hash": hashes[worded], "size": (feeds - starts)[worded]})
    return np.bincount(seen["text"][seen.duplicated()], minlength=len(chunk))


def _repeated_words(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Words inside a three-word window that its text has twice or more, the first one included."""
    windows = batches.grams(words, 3)
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    inside = text[:len(windows)] == text[2:] if len(windows) else np.zeros(0, bool)
    place = np.flatnonzero(inside)
    seen = pd.DataFrame({"text": text[place], "window": windows[place]})
    place = place[seen.duplicated(keep=False).to_numpy()]
    marked = np.zeros(len(words), bool)
    for k in range(3):
        marked[place + k] = True
    return batches.sums(marked.astype(np.int64), at)


def fit(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> features.Linear | None:
    """Model of label 1, from at most ``bound`` rows of either label; none if a label has no row."""
    own = features.labelled(labels, "quality")
    known = own.groupBy("label").count().collect()
    total = {r["label"]: r["count"] for r in known}
    picked = features.first_by_hash(own.filter("label = 1"), bound).union(features.first_by_hash(own.filter("label = 0"), bound))
    sample = features.Sample.gather(picked, docs)
    if len(np.unique(sample.labels)) < 2:
        return None
    back = np.arange(len(sample)) % HELD_BACK == 0
    train, held = sample.part(~back), sample.part(back)
    if len(np.unique(train.labels)) < 2:
        train = sample
    del sample
    share = 0.5 / np.bincount(train.labels, minlength=2)
    weight = share[train.labels]
    weights, bias = features.descend(train, lambda margins: weight * (features.sigmoid(margins) - train.labels))
    # Held-back rows count as often as their label occurs among all labelled rows.
    rate = np.array([total.get(k, 0) / max(1, (held.labels == k).sum()) for k in (0, 1)])
    slope, shift = features.platt(held.margins(weights, bias), held.labels, rate[held.labels] * len(held) / max(1, sum(total.values())))
    return features.Linear(weights.reshape(features.FAMILIES, -1).astype(np.float32), bias, slope, shift)


def _judge(model: features.Linear | None, keep: float):
    def run(parts):
        for batch in parts:
            ids = batch.column("doc_id")
            for chunk in batches.chunks(batch.column("text")):
                found = base_counts(chunk)
                score = model.probability(model.margins(chunk)) if model else np.ones(len(chunk))
                failed = (found["n_words"] < LEAST_WORDS) | (100 * found["n_repeat_words"] > MOST_REPEATED * found["n_words"])
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(chunk.first, len(chunk)), *(pa.array(found[c].astype(np.int64)) for c in COUNTS), pa.array(failed),
                     pa.array(~failed & (score >= keep)), pa.array(score)],
                    ["doc_id", *COUNTS, "base_failed", "kept", "score"])
    return run


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RESULT = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, kept boolean, score double"


def judge(docs: DataFrame, labels: DataFrame, keep: float = KEEP) -> DataFrame:
    """``doc_id``, the base counts, ``base_failed``, ``kept`` and ``score`` of every row of ``docs``."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(_judge(fit(docs, labels), keep), RESULT)


def keep_good(docs: DataFrame, labels: DataFrame, keep: float = KEEP) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns."""
    return filter_texts(docs, _judge(fit(docs, labels), keep), "kept")


def filter_texts(docs: DataFrame, judge, flag: str) -> DataFrame:
    """Rows whose flag the batch function ``judge`` sets; one pass, no join, no shuffle."""
    def run(parts):
        for batch in parts:
            asked = pa.RecordBatch.from_arrays([pa.nulls(batch.num_rows, pa.int64()), batch.column(names.index("text"))], ["doc_id", "text"])
            flags = pa.concat_arrays([b.column(flag) for b in judge([asked])] or [pa.array([], pa.bool_())])
            yield batch.filter(flags)

    names = docs.columns
    return docs.mapInArrow(run, docs.schema)
