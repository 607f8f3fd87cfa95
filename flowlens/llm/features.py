"""Hashed word and character n-grams, bounded samples of labelled rows, and linear models over them."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm import batches

BUCKET_BITS = 15
BUCKETS = 1 << BUCKET_BITS
CHARACTER_ORDERS = (2, 4)
FAMILIES = 2 + len(CHARACTER_ORDERS)
# Frequencies are small numbers; the scale lets weights stay near one.
SCALE = 20.0
# Bucket key of a word followed by itself, whichever word it is.
_AGAIN = np.uint64(0x5851F42D4C957F2D)


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def families(chunk: batches.Chunk):
    """Per family: the buckets of all its n-grams in order, and where each text's n-grams begin and end."""
    words, edges = batches.words(chunk)
    yield _bucket(words), edges[:-1], edges[1:]
    pairs = batches.grams(words, 2)
    if len(pairs):
        pairs[words[1:] == words[:-1]] = _AGAIN
    yield _bucket(pairs), edges[:-1], np.maximum(edges[1:] - 1, edges[:-1])
    points = np.frombuffer(chunk.data.tobytes().decode().encode("utf-32-le"), np.uint32).astype(np.uint64)
    starts = np.concatenate(([0], np.cumsum(batches.STARTS_POINT[chunk.data])))[chunk.edges]
    for order in CHARACTER_ORDERS:
        buckets = _bucket(batches.grams(points + np.uint64(order << 32), order))
        yield buckets, starts[:-1], np.maximum(starts[1:] - order, starts[:-1])


@dataclass
class Linear:
    """Score of a text: bias plus, for each family, the mean weight of its n-grams; then a calibrated probability."""

    weights: np.ndarray  # families x buckets
    bias: float = 0.0
    slope: float = 1.0
    shift: float = 0.0

    def margins(self, chunk: batches.Chunk) -> np.ndarray:
        total = np.full(len(chunk), self.bias)
        for weights, (buckets, starts, ends) in zip(self.weights, families(chunk)):
            running = np.concatenate(([0.0], np.cumsum(weights[buckets], dtype=np.float64)))
            ends = np.minimum(ends, len(buckets))
            starts = np.minimum(starts, ends)
            total += SCALE * (running[ends] - running[starts]) / np.maximum(ends - starts, 1)
        return total

    def probability(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.shift, -500, 500)))


def _sparse(parts):
    """Each row's n-gram frequencies as index and value bytes."""
    for batch in parts:
        rows = []
        for chunk in batches.chunks(batch.column("text")):
            own = [[] for _ in range(len(chunk))]
            for family, (buckets, starts, ends) in enumerate(families(chunk)):
                for k, (start, end) in enumerate(zip(starts, np.minimum(ends, len(buckets)))):
                    if end > start:
                        index, count = np.unique(buckets[start:end], return_counts=True)
                        own[k].append((index + family * BUCKETS, count * (SCALE / (end - start))))
            rows += own
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("label"),
             pa.array([b"".join([i.astype("<i4").tobytes() for i, _ in r]) for r in rows], pa.binary()),
             pa.array([b"".join([v.astype("<f4").tobytes() for _, v in r]) for r in rows], pa.binary())],
            ["doc_id", "label", "index", "value"])


@dataclass
class Sample:
    """A bounded sample as a sparse matrix by rows."""

    labels: np.ndarray
    index: np.ndarray
    value: np.ndarray
    edges: np.ndarray

    @classmethod
    def gather(cls, picked: DataFrame, docs: DataFrame) -> Sample:
        """Features of the documents in ``picked`` (``doc_id``, ``label``; bounded by its maker), in order of ``doc_id``."""
        texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        rows = texts.join(F.broadcast(picked), "doc_id").select("doc_id", "label", "text")
        table = rows.mapInArrow(_sparse, "doc_id long, label int, index binary, value binary").toArrow().sort_by("doc_id")
        labels = table.column("label").to_numpy().astype(np.int64)
        sizes = np.array([len(b.as_buffer()) // 4 if b.is_valid else 0 for b in table.column("index")], np.int64)
        index, value = (np.concatenate([np.frombuffer(b.as_buffer(), kind) for b in table.column(name)] or [np.zeros(0, kind)])
                        for name, kind in (("index", "<i4"), ("value", "<f4")))
        return cls(labels, index, value, np.concatenate(([0], np.cumsum(sizes))))

    def __len__(self) -> int:
        return len(self.labels)

    def _blocks(self):
        """Ranges of rows with about a million values, so that intermediate arrays stay small."""
        first = 0
        while first < len(self):
            last = max(first + 1, int(np.searchsorted(self.edges, self.edges[first] + 1_000_000, "right")) - 1)
            yield first, last, slice(self.edges[first], self.edges[last])
            first = last

    def margins(self, weights: np.ndarray, bias: float) -> np.ndarray:
        out = np.full(len(self), bias)
        for first, last, own in self._blocks():
            running = np.concatenate(([0.0], np.cumsum(self.value[own] * weights[self.index[own]])))
            at = self.edges[first : last + 1] - self.edges[first]
            out[first:last] += running[at[1:]] - running[at[:-1]]
        return out

    def gradient(self, slopes: np.ndarray, size: int) -> np.ndarray:
        out = np.zeros(size)
        for first, last, own in self._blocks():
            each = np.repeat(slopes[first:last], np.diff(self.edges[first : last + 1]))
            out += np.bincount(self.index[own], self.value[own] * each, minlength=size)
        return out

    def part(self, keep: np.ndarray) -> Sample:
        own = np.repeat(keep, np.diff(self.edges))
        sizes = np.diff(self.edges)[keep]
        return Sample(self.labels[keep], self.index[own], self.value[own], np.concatenate(([0], np.cumsum(sizes))))


def descend(sample: Sample, slopes_of, steps: int = 80, rate: float = 0.05, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Adam over the whole sample; ``slopes_of`` gives the loss's slope at every row's margin."""
    size = FAMILIES * BUCKETS
    w, m, v = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, steps + 1):
        slopes = slopes_of(sample.margins(w[:-1], w[-1]))
        g = np.append(sample.gradient(slopes, size), slopes.sum())
        g[:-1] += decay * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w[:-1], float(w[-1])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def platt(margins: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve through held-back margins, by Newton steps with softened targets."""
    up, down = weights[labels == 1].sum(), weights[labels == 0].sum()
    if up == 0 or down == 0:
        return 1.0, 0.0
    target = np.where(labels == 1, (up + 1) / (up + 2), 1 / (down + 2))
    scale = max(1e-9, float(np.abs(margins).mean()))
    x = np.column_stack([margins / scale, np.ones(len(margins))])
    at = np.array([1.0, 0.0])

    def loss(a):
        z = np.clip(x @ a, -500, 500)
        return float((weights * (np.logaddexp(0, z) - target * z)).sum())

    for _ in range(50):
        p = sigmoid(x @ at)
        g = x.T @ (weights * (p - target))
        h = (x * (weights * p * (1 - p))[:, None]).T @ x + 1e-9 * np.eye(2)
        step, size, now = np.linalg.solve(h, g), 1.0, loss(at)
        while size > 1e-4 and loss(at - size * step) > now:
            size /= 2
        at = at - size * step
        if np.abs(size * step).max() < 1e-7:
            break
    return float(at[0] / scale), float(at[1])


def fold(doc_id: Column, count: int) -> Column:
    """crc32 of the id written as text, modulo the number of folds; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % count


def labelled(labels: DataFrame, name: str) -> DataFrame:
    """``doc_id``, ``label`` of the rows with both; of several rows of one document the greatest label counts."""
    return (labels.filter(F.col("doc_id").isNotNull() & F.col(name).isin(0, 1))
            .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(name).cast("int").alias("label")))


def first_by_hash(rows: DataFrame, bound: int) -> DataFrame:
    """At most ``bound`` rows, those with the least hash of their ``doc_id``."""
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
