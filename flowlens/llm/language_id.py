"""Language identification in two steps: the language's family, then the language within it.

A text's features are frequencies of hashed words and of its 2- to 4-byte strings, letters only, ASCII letters
in lower case; everything else is one blank. Linear support vector machines (squared hinge) judge them: one per family against the rest
first (one for both if there are two), then, for the closely related languages of the family chosen, one per pair of them; the language with
most pairs wins, ties by the sum of margins. Margins become probabilities by logistic curves fitted on texts held back, and a text's score is
the probability of its family times that of its language among the family's pairs.

``FAMILIES`` names the families of common languages; a language it does not name is a family of its own. The fit sees at most
``SAMPLE`` distinct texts, dealt evenly over the languages, each with its ``MOST_FEATURES`` most frequent features; every text is judged whole. Only
documents with an id outside the held-out fold, a text and a language are learned from. A null text or one without a
letter is ``und`` with score 0, and so is every text if nothing was learned. With one language learned all others are that one, score 1.
A null id is not held out and not learned from. Repeated rows are judged like any other; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm import batches, features

FOLDS, HELD_OUT = 4, 2
SAMPLE = 3000
MOST_FEATURES = 1000
BITS = 15
BUCKETS = 1 << BITS
ORDERS = (2, 3, 4)
KINDS = 1 + len(ORDERS)
SCALE = 20.0
STEPS = 40
NONE = "und"
# Languages of a family, by ISO 639 code.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is fy af lb yi", "romance": "fr es it pt ro ca gl oc la", "slavic": "ru uk be pl cs sk bg sr hr bs sl mk",
    "baltic": "lt lv", "celtic": "ga gd cy br", "indic": "hi ur bn pa gu mr ne si", "iranian": "fa ku ps tg", "uralic": "fi et hu",
    "turkic": "tr az kk ky uz tk tt", "semitic": "ar he am mt", "dravidian": "ta te kn ml", "malayic": "id ms jv su", "sinitic": "zh yue wuu"}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}
# Letters and bytes of longer code points; every other byte is read as a blank.
_READ = np.where((np.arange(256) >= 0x80) | ((batches.LOWER >= 97) & (batches.LOWER <= 122)), batches.LOWER, 32).astype(np.uint8)


def family_of(lang: str) -> str:
    """The family of a language code such as ``de`` or ``pt-BR``; the code itself where none is known."""
    return _FAMILY.get(lang.lower().replace("_", "-").split("-")[0], lang)


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - BITS)).astype(np.int32)


def kinds(data: np.ndarray, edges: np.ndarray):
    """Per kind of feature: buckets in order, and where each text's begin and end. ``data`` is text behind text, one byte between."""
    read = _READ[data]
    starts, ends = batches.spans(read != 32)
    words = _bucket(batches.span_hashes(read, starts, ends))
    at = np.searchsorted(starts, edges)
    yield words, at[:-1], at[1:]
    blank = read == 32
    # Runs of blanks say nothing: a string may not hold two in a row.
    pair = np.zeros(len(read), bool)
    pair[:-1] = blank[:-1] & blank[1:]
    code = read.astype(np.uint64)
    for order in ORDERS:
        count = max(0, len(read) - order + 1)
        value = np.full(count, order, np.uint64)
        bad = np.zeros(count, bool)
        for k in range(order):
            value = (value << np.uint64(8)) | code[k : k + count]
            if k < order - 1:
                bad |= pair[k : k + count]
        kept = np.flatnonzero(~bad)
        first = np.searchsorted(kept, edges[:-1])
        yield _bucket(batches.mix(value[kept])), first, np.maximum(first, np.searchsorted(kept, edges[1:] - order))


def _pieces(chunk: batches.Chunk):
    """A chunk with texts of any length in pieces of about ``CHUNK_BYTES``: bytes, edges, and the texts of each piece."""
    if len(chunk.data) <= 2 * batches.CHUNK_BYTES:
        yield chunk.data, chunk.edges, np.arange(len(chunk))
        return
    for k in range(len(chunk)):
        at, stop = int(chunk.edges[k]), int(chunk.edges[k + 1])
        while at < stop:
            end = min(stop, at + batches.CHUNK_BYTES)
            if end < stop:  # back to a blank, so that no word is cut
                blanks = np.flatnonzero(_READ[chunk.data[at:end]] == 32)
                end = at + int(blanks[-1]) + 1 if len(blanks) else end
            yield chunk.data[at:end], np.array([0, end - at]), np.array([k])
            at = end


@dataclass
class Machines:
    """Linear machines side by side: weights kinds x buckets x machines, and the logistic curve of each margin."""

    weights: np.ndarray
    bias: np.ndarray
    slope: np.ndarray
    shift: np.ndarray

    def margins(self, chunk: batches.Chunk) -> np.ndarray:
        """Texts x machines: bias plus, for each kind, the mean weight of the text's features."""
        total = np.zeros((KINDS, len(chunk), len(self.bias)))
        count = np.zeros((KINDS, len(chunk)))
        for data, edges, texts in _pieces(chunk):
            for kind, (buckets, starts, ends) in enumerate(kinds(data, edges)):
                count[kind, texts] += ends - starts
                for m in range(len(self.bias)):
                    running = np.concatenate(([0.0], np.cumsum(self.weights[kind, m][buckets], dtype=np.float64)))
                    total[kind, texts, m] += running[ends] - running[starts]
        return self.bias + SCALE * (total / np.maximum(count, 1)[:, :, None]).sum(0)

    def odds(self, margins: np.ndarray) -> np.ndarray:
        return features.sigmoid(self.slope * margins + self.shift)


@dataclass
class Model:
    """Families with their languages; one machine per family, then one per pair of languages of a family."""

    families: list[list[str]]
    pairs: list[tuple[int, int, int]]  # family, and the two places of its languages
    machines: Machines

    @property
    def own(self) -> int:
        """Machines that judge families."""
        return {1: 0, 2: 1}.get(len(self.families), len(self.families))

    def judge(self, chunk: batches.Chunk) -> tuple[np.ndarray, np.ndarray]:
        """Language and score of every text of a chunk."""
        margins = self.machines.margins(chunk)
        odds = self.machines.odds(margins)
        languages, scores = np.empty(len(chunk), object), np.zeros(len(chunk))
        if self.own:
            sides, likely = margins[:, : self.own], odds[:, : self.own]
            if self.own == 1:  # of two families one machine tells both
                sides, likely = np.hstack([sides, -sides]), np.hstack([likely, 1 - likely])
            family = sides.argmax(1)
            sure = likely[np.arange(len(chunk)), family] / np.maximum(likely.sum(1), 1e-300)
        else:
            family, sure = np.zeros(len(chunk), int), np.ones(len(chunk))
        for f, names in enumerate(self.families):
            rows = np.flatnonzero(family == f)
            votes, sums, near = np.zeros((len(rows), len(names))), np.zeros((len(rows), len(names))), np.zeros((len(rows), len(names)))
            for k, (of, a, b) in enumerate(self.pairs):
                if of == f:
                    m, p = margins[rows, self.own + k], odds[rows, self.own + k]
                    votes[:, a] += m >= 0
                    votes[:, b] += m < 0
                    sums[:, a] += m
                    sums[:, b] -= m
                    near[:, a] += p
                    near[:, b] += 1 - p
            best = np.lexsort((sums.T, votes.T), axis=0)[-1] if len(rows) else np.zeros(0, int)
            languages[rows] = np.array(names, object)[best]
            scores[rows] = sure[rows] * (near[np.arange(len(rows)), best] / (len(names) - 1) if len(names) > 1 else 1)
        return languages, np.clip(scores, 0, 1)


def _most_frequent(found: list[list[np.ndarray]]) -> tuple[bytes, bytes]:
    """A text's greatest frequencies, from each kind's buckets or, for long pieces, their counts."""
    index, value = [], []
    for kind, parts in enumerate(found):
        total = np.zeros(BUCKETS, np.int64)
        for part in parts:
            total += part if len(part) == BUCKETS and part.dtype == np.int64 else np.bincount(part, minlength=BUCKETS)
        there = np.flatnonzero(total)
        index.append(there + kind * BUCKETS)
        value.append(total[there] * (SCALE / max(total.sum(), 1)))
    index, value = np.concatenate(index), np.concatenate(value)
    first = np.lexsort((index, -value))[:MOST_FEATURES]
    return index[first].astype("<i4").tobytes(), value[first].astype("<f4").tobytes()


def _rows(parts):
    """Sparse features of sample texts, the most frequent of each."""
    for batch in parts:
        out = []
        for chunk in batches.chunks(batch.column("text")):
            found = [[[] for _ in range(KINDS)] for _ in range(len(chunk))]
            for data, edges, texts in _pieces(chunk):
                for kind, (buckets, starts, ends) in enumerate(kinds(data, edges)):
                    for text, start, end in zip(texts, starts, ends):
                        found[text][kind].append(np.bincount(buckets[start:end], minlength=BUCKETS) if end - start > BUCKETS else buckets[start:end])
            out += [_most_frequent(own) for own in found]
        yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("hash"), pa.array([i for i, _ in out], pa.binary()),
                                          pa.array([v for _, v in out], pa.binary())], ["lang", "hash", "index", "value"])


def sample_of(docs: DataFrame, sample: int = SAMPLE) -> tuple[list[str], features.Sample]:
    """The learned languages, and features of about ``sample`` distinct texts with the place of their language, in order of a hash."""
    learned = docs.filter((features.fold(F.col("doc_id"), FOLDS) != HELD_OUT) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    # Distinct texts are counted: copies of one would leave little room for a language's others.
    sizes = {r["lang"]: max(1, r["n"]) for r in learned.groupBy("lang").agg(F.approx_count_distinct(F.xxhash64("text")).alias("n")).collect()}
    names = sorted(sizes)
    if not names:
        return names, features.Sample(np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.float32), np.zeros(1, np.int64))
    # A text's hash decides whether it is taken, so copies are taken once or not at all.
    place = F.shiftrightunsigned(F.xxhash64("text"), 11) / float(1 << 53)
    share = F.element_at(F.create_map(*[F.lit(x) for name in names for x in (name, sample / len(names) / sizes[name])]), F.col("lang"))
    taken = learned.withColumn("hash", F.xxhash64("text")).filter(place < share).groupBy("lang", "hash").agg(F.min("text").alias("text"))
    table = taken.mapInArrow(_rows, "lang string, hash long, index binary, value binary").orderBy("hash", "lang").limit(2 * sample).toArrow()
    labels = np.array([names.index(lang) for lang in table.column("lang").to_pylist()], np.int64)
    widths = np.array([len(b.as_buffer()) // 4 for b in table.column("index")], np.int64)
    index, value = (np.concatenate([np.frombuffer(b.as_buffer(), kind) for b in table.column(c)] or [np.zeros(0, kind)])
                    for c, kind in (("index", "<i4"), ("value", "<f4")))
    return names, features.Sample(labels, index, value, np.concatenate(([0], np.cumsum(widths))))


def machine(sample: features.Sample, positive: np.ndarray, steps: int = STEPS, rate: float = 0.1, ridge: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias of a squared-hinge machine, both sides weighing alike; Adam over the whole sample."""
    sign = np.where(positive, 1.0, -1.0)
    told = 0.5 / np.maximum(np.where(positive, positive.sum(), (~positive).sum()), 1)
    size = KINDS * BUCKETS
    w, m, v = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, steps + 1):
        slack = np.maximum(0, 1 - sign * sample.margins(w[:-1], w[-1]))
        slopes = -2 * told * sign * slack
        g = np.append(sample.gradient(slopes, size) + ridge * w[:-1], slopes.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w[:-1], float(w[-1])


def _calibrated(sample: features.Sample, positive: np.ndarray) -> tuple[np.ndarray, float, float, float]:
    """A machine from all rows, its curve from every fourth row judged by a machine of the others."""
    back = np.arange(len(sample)) % 4 == 0
    curve = (1.0, 0.0)
    if all(len(np.unique(positive[part])) == 2 for part in (back, ~back)):
        weights, bias = machine(sample.part(~back), positive[~back])
        curve = features.platt(sample.part(back).margins(weights, bias), positive[back].astype(int), np.ones(back.sum()))
    return (*machine(sample, positive), *curve)


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model | None:
    """The model of the documents outside the held-out fold; nothing if there is none with a text and a language."""
    names, rows = sample_of(docs, sample)
    names = [name for k, name in enumerate(names) if (rows.labels == k).any()] if len(rows) else []
    if not names:
        return None
    kept = sorted(set(rows.labels.tolist()))
    label = np.searchsorted(kept, rows.labels)
    groups: dict[str, list[str]] = {}
    for name in names:
        groups.setdefault(family_of(name), []).append(name)
    families = [groups[f] for f in sorted(groups)]
    family = np.array([next(k for k, own in enumerate(families) if name in own) for name in names])
    fitted, pairs = [], []
    if len(families) > 1:
        fitted = [_calibrated(rows, family[label] == f) for f in range(1 if len(families) == 2 else len(families))]
    for f, own in enumerate(families):
        for a, b in combinations(range(len(own)), 2):
            first, second = names.index(own[a]), names.index(own[b])
            these = (label == first) | (label == second)
            fitted.append(_calibrated(rows.part(these), label[these] == first))
            pairs.append((f, a, b))
    weights = np.array([w for w, *_ in fitted], np.float32).reshape(len(fitted), KINDS, BUCKETS).transpose(1, 0, 2)
    return Model(families, pairs, Machines(weights, *(np.array([x[k] for x in fitted]) for k in (1, 2, 3))))


def _judge(model: Model | None):
    def run(parts):
        for batch in parts:
            if model is None:
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([NONE] * batch.num_rows, pa.string()), pa.array([0.0] * batch.num_rows)],
                                                 ["doc_id", "lang_pred", "score"])
                continue
            letters = batch.column("letters").to_numpy(zero_copy_only=False)
            for chunk in batches.chunks(batch.column("text")):
                languages, scores = model.judge(chunk)
                none = ~letters[chunk.first : chunk.last].astype(bool)
                languages[none], scores[none] = NONE, 0.0
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(chunk.first, len(chunk)), pa.array(languages, pa.string()), pa.array(scores)],
                                                 ["doc_id", "lang_pred", "score"])
    return run


def identify(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score`` of every row of ``docs`` (``doc_id``, ``text``, ``lang``)."""
    model = fit(docs, sample)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                        F.coalesce(F.col("text").cast("string").rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    held = F.coalesce(features.fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return texts.mapInArrow(_judge(model), "doc_id long, lang_pred string, score double").select("doc_id", held.alias("held_out"), "lang_pred", "score")
