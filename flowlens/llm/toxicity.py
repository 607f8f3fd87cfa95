"""Toxicity by a support vector machine with a subsequence string kernel.

The kernel of two words is the sum over all common subsequences of ``ORDER`` letters of ``DECAY`` to the
spans they take in both, normalised to one on equal words. A character between the letters only
lengthens a span, so ``l.o.s.e.r``, ``lo-ser`` and ``loosser`` stay close to ``loser``. Spans
above ``REACH`` are left out. Letters spaced out as words of their own (``l o s e r``) are read as one word.

A labelled text is a bag of sentences, and a sentence is as toxic as its most toxic words; the three
greatest margins judge a text. Training goes in rounds, as multiple instances ask: the words of each toxic text that
speak most for toxicity are taken as its toxic sentence's, all words of clean texts as clean, with those most often mistaken added. The
kernel is approximated by the Nyström method with landmark words, and the machine is linear in that space.
Because the kernel has an explicit feature per subsequence, landmarks and machine fold into one
weight per subsequence for scoring. Probabilities are calibrated on texts held back.

The fit sees at most ``TOXIC`` and ``CLEAN`` labelled rows; all texts are scored whole. A null or empty text has no words and
gets the least score. Without labels of both kinds every score is 0. Rows are independent;
repeated rows and null ids are scored like any other.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm import batches, features

ORDER = 3
DECAY = 0.6
REACH = 9
LANDMARKS = 160
ROUNDS = 2
TOXIC, CLEAN = 1000, 2000
HARD = 3000
MOST_WITNESSES = 3000
# A text is judged by so many of its words, those with the greatest margins.
TOP = 3
# A log-likelihood ratio that chance rarely gives a five-letter part.
LEAST_EVIDENCE = 25.0
RIDGE = 1e-5
FOLDS, HELD_OUT = 5, 0
KEPT = 250_000

# Symbols: 0 no letter, 1-26 a-z, 27 a word's start, the rest for other letters.
SYMBOLS = 64
_START = 27
_STEPS = [(a, b) for a, b in combinations(range(1, REACH), 2)]


def _symbols(points: np.ndarray) -> np.ndarray:
    lower = np.where((points >= 65) & (points <= 90), points + 32, points)
    ascii_letter = (lower >= 97) & (lower <= 122)
    # À-Þ and à-þ are the same letters in two cases.
    other = np.where((lower >= 0xC0) & (lower <= 0xDE), lower + 32, lower)
    return np.where(ascii_letter, lower - 96, np.where(other >= 0xAA, 28 + other % 36, 0)).astype(np.int64)


def _subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word number, subsequence and weight of every feature of the words, ordered by word."""
    joined = "".join([w + "\0" * REACH for w in ["\0" + w for w in words]])
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.int64)
    sizes = np.array([len(w) + 1 + REACH for w in words], np.int64)
    owner = np.repeat(np.arange(len(words)), sizes)
    text = _symbols(points)
    text[np.cumsum(sizes) - sizes] = _START
    owners, keys, weights = [], [], []
    end = len(text) - REACH + 1
    here = np.flatnonzero(text[:end] > 0)
    for a, b in _STEPS:
        middle, last = text[here + a], text[here + b]
        good = (middle > 0) & (last > 0)
        place = here[good]
        owners.append(owner[place])
        keys.append((text[place] * SYMBOLS + middle[good]) * SYMBOLS + last[good])
        weights.append(np.full(len(place), DECAY ** (b + 1)))
    owner, key, weight = np.concatenate(owners), np.concatenate(keys), np.concatenate(weights)
    both = owner * SYMBOLS**ORDER + key
    order = np.argsort(both)
    both, weight = both[order], weight[order]
    first = np.flatnonzero(np.concatenate(([True], both[1:] != both[:-1]))) if len(both) else np.zeros(0, np.int64)
    total = np.add.reduceat(weight, first) if len(first) else weight
    owner, key = both[first] // SYMBOLS**ORDER, both[first] % SYMBOLS**ORDER
    norm = np.sqrt(np.bincount(owner, total * total, minlength=len(words)))
    return owner, key, total / norm[owner]


def kernel(words: list[str], landmarks: list[str]) -> np.ndarray:
    """Normalised subsequence kernel of every word with every landmark."""
    owner, key, weight = _subsequences(landmarks)
    columns, place = np.unique(key, return_inverse=True)
    basis = np.zeros((len(columns), len(landmarks)), np.float32)
    basis[place, owner] = weight
    out = np.zeros((len(words), len(landmarks)))
    for at in range(0, len(words), 512):
        part = words[at : at + 512]
        owner, key, weight = _subsequences(part)
        place = np.minimum(np.searchsorted(columns, key), len(columns) - 1)
        there = columns[place] == key
        block = np.zeros((len(part), len(columns)), np.float32)
        block[owner[there], place[there]] = weight[there]
        out[at : at + 512] = block @ basis
    return out


def spaced(words: list[bytes]) -> list[bytes]:
    """The words, and each run of at least three one-letter words as one more."""
    out, run = list(words), []
    for word in [*words, b"--"]:
        bare = word.strip(b".,;:!?-_*'\"()")
        if len(bare) == 1 and bare.isalpha() or len(bare) == 2 and bare[0] >= 0xC0:
            run.append(bare)
            continue
        if len(run) >= 3:
            out.append(b"".join(run))
        run = []
    return out


@dataclass
class Machine:
    """Weight of every subsequence, bias, and the calibration of a text's greatest margins."""

    weights: np.ndarray
    bias: float
    slopes: tuple[float, ...] = (1.0, 0.0, 0.0)
    shift: float = 0.0
    known: dict = field(default_factory=dict, repr=False)

    def of_words(self, words: list[str]) -> np.ndarray:
        out = np.empty(len(words))
        for at in range(0, len(words), 1024):
            part = words[at : at + 1024]
            owner, key, weight = _subsequences(part)
            out[at : at + 1024] = np.bincount(owner, weight * self.weights[key], minlength=len(part)) + self.bias
        return out

    def of_texts(self, chunk: batches.Chunk) -> np.ndarray:
        """The ``TOP`` greatest margins of each text's distinct words, one row a text."""
        hashes, at = batches.words(chunk)
        names, first, place = np.unique(hashes, return_index=True, return_inverse=True)
        starts, ends = batches.spans(~batches.BLANK[chunk.data])
        raw = chunk.data.tobytes()
        known, margins, new = self.known, np.empty(len(names)), []
        for k, name in enumerate(names.tolist()):
            value = known.get(name)
            if value is None:
                new.append(k)
            else:
                margins[k] = value
        if new:
            values = self.of_words([raw[starts[first[k]] : ends[first[k]]].decode() for k in new])
            margins[new] = values
            if len(known) + len(new) > KEPT:
                known.clear()
            known.update(zip(names[new].tolist(), values.tolist()))
        text = np.repeat(np.arange(len(chunk)), np.diff(at))
        extra_text, extra = self._spaced(text, starts, ends, raw)
        text = np.concatenate([text, extra_text])
        word = np.concatenate([place, len(names) + np.arange(len(extra))])
        margin = np.concatenate([margins[place], extra])
        out = np.full((len(chunk), TOP), self.bias - 1)
        # Only words well above the bias can count; they are few.
        high = np.flatnonzero(margin > self.bias)
        high = high[np.lexsort((word[high], -margin[high], text[high]))]
        new_word = np.ones(len(high), bool)
        new_word[1:] = (text[high][1:] != text[high][:-1]) | (word[high][1:] != word[high][:-1])
        high = high[new_word]
        rank = np.arange(len(high)) - np.searchsorted(text[high], text[high], "left")
        some = rank < TOP
        out[text[high][some], rank[some]] = margin[high][some]
        return out

    def _spaced(self, text, starts, ends, raw) -> tuple[np.ndarray, np.ndarray]:
        """Text and margin of words whose letters are spaced out."""
        runs, stops = batches.spans((ends - starts) <= 3)
        units, owners = [], []
        for k in np.flatnonzero(stops - runs >= 3):
            own = text[runs[k] : stops[k]]
            for number in np.unique(own):
                words = [raw[starts[i] : ends[i]] for i in np.arange(runs[k], stops[k])[own == number]]
                extra = spaced(words)[len(words) :]
                units += [u.decode() for u in extra]
                owners += [number] * len(extra)
        return np.array(owners, np.int64), self.of_words(units)

    def of_bag(self, words: list[str]) -> np.ndarray:
        best = np.sort(self.of_words(words))[::-1][:TOP]
        return np.concatenate([best, np.full(TOP - len(best), self.bias - 1)])

    def probability(self, margins: np.ndarray) -> np.ndarray:
        return features.sigmoid(margins @ np.array(self.slopes) + self.shift)


def _bags(parts):
    """The distinct words of each text, one to a line."""
    for batch in parts:
        bags = []
        for text in batch.column("text").to_pylist():
            bags.append("\n".join(sorted({w.decode() for w in spaced((text or "").encode().split())})))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(bags, pa.string())], ["doc_id", "label", "words"])


def _parts(word: str) -> list[str]:
    """Five-letter parts of the word's letters between a start and an end mark."""
    bare = "".join(c for c in word.lower() if c.isalpha())
    marked = f"^{bare}$"
    return [marked[k : k + 5] for k in range(max(1, len(marked) - 4))] if bare else []


def _evidence(bags: list[list[str]], toxic: np.ndarray) -> dict[str, float]:
    """How much a word speaks for toxic texts: the greatest log-likelihood ratio of its parts' text counts."""
    # One object per distinct part: the words of a sample share most of them.
    same: dict[str, str] = {}
    parts = {w: tuple([same.setdefault(p, p) for p in _parts(w)]) for w in {w for words in bags for w in words}}
    counts: dict[str, list[int]] = {}
    for words, label in zip(bags, toxic.tolist()):
        for part in set().union(*(parts[w] for w in words)):
            counts.setdefault(part, [0, 0])[label] += 1
    names = list(counts)
    good, bad = np.array([counts[n] for n in names], float).reshape(-1, 2).T
    all_bad, all_good = max(1, int(toxic.sum())), max(1, int((~toxic).sum()))
    share = (good + bad) / (all_bad + all_good)

    def term(seen, expected):
        return np.where(seen > 0, 2 * seen * np.log(np.maximum(seen, 1e-9) / np.maximum(expected, 1e-9)), 0)

    ratio = (term(bad, all_bad * share) + term(good, all_good * share)
             + term(all_bad - bad, all_bad * (1 - share)) + term(all_good - good, all_good * (1 - share)))
    worth = dict(zip(names, np.where(bad * all_good > good * all_bad, ratio, 0.0).tolist()))
    return {w: max((worth[p] for p in own), default=0.0) for w, own in parts.items()}


def fit(docs: DataFrame, labels: DataFrame, toxic_bound: int = TOXIC, clean_bound: int = CLEAN) -> Machine | None:
    """The machine, from labelled rows outside the held-out fold; none if a label has no row there."""
    known = features.labelled(labels, "toxic").filter(features.fold(F.col("doc_id"), FOLDS) != HELD_OUT)
    picked = features.first_by_hash(known.filter("label = 1"), toxic_bound).union(features.first_by_hash(known.filter("label = 0"), clean_bound))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = texts.join(F.broadcast(picked), "doc_id").select("doc_id", "label", "text")
    table = rows.mapInArrow(_bags, "doc_id long, label int, words string").toArrow().sort_by("doc_id")
    toxic = table.column("label").to_numpy() == 1
    # One object per distinct word.
    same: dict[str, str] = {}
    bags = [[same.setdefault(w, w) for w in words.as_py().split("\n")] if words.as_py() else [] for words in table.column("words")]
    del table
    if toxic.all() or not toxic.any():
        return None
    return train(bags, toxic)


def train(bags: list[list[str]], toxic: np.ndarray) -> Machine:
    held = np.arange(len(bags)) % 4 == 0
    if not toxic[~held].any() or toxic[~held].all() or not toxic[held].any() or toxic[held].all():
        held[:] = False
    own = [(b, t) for b, t, h in zip(bags, toxic, held) if not h and b]
    evidence = _evidence([b for b, _ in own], np.array([t for _, t in own]))
    random = np.random.default_rng(4)
    clean: dict[str, int] = {}
    for words, t in own:
        if not t:
            for w in words:
                clean[w] = clean.get(w, 0) + 1
    names = sorted(clean)
    # All clean words that look like evidence, and a sample of the others, may be mistaken.
    doubtful = sorted(names, key=lambda w: (-evidence[w], w))[:HARD]
    others = [names[k] for k in random.permutation(len(names))[: 4 * HARD]]
    negatives = sorted({*doubtful[: HARD // 2], *others[: HARD // 2]})
    pool = sorted({*doubtful, *others})
    # In the first round the witnesses are the words of a toxic text that speak most for toxicity.
    worth: dict[str, float] = evidence
    for turn in range(ROUNDS):
        witness: dict[str, int] = {}
        for words, t in own:
            if t:
                best = sorted(words, key=lambda w: (-worth[w], w))[:TOP]
                for w in best:
                    if evidence[w] >= LEAST_EVIDENCE and worth[w] >= (0.5 * worth[best[0]] if turn == 0 else 0.0) or w == best[0] and turn == 0:
                        witness[w] = witness.get(w, 0) + 1
        if not witness:
            break
        machine = _svm(witness, {w: clean[w] for w in negatives}, evidence)
        margins = machine.of_words(pool)
        negatives = sorted({*negatives, *(pool[k] for k in np.argsort(-margins, kind="stable")[: HARD // 2])})
        candidates = sorted({w for words, t in own if t for w in words})
        worth = dict(zip(candidates, machine.of_words(candidates).tolist()))
    rows = [(b, t) for b, t, h in zip(bags, toxic, held if held.any() else ~held) if h]
    best = np.array([machine.of_bag(b) for b, _ in rows])
    machine.slopes, machine.shift = _calibrate(best, np.array([t for _, t in rows], float))
    return machine


def _svm(positives: dict[str, int], negatives: dict[str, int], evidence: dict[str, float]) -> Machine:
    """Squared-hinge machine in the Nyström space of landmark words, folded into subsequence weights.

    A word weighs as often as texts have it.
    """
    frequent = sorted(positives, key=lambda w: (-positives[w], w))[:MOST_WITNESSES]
    close = sorted(negatives, key=lambda w: (-evidence[w], w))
    landmarks = frequent[: LANDMARKS * 2 // 3] + close[: LANDMARKS // 3]
    values, vectors = np.linalg.eigh(kernel(landmarks, landmarks))
    root = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-3))) @ vectors.T
    words = frequent + close
    label = np.array([1.0] * len(frequent) + [-1.0] * len(close))
    weight = np.sqrt(np.array([positives[w] for w in frequent] + [negatives[w] for w in close], float))
    weight /= np.where(label > 0, weight[label > 0].sum(), weight[label < 0].sum())
    z = np.column_stack([kernel(words, landmarks) @ root, np.ones(len(words))])
    w = np.zeros(z.shape[1])
    ridge = np.full(len(w), RIDGE)
    ridge[-1] = 1e-9
    for _ in range(40):  # Newton steps over the rows inside the margin
        miss = label * (z @ w) < 1
        inner = z[miss] * weight[miss, None]
        new = np.linalg.solve(inner.T @ z[miss] + np.diag(ridge), inner.T @ label[miss])
        if np.allclose(new, w, atol=1e-8):
            break
        w = w + 0.7 * (new - w)
    alpha = root @ w[:-1]
    owner, key, value = _subsequences(landmarks)
    return Machine(np.bincount(key, alpha[owner] * value, minlength=SYMBOLS**ORDER), float(w[-1]))


def _calibrate(margins: np.ndarray, label: np.ndarray) -> tuple[tuple[float, ...], float]:
    """Logistic regression on the greatest margins of held-back texts, no slope below zero."""
    x, w = np.column_stack([margins, np.ones(len(margins))]), np.zeros(TOP + 1)
    step = 4.0 / max(1e-9, float((x * x).sum(axis=1).mean()))
    momentum, last = w.copy(), w
    for k in range(3000):
        g = x.T @ (features.sigmoid(x @ momentum) - label) / len(label)
        g[:-1] += 1e-5 * momentum[:-1]
        w = momentum - step * g
        w[:-1] = np.maximum(w[:-1], 0)
        momentum, last = w + k / (k + 3) * (w - last), w
    return tuple(w[:-1].tolist()), float(w[-1])


def _score(machine: Machine | None):
    def run(parts):
        for batch in parts:
            for chunk in batches.chunks(batch.column("text")):
                score = machine.probability(machine.of_texts(chunk)) if machine else np.zeros(len(chunk))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(chunk.first, len(chunk)), pa.array(score), pa.array(score < 0.5)],
                                                 ["doc_id", "score", "clean"])
    return run


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` of every row of ``docs``."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(_score(fit(docs, labels)), "doc_id long, score double, clean boolean").select(
        "doc_id", (features.fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not toxic, with their columns."""
    from flowlens.llm.quality_rules import filter_texts

    return filter_texts(docs, _score(fit(docs, labels)), "clean")
