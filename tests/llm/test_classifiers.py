import random
import re
import zlib

import numpy as np
import pytest
from fixtures import TEXTS, awkward, labels_of, no_docs
from pyspark.sql import functions as F

from flowlens.llm import quality_pu, quality_rules, toxicity


def counts_brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    many = {w for w in windows if windows.count(w) > 1} if len(words) < 500 else {w for w, n in __import__("collections").Counter(windows).items() if n > 1}
    inside = {k + j for k, w in enumerate(windows) if w in many for j in range(3)}
    seen, duplicates = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            duplicates += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), duplicates, len(inside)


def test_base_counts(spark):
    texts = [*TEXTS, (50, "a b c a b c a"), (51, "x\nx \nx\n\n\nx"), (52, "#a *b$ %&|<> c"), (53, "same same same same"), (54, "é é é")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    rows = quality_rules.judge(docs, labels_of(spark)).collect()
    got = sorted(((r.doc_id, *(r[c] for c in quality_rules.COUNTS), r.base_failed) for r in rows), key=repr)
    wanted = []
    for doc_id, text in texts:
        n, *rest = counts_brute(text)
        wanted.append((doc_id, n, *rest, n < 50 or 100 * rest[3] > 50 * n))
    assert got == sorted(wanted, key=repr)
    assert all(r.kept != r.base_failed for r in rows)  # without labels the base rules decide alone


def test_empty_tables(spark):
    none, labels = no_docs(spark), labels_of(spark)
    assert quality_rules.judge(none, labels).count() == quality_pu.scores(none, labels).count() == toxicity.scores(none, labels).count() == 0
    assert quality_rules.keep_good(none, labels).count() == toxicity.keep_clean(none, labels).count() == 0


def test_scores_without_labels(spark):
    docs, labels = awkward(spark), labels_of(spark)
    assert {r.score for r in toxicity.scores(docs, labels).collect()} == {0.0}
    assert {r.score for r in quality_pu.scores(docs, labels).collect()} == {0.5}
    kept = toxicity.keep_clean(docs, labels)
    assert kept.dtypes == docs.dtypes and kept.count() == docs.count()


def rates(rows, truth):
    caught = [r.predicted == 1 for r in rows if truth.get(r.doc_id) == 1]
    false = [r.predicted == 1 for r in rows if truth.get(r.doc_id) == 0]
    return sum(caught) / max(1, len(caught)), sum(false) / max(1, len(false))


@pytest.fixture(scope="module")
def tables(spark):
    folder = "/root/testdata/sf0.01"
    return spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")


def test_held_out_quality(spark, tables):
    docs, labels = tables
    truth = {r.doc_id: r.quality for r in labels.collect()}
    rows = quality_pu.scores(docs, labels).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    good, bad = rates([r for r in rows if r.held_out], truth)
    assert good > 0.95 and bad < 0.3


def plain_risk(z, positive, prior):
    """Non-negative risk, row by row: its two parts."""
    import math

    loss = {k: [math.log1p(math.exp(-m)) if k else math.log1p(math.exp(m)) for m in z] for k in (0, 1)}
    mean = lambda values: sum(values) / len(values)
    first = prior * mean([x for x, own in zip(loss[1], positive) if own])
    second = mean([x for x, own in zip(loss[0], positive) if not own]) - prior * mean([x for x, own in zip(loss[0], positive) if own])
    return first, second


def test_slopes_of_the_non_negative_risk():
    draw = np.random.default_rng(7)
    seen = set()
    for shift in (-3.0, 0.0, 3.0):
        positive = np.arange(30) < 12
        z = draw.normal(size=30) + np.where(positive, -shift, shift)
        for prior in (0.2, 0.9):
            per_row = 1 / np.bincount(positive, minlength=2)[positive.astype(int)]
            got = quality_pu.risk_slopes(z, positive, per_row, prior)
            below = plain_risk(z, positive, prior)[1] < 0
            seen.add(below)
            for k in range(30):
                step = np.zeros(30)
                step[k] = 1e-6
                (a1, a2), (b1, b2) = plain_risk(z + step, positive, prior), plain_risk(z - step, positive, prior)
                wanted = -(a2 - b2) / 2e-6 if below else (a1 + a2 - b1 - b2) / 2e-6
                assert abs(got[k] - wanted) < 1e-6
    assert seen == {True, False}


def test_presence_of_held_out_labels_is_not_used(spark, tables):
    docs, labels = tables
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    fewer = labels.filter(fold != 1)
    one, two = ({(r.doc_id, r.score) for r in quality_pu.scores(docs, given).collect()} for given in (labels, fewer))
    assert one == two


def test_held_out_toxicity(spark, tables):
    docs, labels = tables
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    rows = toxicity.scores(docs, labels).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.5) for r in rows)
    caught, false = rates(rows, truth)
    assert caught > 0.6 and false < 0.05


def test_labels_of_the_held_out_fold_are_not_read(spark, tables):
    docs, labels = tables
    turned = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    few = docs.limit(50)
    assert toxicity.scores(few, labels).orderBy("doc_id").collect() == toxicity.scores(few, turned).orderBy("doc_id").collect()


def test_quality_rules_keep_good_rows(spark, tables):
    docs, labels = tables
    kept = {r.doc_id for r in quality_rules.keep_good(docs, labels).select("doc_id").collect()}
    rows = quality_rules.judge(docs, labels).join(labels, "doc_id").collect()
    assert all((r.doc_id in kept) == r.kept for r in rows)
    passed = [r for r in rows if not r.base_failed]
    assert np.mean([r.kept == (r.quality == 1) for r in passed]) > 0.97


def test_kernel_tolerates_gaps():
    near = toxicity.kernel(["loser", "l.o.s.e.r", "lo-ser", "loosser", "window"], ["loser"])[:, 0]
    assert near[0] == pytest.approx(1, abs=1e-6) and (near[1:4] > 0.6).all() and near[4] < 0.1


def kernel_brute(a, b):
    from itertools import combinations

    def subsequences(word):
        word, out = "^" + word, {}
        for places in combinations(range(len(word)), 3):
            if places[2] - places[0] < toxicity.REACH:
                key = "".join(word[k] for k in places)
                out[key] = out.get(key, 0) + toxicity.DECAY ** (places[2] - places[0] + 1)
        return out

    x, y = subsequences(a), subsequences(b)
    dot = lambda p, q: sum(v * q.get(k, 0) for k, v in p.items())
    return dot(x, y) / (dot(x, x) * dot(y, y)) ** 0.5


def test_kernel_equals_brute_force():
    words = ["abcabc", "banana", "abba", "zzzabc", "thing"]
    assert toxicity.kernel(words, words) == pytest.approx(np.array([[kernel_brute(a, b) for b in words] for a in words]), abs=1e-5)


def test_machine_finds_hidden_insults():
    draw = random.Random(2)
    syllables = ["ka", "mi", "ton", "ver", "lu", "pas", "ne", "gro"]
    word = lambda: "".join(draw.choice(syllables) for _ in range(draw.randrange(1, 4)))
    bags, toxic = [], []
    for k in range(300):
        words = [word() for _ in range(60)]
        if k % 5 == 0:
            words += draw.sample(["loser", "scumbag", "idiots"], 2)
        bags.append(sorted(set(words)))
        toxic.append(k % 5 == 0)
    machine = toxicity.train(bags, np.array(toxic))
    scores = lambda extra: machine.probability(np.array([machine.of_bag([*bags[1], *extra])]))[0]
    assert scores([]) < 0.5
    for hidden in (["l.o.s.e.r", "idiot"], ["lo-ser!", "scum-bag"], ["IDIOTS", "losser"]):
        assert scores(hidden) > 0.5, hidden


def test_spaced_letters_are_one_word():
    assert toxicity.spaced([b"a", b"word", b"l", b"o", b"s,", b"e", b"r.", b"x"])[8:] == [b"loserx"]


def test_prior_bound():
    draw = np.random.default_rng(5)
    positive = draw.normal(3, 1, 4000)
    unlabelled = np.concatenate([draw.normal(3, 1, 2800), draw.normal(-3, 1, 1200)])
    assert quality_pu.prior_bound(positive, unlabelled) == pytest.approx(0.7, abs=0.05)
