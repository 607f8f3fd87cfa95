import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from fixtures import awkward, no_docs
from pyspark.sql import functions as F

from flowlens.llm import batches, language_id
from flowlens.llm.shipping import ship

WORDS = {
    "en": "the of and with house water people should night which there weather", "de": "der die und mit haus wasser leute sollte nacht welche dort wetter",
    "nl": "de het en met huis water mensen zouden nacht welke daar weer", "fr": "le la et avec maison eau gens devrait nuit lequel temps où",
    "es": "el los y con casa agua gente debería noche cual tiempo donde", "xx": "zzor qqat vrix uumo zzat qqor vrum uuix"}


def texts(count, seed=1):
    rng = random.Random(seed)
    rows = []
    for k in range(count):
        lang = rng.choice(sorted(WORDS))
        rows.append((k, " ".join(rng.choice(WORDS[lang].split()) for _ in range(rng.randrange(4, 60))).capitalize() + ".", lang))
    return rows


def table(spark, rows):
    ship(spark)
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_held_out_texts_get_their_language(spark):
    rows = texts(900)
    got = language_id.identify(table(spark, rows)).collect()
    assert len(got) == len(rows)
    truth = {k: lang for k, _, lang in rows}
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.99 * len(held)


def test_held_out_labels_are_not_learned(spark):
    rows = texts(400)
    lied = [(k, t, "xx" if zlib.crc32(str(k).encode()) % 4 == 2 else lang) for k, t, lang in rows]
    key = lambda r: r.doc_id
    assert sorted(language_id.identify(table(spark, rows)).collect(), key=key) == sorted(language_id.identify(table(spark, lied)).collect(), key=key)


def test_family_first_then_pairs(spark):
    model = language_id.fit(table(spark, texts(600)))
    assert model.families == [["de", "en", "nl"], ["es", "fr"], ["xx"]]
    assert model.pairs == [(0, 0, 1), (0, 0, 2), (0, 1, 2), (1, 0, 1)]
    assert len(model.machines.bias) == 3 + 4


def plain_margins(model, text):
    """Features counted in dictionaries."""
    read = "".join(chr(language_id._READ[b]) for b in text.encode())
    found = [read.split(" ")] + [[read[k : k + n] for k in range(len(read) - n + 1)] for n in language_id.ORDERS]
    total = model.machines.bias.copy()
    for kind, parts in enumerate(found):
        if kind:
            parts = [p for p in parts if "  " not in p]
        counts = Counter(p for p in parts if p)
        for part, n in counts.items():
            data = np.array([ord(c) for c in part], np.uint8)
            if kind == 0:
                h = batches.span_hashes(data, np.array([0]), np.array([len(data)]))
            else:
                value = language_id.ORDERS[kind - 1]
                for b in data.tolist():
                    value = (value << 8 | b) % (1 << 64)
                h = batches.mix(np.array([value], np.uint64))
            total = total + language_id.SCALE * n / sum(counts.values()) * model.machines.weights[kind, :, language_id._bucket(h)[0]]
    return total


def test_margins_equal_counting_by_hand(spark):
    model = language_id.fit(table(spark, texts(300)))
    some = ["Der Wind, und die  Nacht!", "", "où", "x", "12 34", "the\tthe\nThe casa", " a "]
    chunk = next(batches.chunks(pa.array(some)))
    got = model.machines.margins(chunk)
    for k, text in enumerate(some):
        assert got[k] == pytest.approx(plain_margins(model, text), abs=1e-4)


def test_texts_of_several_chunks_are_read_whole(spark, monkeypatch):
    model = language_id.fit(table(spark, texts(300)))
    long = ("der wind und die nacht " * 9000) + ("the people of the house " * 30000)
    chunk = next(batches.chunks(pa.array([long])))
    once = model.machines.margins(chunk)
    monkeypatch.setattr(batches, "CHUNK_BYTES", 1 << 14)
    assert model.machines.margins(chunk) == pytest.approx(once, rel=1e-3, abs=1e-3)
    assert once[0] == pytest.approx(plain_margins(model, long), rel=1e-3, abs=1e-3)


def test_awkward_rows_have_a_defined_result(spark):
    docs = awkward(spark)
    got = language_id.identify(docs).collect()
    assert len(got) == docs.count() and {r.lang_pred for r in got} == {"und"} and {r.score for r in got} == {0.0}
    known = docs.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "en").otherwise("fr"))
    rows = {r.doc_id: r for r in language_id.identify(known).collect()}
    assert rows[4].lang_pred == rows[5].lang_pred == rows[6].lang_pred == "und" and rows[4].score == 0
    assert rows[None].held_out is False
    assert all(r.lang_pred in ("en", "fr", "und") for r in rows.values())
    one = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(docs.withColumn("lang", F.lit("en"))).collect()}
    assert one[1] == ("en", 1.0) and one[5] == ("und", 0.0)
    assert language_id.identify(no_docs(spark)).count() == 0


def test_letters_decide_und(spark):
    rows = texts(100) + [(1000, "12 !? 34", "en"), (1001, "漢字", None), (1002, "١٢٣", None), (1003, "ʰ", None)]
    got = {r.doc_id: r.lang_pred for r in language_id.identify(table(spark, rows)).collect()}
    assert got[1000] == got[1002] == "und" and got[1001] != "und" and got[1003] != "und"


def test_copies_of_one_text_do_not_fill_the_sample(spark):
    rows = texts(200) + [(10_000 + k, "the water and the people", "en") for k in range(3000)]
    names, sample = language_id.sample_of(table(spark, rows), 300)
    assert names == sorted(WORDS) and len(sample) <= 600
    assert min(np.bincount(sample.labels)) >= 15
