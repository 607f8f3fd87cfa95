import random
from collections import Counter

import numpy as np
import pytest
from fixtures import awkward, no_docs
from pyspark.sql import functions as F

from flowlens.llm import batches, hamming_topk, jaccard_join, licences
from flowlens.llm.components import components


def shingle_set(text):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    size = min(5, len(words))
    return {tuple(words[k : k + size]) for k in range(len(words) - size + 1)}


def brute(rows):
    """Class and links of each row, rows compared one by one."""
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def top(k):
        while parent[k] != k:
            k = parent[k]
        return k

    links = Counter()
    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and common >= 0.8 * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                parent[top(i)] = top(j)
    out = []
    for k, (doc_id, _) in enumerate(rows):
        ids = [rows[m][0] for m in range(len(rows)) if top(m) == top(k) and rows[m][0] is not None]
        out.append((doc_id, min(ids) if ids else None, links[k]))
    return sorted(out, key=repr)


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_near_duplicates_of_awkward_rows(spark):
    docs = awkward(spark)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert found(jaccard_join.near_duplicates(docs)) == brute(rows)


def test_near_duplicates_of_no_rows(spark):
    assert found(jaccard_join.near_duplicates(no_docs(spark))) == []
    assert jaccard_join.keep_one(no_docs(spark)).count() == 0


@pytest.mark.parametrize("limits", [{}, {"SMALL_BUCKET": 8, "PART": 32, "BLOCK_SETS": 16}])
def test_near_duplicates_in_large_groups(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(jaccard_join, name, value)
    draw = random.Random(1)
    base = [f"w{draw.randrange(10**6)}" for _ in range(150)]
    rows = []
    for k in range(90):
        words = list(base)
        for _ in range(draw.randrange(4)):
            words[draw.randrange(len(words))] = f"x{draw.randrange(10**6)}"
        rows.append((k, " ".join(words)))
    passage = " ".join(base[:60])
    rows += [(100 + k, passage + " " + " ".join(f"y{draw.randrange(10**6)}" for _ in range(70))) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(jaccard_join.near_duplicates(docs)) == brute(rows)


def test_leaders_that_do_not_shrink_are_compared_in_blocks(spark, monkeypatch):
    """Sets that share a long passage but are no near-duplicates: every one is a leader, and pairs stand in different parts."""
    for name, value in {"SMALL_BUCKET": 8, "PART": 16, "ALIKE": 0.3}.items():
        monkeypatch.setattr(jaccard_join, name, value)
    similar, most = jaccard_join._similar, []

    def watched(tokens, least, *others):
        most.append(max(len(tokens), *map(len, others)) if others else len(tokens))
        return similar(tokens, least, *others)

    draw = random.Random(2)
    passage = " ".join(f"w{draw.randrange(10**6)}" for _ in range(90))
    rows = [(k, passage + " " + " ".join(f"y{draw.randrange(10**6)}" for _ in range(30))) for k in range(120)]
    rows += [(200 + k, text + " more") for k, text in rows[:20]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(jaccard_join.near_duplicates(docs)) == brute(rows)

    # One node of 160 leaders, its blocks compared here, so that sizes can be watched.
    monkeypatch.setattr(jaccard_join, "_similar", watched)
    sketches = np.random.default_rng(1).integers(0, 256, (160, jaccard_join.TOKENS)).astype(np.uint8)
    sketches[80:] = sketches[:80]
    reps = spark.createDataFrame([(k, bytes(s)) for k, s in enumerate(sketches)], "rep long, sketch binary")
    plan = {}
    monkeypatch.setattr(type(reps), "mapInArrow", lambda df, run, _: plan.update(run=run, rows=df.toArrow()) or df)
    jaccard_join._compare_leaders(reps.selectExpr("rep", "7L AS node"), reps)
    links = [(a, b) for batch in plan["run"](plan["rows"].to_batches()) for a, b in zip(*(c.to_pylist() for c in batch.columns))]
    assert {(max(p), min(p)) for p in links} == {(80 + k, k) for k in range(80)}
    assert max(most) <= 3 * jaccard_join.PART


def test_keep_one_keeps_columns_and_one_row_a_class(spark):
    docs = awkward(spark)
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    # One row of each class; every text without words is a class of its own, with an id or without.
    classes = {c for i, c, _ in brute([(r.doc_id, r.text) for r in docs.collect()]) if i == c and i is not None}
    assert sorted(ids, key=repr) == sorted([*classes, None], key=repr)


def test_keep_one_looks_at_rows_not_ids(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(60)) for x in "abc")
    rows = [(1, a), (1, b), (2, c), (3, a + " x"), (None, c), (None, "alone in the world of words"), (1, a), (None, None)]
    kept = jaccard_join.keep_one(spark.createDataFrame(rows, "doc_id long, text string").withColumn("_row", F.lit(0)))
    assert kept.columns == ["doc_id", "text", "_row"]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(
        [(1, a), (1, b), (2, c), (None, "alone in the world of words"), (None, None)], key=repr)


def test_very_many_rows_without_an_id(spark):
    base = " ".join(f"w{k}" for k in range(40))
    docs = spark.range(4000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit(base), F.lit(" "), (F.col("id") % 50).cast("string")).alias("text"))
    found_rows = jaccard_join.near_duplicates(docs)
    assert found_rows.groupBy("class_id", "n_links").count().collect() == [(None, 3999, 4000)]
    assert jaccard_join.keep_one(docs).count() == 1


def test_runs_reach_the_recall():
    miss = (1 - jaccard_join.meeting_probability(jaccard_join.DEPTH)) ** jaccard_join.runs_needed()
    assert miss <= 1 - jaccard_join.RECALL


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 101), (101, 100), (7, 7), (None, 3)] + [(200, 201 + k) for k in range(30)]
    result = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert result == {**{k: 0 for k in range(41)}, 100: 100, 101: 100, **{k: 200 for k in range(200, 231)}}


def test_word_hashes_ignore_cuts(monkeypatch):
    import pyarrow as pa

    text = pa.array(["alpha beta " * 50 + "gamma" * 40, None, "", "beta"])
    whole = [batches.words(c) for c in batches.chunks(text)]
    monkeypatch.setattr(batches, "CHUNK_BYTES", 64)
    batches._TABLES.clear()
    small = [batches.words(c) for c in batches.chunks(text, 1 << 20)]
    batches._TABLES.clear()
    assert all((a[0] == b[0]).all() and (a[1] == b[1]).all() for a, b in zip(whole, small))
    hashes, at = whole[0]
    assert at.tolist() == [0, 101, 101, 101, 102] and hashes[1] == hashes[101]


def test_topk_of_awkward_rows(spark):
    draw = np.random.default_rng(3)
    vectors = [(k, draw.normal(size=64).tolist()) for k in range(300)]
    vectors += [(1000 + k, vectors[0][1]) for k in range(30)] + [(40, vectors[5][1]), (None, vectors[0][1]), (60, None)]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    codes = [(k, sum(1 << b for b, x in enumerate(v) if x > 0)) for k, v in vectors if k is not None and v is not None]
    wanted = []
    for q, code in codes:
        if q % 20 == 0:
            near = sorted(((code ^ c).bit_count(), k) for k, c in codes)[:10]
            wanted += [(q, rank + 1, k, d) for rank, (d, k) in enumerate(near)]
    got = sorted((r.query_id, r.rank, r.vec_id, r.distance) for r in hamming_topk.search(frame).collect())
    assert {g[0] for g in got} == {w[0] for w in wanted}
    assert [g for g in got if g[0] != 40] == sorted(w for w in wanted if w[0] != 40)
    assert hamming_topk.search(frame.limit(0)).count() == 0


@pytest.mark.parametrize("dims", [8, 72, 128])
def test_topk_of_any_number_of_dimensions(spark, dims):
    draw = np.random.default_rng(4)
    base = draw.normal(size=dims)
    vectors = []
    for k in range(200):
        v = base.copy()
        v[-8:] = draw.normal(size=8)
        vectors.append((k, (v if k % 2 else draw.normal(size=dims)).tolist()))
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    codes = {k: sum(1 << b for b, x in enumerate(v) if x > 0) for k, v in vectors}
    wanted = [(q, rank + 1, k, d) for q in codes if q % 20 == 0
              for rank, (d, k) in enumerate(sorted(((codes[q] ^ c).bit_count(), k) for k, c in codes.items())[:10])]
    assert sorted((r.query_id, r.rank, r.vec_id, r.distance) for r in hamming_topk.search(frame).collect()) == sorted(wanted)


def nearest_by_hand(codes, asked, k=10):
    """Rows by code of the vectors, as whole numbers of any size."""
    return sorted((q, rank + 1, i, d) for q in asked for rank, (d, i) in enumerate(sorted(((codes[q] ^ c).bit_count(), i) for i, c in codes.items())[:k]))


def test_topk_broadcasts_nothing(spark, monkeypatch):
    # Spark takes exploded probes for as small as the codes they come from; every table here is below its bound.
    plans = []
    plain = hamming_topk.stage
    monkeypatch.setattr(hamming_topk, "stage", lambda df, name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or plain(df, name))
    draw = np.random.default_rng(6)
    vectors = [(k, draw.normal(size=16).tolist()) for k in range(200)]
    found = hamming_topk.search(spark.createDataFrame(vectors, "vec_id long, embedding array<float>"))
    codes = {k: sum(1 << b for b, x in enumerate(v) if x > 0) for k, v in vectors}
    assert sorted((r.query_id, r.rank, r.vec_id, r.distance) for r in found.collect()) == nearest_by_hand(codes, [k for k in codes if k % 20 == 0])
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    assert len(plans) > 3 and not [p for p in plans if "Broadcast" in p]


def test_topk_in_many_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(hamming_topk, "SHARD_ROWS", 150)
    monkeypatch.setattr(hamming_topk, "LEAST_BLOCK", 8)
    draw = np.random.default_rng(7)
    vectors = [(7 * k - 300, draw.normal(size=64).tolist()) for k in range(1000)]
    vectors += [(10_000 + k, vectors[3 * k][1]) for k in range(100)]
    codes = {k: sum(1 << b for b, x in enumerate(v) if x > 0) for k, v in vectors}
    assert hamming_topk._parts(len(codes), 55, 1, 8) == (8, 6)
    got = hamming_topk.search(spark.createDataFrame(vectors, "vec_id long, embedding array<float>"))
    assert sorted((r.query_id, r.rank, r.vec_id, r.distance) for r in got.collect()) == nearest_by_hand(codes, [k for k in codes if k % 20 == 0])


@pytest.mark.parametrize("scan_cost, held", [(0, 1 << 17), (3, 50), (10**9, 1 << 17), (10**9, 50)])
@pytest.mark.parametrize("bits", [20, 64, 100])
def test_topk_of_a_block(monkeypatch, bits, scan_cost, held):
    """By comparison with all codes, by fetches, and by both; half of the codes share most segments."""
    monkeypatch.setattr(hamming_topk, "PIECE", 256)
    monkeypatch.setattr(hamming_topk, "HELD", held)
    monkeypatch.setattr(hamming_topk, "SCAN_COST", scan_cost)
    draw = np.random.default_rng(8)
    words = -(-bits // 64)
    top = np.array([(1 << min(64, bits - 64 * w)) - 1 for w in range(words)], np.uint64)
    rows = draw.integers(0, 1 << 63, (600, words)).astype(np.uint64) * np.uint64(2) & top
    rows[::2] = rows[0] ^ draw.integers(0, 64, (300, words)).astype(np.uint64)
    ids = draw.permutation(600) - 100
    block = hamming_topk.Block(np.ascontiguousarray(rows[:40].T), bits, 10)
    for part in (slice(0, 7), slice(7, 400), slice(400, 600)):
        block.meet(np.ascontiguousarray(rows[part].T), ids[part])
    number = lambda row: sum(int(x) << 64 * w for w, x in enumerate(row))
    for query, distance, found in zip(block.queries.T, block.distance, block.ids):
        near = sorted(((number(query) ^ number(row)).bit_count(), int(i)) for row, i in zip(rows, ids))[:10]
        assert list(zip(distance.tolist(), found.tolist())) == near


def test_topk_packs_rows_of_bounded_size(monkeypatch):
    """A shard travels in many rows, and all of its codes arrive."""
    import pyarrow as pa

    monkeypatch.setattr(hamming_topk, "PACKED_WORDS", 50)
    batch = pa.RecordBatch.from_pydict({"code": [[k, -k] for k in range(40)], "vec_id": list(range(40)), "part": pa.array([k % 3 for k in range(40)], pa.int32())})
    rows = [r for b in hamming_topk._packed(2)(iter([batch] * 9)) for r in b.to_pylist()]
    assert len(rows) == 15 and max(len(r["ids"]) for r in rows) == 28 * 8
    found = Counter((r["part"], *x) for r in rows for x in zip(np.frombuffer(r["codes"], np.int64).reshape(-1, 2).tolist(), np.frombuffer(r["ids"], np.int64).tolist()) for x in [(*x[0], x[1])])
    assert found == Counter({(k % 3, k, -k, k): 9 for k in range(40)})
    # 6 GB of vectors: shards stay bounded, and so do blocks.
    assert hamming_topk._parts(15_400_000, 770_000, 1, 6) == (8, 18) and hamming_topk._parts(154_000_000, 7_700_000, 1, 6) == (74, 118)


def test_topk_refuses_mixed_lengths(spark):
    with pytest.raises(ValueError):
        hamming_topk.search(spark.createDataFrame([(0, [1.0]), (1, [1.0, 2.0])], "vec_id long, embedding array<float>"))


def test_licences_of_awkward_rows(spark):
    rows = awkward(spark).select("doc_id", "text").collect()
    notice = "Notes.\nReleased under the MIT license!\nmore words follow here"
    docs = spark.createDataFrame([*map(tuple, rows), (900, notice), (901, "licensed UNDER cc by-nc 4.0"), (902, "released under")], "doc_id long, text string")
    got = {r.doc_id: (r.licence, r.n_matches) for r in licences.scan(docs).collect()}
    assert got[900] == ("mit", 1) and got[901] == ("cc-by-nc-4.0", 1) and got[902] == (None, 0) and got[7] == (None, 0)
    assert licences.scan(docs).count() == docs.count() and licences.scan(docs.limit(0)).count() == 0
    assert [(r.doc_id, r.line) for r in licences.matches(docs).collect()] == [(900, 1), (901, 0)]


def test_licences_of_long_texts_equal_sql(spark):
    """Texts of thousands of words that have few distinct bigrams, as they repeat a notice."""
    import duckdb

    lines = "Released under the MIT License.\n" * 1000
    wrapped = "This Source Code Form is subject to\nthe terms of the Mozilla Public License, v. 2.0.\n" * 300
    other = " ".join(f"w{k}" for k in range(5000)) + "\nReleased under the MIT License."
    docs = spark.createDataFrame([(1, lines), (2, wrapped), (3, other), (4, "a\nb")], "doc_id long, text string")
    connection = duckdb.connect()
    connection.register("documents", docs.toPandas())
    got = sorted(map(tuple, licences.scan(docs).collect()))
    assert got == sorted(connection.execute(licences.ORACLE).fetchall())
    assert [(r[1], r[3]) for r in got] == [("mit", 1001), ("mpl-2.0", 1), ("mit", 1), (None, 0)]
