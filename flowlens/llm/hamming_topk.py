"""Exact top-k search over binary codes by multi-index hashing.

A vector's code has one bit per dimension, set where the value is above zero. The code is cut into
``m`` segments, and every segment has a hash index over all codes. A search enlarges the radius of
one segment after the other: at radius ``r`` in segment ``j`` it fetches the codes whose segment
differs in exactly ``r`` bits. After radius ``r`` in the first ``j`` segments every code within
``m * r + j - 1`` bits has been fetched, so a query is done once its k-th verified distance is at
most that. Fetched codes are verified at once, against the k-th distance known so far. A query whose
fetches have cost as much as a comparison with all codes is compared with all of them instead.

Queries are dealt to blocks, one to a task, and codes to shards of a bounded number of rows. A task meets one shard after the
other: it builds the shard's indexes, looks its queries up and goes on with the k-th distances found so far.
Neither probes nor fetched codes leave the task, and nothing is broadcast: codes travel as packed rows of about 1 MiB,
once for each block.

A code has as many bits as the vectors have dimensions, in 64-bit words; no segment crosses a word. Vectors of different
lengths have no distance and are refused. Of equal codes
the ``k`` least ids are kept, which are all that a result can show: ties in distance go to the lesser
id. A query finds itself too. Rows whose vector or id is null are neither searched nor found; repeated ids
are entries each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlens.session import stage

K = 10
QUERY_STEP = 20
# Codes of one word in a shard; queries in a block.
SHARD_ROWS = 1 << 21
BLOCK_ROWS = 1 << 16
# Blocks are smaller while there are fewer of them than this for each core, but none has fewer queries than LEAST_BLOCK.
BLOCKS_PER_CORE = 3
LEAST_BLOCK = 1 << 9
PACKED_WORDS = 1 << 16
# Codes that are verified at a time, and pairs found between two looks at the k-th distances.
PIECE = 1 << 16
HELD = 1 << 17
# Nanoseconds of a probe, of a word of a fetched code, and of one in a comparison with all codes.
PROBE_COST, FETCH_COST, SCAN_COST = 30, 6, 3


def code(vector: Column, bits: int) -> Column:
    """The signs of the dimensions as an array of longs, 64 to a word."""
    def word(start: int) -> Column:
        places = F.sequence(F.lit(0), F.lit(min(64, bits - start) - 1))
        signs = F.transform(places, lambda p: F.when(F.get(vector, p + F.lit(start)) > 0, F.call_function("shiftleft", F.lit(1).cast("long"), p)).otherwise(F.lit(0).cast("long")))
        return F.aggregate(signs, F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))
    return F.array(*[word(start) for start in range(0, bits, 64)])


def dimensions(vectors: DataFrame) -> int:
    """The one length of the vectors, 0 if there are none."""
    least, most = vectors.agg(F.min(F.size("embedding")), F.max(F.size("embedding"))).first()
    if least != most:
        raise ValueError(f"vectors of {least} to {most} dimensions have no common codes")
    return most or 0


def segments(bits: int, rows: int) -> list[tuple[int, int]]:
    """Start and width of each segment: about as many bits as the logarithm of the table's size, as the method asks."""
    out = []
    for start in range(0, bits, 64):
        own = min(64, bits - start)
        m = min(own, max(1, math.ceil(own / math.log2(max(rows, 4)))))
        base, more = divmod(own, m)
        at = start
        for j in range(m):
            width = base + (j < more)
            out.append((at, width))
            at += width
    # The search ends with the radius of its first segment, so that has to be a widest one.
    return sorted(out, key=lambda cut: -cut[1])


def _flips(width: int, radius: int) -> list[int]:
    return [sum(1 << b for b in chosen) for chosen in combinations(range(width), radius)]


def _segment(codes: np.ndarray, start: int, width: int) -> np.ndarray:
    """The bits of a segment as a place in its index; codes have a row for each word."""
    part = codes[start // 64] >> np.uint64(start % 64)
    return (part & np.uint64((1 << width) - 1)).astype(np.int64)


class Index:
    """Codes in the order of a segment, in lines of equal length: each of its values begins a line and has as many as it needs."""

    def __init__(self, codes: np.ndarray, start: int, width: int):
        slots = _segment(codes, start, width)
        order = np.argsort(slots, kind="stable")
        count = np.bincount(slots, minlength=1 << width)
        mean = len(slots) / len(count)
        self.length = math.ceil(mean + math.sqrt(mean))
        self.edges = np.concatenate(([0], np.cumsum(-(-count // self.length))))
        slots = slots[order]
        cells = self.edges[slots] * self.length + np.arange(len(slots)) - (np.cumsum(count) - count)[slots]
        shape = (int(self.edges[-1]), self.length)
        self.place = np.full(shape, -1, np.int32)
        self.place.reshape(-1)[cells] = order
        self.codes = [np.zeros(shape, np.uint64) for _ in codes]
        for lines, word in zip(self.codes, codes):
            lines.reshape(-1)[cells] = word[order]


class Shard:
    """Codes in the order of their ids, a row for each word, and an index for every segment, made when it is first used."""

    def __init__(self, codes: np.ndarray, ids: np.ndarray, bits: int):
        order = np.argsort(ids, kind="stable")
        self.codes, self.ids = codes[:, order], ids[order]
        self.cuts = segments(bits, len(ids))
        self._indexes: dict[int, Index] = {}

    def index(self, j: int) -> Index:
        if j not in self._indexes:
            self._indexes[j] = Index(self.codes, *self.cuts[j])
        return self._indexes[j]


class Nearest:
    """The ``k`` nearest places of each query in a shard, as ``distance << 32 | place``; ``kth`` bounds what is looked for."""

    NONE = np.iinfo(np.int64).max

    def __init__(self, kth: np.ndarray, k: int):
        self.k, self.kth = k, kth.copy()
        self.keys = np.full((len(kth), k), self.NONE, np.int64)
        self.new, self.held, self.merges = [], 0, 0

    def add(self, query: np.ndarray, distance: np.ndarray, place: np.ndarray) -> None:
        self.new.append((query, distance.astype(np.int64) << 32 | place))
        self.held += len(query)
        if self.held >= HELD:
            self.merge()

    def merge(self) -> None:
        """Pairs that several segments reach count once."""
        if not self.held:
            return
        query, key = (np.concatenate(x) for x in zip(*self.new))
        self.new, self.held, self.merges = [], 0, self.merges + 1
        mine, owner = np.unique(query, return_inverse=True)
        owner = np.concatenate((owner, np.repeat(np.arange(len(mine)), self.k)))
        key = np.concatenate((key, self.keys[mine].ravel()))
        sort = np.lexsort((key, owner))
        owner, key = owner[sort], key[sort]
        fresh = np.concatenate(([True], (owner[1:] != owner[:-1]) | (key[1:] != key[:-1])))
        owner, key = owner[fresh], key[fresh]
        rank = np.arange(len(owner)) - np.searchsorted(owner, owner, "left")
        kept = rank < self.k
        best = np.full((len(mine), self.k), self.NONE, np.int64)
        best[owner[kept], rank[kept]] = key[kept]
        self.keys[mine] = best
        full = best[:, -1] != self.NONE
        self.kth[mine[full]] = np.minimum(self.kth[mine[full]], (best[full, -1] >> 32).astype(self.kth.dtype))


class Verifier:
    """Lines of codes against the query of each line, in arrays that are used again."""

    def __init__(self, lines: int, length: int, words: int):
        # The marks are looked through eight at a time.
        self.lines, self.marks = (lines, length), np.zeros(-(-lines * length // 8) * 8, bool)
        self.codes, self.counts = np.empty(self.lines, np.uint64), np.empty(self.lines, np.uint8)
        self.sums = np.empty(self.lines, np.uint16 if words < 1024 else np.int32) if words > 1 else None

    def fetched(self, words: list[np.ndarray], lines: np.ndarray, own: np.ndarray, most: int):
        """Line, column and distance of the codes of an index that differ in ``most`` bits or fewer."""
        # Clipping changes nothing; without it numpy copies once more.
        return self._near((word.take(lines, axis=0, out=self.codes[: len(lines)], mode="clip") for word in words), own, (len(lines), self.lines[1]), most)

    def compared(self, codes: np.ndarray, own: np.ndarray, most: int):
        """The same for one line of codes that all queries meet."""
        return self._near(codes, own, (own.shape[1], codes.shape[1]), most)

    def _near(self, words, own: np.ndarray, shape: tuple[int, int], most: int):
        of = (slice(shape[0]), slice(shape[1]))
        for k, (word, query) in enumerate(zip(words, own)):
            distance = np.bitwise_count(np.bitwise_xor(word, query[:, None], out=self.codes[of]), out=self.counts[of])
            if self.sums is not None:
                distance = np.add(self.sums[of] if k else 0, distance, out=self.sums[of])
        size = shape[0] * shape[1]
        np.less_equal(distance, most, out=self.marks[:size].reshape(shape))
        self.marks[size : -(-size // 8) * 8] = False
        eights = np.flatnonzero(self.marks[: -(-size // 8) * 8].view(np.uint64))
        line, column = np.divmod(((eights * 8)[:, None] + np.arange(8))[self.marks.reshape(-1, 8)[eights]], shape[1])
        return line, column, distance[line, column]


def _fetch(index: Index, cut: tuple[int, int], flips: list[int], queries: np.ndarray, alive: np.ndarray, best: Nearest, spent: np.ndarray) -> None:
    """Verify the codes whose segment differs from a query's in these bits."""
    step = max(1, PIECE // index.length)
    verifier = Verifier(step, index.length, len(queries))
    alive = alive[np.argsort(best.kth[alive], kind="stable")]
    for first in range(0, len(alive), step):
        some = alive[first : first + step]
        own, every = queries.take(some, axis=1), np.arange(len(some))
        slots, fetched, merges = _segment(own, *cut), np.zeros(len(some), np.int64), -1
        for flip in flips:
            if best.merges != merges:
                kth, merges = best.kth[some], best.merges
                most = kth.max()
            probe = slots ^ flip
            low = index.edges.take(probe)
            count = index.edges.take(probe + 1) - low
            fetched += count
            who = np.repeat(every, count)
            lines = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(len(who))
            for at in range(0, len(who), step):  # more than one for values that many codes share
                mine, some_lines = who[at : at + step], lines[at : at + step]
                line, column, distance = verifier.fetched(index.codes, some_lines, own.take(mine, axis=1), most)
                query, place = mine[line], index.place[some_lines[line], column]
                real = np.flatnonzero((place >= 0) & (distance <= kth[query]))
                if len(real):
                    best.add(some[query[real]], distance[real], place[real])
        spent[some] += len(flips) * PROBE_COST + fetched * (index.length * FETCH_COST * len(queries))
    best.merge()


def _scan(shard: Shard, queries: np.ndarray, left: np.ndarray, best: Nearest) -> None:
    """Compare queries with all codes of a shard."""
    step = PIECE // 8
    verifier = Verifier(8, step, len(queries))
    left = left[np.argsort(best.kth[left], kind="stable")]
    for first in range(0, len(left), 8):
        some = left[first : first + 8]
        own = queries.take(some, axis=1)
        for at in range(0, len(shard.ids), step):
            line, place, distance = verifier.compared(shard.codes[:, at : at + step], own, best.kth[some].max())
            near = np.flatnonzero(distance <= best.kth[some[line]])
            if len(near):
                best.add(some[line[near]], distance[near], place[near] + at)
            if best.held >= step:
                best.merge()
    best.merge()


def search_shard(shard: Shard, queries: np.ndarray, kth: np.ndarray, k: int) -> np.ndarray:
    """``distance << 32 | place`` of the ``k`` nearest codes of a shard for each query, of those within its ``kth`` distance all that count."""
    best, cuts, rows = Nearest(kth, k), shard.cuts, len(shard.ids)
    words, asked = queries.shape
    spent, scan = np.zeros(asked, np.int64), rows * words * SCAN_COST
    alive = np.arange(asked)
    for radius in range(cuts[0][1] + 1):
        for j, (_, width) in enumerate(cuts):
            if radius <= width:
                ahead = math.comb(width, radius) * (PROBE_COST + FETCH_COST * words * rows / (1 << width))
                dear = spent[alive] + ahead > scan
                _scan(shard, queries, alive[dear], best)
                alive = alive[~dear]
                if len(alive):
                    _fetch(shard.index(j), cuts[j], _flips(width, radius), queries, alive, best, spent)
            alive = alive[best.kth[alive] > len(cuts) * radius + j]
            if not len(alive):
                return best.keys
    return best.keys


class Block:
    """The queries of a task and their nearest rows in the shards met so far."""

    def __init__(self, queries: np.ndarray, bits: int, k: int):
        # Queries with like segments use like parts of an index.
        self.queries = queries[:, np.argsort(queries[0] & np.uint64(0xFFFF), kind="stable")]
        self.bits, self.k = bits, k
        shape = (self.queries.shape[1], k)
        self.distance, self.ids = np.full(shape, bits + 1, np.int32), np.zeros(shape, np.int64)

    def meet(self, codes: np.ndarray, ids: np.ndarray) -> None:
        shard = Shard(codes, ids, self.bits)
        # Everything is within ``bits``; counts of bits fit into the lesser type where they are a byte each.
        kth = np.minimum(self.distance[:, -1], self.bits).astype(np.uint8 if self.bits <= 64 else np.int32)
        keys = search_shard(shard, self.queries, kth, self.k)
        found = keys != Nearest.NONE
        distance = np.concatenate((self.distance, np.where(found, keys >> 32, self.bits + 1).astype(np.int32)), 1)
        ids = np.concatenate((self.ids, np.where(found, shard.ids[np.where(found, keys & 0xFFFFFFFF, 0)], 0)), 1)
        order = np.lexsort((ids, distance), axis=-1)[:, : self.k]
        self.distance, self.ids = np.take_along_axis(distance, order, 1), np.take_along_axis(ids, order, 1)

    def results(self) -> Iterator[pa.RecordBatch]:
        words, step = len(self.queries), BLOCK_ROWS // 8
        for first in range(0, len(self.distance), step):
            distance = self.distance[first : first + step]
            query, rank = np.nonzero(distance <= self.bits)
            flat = self.queries[:, first + query].T.reshape(-1).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, words, dtype=np.int32)), pa.array(flat)), pa.array((rank + 1).astype(np.int32)),
                 pa.array(self.ids[first + query, rank]), pa.array(distance[query, rank])], ["query", "rank", "vec_id", "distance"])


def _packed(words: int):
    """Codes and their ids as rows of bytes, each of one part."""
    def row(part: int, codes: list[np.ndarray], ids: list[np.ndarray]):
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([np.concatenate(codes).tobytes()], pa.binary()), pa.array([np.concatenate(ids).tobytes()], pa.binary())], ["part", "codes", "ids"])

    def run(batches):
        held: dict[int, tuple[list, list]] = {}
        for batch in batches:
            codes = batch.column("code").flatten().to_numpy(zero_copy_only=False).reshape(-1, words)
            parts, ids = (batch.column(name).to_numpy() for name in ("part", "vec_id"))
            for part in np.unique(parts).tolist():
                mine = np.flatnonzero(parts == part)
                own = held.setdefault(part, ([], []))
                own[0].append(codes[mine])
                own[1].append(ids[mine])
                if sum(map(len, own[1])) * words >= PACKED_WORDS:
                    yield row(part, *held.pop(part))
        for part, own in held.items():
            yield row(part, *own)
    return run


def _search(bits: int, k: int):
    """The nearest rows of a block's queries: its queries come first, as part -1, then shard after shard."""
    words = -(-bits // 64)

    def values(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
        codes, ids = (b"".join(x) for x in zip(*rows))
        return np.ascontiguousarray(np.frombuffer(codes, np.uint64).reshape(-1, words).T), np.frombuffer(ids, np.int64)

    def pieces(batches):
        for batch in batches:
            names = zip(*(batch.column(c).to_pylist() for c in ("block", "part")))
            yield from zip(names, ([x.as_buffer() for x in row] for row in zip(batch.column("codes"), batch.column("ids"))))

    def run(batches):
        block, held, at = None, [], None
        for name, row in pieces(batches):
            if name != at:
                if held:
                    block = met(block, at, held)
                if block and name[0] != at[0]:
                    yield from block.results()
                    block = None
                held, at = [], name
            held.append(row)
        if held:
            block = met(block, at, held)
        if block:
            yield from block.results()

    def met(block: Block | None, at: tuple[int, int], rows: list[tuple]) -> Block | None:
        codes, ids = values(rows)
        if at[1] < 0:
            return Block(codes, bits, k)
        if block:
            block.meet(codes, ids)
        return block
    return run


def _parts(entries: int, asked: int, words: int, cores: int) -> tuple[int, int]:
    """Numbers of shards and of blocks."""
    # An index has all words of a code for each segment.
    shards = -(-entries * words * (words + 1) // (2 * SHARD_ROWS))
    return max(1, shards), max(1, -(-asked // BLOCK_ROWS), min(BLOCKS_PER_CORE * cores, asked // LEAST_BLOCK))


def search(vectors: DataFrame, k: int = K, step: int = QUERY_STEP, bits: int | None = None) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``distance``: the k nearest of all rows for every row whose id divides by ``step``.

    ``bits`` is the number of dimensions, if it is known; a pass over the vectors finds it and checks that it is one.
    """
    usable = vectors.filter("vec_id is not null and embedding is not null")
    found_bits = dimensions(usable)
    if bits is not None and found_bits not in (0, bits):
        raise ValueError(f"vectors of {found_bits} dimensions, not {bits}")
    bits = max(1, found_bits or bits or 1)
    words = -(-bits // 64)
    rows = usable.select(
        F.col("vec_id").cast("long").alias("vec_id"), code(F.col("embedding"), bits).alias("code"))
    rows = stage(rows, "codes")
    # The group limit before the shuffle keeps a code that a third of all rows share at k rows per task.
    first = rows.withColumn("place", F.row_number().over(Window.partitionBy("code").orderBy("vec_id"))).filter(F.col("place") <= k)
    entries = stage(first.select("code", "vec_id"), "code-entries")
    # Equal query codes have equal results: each is searched once.
    asked = stage(rows.filter(F.col("vec_id") % step == 0).select("code").distinct(), "asked")
    shards, blocks = _parts(entries.count(), asked.count(), words, rows.sparkSession.sparkContext.defaultParallelism)
    part = lambda parts: F.pmod(F.xxhash64("code"), F.lit(parts)).cast("int").alias("part")
    pack = lambda table: table.mapInArrow(_packed(words), "part int, codes binary, ids binary")
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    codes = pack(entries.select("code", "vec_id", part(shards))).select(every, "part", "codes", "ids")
    queries = pack(asked.select("code", F.lit(0).cast("long").alias("vec_id"), part(blocks))).select(F.col("part").alias("block"), F.lit(-1).alias("part"), "codes", "ids")
    tasks = codes.union(queries).repartitionById(blocks, "block").sortWithinPartitions("block", "part")
    found = stage(tasks.mapInArrow(_search(bits, k), "query array<long>, rank int, vec_id long, distance int"), "nearest")
    wanted = rows.filter(F.col("vec_id") % step == 0).select(F.col("vec_id").alias("query_id"), F.col("code").alias("query"))
    # Spark sizes both sides by their packed files and could broadcast what is many times as large in memory.
    return wanted.join(found.hint("merge"), "query").select("query_id", "rank", "vec_id", "distance")


ORACLE = """
WITH codes AS (SELECT vec_id, list_sum(list_transform(range(64), lambda i: CASE WHEN embedding[i + 1] > 0 THEN pow(2::DOUBLE, i)::HUGEINT ELSE 0::HUGEINT END))::HUGEINT AS code
    FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
pairs AS (SELECT q.vec_id AS query_id, x.vec_id, CAST(bit_count(xor(q.code, x.code)) AS INTEGER) AS distance
    FROM codes q, codes x WHERE q.vec_id % 20 = 0),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS INTEGER) AS rank FROM pairs)
SELECT query_id, rank, vec_id, distance FROM ranked WHERE rank <= 10"""
