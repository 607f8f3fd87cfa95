"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

A text becomes blanks-as-``▁`` symbols behind one leading ``▁``. Adjacent pairs whose joined piece is in
the vocabulary stand in an agenda ordered by score, leftmost first among equals; the best pair is
merged and the pairs with its new neighbours join the agenda, until none is left. A symbol outside
the vocabulary falls back to its UTF-8 bytes. Short segments are merged many at once, each with a row
of a matrix as its agenda; long and unusual ones use a heap.

No piece of such a vocabulary goes across the start of a ``▁`` run or across a line feed, so the text is
cut there and equal segments are encoded once per worker; where a vocabulary has such pieces, texts
stay whole. Every segment met for the first time, and one whole text of each Arrow batch, is compared with
the sentencepiece library; a difference ends the job.

A null text is read as the empty one, which has no ids and decodes to the empty text. Rows are independent: ties,
repeated rows, empty tables and other columns change nothing.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Segments kept per worker, and the longest one kept.
KEPT = 500_000
KEPT_LENGTH = 48
# Texts whose new segments are merged together.
TOGETHER = 256
SPACE = "▁"


class Encoder:
    """One model: ids of texts and texts of ids."""

    def __init__(self, model: str):
        from sentencepiece import SentencePieceProcessor

        self.library = SentencePieceProcessor(model_file=model)
        count = self.library.get_piece_size()
        self.pieces = [self.library.id_to_piece(k) for k in range(count)]
        special = [self.library.is_control(k) or self.library.is_unknown(k) or self.library.is_byte(k) for k in range(count)]
        self.ids = {piece: k for k, piece in enumerate(self.pieces) if not special[k]}
        self.rank = {piece: -self.library.get_score(k) for piece, k in self.ids.items()}
        self.bytes = {}
        for k in range(count):
            if self.library.is_byte(k):
                self.bytes[int(self.pieces[k][3:5], 16)] = k
        self.byte_of = {k: bytes([value]) for value, k in self.bytes.items()}
        self.shown = [None if self.library.is_byte(k) else "" if self.library.is_control(k)
                      else " \u2047 " if self.library.is_unknown(k) else self.pieces[k].replace(SPACE, " ") for k in range(count)]
        crossing = any(SPACE in piece.lstrip(SPACE) or ("\n" in piece and piece != "\n") for piece in self.ids)
        self.cut = re.compile(".+" if crossing else f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n", re.S)
        self.known_ids: dict[str, bytes] = {}
        self.known_surface: dict[str, bytes] = {}
        self._tabulate()

    def _tabulate(self) -> None:
        """Symbols by number: the pieces, then single letters of pieces that are none; what each pair merges to."""
        symbols = list(self.ids)
        symbols += sorted({letter for piece in symbols for letter in piece} - set(symbols))
        number = {symbol: k for k, symbol in enumerate(symbols)}
        self.letter = np.full(0x110000, -1, np.int32)
        for symbol, k in number.items():
            if len(symbol) == 1:
                self.letter[ord(symbol)] = k
        self.letters = {symbol for symbol in symbols if len(symbol) == 1} - {"\0"}
        pairs = sorted((number[piece[:k]] * len(symbols) + number[piece[k:]], number[piece])
                       for piece in self.ids for k in range(1, len(piece)) if piece[:k] in number and piece[k:] in number)
        self.pair = np.array([p for p, _ in pairs] or [-1], np.int64)
        self.merged = np.array([m for _, m in pairs] or [0], np.int32)
        self.order = np.array([self.rank.get(symbol, np.inf) for symbol in symbols])
        self.numbers = [",".join(map(str, self._final(symbol))).encode() for symbol in symbols]
        self.bytes_of = [self.surface(self._final(symbol)) for symbol in symbols]
        self.count = len(symbols)

    def _final(self, symbol: str) -> list[int]:
        k = self.ids.get(symbol)
        return [k] if k is not None else [self.bytes[b] for b in symbol.encode()]

    def _joined(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and number of what two symbols merge to; an infinite rank if to nothing."""
        wanted = left.astype(np.int64) * self.count + right
        place = np.minimum(np.searchsorted(self.pair, wanted), len(self.pair) - 1)
        merged = self.merged[place]
        return np.where((self.pair[place] == wanted) & (left >= 0) & (right >= 0), self.order[merged], np.inf), merged

    def merge_many(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbol numbers of all segments in a row, and how many each has; every letter is in a piece."""
        count, length = len(segments), max(map(len, segments))
        sizes = np.array([len(s) for s in segments])
        symbols = np.full((count, length + 1), -1, np.int32)
        symbols[:, :length] = self.letter[np.array(segments, f"<U{length}").view(np.uint32).reshape(count, length)]
        symbols[np.arange(length + 1) >= sizes[:, None]] = -1
        after = np.tile(np.arange(1, length + 2), (count, 1))
        before = np.tile(np.arange(-1, length), (count, 1))
        agenda, target = self._joined(symbols[:, :-1], symbols[:, 1:])
        rows = np.arange(count)
        while len(rows):
            left = agenda[rows].argmin(axis=1)
            open_ = np.isfinite(agenda[rows, left])
            rows, left = rows[open_], left[open_]
            right = after[rows, left]
            far = np.minimum(after[rows, right], length)
            symbols[rows, left] = target[rows, left]
            symbols[rows, right] = -1
            agenda[rows, np.minimum(right, length - 1)] = np.inf
            after[rows, left] = far
            before[rows, far] = left
            agenda[rows, left], target[rows, left] = self._joined(symbols[rows, left], symbols[rows, far])
            near = before[rows, left]
            inner = near >= 0
            r, n = rows[inner], near[inner]
            agenda[r, n], target[r, n] = self._joined(symbols[r, n], symbols[r, left[inner]])
        there = symbols >= 0
        return symbols[there], there.sum(axis=1)

    def merge(self, text: str) -> list[int]:
        """Ids of a text whose blanks are ``▁`` already."""
        rank, ids = self.rank, self.ids
        symbols = list(text)
        count = len(symbols)
        agenda = []
        for k in range(count - 1):
            place = rank.get(symbols[k] + symbols[k + 1])
            if place is not None:
                agenda.append((place, k, k + 1, 2))
        if agenda:
            heapify(agenda)
            after, before = list(range(1, count + 1)), list(range(-1, count - 1))
            while agenda:
                _, left, right, size = heappop(agenda)
                one, two = symbols[left], symbols[right]
                # Out of date if a side has been merged since.
                if one is None or two is None or len(one) + len(two) != size:
                    continue
                symbols[left] = joined = one + two
                symbols[right] = None
                after[left] = far = after[right]
                if far < count:
                    before[far] = left
                    place = rank.get(joined + symbols[far])
                    if place is not None:
                        heappush(agenda, (place, left, far, size + len(symbols[far])))
                near = before[left]
                if near >= 0:
                    place = rank.get(symbols[near] + joined)
                    if place is not None:
                        heappush(agenda, (place, near, left, size + len(symbols[near])))
        out = []
        for symbol in symbols:
            if symbol is not None:
                k = ids.get(symbol)
                if k is None:
                    out.extend([self.bytes[b] for b in symbol.encode()])
                else:
                    out.append(k)
        return out

    def encode(self, text: str) -> list[int]:
        ids = []
        for segment in self.segments(text):
            ids.extend(self.merge(segment))
        return ids

    def segments(self, text: str) -> list[str]:
        return self.cut.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def surface(self, ids: list[int]) -> bytes:
        """UTF-8 of the pieces, with blanks, leading one included; bytes that are no UTF-8 become U+FFFD."""
        parts = [self.shown[k] for k in ids]
        if None not in parts:
            return "".join(parts).encode()
        out, held = [], b""
        for k, part in zip(ids, parts):
            if part is None:
                held += self.byte_of[k]
                continue
            out += [_valid(held), part]
            held = b""
        return ("".join(out) + _valid(held)).encode()

    def decode(self, ids: list[int]) -> str:
        text = self.surface(ids).decode()
        return text.removeprefix(" ") if ids and self.pieces[ids[0]].startswith(SPACE) else text

    def learn(self, segments: list[str]) -> None:
        """Keep ids (as text) and surface of segments, each compared with the library."""
        plain, odd = [], []
        for s in segments:
            (plain if len(s) <= KEPT_LENGTH and self.letters.issuperset(s) else odd).append(s)
        ids_of, surface_of = self.known_ids, self.known_surface
        plain.sort(key=len)
        for at in range(0, len(plain), 4096):
            part = plain[at : at + 4096]
            symbols, counts = self.merge_many(part)
            symbols, end = symbols.tolist(), 0
            for segment, count in zip(part, counts.tolist()):
                own = symbols[end : end + count]
                end += count
                ids_of[segment] = b",".join([self.numbers[k] for k in own])
                surface_of[segment] = b"".join([self.bytes_of[k] for k in own])
        for segment in odd:
            ids = self.merge(segment)
            ids_of[segment], surface_of[segment] = ",".join(map(str, ids)).encode(), self.surface(ids)
        # Behind a line feed the library's own leading blank stands apart; an empty text has none.
        asked = [s for s in segments if s != SPACE]
        texts = [s[1:].replace(SPACE, " ") if s[0] == SPACE else "\n" + s for s in asked]
        for segment, theirs in zip(asked, self.library.encode(texts, num_threads=1)):
            if ids_of[segment] != ",".join(map(str, theirs if segment[0] == SPACE else theirs[2:])).encode():
                raise ValueError(f"differs from the library: {segment!r}: {ids_of[segment]} and {theirs}")

    def digests(self, texts: list[str]):
        """Of every text: number of ids, the ids as text, the decoded bytes."""
        cut = [self.segments(text) for text in texts]
        ids_of, surface_of = self.known_ids, self.known_surface
        new = set().union(*cut).difference(ids_of)
        if len(ids_of) + len(new) > KEPT:
            ids_of.clear()
            surface_of.clear()
            new = set().union(*cut)
        self.learn(list(new))
        for segments in cut:
            ids = b",".join([ids_of[s] for s in segments])
            yield ids.count(b",") + 1 if ids else 0, ids, b"".join([surface_of[s] for s in segments]).removeprefix(b" ")
        for segment in new:
            if len(segment) > KEPT_LENGTH:
                del ids_of[segment], surface_of[segment]


def _valid(raw: bytes) -> str:
    """UTF-8 text; every byte that belongs to no code point is one U+FFFD."""
    out = []
    while raw:
        try:
            out.append(raw.decode())
            break
        except UnicodeDecodeError as error:
            out.append(raw[: error.start].decode() + "�")
            raw = raw[error.start + 1 :]
    return "".join(out)


@lru_cache(maxsize=2)
def encoder(model: str) -> Encoder:
    """The model of this worker process."""
    return Encoder(model)


def _digests(model: str):
    def run(parts):
        own = encoder(model)
        for batch in parts:
            texts = [text or "" for text in batch.column("text").to_pylist()]
            counts, ids, decoded = [], [], []
            for at in range(0, len(texts), TOGETHER):
                for n, joined, surface in own.digests(texts[at : at + TOGETHER]):
                    if not counts and joined != ",".join(map(str, own.library.encode(texts[0]))).encode():
                        raise ValueError(f"differs from the library: {texts[0][:200]!r}")
                    counts.append(n)
                    ids.append(hashlib.sha256(joined).hexdigest())
                    decoded.append(hashlib.sha256(surface).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return run


def _encoded(model: str):
    def run(parts):
        own = encoder(model)
        for batch in parts:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([own.encode(t or "") for t in batch.column("text").to_pylist()], pa.list_(pa.int32()))],
                ["doc_id", "ids"])
    return run


def _decoded(model: str):
    def run(parts):
        own = encoder(model)
        for batch in parts:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([own.decode(i or []) for i in batch.column("ids").to_pylist()], pa.string())],
                ["doc_id", "text"])
    return run


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def encode(docs: DataFrame, model: str) -> DataFrame:
    """``doc_id``, ``ids``: the ids of every text."""
    return _texts(docs).mapInArrow(_encoded(model), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """``doc_id``, ``text`` of rows with ``doc_id`` and ``ids``."""
    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids")).mapInArrow(
        _decoded(model), "doc_id long, text string")


def round_trip(docs: DataFrame, model: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``: every text encoded, then decoded."""
    return _texts(docs).mapInArrow(_digests(model), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
