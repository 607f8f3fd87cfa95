"""Documents packed into token sequences of fixed length by best-two-fit.

A document is its token ids and an end id. Only a document longer than a sequence is cut, into full pieces
and a last, shorter one. A full piece is a sequence. The others are dealt at random into cells of
bounded size, and every cell is packed on its own: a sequence is filled greedily, largest piece that fits first;
then its smallest piece is exchanged for two unpacked pieces that fit the gap widened by it more tightly, if there are such.
A cell leaves at most one badly filled sequence, so the loss does not grow with the table.

A null text is read as the empty one: its document is the end id alone. Rows that repeat a ``doc_id`` are
packed one by one; a null ``doc_id`` is packed like any other. An empty table gives no pieces.
"""

from __future__ import annotations

import json
import unicodedata
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.session import stage

LENGTH = 4096
END_ID = 1
CELL_PIECES = 16_384
# Words and their pieces kept per worker; both tables stay with a worker between tasks.
KEPT = 150_000
KEPT_PIECES = 300_000
# Marks that end a word and belong to no piece of letters.
STOPS = ".,;:!?"


class WordTokens:
    """Ids of blank-separated words by a ``tokenizers`` file whose pre-tokenizer drops white space.

    Normaliser and split pattern never look across white space there, so words are encoded once and kept.
    Plain words go to the library's model directly; a word with an added token such as ``<|endoftext|>``,
    whose lower case depends on its neighbours or whose code points are not composed goes through the whole library.
    """

    def __init__(self, file: str):
        import regex
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(file)
        with open(file) as text:
            parts = json.load(text)["pre_tokenizer"]["pretokenizers"]
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        pattern = next(p["pattern"]["Regex"] for p in parts if p["type"] == "Split")
        self.split = regex.compile(pattern)
        # By such a pattern a run of letters is one piece and so is a run of marks, so most words need no search.
        self.letters_are_one = r"[\p{L}]+" in pattern and r"[^\s\p{L}\p{N}]+" in pattern
        # Letters whose lower case hangs on their neighbours, and blanks beyond ASCII.
        self.odd = regex.compile(r"[Σİ\x1C-\x1F]|[^\S\x00-\x7F]")
        self.model = self.library.model
        self.bytes = str.maketrans({chr(b): c for b, c in _byte_letters().items()})
        self.words: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def by_library(self, text: str) -> bytes:
        return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()

    def is_plain(self, text: str) -> bool:
        """Words of the text can go to the model by themselves."""
        return not any(token in text for token in self.added) and (text.isascii() or not self.odd.search(text) and unicodedata.is_normalized("NFC", text))

    def learn(self, words) -> None:
        """Keep the ids of plain words."""
        known, pieces, model, whole = self.words, self.pieces, self.model, self.letters_are_one
        for word in words:
            text = word.decode().lower()
            core = text.rstrip(STOPS)
            if not whole or not core.isalpha():
                found = self.split.findall(text)
            elif len(core) == len(text):
                found = (text,)
            else:
                found = (core, text[len(core):])
            total = b""
            for piece in found:
                ids = pieces.get(piece)
                if ids is None:
                    letters = piece if piece.isascii() and piece.isprintable() else piece.encode().decode("latin-1").translate(self.bytes)
                    ids = pieces[piece] = array("I", [t.id for t in model.tokenize(letters)]).tobytes()
                total += ids
            known[word] = total

    def of_text(self, text: bytes) -> bytes:
        """Little-endian unsigned 32-bit ids of a whole text."""
        words, known = text.split(), self.words
        new = set(words).difference(known)
        if new:
            if len(known) + len(new) > KEPT:
                known.clear()
                new = set(words)
            if len(self.pieces) > KEPT_PIECES:
                self.pieces.clear()
            if not self.is_plain(text.decode()):
                special = {word for word in new if not self.is_plain(word.decode())}
                known.update((word, self.by_library(word.decode())) for word in special)
                new -= special
            self.learn(new)
        return b"".join(map(known.__getitem__, words))


def _byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies write for each byte."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in kept]
    return {b: chr(b) for b in kept} | {b: chr(256 + k) for k, b in enumerate(rest)}


@lru_cache(maxsize=2)
def word_tokens(file: str) -> WordTokens:
    return WordTokens(file)


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _pieces(file: str, length: int, end: int):
    def run(parts):
        own = word_tokens(file)
        tail = np.array([end], "<u4").tobytes()
        for batch in parts:
            columns = [[], [], [], [], []]
            texts = batch.column("text").cast(pa.large_binary()).to_pylist()
            for k, (doc_id, text) in enumerate(zip(batch.column("doc_id").to_pylist(), texts)):
                text = text or b""
                ids = own.of_text(text)
                if k == 0 and ids != own.by_library(text.decode()):
                    raise ValueError(f"differs from the library: {text[:200]!r}")
                ids += tail
                for number, at in enumerate(range(0, len(ids), 4 * length)):
                    part = ids[at : at + 4 * length]
                    for column, value in zip(columns, (doc_id, number, at // 4, len(part) // 4, zlib.crc32(part))):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                ["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def best_two_fit(lengths: np.ndarray, capacity: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of every piece.

    Pieces of one length are interchangeable, so the search goes over the lengths still unpacked.
    """
    by_length: dict[int, list[int]] = {}
    for place in np.argsort(lengths, kind="stable")[::-1]:
        by_length.setdefault(int(lengths[place]), []).append(int(place))
    left = np.zeros(capacity + 1, np.int64)
    for size, places in by_length.items():
        left[size] = len(places)
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    there = np.flatnonzero(left)  # lengths with unpacked pieces, rising
    number, remaining = 0, len(lengths)
    while remaining:
        chosen, gap = [], capacity
        while gap and len(there):
            k = int(np.searchsorted(there, gap, "right")) - 1
            if k < 0:
                break
            size = int(there[k])
            chosen.append(size)
            gap -= size
            left[size] -= 1
            if not left[size]:
                there = np.delete(there, k)
        if gap and len(chosen) and len(there):
            pair = _tightest_pair(there, left, gap + chosen[-1])
            if pair and sum(pair) > chosen[-1]:
                back = chosen.pop()
                left[back] += 1
                for size in pair:
                    left[size] -= 1
                    chosen.append(size)
                there = np.flatnonzero(left)
        at = 0
        for size in chosen:
            place = by_length[size].pop()
            sequence[place], offset[place] = number, at
            at += size
        remaining -= len(chosen)
        number += 1
    return sequence, offset


def _tightest_pair(there: np.ndarray, left: np.ndarray, room: int) -> tuple[int, int] | None:
    """The two unpacked lengths with the largest sum within ``room``; the larger first."""
    small = there[there <= room // 2]
    if not len(small):
        return None
    k = np.searchsorted(there, room - small, "right") - 1
    partner = there[k]
    # One piece cannot be both: a lone length pairs with the next smaller one.
    lone = (partner == small) & (left[small] < 2)
    partner = np.where(lone, np.where(k > 0, there[np.maximum(k - 1, 0)], -capacity_bound(room)), partner)
    total = small + partner
    best = int(np.argmax(total))
    return (int(max(small[best], partner[best])), int(min(small[best], partner[best]))) if total[best] > 0 else None


def capacity_bound(room: int) -> int:
    """A value no pair can make up for."""
    return 4 * room


def _pack_cell(length: int):
    def run(cell: pd.DataFrame) -> pd.DataFrame:
        cell = cell.sort_values("row", kind="stable").reset_index(drop=True)
        sequence, offset = best_two_fit(cell["length"].to_numpy(), length)
        cell["sequence_id"] = (cell["cell"].to_numpy() << 32) + sequence
        cell["offset"] = offset
        return cell[["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]]
    return run


def pack(docs: DataFrame, file: str, length: int = LENGTH, end: int = END_ID, cell: int = CELL_PIECES) -> DataFrame:
    """One row per piece: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = stage(texts.mapInArrow(_pieces(file, length, end), PIECES).withColumn("row", F.monotonically_increasing_id()), "pieces")
    cells = max(1, -(-pieces.count() // cell))
    dealt = pieces.withColumn("cell", F.pmod(F.xxhash64("row"), F.lit(cells)))
    return dealt.groupBy("cell").applyInPandas(_pack_cell(length), f"{PIECES}, sequence_id long, offset long")
