"""Licence scans: parts of a text compared with licence templates by the Dice coefficient over word bigrams.

Normalised text: A-Z lower-cased, every other ASCII character that is no letter or digit a blank. The parts of a text are
its lines and the whole text. With sets A and B of distinct bigrams (a single word is a bigram of its
own), Dice is 2 |A and B| / (|A| + |B|); it can reach the limit only if the sizes are within a factor of
(2 - limit) / limit of each other, so a part meets the templates within that range alone.

A null or empty text has no parts and no licence. Ties go to the higher coefficient, then to the lesser
template name. Rows are independent: repeated rows, a null ``doc_id`` and other columns change nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm import batches

LIMIT = 0.8

# Notices by which texts name their licence, and the opening terms of short licences.
TEMPLATES = {
    "apache-2.0": ("Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
                   "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    "bsd-3-clause": ("Licensed under the BSD 3-Clause License.",
                     "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    "cc-by-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "cc-by-nc-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "cc-by-sa-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "gpl-3.0": ("This work is licensed under the GNU General Public License, version 3.",
                "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    "lgpl-3.0": ("This work is licensed under the GNU Lesser General Public License, version 3.",),
    "mit": ("Released under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    "mpl-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
}

_PLAIN = batches.LOWER.copy()
for _byte in range(128):
    if not chr(_byte).isalnum():
        _PLAIN[_byte] = 0x20


def _words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and first bytes of the words of normalised bytes."""
    starts, ends = batches.spans(data != 0x20)
    return batches.span_hashes(data, starts, ends), starts


def _bigrams(words: np.ndarray) -> np.ndarray:
    return batches.grams(words, 2) if len(words) > 1 else batches.grams(words, 1)


class Templates:
    """Bigram sets of all templates: the distinct bigrams in order, and which template has which."""

    def __init__(self, templates: dict[str, tuple[str, ...]], limit: float):
        self.names, sets = [], []
        for name in sorted(templates):
            for text in templates[name]:
                self.names.append(name)
                sets.append(np.unique(_bigrams(_words(_PLAIN[np.frombuffer(text.encode(), np.uint8)])[0])))
        self.known = np.unique(np.concatenate(sets))
        self.has = np.array([np.isin(self.known, s) for s in sets], np.float32).T
        self.sizes = np.array([len(s) for s in sets])
        self.limit, self.factor = limit, (2 - limit) / limit
        self.least = self.sizes.min() / self.factor

    def compare(self, bigrams: np.ndarray, owner: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
        """Best template and coefficient of every part; -1 and 0 for a part that reaches the limit with none.

        ``bigrams`` may repeat within its part ``owner``; parts are numbered from 0 in order.
        """
        order = np.lexsort((bigrams, owner))
        bigrams, owner = bigrams[order], owner[order]
        if len(bigrams):
            new = np.concatenate(([True], (bigrams[1:] != bigrams[:-1]) | (owner[1:] != owner[:-1])))
            bigrams, owner = bigrams[new], owner[new]
        sizes = np.bincount(owner, minlength=count)
        best, dice = np.full(count, -1), np.zeros(count)
        place = np.minimum(np.searchsorted(self.known, bigrams), len(self.known) - 1)
        hit = self.known[place] == bigrams
        parts = np.unique(owner[hit])
        for at in range(0, len(parts), 1024):
            some = parts[at : at + 1024]
            low, high = np.searchsorted(owner, [some[0], some[-1] + 1])
            rows, columns = owner[low:high][hit[low:high]], place[low:high][hit[low:high]]
            matrix = np.zeros((len(some), len(self.known)), np.float32)
            matrix[np.searchsorted(some, rows), columns] = 1
            common = (matrix @ self.has).astype(np.float64)
            own = sizes[some][:, None]
            fits = (own <= self.sizes * self.factor) & (self.sizes <= own * self.factor)
            value = np.where(fits, 2 * common / (own + self.sizes), 0)
            top = value.argmax(axis=1)
            value = value[np.arange(len(some)), top]
            good = value >= self.limit
            best[some[good]], dice[some[good]] = top[good], value[good]
        return best, dice


def _line_parts(chunk: batches.Chunk, model: Templates):
    """Of a chunk: best template and coefficient of each line that may have one, with its text's number and line number."""
    plain = _PLAIN[chunk.data]
    words, at = _words(plain)
    ends = np.flatnonzero(chunk.data == 0x0A)  # of lines; the last line of a text ends at its line feed
    line = np.searchsorted(ends, at)
    count = np.bincount(line, minlength=len(ends))
    edges = np.concatenate(([0], np.cumsum(count)))
    # Distinct bigrams are no more than words; fewer words than the least size cannot reach the limit.
    wanted = np.flatnonzero(count + 1 >= model.least)
    bigrams, owner = _pieces(words, edges, wanted)
    best, dice = model.compare(bigrams, owner, len(wanted))
    text = np.searchsorted(chunk.edges[1:], ends[wanted], "right")
    first = np.searchsorted(ends, chunk.edges[:-1])
    return best, dice, text, wanted - first[text], words, np.searchsorted(at, chunk.edges)


def _pieces(words: np.ndarray, edges: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bigrams of the wanted ranges of words, each with the number of its range."""
    if not len(words):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    sizes = np.diff(edges)[wanted]
    pairs = np.concatenate([batches.grams(words, 2), np.zeros(1, np.uint64)])
    single = batches.grams(words, 1)
    counts = np.where(sizes > 1, sizes - 1, sizes)
    owner = np.repeat(np.arange(len(wanted)), counts)
    inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    place = np.repeat(edges[:-1][wanted], counts) + inside
    return np.where(np.repeat(sizes == 1, counts), single[place], pairs[place]), owner


def _scan(templates: dict[str, tuple[str, ...]], limit: float, every: bool):
    def run(parts):
        model = Templates(templates, limit)
        for batch in parts:
            ids = batch.column("doc_id")
            for chunk in batches.chunks(batch.column("text")):
                best, dice, text, line, words, edges = _line_parts(chunk, model)
                # Words bound distinct bigrams from above only: a long text that repeats a notice has few.
                whole = np.flatnonzero(np.diff(edges) >= model.least)
                whole = whole[np.diff(np.searchsorted(np.flatnonzero(chunk.data == 0x0A), chunk.edges))[whole] > 1]
                more, value = model.compare(*_pieces(words, edges, whole), len(whole))
                best, dice = np.concatenate([best, more]), np.concatenate([dice, value])
                text, line = np.concatenate([text, whole]), np.concatenate([line, np.full(len(whole), -1)])
                hit = best >= 0
                rows = (np.arange(chunk.first, chunk.last)[text[hit]], line[hit], best[hit], dice[hit])
                yield _matches(ids, *rows, model) if every else _summary(ids, chunk, *rows, model)
    return run


def _matches(ids, row, line, best, dice, model) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [ids.take(pa.array(row)), pa.array(line, pa.int64()), pa.array([model.names[k] for k in best], pa.string()), pa.array(dice)],
        ["doc_id", "line", "licence", "dice"])


def _summary(ids, chunk, row, line, best, dice, model) -> pa.RecordBatch:
    count = np.bincount(row - chunk.first, minlength=len(chunk))
    names, top = [None] * len(chunk), [None] * len(chunk)
    for k in np.lexsort((best, -dice, row)):  # templates stand in order of their names
        place = int(row[k]) - chunk.first
        if names[place] is None:
            names[place], top[place] = model.names[best[k]], round(float(dice[k]), 6)
    return pa.RecordBatch.from_arrays(
        [ids.slice(chunk.first, len(chunk)), pa.array(names, pa.string()), pa.array(top, pa.float64()), pa.array(count, pa.int64())],
        ["doc_id", "licence", "dice", "n_matches"])


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def scan(docs: DataFrame, templates=TEMPLATES, limit: float = LIMIT) -> DataFrame:
    """``doc_id``, ``licence``, ``dice``, ``n_matches``: the best licence of each text, and how many of its parts have one."""
    return _texts(docs).mapInArrow(_scan(dict(templates), limit, False), "doc_id long, licence string, dice double, n_matches long")


def matches(docs: DataFrame, templates=TEMPLATES, limit: float = LIMIT) -> DataFrame:
    """``doc_id``, ``line``, ``licence``, ``dice`` of every part with a licence; line -1 is the whole text of several lines."""
    return _texts(docs).mapInArrow(_scan(dict(templates), limit, True), "doc_id long, line long, licence string, dice double")


def _oracle() -> str:
    rows = ", ".join("('%s', %d, '%s')" % (name, k, text.replace("'", "''")) for name in sorted(TEMPLATES) for k, text in enumerate(TEMPLATES[name]))
    words = r"list_filter(string_split_regex(regexp_replace(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]', ' ', 'g'), ' +'), lambda w: w <> '')"
    grams = "list_distinct(CASE WHEN len(w) = 1 THEN w ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END)"
    return f"""
WITH templates AS (SELECT name, number, {grams} AS b FROM (SELECT name, number, {words.format('body')} AS w FROM (VALUES {rows}) t(name, number, body))),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS part FROM documents WHERE text IS NOT NULL),
parts AS (SELECT doc_id, {grams} AS b FROM (
    SELECT doc_id, {words.format('part')} AS w FROM (SELECT * FROM lines UNION ALL SELECT doc_id, text FROM documents WHERE contains(text, chr(10))))
    WHERE len(w) > 0),
numbered AS (SELECT *, row_number() OVER () AS id FROM parts),
compared AS (SELECT p.doc_id, p.id, t.name, t.number, 2.0 * len(list_intersect(p.b, t.b)) / (len(p.b) + len(t.b)) AS dice
    FROM numbered p JOIN templates t ON len(p.b) <= len(t.b) * {(2 - LIMIT) / LIMIT} AND len(t.b) <= len(p.b) * {(2 - LIMIT) / LIMIT}),
best AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY dice DESC, name, number) AS place FROM compared WHERE dice >= {LIMIT}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY dice DESC, name, number) AS rank, count(*) OVER (PARTITION BY doc_id) AS n FROM best WHERE place = 1)
SELECT d.doc_id, r.name AS licence, round(r.dice, 6) AS dice, coalesce(r.n, 0) AS n_matches
FROM documents d LEFT JOIN ranked r ON d.doc_id = r.doc_id AND r.rank = 1"""


ORACLE = _oracle()
