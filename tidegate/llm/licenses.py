"""License scan: an exact set-similarity join of text blocks with license templates.

A template is a set of words that a block of text has to contain to a threshold. The
blocks of a template with L words are the windows of 2 L words that start at every L-th
word, so any run of L words lies whole in one of them. Words are ordered by how often the
whole corpus has them. The join keeps only block-template pairs whose rarest words meet:

* prefix: of a template with need n out of m words, one of its m - n + 1 rarest must be
  among the block's |B| - n + 1 rarest;
* length: a block has at least n template words;
* position: the words after the two meeting places must still allow n common words.

Remaining pairs are counted in full. The template table is a bounded parameter and goes to
the documents; documents do not move.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import pieces, utf8

_WORD = rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"
#: The template table must stay this small, as it goes to every worker.
MAX_TEMPLATES = 10_000


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    threshold: float = 0.8
    phrase: bool = False  # its words must also stand consecutively

    @property
    def words(self) -> list[bytes]:
        return words_of(self.text.encode())


#: Phrases and their labels.
PHRASES = (
    Template("gpl", "gnu general public license", 1.0, True),
    Template("apache", "apache license", 1.0, True),
    Template("cc-by", "cc by", 1.0, True),
    Template("mit", "mit license", 1.0, True),
)
#: Usual wordings of license notices.
NOTICES = (
    Template("notice:gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    Template("notice:apache-2.0", "Licensed under the Apache License, Version 2.0"),
    Template("notice:cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    Template("notice:mit", "Released under the MIT License"),
    Template("text:gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    Template("text:apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    Template("text:mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    Template("text:bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    Template("text:mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
)


def words_of(text: bytes) -> list[bytes]:
    """Words of the ASCII-lower-cased text: digits, letters and everything beyond ASCII."""
    return re.findall(_WORD, text.lower())


def word_counts(docs: DataFrame, vocabulary: frozenset[bytes]) -> dict[bytes, int]:
    """How often all texts have each word of a bounded vocabulary."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()
        for piece in pieces(batches):
            for text in utf8(piece.column("text")):
                total.update(filter(vocabulary.__contains__, words_of(text)))
        yield pa.RecordBatch.from_pydict({"word": pa.array(list(total), pa.binary()), "n": pa.array(list(total.values()), pa.int64())})

    rows = docs.select("text").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {bytes(r.word): r.n for r in rows.limit(len(vocabulary)).collect()}


class _Index:
    """Templates with words in corpus order, and where their prefixes meet a text."""

    def __init__(self, templates: Sequence[Template], counts: dict[bytes, int]):
        vocabulary = {w for t in templates for w in t.words}
        self.place = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (counts.get(w, 0), w)))}
        self.templates = [t for t in templates if t.words]
        self.sets = [sorted({self.place[w] for w in t.words}) for t in self.templates]
        self.need = [max(1, math.ceil(t.threshold * len(s) - 1e-9)) for t, s in zip(self.templates, self.sets, strict=True)]
        self.prefix: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for number, (words, need) in enumerate(zip(self.sets, self.need, strict=True)):
            for at, word in enumerate(words[:len(words) - need + 1]):
                self.prefix[word].append((number, at))
        name = {i: w for w, i in self.place.items()}
        self.rare = frozenset(name[w] for w in self.prefix)

    def matches(self, words: list[bytes]) -> list[tuple[str, bool, int, int, float]]:
        """``(label, phrase, first word, words, containment)``; blocks that share a place count once."""
        if self.rare.isdisjoint(words):
            return []
        known = [self.place.get(w, -1) for w in words]
        blocks: dict[int, set[int]] = defaultdict(set)  # template -> blocks in which a prefix word stands
        for at, word in enumerate(known):
            for number, _ in self.prefix.get(word, ()):
                step = len(self.templates[number].words)
                blocks[number].update(b for b in (at // step - 1, at // step) if b >= 0)
        found = set()
        for number, starts in blocks.items():
            template, need, wanted = self.templates[number], self.need[number], self.sets[number]
            step = len(template.words)
            for block in starts:
                window = known[block * step:(block + 2) * step]
                have = sorted({w for w in window if w >= 0})
                if len(have) < need or not self._meet(number, have):
                    continue
                common = len(set(have).intersection(wanted))
                if common < need:
                    continue
                if not template.phrase:
                    found.add((template.label, False, block * step, len(window), common / len(wanted)))
                    continue
                for at in range(block * step, block * step + len(window) - step + 1):
                    if words[at:at + step] == template.words:
                        found.add((template.label, True, at, step, 1.0))
        return sorted(found)

    def _meet(self, number: int, have: list[int]) -> bool:
        """Prefix and position filter of one block (its known words in corpus order)."""
        need, size = self.need[number], len(self.sets[number])
        at = {w: i for i, w in enumerate(have[:len(have) - need + 1])}
        for i, word in enumerate(self.sets[number][:size - need + 1]):
            if word in at:  # the first meeting place: all common words stand here or later
                return 1 + min(size - i, len(have) - at[word]) - 1 >= need
        return False


def scan_licenses(docs: DataFrame, templates: Sequence[Template] = PHRASES + NOTICES) -> DataFrame:
    """``docs`` with ``n_words`` and ``matches``, all blocks and phrases found in each whole text.

    ``matches`` is an array of ``(label, phrase, first_word, n_words, containment)``, sorted;
    empty where nothing is found. Null texts count as empty. Other columns stay; columns
    with these two names are replaced. Repeated rows are scanned each for itself.
    """
    if len(templates) > MAX_TEMPLATES:
        raise ValueError(f"more than {MAX_TEMPLATES} templates")
    vocabulary = frozenset(w for t in templates for w in t.words)
    index = _Index(templates, word_counts(docs, vocabulary))
    kept = docs.drop("n_words", "matches")
    match = T.ArrayType(T.StructType([
        T.StructField("label", T.StringType()), T.StructField("phrase", T.BooleanType()),
        T.StructField("first_word", T.LongType()), T.StructField("n_words", T.LongType()),
        T.StructField("containment", T.DoubleType())]))
    arrow = pa.list_(pa.struct([("label", pa.string()), ("phrase", pa.bool_()), ("first_word", pa.int64()),
                                ("n_words", pa.int64()), ("containment", pa.float64())]))
    fields = [arrow.value_type.field(i).name for i in range(arrow.value_type.num_fields)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            counts, found = [], []
            for text in utf8(piece.column("text")):
                words = words_of(text)
                counts.append(len(words))
                found.append([dict(zip(fields, m, strict=True)) for m in index.matches(words)])
            yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(counts, pa.int64()), pa.array(found, arrow)],
                                             names=[*piece.schema.names, "n_words", "matches"])

    schema = T.StructType([*kept.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("matches", match)])
    return kept.mapInArrow(work, schema)
