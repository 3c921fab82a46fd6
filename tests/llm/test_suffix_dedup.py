"""Suffix dedup against brute force, and its parts."""

import random

import brute
import numpy as np
import pytest
from prose import prose, words

from tidegate.llm import suffix_dedup
from tidegate.llm.suffix_dedup import deep_shallow, remove_repeats, runs


def result(df):
    return sorted(((x.doc_id, bytes(x.kept), [(s.start, s.length) for s in x.removed]) for x in df.collect()), key=repr)


def passages(seed):
    r = random.Random(seed)
    shared = [prose(seed * 10 + i, n) for i, n in enumerate((5, 9, 12, 30, 80))] + ["x" * 200, "ab" * 90, "é" * 40]
    rows = []
    for i in r.sample(range(500), 70):
        parts = [x for _ in range(r.randint(0, 4)) for x in (" ".join(words(r, r.randint(0, 12))), r.choice(shared)[r.randint(0, 20):])]
        rows.append((i, "".join(parts)))
    rows += [(900, rows[0][1]), (3, rows[4][1]), (901, rows[0][1] + "tail"), (902, None), (903, ""), (None, rows[5][1])]
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force(make_docs, seed):
    rows = passages(seed)
    assert result(remove_repeats(make_docs(rows).repartition(3), slices=4)) == brute.repeats(rows, 50)


def test_small_batches_and_long_texts(make_docs, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BATCH_RUNS", 30)
    monkeypatch.setattr(suffix_dedup, "_PIECE", 200)  # every text is cut into overlapping parts
    rows = passages(4)[:40]
    assert result(remove_repeats(make_docs(rows).repartition(2), slices=3)) == brute.repeats(rows, 50)


def test_one_line_in_thousands_of_texts(make_docs, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT_WINDOWS", 2000)
    sort = suffix_dedup.deep_shallow

    def bounded(strings):
        if len(strings) > 6000:
            raise MemoryError(f"{len(strings)} windows at once")
        return sort(strings)

    monkeypatch.setattr(suffix_dedup, "deep_shallow", bounded)
    r, line = random.Random(7), prose(77, 12)[:58]
    text = lambda: "".join(r.choice("abcdefghij ") for _ in range(45))
    rows = [(i, text() + line + text() + ("-" * 60 + text() if i % 3 == 0 else "")) for i in range(2000)]
    assert result(remove_repeats(make_docs(rows).repartition(3), slices=4)) == brute.repeats(rows, 50)


def test_odd_and_empty(odd_docs):
    rows = [(x.doc_id, x.text) for x in odd_docs.collect() if x.doc_id != 7]
    assert result(remove_repeats(odd_docs.where("doc_id is null or doc_id <> 7"))) == brute.repeats(rows, 50)
    assert remove_repeats(odd_docs.limit(0)).count() == 0
    long = remove_repeats(odd_docs.where("doc_id = 7")).first()
    assert bytes(long.kept).decode() == long.text and long.removed == []


def test_whole_characters(make_docs):
    rows = [(1, "é" * 30 + "x"), (2, "a" + "é" * 30 + "ü" + "z" * 9)]
    got = {x.doc_id: x.kept for x in remove_repeats(make_docs(rows), as_text=True).collect()}
    assert got[1] == rows[0][1] and got[2] == "azzzzzzzzz"  # half a ü is no character


def test_every_window_is_in_one_run():
    r = random.Random(9)
    texts = ["".join(r.choice("ab") for _ in range(n)).encode() for n in (0, 10, 49, 50, 51, 400)] + [b"q" * 300]
    data = np.frombuffer(b"".join(texts), np.uint8)
    doc = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    _, _, start, count = runs(data, doc, 50)
    covered = sorted(int(s) + i for s, c in zip(start, count, strict=True) for i in range(c))
    assert covered == [i for i in range(len(data) - 49) if doc[i] == doc[i + 49]] and count.max() <= suffix_dedup.RUN


@pytest.mark.parametrize(("n", "letters", "width"), [(0, "ab", 50), (1, "ab", 50), (400, "ab", 30), (600, "abc", 50), (300, "a", 50)])
def test_deep_shallow_sorts(n, letters, width):
    r = random.Random(n)
    stems = ["".join(r.choice(letters) for _ in range(width)) for _ in range(20)]
    strings = [(r.choice(stems)[:r.randint(0, width)] + "".join(r.choice(letters) for _ in range(width)))[:width].encode() for _ in range(n)]
    matrix = np.frombuffer(b"".join(strings), np.uint8).reshape(n, width)
    order, new = deep_shallow(matrix)
    ordered = [strings[i] for i in order]
    assert ordered == sorted(strings) and sorted(order.tolist()) == list(range(n))
    assert new.tolist() == [i == 0 or ordered[i] != ordered[i - 1] for i in range(n)]
