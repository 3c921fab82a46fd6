"""License scan, language, quality and BPE against brute force, a tokenizer and held-out labels."""

import random
import re
import zlib

import public_tokenizers
import pytest
from prose import prose, words
from tokenizers import Tokenizer

from tidegate.llm.bpe import Codec, round_trip
from tidegate.llm.language import fit_language, predict_language
from tidegate.llm.licenses import NOTICES, PHRASES, Template, scan_licenses, words_of
from tidegate.llm.quality import fit_quality, score_quality

PATH = public_tokenizers.path("byte_bpe_50k.json")


def phrase_places(text):
    w = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c < "\x80" else c for c in text or ""))
    found = []
    for p in PHRASES:
        parts = p.text.split()
        found += [(p.label, i) for i in range(len(w) - len(parts) + 1) if w[i:i + len(parts)] == parts]
    return len(w), sorted(found)


def test_license_phrases(make_docs):
    r = random.Random(1)
    phrases = [p.text for p in PHRASES] + ["GNU general, Public license", "cc cc by by", "the MIT-License", "mit licensé", "license mit"]
    rows = [(i, " ".join(x for _ in range(r.randint(0, 12)) for x in (*words(r, r.randint(0, 9)), r.choice(phrases)))) for i in range(60)]
    rows += [(100, "mit license " * 2000), (101, None), (102, "")]
    for row in scan_licenses(make_docs(rows)).collect():
        n, found = phrase_places(dict(rows)[row.doc_id])
        assert (row.n_words, sorted((m.label, m.first_word) for m in row.matches if m.phrase)) == (n, found)


def test_license_blocks_by_containment(make_docs):
    r = random.Random(2)
    templates = [Template("t%d" % i, " ".join(words(r, 6 + i)), 0.75) for i in range(4)] + list(NOTICES)
    rows = []
    for i in range(40):
        inner = [w.decode() for w in r.choice(templates).words]
        for _ in range(r.randint(0, 3)):
            inner[r.randrange(len(inner))] = "swapped"
        rows.append((i, " ".join(words(r, r.randint(0, 40)) + inner + words(r, r.randint(0, 40)))))
    for row in scan_licenses(make_docs(rows), templates).collect():
        w, want = words_of(dict(rows)[row.doc_id].encode()), set()
        for t in templates:
            step, size = len(t.words), len(set(t.words))
            for start in range(0, max(1, len(w)), step):
                common = len(set(t.words) & set(w[start:start + 2 * step]))
                if common >= t.threshold * size - 1e-9:
                    want.add((t.label, start))
        assert {(m.label, m.first_word) for m in row.matches} == want


def test_license_odd_and_empty(odd_docs):
    got = scan_licenses(odd_docs)
    assert got.count() == odd_docs.count() and {"matches", "score", "node"} <= set(got.columns)
    assert scan_licenses(odd_docs.limit(0)).count() == 0


def test_language_learns_and_abstains(make_docs, spark):
    r = random.Random(3)
    kinds = {"xx": "bakelo", "yy": "mivezu"}
    rows = [(i, " ".join("".join(r.choice(kinds[lang]) for _ in range(4)) for _ in range(30)), lang) for i, lang in enumerate(list(kinds) * 30)]
    train = spark.createDataFrame(rows + [(900, None, "xx"), (901, "text", None)], "doc_id long, text string, lang string")
    model = fit_language(train)
    assert model.languages == ["xx", "yy"]
    asked = spark.createDataFrame([(i + 1, t, "?", 1) for i, t, _ in rows[:20]] + [(50, None, "", 1), (51, "", "", 1), (52, "12 !?", "", 1), (None, "bake", "", 1)],
                                  "doc_id long, text string, lang string, lang_pred int")
    got = {x.doc_id: x for x in predict_language(asked, model).collect()}
    assert [got[i + 1].lang_pred for i, _, _ in rows[:20]] == [lang for _, _, lang in rows[:20]]
    assert [got[i].lang_pred for i in (50, 51, 52)] == ["und"] * 3 and got[50].score == 0
    assert got[None].lang_pred == "xx" and 0 <= got[None].score <= 1


def test_language_without_training(odd_docs):
    model = fit_language(odd_docs.limit(0))
    assert {x.lang_pred for x in predict_language(odd_docs, model).collect()} == {"und"}


def test_quality_on_held_out_rows(spark):
    r = random.Random(4)
    good = [" ".join(w if r.random() > 0.1 else w + ".\n" for w in words(r, r.randint(40, 200))) for _ in range(300)]
    bad = [" | ".join(w + "$$$" for w in words(r, r.randint(40, 200))) for _ in range(300)]
    texts = [x for pair in zip(good, bad, strict=True) for x in pair]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(9000, None, "x"), (9001, "", "x"), (None, "no id", "x")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(600)] + [(1, 1), (2, None), (None, 1), (9000, 0)], "doc_id long, quality int")
    model = fit_quality(docs, labels)
    got = {x.doc_id: x.score for x in score_quality(docs, model).collect()}
    held = [i for i in range(600) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum((got[i] >= 0.7) == (i % 2 == 0) for i in held) >= 0.97 * len(held)
    assert got[9000] == got[9001] and 0 <= got[9000] <= 1 and len(got) == 603


def test_quality_without_labels(odd_docs, spark):
    model = fit_quality(odd_docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert {x.score for x in score_quality(odd_docs, model).collect()} == {0.5}
    assert score_quality(odd_docs.limit(0), model).count() == 0


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_bpe_equals_the_tokenizer(tokenizer):
    with open(PATH, encoding="utf-8") as file:
        codec = Codec(file.read())
    r = random.Random(5)
    signs = [chr(c) for c in (*range(0x20, 0x7F), 9, 10, 13, 0x85, 0xA0, 0xE9, 0x301, 0x3042, 0x4E2D, 0x1F600, 0x200B, 0x2028, 0x661)]
    texts = ["", " ", "a  b", "<|endoftext|>x<|endoftext|><|endoftext|>", "don't we'll I'M", "x" * 5000, "ab" * 3000, "\n\n  \n", prose(6, 400)]
    texts += ["".join(r.choice(signs) for _ in range(r.randint(1, 60))) for _ in range(400)]
    texts += ["".join(r.choice("etaoin shrdlu") for _ in range(200)) for _ in range(60)]
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    got = codec.encode(texts)
    assert [x.tolist() for x in got] == want
    assert [codec.decode(x) for x in got] == [tokenizer.decode(x, skip_special_tokens=False) for x in want]


def test_bpe_on_every_code_point(tokenizer):
    with open(PATH, encoding="utf-8") as file:
        codec = Codec(file.read())
    points = [*range(0x3100), *range(0xA000, 0xAC00), *range(0xF900, 0x10000), *range(0x1F300, 0x1F700)]
    texts = ["a" + chr(c) + " 1" + chr(c) + chr(c) + " b" for c in points]
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    different = [hex(c) for c, x, y in zip(points, codec.encode(texts), want, strict=True) if x.tolist() != y]
    assert different == []


def test_failing_proposals_are_merged():
    with open(PATH, encoding="utf-8") as file:
        codec = Codec(file.read())
    r = random.Random(7)
    new = [" " + "".join(r.choice("aeinorstl") for _ in range(r.randint(3, 14))) for _ in range(3000)]
    codec.learn(new)
    import numpy as np
    exact = [codec.merge(w.encode()) for w in new]
    assert [np.frombuffer(codec.known[w], np.int32).tolist() for w in new] == exact
    assert any(codec.propose(w.encode()) != ids for w, ids in zip(new, exact, strict=True))


def test_round_trip_odd_and_empty(odd_docs):
    rows = round_trip(odd_docs.withColumnRenamed("matches", "ids"), PATH).collect()
    assert all(x.decoded == (x.text or "") and (len(x.ids) > 0) == bool(x.text) for x in rows) and len(rows) == odd_docs.count()
    assert round_trip(odd_docs.limit(0), PATH).count() == 0
