"""Prefix trie, structure repair and packing of conversations and documents: odd rows, SQL and brute force."""

import duckdb
import pandas as pd
import pytest

from tidegate.llm.prefix_trie import EMPTY_SHA, prefix_trie
from tidegate.llm.queries import PREFIX_TRIE_SQL

SCHEMA = "conv_id long, turn long, role string, text string, key string, depth int, node long, pos int"


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "k", 1, 2, 3) for r in rows], SCHEMA)


def by_sql(rows):
    con = duckdb.connect()
    frame = pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"})
    con.register("conversations", frame)
    cur = con.execute(PREFIX_TRIE_SQL)
    names = [c[0] for c in cur.description]
    return sorted(
        (tuple(dict(zip(names, r))[c] for c in COLUMNS) for r in cur.fetchall()), key=repr)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]

ODD = [
    (0, 0, "user", "hello there"), (0, 1, "assistant", "hi"), (0, 2, "user", None),
    (1, 0, "user", "hello there"), (1, 1, "assistant", "hi"), (1, 5, None, "bye now friend"),
    (2, None, "system", "be kind"), (2, 0, "user", "hello there"), (2, 0, "user", "hello there"),
    (3, 3, "user", "x"), (5, 1, "user", "hello there"), (20, 0, "user", "a b c"), (21, 0, "assistant", "z"),
    (22, 7, "user", ""), (None, 0, "user", "no conversation"), (40, None, None, None), (61, 2, "user", "alone"),
]


def test_trie_equals_sql_on_odd_rows(spark):
    got = prefix_trie(conversations(spark, ODD)).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=repr) == by_sql(ODD)
    root = [r for r in got if r.depth == 0]
    assert len(root) == 1 and root[0].parent_conv_id is None and root[0].n_convs == len({r[0] for r in ODD if r[0] is not None})


def test_trie_of_copies_and_rollups(spark):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"turn {t} of the same chat") for c in range(0, 200, 20) for t in range(3)]
    got = {(r.depth, r.conv_id): r for r in prefix_trie(conversations(spark, rows)).collect()}
    assert sorted(got) == [(0, 0), (1, 0), (2, 0), (3, 0)]
    leaf = got[3, 0]
    assert leaf.n_convs == 10 and leaf.n_leaves == 1 and leaf.n_children == 0
    assert got[0, 0].saved_tokens == 9 * 6 * 3  # three turns of six words, nine copies saved each
    import hashlib
    assert leaf.ends_sha256 == hashlib.sha256(",".join(str(c) for c in range(0, 200, 20)).encode()).hexdigest()
    assert got[1, 0].ends_sha256 == EMPTY_SHA
    assert sorted(map(tuple, prefix_trie(conversations(spark, rows)).select(*COLUMNS).collect()), key=repr) == by_sql(rows)


def test_trie_of_nothing(spark):
    assert prefix_trie(conversations(spark, ODD).limit(0)).count() == 0


def test_trie_of_long_texts_and_deep_chats(spark):
    rows = [(7, t, "user", ("word " * 50_000) if t == 0 else f"t{t}") for t in range(40)] + [(8, 0, "user", "word " * 50_000)]
    got = sorted(map(tuple, prefix_trie(conversations(spark, rows)).select(*COLUMNS).collect()), key=repr)
    assert got == by_sql(rows)


# ---- structure repair ----------------------------------------------------------------------

import heapq  # noqa: E402
import random  # noqa: E402

from tidegate.llm.repair import NEXT, damage, faults, repair_damaged, repair_one, search  # noqa: E402


def cheapest_by_best_first(turns):
    """Uniform-cost search over (cost, audit) without bounds or tables: the least pair wins."""
    found = faults(turns)
    n = len(turns)
    heap = [(0, "", 0, 0)]
    while heap:
        g, audit, i, q = heapq.heappop(heap)
        if i == n and q in (0, 3):
            return g, audit
        target = "u" if (q, "u") in NEXT else "a"
        options = [("I", 5, i, NEXT[q, target])]
        if i < n:
            options.append(("D", 2, i + 1, q))
            if found[i] not in ("blank", "duplicate"):
                extra = 5 if found[i] == "truncated" else 0
                if (q, turns[i][0][:1]) in NEXT:
                    options.append(("K", extra, i + 1, NEXT[q, turns[i][0][:1]]))
                options.append(("R", 1 + extra, i + 1, NEXT[q, target]))
        for edit, cost, i2, q2 in options:
            if g + cost <= 60:
                heapq.heappush(heap, (g + cost, audit + edit, i2, q2))
    raise AssertionError("no repair")


def test_search_equals_best_first_on_random_chats():
    rnd = random.Random(5)
    roles, texts = ["user", "assistant", "system", "", " ", "tool"], ["Hi.", "ok", "", "  ", "Sure!", "why?", "x"]
    for _ in range(400):
        turns = [(rnd.choice(roles), rnd.choice(texts)) for _ in range(rnd.randrange(0, 7))]
        cost, edits = search(turns, faults(turns))
        assert (cost, "".join(e for e, _ in edits)) == cheapest_by_best_first(turns), turns


def test_repair_counts_and_text():
    got = repair_one([("user", "Hi."), ("user", "Hi."), ("assistant", "ok"), ("system", "x.")], [0, 1, 2, 5])
    assert (got["gaps"], got["blank"], got["duplicate"], got["truncated"], got["illegal"]) == (2, 0, 1, 1, 2)
    assert (got["cost"], got["audit"]) == (5, "KDDR")
    import hashlib
    assert got["repaired_sha256"] == hashlib.sha256(b"user:Hi.\nassistant:x.").hexdigest()
    assert repair_one([], [])["repaired_sha256"] == hashlib.sha256(b"").hexdigest()
    long = [("user" if i % 2 == 0 else "assistant", f"turn {i}.") for i in range(3000)]
    assert repair_one(long, list(range(3000)))["cost"] == 0


def test_repair_query_over_odd_rows(spark):
    rows = ODD + [(9, t, "user", "same words.") for t in range(6)] + [(11, None, None, None)]
    convs = conversations(spark, rows)
    got = {r.conv_id: r for r in repair_damaged(convs).collect()}
    assert set(got) == {r[0] for r in rows}
    damaged = [tuple(r) for r in damage(convs).collect()]
    for cid in got:
        mine = [r for r in damaged if r[0] == cid]
        mine.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        want = repair_one([(r[2], r[3]) for r in mine], [r[1] for r in mine])
        assert {k: getattr(got[cid], k) for k in want} == want, cid
    assert repair_damaged(convs.limit(0)).count() == 0


# ---- packing -------------------------------------------------------------------------------

import zlib  # noqa: E402
from collections import defaultdict  # noqa: E402

import numpy as np  # noqa: E402
import public_tokenizers  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from tidegate.llm import packing  # noqa: E402

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def check_packed(rows, got, limits=(4096, 256, 4096)):
    """Every id of every document in exactly one piece, pieces right, sequences within limits."""
    tok = Tokenizer.from_file(WORD_BPE)
    ids = {n: tok.encode(t or "", add_special_tokens=False).ids + [2] for n, (_, t) in enumerate(rows)}
    by_doc = defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
    wanted = defaultdict(list)
    for n, (d, _) in enumerate(rows):
        wanted[d].append(ids[n])
    for d, docs in wanted.items():
        pieces = sorted(by_doc[d], key=lambda r: (r.doc_tokens, r.start))
        assert sum(r.length for r in pieces) == sum(map(len, docs))
        for full in docs:  # a repeated document has its own pieces
            mine = [r for r in pieces if r.doc_tokens == len(full)]
            for r in mine:
                assert r.ids_crc32 == zlib.crc32(np.asarray(full[r.start:r.start + r.length], "<u4").tobytes())
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append(r)
    for pieces in sequences.values():
        pieces.sort(key=lambda r: r.offset)
        assert [r.offset for r in pieces] == list(np.cumsum([0] + [r.length for r in pieces[:-1]]))
        assert sum(r.length for r in pieces) <= limits[0] and len(pieces) <= limits[1]
    return sequences


def test_packing_is_whole_and_tight(spark, make_docs):
    from prose import prose
    rows = [(i, prose(i, 3 + (i * 37) % 900)) for i in range(300)] + [(900, "word " * 9000), (901, None), (902, ""),
                                                                       (None, "no id here"), (903, "x y"), (903, "x y")]
    got = packing.pack_documents(make_docs(rows), WORD_BPE).collect()
    sequences = check_packed(rows, got)
    total = sum(r.length for r in got)
    assert len(sequences) <= -(-total // 4096) + 1  # one group: at most one bin beyond the bound
    assert all(r.ids is not None for r in got)


def test_packing_limits_on_segments(spark, make_docs):
    rows = [(i, "a b c") for i in range(100)]
    pieces = packing.tokenised_pieces(make_docs(rows), WORD_BPE, with_ids=False)
    got = packing.pack(pieces, max_segments=8).collect()
    sequences = check_packed(rows, got, (4096, 8, 4096))
    assert len(sequences) == 13


def test_packing_of_nothing(spark, make_docs):
    assert packing.pack_documents(make_docs([(1, "a")]).limit(0), WORD_BPE).count() == 0


def test_words_are_encoded_once_and_as_the_library_does():
    """Odd characters, added tokens and long words get the library's ids; few words reach the library."""
    from tokenizers import Tokenizer

    class Counting:
        """A tokenizer that counts what it is asked."""

        def __init__(self, tokenizer):
            self.own, self.model, self.pre_tokenizer, self.asked = tokenizer, self, tokenizer.pre_tokenizer, 0

        def encode_batch_fast(self, texts, **options):
            self.asked += len(" ".join(texts).split())
            return self.own.encode_batch_fast(texts, **options)

        def tokenize(self, piece):
            self.asked += 1
            return self.own.model.tokenize(piece)

    tok = Tokenizer.from_file(WORD_BPE)
    r = random.Random(4)
    odd = ["a", "B", "'s", "'", "t", "9", " ", "\n", "\t", "\r\x0b", "\x1c", "\x85", "\xa0", " ", "́", "é", "İ", "À", "ß", "×",
           "º", "Å", "<|endoftext|>", "<|", "|>", "中文", "٣", "²", "_", "!!", "\x00", "​", "ſ", "'LL", "\U0001f600", "ᄀ", "ᅡ"]
    texts = ["".join(r.choice(odd) for _ in range(r.randint(0, 12))) for _ in range(4000)]
    texts += ["x" * 300_000, "a b" * 100_000, "é" * 270_000, "ab," * 100_000 + " énd"]
    for some in (texts, texts[:100]):
        want = [e.ids + [2] for e in tok.encode_batch(some, add_special_tokens=False)]
        assert [ids.tolist() for ids in packing.encode(some, tok, {})] == want
    counting, kept = Counting(tok), {}
    said = [" ".join(r.choice(["The", "the,", "été", "end."]) for _ in range(500)) for _ in range(20)]
    got = packing.encode(said[:10], counting, kept) + packing.encode(said[10:], counting, kept)
    assert [ids.tolist() for ids in got] == [e.ids + [2] for e in tok.encode_batch(said, add_special_tokens=False)]
    assert counting.asked <= 6      # the, comma, ete, end, full stop, nothing


def test_words_share_the_ids_of_their_pieces(monkeypatch):
    """Words made of the same pieces are not remembered one by one; forgetting and long pieces change no id."""
    tok = Tokenizer.from_file(WORD_BPE)
    r = random.Random(5)
    parts = ["Alpha", "beta", "'s", ",", "?!", "7", "\u00c9t\u00e9", "'d'd", "'rest", "''s", "\t"]
    texts = [" ".join("".join(r.choices(parts, k=r.randint(1, 5))) for _ in range(200)) for _ in range(40)]
    kept = {}
    want = [e.ids + [2] for e in tok.encode_batch(texts, add_special_tokens=False)]
    assert [ids.tolist() for ids in packing.encode(texts, tok, kept)] == want
    assert len({w for t in texts for w in t.split(" ")}) > 3000
    assert sum(len(x) if isinstance(x, dict) else len(getattr(x, "known", ())) for k, x in kept.items() if k != "spelt") < 1200
    monkeypatch.setattr(packing, "KEPT_PIECES", 5)
    monkeypatch.setattr(packing, "PART_CHARS", 1 << 12)
    mixed = [t + " " + "x" * (60 + n) + " \u4e2d\u6587" * n + " <|endoftext|>" for n, t in enumerate(texts)]
    want = [e.ids + [2] for e in tok.encode_batch(mixed, add_special_tokens=False)]
    for _ in range(2):
        assert [ids.tolist() for ids in packing.encode(mixed, tok, kept)] == want
