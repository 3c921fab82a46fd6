"""Byte-level BPE by speculation and verification.

For every new word the longest vocabulary entries from the left are proposed. A sequence
of tokens is the encoding exactly if each adjacent pair is compatible, that is, if the two
tokens' bytes merge back into these two tokens; this holds because proposals use only
tokens that their own bytes merge into. The pairs of all new words are tested together,
and only words with an incompatible pair are merged step by step.
"""

from __future__ import annotations

import heapq
import json
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import pieces, remembered

#: The usual byte-level word pattern (fixed value).
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words remembered by one Python worker. Half of them are forgotten at a time, those not seen since
#: the last time; it changes no result.
REMEMBERED = 400_000
_SHORT = 64
_NO_MERGE = (1 << 60, -1)


def _byte_of() -> dict[str, int]:
    """Characters that stand for bytes: printable ones for themselves, the rest from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec:
    """Encoder and decoder of one tokenizer file (JSON with vocab and merges)."""

    def __init__(self, content: str):
        data, byte_of = json.loads(content), _byte_of()
        to_bytes = lambda s: bytes(byte_of[c] for c in s)
        self.special = {x["content"]: x["id"] for x in data.get("added_tokens", [])}
        self.id_of = {to_bytes(t): i for t, i in data["model"]["vocab"].items() if t not in self.special}
        self.bytes_of = {i: t for t, i in self.id_of.items()} | {i: s.encode() for s, i in self.special.items()}
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        for place, merge in enumerate(data["model"]["merges"]):
            left, right = (to_bytes(x) for x in (merge.split(" ") if isinstance(merge, str) else merge))
            self.rank[self.id_of[left], self.id_of[right]] = (place, self.id_of[left + right])
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.words = regex.compile(WORDS)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.compatible: dict[int, bool] = {}
        self.span = max(map(len, self.id_of))
        self.proposed = {t: i for t, i in self.id_of.items() if self.merge(t) == [i]}
        # decoding: the bytes of all ids in one array, gathered at once
        top = max(self.bytes_of) + 1
        lengths = np.zeros(top, np.int64)
        for i, b in self.bytes_of.items():
            lengths[i] = len(b)
        self.starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        self.lengths = lengths
        self.flat = np.frombuffer(b"".join(self.bytes_of.get(i, b"") for i in range(top)), np.uint8)

    def merge(self, word: bytes) -> list[int]:
        """Exact encoding of one word: always the merge of lowest rank, the leftmost of equals."""
        ids = [self.id_of[word[i:i + 1]] for i in range(len(word))]
        if len(ids) > _SHORT:
            return self._merge_long(ids)
        rank = self.rank
        ranks = [rank.get(pair, _NO_MERGE) for pair in zip(ids, ids[1:], strict=False)]
        while ranks and (best := min(ranks)) is not _NO_MERGE:
            i = ranks.index(best)
            ids[i:i + 2] = [best[1]]
            del ranks[i]
            if i < len(ranks):
                ranks[i] = rank.get((ids[i], ids[i + 1]), _NO_MERGE)
            if i:
                ranks[i - 1] = rank.get((ids[i - 1], ids[i]), _NO_MERGE)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap, in n log n steps."""
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap = [(r[0], i, a, b, r[1]) for i, (a, b) in enumerate(zip(ids, ids[1:], strict=False)) if (r := self.rank.get((a, b)))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, joined = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= len(ids) or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = joined, -1, after[j]
            if after[i] < len(ids):
                before[after[i]] = i
                if r := self.rank.get((joined, ids[after[i]])):
                    heapq.heappush(heap, (r[0], i, joined, ids[after[i]], r[1]))
            if before[i] >= 0 and (r := self.rank.get((ids[before[i]], joined))):
                heapq.heappush(heap, (r[0], before[i], ids[before[i]], joined, r[1]))
        return [x for x in ids if x >= 0]

    def propose(self, word: bytes) -> list[int]:
        """Longest tokens from the left."""
        ids, at, n = [], 0, len(word)
        while at < n:
            end = min(n, at + self.span)
            while (token := self.proposed.get(word[at:end])) is None:
                end -= 1
            ids.append(token)
            at = end
        return ids

    def learn(self, words: list[str]) -> None:
        """Encode new words: propose, test all adjacent pairs at once, merge where a pair fails."""
        texts = [w.encode() for w in words]
        proposals = [self.propose(t) for t in texts]
        lengths = np.fromiter(map(len, proposals), np.int64, len(proposals))
        flat = np.fromiter((i for p in proposals for i in p), np.int64, int(lengths.sum()))
        owner = np.repeat(np.arange(len(words)), lengths)
        inside = owner[1:] == owner[:-1]
        pairs = ((flat[:-1] << 32) | flat[1:])[inside]
        distinct, place = np.unique(pairs, return_inverse=True)
        if len(self.compatible) > REMEMBERED:
            self.compatible.clear()
        for pair in distinct.tolist():
            if pair not in self.compatible:
                a, b = pair >> 32, pair & 0xFFFFFFFF
                self.compatible[pair] = self.merge(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
        good = np.fromiter((self.compatible[p] for p in distinct.tolist()), bool, len(distinct))
        failing = np.zeros(len(words), bool)
        failing[owner[1:][inside][~good[place]]] = True
        for i in np.flatnonzero(failing).tolist():
            proposals[i] = self.merge(texts[i])
        for word, ids in zip(words, proposals, strict=True):
            self.known[word] = array("i", ids).tobytes()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Token ids of every text; special tokens written in a text are taken as such."""
        cut = [self.cut.split(t) if self.cut else [t] for t in texts]
        words = [[[p] if p in self.special else self.words.findall(p) for p in parts] for parts in cut]
        used = {w for parts in words for part in parts for w in part}
        if len(self.known) > REMEMBERED // 2:
            self.older, self.known = self.known, {}
        new = used - self.known.keys()
        again = new & self.older.keys()
        self.known.update((w, self.older[w]) for w in again)
        new -= again
        special = new & self.special.keys()
        for word in special:
            self.known[word] = np.array([self.special[word]], np.int32).tobytes()
        self.learn(list(new - special))
        return [np.frombuffer(b"".join(self.known[w] for part in parts for w in part), np.int32) for parts in words]

    def decode(self, ids: np.ndarray) -> str:
        """The text of token ids; bytes that are no UTF-8 become U+FFFD."""
        ids = np.asarray(ids, np.int64)
        sizes = self.lengths[ids]
        offsets = np.repeat(self.starts[ids] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
        return self.flat[offsets + np.arange(int(sizes.sum()))].tobytes().decode("utf-8", "replace")


def codec(content: str) -> Codec:
    """The codec of a tokenizer file's content, built once in a Python worker."""
    known, key = remembered("bpe").setdefault("codecs", {}), hash(content)
    if key not in known:
        known.clear()
        known[key] = Codec(content)
    return known[key]


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``docs`` with ``ids`` (array of int) and ``decoded`` (their text).

    ``tokenizer`` is the path of a tokenizer file, read once by the driver. Null texts
    count as empty: no ids, empty ``decoded``. Other columns stay; columns named ``ids`` or
    ``decoded`` are replaced. Narrow, one row in, one row out; a text of any length is
    encoded whole.
    """
    with open(tokenizer, encoding="utf-8") as file:
        content = docs.sparkSession.sparkContext.broadcast(file.read())
    kept = docs.drop("ids", "decoded")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(content.value)
        for piece in pieces(batches, 2 << 20):
            ids = own.encode([t or "" for t in piece.column("text").to_pylist()])
            starts = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            tokens = pa.ListArray.from_arrays(pa.array(starts), pa.array(np.concatenate(ids)))
            decoded = pa.array([own.decode(x) for x in ids], pa.string())
            yield pa.RecordBatch.from_arrays([*piece.columns, tokens, decoded], names=[*piece.schema.names, "ids", "decoded"])

    schema = T.StructType([*kept.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())])
    return kept.mapInArrow(work, schema)
