"""Packing token sequences by vector bin packing with the dot-product heuristic.

Every document is tokenised (ids, then an end id) and cut into pieces of at most the sequence
length. Pieces are items with a demand vector of three resources: tokens, segments (one per
piece) and loss-bearing tokens; a sequence is a bin with a limit on each. A bin is filled at a
time: among the pieces that still fit in all three limits, the one whose demand, scaled by the
limits, has the largest dot product with the bin's remaining capacity goes in next (ties: the
earlier piece in a fixed order); when none fits the bin closes.

Spark deals the pieces to groups by a hash of a stored piece number, so that repeated documents
spread too; the number of groups follows the measured tokens and pieces, which bounds the work
and memory of one group (``GROUP_TOKENS`` tokens or ``GROUP_PIECES`` pieces on average). Each
group is packed in one task with numpy; a group leaves at most a few partly filled bins, so
padding stays near the bound of one partial bin per group.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidegate.llm.common import pieces, remembered
from tidegate.storage import materialise, spread

SEQUENCE = 4096
#: Limits of a sequence beside its tokens: segments (pieces) and loss-bearing tokens.
MAX_SEGMENTS = 256
MAX_LOSS_TOKENS = SEQUENCE
END_ID = 2
#: Average size of a packing group: tokens and pieces.
GROUP_TOKENS = 1 << 22
GROUP_PIECES = 8192
#: Texts longer than this are encoded in parts cut at spaces or line feeds.
ENCODE_CHARS = 1 << 18
#: Characters of the words that the library gets at once (its encodings take some 100 bytes a
#: token), and of the parts whose pieces are found at once (some 20 bytes a character).
BATCH_CHARS, PART_CHARS = 1 << 20, 1 << 22
#: Pieces whose ids a worker remembers, and bytes of the longest of them.
KEPT_PIECES, KEPT_BYTES = 1 << 19, 64
#: Classes of characters: space and line feed, other space, letters, digits, others. Words with
#: characters of the last class, which normalising may change or join, go to the library whole.
_CUT, _SPACE, _LETTER, _DIGIT, _MARK, _ODD = range(6)


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Class and lower-case character of each character up to U+00FF, at 256 of any other.

    Letters beyond ASCII are those that normalising leaves alone or turns to one lower-case
    letter of the same range.
    """
    kind, lower = np.full(257, _ODD, np.uint8), np.arange(257, dtype=np.uint16)
    kind[:128] = _MARK
    kind[[9, 11, 12, 13]] = _SPACE
    kind[[10, 32]] = _CUT
    kind[48:58] = _DIGIT
    for first, last in (("A", "Z"), ("\u00c0", "\u00d6"), ("\u00d8", "\u00de")):
        kind[ord(first):ord(last) + 1] = _LETTER
        lower[ord(first):ord(last) + 1] += 32
    for first, last in (("a", "z"), ("\u00df", "\u00f6"), ("\u00f8", "\u00ff")):
        kind[ord(first):ord(last) + 1] = _LETTER
    return kind, lower.astype(np.uint8)


_KIND, _LOWER = _tables()
#: Endings that the tokenizer's own pattern cuts off after an apostrophe.
_ENDINGS = (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d")


def _cut_text(text: str) -> Iterator[str]:
    """Parts of a text; a word stays whole, however long."""
    begin = 0
    while len(text) - begin > ENCODE_CHARS:
        end = begin + ENCODE_CHARS
        cut = max(text.rfind(" ", begin, end), text.rfind("\n", begin, end))
        if cut < begin:
            cut = min((x for x in (text.find(" ", end), text.find("\n", end)) if x >= 0), default=len(text))
        yield text[begin:cut + 1]
        begin = cut + 1
    yield text[begin:]


def _slices(texts: list[str], most: int = BATCH_CHARS) -> Iterator[slice]:
    """Texts of about ``most`` characters at a time; a longer one alone."""
    at = 0
    while at < len(texts):
        stop, chars = at, 0
        while stop < len(texts) and (stop == at or chars + len(texts[stop]) <= most):
            chars += len(texts[stop])
            stop += 1
        yield slice(at, stop)
        at = stop


class _Ids:
    """Remembered pieces and their ids: those of ``known[i]`` are ``flat[ends[i]:ends[i + 1]]``.

    Pieces of plain characters are Latin-1, odd words a space and UTF-8.
    """

    def __init__(self):
        self.known, self.ends, self.flat = pa.array([], pa.binary()), array("q", [0]), array("I")

    def numbers(self, pieces: pa.Array, learn: Callable[[list[bytes]], Iterator[list[int]]]) -> np.ndarray:
        """The number of every piece; new ones are learnt, those too long to stay last."""
        numbers = pc.index_in(pieces, self.known).fill_null(-1).to_numpy().astype(np.int64)
        new = np.flatnonzero(numbers < 0)
        long = pc.binary_length(pieces).to_numpy()[new] > KEPT_BYTES
        new = np.concatenate([new[~long], new[long]])
        numbers[new] = len(self.known) + np.arange(len(new))
        added = pieces.take(pa.array(new))
        for ids in learn(added.to_pylist()):
            self.flat.extend(ids)
            self.ends.append(len(self.flat))
        self.known = pa.concat_arrays([self.known, added.slice(0, len(new) - np.count_nonzero(long))])
        return numbers

    def joined(self, numbers: np.ndarray, cuts: np.ndarray) -> list[np.ndarray]:
        """The ids of the numbered pieces in a row, cut before the pieces at ``cuts``."""
        ends, flat = np.frombuffer(self.ends, np.int64), np.frombuffer(self.flat, np.uint32)
        starts, sizes = ends[numbers], ends[numbers + 1] - ends[numbers]
        before = np.concatenate([[0], np.cumsum(sizes)])
        places = np.repeat(starts - before[:-1], sizes) + np.arange(before[-1])
        return np.split(flat[places].astype("<u4"), before[cuts])

    def forget(self) -> None:
        """Keep what is remembered bounded: long pieces go at once, and frequent ones come again soon."""
        if len(self.known) > KEPT_PIECES:
            self.__init__()
        del self.ends[len(self.known) + 1:]
        del self.flat[self.ends[-1]:]


def _begins(text: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Whether a piece of the tokenizer's pattern begins at each character: ``text`` is lower-case, without odd characters."""
    before = np.concatenate([[_CUT], kind[:-1]])
    first = (kind > _SPACE) & ((kind != before) | (kind == _DIGIT))
    quotes = np.flatnonzero(first & (text == ord("'")))
    for ending in _ENDINGS:
        n = len(ending)
        at = quotes[quotes + n < len(text)]
        for i, c in enumerate(ending, 1):
            at = at[text[at + i] == c]
        first[at + 1] = False
        rest = at[at + n + 1 < len(text)] + n + 1
        first[rest] |= kind[rest] == _LETTER
    return first


def _odd_words(text: str, char: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, list[str]]:
    """Places and texts of the words that hold an odd character, or might an added token."""
    odd = np.flatnonzero((kind == _ODD) | ((char == ord("<")) & (np.append(char[1:], 0) == ord("|"))))
    if not len(odd):
        return odd, []
    cuts = np.flatnonzero(kind == _CUT)
    word = np.unique(np.searchsorted(cuts, odd))
    bounds = np.concatenate([[-1], cuts, [len(char)]])
    starts, stops = bounds[word] + 1, bounds[word + 1]
    return starts, [text[a:b] for a, b in zip(starts.tolist(), stops.tolist())]


def _learn(tokenizer, kept: dict):
    """Ids of new pieces: the library's model gives them for the bytes of a plain piece as its
    pre-tokenizer spells them; odd words go to the library whole."""
    if "spelt" not in kept:
        plain = [chr(c) for c in range(256) if _KIND[c] not in (_CUT, _SPACE, _ODD) and _LOWER[c] == c]
        kept["spelt"] = str.maketrans({c: "".join(x for x, _ in tokenizer.pre_tokenizer.pre_tokenize_str(c)) for c in plain})
    spelt, tokenize = kept["spelt"], tokenizer.model.tokenize

    def ids_of(pieces: list[bytes]) -> Iterator[list[int]]:
        for odd, some in groupby(pieces, lambda p: p.startswith(b" ")):
            if odd:
                words = [p[1:].decode("utf-8", "surrogatepass") for p in some]
                for part in _slices(words):
                    yield from (e.ids for e in tokenizer.encode_batch_fast(words[part], add_special_tokens=False))
            else:
                for piece in b"\n".join(some).decode("latin-1").translate(spelt).split("\n"):
                    yield [t.id for t in tokenize(piece)]
    return ids_of


def _encode_parts(texts: list[str], tokenizer, kept: dict) -> list[np.ndarray]:
    """Ids of every text from those of its pieces.

    The library drops spaces and line feeds and no id spans one. Words of plain characters are
    cut as the library's pattern cuts them; the others are one piece. Equal pieces are encoded once.
    """
    ids = kept.setdefault("ids", _Ids())
    text = "\n".join(texts)
    char = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    small = np.minimum(char, 256).astype(np.uint16)
    kind, lower = _KIND[small], _LOWER[small]
    odd, words = _odd_words(text, char, kind)
    for start, word in zip(odd.tolist(), words):
        kind[start:start + len(word)] = _CUT
    starts, solid = np.flatnonzero(_begins(lower, kind)), kind > _SPACE
    offsets = np.append(np.cumsum(solid, dtype=np.int32)[starts] - 1, np.count_nonzero(solid)).astype(np.int32)
    plain = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(lower[solid])])
    whole = pa.array([b" " + w.encode("utf-8", "surrogatepass") for w in words], pa.binary())
    found = pa.concat_arrays([plain, whole]).dictionary_encode()
    numbers = ids.numbers(found.dictionary, _learn(tokenizer, kept))[found.indices.to_numpy()]
    places = np.searchsorted(starts, odd)
    numbers = np.insert(numbers[:len(starts)], places, numbers[len(starts):])
    starts = np.insert(starts, places, odd)
    out = ids.joined(numbers, np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts])[:-1]))
    ids.forget()
    return out


def encode(texts: list[str], tokenizer, kept: dict | None = None) -> list[np.ndarray]:
    """Ids of every text as the library gives them without special tokens, then the end id.

    ``kept`` holds the ids of pieces from one call to the next.
    """
    kept = {} if kept is None else kept
    parts, owner = [], []
    for n, text in enumerate(texts):
        for part in _cut_text(text):
            parts.append(part)
            owner.append(n)
    ids: list[list[np.ndarray]] = [[] for _ in texts]
    for some in _slices(parts, PART_CHARS):
        for n, own in zip(owner[some], _encode_parts(parts[some], tokenizer, kept)):
            ids[n].append(own)
    end = np.array([END_ID], dtype="<u4")
    return [np.concatenate([*own, end]) for own in ids]


def _tokenise(path: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = remembered("packing")
        if path not in kept:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task is one core; no pool of threads in it
            from tokenizers import Tokenizer
            kept[path] = Tokenizer.from_file(path)
        tokenizer = kept[path]
        for batch in pieces(batches, 8 << 20):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            out = {k: [] for k in ("doc_id", "uid", "start", "length", "ids_crc32", "doc_tokens", "loss_tokens", "ids")}
            for doc_id, uid, ids in zip(batch.column("doc_id").to_pylist(), batch.column("uid").to_pylist(), encode(texts, tokenizer, kept)):
                for start in range(0, len(ids), SEQUENCE):
                    piece = ids[start:start + SEQUENCE]
                    out["doc_id"].append(doc_id)
                    out["uid"].append(uid)
                    out["start"].append(start)
                    out["length"].append(len(piece))
                    out["ids_crc32"].append(zlib.crc32(piece.astype("<u4").tobytes()))
                    out["doc_tokens"].append(len(ids))
                    out["loss_tokens"].append(len(piece))
                    out["ids"].append(piece.astype(np.int32) if with_ids else None)
            if not with_ids:
                del out["ids"]
            yield pa.RecordBatch.from_pydict(out, schema=_schema(with_ids))
    return run


def _schema(with_ids: bool) -> pa.Schema:
    fields = [("doc_id", pa.int64()), ("uid", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
              ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("loss_tokens", pa.int64())]
    return pa.schema(fields + ([("ids", pa.list_(pa.int32()))] if with_ids else []))


def tokenised_pieces(docs: DataFrame, tokenizer_path: str, with_ids: bool = True) -> DataFrame:
    """Pieces of at most ``SEQUENCE`` ids of every row of ``docs``, written once.

    ``doc_id, uid, start, length, ids_crc32, doc_tokens, loss_tokens[, ids]``: ``start`` counts
    the document's ids before the piece, ``doc_tokens`` all of them (with the end id),
    ``ids_crc32`` is crc32 of the piece's ids as little-endian unsigned 32-bit numbers, ``uid``
    numbers rows uniquely (with ``start`` it names a piece). A null text is empty and has one piece: the end id. Every row is a
    document, repeated rows too.
    """
    rows = spread(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                               F.monotonically_increasing_id().alias("uid"))
    schema = "doc_id long, uid long, start long, length long, ids_crc32 long, doc_tokens long, loss_tokens long" + (
        ", ids array<int>" if with_ids else "")
    return materialise(rows.mapInArrow(_tokenise(tokenizer_path, with_ids), schema), "packing-pieces")


def _dot_product_bins(tokens: np.ndarray, segments: np.ndarray, loss: np.ndarray,
                      limits: tuple[int, int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every item, bins filled one at a time by the dot-product rule."""
    n = len(tokens)
    demand = np.stack([tokens / limits[0], segments / limits[1], loss / limits[2]], axis=1)
    raw = np.stack([tokens, segments, loss]).astype(np.int64)
    left = np.ones(n, dtype=bool)
    bins, offsets = np.full(n, -1, dtype=np.int64), np.zeros(n, dtype=np.int64)
    b, placed = 0, 0
    while placed < n:
        room = np.array(limits, dtype=np.int64)
        used = 0
        while True:
            fits = left & (raw[0] <= room[0]) & (raw[1] <= room[1]) & (raw[2] <= room[2])
            if not fits.any():
                break
            score = np.where(fits, demand @ (room / np.array(limits, dtype=np.float64)), -1.0)
            pick = int(np.argmax(score))
            bins[pick], offsets[pick] = b, used
            used += int(raw[0, pick])
            room -= raw[:, pick]
            left[pick] = False
            placed += 1
        b += 1
    return bins, offsets


def _pack_group(limits: tuple[int, int, int]):
    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "uid", "start"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
        bins, offsets = _dot_product_bins(frame["length"].to_numpy(), np.ones(len(frame), dtype=np.int64),
                                          frame["loss_tokens"].to_numpy(), limits)
        frame["sequence_id"] = (int(key[0]) << 32) + bins
        frame["offset"] = offsets
        return frame
    return run


def pack(pieces: DataFrame, sequence: int = SEQUENCE, max_segments: int = MAX_SEGMENTS,
         max_loss_tokens: int = MAX_LOSS_TOKENS) -> DataFrame:
    """Assign every piece a ``sequence_id`` and an ``offset`` there (gapless from 0).

    ``pieces`` needs ``uid`` and ``start`` (unique together), ``length`` (at most ``sequence``) and ``loss_tokens``; its other
    columns pass through. A sequence holds at most ``sequence`` tokens, ``max_segments`` pieces
    and ``max_loss_tokens`` loss-bearing tokens. No pieces give no rows.
    """
    spark = pieces.sparkSession
    total = pieces.agg(F.coalesce(F.sum("length"), F.lit(0)), F.count("*")).first()
    groups = max(1, -(-total[0] // GROUP_TOKENS), -(-total[1] // GROUP_PIECES))
    dealt = pieces.withColumn("_group", F.pmod(F.xxhash64("uid", "start"), F.lit(groups)))
    schema = StructType([*dealt.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())])
    limits = (sequence, max_segments, max_loss_tokens)
    return dealt.groupBy("_group").applyInPandas(_pack_group(limits), schema).drop("_group")


def pack_documents(docs: DataFrame, tokenizer_path: str, with_ids: bool = True) -> DataFrame:
    """Pieces of every document in packed sequences: the columns of ``tokenised_pieces`` with
    ``sequence_id`` and ``offset``. Extra input columns are ignored."""
    return pack(tokenised_pieces(docs, tokenizer_path, with_ids))
