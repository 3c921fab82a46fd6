"""Exact n-gram Jaccard join with token-combination prefixes.

A document is the set of hashes of its word shingles; equal sets are one class (a node).
Tokens are ordered from rare to frequent. For similarity t two sets of n tokens that link
share at least a = ceil(t n) of them and differ in at most d = floor(n (1 - t) / t):

* single tokens: they share one of the n - a + 1 rarest tokens of both;
* combinations: if that first shared token belongs to the frequent class, all shared
  tokens do. Among the first d + 2 shared tokens two neighbours have no other token of
  either set between them, so both sets hold them as neighbours, within the first
  n - a + d + 2 tokens. The frequent class is indexed by such neighbouring pairs, which
  are as many as the prefix is long.

Frequencies come from exchanging tokens, packed by slices of the token space; tokens that
only one class has never come back. The few tokens that many documents of one batch share
are found beforehand and stay out of the exchange, so no slice is hot. Documents with a
common key form candidate groups, linked in stars, never in pairs; their sets are compared
in full, blocks with blocks, and what is linked already is not compared again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from tidegate.storage import materialise

from .common import block_pairs, components, join_checked, mix, pieces, prefix_hash, span_hash, utf8

#: A token goes to the frequent class if this many documents of a batch share it ...
LOCAL_COUNT = 8
#: ... and these batches add up to so many; the table of the class has a size bound.
FREQUENT_COUNT = 64
FREQUENT_TOKENS = 1 << 16
BATCH_TOKENS = 1 << 20
#: Bytes of sets in a block of a candidate group.
BLOCK_BYTES = 16 << 20
_TILE = 256
_COLUMNS = 4096
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Bytes of text hashed at once.
_LIMIT = 1 << 20


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of all texts, and the text each belongs to."""
    joined, ends = b"\n".join(texts).lower(), np.cumsum([len(t) + 1 for t in texts])
    data, hashes, starts, at = np.frombuffer(joined, np.uint8), [], [], 0
    while at < len(data):  # long texts in parts, cut at white space
        end = min(len(data), at + _LIMIT)
        while end < len(data) and not _SPACE[data[end]]:
            end += 1
        part = data[at:end]
        edges = np.diff(np.concatenate([[True], _SPACE[part], [True]]).astype(np.int8))
        first, last = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
        hashes.append(span_hash(prefix_hash(part), first, last))
        starts.append(first + at)
        at = end
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.searchsorted(ends, np.concatenate(starts), "right")


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; fewer than ``width`` words are one shingle."""
    hashes, owner = word_hashes(texts)
    counts = np.bincount(owner, minlength=len(texts))
    rolled = np.zeros(len(hashes), np.uint64)
    for i in range(min(width, len(hashes))):
        rolled[:len(hashes) - i] = rolled[:len(hashes) - i] * np.uint64(0x100000001B3) + hashes[i:]
    rolled, sets, at = mix(rolled), [], 0
    for count in counts.tolist():
        if count >= width:
            sets.append(np.unique(rolled[at:at + count - width + 1]))
        elif count:
            short = np.array([count], np.uint64)
            for i in range(at, at + count):
                short = short * np.uint64(0xC2B2AE3D27D4EB4F) + hashes[i:i + 1]
            sets.append(mix(short))
        else:
            sets.append(np.zeros(0, np.uint64))
        at += count
    return sets


def set_name(tokens: np.ndarray) -> int:
    """A 64-bit name of a set (signed), equal for equal sets."""
    folded = mix(np.bitwise_xor.reduce(mix(tokens), keepdims=True) + np.add.reduce(tokens, keepdims=True) * np.uint64(3) + np.uint64(len(tokens)))
    return int(folded.astype(np.int64)[0])


def _batches(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[list, list[np.ndarray]]]:
    """Ids and sets of a few thousand documents at a time."""
    ids, sets, total = [], [], 0
    for piece in pieces(batches, _LIMIT):
        new = shingle_sets(utf8(piece.column("text")), width)
        ids, sets, total = ids + piece.column("doc_id").to_pylist(), sets + new, total + sum(map(len, new))
        if total >= BATCH_TOKENS:
            yield ids, sets
            ids, sets, total = [], [], 0
    if ids:
        yield ids, sets


def _differing(n: int, percent: int) -> int:
    return n * (100 - percent) // percent


def frequent_tokens(docs: DataFrame, width: int) -> np.ndarray:
    """Tokens of the frequent class from rare to frequent; a batch counts equal sets once."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sets in _batches(batches, width):
            classes = {set_name(s): s for s in sets if len(s)}
            tokens, counts = np.unique(np.concatenate([np.zeros(0, np.uint64), *classes.values()]), return_counts=True)
            often = counts >= LOCAL_COUNT
            yield pa.RecordBatch.from_pydict({"token": tokens[often].astype(np.int64), "n": counts[often].astype(np.int64)})

    counted = docs.mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") >= FREQUENT_COUNT)
    rows = counted.orderBy(F.desc("n"), "token").limit(FREQUENT_TOKENS).collect()
    return np.array([r.token for r in reversed(rows)], np.int64).astype(np.uint64)


_EXCHANGED = "slice int, batch string, tokens binary, owners binary, classes binary, docs array<struct<doc_id:bigint,n:bigint,rare:int,node:bigint>>, combos array<struct<node:bigint,key:bigint>>"
_DOCS = pa.list_(pa.struct([("doc_id", pa.int64()), ("n", pa.int64()), ("rare", pa.int32()), ("node", pa.int64())]))
_COMBOS = pa.list_(pa.struct([("node", pa.int64()), ("key", pa.int64())]))


def _exchange(docs: DataFrame, width: int, percent: int, slices: int) -> DataFrame:
    """Tokens go by slices to where their classes are counted; shared ones come back by batch."""
    frequent = frequent_tokens(docs, width)
    by_token = np.argsort(frequent)
    shared = docs.sparkSession.sparkContext.broadcast((frequent[by_token], by_token))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, place = shared.value
        part, number, sent = TaskContext.get().partitionId(), 0, set()
        rows: dict[str, list] = {}

        def flush() -> pa.RecordBatch:
            nonlocal number
            batch, number = f"{part}-{number}", number + 1
            tokens = np.concatenate([np.zeros(0, np.uint64), *rows["tokens"]])
            owners = np.concatenate([np.zeros(0, np.uint32), *rows["owners"]])
            slot = (tokens % np.uint64(slices)).astype(np.int64)
            order = np.argsort(slot, kind="stable")
            used, starts = np.unique(slot[order], return_index=True)
            low = (tokens[order] >> np.uint64(32)).astype(np.uint32)
            cut = lambda x: [p.tobytes() for p in np.split(x, starts[1:])] if len(used) else []
            none = [None] * len(used)
            return pa.RecordBatch.from_pydict({
                "slice": pa.array([*used.tolist(), -1 - hash_of(batch) % slices], pa.int32()),
                "batch": pa.array([batch] * (len(used) + 1)),
                "tokens": pa.array([*cut(low), None], pa.binary()), "owners": pa.array([*cut(owners[order]), None], pa.binary()),
                "classes": pa.array([*none, None], pa.binary()),
                "docs": pa.array([*none, rows["docs"]], _DOCS), "combos": pa.array([*none, rows["combos"]], _COMBOS)})

        for ids, sets in _batches(batches, width):
            rows = {"tokens": [], "owners": [], "docs": [], "combos": []}
            short: dict[int, int] = {}
            for doc_id, tokens in zip(ids, sets, strict=True):
                node, n = set_name(tokens) if len(tokens) else None, len(tokens)
                if node is None or node in sent or not _differing(n, percent):
                    rows["docs"].append({"doc_id": doc_id, "n": n, "rare": -1, "node": node})
                    continue
                own = node & 0xFFFFFFFF
                if short.setdefault(own, node) != node:  # two sets of a batch must differ in these bits
                    yield flush()
                    rows, short = {"tokens": [], "owners": [], "docs": [], "combos": []}, {own: node}
                at = np.minimum(np.searchsorted(names, tokens), max(0, len(names) - 1))
                often = names[at] == tokens if len(names) else np.zeros(n, bool)
                rare = tokens[~often]
                rows["docs"].append({"doc_id": doc_id, "n": n, "rare": len(rare), "node": node})
                rows["tokens"].append(rare)
                rows["owners"].append(np.full(len(rare), own, np.uint32))
                reach = n + percent * n // -100 + _differing(n, percent) + 2 - len(rare)
                if reach > 1:
                    ordered = np.sort(place[at[often]])[:reach].astype(np.uint64)
                    keys = mix((ordered[:-1] << np.uint64(32)) | ordered[1:]).astype(np.int64)
                    rows["combos"].extend({"node": node, "key": k} for k in keys.tolist())
                sent.add(node)
            yield flush()

    def count(table: pa.Table) -> pa.Table:
        if table.column("slice")[0].as_py() < 0:
            return table
        tokens = [np.frombuffer(x, np.uint32) for x in table.column("tokens").to_pylist()]
        owners = [np.frombuffer(x, np.uint32) for x in table.column("owners").to_pylist()]
        row = np.repeat(np.arange(len(tokens)), [len(t) for t in tokens])
        tokens, owners = np.concatenate(tokens), np.concatenate(owners)
        pairs = np.unique((tokens.astype(np.uint64) << np.uint64(32)) | owners)
        names, counts = np.unique((pairs >> np.uint64(32)).astype(np.uint32), return_counts=True)
        often = counts > 1
        names, classes = names[often], np.ceil(np.log2(counts[often])).astype(np.uint8)
        at = np.minimum(np.searchsorted(names, tokens), max(0, len(names) - 1))
        back = np.flatnonzero(names[at] == tokens) if len(names) else np.zeros(0, np.int64)
        used, starts = np.unique(row[back], return_index=True)
        cut = lambda x: [p.tobytes() for p in np.split(x, starts[1:])] if len(used) else []
        kept = table.take(pa.array(used))
        columns = {"tokens": cut(tokens[back]), "owners": cut(owners[back]), "classes": cut(classes[at[back]])}
        for name, values in columns.items():
            kept = kept.set_column(kept.schema.get_field_index(name), name, pa.array(values, pa.binary()))
        return kept

    return docs.mapInArrow(send, _EXCHANGED).groupBy("slice").applyInArrow(count, _EXCHANGED)


def hash_of(text: str) -> int:
    return int(mix(np.array([int.from_bytes(text.encode()[-8:], "little")], np.uint64))[0] >> np.uint64(8))


def _prefix_keys(exchanged: DataFrame, percent: int) -> DataFrame:
    """``node, key``: single rare tokens of the prefixes and neighbouring pairs of frequent ones."""
    def decode(table: pa.Table) -> pa.Table:
        slices = table.column("slice").to_numpy()
        back = table.filter(pa.array(slices >= 0))
        docs = [d for x in table.column("docs").to_pylist() for d in x or () if d["rare"] >= 0]
        combos = [c for x in table.column("combos").to_pylist() for c in x or ()]
        nodes = np.array([d["node"] for d in docs], np.int64)
        tokens = [np.frombuffer(x, np.uint32) for x in back.column("tokens").to_pylist()]
        slot = np.repeat(slices[slices >= 0].astype(np.int64), [len(t) for t in tokens])
        key = (slot << 32) | np.concatenate([np.zeros(0, np.uint32), *tokens])
        own = np.concatenate([np.zeros(0, np.uint32), *[np.frombuffer(x, np.uint32) for x in back.column("owners").to_pylist()]])
        level = np.concatenate([np.zeros(0, np.uint8), *[np.frombuffer(x, np.uint8) for x in back.column("classes").to_pylist()]])
        low = (nodes & 0xFFFFFFFF).astype(np.uint32)
        by_low = np.argsort(low)
        doc = by_low[np.searchsorted(low[by_low], own)] if len(docs) else np.zeros(0, np.int64)
        order = np.lexsort((key, level, doc))
        doc, key = doc[order], key[order]
        counts = np.bincount(doc, minlength=len(docs))
        rank = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
        n, rare = (np.array([d[c] for d in docs], np.int64) for c in ("n", "rare"))
        # what came back stands behind the tokens that only this set has
        reach = n - -(-percent * n // 100) + 1 - (rare - counts)
        take = rank < reach[doc] if len(docs) else np.zeros(0, bool)
        return pa.table({"node": np.concatenate([nodes[doc[take]], np.array([c["node"] for c in combos], np.int64)]),
                         "key": np.concatenate([key[take], np.array([c["key"] for c in combos], np.int64)])})

    return exchanged.groupBy("batch").applyInArrow(decode, "node long, key long")


def _tiles(sets: list[np.ndarray], low: np.ndarray, same: bool, percent: int) -> tuple[list[int], list[int]]:
    """A spanning forest of the links between the two blocks, or inside the one."""
    size = np.array([len(s) for s in sets])
    parent = np.arange(len(sets))
    one: list[int] = []
    two: list[int] = []

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = int(parent[x])
        return x

    sides = [np.flatnonzero(low), np.flatnonzero(low if same else ~low)]
    sides = [side[np.argsort(size[side], kind="stable")] for side in sides]
    left, right = ([side[i:i + _TILE] for i in range(0, len(side), _TILE)] for side in sides)
    for i, a in enumerate(left):
        for b in right[i if same else 0:]:
            if 100 * size[a].max() < percent * size[b].min() or 100 * size[b].max() < percent * size[a].min():
                continue
            if len({root(x) for x in (*a.tolist(), *b.tolist())}) == 1:
                continue
            common = np.intersect1d(np.concatenate([sets[x] for x in a]), np.concatenate([sets[x] for x in b]))
            shared = np.zeros((len(a), len(b)), np.float64)
            for start in range(0, len(common), _COLUMNS):
                names = common[start:start + _COLUMNS]
                shared += _rows(sets, a, names) @ _rows(sets, b, names).T
            linked = 100 * shared >= percent * (size[a][:, None] + size[b][None] - shared)
            for x, y in zip(*np.nonzero(linked), strict=True):
                x, y = int(a[x]), int(b[y])
                rx, ry = root(x), root(y)
                if rx != ry:
                    parent[max(rx, ry)] = min(rx, ry)
                    one.append(x)
                    two.append(y)
    return one, two


def _rows(sets: list[np.ndarray], which: np.ndarray, names: np.ndarray) -> np.ndarray:
    """0/1 rows of the tokens ``names`` (sorted) of some sets."""
    out = np.zeros((len(which), len(names)), np.float32)
    for i, x in enumerate(which):
        own = sets[x]
        own = own[np.searchsorted(own, names[0]):np.searchsorted(own, names[-1], "right")]
        at = np.searchsorted(names, own)
        out[i, at[names[at] == own]] = 1
    return out


def similar_documents(docs: DataFrame, width: int = 5, percent: int = 80, slices: int | None = None) -> DataFrame:
    """``doc_id, n_shingles, component_id``: one row per row of ``docs(doc_id, text)``.

    Two rows link when 100 |A and B| >= percent |A or B| for their sets of ``width``-word
    shingles (words are separated by ASCII white space, A-Z are lower-cased; a text of fewer words
    is one shingle). ``component_id`` is the smallest ``doc_id`` reachable by links. Null,
    empty and blank texts have no shingles and link with nothing. Rows that repeat an id are
    rows of their own; rows with equal sets always link. A null id is never the smallest.
    """
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    slices = slices or 8 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    exchanged = materialise(_exchange(rows, width, percent, slices), "shingles")
    listed = exchanged.where("slice < 0").select(F.explode("docs").alias("d")).select("d.doc_id", "d.n", "d.node")
    keys = materialise(_prefix_keys(exchanged, percent), "shingle-keys")
    heads = keys.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("last")).where("a < last").select("key", "a")
    near = components(keys.join(heads, "key").select(F.col("node").alias("b"), "a"), "shingle-candidates")
    linked = components(_verify(rows, listed, near, width, percent), "shingle-links")
    known = listed.where("node is not null")
    ids = known.groupBy("node").agg(F.min("doc_id").alias("least")).join(linked, "node", "left")
    root = F.coalesce("root", "node")
    lowest = ids.groupBy(root.alias("root")).agg(F.min("least").alias("component_id"))
    named = ids.select("node", root.alias("root")).join(lowest, "root").select("node", "component_id")
    empty = listed.where("node is null").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return (known.join(named, "node").select("doc_id", "n", "component_id").unionByName(empty)
            .withColumnRenamed("n", "n_shingles"))


def _verify(rows: DataFrame, listed: DataFrame, near: DataFrame, width: int, percent: int) -> DataFrame:
    """``a, b``: a spanning forest of the true links inside each candidate group."""
    key = F.coalesce("doc_id", F.lit(-1 << 63)).alias("id")
    members = (listed.where("node is not null").join(near, "node")
               .groupBy("node", "root").agg(F.min(F.coalesce("doc_id", F.lit(-1 << 63))).alias("id")))
    members = materialise(members.select("id", "node", "root"), "shingle-members")

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, _LIMIT):
            sets = shingle_sets(utf8(piece.column("text")), width)
            good = [i for i, (s, node) in enumerate(zip(sets, piece.column("node").to_pylist(), strict=True)) if len(s) and set_name(s) == node]
            yield pa.RecordBatch.from_pydict({
                "root": piece.column("root").take(pa.array(good, pa.int64())), "node": piece.column("node").take(pa.array(good, pa.int64())),
                "tokens": pa.array([sets[i].tobytes() for i in good], pa.binary())})

    def compare(table: pa.Table) -> pa.Table:
        nodes, blk = table.column("node").to_numpy(), table.column("blk").to_numpy()
        first, second = table.column("lo")[0].as_py(), table.column("hi")[0].as_py()
        nodes, keep = np.unique(nodes, return_index=True)  # a repeated id brings its set once
        sets = [np.frombuffer(table.column("tokens")[int(i)].as_py(), np.uint64) for i in keep]
        one, two = _tiles(sets, blk[keep] == first, first == second, percent)
        return pa.table({"a": nodes[np.array(one, np.int64)], "b": nodes[np.array(two, np.int64)]})

    texts = join_checked(rows.select(key, "text"), members, "id", "inner").select("text", "node", "root")
    sets = materialise(texts.mapInArrow(sets_of, "root long, node long, tokens binary"), "shingle-sets")
    dealt = block_pairs(sets, ["root"], F.octet_length("tokens"), BLOCK_BYTES)
    return dealt.groupBy("root", "lo", "hi").applyInArrow(compare, "a long, b long")
