"""Removal of repeated byte strings by distributed suffix sorting.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts in a document with
a smaller id. Every string (window) belongs to the run of windows that share its smallest
hashed gram, so equal windows have equal grams. Runs, packed by slices of the gram space,
meet in two steps:

1. A run equal to one of a smaller document is covered whole. What is left are runs at the
   edges of repeated passages: equal grams, unequal runs, one for each distinct run.
2. The windows of these runs are sorted as suffixes, deep-shallow: multikey quicksort over
   eight-byte words down to ``SHALLOW`` bytes, then blind tries for the groups that still
   agree. Windows that are equal to the end stand together; the smallest document keeps.

Where the runs of one gram have more than ``HOT_WINDOWS`` windows, these are dealt singly by
a hash of their bytes, and of equal ones in a batch only those of the smallest document go.

Equal texts are one unit throughout, so a group of copies is exchanged once for each task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from tidegate.storage import materialise

from .common import join_checked, pieces, prefix_hash, span_hash, utf8
from .jaccard import hash_of

LENGTH = 50
GRAM = 24
SHALLOW = 24
#: Windows of one run; a longer run, as in periodic text, goes on as a new one.
RUN = 64
BATCH_RUNS = 200_000
#: Windows of one gram that are sorted in one group; so many are also looked at at once.
HOT_WINDOWS = 200_000
#: Added to the size of an open run whose gram has more.
_HOT = 128
_PIECE = 1 << 19
_NONE = (1 << 63) - 1
_TYPES = {"gram": np.uint32, "run": np.uint64, "unit": np.uint16, "start": np.uint32, "count": np.uint8}


def runs(data: np.ndarray, doc: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Runs of windows inside the documents of a buffer: gram hash, run hash, start, windows."""
    width, none = length - GRAM + 1, np.zeros(0, np.int64)
    if len(data) < length:
        return none.astype(np.uint64), none.astype(np.uint64), none, none
    prefix = prefix_hash(data)
    at = np.arange(len(data) - GRAM + 1)
    low, size = span_hash(prefix, at, at + GRAM), 1
    while 2 * size <= width:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    n = len(data) - length + 1
    low = np.minimum(low[:n], low[width - size:width - size + n])
    valid = doc[:n] == doc[length - 1:]
    new = np.ones(n, bool)
    new[1:] = (low[1:] != low[:-1]) | (doc[1:n] != doc[:n - 1]) | ~valid[:-1]
    first = np.flatnonzero(new & valid)
    # a run ends where the next one or an invalid window begins
    stops = np.flatnonzero(np.concatenate([new | ~valid, [True]]))
    last = stops[np.searchsorted(stops, first, "right")]
    parts = -(-(last - first) // RUN)
    which = np.repeat(np.arange(len(first)), parts)
    start = first[which] + RUN * (np.arange(len(which)) - np.repeat(np.cumsum(parts) - parts, parts))
    count = np.minimum(last[which] - start, RUN)
    return low[start], span_hash(prefix, start, start + count + length - 1), start, count


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One buffer of all texts, the text of each byte, and where texts begin."""
    lengths = np.array([len(t) for t in texts], np.int64)
    return np.frombuffer(b"".join(texts), np.uint8), np.repeat(np.arange(len(texts)), lengths), np.cumsum(lengths) - lengths


def text_runs(texts: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """Runs of all texts: gram, run, text, start in it, windows. A huge text goes in overlapping parts."""
    out = []
    small = [i for i, t in enumerate(texts) if len(t) <= 4 * _PIECE]
    data, doc, begin = _joined([texts[i] for i in small])
    gram, run, start, count = runs(data, doc, length)
    own = doc[start]
    out.append((gram, run, np.array(small, np.int64)[own] if len(own) else own, start - begin[own], count))
    for i, text in enumerate(texts):
        for at in range(0, len(text), _PIECE) if len(text) > 4 * _PIECE else ():
            data = np.frombuffer(text[at:at + _PIECE + length - 1], np.uint8)
            gram, run, start, count = runs(data, np.zeros(len(data), np.int8), length)
            out.append((gram, run, np.full(len(start), i), start + at, count))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


_PACKED = ("slice int, batch string, gram binary, run binary, unit binary, start binary, count binary, bytes binary, "
           "ids binary, units array<struct<doc_id:bigint,name:string>>")
_UNITS = pa.list_(pa.struct([("doc_id", pa.int64()), ("name", pa.string())]))


def _pack(batch: str, slices: int, gram: np.ndarray, columns: dict[str, np.ndarray], units: list[tuple[int, str]],
          texts: list[bytes] | None = None) -> pa.RecordBatch:
    """One row for each slice that the grams fall into, and one (slice below 0) with the units of the batch."""
    slot = (gram % np.uint64(slices)).astype(np.int64)
    order = np.argsort(slot, kind="stable")
    used, starts = np.unique(slot[order], return_index=True)
    cut = lambda x: [p.tobytes() for p in np.split(x[order], starts[1:])] if len(used) else []
    data = {"gram": cut((gram >> np.uint64(32)).astype(np.uint32)), **{k: cut(v.astype(_TYPES[k])) for k, v in columns.items()}}
    if texts is not None:
        data["bytes"] = [b"".join(texts[i] for i in p) for p in np.split(order, starts[1:])] if len(used) else []
    ids = np.array([d for d, _ in units], np.int64).tobytes()
    data["ids"] = [ids] * len(used)
    arrays = {name: pa.array([*data.get(name, [None] * len(used)), None], pa.binary())
              for name in ("gram", "run", "unit", "start", "count", "bytes", "ids")}
    return pa.RecordBatch.from_pydict({
        "slice": pa.array([*used.tolist(), -1 - hash_of(batch) % slices], pa.int32()), "batch": pa.array([batch] * (len(used) + 1)),
        **arrays, "units": pa.array([None] * len(used) + [[{"doc_id": d, "name": n} for d, n in units]], _UNITS)})


def _unpack(table: pa.Table, name: str) -> np.ndarray:
    return np.concatenate([np.zeros(0, _TYPES[name]), *[np.frombuffer(x, _TYPES[name]) for x in table.column(name).to_pylist() if x]])


def _owners(table: pa.Table, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The row of each entry and the id of its document."""
    sizes = [len(x) // 2 for x in table.column("unit").to_pylist()]
    row, ids = np.repeat(np.arange(len(sizes)), sizes), [np.frombuffer(x, np.int64) for x in table.column("ids").to_pylist()]
    base = np.cumsum([0, *map(len, ids)])
    return row, np.concatenate(ids)[base[row] + unit]


def _answer(table: pa.Table, row: np.ndarray, columns: dict[str, np.ndarray]) -> pa.Table:
    """Rows of ``table`` that still have entries, with these entries only."""
    used, starts = np.unique(row, return_index=True)
    kept = table.take(pa.array(used)).select(["slice", "batch"])
    cut = lambda x: [p.tobytes() for p in np.split(x, starts[1:])] if len(used) else []
    for name in ("gram", "run", "unit", "start", "count", "bytes", "ids"):
        kept = kept.append_column(name, pa.array(cut(columns[name].astype(_TYPES[name])) if name in columns else [None] * len(used), pa.binary()))
    return kept.append_column("units", pa.array([None] * len(used), _UNITS))


def _heads(*keys: np.ndarray) -> np.ndarray:
    """Where a new combination of sorted keys begins."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return new


def _per_group(new: np.ndarray, values: np.ndarray, reduce: np.ufunc) -> np.ndarray:
    """A reduction of each group, given to all its members."""
    return reduce.reduceat(values, np.flatnonzero(new))[np.cumsum(new) - 1] if len(new) else values


def _whole_runs(table: pa.Table) -> pa.Table:
    """Step 1 on one slice. Entries come back with ``run`` 0 where covered, 1 where windows must be looked at, 2 where their gram has too many."""
    if table.column("slice")[0].as_py() < 0:
        return table
    unit = _unpack(table, "unit")
    row, doc = _owners(table, unit)
    gram, run, start, count = (_unpack(table, c) for c in ("gram", "run", "start", "count"))
    order = np.lexsort((doc, run, gram))
    gram, run, doc, windows = gram[order], run[order], doc[order], count[order].astype(np.int64)
    of_gram, of_run = _heads(gram), _heads(gram, run)
    covered = doc > _per_group(of_run, doc, np.minimum)
    several = _per_group(of_gram, of_run.astype(np.int64), np.add) > 1
    apart = _per_group(of_gram, doc, np.minimum) != _per_group(of_gram, doc, np.maximum)
    back = covered | (several & apart)
    hot = _per_group(of_gram, np.where(back & ~covered, windows, 0), np.add) > HOT_WINDOWS
    where, open_run = order[back], np.where(covered, 0, 1 + hot)[back].astype(np.uint64)
    by_row = np.argsort(row[where], kind="stable")
    where, open_run = where[by_row], open_run[by_row]
    return _answer(table, row[where], {"unit": unit[where], "start": start[where], "count": count[where], "run": open_run})


def deep_shallow(strings: np.ndarray, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Sort the rows of a byte matrix: their order, and for each place whether a new string begins.

    ``shallow`` bytes are sorted by multikey quicksort, eight bytes a step, all groups of a
    step at once and settled groups no more. Groups that agree so far become blind tries: a
    node branches at the first byte in which its members differ from one of them, and only
    that byte is looked at.
    """
    n, width = strings.shape
    order, new = np.arange(n), np.zeros(n, bool)
    new[:1] = True
    for depth in range(0, min(shallow, width), 8):
        group = np.cumsum(new) - 1
        many = np.flatnonzero((np.bincount(group, minlength=1) > 1)[group]) if n else order
        if not len(many):
            return order, new
        part = np.zeros((len(many), 8), np.uint8)
        piece = strings[order[many], depth:min(depth + 8, shallow, width)]
        part[:, :piece.shape[1]] = piece
        word = part.view(">u8")[:, 0].astype(np.uint64)
        sub = np.lexsort((word, group[many]))
        order[many] = order[many][sub]
        new[many] |= _heads(group[many], word[sub])
    rest = strings[:, min(shallow, width):]
    settled = np.zeros(n, bool)
    while n and rest.shape[1]:
        group = np.cumsum(new) - 1
        leader = np.flatnonzero(new)
        open_ = np.flatnonzero((np.bincount(group) > 1)[group] & ~settled)
        if not len(open_):
            break
        differs = rest[order[open_]] != rest[order[leader[group[open_]]]]
        agree = np.where(differs.any(1), differs.argmax(1), rest.shape[1])
        head = _heads(group[open_])
        branch = _per_group(head, agree, np.minimum)
        alike = branch == rest.shape[1]
        settled[open_[alike]] = True
        open_, branch = open_[~alike], branch[~alike]
        byte = rest[order[open_], branch]
        sub = np.lexsort((byte, group[open_]))
        order[open_] = order[open_][sub]
        new[open_] |= _heads(group[open_], byte[sub])
    return order, new


def _windows(table: pa.Table, length: int) -> pa.Table:
    """Step 2 on one slice: sort the windows of all its runs, return the covered ones."""
    if table.column("slice")[0].as_py() < 0:
        return table
    unit = _unpack(table, "unit")
    row, doc = _owners(table, unit)
    start, count = _unpack(table, "start").astype(np.int64), _unpack(table, "count").astype(np.int64)
    data = np.frombuffer(b"".join(x for x in table.column("bytes").to_pylist() if x), np.uint8)
    sizes = count + length - 1
    entry = np.repeat(np.arange(len(count)), count)
    offset = np.arange(len(entry)) - np.repeat(np.cumsum(count) - count, count)
    place = (np.cumsum(sizes) - sizes)[entry] + offset
    covered = np.zeros(len(entry), bool)
    # windows of one gram only can be equal: take some whole grams at a time to bound memory
    gram = _unpack(table, "gram")[entry]
    by_gram = np.argsort(gram, kind="stable")
    cuts = np.flatnonzero(_heads(gram[by_gram]))
    view = np.lib.stride_tricks.sliding_window_view(data, length) if len(data) >= length else np.zeros((0, length), np.uint8)
    at = 0
    while at < len(by_gram):
        later = cuts[np.searchsorted(cuts, at + HOT_WINDOWS):]
        end = int(later[0]) if len(later) else len(by_gram)
        mine = by_gram[at:end]
        order, new = deep_shallow(view[place[mine]])
        owners = doc[entry[mine]][order]
        covered[mine[order]] = owners > _per_group(new, owners, np.minimum)
        at = end
    hit = np.flatnonzero(covered)
    return _answer(table, row[entry[hit]], {"unit": unit[entry[hit]], "start": start[entry[hit]] + offset[hit],
                                            "count": np.ones(len(hit)), "run": np.zeros(len(hit))})


def _merge(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of intervals, touching ones joined."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    new = np.concatenate([[True], start[1:] > reach[:-1]])
    return start[new], reach[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(start) - 1]])]


_SPANS = "name string, doc_id long, starts binary, ends binary, edges binary, sizes binary"


def _by_unit(table: pa.Table) -> pa.Table:
    """The answers of one batch put together by unit: covered windows merged, open runs listed."""
    units = [u for x in table.column("units").to_pylist() for u in x or ()]
    unit, start, count, run = (_unpack(table, c).astype(np.int64) for c in ("unit", "start", "count", "run"))
    order = np.lexsort((start, unit))
    unit, start, count, run = unit[order], start[order], count[order], run[order]
    names, firsts = np.unique(unit, return_index=True)
    out: dict[str, list] = {c.split()[0]: [] for c in _SPANS.split(", ")}
    for number, a, b in zip(names.tolist(), firsts, [*firsts[1:], len(unit)][:len(names)], strict=True):
        part, covered = slice(a, b), run[a:b] == 0
        starts, ends = _merge(start[part][covered], (start[part] + count[part])[covered])
        for name, value in zip(out, (units[number]["name"], units[number]["doc_id"], starts.astype(np.uint32).tobytes(), ends.astype(np.uint32).tobytes(),
                                     start[part][~covered].astype(np.uint32).tobytes(),
                                     (count + _HOT * (run == 2))[part][~covered].astype(np.uint8).tobytes()), strict=True):
            out[name].append(value)
    types = [pa.string(), pa.int64(), *[pa.binary()] * 4]
    return pa.table({k: pa.array(v, t) for (k, v), t in zip(out.items(), types, strict=True)})


def _send(slices: int, length: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, total = TaskContext.get().partitionId(), 0, 0
        sent: dict[bytes, int] = {}
        found, units = [], []
        for piece in pieces(batches, _PIECE):
            texts, ids = utf8(piece.column("text")), piece.column("doc_id").to_pylist()
            first: dict[bytes, tuple[int, int]] = {}
            for i, (text, doc_id) in enumerate(zip(texts, ids, strict=True)):
                if len(text) >= length:
                    name = hashlib.md5(text).digest()
                    if doc_id < min(sent.get(name, _NONE + 1), first.get(name, (_NONE + 1, 0))[0]):
                        first[name] = doc_id, i
            sent.update({name: doc_id for name, (doc_id, _) in first.items()})
            gram, run, own, start, count = text_runs([texts[i] for _, i in first.values()], length)
            found.append((gram, run, own + len(units), start, count))
            units += [(doc_id, name.hex()) for name, (doc_id, _) in first.items()]
            total += len(gram)
            if total >= BATCH_RUNS or len(units) > 30_000:
                gram, *rest = (np.concatenate(x) for x in zip(*found, strict=True))
                yield _pack(f"{part}-{number}", slices, gram, dict(zip(("run", "unit", "start", "count"), rest, strict=True)), units)
                number, total, found, units = number + 1, 0, [], []
        if units:
            gram, *rest = (np.concatenate(x) for x in zip(*found, strict=True))
            yield _pack(f"{part}-{number}", slices, gram, dict(zip(("run", "unit", "start", "count"), rest, strict=True)), units)

    return send


def _hot_windows(texts: list[bytes], doc: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Single windows of runs: hash, run, offset in it, bytes, and whether a smaller document here has the same."""
    data, own, begin = _joined(texts)
    place = np.flatnonzero(own[:len(data) - length + 1] == own[length - 1:])
    hashes = span_hash(prefix_hash(data), place, place + length)
    place = place[np.argsort(hashes, kind="stable")]
    hashes = np.sort(hashes)
    view, covered = np.lib.stride_tricks.sliding_window_view(data, length), np.zeros(len(place), bool)
    cuts, at = np.flatnonzero(_heads(hashes)), 0
    while at < len(place):
        later = cuts[np.searchsorted(cuts, at + HOT_WINDOWS):]
        end = int(later[0]) if len(later) else len(place)
        order, new = deep_shallow(view[place[at:end]])
        owners = doc[own[place[at:end]]][order]
        covered[at + order] = owners > _per_group(new, owners, np.minimum)
        at = end
    run = own[place]
    return hashes, run, place - begin[run], [data[p:p + length].tobytes() for p in place[~covered].tolist()], covered


def _covered_here(batch: str, slices: int, columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    """A row (slice below 0) with windows of a batch that need not be sent."""
    data = {**columns, "count": np.ones(len(columns["unit"])), "run": np.zeros(len(columns["unit"]))}
    arrays = {name: pa.array([data[name].astype(_TYPES[name]).tobytes() if name in data else None], pa.binary())
              for name in ("gram", "run", "unit", "start", "count", "bytes", "ids")}
    return pa.RecordBatch.from_pydict({"slice": pa.array([-1 - hash_of(batch) % slices], pa.int32()), "batch": pa.array([batch]),
                                       **arrays, "units": pa.array([None], _UNITS)})


def _send_edges(slices: int, length: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        for piece in pieces(batches, 4 * _PIECE):
            texts, units, seen = [], [], set()
            columns: dict[str, list] = {"unit": [], "start": [], "count": [], "many": []}
            for text, doc_id, name, edges, sizes in zip(utf8(piece.column("text")), *(piece.column(c).to_pylist() for c in ("doc_id", "name", "edges", "sizes")), strict=True):
                if (name, doc_id) in seen or len(units) > 65_000:
                    continue
                seen.add((name, doc_id))
                starts, counts = np.frombuffer(edges, np.uint32), np.frombuffer(sizes, np.uint8)
                many, counts = counts >= _HOT, counts % _HOT
                texts += [text[s:s + c + length - 1] for s, c in zip(starts.tolist(), counts.tolist(), strict=True)]
                for key, value in (("unit", np.full(len(starts), len(units))), ("start", starts), ("count", counts), ("many", many)):
                    columns[key].append(value)
                units.append((doc_id, name))
            if texts:
                unit, start, count, many = (np.concatenate(columns[c]) for c in ("unit", "start", "count", "many"))
                grams, sent = np.zeros(0, np.uint64), [t for t, m in zip(texts, many.tolist(), strict=True) if not m]
                if sent:
                    prefix = prefix_hash(np.frombuffer(b"".join(sent), np.uint8))
                    sizes = np.array([len(t) for t in sent])
                    begin = np.cumsum(sizes) - sizes
                    # the gram of a run is the smallest of any of its windows, say the first
                    grams = np.minimum.reduce([span_hash(prefix, begin + i, begin + i + GRAM) for i in range(length - GRAM + 1)])
                out = {"unit": unit[~many], "start": start[~many].astype(np.int64), "count": count[~many]}
                if many.any():
                    doc = np.array([d for d, _ in units], np.int64)[unit[many]]
                    hashes, run, offset, windows, covered = _hot_windows([t for t, m in zip(texts, many.tolist(), strict=True) if m], doc, length)
                    single = {"unit": unit[many][run], "start": start[many][run].astype(np.int64) + offset, "count": np.ones(len(run), np.uint8)}
                    grams, sent = np.concatenate([grams, hashes[~covered]]), sent + windows
                    out = {k: np.concatenate([v, single[k][~covered]]) for k, v in out.items()}
                    if covered.any():
                        yield _covered_here(f"{part}-{number}", slices, {k: single[k][covered] for k in ("unit", "start")})
                yield _pack(f"{part}-{number}", slices, grams, out, units, sent)
                number += 1

    return send


def repeated_windows(docs: DataFrame, length: int, slices: int) -> DataFrame:
    """``name, doc_id, starts, ends``: per unit (distinct text, smallest id that a task saw) its covered windows."""
    first = (docs.mapInArrow(_send(slices, length), _PACKED).groupBy("slice").applyInArrow(_whole_runs, _PACKED)
             .groupBy("batch").applyInArrow(_by_unit, _SPANS))
    first = materialise(first, "suffix-runs")
    edges = first.where("octet_length(edges) > 0").select("name", F.col("doc_id").alias("_doc"), "edges", "sizes")
    edges = materialise(edges, "suffix-edges")
    named = docs.select(F.md5("text").alias("name"), "text", "doc_id")
    texts = join_checked(named, edges, "name", "inner").where("doc_id = _doc").select("text", "doc_id", "name", "edges", "sizes")
    second = (texts.mapInArrow(_send_edges(slices, length), _PACKED)
              .groupBy("slice").applyInArrow(lambda table: _windows(table, length), _PACKED)
              .groupBy("batch").applyInArrow(_by_unit, _SPANS))
    return first.unionByName(second).where("octet_length(starts) > 0").select("name", "doc_id", "starts", "ends")


def remove_repeats(docs: DataFrame, length: int = LENGTH, slices: int | None = None, as_text: bool = False) -> DataFrame:
    """``docs`` with ``kept`` (binary, the bytes that stay; ``as_text``: the whole characters among them) and ``removed`` (array of ``start, length``, maximal, in order).

    A byte of the UTF-8 text is removed if a string of ``length`` bytes over it also starts
    in a document with a smaller ``doc_id``; strings are those of the input and never cross
    documents. Null texts count as empty, texts under ``length`` bytes stay whole. Of rows
    that repeat an id none removes from the other. A null id counts as larger than any.
    Other columns stay; columns with the two names are replaced.
    """
    slices = slices or 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NONE)).alias("doc_id"), "text").where(F.octet_length("text") >= length)
    windows = repeated_windows(rows, length, slices)
    # covered windows of a unit from both steps, in as many rows as there were batches
    parts = windows.groupBy("name", "doc_id").agg(F.collect_list(F.struct("starts", "ends")).alias("parts"))
    copies = rows.groupBy(F.md5("text").alias("name")).agg(F.min("doc_id").alias("least"), F.count("*").alias("n"))
    info = (copies.join(parts, "name", "left").where("n > 1 or doc_id = least").where("doc_id is null or doc_id = least")
            .select("name", "least", "parts"))
    few = materialise(copies.where("n > 1").select("name", "least", F.lit(None).cast("array<struct<starts:binary,ends:binary>>").alias("parts"))
                      .unionByName(info.where("parts is not null")).groupBy("name").agg(
                          F.min("least").alias("_least"), F.first("parts", ignorenulls=True).alias("_parts")), "suffix-info")
    kept = docs.drop("kept", "removed")
    keyed = kept.withColumn("name_", F.md5(F.coalesce("text", F.lit(""))))
    joined = join_checked(keyed, few.withColumnRenamed("name", "name_"), "name_", "left").select(
        *[F.col(f"`{c}`") for c in kept.columns], "_parts", (F.coalesce(F.col("doc_id").cast("long"), F.lit(_NONE)) > F.col("_least")).alias("_copy"))
    return _cut(joined, kept, length, as_text)


def _cut(joined: DataFrame, kept: DataFrame, length: int, as_text: bool) -> DataFrame:
    removed, names = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())])), kept.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, 2 * _PIECE):
            stay, gone = [], []
            for text, parts, copy in zip(utf8(piece.column("text")), piece.column("_parts").to_pylist(), piece.column("_copy").to_pylist(), strict=True):
                if len(text) < length or not (copy or parts):
                    stay.append(text)
                    gone.append([])
                    continue
                if copy:
                    starts, ends = [0], [len(text)]
                else:
                    bounds = [np.concatenate([np.frombuffer(p[c], np.uint32) for p in parts]).astype(np.int64) for c in ("starts", "ends")]
                    starts, ends = (x.tolist() for x in _merge(bounds[0], bounds[1] + length - 1))
                stay.append(b"".join(text[a:b] for a, b in zip([0, *ends], [*starts, len(text)], strict=True)))
                gone.append([{"start": a, "length": b - a} for a, b in zip(starts, ends, strict=True)])
            columns = [c for name, c in zip(piece.schema.names, piece.columns, strict=True) if name not in ("_parts", "_copy")]
            left = pa.array([x.decode("utf-8", "ignore") for x in stay], pa.string()) if as_text else pa.array(stay, pa.binary())
            yield pa.RecordBatch.from_arrays([*columns, left, pa.array(gone, removed)],
                                             names=[*names, "kept", "removed"])

    schema = kept.withColumns({"kept": F.lit("" if as_text else b""), "removed": F.expr("cast(array() as array<struct<start:bigint,length:bigint>>)")}).schema
    return joined.mapInArrow(work, schema)
