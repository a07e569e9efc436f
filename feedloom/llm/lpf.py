"""Removal of byte passages that an earlier document has, by suffix order.

A suffix array over the whole corpus would have a row per byte. Only places where
two documents can share ``LENGTH`` bytes are looked at: every window of that length
has an anchor, the 16 bytes with the smallest hash in it, chosen by the window's
content alone, so equal windows have equal anchors at equal places. Anchors that
several documents have bring their surroundings together, and there suffixes are
sorted, and previous and next smaller documents in suffix order give the longest
previous factors.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import byte_texts, ids_and_texts, lean, release
from feedloom.session import delete_path, materialize, scratch_path

LENGTH = 50
ANCHOR = 16
_REACH = LENGTH - ANCHOR  # bytes beside an anchor that a window with it can cover
_SPAN = ANCHOR + 2 * _REACH
_PART = "h long, c long, id long, starts binary"
_SEGMENT = 1 << 20
_BLOB = 2 << 20
#: Surroundings of one anchor that are sorted in memory at most. An anchor with more
#: has its windows compared by a shuffled aggregation instead.
GROUP = 50_000
_CHUNK = 4_000
#: An anchor with more rows than this and than a task's share, in some megabytes of text,
#: is counted by an aggregation, which leaves every task as one row.
OFTEN = 64
#: Anchors are counted in so many shares, so that the shuffles of one are on disk at a time.
_SHARES = 4
#: A null id stands after all others.
_LAST = (1 << 63) - 1


def _words8(x: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as a number; the last seven places lack some."""
    padded = np.zeros(len(x) + 7, np.uint64)
    padded[:len(x)] = x
    out = padded[:-1] | padded[1:] << np.uint64(8)
    out = out[:-2] | out[2:] << np.uint64(16)
    return out[:-4] | out[4:] << np.uint64(32)


def _anchor_hashes(x: np.ndarray) -> np.ndarray:
    """A hash of the ANCHOR bytes from each place on (len(x) - ANCHOR + 1 places)."""
    words = _words8(x)
    n = len(x) - ANCHOR + 1
    h = words[:n] * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    h += words[8:8 + n]
    h *= np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x165667B19E3779F9)
    h ^= h >> np.uint64(32)
    return h | np.uint64(1)  # 0 is kept for windows across documents


def _slide(x: np.ndarray, width: int, pick) -> np.ndarray:
    """Minimum or maximum of each run of ``width`` values, by doubling."""
    out, done = x, 1
    while 2 * done <= width:
        out, done = pick(out[:-done], out[done:]), 2 * done
    if done < width:
        out = pick(out[:len(x) - width + 1], out[width - done:][:len(x) - width + 1])
    return out


def anchors(blob: bytes, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the anchors of the texts blob[bounds[i]:bounds[i+1]].

    Works in segments of windows, so its memory does not follow the text."""
    x = np.frombuffer(blob, np.uint8)
    width = _REACH + 1
    total = len(x) - LENGTH + 1  # windows
    places, hashes = [], []
    for first in range(0, max(total, 0), _SEGMENT):
        count = min(_SEGMENT, total - first)
        h = _anchor_hashes(x[first:first + count + LENGTH - 1])
        least = _slide(h, width, np.minimum)
        # Windows that reach into the next text count for nothing.
        for edge in bounds[np.searchsorted(bounds, first + 1):np.searchsorted(bounds, first + count + LENGTH - 1)].tolist():
            least[max(edge - LENGTH + 1 - first, 0):max(min(edge, first + count) - first, 0)] = 0
        around = np.zeros(count + 2 * (width - 1), np.uint64)
        around[width - 1:width - 1 + count] = least
        mine = np.flatnonzero(h == _slide(around, width, np.maximum))
        places.append(mine + first)
        hashes.append(h[mine])
    if not places:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    place, h = np.concatenate(places), np.concatenate(hashes)
    place, index = np.unique(place, return_index=True)
    return place, h[index]


def _cells(column: pa.Array) -> list:
    """The values of a column; lists of numbers as arrays."""
    if not (pa.types.is_list(column.type) and pa.types.is_int64(column.type.value_type)):
        return column.to_pylist()
    numbers, ends = np.asarray(column.values), np.asarray(column.offsets).tolist()
    return [numbers[a:b] if some else None for a, b, some in zip(ends, ends[1:], column.is_valid().to_pylist())]


def _blobs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[dict], bytes, np.ndarray]]:
    """Rows with their texts joined, some megabytes at a time; a longer text is alone."""
    for batch in batches:
        others = [n for n in batch.schema.names if n != "text"]
        rows = [dict(zip(others, cells)) for cells in zip(*(_cells(batch.column(n)) for n in others))]
        some, texts, size = [], [], 0
        for row, text in zip(rows, byte_texts(batch)):
            if texts and size + len(text) > _BLOB:
                yield some, b"".join(texts), np.cumsum([0] + [len(t) for t in texts])
                some, texts, size = [], [], 0
            some.append(row)
            texts.append(text)
            size += len(text)
        if texts:
            yield some, b"".join(texts), np.cumsum([0] + [len(t) for t in texts])


def _per_key(ids: np.ndarray, *keys: np.ndarray) -> tuple[list[np.ndarray], list[pa.Array]]:
    """Distinct (keys, id) as one row per key: the keys, its smallest id, and only
    where there are more its largest id and all of them."""
    order = np.lexsort((ids, *keys[::-1]))
    ids, keys = ids[order], [k[order] for k in keys]
    changed = np.ones(len(ids), bool)
    changed[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    fresh = changed.copy()
    fresh[1:] |= ids[1:] != ids[:-1]
    ids, keys, changed = ids[fresh], [k[fresh] for k in keys], changed[fresh]
    starts = np.flatnonzero(changed)
    ends = np.append(starts[1:], len(ids))
    several = (ends - starts) > 1
    more = [ids[a:b].tobytes() if s else None for a, b, s in zip(starts.tolist(), ends.tolist(), several.tolist())]
    top = pa.array(ids[ends - 1] if len(ids) else ids, mask=~several)
    return [k[starts] for k in keys], [pa.array(ids[starts]), top, pa.array(more, pa.binary())]


def _owners(bounds: np.ndarray, place: np.ndarray) -> np.ndarray:
    return np.searchsorted(bounds, place, side="right") - 1


def _each_id(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, more, …) to one row per document."""
    for batch in batches:
        more = batch.column("more").to_pylist()
        ids = [np.frombuffer(m, np.int64) if m else [i] for i, m in zip(batch.column("id").to_pylist(), more)]
        rows = np.repeat(np.arange(batch.num_rows), [len(i) for i in ids])
        flat = np.concatenate(ids) if len(ids) else np.empty(0, np.int64)
        names = [n for n in batch.schema.names if n not in ("id", "more")]
        yield pa.RecordBatch.from_arrays(
            [pa.array(flat.astype(np.int64))] + [batch.column(n).take(pa.array(rows)) for n in names], ["id", *names])


def _mix(h: np.ndarray, words: np.ndarray) -> np.ndarray:
    h = (h ^ words) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ h >> np.uint64(29)


def _codes(words: np.ndarray, place: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """A hash of the bytes low to high around each anchor, and of where it lies in
    them. Words of eight bytes tile them; words that would stick out move inside."""
    code = _mix(np.full(len(place), 0x243F6A8885A308D3, np.uint64), ((place - low) * 256 + high - place).astype(np.uint64))
    for at in (*range(-_REACH, LENGTH - 8, 8), LENGTH - 8):
        code = _mix(code, words[np.clip(place + at, low, high - 8)])
    return code ^ code >> np.uint64(32)


def _tagged(values: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Numbers of different rows of a blob made different."""
    return _mix(values.view(np.uint64), (rows.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93))


def _asked(rows: list[dict], name: str) -> np.ndarray:
    parts = [np.empty(0, np.int64) if r[name] is None else r[name] for r in rows]
    owners = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    return _tagged(np.concatenate(parts), owners)


class _Places:
    """The anchors of a blob with their surroundings, in arrays."""

    def __init__(self, blob: bytes, bounds: np.ndarray) -> None:
        self.place, h = anchors(blob, bounds)
        self.h, self.row = h.view(np.int64), _owners(bounds, self.place)
        self.bytes, self.bounds = np.frombuffer(blob, np.uint8), bounds

    def only(self, kept: np.ndarray) -> None:
        self.place, self.h, self.row = self.place[kept], self.h[kept], self.row[kept]

    def measure(self) -> None:
        self.low = np.maximum(self.bounds[self.row], self.place - _REACH)
        self.high = np.minimum(self.bounds[self.row + 1], self.place + LENGTH)
        self.code = _codes(_words8(self.bytes), self.place, self.low, self.high).view(np.int64)


def _surroundings(batches: Iterator[pa.RecordBatch], often: int, tasks: int) -> Iterator[pa.RecordBatch]:
    """(h, c, id, top, more, often): which documents have an anchor with the surroundings c,
    and whether the anchor has over ``often`` rows here and over one in ``tasks`` of them."""
    for rows, blob, bounds in _blobs(batches):
        found = _Places(blob, bounds)
        found.measure()
        ids = np.array([r["id"] for r in rows], np.int64)[found.row]
        (h, c), columns = _per_key(ids, found.h, found.code)
        count = np.diff(np.append(np.flatnonzero(np.append(True, h[1:] != h[:-1])), len(h)))
        many = np.repeat(count > max(often, len(h) // tasks), count)
        yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(c), *columns, pa.array(many)], ["h", "c", "id", "top", "more", "often"])


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, c, id, low, high, around) of the surroundings asked for, once per document:
    ``around`` are LENGTH - ANCHOR bytes before an anchor, the anchor and as many
    behind it, of which those from ``low`` to ``high`` are of the text."""
    for rows, blob, bounds in _blobs(batches):
        found = _Places(blob, bounds)
        found.only(np.isin(_tagged(found.h, found.row), _asked(rows, "keys")))
        found.measure()
        named = _tagged(found.code, found.row)
        kept = np.flatnonzero(np.isin(named, _asked(rows, "codes")))
        kept = kept[np.unique(named[kept], return_index=True)[1]]
        place, low, high = found.place[kept], found.low[kept], found.high[kept]
        columns = place[:, None] + np.arange(-_REACH, LENGTH)
        inside = (columns >= low[:, None]) & (columns < high[:, None])
        around = np.where(inside, found.bytes[np.clip(columns, 0, max(len(blob) - 1, 0))], 0).astype(np.uint8)
        offsets = np.arange(len(kept) + 1, dtype=np.int32) * _SPAN
        ids = np.array([r["id"] for r in rows], np.int64)[found.row[kept]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(found.h[kept]), pa.array(found.code[kept]), pa.array(ids),
             pa.array((low - place + _REACH).astype(np.int32)), pa.array((high - place + _REACH).astype(np.int32)),
             pa.Array.from_buffers(pa.binary(), len(kept), [None, pa.py_buffer(offsets), pa.py_buffer(around)])],
            ["h", "c", "id", "low", "high", "around"])


def previous_smaller(values: np.ndarray) -> np.ndarray:
    """For each place the nearest place before it with a smaller value, or -1. All
    places jump at once over what is known to be no smaller."""
    at = np.arange(len(values)) - 1
    open_ = np.arange(len(values))
    while True:
        open_ = open_[(at[open_] >= 0) & (values[np.maximum(at[open_], 0)] >= values[open_])]
        if not len(open_):
            return at
        at[open_] = at[at[open_]]


def _shared_most(sides: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Per row the longest beginning that it shares with another row of its group:
    that with one of its neighbours in suffix order."""
    n, width = sides.shape
    padded = np.zeros((n, -(-width // 8) * 8), np.uint8)
    padded[:, :width] = sides
    words = padded.view(">u8").astype(np.uint64)
    order = np.lexsort((*words.T[::-1], group))
    same = np.ones((max(n - 1, 0), width + 1), bool)
    np.equal(sides[order[1:]], sides[order[:-1]], out=same[:, :width])
    same[:, width] = False
    common = np.where(group[order[1:]] == group[order[:-1]], same.argmin(axis=1), -1)
    most = np.full(n, -1)
    most[order[1:]] = common
    most[order[:-1]] = np.maximum(most[order[:-1]], common)
    return most


def earlier_windows(around: np.ndarray, low: np.ndarray, high: np.ndarray, ids: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, start): the windows of surroundings that a row with a smaller id has too,
    ``start`` counted from the anchor.

    Suffixes behind the anchor and reversed prefixes before it are sorted within an
    anchor; what a row shares with its neighbours bounds how far any common window
    can reach to either side. The windows within these bounds are put in order of
    their LENGTH bytes, and in that order the previous and the next one of a smaller
    id are the only ones that can share the longest prefix with an earlier text.
    """
    right = _shared_most(around[:, _REACH + ANCHOR:], group)
    left = _shared_most(around[:, _REACH - 1::-1] if _REACH else around[:, :0], group)
    # A window takes ``used`` bytes before the anchor and _REACH - used behind it.
    least = np.maximum(_REACH - right, _REACH + LENGTH - high)
    most = np.minimum(left, _REACH - low)
    count = np.where((right < 0) | (left < 0), 0, np.maximum(most - least + 1, 0))
    row = np.repeat(np.arange(len(around)), count)
    used = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + least[row]
    flat = np.ascontiguousarray(around).reshape(-1)
    words, at = _words8(flat), row * _SPAN + _REACH - used
    places = (*range(0, LENGTH - 8, 8), LENGTH - 8)
    key = np.zeros(len(at), np.uint64)
    for k in places:
        key = _mix(key, words[at + k])

    def differs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.logical_or.reduce([words[a + k] != words[b + k] for k in places]) if len(a) else np.zeros(0, bool)

    order = np.argsort(key, kind="stable")
    tied = np.flatnonzero(key[order[1:]] == key[order[:-1]])
    if differs(at[order[tied]], at[order[tied + 1]]).any():  # different bytes with one key: the full order
        order = np.lexsort(tuple(words[at + k] for k in places))
    doc, ordered = ids[row][order], at[order]
    before = previous_smaller(doc)
    behind = len(doc) - 1 - previous_smaller(doc[::-1])[::-1]  # len(doc): none
    some = np.flatnonzero(before >= 0)
    earlier = np.zeros(len(at), bool)
    earlier[some] = ~differs(ordered[some], ordered[before[some]])
    some = np.flatnonzero((behind < len(doc)) & ~earlier)
    earlier[some] = ~differs(ordered[some], ordered[behind[some]])
    flags = np.zeros(len(at), bool)
    flags[order] = earlier
    return row[flags], -used[flags]


def _sorted_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by anchor; whole anchors are taken together up to some number."""
    def judged(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        h, c, ids, low, high, around = (np.concatenate([p[i] for p in parts]) for i in range(6))
        row, start = earlier_windows(around, low, high, ids, np.cumsum(np.append(0, h[1:] != h[:-1])))
        first = np.flatnonzero(np.append(True, row[1:] != row[:-1])[:len(row)])
        kept, cells = row[first], np.split(start.astype(np.int8), first[1:])
        return pa.RecordBatch.from_arrays(
            [pa.array(h[kept]), pa.array(c[kept]), pa.array(ids[kept]),
             pa.array([s.tobytes() for s in cells] if len(kept) else [], pa.binary())], ["h", "c", "id", "starts"])

    parts, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(n).to_numpy() for n in ("h", "c", "id", "low", "high")]
        around = np.frombuffer(b"".join(batch.column("around").to_pylist()), np.uint8).reshape(-1, _SPAN)
        # Cut behind the last whole anchor of the batch once there is enough.
        h = columns[0]
        edges = np.flatnonzero(h[1:] != h[:-1]) + 1
        if parts and parts[-1][0][-1] != h[0]:
            edges = np.append(0, edges)
        if size + len(h) >= _CHUNK and len(edges):
            cut = int(edges[-1])
            yield judged([*parts, (*(x[:cut] for x in columns), around[:cut])])
            parts, size = [], 0
            columns, around = [x[cut:] for x in columns], around[cut:]
        parts.append((*columns, around))
        size += len(around)
    if parts:
        yield judged(parts)


def _crowded(contents: DataFrame) -> DataFrame:
    """The same for anchors with very many surroundings: every window is a row, and
    the smallest id of equal windows is found by an aggregation."""
    starts = F.sequence(F.col("low"), F.col("high") - LENGTH)
    windows = contents.select("h", "c", "id", "around", F.explode(starts).alias("s")).select(
        "h", "c", "id", "s", F.sha2(F.substring("around", F.col("s") + 1, F.lit(LENGTH)), 256).alias("w"))
    least = windows.groupBy("w").agg(F.min("id").alias("least"))
    return windows.join(least, "w").where("least < id").groupBy("h", "c", "id").agg(
        F.collect_set(F.col("s") - _REACH).alias("list")).mapInArrow(_packed_lists, _PART)


def _packed_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = [np.array(x, np.int8).tobytes() for x in batch.column("list").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("h"), batch.column("c"), batch.column("id"), pa.array(lists, pa.binary())], ["h", "c", "id", "starts"])


def _shared(rows: DataFrame) -> DataFrame:
    """Rows of anchors that several documents have, with ``least`` and ``mixed``. Rows are
    dealt by anchor once: most anchors have one row, so that counting first would
    shuffle nearly all of them a second time."""
    whole = Window.partitionBy("h")
    found = rows.withColumns({"least": F.min("id").over(whole), "most": F.max(F.coalesce("top", "id")).over(whole),
                              "mixed": F.min("c").over(whole) < F.max("c").over(whole)})
    return found.where("least < most").select("h", "c", "id", "top", "more", "least", "mixed")


def _keys_by_document(pairs: DataFrame, *columns: str) -> DataFrame:
    """(id, keys, …): what a document is asked for; bounded by the document's size."""
    names = {"h": "keys", "c": "codes"}
    return pairs.groupBy("id").agg(*(F.collect_list(c).alias(names[c]) for c in columns))


_RESULT = "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary, changed string"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _removed(batches: Iterator[pa.RecordBatch], characters: bool = False) -> Iterator[pa.RecordBatch]:
    """Rows with their decisions to spans and kept bytes."""
    for rows, blob, bounds in _blobs(batches):
        raw = np.frombuffer(blob, np.uint8)
        gone = np.zeros(len(blob), bool)
        decided = np.array([any(r[n] is not None and len(r[n]) for n in ("whole", "part")) for r in rows])
        if decided.any():
            found = _Places(blob, bounds)
            found.only(decided[found.row])
            found.measure()
            named = _tagged(found.code, found.row)
            whole = np.isin(named, _asked(rows, "whole"))
            begins, ends = [found.low[whole]], [found.high[whole]]
            # Windows of surroundings of which only some are repeated.
            asked, starts = _asked(rows, "part"), [np.frombuffer(s, np.int8) for r in rows for s in r["starts"] or []]
            if len(asked):
                order = np.argsort(asked)
                at = np.minimum(np.searchsorted(asked[order], named), len(asked) - 1)
                hit = np.flatnonzero(asked[order][at] == named)
                lists = [starts[k] for k in order[at[hit]].tolist()]
                first = np.repeat(found.place[hit], [len(s) for s in lists]) + (np.concatenate(lists) if lists else np.empty(0, np.int8))
                begins.append(first)
                ends.append(first + LENGTH)
            marks = np.bincount(np.concatenate(begins), minlength=len(blob) + 1) - np.bincount(np.concatenate(ends), minlength=len(blob) + 1)
            gone = np.cumsum(marks[:-1]) > 0
        spans, kept, changed = [], [], []
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            mine = gone[a:b]
            if not mine.any():
                spans.append([])
                kept.append(blob[a:b])
                changed.append(None)
                continue
            changed.append(hashlib.sha256(blob[a:b]).hexdigest())
            edges = np.flatnonzero(np.diff(np.concatenate([[False], mine, [False]]).astype(np.int8))).reshape(-1, 2)
            spans.append([{"start": s, "end": e} for s, e in edges.tolist()])
            left = raw[a:b][~mine].tobytes()
            kept.append(left.decode("utf-8", "ignore").encode() if characters else left)
        ids = [None if r["id"] == _LAST else r["id"] for r in rows]
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(np.diff(bounds), pa.int64()), pa.array(spans, _SPANS), pa.array(kept, pa.binary()),
             pa.array(changed, pa.string())],
            ["doc_id", "n_bytes", "spans", "kept", "changed"])


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", group: int = GROUP, written: str | None = None,
    characters: bool = False, often: int = OFTEN,
) -> DataFrame:
    """(doc_id, n_bytes, spans, kept, changed) for every row of ``docs``; ``changed`` is
    the SHA-256 of a text that has spans.

    ``spans`` are the maximal runs of bytes that lie in a string of ``LENGTH`` bytes
    which also begins in a document with a smaller id; ``kept`` are the other bytes.
    All strings are those of the input, and none crosses documents. With ``characters``
    the rest of a character that was cut through is not kept either.

    Whole copies of an earlier text go without any search. Of the rest, the texts
    are written once, bucketed by id, so that asking documents for surroundings
    shuffles only what is asked for. An anchor's surroundings that an earlier document has
    in full are covered at once; only the first of each kind, where an anchor has
    several, are compared byte by byte in suffix order. Ids are combined before every
    shuffle to one row per anchor and some megabytes of text, so an anchor that a
    third of all documents have stays small. One that has over ``often`` rows in these megabytes,
    and over a task's share of them, is counted by an aggregation and met by a join, the others are
    dealt by anchor once. An anchor with more than ``group`` kinds of
    surroundings is compared by a shuffled aggregation, with the same result.

    Null and empty texts give no spans and nothing kept; a text shorter than
    ``LENGTH`` keeps everything; null ids come after all others and are no earlier
    document for each other; rows of one id are no earlier documents for each other
    and repeated rows give repeated results; an empty table gives an empty result;
    further columns are not looked at. The texts are written to ``written``, which the
    caller may delete when the result is no longer read.
    """
    spark = docs.sparkSession
    rows = ids_and_texts(docs, id_col, text_col).select(
        F.coalesce("doc_id", F.lit(_LAST)).alias("id"), "text", F.sha2(F.col("text").cast("binary"), 256).alias("sha"))
    # Short texts travel with their keys: nothing is ever removed from them.
    narrow = materialize(rows.select(
        "id", "sha", F.octet_length("text").alias("n"), F.when(F.octet_length("text") < LENGTH, F.col("text")).alias("short")), "copies")
    # One row per text that several rows have, written: a join with it can be split.
    firsts = materialize(narrow.where(F.col("short").isNull()).groupBy("sha").agg(F.min("id").alias("least"), F.count("*").alias("rows")).where(
        "rows > 1").select("sha", "least"), "firsts")
    long = narrow.where(F.col("short").isNull()).select("id", "sha", "n").join(firsts, "sha", "left").withColumn(
        "first", F.coalesce("least", "id")).drop("least")
    short = narrow.where(F.col("short").isNotNull()).select(
        F.when(F.col("id") != _LAST, F.col("id")).alias("doc_id"), F.col("n").cast("long").alias("n_bytes"),
        F.expr("cast(array() as array<struct<start: bigint, end: bigint>>)").alias("spans"), F.col("short").cast("binary").alias("kept"),
        F.lit(None).cast("string").alias("changed"))
    copies = long.where("first < id").select(
        F.when(F.col("id") != _LAST, F.col("id")).alias("doc_id"), F.col("n").cast("long").alias("n_bytes"),
        F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n").cast("long").alias("end"))).alias("spans"),
        F.lit("").cast("binary").alias("kept"), F.col("sha").alias("changed"))

    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The join is on the id alone, so that both sides are dealt as the table is.
    keep = long.where("first = id").groupBy(F.col("id").alias("k_id")).agg(F.collect_set("sha").alias("k_shas")).repartition(buckets, "k_id")
    name = f"first_texts_{uuid.uuid4().hex}"
    rows.repartition(buckets, "id").join(keep, (F.col("id") == F.col("k_id")) & F.array_contains("k_shas", F.col("sha")), "left_semi").select(
        "id", "text").write.option("compression", "zstd").bucketBy(buckets, "id").option("path", written or scratch_path(spark, "texts")).saveAsTable(name)
    texts = spark.table(name)

    spark.sql(f"DROP TABLE {name}")  # the entry alone: the files are not the catalog's

    # Anchors are looked for once. A hot one leaves a task as one row, and the joins
    # meet written tables, so that Spark can split what one key has too much of.
    release(spark)
    shape = "h long, c long, id long, top long, more binary, often boolean"
    number = F.pmod(F.shiftright("h", 1), F.lit(_SHARES))
    find = partial(_surroundings, often=often, tasks=buckets)
    texts.mapInArrow(lean(find), shape).withColumn("share", number).write.partitionBy("share").parquet(at := scratch_path(spark, "keyed"))
    keyed = spark.read.schema(f"{shape}, share int").parquet(at)
    last, paths, over = F.max(F.coalesce("top", "id")), [], []

    def used(df: DataFrame, name: str) -> DataFrame:
        """``df`` written, until the decisions are."""
        over.append(scratch_path(spark, name))
        df.write.parquet(over[-1])
        return spark.read.schema(df.schema).parquet(over[-1])

    hot = used(keyed.where("often").select("h").distinct(), "hot_anchors")
    some_hot = not hot.isEmpty()
    for share in range(_SHARES):
        mine = keyed.where(F.col("share") == share)
        found = _shared(mine.join(hot, "h", "left_anti") if some_hot else mine)
        if some_hot:
            many = mine.join(hot, "h", "left_semi")
            shared = used(many.groupBy("h").agg(F.min("id").alias("least"), last.alias("most"), (F.min("c") < F.max("c")).alias("mixed")).where(
                "least < most").select("h", "least", "mixed"), "anchors")
            release(spark)
            found = found.unionByName(many.join(shared, "h").select(*found.columns))
        paths.append(scratch_path(spark, "kinds"))
        found.write.parquet(paths[-1])
        delete_path(spark, f"{at}/share={share}")
        release(spark)
    around = spark.read.schema("h long, c long, id long, top long, more binary, least long, mixed boolean").parquet(*paths)
    delete_path(spark, at)

    # Where an anchor has one kind of surroundings, its first document is theirs.
    mixed = around.where("mixed")
    kinds = used(mixed.groupBy("h", "c").agg(F.min("id").alias("first"), last.alias("last")), "mixed")
    again = mixed.select("h", "c", "id", "more").join(kinds.where("first < last").select("h", "c", "first"), ["h", "c"])
    whole = around.where("NOT mixed").select("c", "id", "more", F.col("least").alias("first")).unionByName(
        again.select("c", "id", "more", "first")).mapInArrow(lean(_each_id), "id long, c long, first long").where("first < id").select("id", "c")
    several = kinds.select(F.col("first").alias("id"), "h", "c")
    # At most one anchor per ``group`` kinds.
    crowds = used(kinds.groupBy("h").count().where(F.col("count") > group).select("h"), "crowds")
    release(spark)

    def contents(pairs: DataFrame) -> DataFrame:
        return texts.join(_keys_by_document(pairs, "h", "c"), "id").mapInArrow(
            lean(_contents), "h long, c long, id long, low int, high int, around binary")

    few = contents(several.join(crowds, "h", "left_anti")).repartition("h").sortWithinPartitions("h").mapInArrow(lean(_sorted_groups), _PART)
    part = used(few.unionByName(_crowded(contents(several.join(crowds, "h", "left_semi")))), "part")
    release(spark)
    decisions = whole.withColumn("starts", F.lit(None).cast("binary")).unionByName(part.select("id", "c", "starts"))
    full = F.col("starts").isNull()
    decided = decisions.groupBy("id").agg(
        F.collect_list(F.when(full, F.col("c"))).alias("whole"), F.collect_list(F.when(~full, F.struct("c", "starts"))).alias("part")).select(
        "id", "whole", F.col("part.c").alias("part"), F.col("part.starts").alias("starts"))
    decided = materialize(decided, "decided")
    for path in (*paths, *over):
        delete_path(spark, path)
    release(spark)
    result = texts.join(decided, "id", "left").mapInArrow(lean(partial(_removed, characters=characters)), _RESULT)
    return result.unionByName(copies).unionByName(short)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for every row of ``docs``."""
    found = remove_repeats(docs, id_col, text_col)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """``docs`` with repeated passages taken out of its texts and ``length_col`` set to
    the new number of characters. Bytes of a character that was cut through go too;
    a document of which nothing is left goes. Of rows with the same id each gets the
    remainder of its own text. Rows with a null id are documents named by a hash of
    their text, which comes after all ids below 2 to the 62nd."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    number = F.shiftrightunsigned(F.xxhash64(text), 2) + F.lit(1 << 62)
    key = F.coalesce(F.col(id_col).cast("long"), number)
    spark = docs.sparkSession
    found = remove_repeats(docs.select(key.alias("doc_id"), text.alias("text")), written=(written := scratch_path(spark, "texts")), characters=True)
    changed = found.where(F.size("spans") > 0).select(
        F.col("doc_id").alias("_id"), F.col("changed").alias("_sha"), F.col("kept").cast("string").alias("_text"))
    changed = materialize(changed.groupBy("_id", "_sha").agg(F.max("_text").alias("_text")), "changed")
    delete_path(spark, written)
    release(spark)
    sha = F.sha2(F.col(text_col).cast("string").cast("binary"), 256)
    out = docs.join(changed, (key == F.col("_id")) & (sha == F.col("_sha")), "left").where(F.col("_text").isNull() | (F.col("_text") != ""))
    now = F.coalesce("_text", F.col(text_col))
    columns = []
    for c in docs.columns:
        if c == text_col:
            columns.append(now.alias(c))
        elif c == length_col:
            columns.append(F.when(F.col("_text").isNull(), F.col(c)).otherwise(F.length("_text")).cast(docs.schema[c].dataType).alias(c))
        else:
            columns.append(F.col(c))
    return out.select(*columns)
