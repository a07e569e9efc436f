"""Benchmark passages in documents, exact or edited.

Word edit distance between an item and item-sized windows of a text is found by
CGK embedding: a random walk copies words of a window to an output, going on to
the next word or staying, as a random bit of the step and the word says. Two
windows at a small edit distance get outputs at a small Hamming distance, so a few
sampled places of the output agree with good probability. Repeated walks bring the
recall to the target; every pair found is verified by its exact edit distance.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import byte_texts, ids_and_texts, lean, name_of, unnamed
from feedloom.session import materialize

#: A passage counts if at most this share of the item's words is edited.
EDITS = 0.2
RECALL = 0.995
#: Sampled places of a walk. At EDITS, all of them agree with a probability of
#: AGREEMENT or more (measured in tests), which gives the number of walks for RECALL.
SAMPLED = 1
AGREEMENT = 0.1
#: Items are handled in groups of about this many bytes, one pass over the
#: documents for each group; what a pass sends to the tasks follows this bound.
GROUP_BYTES = 4 << 20
_MARKS = b".,;:!?\"'()[]{}<>*#$%&|~`^_-+=/\\"
_TEXT_BYTES = 4 << 20


def words_of(text: bytes) -> list[bytes]:
    """Lower-case words without marks at their ends."""
    return [w for w in map(bytes.strip, text.lower().split(), repeat(_MARKS)) if w]


def walks(recall: float = RECALL, agreement: float = AGREEMENT) -> int:
    return math.ceil(math.log(1 - recall) / math.log(1 - agreement))


class Embedding:
    """CGK walks over windows of one length; the same for items and texts."""

    def __init__(self, length: int, repeats: int, sampled: int = SAMPLED, seed: int = 7) -> None:
        rng = np.random.default_rng([seed, length])
        self.length, self.repeats = length, repeats
        self.steps = 2 * length
        self.places = np.sort(rng.integers(0, self.steps, (repeats, sampled)), axis=1)
        self.factors = rng.integers(1, 2**63, (repeats, self.steps), dtype=np.uint64) | np.uint64(1)
        self.offsets = rng.integers(0, 2**63, (repeats, self.steps), dtype=np.uint64)

    def keys(self, windows: np.ndarray, walk: int) -> np.ndarray:
        """One 64-bit key per window (rows of word numbers; 0 is any other word)."""
        padded = np.zeros((len(windows), self.length + 1), np.uint64)
        padded[:, :windows.shape[1]] = windows
        rows, at = np.arange(len(windows)), np.zeros(len(windows), np.int64)
        out = np.zeros(len(windows), np.uint64)
        wanted = self.places[walk].tolist()
        for step in range(wanted[-1] + 1):
            word = padded[rows, at]
            for _ in range(wanted.count(step)):
                out = out * np.uint64(0x9E3779B97F4A7C15) + word + np.uint64(1)
            bit = (word * self.factors[walk, step] + self.offsets[walk, step]) >> np.uint64(63)
            at = np.minimum(at + bit.astype(np.int64), self.length)
        return out


def best_match(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """(distance, start, end) of the part of ``text`` at the least edit distance to
    ``item``: the first such end, and its latest start."""
    width = len(text) + 1
    column = np.arange(width)
    cost, start = np.zeros(width, np.int64), column.copy()
    for word in item.tolist():
        # Substitute or match, or leave out the item's word; starts go along.
        diagonal = np.append(cost[0] + 1, cost[:-1] + (text != word) if width > 1 else [])
        diagonal_start = np.append(start[0], start[:-1])
        up = cost + 1
        take = up < diagonal
        now = np.where(take, up, diagonal)
        now[0] = cost[0] + 1
        now_start = np.where(take, start, diagonal_start)
        # Extra words of the text: a running minimum of now - column, plus column.
        shifted = now - column
        least = np.minimum.accumulate(shifted)
        source = np.maximum.accumulate(np.where(shifted == least, column, 0))
        cost, start = least + column, now_start[source]
    end = int(cost.argmin())
    return int(cost[end]), int(start[end]), end


class Items:
    """The index of a group of items that goes to every task of a pass."""

    def __init__(self, rows: list[tuple[int | None, bytes]], edits: float, recall: float) -> None:
        self.ids, self.words, self.vocabulary = [], [], {}
        for item_id, text in rows:
            words = words_of(text)
            if words:
                self.ids.append(item_id)
                self.words.append(np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words], np.int64))
        self.allowed = [int(edits * len(w)) for w in self.words]
        self.repeats = walks(recall)
        # Count filter. An edit touches at most q of an item's q-grams, so a passage
        # within the allowed edits keeps ``need`` of its distinct q-grams at least.
        # The largest q that leaves any is used.
        self.grams: dict[int, dict[bytes, list[tuple[int, int]]]] = {}
        self.size, self.need = [], []
        for number, (words, allowed) in enumerate(zip(self.words, self.allowed)):
            for q in (3, 2, 1):
                distinct = {words[o:o + q].tobytes() for o in range(len(words) - q + 1)}
                if len(distinct) - q * allowed > 0 or q == 1:
                    break
            self.size.append(q)
            self.need.append(max(1, len(distinct) - q * allowed))
            for o in range(len(words) - q + 1):
                self.grams.setdefault(q, {}).setdefault(words[o:o + q].tobytes(), []).append((number, o))
        # Per q: the sorted keys of q-grams, and for each its (item, offset) pairs.
        self.tables = {}
        base = len(self.vocabulary) + 1
        for q, grams in self.grams.items():
            keys = np.array([self._key([*np.frombuffer(g, np.int64)], base) for g in grams], np.uint64)
            order = np.argsort(keys, kind="stable")
            pairs = list(grams.values())
            pairs = [pairs[i] for i in order]
            ends = np.cumsum([0] + [len(p) for p in pairs])
            flat = np.array([x for p in pairs for x in p], np.int64).reshape(-1, 2)
            self.tables[q] = keys[order], ends, flat
        self.base = base
        self.embeddings: dict[int, Embedding] = {}
        self.item_keys: dict[int, np.ndarray] = {}

    @staticmethod
    def _key(words: list, base: int):
        key = np.uint64(0)
        with np.errstate(over="ignore"):
            for w in words:
                key = np.uint64(key) * np.uint64(base) + np.uint64(w)
        return key

    def hits(self, ids: np.ndarray, doc: np.ndarray, q: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(position, gram, item, offset) of every q-gram of an item in the texts."""
        keys, ends, flat = self.tables[q]
        n = len(ids) - q + 1
        if n <= 0 or not len(keys):
            return (np.empty(0, np.int64),) * 4
        whole = ids[:n] > 0
        for k in range(1, q):
            whole &= (ids[k:n + k] > 0) & (doc[k:n + k] == doc[:n])
        at = np.flatnonzero(whole)
        with np.errstate(over="ignore"):
            found = np.zeros(len(at), np.uint64)
            for k in range(q):
                found = found * np.uint64(self.base) + ids[at + k].astype(np.uint64)
        place = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
        same = keys[place] == found
        at, place = at[same], place[same]
        counts = ends[place + 1] - ends[place]
        first = np.repeat(ends[place] - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
        return np.repeat(at, counts), np.repeat(place, counts), flat[first, 0], flat[first, 1]

    def candidates(self, ids: np.ndarray, doc: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """(document, item, window starts) that pass the count filter."""
        for q in self.tables:
            at, gram, item, offset = self.hits(ids, doc, q)
            if not len(at):
                continue
            pair = doc[at] * len(self.words) + item
            distinct = np.unique(np.stack([pair, gram]), axis=1)[0]
            pairs, counts = np.unique(distinct, return_counts=True)
            need = np.array(self.need)[pairs % len(self.words)]
            kept = pairs[counts >= need]
            mine = np.isin(pair, kept)
            order = np.argsort(pair[mine], kind="stable")
            pair, starts = pair[mine][order], (at[mine] - offset[mine])[order]
            for p, part in zip(kept.tolist(), np.split(starts, np.searchsorted(pair, kept[1:]))):
                yield p // len(self.words), p % len(self.words), np.unique(part)

    def embedding(self, length: int) -> Embedding:
        if length not in self.embeddings:
            self.embeddings[length] = Embedding(length, self.repeats)
        return self.embeddings[length]

    def keys_of(self, item: int) -> np.ndarray:
        if item not in self.item_keys:
            walk = self.embedding(len(self.words[item]))
            rows = self.words[item][None, :]
            self.item_keys[item] = np.array([walk.keys(rows, r)[0] for r in range(self.repeats)])
        return self.item_keys[item]

    def collides(self, item: int, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Which windows share the key of a walk with the item."""
        length = len(self.words[item])
        walk, wanted = self.embedding(length), self.keys_of(item)
        place = starts[:, None] + np.arange(length)
        inside = (place >= 0) & (place < len(ids))
        windows = np.where(inside, ids[np.clip(place, 0, len(ids) - 1)], 0)
        found = np.zeros(len(starts), bool)
        for r in range(self.repeats):
            left = np.flatnonzero(~found)
            if not len(left):
                break
            found[left] = walk.keys(windows[left], r) == wanted[r]
        return found

    def matches(self, ids: np.ndarray, doc: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(document, item, distance, start, end) of the best passage of each pair."""
        out = []
        bounds = np.searchsorted(doc, np.arange(int(doc[-1]) + 2)) if len(doc) else np.zeros(1, np.int64)
        for d, item, starts in self.candidates(ids, doc):
            first, last = int(bounds[d]), int(bounds[d + 1])
            text, starts = ids[first:last], starts - first
            # A passage may begin up to ``allowed`` words off the place of a hit.
            allowed, length = self.allowed[item], len(self.words[item])
            starts = starts[self.collides(item, text, starts)]
            best = None
            # Windows that overlap are verified together, each word once.
            for group in np.split(starts, np.flatnonzero(np.diff(starts) > 2 * (length + allowed)) + 1) if len(starts) else []:
                low = max(0, int(group[0]) - allowed)
                high = min(len(text), int(group[-1]) + length + 2 * allowed)
                distance, start, end = best_match(self.words[item], text[low:high])
                if distance <= allowed and (best is None or (distance, low + start) < best[:2]):
                    best = distance, low + start, low + end
            if best:
                out.append((d, item, *best))
        return out


_SCHEMA = "doc_id long, item_id long, distance int, item_words int, start long, end long, unnamed string"


def _scan(items: Items):
    def found(doc_ids: list, texts: list[bytes]) -> pa.RecordBatch:
        get = items.vocabulary.get
        parts = [np.fromiter(map(get, words, repeat(0)), np.int64, len(words)) for words in map(words_of, texts)]
        doc = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        rows = items.matches(np.concatenate(parts) if parts else np.empty(0, np.int64), doc)
        ids = [doc_ids[r[0]] for r in rows]
        columns = [ids, [items.ids[r[1]] for r in rows], [r[2] for r in rows],
                   [len(items.words[r[1]]) for r in rows], [r[3] for r in rows], [r[4] for r in rows]]
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays(
            [*(pa.array(c, t) for c, t in zip(columns, types)), unnamed(ids, [texts[r[0]] for r in rows])],
            ["doc_id", "item_id", "distance", "item_words", "start", "end", "unnamed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids, texts, size = [], [], 0
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), byte_texts(batch)):
                doc_ids.append(doc_id)
                texts.append(text)
                size += len(text)
                if size >= _TEXT_BYTES:
                    yield found(doc_ids, texts)
                    doc_ids, texts, size = [], [], 0
            if texts:
                yield found(doc_ids, texts)
    return run


def find_passages(
    docs: DataFrame, items: DataFrame, edits: float = EDITS, recall: float = RECALL, group_bytes: int = GROUP_BYTES,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """(doc_id, item_id, distance, item_words, start, end, unnamed) per document row and
    item of which the document has a passage within ``edits`` times the item's words;
    ``start`` and ``end`` count the document's words, ``distance`` is the exact
    least word edit distance there, ``unnamed`` the SHA-256 of the text of a row
    without an id.

    Words are lower-cased and lose marks at their ends. An exact count filter on
    q-grams leaves the windows that can match at all; CGK walks then find those
    near the item with probability ``recall`` or more, and no pair is reported
    unverified. Documents are scanned where they lie, whole and without a shuffle.
    Items go to the tasks in groups of about ``group_bytes``, one scan per group,
    so what is sent has a bound.

    Null and empty texts and items without words match nothing; null ids are kept
    as they are; repeated rows of documents or items give repeated results; empty
    tables give an empty result; further columns are not looked at.
    """
    spark = docs.sparkSession
    texts = items.select(F.col(item_col).cast("long").alias("item_id"), F.coalesce(F.col(item_text_col), F.lit("")).alias("text"))
    total = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    groups = max(1, -(-total // group_bytes))
    group = F.pmod(F.xxhash64("item_id", "text"), F.lit(groups))
    scans = []
    for number in range(groups):
        rows = [(r.item_id, r.text.encode()) for r in texts.where(group == number).toLocalIterator()]
        index = Items(rows, edits, recall)
        if index.words:
            scans.append(ids_and_texts(docs, id_col, text_col).mapInArrow(lean(_scan(index)), _SCHEMA))
    # An empty list as a frame would start further Python workers, so it is no part of the union.
    return reduce(DataFrame.unionByName, scans) if scans else spark.createDataFrame([], _SCHEMA)


def without_passages(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose document has no passage of any item. Rows with a
    null id are judged by their text; of documents with the same id, one passage
    removes all."""
    found = find_passages(docs, items, id_col=id_col, text_col=text_col).select(
        F.coalesce(F.col("doc_id").cast("string"), "unnamed").alias("_leaky")).distinct()
    return docs.join(materialize(found, "leaky"), name_of(id_col, text_col) == F.col("_leaky"), "left_anti")
