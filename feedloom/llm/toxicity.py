"""Toxic spans and document scores by a linear-chain conditional random field.

Two states per token, plain and toxic. Emissions come from the token and its
neighbours, transitions are learnt, and the marginals of forward-backward give
each token's probability, the spans, and the document's score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import byte_texts, held_out, ids_and_texts, lean, name_of, unnamed
from feedloom.session import materialize

#: Labelled documents of each label that the model is fitted on at most: those with
#: the smallest hash of their id, without texts above TRAINING_BYTES.
TRAINING_ROWS = 1_500
TRAINING_BYTES = 1 << 14
#: Words and beginnings of words that the model knows at most: those that tell the
#: labels apart best.
LEXICON = 2_000
#: Lengths of beginnings, in bytes.
PREFIXES = (4, 5, 6)
PREDICTED_FROM = 0.7
TAGGED_FROM = 0.5
_MARKS = b".,;:!?\"'()[]{}<>*#$%&|~`^_-+=/\\"
_TEXT_BYTES = 4 << 20
_TOKEN = re.compile(rb"[^\x20\x09-\x0d]+")


def tokens_of(text: bytes) -> list[bytes]:
    """Lower-case (A-Z) tokens between white space."""
    return text.lower().split()


def units_of(token: bytes) -> list[bytes]:
    """What the model may know of a token: the word without marks at its ends, and
    its beginnings, which are shared by words that were never seen."""
    word = token.strip(_MARKS)
    return [word, *(word[:k] + b"*" for k in PREFIXES if len(word) > k)] if word else []


class _Numbers(dict):
    """Token to the number of the first known unit of it, or 0; emptied when full."""

    def __init__(self, units: list[bytes], limit: int = 300_000) -> None:
        super().__init__()
        self.known, self.limit = {u: i + 1 for i, u in enumerate(units)}, limit

    def __missing__(self, token: bytes) -> int:
        number = min((self.known[u] for u in units_of(token) if u in self.known), default=0)
        if len(self) >= self.limit:
            self.clear()
        self[token] = number
        return number

    def __reduce__(self):
        return _Numbers, (list(self.known), self.limit)


class Chain:
    """Marginals of a two-state chain for many sequences that stand in one array.

    ``odds`` is each token's emission of toxic over plain. The message of a place is
    a vector of two numbers, and going one place on is a 2x2 matrix; a first token's
    matrix forgets what was before. Lanes of ``lane`` tokens are multiplied side by
    side, joined in order, and walked again from their true starts, so the result
    is that of the plain recursion.
    """

    def __init__(self, start: float, change: np.ndarray, lane: int = 512) -> None:
        self.start, self.change, self.lane = start, change, lane

    def _walk(self, odds: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Forward messages as odds: f(t) = odds(t) * P(to toxic) / P(to plain)."""
        (a, b), (c, d) = self.change  # plain to plain, plain to toxic; toxic to plain, toxic to toxic
        n, lane = len(odds), self.lane
        rows = -(-n // lane)
        e = np.ones(rows * lane)
        e[:n] = odds
        s = np.zeros(rows * lane, bool)
        s[:n] = first
        e, s = e.reshape(rows, lane), s.reshape(rows, lane)
        # Product of a lane's matrices, columns scaled together.
        p = [np.ones(rows), np.zeros(rows), np.zeros(rows), np.ones(rows)]
        for t in range(lane):
            et, st = e[:, t], s[:, t]
            top = [np.where(st, p[i] + p[2 + i], a * p[i] + c * p[2 + i]) for i in (0, 1)]
            low = [et * np.where(st, self.start * (p[i] + p[2 + i]), b * p[i] + d * p[2 + i]) for i in (0, 1)]
            size = np.maximum(np.maximum(top[0], top[1]), np.maximum(low[0], low[1]))
            p = [top[0] / size, top[1] / size, low[0] / size, low[1] / size]
        ratio, starts = 1.0, np.empty(rows)
        for r, (p0, p1, p2, p3) in enumerate(zip(*(x.tolist() for x in p))):
            starts[r] = ratio
            ratio = (p2 + p3 * ratio) / (p0 + p1 * ratio)
        f, out = starts, np.empty((rows, lane))
        for t in range(lane):
            f = e[:, t] * np.where(s[:, t], self.start, (b + d * f) / (a + c * f))
            out[:, t] = f
        return out.reshape(-1)[:n]

    def messages(self, odds: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Forward odds, and backward odds (toxic over plain of what follows)."""
        forward = self._walk(odds, first)
        # Backward, u(t) = odds(t) * back(t) obeys the same recursion from the end with
        # the change matrix turned round and a start of one.
        turned = Chain(1.0, self.change.T, self.lane)
        last = np.append(first[1:], True)
        after = turned._walk(odds[::-1], last[::-1])[::-1]
        return forward, after / odds

    def marginals(self, odds: np.ndarray, first: np.ndarray) -> np.ndarray:
        forward, back = self.messages(odds, first)
        both = forward * back
        return both / (1 + both)


class Tagger:
    """Units known to the model, the first ones first, their weights, and the chain."""

    def __init__(self, units: list[bytes]) -> None:
        self.number = _Numbers(units)
        self.own, self.before, self.behind = (np.zeros(len(units) + 1) for _ in range(3))
        self.bias, self.start = -6.0, 0.0
        self.change = np.array([[0.99, 0.01], [0.9, 0.1]])
        self.scale = np.array([-5.0, 1.0, 1.0])  # of the document's score

    def numbers(self, tokens: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.number.__getitem__, tokens), np.int64, len(tokens))

    def _neighbours(self, x: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        before = np.append(0, x[:-1])
        before[first] = 0
        behind = np.append(x[1:], 0)
        behind[np.flatnonzero(first[1:])] = 0
        return before, behind

    def _chain(self) -> Chain:
        return Chain(np.exp(self.start), self.change)

    def odds(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        before, behind = self._neighbours(x, first)
        return np.exp(np.clip(self.bias + self.own[x] + self.before[before] + self.behind[behind], -30, 30))

    def marginals(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        return self._chain().marginals(self.odds(x, first), first) if len(x) else np.empty(0)

    def fit(self, x: np.ndarray, first: np.ndarray, y: np.ndarray, rounds: int = 80, rate: float = 0.2, l2: float = 1e-3) -> None:
        """Maximum likelihood of the tags y, by Adam on expected minus seen counts."""
        if not len(x):
            return
        size, n = len(self.own), float(max(y.sum(), 1.0))
        before, behind = self._neighbours(x, first)
        inner = ~first
        log_change = np.log(self.change)
        params = np.concatenate([self.own, self.before, self.behind, [self.bias, self.start], log_change.ravel()])
        m, v = np.zeros_like(params), np.zeros_like(params)
        y_last = np.append(0.0, y[:-1])
        seen = np.array([((1 - y_last) * (1 - y))[inner].sum(), ((1 - y_last) * y)[inner].sum(),
                         (y_last * (1 - y))[inner].sum(), (y_last * y)[inner].sum()])
        for step in range(1, rounds + 1):
            self.own, self.before, self.behind = np.split(params[:3 * size], 3)
            self.bias, self.start = float(params[3 * size]), float(params[3 * size + 1])
            self.change = np.exp(params[3 * size + 2:].reshape(2, 2))
            odds = self.odds(x, first)
            forward, back = self._chain().messages(odds, first)
            p = forward * back / (1 + forward * back)
            # Pair marginals: previous forward message, change, emission, backward message.
            f = np.append(1.0, forward[:-1])
            e = odds * back
            pair = np.stack([np.full(len(x), self.change[0, 0]), self.change[0, 1] * e, f * self.change[1, 0], f * self.change[1, 1] * e])
            pair = (pair / pair.sum(0))[:, inner].sum(1)
            off = p - y
            grad = np.concatenate([np.bincount(x, off, size), np.bincount(before, off, size), np.bincount(behind, off, size),
                                   [off.sum(), off[first].sum()], pair - seen]) / n
            grad[0] = grad[size] = grad[2 * size] = 0.0  # other words: the bias has them
            grad += l2 * params
            m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
            params = params - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        self.own, self.before, self.behind = np.split(params[:3 * size], 3)
        self.bias, self.start = float(params[3 * size]), float(params[3 * size + 1])
        self.change = np.exp(params[3 * size + 2:].reshape(2, 2))

    @staticmethod
    def evidence(p: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Per document: log odds of its likeliest token, and the expected number of
        its tagged tokens (log1p); -12 and 0 without tokens."""
        out = np.zeros((len(bounds) - 1, 2))
        out[:, 0] = -12.0
        full = np.flatnonzero(np.diff(bounds))
        if len(full):
            starts = bounds[:-1][full]
            top = np.clip(np.maximum.reduceat(p, starts), 1e-6, 1 - 1e-6)
            out[full, 0] = np.clip(np.log(top / (1 - top)), -12, 12)
            out[full, 1] = np.log1p(np.add.reduceat(np.where(p >= TAGGED_FROM, p, 0.0), starts))
        return out

    def fit_scale(self, evidence: np.ndarray, labels: np.ndarray) -> None:
        """Logistic regression of the label on the evidence, a little shrunk."""
        z = np.column_stack([np.ones(len(labels)), evidence])
        w = np.zeros(3)
        for _ in range(50):
            q = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            hess = (z * (q * (1 - q))[:, None]).T @ z + 0.05 * np.eye(3)
            w -= np.linalg.solve(hess, z.T @ (q - labels) + 0.05 * w)
        self.scale = w

    def scores(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale[0] + evidence @ self.scale[1:], -30, 30)))


def _unit_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = (Counter(), Counter())
    for batch in batches:
        for y, text in zip(batch.column("y").to_pylist(), byte_texts(batch)):
            counts[y].update({u for token in set(tokens_of(text)) for u in units_of(token)})
    units = list(counts[0].keys() | counts[1].keys())
    yield pa.RecordBatch.from_arrays(
        [pa.array(units, pa.binary()), pa.array([counts[0][u] for u in units], pa.int64()),
         pa.array([counts[1][u] for u in units], pa.int64())], ["unit", "plain", "toxic"])


def _covering(docs: list[tuple[int, set[int]]]) -> list[int]:
    """Numbers of the units that explain the toxic documents: again and again the
    one with the most toxic documents not yet explained, less three times what the
    plain documents' share with it would make. Units that only go along with others
    are not taken, unless they have half as many documents as is usual for those
    taken, which a group of copies does not reach."""
    toxic = [units for y, units in docs if y]
    plain = Counter(u for y, units in docs if not y for u in units)
    weight = 3 * len(toxic) / max(1, len(docs) - len(toxic))
    gains = {u: n - weight * plain[u] for u, n in Counter(u for units in toxic for u in units).items()}
    chosen: list[int] = []
    least = max(2, len(toxic) // 500)
    while toxic:
        counts = Counter(u for units in toxic for u in units)
        gain, unit = max(((n - weight * plain[u], -u) for u, n in counts.items()), default=(0, 0))
        if gain < least:
            break
        chosen.append(-unit)
        toxic = [units for units in toxic if -unit not in units]
    if chosen:
        usual = sorted(gains[u] for u in chosen)[len(chosen) // 2]
        chosen += sorted(u for u, gain in gains.items() if u not in set(chosen) and gain >= max(usual / 2, 5))
    return chosen


def train(
    docs: DataFrame, labels: DataFrame, label_col: str = "toxic", parts: int = 3, part: int = 1, rows: int = TRAINING_ROWS,
    most_bytes: int = TRAINING_BYTES, lexicon: int = LEXICON, id_col: str = "doc_id", text_col: str = "text",
) -> Tagger:
    """A tagger from document labels outside the held-out fold.

    Labels name documents, not tokens. Token tags follow from them: words or
    beginnings of words that explain why the toxic documents of the sample are labelled so are tagged in
    those documents. The sample has at most ``rows`` documents of each label,
    without texts of more than ``most_bytes``; counts of its units are made on the
    executors, and unit numbers, but no texts, come to the driver. Without both
    labels the tagger knows nothing and scores every document the same, 0.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y"))
    known = known.where(F.col("y").isin(0, 1) & ~held_out("doc_id", parts, part)).distinct()
    lengths = ids_and_texts(docs, id_col, text_col).where(F.octet_length("text") <= most_bytes).select("doc_id")
    known = known.join(lengths.distinct(), "doc_id", "left_semi")
    chosen = [known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows) for y in (0, 1)]
    chosen = F.broadcast(chosen[0].unionByName(chosen[1]))  # 2 * rows pairs of numbers
    texts = ids_and_texts(docs, id_col, text_col).where(F.octet_length("text") <= most_bytes)
    sample = materialize(texts.join(chosen, "doc_id").select("doc_id", "y", "text"), "labelled")
    totals = {y: n for y, n in sample.groupBy("y").count().collect()}
    tagger = Tagger([])
    tagger.scale = np.array([-30.0, 0.0, 0.0])
    if len(totals) < 2:
        return tagger
    counts = sample.select("y", "text").mapInArrow(lean(_unit_counts), "unit binary, plain long, toxic long").groupBy("unit").agg(
        F.sum("plain").alias("plain"), F.sum("toxic").alias("toxic"))
    rate = (F.col("toxic") + 0.5) / (totals[1] + 1.0)
    gain = F.col("toxic") * F.log(rate / ((F.col("plain") + 0.5) / (totals[0] + 1.0)))
    top = counts.where(F.col("toxic") >= 2).select("unit", gain.alias("gain")).where("gain > 0")
    units = [bytes(r.unit) for r in top.orderBy(F.desc("gain"), F.octet_length("unit"), "unit").limit(lexicon).collect()]

    def collected(numbers) -> list[tuple[int, np.ndarray]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                lists = [np.asarray(numbers(tokens_of(t)), np.int32).tobytes() for t in byte_texts(batch)]
                yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(lists, pa.binary())], ["y", "x"])

        ordered = sample.orderBy(F.xxhash64("doc_id"), "doc_id", "y").select("y", "text")
        return [(r.y, np.frombuffer(r.x, np.int32).astype(np.int64)) for r in ordered.mapInArrow(run, "y int, x binary").toLocalIterator()]

    known_units = {u: i for i, u in enumerate(units)}
    sets = collected(lambda tokens: sorted({known_units[u] for token in set(tokens) for u in units_of(token) if u in known_units}))
    first_units = _covering([(y, set(x.tolist())) for y, x in sets])
    order = first_units + sorted(set(range(len(units))) - set(first_units))
    tagger = Tagger([units[i] for i in order])
    seqs = collected(tagger.numbers)
    explaining = np.zeros(len(units) + 1)
    explaining[1:len(first_units) + 1] = 1.0
    x = np.concatenate([s for _, s in seqs])
    bounds = np.cumsum([0] + [len(s) for _, s in seqs])
    first = np.zeros(len(x), bool)
    first[bounds[:-1][np.diff(bounds) > 0]] = True
    y = explaining[x] * np.repeat([float(label) for label, _ in seqs], np.diff(bounds))
    tagger.fit(x, first, y)
    tagger.fit_scale(Tagger.evidence(tagger.marginals(x, first), bounds), np.array([label for label, _ in seqs], float))
    return tagger


def _spans(text: bytes, p: np.ndarray) -> list[dict]:
    """Runs of tagged tokens as character offsets, with their largest probability."""
    out: list[dict] = []
    tagged = p >= TAGGED_FROM
    if not tagged.any():
        return out
    last = -2
    for i, token in enumerate(_TOKEN.finditer(text)):
        if tagged[i]:
            if i == last + 1:
                out[-1]["end"] = token.end()
                out[-1]["p"] = max(out[-1]["p"], float(p[i]))
            else:
                out.append({"start": token.start(), "end": token.end(), "p": float(p[i])})
            last = i
    for span in out:  # bytes to characters
        span["start"], span["end"] = (len(text[:span[k]].decode()) for k in ("start", "end"))
    return out


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())])


def tag(docs: DataFrame, tagger: Tagger, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, spans, unnamed) for every row; spans are (start, end, p) in
    characters, ``unnamed`` is the SHA-256 of the text of a row without an id."""
    def tagged(doc_ids: list, texts: list[bytes]) -> pa.RecordBatch:
        parts = [tagger.numbers(tokens_of(t)) for t in texts]
        bounds = np.cumsum([0] + [len(p) for p in parts])
        x = np.concatenate(parts)
        first = np.zeros(len(x), bool)
        first[bounds[:-1][np.diff(bounds) > 0]] = True
        p = tagger.marginals(x, first)
        scores = tagger.scores(Tagger.evidence(p, bounds))
        spans = [_spans(t, p[a:b]) for t, a, b in zip(texts, bounds[:-1].tolist(), bounds[1:].tolist())]
        return pa.RecordBatch.from_arrays(
            [pa.array(doc_ids, pa.int64()), pa.array(scores, pa.float64()), pa.array(spans, pa.list_(_SPAN)),
             unnamed(doc_ids, texts)],
            ["doc_id", "score", "spans", "unnamed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids, texts, size = [], [], 0
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), byte_texts(batch)):
                doc_ids.append(doc_id)
                texts.append(text)
                size += len(text)
                if size >= _TEXT_BYTES:
                    yield tagged(doc_ids, texts)
                    doc_ids, texts, size = [], [], 0
            if texts:
                yield tagged(doc_ids, texts)

    return ids_and_texts(docs, id_col, text_col).mapInArrow(
        lean(run), "doc_id long, score double, spans array<struct<start: long, end: long, p: double>>, unnamed string")


def toxicity_scores(
    docs: DataFrame, labels: DataFrame, label_col: str = "toxic", parts: int = 3, part: int = 1,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(doc_id, held_out, score, predicted, spans) for every row of ``docs``.

    Labels are learnt from rows outside the fold crc32(doc_id as text) mod ``parts``
    = ``part``; a score depends on the text alone. Null and empty texts score as
    texts without a toxic token; repeated rows get equal results; a null id is not
    held out and has no label; a label other than 0 and 1 counts as none. No
    documents give no rows, no labels give the score 0. Long texts are whole chains.
    """
    tagger = train(docs, labels, label_col, parts, part, id_col=id_col, text_col=text_col)
    return tag(docs, tagger, id_col, text_col).select(
        "doc_id", held_out("doc_id", parts, part).alias("held_out"), "score",
        (F.col("score") >= PREDICTED_FROM).cast("int").alias("predicted"), "spans")


def without_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose document is not predicted toxic. Rows with a null
    id are judged by their text; of documents with the same id, one toxic text
    removes all."""
    scores = tag(docs, train(docs, labels, id_col=id_col, text_col=text_col), id_col, text_col)
    toxic = scores.where(F.col("score") >= PREDICTED_FROM).select(
        F.coalesce(F.col("doc_id").cast("string"), "unnamed").alias("_toxic")).distinct()
    return docs.join(materialize(toxic, "toxic"), name_of(id_col, text_col) == F.col("_toxic"), "left_anti")
