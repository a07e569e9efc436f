"""Quality scores by gradient-boosted trees over statistics of a document's text."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import byte_texts, held_out, ids_and_texts
from feedloom.session import materialize

#: Labelled rows that a model is fitted on at most: those with the smallest hash
#: of their id. The rows are statistics of whole texts, 30 numbers each.
TRAINING_ROWS = 20_000
PREDICTED_FROM = 0.7

_PUNCTUATION = np.frombuffer(b".,;:!?'\"()-", np.uint8)
_SYMBOLS = np.frombuffer(b"#$%&*+/<=>@[\\]^_`{|}~", np.uint8)
FEATURES = (
    "bytes", "words", "lines", "mean_word", "mean_line", "longest_word", "upper", "lower", "digits", "punctuation",
    "symbols", "non_ascii", "control", "spaces", "bars", "exclamations", "stops", "commas", "entropy", "distinct_words",
    "top_word", "top_two_words", "adjacent_repeats", "short_words", "long_words", "words_ending_symbol", "words_upper",
    "repeated_lines", "top_line", "repeated_shingles",
)


def statistics(text: bytes) -> list[float]:
    """One row of ``FEATURES``; shares are 0 for an empty text."""
    n = len(text)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256).astype(np.float64)
    total = max(n, 1)
    share = counts / total
    seen = share[share > 0]
    words = text.split()
    m = max(len(words), 1)
    freq = Counter(words)
    top = sorted(freq.values())[-2:][::-1]
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    lines = text.split(b"\n")
    line_freq = Counter(lines)
    shingles = len(set(zip(words, words[1:], words[2:])))
    return [
        np.log1p(n), np.log1p(len(words)), np.log1p(len(lines)), lengths.mean(), n / len(lines), np.log1p(int(lengths.max())),
        share[65:91].sum(), share[97:123].sum(), share[48:58].sum(), share[_PUNCTUATION].sum(), share[_SYMBOLS].sum(),
        share[128:].sum(), share[:9].sum() + share[14:32].sum(), share[32], share[124], share[33], share[46], share[44],
        float(-(seen * np.log2(seen)).sum()), len(freq) / m, (top[0] if top else 0) / m, sum(top) / m,
        sum(a == b for a, b in zip(words, words[1:])) / m, float((lengths <= 2).sum()) / m, float((lengths > 12).sum()) / m,
        sum(w[-1:] in b"#$%&*|~^" for w in words) / m, sum(map(bytes.isupper, words)) / m,
        1 - len(line_freq) / len(lines), max(line_freq.values()) / len(lines),
        1 - shingles / max(len(words) - 2, 1) if len(words) > 2 else 0.0,
    ]


class BoostedTrees:
    """Logistic gradient boosting with histogram splits, as complete trees in flat arrays.

    Tree t has its inner nodes in ``feature[t]`` and ``threshold[t]`` in heap order
    (children of i: 2i+1, 2i+2) and its leaves in ``leaf[t]``. A node that is not
    split keeps an infinite threshold, which sends every row left.
    """

    def __init__(self, prior: float, feature: np.ndarray, threshold: np.ndarray, leaf: np.ndarray) -> None:
        self.prior, self.feature, self.threshold, self.leaf = prior, feature, threshold, leaf

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15,
            bins: int = 64, l2: float = 1.0, least: int = 10) -> BoostedTrees:
        inner, leaves = 2**depth - 1, 2**depth
        feature = np.zeros((trees, inner), np.int64)
        threshold = np.full((trees, inner), np.inf)
        leaf = np.zeros((trees, leaves))
        rate_of_ones = (y.sum() + 0.5) / (len(y) + 1.0)  # half a row of each label, so that the prior is finite
        prior = float(np.log(rate_of_ones / (1 - rate_of_ones)))
        model = cls(prior, feature, threshold, leaf)
        if len(y) == 0 or y.min() == y.max():
            return model
        n, width = x.shape
        cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
        binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
        usable = np.array([[b < len(c) for b in range(bins)] for c in cuts])
        flat = binned + np.arange(width) * bins
        margin = np.full(n, prior)
        for t in range(trees):
            p = 1 / (1 + np.exp(-margin))
            grad, hess = p - y, p * (1 - p)
            node = np.zeros(n, np.int64)
            for level in range(depth):
                first, count = 2**level - 1, 2**level
                cell = ((node - first)[:, None] * (width * bins) + flat).ravel()
                shape, size = (count, width, bins), count * width * bins
                g = np.bincount(cell, np.repeat(grad, width), size).reshape(shape).cumsum(2)
                h = np.bincount(cell, np.repeat(hess, width), size).reshape(shape).cumsum(2)
                c = np.bincount(cell, minlength=size).reshape(shape).cumsum(2)
                gt, ht, ct = g[:, :, -1:], h[:, :, -1:], c[:, :, -1:]
                gain = g**2 / (h + l2) + (gt - g) ** 2 / (ht - h + l2) - gt**2 / (ht + l2)
                gain[(c < least) | (ct - c < least) | ~usable] = -np.inf
                best = gain.reshape(count, -1).argmax(1)
                for k in range(count):
                    f, b = divmod(int(best[k]), bins)
                    if gain[k, f, b] > 1e-9:
                        feature[t, first + k], threshold[t, first + k] = f, cuts[f][b]
                node = 2 * node + 1 + (x[np.arange(n), feature[t, node]] > threshold[t, node])
            place = node - inner
            leaf[t] = -rate * np.bincount(place, grad, leaves) / (np.bincount(place, hess, leaves) + l2)
            margin += leaf[t, place]
        return model

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probabilities; all rows walk down a tree together."""
        rows, margin = np.arange(len(x)), np.full(len(x), self.prior)
        inner = self.feature.shape[1]
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), np.int64)
            while inner and len(node) and node[0] < inner:
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            margin += leaf[node - inner]
        return 1 / (1 + np.exp(-margin))


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        flat = np.array([statistics(t) for t in byte_texts(batch)], np.float64).reshape(-1)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, len(FEATURES)), pa.int32()), pa.array(flat))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], ["doc_id", "x"])


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, x): the statistics of every whole text, in the order of ``FEATURES``."""
    return ids_and_texts(docs, id_col, text_col).mapInArrow(_statistics, "doc_id long, x array<double>")


def train(stats: DataFrame, labels: DataFrame, label_col: str, parts: int, part: int, rows: int = TRAINING_ROWS) -> BoostedTrees:
    """A model of the labelled rows outside the held-out fold. At most ``rows`` of
    them are used, those with the smallest hash of their id; their statistics are
    collected to the driver. Rows without a label of 0 or 1 are left out; without
    both labels the model is their share alone (none: 0.5)."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y"))
    known = known.where(F.col("y").isin(0, 1) & ~held_out("doc_id", parts, part))
    # Statistics of chosen rows alone come together: hashes are counted by their upper 16
    # bits, and what lies beyond the rows asked for is left out before anything is sorted.
    upper = F.shiftright(F.xxhash64("doc_id"), 48)
    counts = known.join(stats.select("doc_id"), "doc_id").groupBy(upper.alias("upper")).count().collect()
    total = 0
    for last, count in sorted(map(tuple, counts)):
        total += count
        if total >= rows:
            known = known.where(upper <= last)
            break
    sample = stats.join(known, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(rows).select("x", "y").toPandas()
    x = np.stack(sample["x"].to_list()) if len(sample) else np.empty((0, len(FEATURES)))
    return BoostedTrees.fit(x, sample["y"].to_numpy(np.float64))


def quality_scores(
    docs: DataFrame, labels: DataFrame, label_col: str = "quality", parts: int = 4, part: int = 2,
    rows: int = TRAINING_ROWS, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    Labels are learnt from rows outside the fold crc32(doc_id as text) mod
    ``parts`` = ``part``; only statistics of the text go into a score. Null and
    empty texts have a score too; repeated rows get equal scores; a null id is not
    held out and has no label; a document with several labels counts once for each.
    Empty tables: no documents give no rows, no labels give the score 0.5.
    """
    stats = materialize(document_statistics(docs, id_col, text_col), "statistics")
    model = train(stats, labels, label_col, parts, part, rows)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.asarray(batch.column("x").flatten()).reshape(batch.num_rows, len(FEATURES))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(model.predict(x), pa.float64())], ["doc_id", "score"])

    scored = stats.mapInArrow(score, "doc_id long, score double")
    return scored.select(
        "doc_id", held_out("doc_id", parts, part).alias("held_out"), "score",
        (F.col("score") >= PREDICTED_FROM).cast("int").alias("predicted"))
