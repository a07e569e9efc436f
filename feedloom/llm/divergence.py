"""How far the vocabulary of each source is from that of the others, by run lengths.

Terms with equal counts in all sources are one row with a weight. The rows are sorted, so
that equal counts of a source lie together, and each source's column becomes runs of
equal counts. Two columns are compared run by run: where their run boundaries meet,
the value of a term is multiplied by the weight of the run.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import byte_texts
from feedloom.session import materialize

LEAST_DOCUMENTS, TOP_TERMS = 10, 10
UNIT = 1_000_000_000
#: Distinct counts that a task gathers before it sends them on.
GATHERED = 1 << 19
#: Counts of a tile of the vocabulary, and sources that one task compares with all others.
TILE_CELLS, BLOCK_SOURCES = 1 << 19, 256
_PIECE = 1 << 20
#: A-Z to a-z; a-z and all bytes of other alphabets stay, the rest separates terms.
_TERM_BYTES = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, piece by piece."""
    text, at = text.translate(_TERM_BYTES), 0
    while at < len(text):
        end = text.find(b" ", at + _PIECE)
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each term per lang and source. An empty term with no
    occurrences says that the group exists."""
    def sent() -> pa.RecordBatch:
        out: list[list] = [[], [], [], [], []]
        for (lang, source), number in counts.items():
            seen = documents[lang, source]
            rows = [(b"", 0, 0), *((t, n, seen[t]) for t, n in number.items())]
            for column, values in zip(out, ([lang] * len(rows), [source] * len(rows), *map(list, zip(*rows)))):
                column += values
        return pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.string()), pa.array(out[1], pa.string()), pa.array(out[2], pa.binary()).cast(pa.string()),
             pa.array(out[3], pa.int64()), pa.array(out[4], pa.int64())], ["lang", "source", "term", "n", "docs"])

    counts, documents = defaultdict(Counter), defaultdict(Counter)
    for batch in batches:
        for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), byte_texts(batch)):
            number, distinct = counts[lang, source], set()
            for words in terms(text):
                number.update(words)
                distinct.update(words)
            documents[lang, source].update(distinct)
        if sum(map(len, counts.values())) > GATHERED:
            yield sent()
            counts, documents = defaultdict(Counter), defaultdict(Counter)
    if counts:
        yield sent()


def runs(rows: np.ndarray, values: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(first row, value) of each run of a column of ``n`` rows that has ``values`` at the
    ascending ``rows`` and 0 elsewhere."""
    if not len(rows):
        return np.zeros(1, np.int64), np.zeros(1, np.int64)
    new = np.append(True, (rows[1:] != rows[:-1] + 1) | (values[1:] != values[:-1]))
    first = np.flatnonzero(new)
    ends = rows[np.append(first[1:] - 1, len(rows) - 1)] + 1
    starts = np.concatenate(([0], ends, rows[first]))  # at equal rows the last one counts
    what = np.concatenate((np.zeros(1 + len(ends), np.int64), values[first]))
    order = np.argsort(starts, kind="stable")
    starts, what = starts[order], what[order]
    keep = np.append(starts[1:] != starts[:-1], True) & (starts < n)
    return starts[keep], what[keep]


def share(counts: np.ndarray, total: int, terms_: int) -> np.ndarray:
    """p of each count, in exact integers."""
    distinct, where = np.unique(counts, return_inverse=True)
    return np.array([1 + UNIT * (int(c) + 2) // (total + 2 * terms_) for c in distinct.tolist()], np.int64)[where]


def compared(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], weights: np.ndarray) -> int:
    """Sum over all terms of floor((p - q)^2 / (p + q)), run by run; ``weights`` are the
    terms before each row and in all."""
    at = np.union1d(a[0], b[0])
    p, q = (s[1][np.searchsorted(s[0], at, "right") - 1] for s in (a, b))
    length = np.diff(np.append(weights[at], weights[-1]))
    return int(((p - q) * (p - q) // (p + q) * length).sum())


def _pairs(block_sources: int):
    """Part of the divergence of two sources, for the terms of one tile."""
    def run(tile: pa.Table, groups: pa.Table) -> pa.Table:
        out: list[tuple[str, str, str, int]] = []
        if tile.num_rows and groups.num_rows:
            sources = sorted(groups.to_pylist(), key=lambda g: g["number"])
            number = {g["source"]: i for i, g in enumerate(sources)}
            tile = tile.take(np.argsort(np.asarray(tile.column("at")))).combine_chunks()
            cells = tile.column("cells").chunk(0)
            ends, flat = np.asarray(cells.offsets, dtype=np.int64), cells.values
            row = np.repeat(np.arange(tile.num_rows), np.diff(ends))
            column = np.array([number[s] for s in flat.field("source").to_pylist()[ends[0]:ends[-1]]], np.int64)
            count = np.asarray(flat.field("n"))[ends[0]:ends[-1]]
            order = np.argsort(column, kind="stable")
            row, count = row[order], count[order]
            edges = np.searchsorted(column[order], np.arange(len(sources) + 1))
            weights = np.append(0, np.cumsum(np.asarray(tile.column("weight"))))
            columns = []
            for i, g in enumerate(sources):
                starts, what = runs(row[edges[i]:edges[i + 1]], count[edges[i]:edges[i + 1]], tile.num_rows)
                columns.append((starts, share(what, g["total"], g["terms"])))
            lang, block = sources[0]["lang"], groups.column("of_block")[0].as_py()
            for i, g in enumerate(sources):
                if g["number"] // block_sources == block:
                    out += [(lang, g["source"], sources[j]["source"], compared(columns[i], columns[j], weights)) for j in range(i + 1, len(sources))]
        lists = list(zip(*out)) or [()] * 4
        return pa.table({"lang": pa.array(lists[0], pa.string()), "source": pa.array(lists[1], pa.string()),
                         "item": pa.array(lists[2], pa.string()), "value": pa.array(lists[3], pa.int64())})
    return run


def _share(count: str, total: str) -> Column:
    return F.expr(f"1 + (CAST({UNIT} AS DECIMAL(10, 0)) * CAST({count} + 2 AS DECIMAL(20, 0))) div CAST({total} + 2 * terms AS DECIMAL(20, 0))")


def audit(docs: DataFrame, tile_cells: int = TILE_CELLS, block_sources: int = BLOCK_SOURCES) -> DataFrame:
    """(lang, source, part, item, value, rank) of every source of every language.

    Terms are runs of letters, A-Z lower-cased; each language keeps those in at least
    10 of its documents. Part ``pair`` has every other source of the language with the
    divergence of the two over all kept terms, part ``term`` the ten kept terms that the
    source uses most above its language. Ranks go by value, then by name. All of it in
    exact integers.

    Texts are counted in tasks and leave them as counts. A term's row has one count per
    source that uses it; rows with equal counts are counted together, sorted, and cut into
    tiles of ``tile_cells`` counts or so. A task compares up to ``block_sources`` sources with all
    others over one tile. The result has a row per pair of sources, as its purpose is; nothing
    else is squared.

    Null text, language and source count as empty. Every row is a document, repeated ids
    and rows included. A language without kept terms gives pairs of value 0; a source
    that is alone in its language gives none. An empty table gives no rows.
    """
    texts = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    sent = texts.mapInArrow(_gathered, "lang string, source string, term string, n long, docs long")
    counts = materialize(sent.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "counts")
    kept = counts.where("term <> ''").groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("in_lang"), F.sort_array(F.collect_list(F.struct("source", "n"))).alias("cells"))
    kept = materialize(kept.where(F.col("docs") >= LEAST_DOCUMENTS).drop("docs"), "kept_terms")

    used = kept.select("lang", F.explode("cells").alias("c")).groupBy("lang", F.col("c.source").alias("source")).agg(F.sum("c.n").alias("total"))
    by_lang = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("in_lang").alias("lang_total"))
    groups = counts.select("lang", "source").distinct().join(used, ["lang", "source"], "left").join(by_lang, "lang", "left").na.fill(0, ["total", "terms", "lang_total"])
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = materialize(groups.withColumn("number", number), "groups")

    # Equal rows together, in the order of their counts; tiles stay as they were written.
    equal = materialize(kept.groupBy("lang", "cells").agg(F.count(F.lit(1)).alias("weight")), "equal_terms")
    cells = equal.agg(F.sum(F.size("cells"))).first()[0] or 0
    tiles = equal.repartitionByRange(max(1, -(-cells // tile_cells)), "lang", "cells").sortWithinPartitions("lang", "cells")
    tiles = materialize(tiles.select("*", F.spark_partition_id().alias("tile"), F.monotonically_increasing_id().alias("at")), "tiles")
    blocks = groups.groupBy("lang").agg(F.explode(F.sequence(F.lit(0), F.floor(F.max("number") / block_sources))).alias("block"))
    tiles = materialize(tiles.join(blocks, "lang"), "tile_blocks")
    keys = tiles.select("lang", F.col("tile").alias("of_tile"), F.col("block").alias("of_block")).distinct()
    right = groups.join(keys, "lang").withColumn("of_lang", F.concat("lang", F.lit(""))).groupBy("of_lang", "of_tile", "of_block")
    parts = tiles.groupBy("lang", "tile", "block").cogroup(right).applyInArrow(_pairs(block_sources), "lang string, source string, item string, value long")
    values = materialize(parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")), "divergence")
    both = values.unionByName(values.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))

    every = groups.select("lang", "source").join(groups.select("lang", F.col("source").alias("item")), "lang").where("source <> item")
    pairs = every.join(both, ["lang", "source", "item"], "left").select(
        "lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).cast("long").alias("value"))
    own = kept.select("lang", "term", "in_lang", F.explode("cells").alias("c")).select("lang", "term", "in_lang", "c.source", "c.n")
    both = own.where("n > 0").join(groups, ["lang", "source"]).withColumns({"p": _share("n", "total"), "q": _share("in_lang", "lang_total")})
    above = both.where("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr("((p - q) * (p - q)) div (p + q)").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item")
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(
        above.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP_TERMS))


AUDIT_SQL = f"""
    WITH d AS (
        SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS found
        FROM documents),
    w AS (SELECT r, lang, source, unnest(found) AS term FROM d),
    kept AS MATERIALIZED (SELECT lang, term, count(*) AS n FROM w GROUP BY ALL HAVING count(DISTINCT r) >= {LEAST_DOCUMENTS}),
    c AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
    g AS MATERIALIZED (
        SELECT lang, source, coalesce(t.n, 0) AS total, coalesce(l.v, 0) AS v, coalesce(l.n, 0) AS lang_total
        FROM (SELECT DISTINCT lang, source FROM d)
        LEFT JOIN (SELECT lang, source, CAST(sum(n) AS BIGINT) AS n FROM c GROUP BY ALL) t USING (lang, source)
        LEFT JOIN (SELECT lang, count(*) AS v, CAST(sum(n) AS BIGINT) AS n FROM kept GROUP BY ALL) l USING (lang)),
    p AS MATERIALIZED (
        SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
               1 + ({UNIT}::HUGEINT * (coalesce(c.n, 0) + 2)) // (g.total + 2 * g.v) AS p,
               1 + ({UNIT}::HUGEINT * (k.n + 2)) // (g.lang_total + 2 * g.v) AS q
        FROM g JOIN kept k ON g.lang = k.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
    pair AS (
        SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
        FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
    rows AS (
        SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(pair.value, 0) AS BIGINT) AS value
        FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source
        UNION ALL
        SELECT lang, source, 'term', term, CAST(((p - q) * (p - q)) // (p + q) AS BIGINT) FROM p WHERE n > 0 AND p > q)
    SELECT lang, source, part, item, value,
           CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
    FROM rows QUALIFY part = 'pair' OR rank <= {TOP_TERMS}
"""
