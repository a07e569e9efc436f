"""Token counts by source, language and tokenizer version, kept up by deltas."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions.text import words
from feedloom.llm.tokens import byte_bpe, word_tokenizer
from feedloom.session import materialize

_KEYS = ("source", "lang", "version")
_LEDGER = "doc_id long, source string, lang string, version string, tokens long, sign int"
_DELTA = "source string, lang string, version string, docs long, tokens long"


def token_counts(
    docs: DataFrame, version: str, vocabulary: tuple[str, bool],
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang",
) -> DataFrame:
    """(doc_id, source, lang, version, tokens) per row; null and empty texts have 0
    tokens, null sources and languages stay null."""
    path, blanks = vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_tokenizer(path, blanks).encode
        for batch in batches:
            tokens = [len(encode(t)) // 4 for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("source"), batch.column("lang"), pa.array(tokens, pa.int64())],
                ["doc_id", "source", "lang", "tokens"])

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.col(source_col).cast("string").alias("source"), F.col(lang_col).cast("string").alias("lang"))
    return rows.mapInArrow(run, "doc_id long, source string, lang string, tokens long").select(
        "doc_id", "source", "lang", F.lit(version).alias("version"), "tokens")


def word_counts(
    docs: DataFrame, version: str = "words",
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang",
) -> DataFrame:
    """The same with the words between white space as tokens, without Python."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        F.col(lang_col).cast("string").alias("lang"), F.lit(version).alias("version"),
        F.size(words(F.coalesce(F.col(text_col), F.lit("")))).cast("long").alias("tokens"))


class TokenRollup:
    """Additive totals below a folder that all executors share.

    A batch writes its signed rows to the ledger (+1 for a document that comes, -1
    for one that goes, both for a revised count) and their sums per source, language
    and version, a handful of rows combined before the shuffle, to the deltas. Its
    name in the list of commits makes it count. Committing a name again does
    nothing; a batch that failed before its commit is written anew from the start.
    Totals are the sum of the committed deltas and never look at the ledger.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _read(self, part: str, schema: str) -> DataFrame:
        paths = [f"{self.path}/{part}/{name}" for name in self.committed()]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def committed(self) -> list[str]:
        """Names of the batches that count, in the order of their commits."""
        fs, folder = self._folder()
        if not fs.exists(folder):
            return []
        files = [(f.getModificationTime(), f.getPath().getName()) for f in fs.listStatus(folder)]
        return [name for _, name in sorted(files)]

    def _folder(self):
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/commits")
        return folder.getFileSystem(self.spark._jsc.hadoopConfiguration()), folder

    def current(self, ids: DataFrame | None = None) -> DataFrame:
        """The ledger's rows that stand, of ``ids`` if given: those whose signs do not
        cancel out. A row that was inserted twice stands twice."""
        ledger = self._read("ledger", _LEDGER)
        if ids is not None:
            ledger = ledger.join(ids, "doc_id", "left_semi")
        net = ledger.groupBy("doc_id", *_KEYS, "tokens").agg(F.sum("sign").alias("times"))
        return net.where("times > 0").withColumn("times", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).drop("times")

    def commit(
        self, name: str, inserts: DataFrame | None = None, deletes: DataFrame | None = None, revisions: DataFrame | None = None
    ) -> bool:
        """Apply a batch; False if ``name`` is committed already.

        ``inserts`` and ``revisions`` have the columns of ``token_counts``;
        ``deletes`` has ``doc_id``. A delete takes back every standing count of the
        id. A revision takes back those of its id and adds its own row; for an id
        without any it is an insert. Null ids insert, but neither delete nor revise
        what stands. An id may stand in one of the three only.
        """
        if name in self.committed():
            return False
        # Used for what comes and for what goes; a few numbers per document.
        revisions = revisions if revisions is None else materialize(revisions, "revisions")
        parts = []
        for frame in (inserts, revisions):
            if frame is not None:
                parts.append(frame.select("doc_id", *_KEYS, "tokens", F.lit(1).alias("sign")))
        gone = [frame.select("doc_id") for frame in (deletes, revisions) if frame is not None]
        if gone:
            ids = gone[0] if len(gone) == 1 else gone[0].unionByName(gone[1])
            # Written, so that Spark knows how small the batch is beside the ledger.
            ids = materialize(ids.distinct(), "gone")
            parts.append(self.current(ids).select("doc_id", *_KEYS, "tokens", F.lit(-1).alias("sign")))
        rows = self.spark.createDataFrame([], _LEDGER)
        for part in parts:
            rows = rows.unionByName(part)
        rows.write.mode("overwrite").parquet(f"{self.path}/ledger/{name}")
        stored = self.spark.read.schema(_LEDGER).parquet(f"{self.path}/ledger/{name}")
        stored.groupBy(*_KEYS).agg(
            F.sum(F.col("sign").cast("long")).alias("docs"), F.sum(F.col("sign") * F.col("tokens")).alias("tokens"),
        ).write.mode("overwrite").parquet(f"{self.path}/deltas/{name}")
        fs, folder = self._folder()
        fs.mkdirs(folder)
        fs.create(self.spark._jvm.org.apache.hadoop.fs.Path(folder, name), False).close()
        return True

    def totals(self) -> DataFrame:
        """(source, lang, version, docs, tokens) of what stands; groups without
        documents are left out."""
        sums = self._read("deltas", _DELTA).groupBy(*_KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        return sums.where("docs <> 0")


def corpus_totals(docs: DataFrame, labels: DataFrame, path: str) -> DataFrame:
    """Totals of a corpus after three batches: every document counted with the
    byte-level vocabulary; documents labelled toxic withdrawn; documents labelled
    of low quality revised to counts of plain words. The second batch is sent twice
    and counts once. Texts are counted where they lie; only counts are joined."""
    rollup = TokenRollup(docs.sparkSession, path)
    ids = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic", "quality").where("doc_id IS NOT NULL")
    toxic = ids.where("toxic = 1").select("doc_id").distinct()
    poor = ids.where("quality = 0").select("doc_id").distinct().join(toxic, "doc_id", "left_anti")
    rollup.commit("load", inserts=token_counts(docs, "byte_bpe_50k", byte_bpe()))
    for _ in range(2):
        rollup.commit("withdraw", deletes=toxic)
    rollup.commit("revise", revisions=word_counts(docs).join(poor, "doc_id", "left_semi"))
    return rollup.totals()
