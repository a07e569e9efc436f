"""A folder of parquet files that keyed loads rewrite file by file.

What a load replaces is found through the files that hold it: only those are read and
written again, in one new folder beside the old files. A version is a small list of
the files that count; it is put in place last, so that readers see the rows from
before a load or after it and nothing between, and a load that dies leaves nothing but
files that no version names.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.operators.upsert import last_per_key, upsert_latest
from feedloom.session import delete_path, materialize


class VersionedFolder:
    """Rows of ``schema``; those of a ``group`` are written close together.

    Loads may name themselves as ``(job, number)`` with numbers that grow, as the
    batches of a stream do. The number is part of the version, so a load that comes again
    is known and left out before any of its rows is computed.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, group: list[str]):
        self.spark, self.path, self.schema, self.group = spark, path.rstrip("/"), schema, group
        self._at = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/_versions")
        self._fs = self._at.getFileSystem(spark._jsc.hadoopConfiguration())

    def _names(self, folder) -> list[str]:
        return [s.getPath().getName() for s in self._fs.listStatus(folder)] if self._fs.exists(folder) else []

    def _child(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(self._at, name)

    def version(self) -> int:
        return max((int(n[:-5]) for n in self._names(self._at) if n.endswith(".json")), default=0)

    def _listed(self, version: int) -> dict:
        if not version:
            return {"files": [], "loads": {}}
        return json.loads(self.spark.read.text(f"{self.path}/_versions/{version:012d}.json", wholetext=True).first()[0])

    def _commit(self, version: int, listed: dict) -> None:
        """The version after ``version``, unless another load has made it."""
        draft, final = self._child(f"draft-{uuid.uuid4().hex}"), self._child(f"{version + 1:012d}.json")
        out = self._fs.create(draft, False)
        out.write(json.dumps(listed).encode())
        out.close()
        if self._fs.exists(final) or not self._fs.rename(draft, final):
            raise RuntimeError(f"{self.path}: another load has made version {version + 1}; run this one again")

    def _read(self, files: list[str]) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*(f"{self.path}/{f}" for f in files))

    def read(self) -> DataFrame:
        return self._read(self._listed(self.version())["files"])

    def has_load(self, load: tuple[str, int]) -> bool:
        return self._listed(self.version())["loads"].get(load[0], -1) >= load[1]

    def _rewrite(self, keys: DataFrame, merged, load: tuple[str, int] | None, together: bool = False) -> bool:
        """Files with rows of ``keys`` give way to ``merged(their rows, or None)``. New rows
        that are ``together`` by group already are written where they are made."""
        version = self.version()
        listed = self._listed(version)
        if load and listed["loads"].get(load[0], -1) >= load[1]:
            return False
        touched = []
        if listed["files"]:
            stored = self._read(listed["files"])
            of_file = stored.select(*keys.columns, F.col("_metadata.file_path").alias("_file"))
            hits = of_file.join(keys, keys.columns, "left_semi").select("_file").distinct().collect()  # names of files
            touched = ["/".join(r["_file"].split("/")[-2:]) for r in hits]
        folder = uuid.uuid4().hex
        rows = merged(self._read(touched) if touched else None)
        if touched or not together:
            rows = rows.hint("rebalance", *self.group)
        rows.write.parquet(f"{self.path}/{folder}")
        fresh = [n for n in self._names(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}")) if n.endswith(".parquet")]
        files = sorted(set(listed["files"]) - set(touched)) + [f"{folder}/{n}" for n in fresh]
        self._commit(version, {"files": files, "loads": listed["loads"] | ({load[0]: load[1]} if load else {})})
        return True

    def upsert(self, batch: DataFrame, keys: list[str], order: list[str] | None = None, load: tuple[str, int] | None = None) -> bool:
        """Last write wins per key; False if the load is known."""
        if load and self.has_load(load):
            return False
        staged = materialize(batch, "incoming")
        return self._rewrite(
            staged.select(*keys),
            lambda old: last_per_key(staged, keys, order or []) if old is None else upsert_latest(old, staged, keys, order), load)

    def replace(self, batch: DataFrame, groups: DataFrame | None = None, load: tuple[str, int] | None = None,
                together: bool = False) -> bool:
        """All rows of the batch's groups give way to the batch; False if the load is
        known. ``groups`` lists those groups when that is cheaper than computing the
        batch, which is then computed once, and may name groups that keep no row.
        ``together``: the rows of a group are made by one task, and need no shuffle to lie
        together unless older rows join them."""
        if load and self.has_load(load):
            return False
        if groups is None:
            groups = batch = materialize(batch, "incoming")
        wanted = groups.select(*self.group).distinct()
        return self._rewrite(
            wanted, lambda old: batch if old is None else old.join(wanted, self.group, "left_anti").unionByName(batch), load, together)

    def drop_old_files(self) -> int:
        """Delete what the newest version does not name; for times without loads or
        readers of older versions. Returns the number of files."""
        version = self.version()
        kept, gone = set(self._listed(version)["files"]), 0
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        for folder in self._names(root):
            if not folder.startswith("_"):
                inside = [n for n in self._names(self.spark._jvm.org.apache.hadoop.fs.Path(root, folder)) if n.endswith(".parquet")]
                old = [n for n in inside if f"{folder}/{n}" not in kept]
                gone += len(old)
                for target in [folder] if len(old) == len(inside) else [f"{folder}/{n}" for n in old]:
                    delete_path(self.spark, f"{self.path}/{target}")
        for name in self._names(self._at):
            if name != f"{version:012d}.json":
                delete_path(self.spark, f"{self.path}/_versions/{name}")
        return gone
