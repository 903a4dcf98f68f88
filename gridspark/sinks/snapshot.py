"""Snapshot commits: several results of one batch become visible together, or not at all.

A batch stages its frames as Parquet under folders of their own and then publishes one
manifest that names them, by moving a finished file into place; readers see only what manifests
name. A failure before that leaves nothing to be seen, and a batch whose manifest exists is
not written again when it is replayed.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class SnapshotStore:
    """Named tables under ``root`` (any file system Spark writes to), grown by batches."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self):
        return self._path(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _manifest(self, batch_id: int) -> str:
        return f"{self.root}/manifests/{batch_id:020d}.json"

    def committed(self, batch_id: int) -> bool:
        return self._fs().exists(self._path(self._manifest(batch_id)))

    def write(self, batch_id: int, frames: dict[str, DataFrame], partition_by: dict[str, list[str]] | None = None) -> bool:
        """Stage all ``frames`` (name -> rows) and publish them as batch ``batch_id``; False when that batch
        is there already. Row counts are taken while writing."""
        if self.committed(batch_id):
            return False
        entry: dict = {"batch_id": batch_id, "frames": {}}
        for name, df in frames.items():
            path, seen = f"data/{name}/batch_id={batch_id}/try={uuid.uuid4().hex}", Observation()
            writer = df.observe(seen, F.count(F.lit(1)).alias("n")).write
            by = (partition_by or {}).get(name)
            (writer.partitionBy(*by) if by else writer).parquet(f"{self.root}/{path}")
            entry["frames"][name] = {"path": path, "rows": int(seen.get["n"]), "schema": df.schema.json()}
        return self._publish(batch_id, entry)

    def _publish(self, batch_id: int, entry: dict) -> bool:
        fs = self._fs()
        final = self._path(self._manifest(batch_id))
        fs.mkdirs(final.getParent())
        staged = self._path(f"{self.root}/manifests/_{batch_id}-{uuid.uuid4().hex}")
        out = fs.create(staged)
        try:
            out.write(bytearray(json.dumps(entry).encode()))
        finally:
            out.close()
        if not fs.exists(final) and fs.rename(staged, final):
            return True
        fs.delete(staged, False)
        return False

    def manifests(self) -> list[dict]:
        """The published batches in order: one small file for each."""
        pattern = f"{self.root}/manifests/[0-9]*.json"
        if not self._fs().globStatus(self._path(pattern)):
            return []
        rows = self.spark.read.text(pattern, wholetext=True).collect()
        return sorted((json.loads(r["value"]) for r in rows), key=lambda m: m["batch_id"])

    def read(self, name: str) -> DataFrame:
        """All published rows of a table with their ``batch_id``."""
        held = [(m["batch_id"], m["frames"][name]) for m in self.manifests() if name in m["frames"]]
        if not held:
            raise LookupError(f"no batch has published {name!r}")
        schema = T.StructType.fromJson(json.loads(held[-1][1]["schema"]))
        paths = [f"{self.root}/{f['path']}" for _, f in held if f["rows"]]
        full = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
        if not paths:
            return self.spark.createDataFrame([], full)
        return self.spark.read.schema(full).option("basePath", f"{self.root}/data/{name}").parquet(*paths).select(*full.names)

    def vacuum(self) -> int:
        """Delete staged folders that no manifest names (failed attempts); run it while nothing writes."""
        named = {f["path"] for m in self.manifests() for f in m["frames"].values()}
        fs, gone = self._fs(), 0
        for folder in fs.globStatus(self._path(f"{self.root}/data/*/*/try=*")):
            path = folder.getPath()
            if "/".join(["data", path.getParent().getParent().getName(), path.getParent().getName(), path.getName()]) not in named:
                gone += bool(fs.delete(path, True))
        return gone
