"""A stored catalogue of file headers, so that unchanged files are not opened again.

One entry for each (path, length, modification time): the header as text and the values of
its scalars and one-dimensional variables, or why the file cannot be read. Updates add
entries for files that are new or changed, as one published batch; a request is resolved from
the entry of the file as it is now.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridspark.session import scratch_path
from gridspark.sinks.snapshot import SnapshotStore
from gridspark.sources import gridfile as G
from gridspark.sources import netcdf as nc

KEY = ["path", "length", "modified"]
STATS = "path string, length long, modified long"
ENTRY = f"{STATS}, header string, error string"


def header_text(reader: nc.RangeReader, h: nc.Header) -> str:
    """A header with the values of its fixed variables of at most one dimension, as text."""
    small = [v for v in h.variables.values() if len(v.dim_ids) < 2 and not h.is_record(v)]
    values = {}
    for v in small:
        n = v.dtype.itemsize * (h.shape(v)[0] if v.dim_ids else 1)
        values[v.begin] = base64.b64encode(reader.read(v.begin, n)).decode()
    packed = [v.name for v in h.variables.values() if {"scale_factor", "add_offset"} & set(v.attrs)]
    return json.dumps({"layout": h.layout(list(h.variables)), "values": values, "packed": packed})


class KnownFile(nc.RangeReader):
    """Stands for a file of which the catalogue knows the header and the small variables: other ranges are
    only checked against its length."""

    def __init__(self, text: str, size: int):
        held = json.loads(text)
        self.size = size
        self.values = {int(at): base64.b64decode(x) for at, x in held["values"].items()}
        self.header = nc.Header.from_layout(held["layout"])
        for name in held["packed"]:
            self.header.variables[name].attrs["scale_factor"] = None

    def read(self, offset: int, n: int) -> bytes:
        if offset < 0 or offset + n > self.size:
            raise nc.FormatError(f"read past end of file ({offset}+{n} > {self.size})")
        return self.values.get(offset, b"")[:n].ljust(n, b"\0")

    def close(self) -> None:
        pass


def _stat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyarrow import fs as pafs

    for batch in batches:
        rows = []
        for path in batch.column("path").to_pylist():
            fs, own = nc._filesystem(path)
            info = fs.get_file_info(own)
            there = info.type == pafs.FileType.File
            rows.append((path, info.size if there else None, info.mtime_ns // 1000 if there else None))
        cols = list(zip(*rows, strict=True)) or [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64())], names=KEY)


def _open(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for path in batch.column("path").to_pylist():
            try:
                reader = nc.open_reader(path)
                try:
                    out.append((header_text(reader, nc.read_header(reader)), None))
                finally:
                    reader.close()
            except G.UNREADABLE as e:
                out.append((None, f"{type(e).__name__}: {e}"))
        cols = list(zip(*out, strict=True)) or [()] * 2
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in KEY] + [pa.array(c, pa.string()) for c in cols], names=[*KEY, "header", "error"])


def _resolver(block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.name for f in G.RESOLVED_SCHEMA.fields]
        for batch in batches:
            out = {n: [] for n in names}
            for row in batch.to_pylist():
                if row["length"] is None:
                    got = dict(error=f"FileNotFoundError: {row['path']}")
                elif row["error"] is not None:
                    got = dict(error=row["error"])
                else:
                    try:
                        known = KnownFile(row["header"], row["length"])
                        got = G.resolve_one(known, known.header, row["measure"], row["coord_y"], row["coord_x"], row["r_limit"], block_bytes)
                    except nc.FormatError as e:
                        got = dict(error=f"FormatError: {e}")
                for n in names:
                    out[n].append(row[n] if n in G.REQUEST_COLUMNS else got.get(n))
            yield pa.RecordBatch.from_pydict(out, schema=G._arrow(G.RESOLVED_SCHEMA))

    return run


class HeaderCatalogue:
    """A catalogue under ``root`` in the shared folder or any file system Spark writes to."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.store = spark, SnapshotStore(spark, root)
        self.opened = 0  # files opened by the last update

    def entries(self) -> DataFrame:
        if not self.store.manifests():
            return self.spark.createDataFrame([], ENTRY)
        return self.store.read("headers").drop("batch_id").dropDuplicates(KEY)

    def _spread(self, rows: DataFrame) -> DataFrame:
        return rows.repartition(4 * self.spark.sparkContext.defaultParallelism, "path")  # the tasks wait for the store

    def stats(self, paths: DataFrame) -> DataFrame:
        """path, length, modified of each distinct path as it is now (nulls: no such file), written."""
        out = scratch_path(self.spark, "file-stats")
        self._spread(paths.select("path").distinct()).mapInArrow(_stat, STATS).write.parquet(out)
        return self.spark.read.schema(STATS).parquet(out)

    def update(self, stats: DataFrame) -> int:
        """Open the files of ``stats`` that have no entry as they are now, and publish theirs; how many that were."""
        new = stats.filter("length IS NOT NULL").join(self.entries().select(*KEY), KEY, "left_anti")
        path = scratch_path(self.spark, "new-headers")
        self._spread(new).mapInArrow(_open, ENTRY).write.parquet(path)
        added = self.spark.read.schema(ENTRY).parquet(path)
        self.opened = added.count()
        batch = max([m["batch_id"] for m in self.store.manifests()], default=-1) + 1
        while self.opened and not self.store.write(batch, {"headers": added}):
            batch += 1  # another update was faster
        return self.opened

    def resolve(self, requests: DataFrame, block_bytes: int = G.DEFAULT_BLOCK_BYTES) -> DataFrame:
        """``gridfile.resolve`` without opening files that are unchanged since an earlier call."""
        requests = requests.select(*G.REQUEST_COLUMNS)
        stats = self.stats(requests)
        self.update(stats)
        known = stats.join(self.entries(), KEY, "left")
        rows = requests.join(known, "path")
        return rows.mapInArrow(_resolver(block_bytes), G.RESOLVED_SCHEMA)

    def describe(self, paths: DataFrame) -> DataFrame:
        """``gridfile.describe_files`` from the catalogue; files that are not in it yet are added."""
        stats = self.stats(paths)
        self.update(stats)
        return stats.join(self.entries(), KEY, "left").mapInArrow(_described, G.DESCRIBE_SCHEMA)


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.name for f in T.StructType(G.DESCRIBE_SCHEMA.fields).fields]
    for batch in batches:
        rows = {n: [] for n in names}
        for row in batch.to_pylist():
            if row["header"] is None:
                found = [dict(kind="error", error=row["error"] or f"FileNotFoundError: {row['path']}")]
            else:
                found = G.header_rows(KnownFile(row["header"], row["length"]).header)
            for f in found:
                for n in names:
                    rows[n].append(row["path"] if n == "path" else f.get(n))
        yield pa.RecordBatch.from_pydict(rows, schema=G._arrow(G.DESCRIBE_SCHEMA))
