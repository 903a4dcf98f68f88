"""File listings made by tasks, level by level.

Spark's own listing of a deep tree goes through the driver. Here the folders of one level are a
written table; tasks list them, files go to the result, and the folders found are the next level,
until there are none. The driver holds one count for each level.
"""

from __future__ import annotations

from collections.abc import Iterator
from fnmatch import fnmatchcase
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.session import scratch_path
from gridspark.sources.netcdf import _filesystem

FOUND = "path string, folder boolean, length long, modification_time timestamp"


def _lister(glob: str) -> callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs as pafs

        for batch in batches:
            for path in batch.column("path").to_pylist():
                fs, own = _filesystem(path)
                rows = []
                for f in fs.get_file_info(pafs.FileSelector(own)):
                    folder = f.type == pafs.FileType.Directory
                    if f.base_name[0] in "._" or not (folder or fnmatchcase(f.base_name, glob)):
                        continue
                    name = quote(f.base_name) if path.startswith("file:") else f.base_name
                    rows.append((f"{path}/{name}", folder, None if folder else f.size, f.mtime_ns // 1000 if f.mtime_ns else None))
                cols = list(zip(*rows, strict=True)) or [()] * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.bool_()), pa.array(cols[2], pa.int64()),
                     pa.array(cols[3], pa.timestamp("us", "UTC"))], names=["path", "folder", "length", "modification_time"])

    return run


def list_tree(spark: SparkSession, root: str, glob: str = "*.nc") -> DataFrame:
    """path, length, modification_time of every file under ``root`` whose name matches ``glob``; names starting with ``.`` or
    ``_`` are left out, with all that is below them; local paths are URIs, as Spark lists them. A missing root fails, an empty one gives no rows."""
    root = root.rstrip("/")
    root = root if ":" in root.split("/", 1)[0] else f"file:{quote(root)}"
    base = scratch_path(spark, "listing")
    frontier = spark.createDataFrame([(root,)], "path string")
    tasks, level = 4 * spark.sparkContext.defaultParallelism, 0  # the tasks wait for the store
    while True:
        out = f"{base}/level={level}"
        frontier.repartition(tasks, "path").mapInArrow(_lister(glob), FOUND).write.parquet(out)
        found = spark.read.schema(FOUND).parquet(out)
        frontier = found.filter("folder").select("path")
        if frontier.isEmpty():
            break
        level += 1
    levels = spark.read.schema(FOUND).parquet(*[f"{base}/level={k}" for k in range(level + 1)])
    return levels.filter("NOT folder").select("path", "length", F.col("modification_time"))
