"""Least and largest coordinates and values of every block, so that a box or a range of
values rules blocks out before they are read.

Statistics are kept for each (path, length, modification time, measure, realization, first y line),
gathered by one pass over the blocks that have none, and published like the header catalogue.
A search joins them to the read plan: blocks that cannot hold a wanted cell leave the plan,
blocks without statistics stay, and the cells that are read are judged one by one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.operators.unpivot import to_long
from gridspark.session import scratch_path
from gridspark.sinks.snapshot import SnapshotStore
from gridspark.sources import gridfile as G
from gridspark.sources.catalogue import HeaderCatalogue

KEY = ["path", "length", "modified", "measure", "coord_y", "coord_x", "r", "y0", "ny"]
_RANGES = ", ".join(f"{c}_lo double, {c}_hi double" for c in "yxv")
STATS = f"path string, length long, modified long, measure string, coord_y string, coord_x string, r int, y0 int, ny int, {_RANGES}"


@dataclass(frozen=True)
class Wanted:
    """Closed ranges of the y and x coordinates and of the value; None leaves a side open."""

    y: tuple[float | None, float | None] = (None, None)
    x: tuple[float | None, float | None] = (None, None)
    value: tuple[float | None, float | None] = (None, None)

    def overlaps(self) -> F.Column:
        """Whether a block's ranges can hold a wanted cell; unknown ranges can."""
        keep = F.lit(True)
        for column, (lo, hi) in (("y", self.y), ("x", self.x), ("v", self.value)):
            if lo is not None:
                keep = keep & F.coalesce(F.col(f"{column}_hi") >= lo, F.lit(True))
            if hi is not None:
                keep = keep & F.coalesce(F.col(f"{column}_lo") <= hi, F.lit(True))
        return keep

    def cells(self) -> F.Column:
        """Whether a long row is wanted; missing values (NaN) are not, once values are asked for."""
        keep = F.lit(True)
        for column, (lo, hi) in (("y_coord", self.y), ("x_coord", self.x), ("measure_value", self.value)):
            if lo is not None:
                keep = keep & (F.col(column) >= lo) & ~F.isnan(column)
            if hi is not None:
                keep = keep & (F.col(column) <= hi)
        return keep


def _span(x: np.ndarray) -> tuple[float | None, float | None]:
    x = x[~np.isnan(x)]
    return (float(x.min()), float(x.max())) if len(x) else (None, None)


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in STATS.split(", ")]
    files = G._Files()
    try:
        for batch in batches:
            out = {n: [] for n in names}
            for p in batch.to_pylist():
                _, yc, xc, vals = G._read_block(files, p, False)
                row = dict(zip(names[9:], (*_span(yc), *_span(xc), *_span(vals)), strict=True))
                for n in names:
                    out[n].append(row[n] if n in row else p[n])
            kinds = [pa.string()] + [pa.int64()] * 2 + [pa.string()] * 3 + [pa.int32()] * 3 + [pa.float64()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(out[n], k) for n, k in zip(names, kinds, strict=True)], names=names)
    finally:
        files.close()


class BlockStats:
    """Block statistics under ``root``, beside a header ``catalogue``."""

    def __init__(self, spark: SparkSession, root: str, catalogue: HeaderCatalogue):
        self.spark, self.catalogue = spark, catalogue
        self.store = SnapshotStore(spark, root)
        self.planned = self.read = 0  # blocks of the last search

    def known(self) -> DataFrame:
        if not self.store.manifests():
            return self.spark.createDataFrame([], STATS)
        return self.store.read("blocks").drop("batch_id").dropDuplicates(KEY)

    def _plan(self, requests: DataFrame, block_bytes: int) -> tuple[DataFrame, DataFrame | None]:
        """The written slab plan with each file's length and modification time, and the shared axes."""
        plan, axes = G.prepared(requests, block_bytes, catalogue=self.catalogue)
        stats = self.catalogue.stats(requests)
        return G.materialize_plan(plan.join(stats, "path")), axes

    def update(self, requests: DataFrame, block_bytes: int = G.DEFAULT_BLOCK_BYTES) -> int:
        """Read the blocks that have no statistics as their files are now; how many that were."""
        plan, _ = self._plan(requests, block_bytes)
        new = plan.filter("error IS NULL").dropDuplicates(KEY).join(self.known().select(*KEY), KEY, "left_anti")
        path = scratch_path(self.spark, "block-stats")
        G.spread_plan(G.materialize_plan(new)).mapInArrow(_measured, STATS).write.parquet(path)
        rows = self.spark.read.schema(STATS).parquet(path)
        n = rows.count()
        batch = max([m["batch_id"] for m in self.store.manifests()], default=-1) + 1
        while n and not self.store.write(batch, {"blocks": rows}):
            batch += 1
        return n

    def search(self, requests: DataFrame, wanted: Wanted, block_bytes: int = G.DEFAULT_BLOCK_BYTES) -> DataFrame:
        """The long rows of ``requests`` that are ``wanted``; ``planned`` and ``read`` say how many blocks there were and
        how many had to be read."""
        plan, axes = self._plan(requests, block_bytes)
        held = plan.join(self.known(), KEY, "left")
        left = G.materialize_plan(held.filter(F.col("error").isNotNull() | wanted.overlaps()).select(*plan.columns))
        self.planned, self.read = plan.count(), left.count()
        slabs = G.good_slabs(G.read_slabs(G.spread_plan(left), fail_fast=True, axes=axes))
        return to_long(slabs).filter(wanted.cells())
