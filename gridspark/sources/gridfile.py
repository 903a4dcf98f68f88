"""Grid file scan (S4-S7, P6, P7, UD1, UD4) as Spark jobs.

The unit of work is a slab block, not a file: a file of any size is split into
(realization, y-block) reads of about ``block_bytes`` each and spread over the cluster.

1. ``resolve`` (``mapInArrow``, one small ranged header read per request): finds the
   measure, its coordinate axes and scalar times, checks shapes, and computes how many
   realizations (L1) and y blocks to read. Requests are first spread over the cluster:
   the pass waits for stores, so its width follows the opens, not the bytes of the rows.
2. The slab plan is built with ``sequence`` + ``explode``: one row per
   (request, realization, y block). It is tiny, so it is written to the shared folder
   (a lost executor never re-reads headers) and sized: it is dealt in ranges of (path,
   realization, y), so a task opens few files, over as many read tasks as
   ``spark.sql.files.maxPartitionBytes`` of slab data calls for. It carries the variables'
   places in the file, so the reads that follow do not read headers again.
3. ``read`` (``mapInArrow``) reads each block with one ranged read and emits
   ``grid_slabs`` rows as Arrow batches, vectorized with NumPy; the unpivot that follows
   is a native ``posexplode``.

Requests whose file is missing, damaged or unlike them yield one row with ``error`` set and
no data (the reference prints the exception and keeps going); ``fail_fast`` raises
instead. Any other failure (a store that does not answer) always raises, so that Spark
tries the task again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridspark.functions.text import basename
from gridspark.schema import SLAB_SCHEMA, VAR_FORECAST_TIME, VAR_TIME
from gridspark.session import scratch_path, size_in_bytes
from gridspark.sources import netcdf as nc

if TYPE_CHECKING:
    from gridspark.sources.catalogue import HeaderCatalogue

# What marks a request as unreadable; other errors are left to Spark's retries.
UNREADABLE = (nc.FormatError, FileNotFoundError, IsADirectoryError)

REQUEST_COLUMNS = ("path", "file_name", "measure", "coord_y", "coord_x", "r_limit")
DEFAULT_BLOCK_BYTES = 16 << 20

RESOLVED_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("measure", T.StringType()),
        T.StructField("coord_y", T.StringType()),
        T.StructField("coord_x", T.StringType()),
        T.StructField("r_count", T.IntegerType()),
        T.StructField("y_len", T.IntegerType()),
        T.StructField("x_len", T.IntegerType()),
        T.StructField("itemsize", T.IntegerType()),
        T.StructField("rows_per_block", T.IntegerType()),
        T.StructField("time", T.LongType()),
        T.StructField("forecast", T.LongType()),
        T.StructField("layout", T.StringType()),
        T.StructField("x_axis", T.LongType()),
        T.StructField("x_coords", T.ArrayType(T.FloatType())),
        T.StructField("error", T.StringType()),
    ]
)

# ``vals`` holds float32 measures, ``dvals`` (as doubles) those of other types.
# ``part`` numbers the copies of a block planned more than once (hot files, see
# ``plans.ingest``); it is 0 otherwise.
SCAN_SCHEMA = T.StructType(
    SLAB_SCHEMA.fields + [T.StructField("dvals", T.ArrayType(T.DoubleType(), True), True),
                          T.StructField("part", T.IntegerType(), True), T.StructField("error", T.StringType(), True)]
)

SCAN_COLUMNS = tuple(f.name for f in SCAN_SCHEMA.fields)
# What the block reader emits: lines with their axis, or with the digest of it.
READ_SCHEMA = T.StructType([*SCAN_SCHEMA.fields, T.StructField("x_axis", T.LongType(), True)])

DESCRIBE_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("dims", T.ArrayType(T.StringType())),
        T.StructField("shape", T.ArrayType(T.LongType())),
        T.StructField("is_record", T.BooleanType()),
        T.StructField("error", T.StringType()),
    ]
)


# --- listing and requests -----------------------------------------------------------------
def list_files(spark, location: str, glob: str = "*.nc", recursive: bool = True) -> DataFrame:
    """File listing through Spark's file systems; the content column is never read."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.load(location).select("path", "length", F.col("modificationTime").alias("modification_time"))


def requests_for_files(files: DataFrame, measure: str, coord_y: str, coord_x: str, r_limit: int = -1) -> DataFrame:
    """The same extraction parameters for every listed file; the output file name
    is the base name of the path."""
    return files.select(
        "path",
        basename("path").alias("file_name"),
        F.lit(measure).alias("measure"),
        F.lit(coord_y).alias("coord_y"),
        F.lit(coord_x).alias("coord_x"),
        F.lit(r_limit).cast("int").alias("r_limit"),
    )


# --- header pass ---------------------------------------------------------------------------
class _Files:
    """Per-task cache of open files and decoded headers."""

    def __init__(self, limit: int = 16):
        self.limit, self.open = limit, {}

    def get(self, path: str, layout: str | None = None):
        """The open file, its header (from ``layout`` when the header pass left one, so the
        file's own is not read again) and a cache for its axes."""
        key = (path, layout)
        hit = self.open.pop(key, None)
        if hit is None:
            reader = nc.open_reader(path)
            hit = (reader, nc.Header.from_layout(layout) if layout else nc.read_header(reader), {})
            if len(self.open) >= self.limit:
                old = next(iter(self.open))
                self.open.pop(old)[0].close()
        self.open[key] = hit
        return hit

    def close(self):
        for r, _, _ in self.open.values():
            r.close()
        self.open.clear()


def _scalar(reader, h, name: str) -> int:
    v = h.find(name)
    if v is None:
        raise nc.FormatError(f"variable {name!r} not found")
    if h.shape(v):
        raise nc.FormatError(f"variable {name!r} has shape {h.shape(v)}; a scalar is expected")
    value = nc.read_all(reader, h, v).reshape(-1)[0]
    if value != int(value):
        raise nc.FormatError(f"variable {name!r} is {value}; whole seconds are expected")
    return int(value)


def axis_digest(axis: np.ndarray) -> int:
    """A 64-bit name for an axis, from its values."""
    return int.from_bytes(hashlib.blake2b(np.ascontiguousarray(axis, np.float32).tobytes(), digest_size=8).digest(), "big", signed=True)


def resolve_one(reader, h, measure: str, coord_y: str, coord_x: str, r_limit: int, block_bytes: int) -> dict:
    """P6/P7/L1 for one request: shape checks and the read extent."""
    v = h.find(measure)
    if v is None:
        raise nc.FormatError(f"measure {measure!r} not found")
    if v.nc_type == 2:
        raise nc.FormatError(f"measure {measure!r} is text")
    if {"scale_factor", "add_offset"} & set(v.attrs):
        raise nc.FormatError(f"measure {measure!r} is packed (scale_factor, add_offset)")
    dims, shape = h.dim_names(v), h.shape(v)
    if len(shape) not in (3, 4):
        raise nc.FormatError(f"measure {measure!r} has rank {len(shape)}; 3 or 4 expected")
    if dims[-2].lower() != coord_y.lower() or dims[-1].lower() != coord_x.lower():
        raise nc.FormatError(f"measure dims {dims} do not end with ({coord_y}, {coord_x})")
    y_len, x_len = shape[-2], shape[-1]
    for cname, n in ((coord_y, y_len), (coord_x, x_len)):
        cv = h.find(cname)
        if cv is None:
            raise nc.FormatError(f"coordinate {cname!r} not found")
        if h.shape(cv) != [n]:
            raise nc.FormatError(f"coordinate {cname!r} has shape {h.shape(cv)}, {n} expected")
    r_len = shape[0]
    r_count = r_len if r_limit is None or r_limit < 0 else min(r_limit, r_len)
    if r_count > 0 and y_len > 0 and x_len > 0:
        # the last cell needed: a file cut short is found out here, not while reading
        nc.read_run(reader, h, v, [r_count - 1, *([0] if len(shape) == 4 else []), y_len - 1, x_len - 1], 1)
    line = max(1, x_len * v.dtype.itemsize)
    axis = nc.read_all(reader, h, h.find(coord_x)).astype(np.float32)
    return dict(
        r_count=r_count,
        y_len=y_len,
        x_len=x_len,
        itemsize=v.dtype.itemsize,
        rows_per_block=max(1, min(y_len, block_bytes // line)) if y_len else 1,
        time=_scalar(reader, h, VAR_TIME),
        forecast=_scalar(reader, h, VAR_FORECAST_TIME),
        layout=h.layout([measure, coord_y, coord_x]),
        x_axis=axis_digest(axis),
        x_coords=axis,
        error=None,
    )


def _resolver(block_bytes: int, fail_fast: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = _Files()
        names = [f.name for f in RESOLVED_SCHEMA.fields]
        try:
            for batch in batches:
                cols = {n: batch.column(n).to_pylist() for n in REQUEST_COLUMNS}
                out = {n: [] for n in names}
                for i in range(batch.num_rows):
                    req = {n: cols[n][i] for n in REQUEST_COLUMNS}
                    try:
                        reader, h, _ = files.get(req["path"])
                        res = resolve_one(reader, h, req["measure"], req["coord_y"], req["coord_x"],
                                          req["r_limit"], block_bytes)
                    except UNREADABLE as e:  # reported per request
                        if fail_fast:
                            raise
                        res = dict(error=f"{type(e).__name__}: {e}")
                    for n in names:
                        out[n].append(req.get(n) if n in req else res.get(n))
                yield pa.RecordBatch.from_pydict(out, schema=_arrow(RESOLVED_SCHEMA))
        finally:
            files.close()

    return run


def resolve(requests: DataFrame, block_bytes: int = DEFAULT_BLOCK_BYTES, fail_fast: bool = False) -> DataFrame:
    # By path: each file's header is read by one task, once; more partitions than cores,
    # as a task mostly waits for the store.
    tasks = 4 * requests.sparkSession.sparkContext.defaultParallelism
    reqs = requests.select(*REQUEST_COLUMNS).repartition(tasks, "path").sortWithinPartitions("path")
    return reqs.mapInArrow(_resolver(block_bytes, fail_fast), RESOLVED_SCHEMA)


# --- plan --------------------------------------------------------------------------------------
def plan_slabs(resolved: DataFrame) -> DataFrame:
    """One row per (request, realization, y block), without the x axis; failed requests keep one row."""
    resolved = resolved.drop("x_coords")
    ok = resolved.filter(F.col("error").isNull())
    r_seq = F.when(F.col("r_count") > 0, F.sequence(F.lit(0), F.col("r_count") - 1)).otherwise(F.array().cast("array<int>"))
    n_blocks = F.expr("CAST((y_len + rows_per_block - 1) DIV rows_per_block AS INT)")
    b_seq = F.when(n_blocks > 0, F.sequence(F.lit(0), n_blocks - 1)).otherwise(F.array().cast("array<int>"))
    planned = (
        ok.select("*", F.explode(r_seq).alias("r"))
        .select("*", F.explode(b_seq).alias("block"))
        .withColumn("y0", F.col("block") * F.col("rows_per_block"))
        .withColumn("ny", F.least(F.col("rows_per_block"), F.col("y_len") - F.col("y0")))
        .drop("block")
    )
    failed = resolved.filter(F.col("error").isNotNull()).select(
        "*", F.lit(None).cast("int").alias("r"), F.lit(None).cast("int").alias("y0"), F.lit(None).cast("int").alias("ny")
    )
    return planned.unionByName(failed)


def materialize_plan(plan: DataFrame) -> DataFrame:
    """The plan written to the shared folder: a lost executor never re-reads headers, and
    the plan can be measured and adjusted cheaply."""
    path = scratch_path(plan.sparkSession, "slab-plan")
    plan.write.parquet(path)
    return plan.sparkSession.read.schema(plan.schema).parquet(path)


def spread_plan(plan: DataFrame, target_task_bytes: int | None = None) -> DataFrame:
    """Deal a materialized plan in ranges over enough tasks for ``target_task_bytes`` of
    slab data each (default ``spark.sql.files.maxPartitionBytes``)."""
    spark = plan.sparkSession
    target = target_task_bytes or size_in_bytes(spark.conf.get("spark.sql.files.maxPartitionBytes", "128m"))
    stats = plan.agg(
        F.sum(F.coalesce(F.col("ny").cast("long") * F.col("x_len") * F.col("itemsize"), F.lit(0))).alias("bytes"),
        F.count(F.lit(1)).alias("rows"),
    ).first()
    rows = stats["rows"] or 0
    tasks = max(1, min(rows, -(-(stats["bytes"] or 0) // target)))
    tasks = max(tasks, min(rows, spark.sparkContext.defaultParallelism))
    # Ranges of (path, realization, y): a task opens few files, and a large file's blocks
    # are split among several tasks.
    keys = ["path", "r", "y0", *(["part"] if "part" in plan.columns else [])]
    return plan.repartitionByRange(tasks, *keys).sortWithinPartitions(*keys)


def sized(plan: DataFrame, target_task_bytes: int | None = None) -> DataFrame:
    """Write the plan to the shared folder and deal it over enough tasks for
    ``target_task_bytes`` of slab data each."""
    return spread_plan(materialize_plan(plan), target_task_bytes)


# --- slab reads --------------------------------------------------------------------------------
def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


class _Batch:
    """Slab rows of many blocks gathered as NumPy pieces, turned into one Arrow batch."""

    def __init__(self, schema: pa.Schema):
        self.schema = schema
        self.reset()

    def reset(self):
        self.names, self.measures, self.line_counts = [], [], []
        self.num = {k: [] for k in ("r", "y", "y_len", "y_coord", "time", "forecast", "part")}
        self.x_coords, self.vals, self.x_lens, self.wide = [], [], [], []
        self.axes, self.shared = [], []
        self.cells = 0

    def add(self, p: dict, y: np.ndarray, yc: np.ndarray, xc: np.ndarray | None, vals: np.ndarray) -> None:
        """The lines of one block; without ``xc`` they carry the digest of their x axis only."""
        n = len(y)
        self.names.append(p["file_name"])
        self.measures.append(p["measure"])
        self.line_counts.append(n)
        for k, v in (("r", p["r"]), ("y_len", p["y_len"]), ("time", p["time"]), ("forecast", p["forecast"]),
                     ("part", p.get("part") or 0)):
            self.num[k].append(np.full(n, v))
        self.num["y"].append(y)
        self.num["y_coord"].append(yc)
        self.shared.append(np.full(n, xc is None))
        self.axes.append(np.full(n, p["x_axis"] if xc is None else 0, dtype=np.int64))
        self.x_coords.append(np.zeros(0, np.float32) if xc is None else np.tile(xc, n))
        self.vals.append(vals)
        self.wide.append(np.full(n, vals.dtype != np.float32))
        self.x_lens.append(np.full(n, vals.size // n if n else 0, dtype=np.int64))
        self.cells += vals.size

    def build(self) -> pa.RecordBatch | None:
        if not self.line_counts:
            return None
        counts = np.asarray(self.line_counts)
        cat = lambda k, t: np.concatenate(self.num[k]).astype(t)
        wide = np.concatenate(self.wide)
        x_lens = np.concatenate(self.x_lens)

        def lines(of_wide: bool, kind) -> pa.Array:
            """The value lines of one kind; the other kind's lines are null."""
            mine = wide == of_wide
            ends = np.cumsum(np.where(mine, x_lens, 0))
            pieces = [v for v in self.vals if (v.dtype != np.float32) == of_wide]
            flat = pa.array(np.concatenate(pieces) if pieces else np.zeros(0), kind)
            return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)).astype(np.int32)), flat, mask=pa.array(~mine))

        shared = np.concatenate(self.shared)
        offsets = pa.array(np.concatenate([[0], np.cumsum(np.where(shared, 0, x_lens))]).astype(np.int32))
        rows = int(counts.sum())
        arrays = [
            pa.DictionaryArray.from_arrays(np.repeat(np.arange(len(counts), dtype=np.int32), counts),
                                           pa.array(self.names, pa.string())).cast(pa.string()),
            pa.DictionaryArray.from_arrays(np.repeat(np.arange(len(counts), dtype=np.int32), counts),
                                           pa.array(self.measures, pa.string())).cast(pa.string()),
            pa.array(cat("r", np.int32)),
            pa.array(np.zeros(rows, dtype=np.int32)),
            pa.array(cat("y", np.int32)),
            pa.array(cat("y_len", np.int32)),
            pa.array(cat("y_coord", np.float32)),
            pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(self.x_coords), pa.float32()), mask=pa.array(shared)),
            pa.array(cat("time", np.int64)),
            pa.array(cat("forecast", np.int64)),
            lines(False, pa.float32()),
            lines(True, pa.float64()),
            pa.array(cat("part", np.int32)),
            pa.nulls(rows, pa.string()),
            pa.array(np.concatenate(self.axes), mask=~shared),
        ]
        batch = pa.RecordBatch.from_arrays(arrays, schema=self.schema)
        self.reset()
        return batch


def _reader(fail_fast: bool, batch_cells: int, shared: bool):
    names = [f.name for f in READ_SCHEMA.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _arrow(READ_SCHEMA)
        files = _Files()
        acc = _Batch(schema)

        def error_row(p, msg):
            row = {n: [None] for n in names}
            row.update(file_name=[p["file_name"]], measure_name=[p["measure"]], r=[p["r"]], error=[msg])
            return pa.RecordBatch.from_pydict(row, schema=schema)

        try:
            for batch in batches:
                cols = batch.to_pydict()
                for i in range(batch.num_rows):
                    p = {k: v[i] for k, v in cols.items()}
                    if p["error"] is not None:
                        yield error_row(p, p["error"])
                        continue
                    try:
                        acc.add(p, *_read_block(files, p, shared))
                    except UNREADABLE as e:  # reported per block
                        if fail_fast:
                            raise
                        yield error_row(p, f"{type(e).__name__}: {e}")
                    if acc.cells >= batch_cells or len(acc.line_counts) >= 4096:
                        yield acc.build()
            last = acc.build()
            if last is not None:
                yield last
        finally:
            files.close()

    return run


def _read_block(files: _Files, p: dict, shared: bool):
    """One ranged read of a (realization, y block) slab plus its coordinates:
    returns y indices, y coordinates, the x axis (None when it is ``shared``) and the values (row-major,
    float32, or float64 for measures of other types)."""
    reader, h, cache = files.get(p["path"], p["layout"])
    return _block(reader, h, cache, p["measure"], p["coord_y"], None if shared else p["coord_x"], p["r"], p["y0"], p["ny"], p["x_len"])


def _block(reader, h, cache: dict, measure: str, coord_y: str, coord_x: str | None, r: int, y0: int, ny: int, x_len: int):
    v = h.find(measure)
    key = ("x", coord_x)
    if key not in cache:
        cache[key] = None if coord_x is None else nc.read_all(reader, h, h.find(coord_x)).astype(np.float32)
    xc = cache[key]
    yc = nc.read_run(reader, h, h.find(coord_y), [y0], ny).astype(np.float32)
    index = [r, y0, 0] if len(v.dim_ids) == 3 else [r, 0, y0, 0]
    vals = nc.read_run(reader, h, v, index, ny * x_len)
    vals = vals.astype(np.float32 if v.type_name == "float" else np.float64, copy=False)
    return np.arange(y0, y0 + ny, dtype=np.int32), yc, xc, vals


def shared_axes(resolved: DataFrame) -> DataFrame | None:
    """The distinct x axes (a_axis, axis) of written ``resolve`` rows; None when they are beyond the session's broadcast
    bound, as measured."""
    held = resolved.filter(F.col("x_axis").isNotNull()).groupBy(F.col("x_axis").alias("a_axis")).agg(F.first("x_coords").alias("axis"))
    limit = size_in_bytes(resolved.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10m"))
    size = held.agg(F.sum(F.size("axis").cast("long") * 4 + 64).alias("bytes")).first()["bytes"]
    return held if (size or 0) <= limit else None


def prepared(requests: DataFrame, block_bytes: int = DEFAULT_BLOCK_BYTES, fail_fast: bool = False,
             catalogue: HeaderCatalogue | None = None) -> tuple[DataFrame, DataFrame | None]:
    """The slab plan of ``requests`` and its shared axes. The header pass's result, one row for each request, is
    written; the plan's rows, one for each block, come from it. A ``catalogue`` opens only files it does not know."""
    resolved = materialize_plan(resolve(requests, block_bytes, fail_fast) if catalogue is None else catalogue.resolve(requests, block_bytes))
    return plan_slabs(resolved), shared_axes(resolved)


def read_slabs(plan: DataFrame, fail_fast: bool = False, batch_cells: int = 1 << 20, axes: DataFrame | None = None) -> DataFrame:
    """The slab rows of a plan. With ``axes`` (``shared_axes``) x axes are not read again and not repeated: lines carry
    their axis's digest, and the distinct axes, broadcast, are put back afterwards. Without, each line
    carries its axis."""
    lines = plan.mapInArrow(_reader(fail_fast, batch_cells, axes is not None), READ_SCHEMA)
    if axes is None:
        return lines.select(*SCAN_COLUMNS)
    back = [F.col("axis").alias("x_coords") if c == "x_coords" else F.col(c) for c in SCAN_COLUMNS]
    return lines.join(F.broadcast(axes), lines["x_axis"] == axes["a_axis"], "left").select(*back)


def scan_grid(
    requests: DataFrame,
    block_bytes: int = DEFAULT_BLOCK_BYTES,
    target_task_bytes: int | None = None,
    fail_fast: bool = False,
    catalogue: HeaderCatalogue | None = None,
) -> DataFrame:
    """Requests (path, file_name, measure, coord_y, coord_x, r_limit) ->
    ``grid_slabs`` rows plus ``error`` (NULL on good rows)."""
    plan, axes = prepared(requests, block_bytes, fail_fast, catalogue)
    return read_slabs(spread_plan(plan, target_task_bytes), fail_fast, axes=axes)


def _content_reader(measure: str, coord_y: str, coord_x: str, r_limit: int, fail_fast: bool, batch_cells: int):
    names = [f.name for f in READ_SCHEMA.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _arrow(READ_SCHEMA)
        acc = _Batch(schema)
        for batch in batches:
            paths = batch.column("path").to_pylist()
            contents = batch.column("content")
            for i, path in enumerate(paths):
                file_name = path.rsplit("/", 1)[-1]
                try:
                    reader = nc.BytesReader(contents[i].as_buffer())
                    h = nc.read_header(reader)
                    res = resolve_one(reader, h, measure, coord_y, coord_x, r_limit, 1 << 62)
                    p = dict(file_name=file_name, measure=measure, y_len=res["y_len"], time=res["time"],
                             forecast=res["forecast"])
                    cache: dict = {}
                    for r in range(res["r_count"]):
                        p["r"] = r
                        acc.add(p, *_block(reader, h, cache, measure, coord_y, coord_x, r, 0, res["y_len"],
                                           res["x_len"]))
                        if acc.cells >= batch_cells:
                            yield acc.build()
                except UNREADABLE as e:  # reported per file
                    if fail_fast:
                        raise
                    row = {n: [None] for n in names}
                    row.update(file_name=[file_name], measure_name=[measure], error=[f"{type(e).__name__}: {e}"])
                    yield pa.RecordBatch.from_pydict(row, schema=schema)
        last = acc.build()
        if last is not None:
            yield last

    return run


def scan_contents(binary: DataFrame, measure: str, coord_y: str, coord_x: str, r_limit: int = -1,
                  fail_fast: bool = False, batch_cells: int = 1 << 20) -> DataFrame:
    """S4 content mode: files read whole through Spark's own file systems
    (``spark.read.format("binaryFile")``), one task per file.

    For stores the pyarrow file systems cannot open. A file is held in one task's memory
    (the binaryFile source caps it at ``spark.sql.sources.binaryFile.maxLength``), so
    the path mode of ``scan_grid``, which splits files into blocks, is the default for
    large files.
    """
    return binary.select("path", "content").mapInArrow(
        _content_reader(measure, coord_y, coord_x, r_limit, fail_fast, batch_cells), READ_SCHEMA).select(*SCAN_COLUMNS)


def good_slabs(scanned: DataFrame) -> DataFrame:
    return scanned.filter(F.col("error").isNull()).drop("error")


def scan_rejects(scanned: DataFrame) -> DataFrame:
    """UD4: one row per failed request or block: file_name, measure_name, r, error."""
    return scanned.filter(F.col("error").isNotNull()).select("file_name", "measure_name", "r", "error")


# --- metadata listing (S7) ------------------------------------------------------------------
def header_rows(h: nc.Header) -> Iterator[dict]:
    """The dimensions and variables of a header."""
    for i, (d, n) in enumerate(h.dims):
        yield dict(kind="dimension", name=d, shape=[h.numrecs if i == h.record_dim else n], is_record=i == h.record_dim)
    for v in h.variables.values():
        yield dict(kind="variable", name=v.name, type=v.type_name, dims=h.dim_names(v), shape=h.shape(v), is_record=h.is_record(v))


def _describer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = _arrow(DESCRIBE_SCHEMA)
    for batch in batches:
        rows = {f.name: [] for f in DESCRIBE_SCHEMA.fields}

        def add(**kw):
            for k in rows:
                rows[k].append(kw.get(k))

        for path in batch.column("path").to_pylist():
            try:
                reader = nc.open_reader(path)
                try:
                    h = nc.read_header(reader)
                finally:
                    reader.close()
                for row in header_rows(h):
                    add(path=path, **row)
            except UNREADABLE as e:  # reported per file
                add(path=path, kind="error", error=f"{type(e).__name__}: {e}")
        yield pa.RecordBatch.from_pydict(rows, schema=schema)


def describe_files(files: DataFrame) -> DataFrame:
    """Every dimension (name, length) and variable (type, dims, shape) of each file,
    from header-only reads."""
    return files.select("path").mapInArrow(_describer, DESCRIBE_SCHEMA)
