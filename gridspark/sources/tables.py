"""Stand-in inputs built from the provided tables.

* ``orders_grid`` plays the gridded files: ``orders`` rows become the cells of
  (realization, y, x) grids, grouped into ``grid_slabs`` lines.
* ``notifications_from_events`` plays the queue: each ``events`` row becomes one
  file-arrival message body.

Both are ordinary DataFrame plans over the whole tables, so their work grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridspark.functions.messages import build_body

# Coordinate spacing of the stand-in grids (metres between grid points).
GRID_SPACING = 2000


def orders_cells(
    orders: DataFrame,
    realizations: int = 2,
    y_len: int = 25,
    x_len: int = 100,
    prefix: str = "g_",
    value: str = "o_totalprice",
) -> DataFrame:
    """One row per cell: file_name, file_no, r, y, x, v (FLOAT), t (epoch seconds).

    Cells are numbered by the dense, unique ``o_orderkey``: a file holds
    ``realizations * y_len * x_len`` consecutive keys in (r, y, x) order, so every file,
    line and group below is bounded by construction.
    """
    per_file = realizations * y_len * x_len
    per_r = y_len * x_len
    k = "o_orderkey"
    return orders.select(
        F.concat(F.lit(prefix), F.expr(f"{k} div {per_file}").cast("string"), F.lit(".nc")).alias("file_name"),
        F.expr(f"{k} div {per_file}").alias("file_no"),
        F.expr(f"({k} % {per_file}) div {per_r}").cast("int").alias("r"),
        F.expr(f"({k} % {per_r}) div {x_len}").cast("int").alias("y"),
        F.expr(f"{k} % {x_len}").cast("int").alias("x"),
        F.col(value).cast("float").alias("v"),
        F.unix_seconds(F.col("o_orderdate").cast("timestamp")).alias("t"),
    )


def orders_grid(
    orders: DataFrame,
    realizations: int = 2,
    y_len: int = 25,
    x_len: int = 100,
    prefix: str = "g_",
    value: str = "o_totalprice",
    measure: str | None = None,
    four_d: bool = False,
) -> DataFrame:
    """``grid_slabs`` from ``orders``.

    One shuffle: cells are hash-partitioned by file (a file holds at most
    ``realizations * y_len * x_len`` cells by construction, so no file can be a hot
    partition), and both the x-line aggregation and the per-file window for ``time``
    (latest order date) and ``forecast`` (earliest) reuse that partitioning. AQE sizes the
    partitions from the data. ``four_d``
    labels ``level = y % 2`` to stand in for a 4-D measure.
    """
    cells = orders_cells(orders, realizations, y_len, x_len, prefix, value).repartition("file_name")
    lines = cells.groupBy("file_name", "r", "y").agg(
        F.sort_array(F.collect_list(F.struct("x", "v"))).alias("xv"),
        F.min("t").alias("t_min"),
        F.max("t").alias("t_max"),
    )
    per_file = Window.partitionBy("file_name")
    return lines.select(
        "file_name",
        F.lit(measure or value).alias("measure_name"),
        "r",
        ((F.col("y") % 2) if four_d else F.lit(0)).cast("int").alias("level"),
        "y",
        F.lit(y_len).cast("int").alias("y_len"),
        (F.col("y") * GRID_SPACING).cast("float").alias("y_coord"),
        F.transform(
            F.sequence(F.lit(0), F.size("xv") - 1), lambda i: (i * GRID_SPACING).cast("float")
        ).alias("x_coords"),
        F.max("t_max").over(per_file).alias("time"),
        F.min("t_min").over(per_file).alias("forecast"),
        F.transform("xv", lambda s: s["v"]).alias("vals"),
    )


def notification_fields(events: DataFrame, per_key: int = 100, prefix: str = "g_", escape_names: bool = False):
    """The five message fields of one notification per event.

    ``key`` names the announced file: ``per_key`` consecutive events announce the same
    object (redeliveries and re-announcements). ``escape_names`` puts a backslash inside
    the name, which the JSON text then carries as an escaped pair.
    """
    iso = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    name = F.col("event_type")
    if escape_names:
        name = F.concat(F.substring(name, 1, 2), F.lit("\\"), F.substring(name, 3, 1 << 20))
    return [
        F.concat(F.lit("b"), F.col("user_id").cast("string")),
        name,
        F.concat(F.lit(prefix), F.expr(f"event_id div {per_key}").cast("string"), F.lit(".nc")),
        F.date_format("ts", iso),
        F.date_format(F.date_trunc("day", "ts"), iso),
    ]


def notifications_from_events(events: DataFrame, per_key: int = 100, prefix: str = "g_", escape_names: bool = False) -> DataFrame:
    """Message bodies (``body STRING``) as the queue would deliver them, one per event."""
    return events.select(build_body(*notification_fields(events, per_key, prefix, escape_names)).alias("body"))


def write_orders_grid_files(
    orders: DataFrame,
    out_dir: str,
    realizations: int = 2,
    y_len: int = 25,
    x_len: int = 100,
    prefix: str = "g_",
    value: str = "o_totalprice",
    measure: str | None = None,
    version: int = 5,
    four_d: bool = False,
    record_realization: bool = False,
    add: int | None = None,
) -> DataFrame:
    """Write the ``orders_grid`` stand-in as classic NetCDF files, one per grid file.

    A Spark job: cells are hash-partitioned by file and sorted within each partition
    (a file holds at most ``realizations * y_len * x_len`` cells), and one
    ``mapInArrow`` pass writes each file through the pyarrow file systems into
    ``out_dir/files``. The list of written files goes to the
    manifest table ``out_dir/manifest`` (path, file_name, n_cells), which is returned,
    so no file list passes through the driver. With ``add`` the measure is a double with
    that number added to every value. ``four_d`` adds a 2-long ``height`` axis
    whose level 1 holds the negated values.
    """
    import numpy as np
    import pyarrow as pa

    from gridspark.sources.ncwrite import grid_file_bytes
    from gridspark.sources.netcdf import _filesystem

    files_dir = f"{out_dir.rstrip('/')}/files"
    name = measure or value
    cells = orders_cells(orders, realizations, y_len, x_len, prefix, value)
    manifest_schema = pa.schema([("path", pa.string()), ("file_name", pa.string()), ("n_cells", pa.int64())])

    def write_one(file_name, r, y, x, v, t):
        r_n = int(r.max()) + 1
        y_n = y_len if r_n > 1 else int(y.max()) + 1
        x_n = x_len if (r_n > 1 or y_n > 1) else int(x.max()) + 1
        grid = np.full((r_n, y_n, x_n), np.nan, dtype=np.float32)
        grid[r, y, x] = v
        if add is not None:
            grid = grid.astype(np.float64) + add
        if four_d:
            grid = np.stack([grid, -grid], axis=1)
        data = grid_file_bytes(
            name,
            grid,
            np.arange(y_n, dtype=np.float32) * GRID_SPACING,
            np.arange(x_n, dtype=np.float32) * GRID_SPACING,
            int(t.max()),
            int(t.min()),
            version=version,
            record_realization=record_realization,
        )
        path = f"{files_dir}/{file_name}"
        fs, fpath = _filesystem(path)
        fs.create_dir(fpath.rsplit("/", 1)[0], recursive=True)
        with fs.open_output_stream(fpath) as out:
            out.write(data)
        return path, len(v)

    def write(batches):
        # Rows arrive sorted by file; a file's rows may span Arrow batches, so the open
        # group is carried over until the next file starts.
        cols = ("file_name", "r", "y", "x", "v", "t")
        pending = None
        for batch in batches:
            part = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in cols}
            if pending is not None:
                part = {c: np.concatenate([pending[c], part[c]]) for c in cols}
            names = part["file_name"]
            if len(names) == 0:
                continue
            starts = np.flatnonzero(np.r_[True, names[1:] != names[:-1]])
            ends = np.r_[starts[1:], len(names)]
            done = []
            for a, b in zip(starts[:-1], ends[:-1]):
                done.append((names[a],) + write_one(names[a], *(part[c][a:b] for c in cols[1:])))
            pending = {c: part[c][starts[-1]:] for c in cols}
            if done:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([d[1] for d in done]), pa.array([d[0] for d in done]),
                     pa.array([d[2] for d in done], pa.int64())], schema=manifest_schema)
        if pending is not None and len(pending["file_name"]):
            path, n = write_one(pending["file_name"][0], *(pending[c] for c in cols[1:]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([path]), pa.array([pending["file_name"][0]]), pa.array([n], pa.int64())],
                schema=manifest_schema)

    by_file = cells.repartition("file_no").sortWithinPartitions("file_no", "r", "y", "x")
    written = by_file.select("file_name", "r", "y", "x", "v", "t").mapInArrow(
        write, "path string, file_name string, n_cells long")
    manifest_dir = f"{out_dir.rstrip('/')}/manifest"
    written.write.mode("errorifexists").parquet(manifest_dir)
    return orders.sparkSession.read.parquet(manifest_dir)
