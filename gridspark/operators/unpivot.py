"""Slab -> long-row operators.

Input is a ``grid_slabs`` DataFrame (``gridspark.schema.SLAB_SCHEMA``): one row per
(file, measure, realization, level, y line) holding the x line as an array. The unpivot
is a ``posexplode`` generator, which stays in whole-stage codegen and needs no shuffle,
so it scales with the number of slab rows however they are partitioned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.functions.text import float_text_double


def realization_slab(slabs: DataFrame, r: int) -> DataFrame:
    """The ``[r, :, :]`` slab of the leading axis."""
    return slabs.filter(F.col("r") == F.lit(r))


def first_level(slabs: DataFrame) -> DataFrame:
    """Rank reduction of a 4-D measure to ``[r, 0, :, :]`` (3-D slabs have level 0)."""
    return slabs.filter(F.col("level") == F.lit(0))


def within_limit(r_limit: Column | str) -> Column:
    """L1 predicate: the first ``r_limit`` realizations; a negative limit keeps all."""
    lim = F.col(r_limit) if isinstance(r_limit, str) else r_limit
    return (lim < 0) | (F.col("r") < lim)


def doubles(slabs: DataFrame) -> Column:
    """The value line of measures that are not float32 (``dvals``), NULL without one."""
    return F.col("dvals") if "dvals" in slabs.columns else F.lit(None).cast("array<double>")


def converted_lines(slabs: DataFrame, *extra: str) -> DataFrame:
    """Per-line work done once, before any fan-out: the float text rule on the y
    coordinate, the x axis and the values (doubles need none), and the integer times (an
    int64 prints and parses back to the same double a plain cast gives)."""
    return slabs.select(
        *extra,
        "file_name",
        "measure_name",
        "r",
        "level",
        "y",
        "y_len",
        float_text_double("y_coord").alias("y_coord"),
        F.transform("x_coords", float_text_double).alias("x_coords"),
        F.col("time").cast("double").alias("time"),
        F.col("forecast").cast("double").alias("forecast"),
        F.coalesce(doubles(slabs), F.transform("vals", float_text_double)).alias("vals"),
    )


def explode_cells(slabs: DataFrame, *extra: str) -> DataFrame:
    """One row per (y, x) cell with its coordinates and file scalars.

    Values keep the type they have in the line; the coordinate is taken by array position and is NULL when the x axis is shorter than
    the value line.
    """
    cells = slabs.select(
        *extra,
        "file_name",
        "measure_name",
        "r",
        "level",
        "y",
        "y_len",
        "y_coord",
        "x_coords",
        "time",
        "forecast",
        F.posexplode("vals").alias("x", "v"),
    )
    return cells.withColumn("x_coord", F.get(F.col("x_coords"), F.col("x"))).drop("x_coords")


def long_columns(prefix_cols: tuple[str, ...] = ()) -> list[Column]:
    """The long table's seven columns from exploded ``converted_lines`` cells."""
    return [
        *[F.col(c) for c in prefix_cols],
        F.col("file_name"),
        F.col("y_coord"),
        F.col("x_coord"),
        F.col("forecast"),
        F.col("time"),
        F.col("measure_name"),
        F.col("v").alias("measure_value"),
    ]


def to_long(slabs: DataFrame, *extra: str) -> DataFrame:
    """``grid_slabs`` -> ``grid_long`` (file_name, y_coord, x_coord, forecast,
    time, measure_name, measure_value). ``extra`` slab columns are carried in front."""
    return long_cells(converted_lines(slabs, *extra), *extra)


def long_cells(lines: DataFrame, *extra: str) -> DataFrame:
    """``grid_long`` rows of ``converted_lines``."""
    return explode_cells(lines, *extra).select(*long_columns(extra))


def to_long_indexed(slabs: DataFrame) -> DataFrame:
    """The long table plus ``r``, ``y``, ``x`` and the running number ``cnt``.

    ``cnt`` is arithmetic on the slab position, so no window or ordering is needed.
    """
    lines = converted_lines(slabs).withColumn("x_len", F.size("vals").cast("long"))
    cells = explode_cells(lines, "x_len")
    return cells.select(
        *long_columns(),
        F.col("r"),
        F.col("y"),
        F.col("x"),
        ((F.col("r").cast("long") * F.col("y_len") + F.col("y")) * F.col("x_len") + F.col("x")).alias("cnt"),
    )


def to_wide(long_df: DataFrame, measure: str) -> DataFrame:
    """One measure as its own column, every value as text, the way the JSON
    writer of the reference labels a cell: y_coord, x_coord, time, forecast, <measure>."""
    return long_df.filter(F.col("measure_name") == F.lit(measure)).select(
        F.col("y_coord").cast("float").cast("string").alias("y_coord"),
        F.col("x_coord").cast("float").cast("string").alias("x_coord"),
        F.col("time").cast("long").cast("string").alias("time"),
        F.col("forecast").cast("long").cast("string").alias("forecast"),
        F.col("measure_value").cast("float").cast("string").alias(measure),
    )


def wide_from_slabs(slabs: DataFrame, measure: str) -> DataFrame:
    """P15 straight from slabs: avoids the text -> double -> text detour of ``to_wide``."""
    lines = slabs.filter(F.col("measure_name") == F.lit(measure))
    text = F.coalesce(F.transform(doubles(lines), lambda v: v.cast("string")), F.transform("vals", lambda v: v.cast("string")))
    cells = explode_cells(lines.withColumn("vals", text))
    return cells.select(
        F.col("y_coord").cast("string").alias("y_coord"),
        F.col("x_coord").cast("string").alias("x_coord"),
        F.col("time").cast("string").alias("time"),
        F.col("forecast").cast("string").alias("forecast"),
        F.col("v").alias(measure),
    )


def cell_json(wide_df: DataFrame, measure: str) -> DataFrame:
    """each wide cell as one JSON object text (all values strings)."""
    cols = ["y_coord", "x_coord", "time", "forecast", measure]
    return wide_df.select(F.to_json(F.struct(*cols)).alias("value"))


def cell_count(slabs: DataFrame, by: tuple[str, ...] = ("file_name",)) -> DataFrame:
    """A1 per group without unpivoting: the long table has ``size(vals)`` rows per slab.

    A partial (map-side) sum, so a file holding most of the cells is still combined on
    every mapper before the shuffle.
    """
    return slabs.groupBy(*by).agg(F.sum(F.size(F.coalesce("vals", doubles(slabs).cast("array<float>"))).cast("long")).alias("n_rows"))
