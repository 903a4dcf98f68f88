"""Extract-and-load entry points in the reference's parameter-string form.

``"file,measure,coordY,coordX,limit"`` strings are parsed by Spark (F12) into read
requests; the files are scanned slab by slab, unpivoted, and handed to a writer. The
long rows are produced once: the writer's row count is observed during the write.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.functions.text import basename, parse_param_string
from gridspark.operators.unpivot import to_long, to_long_indexed, wide_from_slabs
from gridspark.sinks.writers import console, write_jdbc, write_json
from gridspark.sources.gridfile import DEFAULT_BLOCK_BYTES, good_slabs, scan_grid


def requests_from_strings(spark: SparkSession, file_parameters: Sequence[str] | DataFrame) -> DataFrame:
    """F12 + S5: one read request per ``"file,measure,coordY,coordX,limit"`` string. Long
    lists are given as a one-column DataFrame (e.g. of a text file) and stay in Spark."""
    if isinstance(file_parameters, DataFrame):
        text = file_parameters.toDF("p")
    else:
        text = spark.createDataFrame([(p,) for p in file_parameters], "p string")
    p = parse_param_string("p", with_file=True)
    return text.select(p.alias("q")).select(
        F.col("q.path").alias("path"),
        basename("q.path").alias("file_name"),
        F.col("q.measure").alias("measure"),
        F.col("q.coord_y").alias("coord_y"),
        F.col("q.coord_x").alias("coord_x"),
        F.col("q.r_limit").alias("r_limit"),
    )


def read_list(spark: SparkSession, file_parameters: Sequence[str] | DataFrame, block_bytes: int = DEFAULT_BLOCK_BYTES) -> DataFrame:
    """Long rows of all listed files in one scan (duplicates in the list are kept)."""
    return to_long(good_slabs(scan_grid(requests_from_strings(spark, file_parameters), block_bytes)))


def read_one(spark: SparkSession, path: str, measure: str, coordinates: str, r_limit: int = -1) -> DataFrame:
    """One file; ``coordinates`` is ``"coordY,coordX"``."""
    return read_list(spark, [f"{path},{measure},{coordinates},{r_limit}"])


def read_list_and_dump(
    spark: SparkSession,
    file_parameters: Sequence[str],
    write: Callable[[DataFrame], int],
    show: bool = False,
) -> int:
    """S5 + S8/S9 + S11: scan, optionally print schema and a preview, write; returns
    the number of rows written."""
    rows = read_list(spark, file_parameters)
    if show:
        console(rows)
    return write(rows)


def jdbc_writer(url: str, table: str, properties: dict | None = None, num_partitions: int = 8) -> Callable[[DataFrame], int]:
    """S8 as a writer for ``read_list_and_dump`` (the reference's demo uses 8)."""
    return lambda df: write_jdbc(df, url, table, properties, num_partitions)


def measure_to_json(spark: SparkSession, path: str, measure: str, coordinates: str, r_limit: int, out_dir: str,
                    max_records_per_file: int = 100_000) -> int:
    """S9 for one file: each cell as a JSON object of text values (y_coord, x_coord,
    time, forecast, <measure>), a new output file every ``max_records_per_file`` rows;
    returns the number of cells written."""
    slabs = good_slabs(scan_grid(requests_from_strings(spark, [f"{path},{measure},{coordinates},{r_limit}"])))
    return write_json(wide_from_slabs(slabs, measure), out_dir, max_records_per_file)


def measure_to_console(spark: SparkSession, path: str, measure: str, coordinates: str, r_limit: int,
                       n: int = 20) -> DataFrame:
    """S10 for one file: coordinates, times, ``[r, y, x, cnt]`` and the value of each cell,
    in read order; prints the first ``n`` and returns the rows."""
    slabs = good_slabs(scan_grid(requests_from_strings(spark, [f"{path},{measure},{coordinates},{r_limit}"])))
    rows = to_long_indexed(slabs)
    rows.orderBy("cnt").show(n, truncate=False)
    return rows
