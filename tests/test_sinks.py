"""Sinks (S8-S11, L5)."""

import glob
import os

from pyspark.sql import functions as F

from gridspark.sinks.writers import jdbc_table_ddl, preview, read_long_json, write_json


def long_df(spark, n):
    return spark.range(n).select(
        F.lit("f.nc").alias("file_name"), F.col("id").cast("double").alias("y_coord"),
        F.lit(0.0).alias("x_coord"), F.lit(1.0).alias("forecast"), F.lit(2.0).alias("time"),
        F.lit("m").alias("measure_name"), (F.col("id") / 3).alias("measure_value")).coalesce(1)


def test_json_roll_and_count(spark, scratch):
    path = scratch.replace("file:", "")
    n = write_json(long_df(spark, 250), path, max_records_per_file=100)
    assert n == 250
    sizes = sorted(sum(1 for _ in open(f)) for f in glob.glob(os.path.join(path, "*.json")))
    assert sizes == [50, 100, 100]
    back = read_long_json(spark, path)
    assert back.count() == 250 and back.schema["measure_value"].dataType.typeName() == "double"
    assert back.agg(F.sum("measure_value")).first()[0] == long_df(spark, 250).agg(F.sum("measure_value")).first()[0]


def test_preview(spark):
    assert preview(long_df(spark, 50)).count() == 20


def test_jdbc_ddl_names_time_and_forecast():
    ddl = jdbc_table_ddl()
    assert "forecast DOUBLE" in ddl and "time DOUBLE" in ddl and ddl.index("forecast") < ddl.index("time ")
