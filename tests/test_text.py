"""Scalar functions (F5-F14) and the float text rule."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridspark.functions.text import (decode_long_row, encode_long_row, float_text_double, parse_param_string,
                                      to_int)
from gridspark.schema import REFERENCE_SCHEMA_STRING, parse_schema_string


def test_float_text_rule_keeps_printed_value(spark):
    vals = [101325.1, 414368.12, 1.0e7, 1.0e-4, 123456789.0, 0.1, -2.5]
    df = spark.createDataFrame([(v,) for v in vals], "v double").select(F.col("v").cast("float").alias("f"))
    got = [r[0] for r in df.select(float_text_double("f")).collect()]
    assert got[0] == 101325.1 and got[0] != float(np.float32(101325.1))
    assert got[1] == 414368.12
    assert got[2] == 1.0e7 and got[3] == 1.0e-4
    # always the same float32 as the input
    assert [np.float32(g) for g in got] == [np.float32(v) for v in vals]


def test_float_text_rule_nan_and_infinity(spark):
    df = spark.sql("SELECT CAST('NaN' AS FLOAT) a, CAST('Infinity' AS FLOAT) b")
    r = df.select(float_text_double("a").alias("a"), float_text_double("b").alias("b")).first()
    assert np.isnan(r["a"]) and r["b"] == float("inf")


def test_float_text_matches_shortest_repr_on_table_values(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").select(F.col("o_totalprice").cast("float").alias("f"))
    rows = df.select("f", float_text_double("f").alias("d")).collect()
    for r in rows:
        assert r["d"] == float(np.format_float_positional(np.float32(r["f"]), unique=True))


def test_schema_string():
    s = parse_schema_string(REFERENCE_SCHEMA_STRING)
    assert [f.name for f in s.fields][:4] == ["file_name", "y_coord", "x_coord", "forecast"]
    assert s["y_coord"].dataType.typeName() == "double" and all(f.nullable for f in s.fields)
    assert parse_schema_string("a:STRING, b:Double")["b"].dataType.typeName() == "double"
    with pytest.raises(ValueError):
        parse_schema_string("a:geometry")


def test_param_string(spark):
    df = spark.createDataFrame([("f.nc,m,y,x,-1",), ("f.nc,m,y,x,3",)], "t string")
    r = df.select(parse_param_string("t", with_file=True).alias("p")).select("p.*").collect()
    assert r[0]["path"] == "f.nc" and r[0]["r_limit"] == -1 and r[1]["r_limit"] == 3


def test_int_parse_strict_and_lenient(spark):
    df = spark.createDataFrame([("1x",)], "t string")
    assert df.select(to_int("t", strict=False)).first()[0] is None
    with pytest.raises(Exception):
        df.select(to_int("t", strict=True)).collect()


def test_row_text_round_trip(spark):
    df = spark.createDataFrame([("f.nc", 1.5, 2.0, 10.0, 20.0, "m", float("nan"))],
                               "file_name string, y_coord double, x_coord double, time double, forecast double, "
                               "measure_name string, measure_value double")
    text = df.select(encode_long_row().alias("t"))
    assert text.first()["t"] == "f.nc,1.5,2.0,10.0,20.0,m,NaN"
    back = text.select(*decode_long_row("t")).first()
    assert back["time"] == 10.0 and back["forecast"] == 20.0 and np.isnan(back["measure_value"])
