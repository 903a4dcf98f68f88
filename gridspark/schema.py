"""Canonical schemas of the engine and the schema-string parser."""

from __future__ import annotations

from pyspark.sql import types as T

# The reference's output table schema string, and the names of
# the notification fields and the scalar time variables it reads.
REFERENCE_SCHEMA_STRING = (
    "file_name:string,y_coord:double,x_coord:double,forecast:double,"
    "time:double,measure_name:string,measure_value:double"
)
NOTIFICATION_FIELDS = ("bucket", "name", "key", "created_time", "forecast_reference_time")
VAR_TIME = "time"
VAR_FORECAST_TIME = "forecast_reference_time"

NOTIFICATION_SCHEMA = T.StructType(
    [T.StructField(f, T.StringType(), True) for f in NOTIFICATION_FIELDS]
)

PARAMS_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType(), False),
        T.StructField("measure", T.StringType(), False),
        T.StructField("coord_y", T.StringType(), False),
        T.StructField("coord_x", T.StringType(), False),
        T.StructField("r_limit", T.IntegerType(), False),
    ]
)

# One row per (file, measure, realization, level, y line); the x axis is an array.
SLAB_SCHEMA = T.StructType(
    [
        T.StructField("file_name", T.StringType(), True),
        T.StructField("measure_name", T.StringType(), True),
        T.StructField("r", T.IntegerType(), True),
        T.StructField("level", T.IntegerType(), True),
        T.StructField("y", T.IntegerType(), True),
        T.StructField("y_len", T.IntegerType(), True),
        T.StructField("y_coord", T.FloatType(), True),
        T.StructField("x_coords", T.ArrayType(T.FloatType(), True), True),
        T.StructField("time", T.LongType(), True),
        T.StructField("forecast", T.LongType(), True),
        T.StructField("vals", T.ArrayType(T.FloatType(), True), True),
    ]
)
SLAB_COLUMNS = tuple(f.name for f in SLAB_SCHEMA.fields)

# The long table, with time and forecast labelled by what they hold.
LONG_SCHEMA = T.StructType(
    [
        T.StructField("file_name", T.StringType(), True),
        T.StructField("y_coord", T.DoubleType(), True),
        T.StructField("x_coord", T.DoubleType(), True),
        T.StructField("forecast", T.DoubleType(), True),
        T.StructField("time", T.DoubleType(), True),
        T.StructField("measure_name", T.StringType(), True),
        T.StructField("measure_value", T.DoubleType(), True),
    ]
)
LONG_COLUMNS = tuple(f.name for f in LONG_SCHEMA.fields)

_TYPE_NAMES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "int": T.IntegerType(),
    "integer": T.IntegerType(),
    "bigint": T.LongType(),
    "long": T.LongType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
}


def parse_schema_string(text: str) -> T.StructType:
    """``"name:type,name:type"`` -> nullable StructType; type names match case-insensitively.

    Unknown type names raise instead of producing an unusable field.
    """
    fields = []
    for item in text.split(","):
        item = item.strip()
        if not item:
            continue
        name, sep, type_name = item.partition(":")
        if not sep:
            raise ValueError(f"schema item without a type: {item!r}")
        dtype = _TYPE_NAMES.get(type_name.strip().lower())
        if dtype is None:
            raise ValueError(f"unsupported type {type_name!r} for field {name!r}")
        fields.append(T.StructField(name.strip(), dtype, True))
    return T.StructType(fields)
