"""Text and number functions (F5-F13), all as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F



def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def float_text_double(c: Column | str) -> Column:
    """F10 then F9: number -> its JVM text -> double.

    For a FLOAT column this keeps the value as printed (``101325.1f`` becomes the double
    ``101325.1``, not the widened ``101325.1015625``); for integers and doubles it equals a
    plain cast.
    """
    return _c(c).cast("string").cast("double")


def widened(c: Column | str) -> Column:
    """The value at float32 precision, widened exactly to double (for float-level compares)."""
    return _c(c).cast("float").cast("double")


def basename(path: Column | str) -> Column:
    """last path component."""
    return F.substring_index(_c(path), "/", -1)


def split_fields(text: Column | str, sep: str = ",") -> Column:
    """F5."""
    return F.split(_c(text), sep)


def to_int(text: Column | str, strict: bool = True) -> Column:
    """F8: text -> INT. ``strict`` follows ANSI (bad text fails the query, as in the
    reference); otherwise bad text becomes NULL for a rejects path."""
    c = F.trim(_c(text))
    return c.cast("int") if strict else c.try_cast("int")


def to_double(text: Column | str, strict: bool = True) -> Column:
    """text -> DOUBLE, accepting NaN and Infinity."""
    c = F.trim(_c(text))
    return c.cast("double") if strict else c.try_cast("double")


def join_fields(*cols: Column, sep: str = ",") -> Column:
    """fields -> one text row (numbers rendered by the JVM text rule)."""
    return F.concat_ws(sep, *[c.cast("string") for c in cols])


def parse_param_string(text: Column | str, with_file: bool = False, strict: bool = True) -> Column:
    """``"measure,coordY,coordX,limit"`` (or with a leading file path) -> struct.

    Struct fields: [path,] measure, coord_y, coord_x, r_limit.
    """
    parts = split_fields(text)
    off = 1 if with_file else 0
    fields = []
    if with_file:
        fields.append(parts.getItem(0).alias("path"))
    fields += [
        parts.getItem(off).alias("measure"),
        parts.getItem(off + 1).alias("coord_y"),
        parts.getItem(off + 2).alias("coord_x"),
        to_int(parts.getItem(off + 3), strict).alias("r_limit"),
    ]
    return F.struct(*fields)


def decode_long_row(text: Column | str, strict: bool = True) -> list[Column]:
    """a seven-field text row ``file,y,x,time,forecast,measure,value`` -> typed columns
    named as the long table (time and forecast labelled by their content)."""
    parts = split_fields(text)
    dbl = (lambda i: to_double(parts.getItem(i), strict))
    return [
        parts.getItem(0).alias("file_name"),
        dbl(1).alias("y_coord"),
        dbl(2).alias("x_coord"),
        dbl(4).alias("forecast"),
        dbl(3).alias("time"),
        parts.getItem(5).alias("measure_name"),
        dbl(6).alias("measure_value"),
    ]


def encode_long_row(prefix: str = "") -> Column:
    """F6 over the long table's columns, in the reference's row order
    (file, y, x, time, forecast, measure, value)."""
    p = prefix
    return join_fields(
        F.col(p + "file_name"),
        F.col(p + "y_coord"),
        F.col(p + "x_coord"),
        F.col(p + "time"),
        F.col(p + "forecast"),
        F.col(p + "measure_name"),
        F.col(p + "measure_value"),
    )


