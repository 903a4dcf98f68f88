"""Notification message functions.

A message body is a JSON envelope whose ``Message`` field is itself JSON text holding the
five notification fields. Everything here is a built-in column expression, so parsing
runs inside whole-stage codegen and needs no Python on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridspark.schema import NOTIFICATION_FIELDS

CORRUPT = "_corrupt_message"

_PARSE_SCHEMA = T.StructType(
    [T.StructField(f, T.StringType(), True) for f in NOTIFICATION_FIELDS]
    + [T.StructField(CORRUPT, T.StringType(), True)]
)


def envelope_message(body: Column | str) -> Column:
    """the ``Message`` string of the outer envelope (NULL when absent or not JSON)."""
    return F.get_json_object(F.col(body) if isinstance(body, str) else body, "$.Message")


def strip_escapes(text: Column) -> Column:
    """remove every pair of consecutive backslashes from the message text."""
    return F.replace(text, F.lit("\\\\"), F.lit(""))


def parse_message(text: Column) -> Column:
    """message text -> struct of the five string fields plus the corrupt-record text."""
    return F.from_json(text, _PARSE_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})


def parse_notifications(df: DataFrame, body_col: str = "body", keep: tuple[str, ...] = ()) -> DataFrame:
    """Body text -> the five notification fields and ``reject_reason``.

    ``reject_reason`` is NULL for a usable message; otherwise it names the first problem
    (no envelope, malformed inner JSON, or the first missing field). The reference throws
    on any of these and loses the poll; here such rows are kept aside by ``accepted`` /
    ``rejected``. ``keep`` carries extra input columns through.

    The parse runs once per message: it is produced by a one-element ``inline``
    generator, so a later filter on the fields (``accepted``) stays above it. Without
    that, Catalyst pushes the filter below the projection and inlines ``from_json`` once
    per referenced field (about 6x slower, and too large for whole-stage codegen).
    """
    msg = envelope_message(body_col)
    stage = df.select(*[F.col(c) for c in keep], msg.alias("_m"))
    stage = stage.select(
        *[F.col(c) for c in keep],
        F.inline(F.array(F.struct(F.col("_m").alias("_m"), parse_message(strip_escapes(F.col("_m"))).alias("_j")))),
    )
    j = F.col("_j")
    missing = [F.when(j[f].isNull(), F.lit(f"missing field: {f}")) for f in NOTIFICATION_FIELDS]
    reason = F.coalesce(
        F.when(F.col("_m").isNull(), F.lit("no Message in envelope")),
        F.when(j.isNull() | j[CORRUPT].isNotNull(), F.lit("malformed Message")),
        *missing,
    )
    return stage.select(
        *[F.col(c) for c in keep],
        *[j[f].alias(f) for f in NOTIFICATION_FIELDS],
        reason.alias("reject_reason"),
    )


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject_reason").isNotNull())


def build_body(*fields: Column) -> Column:
    """F4 for messages: five field columns -> envelope text with the message JSON nested
    as a string (the shape the queue delivers)."""
    inner = F.to_json(F.struct(*[c.alias(n) for c, n in zip(fields, NOTIFICATION_FIELDS)]))
    return F.to_json(F.struct(inner.alias("Message")))
