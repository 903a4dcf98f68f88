"""Chat formatting after cumulative-snapshot collapse.

Logged conversations are often snapshots of one another: the same turns, then more. Each
turn gets the rolling hash of all turns up to it; a conversation whose whole hash is another
one's hash at the same length is a prefix of it and is dropped by an anti-join. What
remains is rendered.

A conversation may hold a large share of all rows, under whatever turn numbers, so none is
gathered in one group: the distinct turns are sorted over all rows into ranges, each turn's
position is its place in its range plus the turns of the conversation in the ranges before, and the
hashes, which combine associatively (xor of position-bound hashes), are carried from range
to range the same way. Text is rendered by blocks of ``BLOCK`` positions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridspark.llm.common import fresh

# Turns in one block; a rendered part covers one block.
BLOCK = 256


def _turns(turns: DataFrame) -> DataFrame:
    """Turns with nulls as empty strings and a 128-bit text hash."""
    return turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).select(
        "*", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit("second"), "text").alias("t2"))


TURN = ["conv_id", "turn", "role", "t1", "t2"]


def positions(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, t1, t2, range, pos of each distinct turn: the range of the sorted
    rows it lies in and its position in its conversation. No text is kept."""
    rows = _turns(turns).select(*TURN).distinct().repartitionByRange(*TURN).sortWithinPartitions(*TURN)
    rows = fresh(rows.withColumn("at", F.monotonically_increasing_id()), "turns")
    rows = rows.select(*TURN, F.shiftright("at", 33).alias("range"), F.col("at").bitwiseAND(F.lit((1 << 33) - 1)).alias("place"))
    # a conversation's turns lie together in a range
    each = rows.groupBy("conv_id", "range").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    each = each.select(F.col("conv_id").alias("of"), F.col("range").alias("in"),
                       (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first") + 1).alias("shift"))
    rows = rows.join(each, rows["conv_id"].eqNullSafe(each["of"]) & (rows["range"] == each["in"]))
    return rows.select(*TURN, "range", (F.col("place") + F.col("shift")).alias("pos"))


def prefix_hashes(placed: DataFrame) -> DataFrame:
    """conv_id, pos, h1, h2: for each turn of ``positions`` its position in the conversation and
    the 128-bit hash of the turns up to it. Rows are a few numbers each; no text is moved."""
    rows = placed.select("conv_id", "range", "pos", F.xxhash64("pos", "role", "t1", "t2").alias("o1"),
                         F.xxhash64("t2", "t1", "pos", "role").alias("o2"))
    sums = rows.groupBy("conv_id", "range").agg(F.bit_xor("o1").alias("s1"), F.bit_xor("o2").alias("s2"))
    before = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("conv_id").alias("of"), F.col("range").alias("in"), F.coalesce(F.bit_xor("s1").over(before), F.lit(0)).alias("c1"),
                       F.coalesce(F.bit_xor("s2").over(before), F.lit(0)).alias("c2"))
    rows = rows.join(sums, rows["conv_id"].eqNullSafe(sums["of"]) & (rows["range"] == sums["in"]))
    inside = Window.partitionBy("conv_id", "range").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    return rows.select("conv_id", "pos", F.bit_xor("o1").over(inside).bitwiseXOR(F.col("c1")).alias("h1"),
                       F.bit_xor("o2").over(inside).bitwiseXOR(F.col("c2")).alias("h2"))


def maximal(hashes: DataFrame) -> DataFrame:
    """conv_id, n_turns of the conversations that are no prefix of another one; of equal
    ones the smallest conv_id (null last)."""
    last = hashes.groupBy("conv_id").agg(F.max(F.struct("pos", "h1", "h2")).alias("z")).select("conv_id", "z.*")
    whole = last.groupBy("pos", "h1", "h2").agg(F.min("conv_id").alias("conv_id"))
    n = last.select(F.col("conv_id").alias("of"), F.col("pos").alias("n"))
    on = [hashes["conv_id"].eqNullSafe(n["of"]), hashes["pos"] < n["n"]]
    inner = hashes.join(n, on).groupBy("pos", "h1", "h2").agg(F.count(F.lit(1)).alias("times"))  # equal prefixes meet as one row
    return whole.join(inner, ["pos", "h1", "h2"], "left_anti").select("conv_id", F.col("pos").alias("n_turns"))


def render(turns: DataFrame) -> DataFrame:
    """conv_id, part, n_turns, chat of every maximal conversation of ``turns`` (conv_id,
    turn, role, text; other columns are ignored).

    Turns are ordered by turn (null first), then role, then a hash of the text; exact repeats of a row are
    one turn; null roles and texts are empty. The rows without a conv_id are one conversation. A
    turn is rendered ``<|role|>\\ntext<|end|>\\n``; a part holds ``BLOCK``
    consecutive turns, so ordinary conversations have one part, number 0, and the parts of a very long
    one concatenate to the whole.
    """
    placed = fresh(positions(turns), "positions")
    keep = fresh(maximal(fresh(prefix_hashes(placed), "prefixes")), "maximal").withColumnRenamed("conv_id", "of")
    kept = placed.join(keep, placed["conv_id"].eqNullSafe(keep["of"]))
    kept = kept.select(*[F.col(c).alias(f"of {c}") for c in TURN], "pos", "n_turns", F.floor((F.col("pos") - 1) / BLOCK).cast("long").alias("part"))
    rows = _turns(turns)
    rows = rows.join(keep.select("of"), rows["conv_id"].eqNullSafe(keep["of"]), "left_semi").distinct()
    same = [rows[c].eqNullSafe(kept[f"of {c}"]) if c in ("conv_id", "turn") else rows[c] == kept[f"of {c}"] for c in TURN]
    line = F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"), F.col("text"), F.lit("<|end|>\n"))
    parts = rows.join(kept, same).groupBy("conv_id", "n_turns", "part").agg(
        F.sort_array(F.collect_list(F.struct("pos", line.alias("t")))).alias("l"))
    return parts.select("conv_id", "part", "n_turns", F.array_join(F.transform("l", lambda x: x["t"]), "").alias("chat"))


ORACLE = """
WITH t AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
  FROM (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations)),
c AS (
  SELECT conv_id, count(*) AS n_turns, list({'r': role, 't': text} ORDER BY pos) AS turns FROM t GROUP BY conv_id),
prefixes AS (SELECT DISTINCT c.turns[1:p.k] AS turns FROM c, (SELECT DISTINCT pos AS k FROM t) p WHERE p.k < c.n_turns),
whole AS (SELECT turns, min(conv_id) AS conv_id, any_value(n_turns) AS n_turns FROM c GROUP BY turns),
parts AS (SELECT *, unnest(range(0, (n_turns + 255) // 256)) AS part FROM whole w
          WHERE NOT EXISTS (SELECT 1 FROM prefixes p WHERE p.turns = w.turns))
SELECT conv_id, part, n_turns, array_to_string(list_transform(turns[part * 256 + 1:(part + 1) * 256],
       lambda x: '<|' || x.r || '|>' || chr(10) || x.t || '<|end|>' || chr(10)), '') AS chat
FROM parts
"""
