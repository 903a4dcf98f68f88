"""Small frames with the awkward cases every operator has to take."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])

PROSE = ("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega "
         "one two three four five six seven eight nine ten eleven twelve").split()


def prose(seed: int, n: int) -> str:
    out, x = [], seed * 7919 + 13
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(PROSE[x // 7 % len(PROSE)] + str(x // 1000 % 50))
    return " ".join(out)


def docs(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, source)."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, DOCS)


def awkward(spark):
    """Null ids and texts, empty and wordless texts, repeats of a row, ties, one long text."""
    long = prose(3, 6000)
    return docs(spark, [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (6, prose(1, 60)), (7, prose(1, 60)), (7, prose(1, 60)),
        (None, prose(1, 60)), (None, None), (8, long), (9, "é ß 漢字 😀 " * 30), (10, "x" * 5000), (11, "word " * 500)])


def with_clashes(df):
    """Extra columns whose names operators use themselves."""
    names = ["id", "key", "score", "tag", "part", "component", "kept", "at", "n", "runs", "spans", "found", "block", "host", "rep", "label", "bands"]
    return df.select("*", *[F.lit("x").alias(n) for n in names])


def empty(spark):
    return docs(spark, []).filter("1 = 0")
