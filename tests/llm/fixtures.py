"""Small awkward tables for the training-data operators."""

from pyspark.sql import functions as F

LONG = " ".join(f"word{k % 977} and{k % 31}" for k in range(60_000))
BASE = " ".join(f"tok{k}" for k in range(120))
NEAR = BASE.replace("tok7 ", "other ")
TEXTS = [
    (1, BASE), (2, BASE), (3, NEAR), (3, NEAR), (4, None), (5, ""), (6, " \n\t "), (7, LONG), (None, BASE), (None, None),
    (8, "a b"), (9, "A  b"), (10, "é ü ß 漢字 😀\x00 end"), (11, "\n".join(["Same line ", "other"] * 3)),
    *((20 + k, f"  SAME line\nbody {k} {k * k}\n\nshared passage") for k in range(12)),
]


def awkward(spark):
    """Null ids and texts, empty and very long texts, repeated rows, columns whose names operators use."""
    rows = spark.createDataFrame(TEXTS, "doc_id long, text string")
    return rows.select("doc_id", "text", F.lit("x").alias("label"), F.lit(1).alias("key"), F.lit(2).alias("n_lines"),
                       F.lit("s").alias("source"), F.lit(None).cast("string").alias("lang"), F.length("text").cast("long").alias("n_chars"))


def no_docs(spark):
    return awkward(spark).limit(0)


def labels_of(spark, quality=(), toxic=()):
    rows = [(k, q, None) for k, q in quality] + [(k, None, t) for k, t in toxic]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
