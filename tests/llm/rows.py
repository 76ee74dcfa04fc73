"""Small tables with the awkward cases that every operator must take."""

import random

from pyspark.sql import types as T

SMALL = "/root/testdata/sf0.001"
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # columns that clash with names the operators use
    T.StructField("score", T.StringType()), T.StructField("shard", T.StringType()),
    T.StructField("h1", T.StringType()), T.StructField("band", T.StringType()),
    T.StructField("length", T.StringType()), T.StructField("crc", T.StringType()),
    T.StructField("label", T.StringType()), T.StructField("host", T.StringType())])


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnoprstuv") for _ in range(rng.randint(2, 8))) for _ in range(n))


def awkward_texts(seed=1):
    rng = random.Random(seed)
    base = [sentence(rng, 120) for _ in range(6)]
    shared = sentence(rng, 60)
    long = sentence(rng, 20000)
    near = base[0].split()
    near[50] = "changed"
    return [
        (1, base[0]), (2, base[0]), (3, " ".join(near)), (4, base[1] + " " + shared), (5, base[2] + " " + shared),
        (5, base[2] + " " + shared),                        # a repeated row
        (5, base[3]),                                       # the same doc_id, another text
        (6, None), (7, ""), (8, " \n\t "), (None, base[4]), (None, None), (9, long), (10, "one two"),
        (11, "é" * 70 + " ß∂ " + "日本語 " * 40), (12, long[:400] + base[5]), (13, "a" * 300), (14, "a" * 200),
        (15, "\n".join(["the same line again"] * 40)), (16, "é" * 70)]


def awkward_docs(spark, rows=None):
    rows = awkward_texts() if rows is None else rows
    return spark.createDataFrame(
        [(i, t, "en" if k % 2 else None, None, len(t or ""), *["x"] * 8) for k, (i, t) in enumerate(rows)], SCHEMA)
