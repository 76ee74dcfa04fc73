"""Spark helpers shared by the operators: tables, scratch tables, numbering."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import fresh_dir, job_label
from .text import slices, text_buffers

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, everything else left as it is."""
    return F.translate(c, UPPER, LOWER)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared work folder: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = fresh_dir(spark, label)
    with job_label(spark, label):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete the files of a table made by :func:`written` that nothing reads any more."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def numbered(df: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    """Add ``name``: gapless numbers from 0 within ``keys``.

    ``df`` must be a written table with the column ``_pid``, the id of the
    partition that wrote the row. Rows are numbered within (_pid, keys), a
    group no larger than one input split, and shifted by the counts of the
    partitions before. So no task holds a whole key, however many rows it has.
    """
    counts = df.groupBy("_pid", *keys).agg(F.count("*").alias("_n"))
    before = (Window.partitionBy(*keys).orderBy("_pid")
              .rowsBetween(Window.unboundedPreceding, -1))
    shift = counts.select("_pid", *keys,
                          F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    local = Window.partitionBy("_pid", *keys).orderBy(*order)
    return (df.withColumn("_rank", F.row_number().over(local) - 1)
            .join(shift, ["_pid", *keys])
            .withColumn(name, (F.col("_rank") + F.col("_shift")).cast("long"))
            .drop("_pid", "_rank", "_shift"))


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str, per_class: int,
                    held_out: bool = True, also: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, text, label, *also) of at most ``per_class`` labelled documents of each class.

    The choice is by a hash of doc_id, so it is the same on every run.
    ``held_out`` leaves out the rows whose crc32(doc_id as text) mod 5 is 0.
    """
    rows = labels.select("doc_id", F.col(target).cast("int").alias("label")).dropna()
    if held_out:
        rows = rows.filter(~in_held_out(F.col("doc_id")))
    chosen = None
    for value in (0, 1):
        some = (rows.filter(F.col("label") == value).dropDuplicates(["doc_id"])
                .orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class))
        chosen = some if chosen is None else chosen.unionByName(some)
    # at most 2 * per_class rows of two numbers: safe to broadcast
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *also)
    return (texts.join(F.broadcast(chosen), "doc_id")
            .select("doc_id", "text", "label", *also).limit(4 * per_class))


def with_text_score(docs: DataFrame, make_scorer, name: str, lower: bool = False) -> DataFrame:
    """``docs`` with the double column ``name``; ``make_scorer()`` gives a function
    from (bytes, offsets) of a slice of (lower-cased) texts to one score for each text."""
    def run(batches):
        score = make_scorer()
        for batch in batches:
            buf, off = text_buffers(batch.column("text"), lower)
            out = [np.zeros(0)]
            for i, j in slices(off):
                out.append(score(buf[off[i]:off[j]], off[i:j + 1] - off[i]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(out))],
                                             names=[*batch.schema.names, name])
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def in_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))
