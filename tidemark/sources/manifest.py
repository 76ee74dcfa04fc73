"""Raw-file manifest (opt-in): skip raw files that cannot hold keys above the mark.

The raw contract is "re-read the file and keep keys above the mark". When
the raw zone grows by new files (append-style drops) that are never changed
once written, most files hold only keys at or below the mark and re-parsing
them every run is wasted work. After each successful run the manifest records,
per raw file read, its size, modification time, the mark the run started at
and ``bound`` = the largest key above that mark (NULL if none). A later run at
mark ``lo`` skips a file only if

* it is listed with the same size and modification time, and
* it was recorded at a mark ``<= lo`` (a mark reset re-reads everything), and
* ``bound`` is NULL or ``<= lo`` (no key of the file can be above ``lo``).

Everything else - new, changed or unrecorded files - is read. A file rewritten
with the same size and time would be missed, so the manifest is off unless the
drops are known to be write-once.

Listing, records and bounds are DataFrames. The files are those of Spark's own
folder scan (hidden files and folders left out), named as in
``_metadata.file_path``, so listing and bounds match by construction. Only the
paths of the files to be read reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST = T.StructType([
    T.StructField("file_name", T.StringType()),       # registered source, e.g. orders.csv
    T.StructField("path", T.StringType()),            # as in _metadata.file_path
    T.StructField("size", T.LongType()),
    T.StructField("mtime", T.LongType()),             # microseconds
    T.StructField("recorded_at", T.LongType()),       # mark the recording run started at
    T.StructField("bound", T.LongType()),             # largest key above that mark, or NULL
])
LAYER, TABLE = "control", "raw_files"


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, read_as, size, mtime) of the data files under a raw path (file or folder)."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("path").alias("read_as"),
                        F.col("length").alias("size"), F.unix_micros("modificationTime").alias("mtime"))


class RawManifest:
    def __init__(self, store):
        self.store = store
        self.spark = store.spark

    def entries(self, file_name: str) -> DataFrame:
        """Latest record per path of a source."""
        log = self.store.read(LAYER, TABLE, schema=MANIFEST, partitioned=False)
        return (log.filter(F.col("file_name") == F.lit(file_name)).groupBy("path")
                .agg(F.max_by(F.struct("size", "mtime", "recorded_at", "bound"), "recorded_at").alias("r"))
                .select("path", F.col("r.size").alias("known_size"), F.col("r.mtime").alias("known_mtime"),
                        "r.recorded_at", "r.bound"))

    def plan(self, file_name: str, path: str, lo: int) -> tuple[DataFrame, list[str], int]:
        """(listed files to read, their paths for the reader, number of files skipped)."""
        known = list_files(self.spark, path).join(self.entries(file_name), "path", "left")
        skip = ((F.col("size") == F.col("known_size")) & (F.col("mtime") == F.col("known_mtime"))
                & (F.col("recorded_at") <= F.lit(lo))
                & (F.col("bound").isNull() | (F.col("bound") <= F.lit(lo))))
        marked = known.withColumn("skip", F.coalesce(skip, F.lit(False)))
        r = marked.agg(F.count_if("skip").alias("skipped"),
                       F.sort_array(F.collect_list(F.when(~F.col("skip"), F.col("read_as")))).alias("paths")).first()
        return marked.filter(~F.col("skip")).select("path", "size", "mtime"), list(r["paths"]), int(r["skipped"])

    def record(self, file_name: str, lo: int, files: DataFrame, bounds: DataFrame) -> None:
        """Append one record per file read by a successful run. ``files`` is what
        :meth:`plan` listed before the scan, ``bounds`` (path, bound) the largest key
        above ``lo`` of each file."""
        (files.join(bounds, "path", "left")
         .select(F.lit(file_name).alias("file_name"), "path", "size", "mtime",
                 F.lit(int(lo)).cast("bigint").alias("recorded_at"), F.col("bound").cast("bigint").alias("bound"))
         .coalesce(1).write.format(self.store.fmt).mode("append").save(self.store.path(LAYER, TABLE)))
