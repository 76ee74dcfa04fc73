"""Path-backed medallion layers on a shared file system.

Layout: ``<root>/<layer>/<table>/`` parquet folders (``format`` may be any
file source Spark has, e.g. ``delta`` when installed).

Transactional tables are partitioned by ``load_epoch`` (how often the history was
reloaded from scratch) and ``load_lo`` (the high-water mark a batch started at). A
batch owns exactly one partition, so

* a retry of a failed batch starts at the same mark and *replaces* its own
  partition (dynamic partition overwrite) - no duplicates after a failure;
* a batch is committed iff its epoch is the control log's and ``load_lo < current
  mark`` (the mark moves past ``load_lo`` only after every layer was written), so
  readers can hide a half-finished batch with a partition filter that prunes at
  planning time;
* a forced reload writes into the next epoch: readers keep the old one until the
  control log names the new, in the same append that sets its mark;
* reading "the new batch" is a partition read, not a scan of the table;
* a batch's files are sorted by their key, so that a filter on the key skips row groups
  (and pages) inside a batch too; the sort is local to each task, without a shuffle.

Row counts and largest keys of stored parquet tables come from the files' footers (the
data source's aggregate push-down): no row is read.

Reference tables are small full refreshes and are not partitioned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ..session import job_label
from ..sources.schemas import BATCH_COLUMN, EPOCH_COLUMN


class SchemaMismatchError(ValueError):
    """An append whose columns or types do not fit the target table."""


# Error conditions of a table that is not there yet.
_ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "DELTA_TABLE_NOT_FOUND", "DELTA_MISSING_DELTA_TABLE")


def _is_absent(error: AnalysisException) -> bool:
    """Whether the error says that a path or its data files are missing."""
    return (error.getCondition() or "").split(".")[0] in _ABSENT


# Widening casts an append may apply silently; anything else is rejected.
_SAFE_CASTS = {
    ("tinyint", "smallint"), ("tinyint", "int"), ("tinyint", "bigint"),
    ("smallint", "int"), ("smallint", "bigint"), ("int", "bigint"),
    ("tinyint", "double"), ("smallint", "double"), ("int", "double"), ("bigint", "double"),
    ("float", "double"), ("void", "int"), ("void", "bigint"), ("void", "double"),
    ("void", "string"),
}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Match an append to the table schema by column name.

    Missing or extra columns and narrowing/unsafe casts are refused; safe
    widenings (int -> bigint, int -> double, ...) are applied.
    """
    have = dict(df.dtypes)
    want = [(f.name, f.dataType.simpleString()) for f in schema.fields]
    extra = sorted(set(have) - {n for n, _ in want})
    missing = [n for n, _ in want if n not in have]
    if extra or missing:
        raise SchemaMismatchError(f"append does not match the table: missing {missing}, "
                                  f"extra {extra}")
    cols = []
    for name, t in want:
        got = have[name]
        if got == t:
            cols.append(F.col(f"`{name}`"))
        elif (got, t) in _SAFE_CASTS:
            cols.append(F.col(f"`{name}`").cast(t).alias(name))
        else:
            raise SchemaMismatchError(f"cannot safely cast {name} from {got} to {t}")
    return df.select(*cols)


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty frame of ``schema`` planned on the JVM (no Python worker)."""
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name)
                                   for f in schema.fields])


class Lakehouse:
    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.fmt = fmt

    # -- paths -----------------------------------------------------------------
    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        hpath = jvm.org.apache.hadoop.fs.Path(path)
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        return hpath.getFileSystem(conf), hpath

    def exists(self, layer: str, table: str) -> bool:
        fs, p = self._fs(self.path(layer, table))
        return bool(fs.exists(p))

    def batch_path(self, layer: str, table: str, load_lo: int, epoch: int = 0) -> str:
        return f"{self.path(layer, table)}/{EPOCH_COLUMN}={int(epoch)}/{BATCH_COLUMN}={int(load_lo)}"

    def _delete(self, path: str) -> None:
        fs, p = self._fs(path)
        if fs.exists(p):
            fs.delete(p, True)

    def drop_batch(self, layer: str, table: str, load_lo: int, epoch: int = 0) -> None:
        """Delete one batch partition (an empty retry must not leave stale rows)."""
        self._delete(self.batch_path(layer, table, load_lo, epoch))

    def drop_table(self, layer: str, table: str) -> None:
        self._delete(self.path(layer, table))

    def drop_epochs_before(self, layer: str, table: str, epoch: int) -> None:
        """Delete the partitions of epochs that a committed reload has replaced."""
        fs, root = self._fs(self.path(layer, table))
        if not fs.exists(root):
            return
        for status in fs.listStatus(root):
            name, _, value = status.getPath().getName().partition("=")
            if name == EPOCH_COLUMN and int(value) < epoch:
                fs.delete(status.getPath(), True)

    # -- writes ----------------------------------------------------------------
    @staticmethod
    def _batched(df: DataFrame, load_lo: int, epoch: int, sort_by: str | None = None) -> DataFrame:
        out = df.withColumns({EPOCH_COLUMN: F.lit(int(epoch)).cast("bigint"),
                              BATCH_COLUMN: F.lit(int(load_lo)).cast("bigint")})
        # led by the partition columns, as the writer asks for: it adds no sort of its own
        return out if sort_by is None else out.sortWithinPartitions(EPOCH_COLUMN, BATCH_COLUMN, sort_by)

    def replace(self, df: DataFrame, layer: str, table: str,
                load_lo: int | None = None, epoch: int = 0, sort_by: str | None = None) -> None:
        """Full refresh: data and schema are replaced.

        With ``load_lo`` the table is (re)created as a batch-partitioned table
        whose only partition is this load.
        """
        writer = df if load_lo is None else self._batched(df, load_lo, epoch, sort_by)
        w = (writer.write.format(self.fmt).mode("overwrite")
             .option("partitionOverwriteMode", "static")
             .option("overwriteSchema", "true"))
        if load_lo is not None:
            w = w.partitionBy(EPOCH_COLUMN, BATCH_COLUMN)
        with job_label(self.spark, f"replace {layer}.{table}"):
            w.save(self.path(layer, table))

    def table_schema(self, layer: str, table: str) -> T.StructType | None:
        """Stored schema without the batch column; None for a missing table."""
        if not self.exists(layer, table):
            return None
        try:
            stored = self.spark.read.format(self.fmt).load(self.path(layer, table)).schema
        except AnalysisException as e:      # folder without data files yet
            if not _is_absent(e):
                raise
            return None
        return T.StructType([f for f in stored.fields if f.name not in (EPOCH_COLUMN, BATCH_COLUMN)])

    def write_batch(self, df: DataFrame, layer: str, table: str, load_lo: int,
                    schema: T.StructType | None = None, epoch: int = 0, conformed: bool = True,
                    sort_by: str | None = None) -> None:
        """Retry-safe append: the batch replaces its own partition only.

        Columns are matched by name (see :func:`conform`) to ``schema``, the
        table's declared contract, or else to the stored table's schema;
        ``conformed=False`` lands them as they are (a reload brings its own schema).
        ``sort_by`` sorts each file.
        Parquet: the partition folder is removed first - an empty retry must
        not leave stale rows - then written by dynamic partition overwrite.
        Delta: one atomic ``replaceWhere`` overwrite of the partition.
        """
        if conformed:
            target = schema if schema is not None else self.table_schema(layer, table)
            if target is not None:
                df = conform(df, target)
        out = self._batched(df, load_lo, epoch, sort_by)
        with job_label(self.spark, f"write batch {layer}.{table}"):
            if self.fmt == "delta":
                (out.write.format("delta").mode("overwrite")
                 .option("replaceWhere", f"{EPOCH_COLUMN} = {int(epoch)} AND {BATCH_COLUMN} = {int(load_lo)}")
                 .partitionBy(EPOCH_COLUMN, BATCH_COLUMN).save(self.path(layer, table)))
                return
            self.drop_batch(layer, table, load_lo, epoch)
            (out.write.format(self.fmt).mode("overwrite")
             .option("partitionOverwriteMode", "dynamic")
             .partitionBy(EPOCH_COLUMN, BATCH_COLUMN)
             .save(self.path(layer, table)))

    # -- reads -----------------------------------------------------------------
    def read(self, layer: str, table: str, schema: T.StructType | None = None,
             batch: int | None = None, committed_below: int | None = None,
             partitioned: bool = True, epoch: int | None = None) -> DataFrame:
        """Scan a table; a missing table reads as empty (with ``schema``).

        ``epoch`` and ``batch`` select batch partitions, ``committed_below`` hides
        batches whose mark never advanced. All are partition filters. The
        partition columns themselves are not returned. Without ``schema``,
        types are those stored in the selected epoch (a reload may have brought others).
        """
        full, path = schema, self.path(layer, table)
        if schema is not None and self.fmt in ("parquet", "orc") and not self.exists(layer, table):
            return empty_frame(self.spark, schema)
        if schema is not None and partitioned:
            full = T.StructType(schema.fields + [T.StructField(EPOCH_COLUMN, T.LongType()),
                                                 T.StructField(BATCH_COLUMN, T.LongType())])
        reader = self.spark.read.format(self.fmt)
        if full is not None:
            reader = reader.schema(full)
        elif epoch is not None and self.fmt != "delta":
            reader, path = reader.option("basePath", path), f"{path}/{EPOCH_COLUMN}={int(epoch)}"
        try:
            df = reader.load(path)
        except AnalysisException as e:
            if schema is None or not _is_absent(e):
                raise
            return empty_frame(self.spark, schema)
        if BATCH_COLUMN in df.columns:
            if batch is not None:
                df = df.filter(F.col(BATCH_COLUMN) == F.lit(int(batch)))
            if epoch is not None:
                df = df.filter(F.col(EPOCH_COLUMN) == F.lit(int(epoch)))
            if committed_below is not None:
                df = df.filter(F.col(BATCH_COLUMN) < F.lit(int(committed_below)))
            df = df.drop(BATCH_COLUMN, EPOCH_COLUMN)
        return df

    def _rows(self, layer: str, table: str, epoch: int | None) -> DataFrame | None:
        if not self.exists(layer, table):
            return None
        df = self.spark.read.format(self.fmt).load(self.path(layer, table))
        return df if epoch is None else df.filter(F.col(EPOCH_COLUMN) == F.lit(int(epoch)))

    def is_empty(self, layer: str, table: str, epoch: int | None = None) -> bool:
        """True when the table (or its epoch) is missing or holds no row (reads at most one row)."""
        rows = self._rows(layer, table, epoch)
        return rows is None or rows.isEmpty()

    def footer_frame(self, layer: str, table: str, key: str | None = None, epoch: int | None = None,
                     committed_below: int | None = None) -> DataFrame:
        """One row (row_count, high_water): rows of a stored table and its largest ``key`` (NULL
        without one), of one epoch or of all. For parquet both are pushed down to the footers; the
        filters are on partition columns. The table must exist."""
        session = self.spark
        if self.fmt == "parquet":
            session = session.newSession()         # the caller's settings stay as they are
            session.conf.set("spark.sql.sources.useV1SourceList", "")
            session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
        df = session.read.format(self.fmt).load(self.path(layer, table))
        if epoch is not None:
            df = df.filter(F.col(EPOCH_COLUMN) == F.lit(int(epoch)))
        if committed_below is not None:
            df = df.filter(F.col(BATCH_COLUMN) < F.lit(int(committed_below)))
        batches = [c for c in (EPOCH_COLUMN, BATCH_COLUMN) if c in df.columns]
        top = [] if key is None else [F.max(key).alias("top")]
        each = df.groupBy(*batches).agg(F.count("*").alias("n"), *top)       # pushed down, a row a batch
        return each.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
                        F.max(F.lit(None).cast("long") if key is None else F.col("top")).alias("high_water"))

    def row_count(self, layer: str, table: str, epoch: int | None = None) -> int:
        """``SELECT COUNT(*)`` of a table (or of one epoch); 0 when it does not exist."""
        if not self.exists(layer, table):
            return 0
        return self.footer_frame(layer, table, epoch=epoch).first()["row_count"]
