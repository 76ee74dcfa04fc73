"""Integer-key high-water mark: filters, the batch interval and the control log.

The mark is a *batch* high-water mark on ``order_id`` (not an event-time
watermark). The control table cannot be updated in place on plain parquet,
so it is an append-only log ``(file_name, last_watermark, updated_at, seq, epoch)``;
the current mark of a file is its row with the largest ``seq``. Advancing
writes the rows of all files in ONE append, which makes the move atomic. The
epoch says which partitions the mark speaks of: a forced reload is served from
the append on that names its epoch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import job_label
from ..sinks.store import Lakehouse
from ..sources.schemas import WATERMARK

CONTROL_LAYER, CONTROL_TABLE = "control", "watermark"


def newer_than(df: DataFrame, key: str, mark: int) -> DataFrame:
    """Rows strictly above the mark (``key > mark``; NULL keys are not new)."""
    return df.filter(F.col(key) > F.lit(mark))


def within(df: DataFrame, key: str, lo: int | None, hi: int) -> DataFrame:
    """The batch interval ``lo < key <= hi``.

    With ``lo=None`` (initial load) there is no lower bound and NULL keys are
    kept so that the quality gate still sees and reports them.
    """
    upper: Column = F.col(key) <= F.lit(hi)
    if lo is None:
        return df.filter(F.coalesce(upper, F.lit(True)))
    return df.filter((F.col(key) > F.lit(lo)) & upper)


def high_water_frame(df: DataFrame, key: str, where: Column | None = None,
                     name: str = "high_water") -> DataFrame:
    """One row: ``max(key)`` (over rows matching ``where``); NULL when empty."""
    c = F.col(key) if where is None else F.when(where, F.col(key))
    return df.agg(F.max(c).alias(name))


def high_water(df: DataFrame, key: str, where: Column | None = None) -> int | None:
    """``max(key)`` collected to the driver (a scalar)."""
    return high_water_frame(df, key, where).first()[0]


def guard_frame(df: DataFrame, key: str, mark: int, hi_where: Column | None = None,
                new_where: Column | None = None, extra: list[Column] | None = None) -> DataFrame:
    """One aggregate over the raw rows deciding a run.

    ``new_rows`` = rows with ``key > mark`` (matching ``new_where``), ``current_max`` =
    ``max(key)``, ``batch_hi`` = largest key among rows matching ``hi_where`` (the
    rows that will move the mark). No new rows means ``NO_NEW_DATA``. ``extra``
    aggregates ride along in the same pass.
    """
    hi = F.col(key) if hi_where is None else F.when(hi_where, F.col(key))
    new = F.col(key) > F.lit(mark)
    return df.agg(
        F.count_if(new if new_where is None else new & new_where).alias("new_rows"),
        F.max(key).alias("current_max"),
        F.max(hi).alias("batch_hi"),
        *(extra or []),
    )


class WatermarkLog:
    """The control table as an append-only log."""

    def __init__(self, store: Lakehouse):
        self.store = store
        self.spark = store.spark

    def _log(self) -> DataFrame:
        return self.store.read(CONTROL_LAYER, CONTROL_TABLE, schema=WATERMARK,
                               partitioned=False)

    def table(self) -> DataFrame:
        """Current control rows ``(file_name, last_watermark, updated_at)``."""
        latest = F.max_by(F.struct("last_watermark", "updated_at"), "seq")
        return (self._log().groupBy("file_name").agg(latest.alias("m"))
                .select("file_name", "m.last_watermark", "m.updated_at"))

    def history(self) -> DataFrame:
        """Every control row ever written, with its ``seq`` (1 = first advance)."""
        return self._log()

    def current(self, file_name: str) -> tuple[int, int]:
        """(epoch, mark) of a file; (0, 0) while nothing was loaded."""
        if not self.store.exists(CONTROL_LAYER, CONTROL_TABLE):
            return 0, 0
        with job_label(self.spark, "read mark"):
            row = (self._log().filter(F.col("file_name") == F.lit(file_name))
                   .agg(F.max_by(F.struct("epoch", "last_watermark"), "seq").alias("m")).first())
        m = row["m"]
        return (0, 0) if m is None else (int(m["epoch"] or 0), int(m["last_watermark"] or 0))

    def get(self, file_name: str, default: int = 0) -> int:
        """Current mark of a file; a missing row means nothing was loaded yet."""
        return self.current(file_name)[1] or default

    def advance(self, file_names: list[str], value: int, epoch: int | None = None) -> None:
        """Set the mark of every file in one append (all or nothing); the epoch stays
        unless one is given."""
        # next seq as a scalar subquery of the same job (single writer assumed)
        seq = self._log().agg((F.coalesce(F.max("seq"), F.lit(0)) + 1).alias("s")).scalar()
        same = self._log().agg(F.coalesce(F.max("epoch"), F.lit(0)).alias("e")).scalar()
        rows = F.array(*[F.struct(F.lit(f).alias("file_name"),
                                  F.lit(int(value)).cast("bigint").alias("last_watermark"))
                         for f in file_names])
        with job_label(self.spark, "advance mark"):
            (self.spark.range(1).select(F.inline(rows))
             .select("file_name", "last_watermark",
                     F.current_timestamp().alias("updated_at"),
                     seq.cast("bigint").alias("seq"),
                     (same if epoch is None else F.lit(int(epoch))).cast("bigint").alias("epoch"))
             .coalesce(1).write.format(self.store.fmt).mode("append")
             .save(self.store.path(CONTROL_LAYER, CONTROL_TABLE)))

    def reset(self, file_names: list[str], value: int = 0) -> None:
        """Move the mark back (e.g. before reloading an emptied Bronze)."""
        self.advance(file_names, value)
