"""Rows of a source that a loaded history lacks, without joining all of both.

Nearly all rows have arrived, so most of a plain anti-join's shuffle proves nothing. Here
each side is first summed up by group (for lines: by order): the number of rows and two
independent 64-bit hashes of the keys, added up. The sums are partial aggregates, so a
group of any size leaves each task as one row. Groups with equal summaries hold the
same keys; only the rest, found by one join of summaries, are compared row by row, and
both sides are cut down to those groups before that join. Two summaries of different
keys agree with a probability of 2**-128 a group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def summaries(df: DataFrame, group: str, key: str, prefix: str) -> DataFrame:
    """One row a group: rows and two sums of hashes. Sums are decimal, so they can't overflow."""
    def total(*salt):
        return F.sum(F.xxhash64(group, key, *salt).cast("decimal(20,0)"))
    return df.groupBy(F.col(group).alias(group)).agg(
        F.struct(F.count("*").alias("n"), total().alias("a"), total(F.lit(1)).alias("b")).alias(prefix))


def doubtful_groups(rows: DataFrame, history: DataFrame, group: str, key: str) -> DataFrame:
    """The groups of ``rows`` whose keys are not exactly those that ``history`` holds of them."""
    mine, theirs = summaries(rows, group, key, "_mine"), summaries(history, group, key, "_theirs")
    both = mine.join(theirs, group, "left")
    return both.filter(~F.col("_mine").eqNullSafe(F.col("_theirs"))).select(group)


def missing_rows(rows: DataFrame, history: DataFrame, group: str, key: str) -> DataFrame:
    """The rows whose (group, key) is not in ``history``; rows with a NULL group or key are never found
    there. Repeated rows are all returned."""
    doubtful = doubtful_groups(rows, history, group, key)
    left = rows.join(doubtful, group, "left_semi")
    right = history.select(group, key).join(doubtful, group, "left_semi")
    unknown = rows.filter(F.col(group).isNull())
    return left.join(right, [group, key], "left_anti").select(*rows.columns).unionByName(unknown)
