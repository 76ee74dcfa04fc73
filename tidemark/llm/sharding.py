"""Sharding by longest-processing-time scheduling.

Documents with equal texts form a group that stays together. Groups are given
out largest first, each to the shard with the least load (a heap). Only a
bounded number of items ever reaches the heap: the groups larger than
1/``exact`` of all bytes (at most ``exact`` of them) one by one, and the small
ones in bundles. Bundles come in three tiers, each a tenth of the tier above,
so the last ones given out even out the loads. The resulting maps are bounded
by the same parameters and broadcast; documents are never shuffled by shard.

Null and empty texts are one group of size 16 a row. Repeated rows stay
together. Empty tables give no rows. Only doc_id and text are read.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import numbered, table, written

OVERHEAD = 16
N_SHARDS = 40
EXACT = 8192
BUNDLES = 2048


def lpt(sizes: list[tuple[int, object]], n_shards: int) -> dict:
    """Item -> shard: largest first, each to the least loaded shard."""
    heap = [(0, s) for s in range(n_shards)]
    out = {}
    for size, item in sorted(sizes, key=lambda x: (-x[0], x[1])):
        load, shard = heap[0]
        out[item] = shard
        heapq.heapreplace(heap, (load + size, shard))
    return out


def with_groups(docs: DataFrame) -> DataFrame:
    """doc_id, size, checksum, and the key and bundle of the group of equal texts."""
    t = F.coalesce("text", F.lit(""))
    d = docs.select("doc_id", (F.octet_length(t) + OVERHEAD).cast("long").alias("size"),
                    F.crc32(t.cast("binary")).cast("long").alias("text_crc32"),
                    F.xxhash64(t).alias("h1"))
    h = F.xxhash64("h1", "text_crc32")
    share = F.pmod(h, F.lit(100))
    tier = F.when(share < 1, 2).when(share < 10, 1).otherwise(0)
    return d.withColumn("bundle", (tier * BUNDLES + F.pmod(F.shiftright(h, 20), F.lit(BUNDLES))).cast("int"))


def shard_documents(docs: DataFrame, n_shards: int = N_SHARDS, exact: int = EXACT) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot."""
    spark = docs.sparkSession
    d = with_groups(docs)
    key = ["h1", "text_crc32", "bundle"]
    groups = written(d.groupBy(*key).agg(F.sum("size").alias("bytes")), "shard-groups")
    total = groups.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    large = F.col("bytes") * exact > total
    big = groups.filter(large).collect()                       # fewer than ``exact`` rows
    small = groups.filter(~large).groupBy("bundle").agg(F.sum("bytes").alias("bytes")).collect()
    items = [(r.bytes, (0, r.h1, r.text_crc32)) for r in big]
    items += [(r.bytes, (1, r.bundle, 0)) for r in small]
    where = lpt(items, n_shards)
    of_group = spark.createDataFrame([(k[1], k[2], s) for k, s in where.items() if k[0] == 0],
                                     "h1 long, text_crc32 long, own int")
    of_bundle = spark.createDataFrame([(k[1], s) for k, s in where.items() if k[0] == 1],
                                      "bundle int, shared int")
    placed = (d.join(F.broadcast(of_group), ["h1", "text_crc32"], "left")
              .join(F.broadcast(of_bundle), "bundle", "left")
              .select("doc_id", "size", "text_crc32", F.coalesce("own", "shared").alias("shard"),
                      F.spark_partition_id().alias("_pid")))
    return numbered(written(placed, "shard-placed"), ["shard"], ["doc_id", "size", "text_crc32"], "slot")


def op2_sharding(spark, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of near equal bytes."""
    out = shard_documents(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"),
                      "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
