"""tidemark: a Spark-native medallion batch pipeline for retail orders.

Raw CSV -> Bronze (raw copy) -> Silver (data-quality gated copy) -> Gold
(star schema: one fact at order-product grain, product/aisle/department
dimensions), driven by an integer-key high-water mark.

Everything is expressed with the DataFrame API so Catalyst plans it:
single-pass quality gates, size-checked broadcast joins, partition-pruned
batch reads and retry-safe batch partitions.
"""

__version__ = "0.1.0"
