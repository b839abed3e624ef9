"""Surrogate keys for new dimension rows.

Keys are dense (start+1 .. start+n) and a pure function of the data, not of
the physical partitioning: each row goes to a bucket = hash(natural key) mod
B (a column, so AQE coalescing or a recomputed task after a lost executor
cannot change it), is numbered by ``row_number`` inside its bucket in key
order, and is offset by the row count of the buckets before it. A layer used
twice in one plan, or recomputed, gets the same keys without materializing.

Cost: one shuffle of the new rows on the bucket (groups hold about n / B
unique keys, so no group is hot), plus a per-bucket count table - B rows, a
proven bound - that is broadcast back. No window over the whole data, no
driver round trip.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def key_partitions(spark: SparkSession) -> int:
    """Bucket / partition count for key assignment and ordered scans: fixed
    per session so plans are reproducible."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def assign_keys(df: DataFrame, key_cols: list[str], sk_col: str, start: int = 0,
                num_buckets: int | None = None) -> DataFrame:
    """Add ``sk_col`` = a unique dense integer per row, starting at start+1.

    ``key_cols`` must be unique in ``df`` (natural key of the new rows).
    """
    b = num_buckets or key_partitions(df.sparkSession)
    bucketed = df.withColumn("_kb", F.pmod(F.xxhash64(*key_cols), F.lit(b)))
    in_bucket = Window.partitionBy("_kb").orderBy(*key_cols)
    placed = bucketed.withColumn("_kpos", F.row_number().over(in_bucket))
    counts = bucketed.groupBy("_kb").agg(F.count(F.lit(1)).alias("_kn"))
    before = Window.orderBy("_kb").rowsBetween(Window.unboundedPreceding, -1)  # B rows
    offsets = counts.select("_kb", F.coalesce(F.sum("_kn").over(before), F.lit(0)).alias("_koff"))
    return (placed.join(F.broadcast(offsets), "_kb")
            .withColumn(sk_col, F.lit(start).cast("bigint") + F.col("_koff") + F.col("_kpos"))
            .drop("_kb", "_kpos", "_koff"))


def next_key_start(existing: DataFrame | None, sk_col: str) -> int:
    """Largest stored key (0 when empty): one scalar aggregate."""
    if existing is None:
        return 0
    row = existing.agg(F.max(sk_col).alias("m")).first()
    return int(row["m"] or 0)
