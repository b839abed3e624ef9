"""Previous / next row per key in time order, without a per-key group.

A window ``partitionBy(key).orderBy(ts)`` puts every row of a key into one
task; a key holding a third of the data makes that task a third of the job.
Here the rows are range-partitioned on (key, order columns) instead, so a
hot key is split over as many partitions as its size needs:

1. range-partition + sort, then materialize (reliable checkpoint in the
   shared folder): range bounds are sampled, so the partitioning must be
   fixed before it is read twice;
2. previous / next inside each partition: a window over (key, partition id),
   whose groups are bounded by the partition size;
3. the first row of a partition takes its predecessor from the last row of
   the previous non-empty partition when that row has the same key (and the
   last row its successor likewise). The boundary table has one row per
   partition - a proven bound - and is broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.operators.keys import key_partitions
from starloom.session import shared_dir


def neighbors(df: DataFrame, key: str, order: list[str], prev_cols: list[str] = (), next_cols: list[str] = (),
              num_partitions: int | None = None) -> DataFrame:
    """Add ``prev_<c>`` / ``next_<c>`` (value of the previous / next row of
    the same ``key`` in ``order``) and ``has_prev`` / ``has_next``.
    ``order`` must make rows of one key unique."""
    spark = df.sparkSession
    shared_dir(spark)
    n = num_partitions or key_partitions(spark)
    sort_cols = [key, *order]
    ranged = df.repartitionByRange(n, *sort_cols).sortWithinPartitions(*sort_cols).checkpoint(eager=True)
    tagged = ranged.withColumn("_pid", F.spark_partition_id())

    w = Window.partitionBy(key, "_pid").orderBy(*order)
    local = tagged.select(
        "*",
        F.lag(F.lit(1)).over(w).isNotNull().alias("_lp"),
        F.lead(F.lit(1)).over(w).isNotNull().alias("_ln"),
        *[F.lag(c).over(w).alias(f"_lp_{c}") for c in prev_cols],
        *[F.lead(c).over(w).alias(f"_ln_{c}") for c in next_cols],
    )
    extra_next = [c for c in next_cols if c not in sort_cols]
    extra_prev = [c for c in prev_cols if c not in sort_cols]
    edges = tagged.groupBy("_pid").agg(
        F.min(F.struct(*sort_cols, *extra_next)).alias("_first"),
        F.max(F.struct(*sort_cols, *extra_prev)).alias("_last"))
    across = Window.orderBy("_pid")  # one row per non-empty partition
    edges = edges.select(
        "_pid",
        F.lag("_last").over(across).alias("_before"),
        F.lead("_first").over(across).alias("_after"))
    j = local.join(F.broadcast(edges), "_pid")
    from_before = ~F.col("_lp") & F.col("_before").isNotNull() & (F.col(f"_before.{key}") == F.col(key))
    from_after = ~F.col("_ln") & F.col("_after").isNotNull() & (F.col(f"_after.{key}") == F.col(key))
    out = [F.col(c) for c in df.columns]
    out += [F.when(from_before, F.col(f"_before.{c}")).otherwise(F.col(f"_lp_{c}")).alias(f"prev_{c}")
            for c in prev_cols]
    out += [F.when(from_after, F.col(f"_after.{c}")).otherwise(F.col(f"_ln_{c}")).alias(f"next_{c}")
            for c in next_cols]
    out += [(F.col("_lp") | from_before).alias("has_prev"), (F.col("_ln") | from_after).alias("has_next")]
    return j.select(*out)
