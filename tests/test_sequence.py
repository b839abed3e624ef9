"""The skew-proof previous/next operator against a per-key window (brute
force) on data where one key holds most rows."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from starloom.operators.sequence import neighbors


def _data(spark):
    return spark.range(6000).select(
        F.when(F.col("id") < 3600, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 97).cast("string")))
        .alias("k"),
        ((F.col("id") * 7919) % 5003).alias("t"), F.col("id").alias("i"), (F.col("id") % 3).alias("v"))


def test_neighbors_equal_window(spark):
    df = _data(spark)
    got = neighbors(df, "k", ["t", "i"], prev_cols=["v", "t"], next_cols=["t"], num_partitions=8)
    w = Window.partitionBy("k").orderBy("t", "i")
    expected = df.select(
        "*", F.lag("v").over(w).alias("prev_v"), F.lag("t").over(w).alias("prev_t"),
        F.lead("t").over(w).alias("next_t"), F.lag(F.lit(1)).over(w).isNotNull().alias("has_prev"),
        F.lead(F.lit(1)).over(w).isNotNull().alias("has_next"))
    assert sorted(map(tuple, got.select(*expected.columns).collect())) == sorted(map(tuple, expected.collect()))


def test_hot_key_is_split_over_partitions(spark):
    df = _data(spark)
    got = neighbors(df, "k", ["t", "i"], prev_cols=["v"], num_partitions=8)
    # The ordered work runs on the range-partitioned rows: no partition
    # holds the hot key's 60 % of the rows.
    sizes = [r["n"] for r in got.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert max(sizes) < 0.3 * 6000
