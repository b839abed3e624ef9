"""Minimax contiguous partition of atomic groups into shards.

Rows of one group stay together; groups stand in the order of (smallest key,
group) and are cut into ``n_shards`` runs whose largest total is as small as
any contiguous cut allows. The capacity is found by binary search; a greedy
pass checks each try.

The ordered groups are written once, dealt by range into blocks of about
``block_groups`` with running totals. The driver holds one row per block and,
of the few blocks in which a cut can fall, the running totals (at most
``CACHED_BLOCKS`` of them) - never all groups. A row's slot is the number of
rows in groups before it, plus its place inside its group; a large group is
numbered in sub-groups of about SUB_ROWS rows, so no task sees a whole one.

Defined results: null and empty groups are groups like any other, ties in
the order fall to the group's value, repeated rows take slots of their own, an
empty table gives an empty result, and a group larger than the mean shard sets
the capacity by itself (shards after the last group stay empty).
"""

from __future__ import annotations

from bisect import bisect_right
from collections import OrderedDict

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import col, free_name, materialize, spread_join

BLOCK_GROUPS = 1 << 18
CACHED_BLOCKS = 64
SUB_ROWS = 10_000


class Prefix:
    """Running totals of the ordered groups: block ends on the driver, the
    inside of a block read when a cut needs it."""

    def __init__(self, ordered: DataFrame):
        ends = ordered.groupBy("block").agg(F.sum("size").alias("size"), F.sum("n").alias("n"),
                                            F.max("size").alias("most"), F.count("*").alias("groups")) \
            .orderBy("block").collect()  # one row per block
        self.ordered = ordered
        self.blocks = [r.block for r in ends]
        self.groups = [r.groups for r in ends]
        self.start = [0, *np.cumsum([r["size"] for r in ends]).tolist()]
        self.rows_before = [0, *np.cumsum([r.n for r in ends]).tolist()]
        self.most = max([0, *(r.most for r in ends)])
        self.total = self.start[-1]
        self._read: OrderedDict[int, np.ndarray] = OrderedDict()

    def inside(self, at: int) -> np.ndarray:
        if at not in self._read:
            rows = self.ordered.where(F.col("block") == self.blocks[at]).select("idx", "upto").toPandas()
            self._read[at] = rows.sort_values("idx")["upto"].to_numpy(np.int64)
            while len(self._read) > CACHED_BLOCKS:
                self._read.popitem(last=False)
        self._read.move_to_end(at)
        return self._read[at]

    def furthest(self, limit: int) -> tuple[int, int, int]:
        """(block position, groups of it inside, total) of the longest run of
        first groups with a total of at most ``limit``."""
        if limit >= self.total:
            return len(self.blocks), 0, self.total
        at = bisect_right(self.start, limit) - 1
        upto = self.inside(at)
        k = int(np.searchsorted(upto, limit - self.start[at], side="right"))
        return at, k, self.start[at] + (int(upto[k - 1]) if k else 0)

    def cuts(self, capacity: int, n_shards: int) -> list[tuple[int, int]] | None:
        """Greedy cut points for a capacity, or None if more shards are needed."""
        found, total = [], 0
        for _ in range(n_shards):
            at, k, total = self.furthest(total + capacity)
            if total >= self.total:
                return found
            found.append((at, k))
        return None


def smallest_capacity(prefix: Prefix, n_shards: int) -> int:
    """The least capacity at which the greedy pass needs ``n_shards`` at most."""
    low = max(prefix.most, -(-prefix.total // n_shards))
    high = -(-prefix.total // n_shards) + prefix.most
    while low < high:
        mid = (low + high) // 2
        if prefix.cuts(mid, n_shards) is None:
            low = mid + 1
        else:
            high = mid
    return low


def minimax_shards(rows: DataFrame, n_shards: int, key: str, group: str, size: str,
                   block_groups: int = BLOCK_GROUPS) -> DataFrame:
    """``rows`` plus ``shard`` (int from 0) and ``slot`` (long, gapless from 0
    in each shard). ``size``: a row's size, zero or more. ``rows`` must read the same
    each time (a table, or rows that were written). New columns get an underscore
    at their end while the rows have one of that name."""
    extra = {"k_": col(rows, key), "g_": col(rows, group), "s_": col(rows, size).cast("long"), "u_": F.monotonically_increasing_id()}
    # Input columns go under names of their own, so none meets one that is used here.
    own = [col(rows, c).alias(f"in_{i}") for i, c in enumerate(rows.columns)]
    keyed = materialize(rows.select(*own, *(c.alias(n) for n, c in extra.items())), "rows")
    groups = materialize(keyed.groupBy("g_").agg(F.sum("s_").alias("size"), F.count("*").alias("n"),
                                                 F.min("k_").alias("first")), "groups")
    blocks = max(1, -(-groups.count() // block_groups))
    inside = Window.partitionBy("block").orderBy("first", "g_")
    ordered = materialize(
        groups.repartitionByRange(blocks, "first", "g_").withColumn("block", F.spark_partition_id())
        .select("*", (F.row_number().over(inside) - 1).alias("idx"), F.sum("size").over(inside).alias("upto"),
                (F.sum("n").over(inside) - F.col("n")).alias("rows_before")), "ordered")
    prefix = Prefix(ordered)
    cuts = prefix.cuts(smallest_capacity(prefix, n_shards), n_shards)
    # A cut at a block's end is the start of the next one.
    cuts = [(prefix.blocks[at], k) if k < prefix.groups[at] else (prefix.blocks[at] + 1, 0) for at, k in cuts]
    place = F.struct("block", "idx")
    shard = sum((F.when(place >= F.struct(F.lit(b).alias("block"), F.lit(k).alias("idx")), 1).otherwise(0)
                 for b, k in cuts), F.lit(0)).cast("int")
    spark = rows.sparkSession
    before = spark.createDataFrame(list(zip(prefix.blocks, prefix.rows_before)), "block int, block_rows long")
    placed = ordered.join(F.broadcast(before), "block").select(
        "g_", "n", shard.alias("shard"), (F.col("rows_before") + F.col("block_rows")).alias("at"))
    starts = placed.groupBy("shard").agg(F.min("at").alias("shard_at"))  # n_shards rows
    placed = placed.join(F.broadcast(starts), "shard").select("g_", "n", "shard", (F.col("at") - F.col("shard_at")).alias("at"))
    # Null groups never meet in a join by equality: a marked copy of the value does.
    same = lambda df: df.withColumn("g_", F.struct(F.col("g_")))
    # Rows of a large group are dealt by ``sub``, too: its place comes to them.
    joined = spread_join(same(keyed), same(placed), "g_", "n").withColumn(
        "sub", F.pmod(F.xxhash64("u_"), F.ceil(F.col("n") / SUB_ROWS)))
    subs = joined.groupBy("g_", "sub").agg(F.count("*").alias("sub_n"))
    subs = subs.select("g_", "sub", (F.sum("sub_n").over(Window.partitionBy("g_").orderBy("sub")) - F.col("sub_n")).alias("sub_at"))
    numbered = joined.withColumn("i", F.row_number().over(Window.partitionBy("g_", "sub").orderBy("k_", "u_")) - 1)
    return numbered.join(subs, ["g_", "sub"]).select(
        *(F.col(f"in_{i}").alias(c) for i, c in enumerate(rows.columns)), F.col("shard").alias(free_name(rows.columns, "shard")),
        (F.col("at") + F.col("sub_at") + F.col("i")).alias(free_name(rows.columns, "slot")))
