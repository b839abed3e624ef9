"""The stored quality report, kept current: rules over the event layers are
checked on what the report has not read of them and their counts kept.

``raw_events``, ``staging_events`` and ``fact_events`` only grow, so a report
after a load reads that load's rows: nulls, lengths and foreign keys of the new rows,
and for keys the number of times that the new rows' keys stand in the key index,
which finds a key that an old and a new row share without reading old rows. The
counts go to ``quality_counts``, with the position that they reach in one commit.
The other tables are small or replaced as a whole and are checked in full; facts
and user-day facts are reconciled on the days that new facts touch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators import facts, quality
from starloom.schemas import FOREIGN_KEYS, LAYER_KEYS, LAYER_MAXIMA, NOT_NULL, UNIQUE_KEYS, VARCHAR_LIMITS
from starloom.sources.layers import current, maximum, position, read_keys, read_layer, since, write_layer

GROWING = ("raw_events", "staging_events", "fact_events")
COUNTS = "quality_counts"


def _one(table: str, rule: str, column: str, violations: DataFrame) -> DataFrame:
    return violations.select(F.lit(table).alias("table_name"), F.lit(rule).alias("rule"), F.lit(column).alias("column_name"),
                             F.coalesce("violations", F.lit(0)).cast("bigint").alias("violations"))


def repeated_keys(spark: SparkSession, root: str, table: str, new: DataFrame) -> DataFrame:
    """Rows beyond the first per key that ``new``, stored already, brought: within
    itself or on top of earlier rows."""
    key = LAYER_KEYS[table]
    came = new.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("came"))
    stored = read_keys(spark, root, table).df.join(came.select(key).hint("shuffle_hash"), key, "left_semi") \
        .groupBy(key).agg(F.count(F.lit(1)).alias("stored"))
    before = F.greatest(F.col("stored") - F.col("came"), F.lit(0))
    extra = (F.col("stored") - 1) - F.greatest(before - 1, F.lit(0))
    return _one(table, "unique", key, came.join(stored, key).agg(F.sum(extra).alias("violations")))


def _reused(new: DataFrame, old: DataFrame | None, table: str, key: str, highest: int) -> DataFrame:
    """Surrogate keys used twice: within the new rows, or again from the old
    ones. New keys lie above the old ones, so old rows are only looked at for
    those that do not."""
    twice = quality.chk_unique(new, table, [key])
    low = new.where(F.col(key) <= highest).select(key)
    if old is None or low.isEmpty():
        return twice
    again = low.join(old.select(key), key, "left_semi").agg(F.count(F.lit(1)).alias("violations"))
    return twice.unionByName(_one(table, "unique", key, again))


def _check_new(spark: SparkSession, root: str, core_root: str, table: str, new: DataFrame) -> list[DataFrame]:
    checks = [quality.chk_not_null(new, table), quality.chk_lengths(new, table), repeated_keys(spark, root, table, new)]
    if table == "fact_events":
        top = LAYER_MAXIMA[table]
        checks.append(_reused(new, read_layer(spark, root, table, _as_of(spark, root, core_root)), table, top,
                              position(spark, core_root, COUNTS, f"{table}.{top}")))
        for child, column, parent, parent_column, nullable in FOREIGN_KEYS:
            if child == table:
                checks.append(quality.chk_foreign_key(new, child, column, read_layer(spark, core_root, parent), parent_column, nullable))
    return checks


def _as_of(spark: SparkSession, root: str, core_root: str):
    """The facts as the report last read them."""
    from dataclasses import replace

    now, number = current(spark, root, "fact_events"), position(spark, core_root, COUNTS, "fact_events")
    return replace(now, loads=[load for load in now.loads if load[1] <= number])


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def report(spark: SparkSession, raw_root: str, core_root: str) -> DataFrame:
    """G1-G6 over the stored layers, one row per rule: kept counts brought up
    to date for the event layers, full checks for the others."""
    roots = {t: raw_root if t == "raw_events" else core_root for t in GROWING}
    touched = None
    for table, root in roots.items():
        found = since(spark, root, table, position(spark, core_root, COUNTS, table))
        if found is None:
            continue
        new, number = found
        if table == "fact_events":
            touched = facts.touched_days(new)
        reached = {table: number}
        if table in LAYER_MAXIMA:
            reached[f"{table}.{LAYER_MAXIMA[table]}"] = maximum(spark, root, table)
        write_layer(_union(_check_new(spark, root, core_root, table, new)), core_root, COUNTS, "append", reached)
    parts = [read_layer(spark, core_root, COUNTS).groupBy("table_name", "rule", "column_name")
             .agg(F.sum("violations").cast("bigint").alias("violations"))]

    others = {t: read_layer(spark, core_root, t) for t in dict.fromkeys([*NOT_NULL, *UNIQUE_KEYS, *VARCHAR_LIMITS]) if t not in GROWING}
    for name, df in others.items():
        if name in NOT_NULL:
            parts.append(quality.chk_not_null(df, name))
        parts += [quality.chk_unique(df, name, keys) for keys in UNIQUE_KEYS.get(name, [])]
        if name in VARCHAR_LIMITS:
            parts.append(quality.chk_lengths(df, name))
    parts.append(quality.chk_one_current(others["dim_users"]))
    daily = others["fact_daily_user_activity"]
    for child, column, parent, parent_column, nullable in FOREIGN_KEYS:
        if child not in GROWING:
            parts.append(quality.chk_foreign_key(others[child], child, column, others[parent], parent_column, nullable))
    if touched is not None:
        days = F.broadcast(touched)  # a row a calendar day at most
        fact = read_layer(spark, core_root, "fact_events").join(days, F.col("event_date") == F.col("_day"), "left_semi")
        rows = quality.chk_reconcile(fact, daily.join(days, F.col("activity_date") == F.col("_day"), "left_semi"))
        parts.append(_one("fact_daily_user_activity", "reconcile", "total_events",
                          rows.agg(F.count_if(F.col("difference") != 0).alias("violations"))))
    return _union(parts)
