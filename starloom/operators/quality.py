"""Quality checks: the DDL's constraints as Spark jobs. Each returns one
row per rule with the number of violating rows (0 = pass)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.schemas import NOT_NULL, VARCHAR_LIMITS


def _stack(df: DataFrame, names: list[str], label: str, value: str) -> DataFrame:
    pairs = ", ".join(f"'{n}', `{n}`" for n in names)
    return df.selectExpr(f"stack({len(names)}, {pairs}) as ({label}, {value})")


def chk_not_null(df: DataFrame, table: str, columns: list[str] | None = None) -> DataFrame:
    """G1: NULLs per NOT NULL column, all columns in one pass."""
    cols = [c for c in (columns or NOT_NULL[table]) if c in df.columns]
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return _stack(counts, cols, "column_name", "violations").select(
        F.lit(table).alias("table_name"), F.lit("not_null").alias("rule"), "column_name",
        F.col("violations").cast("bigint"))


def chk_unique(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """Rows beyond the first per key value; rows with a NULL key part
    never collide (NULLs are distinct). Partial aggregation on the key."""
    nn = df.where(F.lit(True) if not keys else F.expr(" AND ".join(f"`{k}` IS NOT NULL" for k in keys)))
    extra = (nn.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
             .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("violations")))
    return extra.select(F.lit(table).alias("table_name"), F.lit("unique").alias("rule"),
                        F.lit(",".join(keys)).alias("column_name"), F.col("violations").cast("bigint"))


def chk_one_current(users: DataFrame) -> DataFrame:
    """At most one current row per user_id."""
    out = chk_unique(users.where(F.col("is_current")), "dim_users", ["user_id"])
    return out.withColumn("rule", F.lit("one_current"))


def chk_foreign_key(child: DataFrame, table: str, col: str, parent: DataFrame, parent_col: str,
                    nullable: bool) -> DataFrame:
    """Child rows whose key is missing in the parent (NULL passes when
    the column is nullable, fails otherwise)."""
    c = child.select(F.col(col).alias("_fk"))
    missing = c.where(F.col("_fk").isNotNull()).join(
        parent.select(F.col(parent_col).alias("_fk")), "_fk", "left_anti")
    bad = missing.agg(F.count(F.lit(1)).alias("v"))
    if not nullable:
        nulls = c.agg(F.count_if(F.col("_fk").isNull()).alias("v"))
        bad = bad.unionByName(nulls).agg(F.sum("v").alias("v"))
    return bad.select(F.lit(table).alias("table_name"), F.lit("foreign_key").alias("rule"),
                      F.lit(col).alias("column_name"), F.col("v").cast("bigint").alias("violations"))


def chk_lengths(df: DataFrame, table: str) -> DataFrame:
    """Values longer than the column's VARCHAR limit, all columns in one
    pass."""
    limits = {c: n for c, n in VARCHAR_LIMITS[table].items() if c in df.columns}
    counts = df.agg(*[F.count_if(F.length(c) > n).alias(c) for c, n in limits.items()])
    return _stack(counts, list(limits), "column_name", "violations").select(
        F.lit(table).alias("table_name"), F.lit("max_length").alias("rule"), "column_name",
        F.col("violations").cast("bigint"))


def chk_reconcile(fact: DataFrame, daily: DataFrame) -> DataFrame:
    """Per day, facts counted vs the daily fact's total_events; both
    sides aggregated first, then a full outer join of day-sized tables."""
    f = fact.groupBy(F.col("event_timestamp").cast("date").alias("activity_date")).agg(
        F.count(F.lit(1)).alias("fact_events"))
    d = daily.groupBy("activity_date").agg(F.sum("total_events").cast("bigint").alias("daily_events"))
    j = f.join(d, "activity_date", "full_outer")
    return j.select(
        "activity_date",
        F.coalesce("fact_events", F.lit(0)).cast("bigint").alias("fact_events"),
        F.coalesce("daily_events", F.lit(0)).cast("bigint").alias("daily_events"),
    ).withColumn("difference", F.col("fact_events") - F.col("daily_events"))
