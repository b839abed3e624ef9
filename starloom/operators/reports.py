"""Reports and validation queries that read the stored views and facts."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions.numeric import pct, round_ratio


def feature_avg_uses(funnel: DataFrame) -> DataFrame:
    """Uses per user per feature, ROUND(uses / users, 1), by uses
    (descending)."""
    return funnel.select(
        "feature_name", "total_uses", "unique_users",
        round_ratio(F.col("total_uses"), F.col("unique_users"), 1).alias("avg_uses_per_user"),
    ).orderBy(F.col("total_uses").desc(), "feature_name")  # at most one row per feature


def churn_distribution(churn: DataFrame) -> DataFrame:
    """Users per churn category and their share of all, ROUND(.., 1).
    The total is a window over the (at most 4) category rows."""
    per = churn.groupBy("churn_risk_category").agg(F.count(F.lit(1)).alias("user_count"))
    total = F.sum("user_count").over(Window.partitionBy())
    return per.select("churn_risk_category", "user_count",
                      pct(F.col("user_count"), total, 1).alias("percentage")).orderBy("churn_risk_category")


def dau_trend(daily: DataFrame, as_of: _dt.date | str, days: int = 30) -> DataFrame:
    """Per day on or after as_of - ``days`` (no upper bound): distinct
    active users and total events, by day."""
    since = F.date_sub(F.lit(as_of).cast("date"), days)
    recent = daily.where(F.col("activity_date") >= since)
    if "activity_month" in daily.columns:
        # Stored daily rows are partitioned by month: the implied month bound
        # lets the scan skip older partitions.
        recent = recent.where(F.col("activity_month") >= F.date_format(since, "yyyy-MM"))
    return (recent
            .groupBy("activity_date")
            # (activity_date, user_sk) is the daily table's primary key, so
            # distinct users per day = rows per day: no distinct aggregation.
            .agg(F.count("user_sk").alias("daily_active_users"),
                 F.sum("total_events").cast("bigint").alias("total_events"))
            .orderBy("activity_date"))  # one row per day


def layer_counts(raw: DataFrame, staging: DataFrame, fact: DataFrame) -> DataFrame:
    """Rows per layer."""
    def one(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("record_count")).select(F.lit(name).alias("layer"), "record_count")
    return one(raw, "Raw").unionByName(one(staging, "Staging")).unionByName(one(fact, "Core"))


def layer_pct_first(counts: DataFrame) -> DataFrame:
    """E5a, as written: 100 * count / the first count in layer-name order
    (which is Core, not Raw); zero in that row fails the query."""
    first = F.first_value("record_count").over(
        Window.orderBy("layer").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return counts.select("layer", "record_count", pct(F.col("record_count"), first, 2).alias("pct_of_raw"))


def layer_pct_of_raw(counts: DataFrame) -> DataFrame:
    """E5b, as intended: 100 * count / the Raw count."""
    raw = F.max(F.when(F.col("layer") == "Raw", F.col("record_count"))).over(Window.partitionBy())
    return counts.select("layer", "record_count", pct(F.col("record_count"), raw, 2).alias("pct_of_raw"))


def duplicate_events(staging: DataFrame) -> DataFrame:
    """event_ids that occur more than once (partial aggregation)."""
    return (staging.groupBy("event_id").agg(F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("n_rows") > 1))


def table_counts(dim_date: DataFrame, fact: DataFrame, funnel: DataFrame) -> DataFrame:
    """Row counts after a clean rebuild."""
    def one(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
    return one(dim_date, "dim_date").unionByName(one(fact, "fact_events")) \
        .unionByName(one(funnel, "feature_adoption_funnel"))


def total_users(users: DataFrame) -> DataFrame:
    """Registered (current) users."""
    return users.where(F.col("is_current")).agg(F.count(F.lit(1)).alias("total_users"))


def retention_matrix(retention: DataFrame, months: list[int] | None = None) -> DataFrame:
    """The retention triangle: one row per cohort, one column per
    months-since-signup value holding the rate. Without ``months`` the
    column set is every value present (one distinct pass over the small
    retention table, bounded by the calendar)."""
    rows = retention.where(F.col("months_since_signup").isNotNull())
    pv = rows.groupBy("cohort_month").pivot("months_since_signup", months)
    return pv.agg(F.first("retention_rate"))
