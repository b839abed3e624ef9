"""Analytics views: cohort retention, feature adoption, churn risk."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.dates import month_start, whole_months_between
from starloom.functions.numeric import pct, round_ratio
from starloom.schemas import CHURN_HIGH_DAYS, CHURN_LOW_DAYS, CHURN_MEDIUM_DAYS

RETENTION_COLUMNS = ["cohort_month", "activity_month", "months_since_signup", "cohort_size",
                     "retained_users", "retention_rate"]


def retention_cohorts(users: DataFrame, daily: DataFrame, denominator: str = "group") -> DataFrame:
    """cohort = signup month of current users, LEFT JOIN their activity
    months, grouped by (cohort, activity month).

    ``denominator="group"`` (D1a, as the view is written): cohort_size is
    counted inside the (cohort, activity month) group, so it equals
    retained_users wherever activity_month is set. ``"cohort"`` (D1b, the
    stated intent): cohort_size = all current users of the cohort.
    Users with no activity form the row with NULL activity month, NULL
    months_since_signup, 0 retained, rate 0.00.

    Activity is reduced to distinct (user, month) before the join, so both
    distinct counts become plain counts of one row per user; the per-cohort
    size table has one row per month (bounded by the calendar)."""
    cohorts = users.where(F.col("is_current")).select(
        "user_sk", month_start(F.col("signup_date")).alias("cohort_month"))
    if "activity_month" in daily.columns and "activity_date" not in daily.columns:
        activity = daily.select("user_sk", "activity_month")  # a maintained user-month rollup
    else:
        activity = daily.select("user_sk", month_start(F.col("activity_date")).alias("activity_month")).distinct()
    j = cohorts.join(activity, "user_sk", "left")
    g = j.groupBy("cohort_month", "activity_month").agg(
        F.count(F.lit(1)).alias("group_size"),
        F.count("activity_month").alias("retained_users"))
    if denominator == "group":
        g = g.withColumn("cohort_size", F.col("group_size"))
    elif denominator == "cohort":
        sizes = cohorts.groupBy("cohort_month").agg(F.count(F.lit(1)).alias("cohort_size"))
        g = g.join(sizes, "cohort_month")
    else:
        raise ValueError(f"unknown denominator {denominator!r}")
    return g.select(
        "cohort_month", "activity_month",
        whole_months_between(F.col("activity_month"), F.col("cohort_month")).alias("months_since_signup"),
        "cohort_size", "retained_users",
        pct(F.col("retained_users"), F.col("cohort_size"), 2).alias("retention_rate"),
    )


def feature_user_rollup(fact: DataFrame) -> DataFrame:
    """First level of D2: feature_used facts per (feature, user) - uses,
    duration sum and count, first and last use. Mergeable: two rollups of
    disjoint fact sets combine with ``merge_feature_rollup``."""
    used = fact.where(F.col("event_type") == "feature_used").select(
        "feature_sk", "user_sk", "duration_seconds", "event_timestamp")
    return used.groupBy("feature_sk", "user_sk").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("duration_seconds").alias("dur_sum"),
        F.count("duration_seconds").alias("dur_n"),
        F.min("event_timestamp").alias("first_ts"),
        F.max("event_timestamp").alias("last_ts"))


def merge_feature_rollup(partials: DataFrame) -> DataFrame:
    """The rollup of all facts from the rollups of disjoint parts of them."""
    return partials.groupBy("feature_sk", "user_sk").agg(
        F.sum("n").alias("n"), F.sum("dur_sum").alias("dur_sum"), F.sum("dur_n").alias("dur_n"),
        F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"))


def funnel_from_rollup(per_user: DataFrame, features: DataFrame) -> DataFrame:
    """Levels 2-3 of D2: per feature from the (feature, user) rollup - a
    map-side-combined aggregation of at most 8 rows per task - then the
    feature attributes (broadcast, 8 rows)."""
    per_feature = per_user.groupBy("feature_sk").agg(
        F.count(F.lit(1)).alias("unique_users"),
        F.sum("n").alias("total_uses"),
        F.sum("dur_sum").alias("dur_sum"),
        F.sum("dur_n").alias("dur_n"),
        F.min("first_ts").alias("first_used_at"),
        F.max("last_ts").alias("last_used_at"))
    f = F.broadcast(features.select("feature_sk", "feature_name", "feature_category",
                                    F.col("is_premium").alias("is_premium_feature")))
    j = per_feature.join(f, "feature_sk")
    return j.groupBy("feature_name", "feature_category", "is_premium_feature").agg(
        F.sum("unique_users").alias("unique_users"),
        F.sum("total_uses").alias("total_uses"),
        F.sum("dur_sum").alias("dur_sum"),
        F.sum("dur_n").alias("dur_n"),
        F.min("first_used_at").alias("first_used_at"),
        F.max("last_used_at").alias("last_used_at"),
    ).select(
        "feature_name", "feature_category", "is_premium_feature", "unique_users", "total_uses",
        F.when(F.col("dur_n") > 0, round_ratio(F.col("dur_sum"), F.col("dur_n"), 2)).alias("avg_duration_seconds"),
        "first_used_at", "last_used_at",
    )


def feature_adoption(fact: DataFrame, features: DataFrame) -> DataFrame:
    """Per feature (name, category, premium) among feature_used facts:
    distinct users, uses, ROUND(AVG(duration), 2) in decimals, first and
    last use. Unused features are absent.

    Two-level aggregation: first by (feature, user) - shuffled on both
    keys, so the work spreads over all partitions even though there are
    only 8 features - then by feature. The stored daily load keeps the first
    level as a rollup and merges only new facts into it."""
    return funnel_from_rollup(feature_user_rollup(fact), features)


def user_activity_rollup(fact: DataFrame) -> DataFrame:
    """Per user key: fact count and last active day (mergeable). Over all
    facts this equals SUM(total_events) and MAX(activity_date) of the daily
    table, the inputs of D3."""
    return fact.groupBy("user_sk").agg(
        F.count(F.lit(1)).alias("lifetime_events"),
        F.max(F.col("event_timestamp").cast("date")).alias("last_active_date"))


def merge_user_activity(partials: DataFrame) -> DataFrame:
    return partials.groupBy("user_sk").agg(
        F.sum("lifetime_events").alias("lifetime_events"), F.max("last_active_date").alias("last_active_date"))


def user_month_activity(fact: DataFrame) -> DataFrame:
    """Distinct (user key, activity month) pairs: the activity side of D1."""
    return fact.select("user_sk", month_start(F.col("event_timestamp").cast("date")).alias("activity_month")).distinct()


def merge_user_months(partials: DataFrame) -> DataFrame:
    return partials.distinct()


def churn_category(days) -> "F.Column":
    return (F.when(days > CHURN_HIGH_DAYS, "high")
            .when(days > CHURN_MEDIUM_DAYS, "medium")
            .when(days > CHURN_LOW_DAYS, "low")
            .otherwise("active"))


def churn_risk(users: DataFrame, daily: DataFrame, as_of: _dt.date | str, by: str = "user_sk") -> DataFrame:
    """D3 (``by="user_sk"``): per current, active user with activity: last
    active date, lifetime events, days since (as_of - last), category
    (> 30 high, > 14 medium, > 7 low, else active; future dates: active).

    D5 (``by="user_id"``): the same rolled up over all versions of a user
    (activity bound to a closed version is kept), reported against the
    user's current, active row."""
    as_of_col = F.lit(as_of).cast("date")
    if by == "user_sk":
        if "lifetime_events" in daily.columns:
            last = daily.select("user_sk", "last_active_date", "lifetime_events")  # maintained rollup
        else:
            last = daily.groupBy("user_sk").agg(
                F.max("activity_date").alias("last_active_date"),
                F.sum("total_events").alias("lifetime_events"))
        cur = users.where(F.col("is_current") & (F.col("account_status") == "active")).select(
            "user_sk", "user_id", "current_plan")
        j = cur.join(last, "user_sk")
        key_cols = ["user_sk", "user_id"]
    elif by == "user_id":
        if "lifetime_events" in daily.columns:
            per_sk = daily.select("user_sk", "last_active_date", "lifetime_events")  # maintained rollup
        else:
            per_sk = daily.groupBy("user_sk").agg(
                F.max("activity_date").alias("last_active_date"),
                F.sum("total_events").alias("lifetime_events"))
        versions = users.select("user_sk", "user_id")
        last = per_sk.join(versions, "user_sk").groupBy("user_id").agg(
            F.max("last_active_date").alias("last_active_date"),
            F.sum("lifetime_events").alias("lifetime_events"))
        cur = users.where(F.col("is_current") & (F.col("account_status") == "active")).select(
            "user_id", "current_plan")
        j = cur.join(last, "user_id")
        key_cols = ["user_id"]
    else:
        raise ValueError(f"unknown grain {by!r}")
    days = F.datediff(as_of_col, F.col("last_active_date"))
    return j.select(
        *key_cols, "current_plan", "last_active_date",
        days.cast("bigint").alias("days_since_last_activity"),
        F.col("lifetime_events").cast("bigint").alias("lifetime_events"),
        churn_category(days).alias("churn_risk_category"),
    )
