"""Profiles of the event data against the product's event model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.numeric import pct
from starloom.operators.sequence import neighbors
from starloom.schemas import EVENT_TYPE_WEIGHTS, PLATFORM_WEIGHTS


def _weights(spark: SparkSession, rows: list[tuple[str, int]], key: str) -> DataFrame:
    schema = T.StructType([T.StructField(key, T.StringType(), False),
                           T.StructField("expected_pct", T.IntegerType(), False)])
    return spark.createDataFrame(rows, schema)


def _mix(staging: DataFrame, key: str, weights: list[tuple[str, int]]) -> DataFrame:
    counts = staging.groupBy(key).agg(F.count(F.lit(1)).alias("n_events"))
    total = F.sum("n_events").over(Window.partitionBy())  # over the few category rows
    share = counts.select(key, "n_events", pct(F.col("n_events"), total, 2).alias("actual_pct"),
                          F.lit(None).cast("int").alias("expected_pct"))
    exp = _weights(staging.sparkSession, weights, key).select(
        key, F.lit(None).cast("bigint").alias("n_events"), F.lit(None).cast("decimal(38,18)").alias("actual_pct"),
        "expected_pct")
    # Observed and expected categories side by side: a union and a group-by
    # over a handful of rows (a full outer join would need a sort-merge join).
    both = share.unionByName(exp, allowMissingColumns=False).groupBy(key).agg(
        F.max("n_events").alias("n_events"), F.max("actual_pct").alias("actual_pct"),
        F.max("expected_pct").alias("expected_pct"))
    return both.select(
        key,
        F.coalesce("n_events", F.lit(0)).cast("bigint").alias("n_events"),
        F.coalesce("actual_pct", F.lit(0)).cast("double").alias("actual_pct"),
        F.col("expected_pct").cast("double").alias("expected_pct"),
    )


def event_mix(staging: DataFrame) -> DataFrame:
    """Share of each event type next to the model's weight."""
    return _mix(staging, "event_type", EVENT_TYPE_WEIGHTS)


def platform_mix(staging: DataFrame) -> DataFrame:
    """Share of each platform next to the model's weight."""
    return _mix(staging, "platform", PLATFORM_WEIGHTS)


def hour_profile(staging: DataFrame) -> DataFrame:
    """Events per hour of day; all 24 hours, 0 where none."""
    hours = staging.sparkSession.range(24).select(F.col("id").alias("hour"))
    counts = staging.groupBy(F.hour("event_timestamp").cast("bigint").alias("hour")).agg(F.count(F.lit(1)).alias("n_events"))
    return F.broadcast(hours).join(counts, "hour", "left").select(
        "hour", F.coalesce("n_events", F.lit(0)).cast("bigint").alias("n_events"))


def volume_trend(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Events per day with the calendar's weekday attributes, the
    trailing 7-row mean, and the weekend / weekday ratio of the daily mean.

    The trailing window runs over the daily table, whose size is bounded
    by the calendar (one row per day), never over events."""
    daily = fact.groupBy(F.col("date_key")).agg(F.count(F.lit(1)).alias("n_events"))
    cal = F.broadcast(dim_date.select("date_key", "full_date", "is_weekend"))
    d = daily.join(cal, "date_key")
    trailing = Window.orderBy("full_date").rowsBetween(-6, 0)
    everything = Window.partitionBy()
    wk_mean = F.avg(F.when(F.col("is_weekend"), F.col("n_events"))).over(everything)
    wd_mean = F.avg(F.when(~F.col("is_weekend"), F.col("n_events"))).over(everything)
    return d.select(
        F.col("full_date").alias("activity_date"), "is_weekend",
        F.col("n_events").cast("bigint").alias("n_events"),
        F.round(F.avg("n_events").over(trailing), 4).alias("trailing_7d_mean"),
        F.round(wk_mean / wd_mean, 4).alias("weekend_ratio"),
    )


def session_rollup(staging: DataFrame) -> DataFrame:
    """Per session: user, events, start, end, length in seconds
    (partial aggregation; a hot session costs one combined row per task)."""
    g = staging.where(F.col("session_id").isNotNull()).groupBy("session_id").agg(
        F.min("user_id").alias("user_id"),
        F.count(F.lit(1)).alias("n_events"),
        F.min("event_timestamp").alias("session_start"),
        F.max("event_timestamp").alias("session_end"))
    # Wall-clock difference of the NTZ values (no time zone involved).
    length = F.expr("timestampdiff(SECOND, session_start, session_end)")
    return g.select("session_id", "user_id", "n_events", "session_start", "session_end",
                    length.cast("bigint").alias("session_seconds"))


def subscription_props(staging: DataFrame) -> DataFrame:
    """Subscription events with their properties read from the stored JSON."""
    p = F.col("properties")
    return staging.where(F.col("event_type").startswith("subscription_")).select(
        "event_id", "user_id", "event_type", "event_timestamp",
        F.get_json_object(p, "$.plan").alias("plan"),
        F.get_json_object(p, "$.billing_cycle").alias("billing_cycle"),
        F.get_json_object(p, "$.reason").alias("reason"))


def subscription_lifecycle(staging: DataFrame) -> DataFrame:
    """Subscription events per type, plan, billing cycle and reason."""
    return (subscription_props(staging)
            .groupBy("event_type", "plan", "billing_cycle", "reason")
            .agg(F.count(F.lit(1)).alias("n_events"),
                 F.count_distinct("user_id").alias("n_users")))


def plan_changes(staging: DataFrame) -> DataFrame:
    """Subscription events as user states: started / upgraded -> (plan,
    active); cancelled -> (free, cancelled). Input for X7 and C3."""
    s = subscription_props(staging)
    cancelled = F.col("event_type") == "subscription_cancelled"
    return s.select(
        "user_id",
        F.col("event_timestamp").alias("change_ts"),
        F.col("event_id").alias("change_id"),
        F.when(cancelled, F.lit("free")).otherwise(F.col("plan")).alias("current_plan"),
        F.when(cancelled, F.lit("cancelled")).otherwise(F.lit("active")).alias("account_status"))


def plan_history(staging: DataFrame) -> DataFrame:
    """Plan intervals per user. Every user starts (free, active) at the
    first event; each subscription event whose state differs from the one
    before opens an interval ending where the next one starts. The last
    interval per user is open (valid_to NULL).

    Previous state and next start come from ``sequence.neighbors``, which
    splits a user with very many events over several tasks."""
    starts = staging.groupBy("user_id").agg(F.min("event_timestamp").alias("change_ts")).select(
        "user_id", "change_ts", F.lit("").alias("change_id"),
        F.lit("free").alias("current_plan"), F.lit("active").alias("account_status"))
    ch = starts.unionByName(plan_changes(staging))
    return change_intervals(ch, ("current_plan", "account_status")).select(
        "user_id", F.col("current_plan").alias("plan"), "account_status",
        F.col("change_ts").alias("valid_from"), F.col("next_change_ts").alias("valid_to"))


def change_intervals(changes: DataFrame, tracked: tuple[str, ...], keep_first: bool = True) -> DataFrame:
    """Collapse (user_id, change_ts, change_id, <tracked>) rows to change
    points - rows whose tracked state differs from the row before - and
    give each the start of the next point (``next_change_ts``) and
    ``is_first`` (no earlier point). With ``keep_first`` the first row of a
    user always counts as a point."""
    order = ["change_ts", "change_id"]
    nb = neighbors(changes, "user_id", order, prev_cols=list(tracked))
    differs = None
    for c in tracked:
        d = ~F.col(c).eqNullSafe(F.col(f"prev_{c}"))
        differs = d if differs is None else (differs | d)
    cond = (~F.col("has_prev") | differs) if keep_first else (F.col("has_prev") & differs)
    points = nb.where(cond).select(*changes.columns)
    ends = neighbors(points, "user_id", order, next_cols=["change_ts"])
    return ends.select(*changes.columns, "next_change_ts", (~F.col("has_prev")).alias("is_first"))
