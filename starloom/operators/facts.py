"""Facts: event grain and user-day grain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.dates import date_key
from starloom.sources.layers import KeyIndex, insert_absent, upsert

FACT_COLUMNS = [
    "event_id", "user_sk", "document_sk", "feature_sk", "date_key", "event_type", "session_id",
    "platform", "event_timestamp", "duration_seconds", "characters_added",
]

DAILY_METRICS = [
    "total_events", "login_count", "documents_edited", "documents_created",
    "total_active_seconds", "distinct_features_used",
]


def build_fact_events(staging: DataFrame, users: DataFrame, documents: DataFrame, features: DataFrame,
                      dates: DataFrame, existing: DataFrame | KeyIndex | None = None, event_keys: bool = False,
                      start: int = 0, now: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Staging rows not loaded yet, bound to the dimensions.

    INNER current user (unknown user -> row dropped), LEFT document and
    feature (unknown -> NULL key), INNER calendar on the yyyyMMdd key (date
    outside the calendar -> dropped). The current user version is bound, not
    the version valid at event time.

    Plan: calendar and features have a fixed size and are broadcast; users
    and documents grow with the data, so the join strategy is left to AQE,
    which broadcasts them only when their measured size is under the
    threshold and otherwise shuffles (and splits skewed user partitions).
    Rows without a document are salted so they do not pile up under the
    NULL key in one partition.

    ``event_keys``: number the rows with ``start`` + position in the scan
    (unique, not dense; stable on recomputation, no extra shuffle).
    ``keep``: staging columns to carry along (natural keys for reports).
    """
    now = now if now is not None else F.localtimestamp()
    s = staging
    if event_keys:
        s = s.withColumn("event_sk", F.lit(start).cast("bigint") + F.monotonically_increasing_id() + 1)
    s = insert_absent(s, existing, ["event_id"])
    s = s.withColumn("date_key", date_key(F.col("event_timestamp")))
    s = s.join(F.broadcast(dates.select("date_key")), "date_key")
    s = s.join(F.broadcast(features.select("feature_id", "feature_sk")), "feature_id", "left")
    cur = users.where(F.col("is_current")).select("user_id", "user_sk")
    s = s.join(cur, "user_id")
    # Rows without a document join on a per-row key that no document id can
    # equal (NUL prefix + event id): they spread over all partitions instead
    # of piling up under the NULL key, in one scan and one join.
    docs = documents.select(F.col("document_id").alias("_doc_key"), "document_sk")
    salted = F.coalesce(F.col("document_id"), F.concat(F.lit("\u0000"), F.col("event_id")))
    s = s.withColumn("_doc_key", salted).join(docs, "_doc_key", "left").drop("_doc_key")
    cols = (["event_sk"] if event_keys else []) + FACT_COLUMNS
    extra = [c for c in keep if c not in cols]
    return s.select(*cols, now.alias("created_at"), *extra)


def explain_dropped(staging: DataFrame, users: DataFrame, dates: DataFrame) -> DataFrame:
    """C6f: staging rows the fact load drops, counted per reason
    (no_current_user, date_out_of_range); a row may count under both."""
    s = staging.select("event_id", "user_id", date_key(F.col("event_timestamp")).alias("date_key"))
    cur = users.where(F.col("is_current")).select("user_id")
    no_user = s.join(cur, "user_id", "left_anti").agg(F.count(F.lit(1)).alias("n_events")) \
        .select(F.lit("no_current_user").alias("reason"), "n_events")
    no_date = s.join(F.broadcast(dates.select("date_key")), "date_key", "left_anti") \
        .agg(F.count(F.lit(1)).alias("n_events")).select(F.lit("date_out_of_range").alias("reason"), "n_events")
    return no_user.unionByName(no_date)


# Largest value of the INTEGER columns that the daily metrics are declared as.
INTEGER_MAX = 2**31 - 1


def _integer(name: str) -> Column:
    """A metric as BIGINT; a value beyond INTEGER fails the statement."""
    c = F.col(name)
    return F.when(c <= INTEGER_MAX, c).otherwise(
        F.raise_error(F.concat(F.lit(f"integer out of range in {name}: "), c.cast("string")))).cast("bigint").alias(name)


def build_daily(fact: DataFrame, now: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per (event date, user_sk): events, logins, edits and
    creations (event counts, not distinct documents), active seconds
    (0 when none), distinct features.

    One shuffle on (date, user), every aggregate combined map-side, so a
    hot user-day costs one partial row per task."""
    now = now if now is not None else F.localtimestamp()
    et = F.col("event_type")
    aggs = [
        F.count(F.lit(1)).alias("total_events"),
        F.count_if(et == "user_login").alias("login_count"),
        F.count_if(et == "document_edited").alias("documents_edited"),
        F.count_if(et == "document_created").alias("documents_created"),
        F.coalesce(F.sum("duration_seconds"), F.lit(0)).cast("bigint").alias("total_active_seconds"),
        # Distinct features: the set per user-day is bounded by the feature
        # seed (8 ids) and is combined map-side, so one shuffle suffices
        # (a COUNT(DISTINCT) next to other aggregates plans two).
        F.size(F.collect_set("feature_sk")).cast("bigint").alias("distinct_features_used"),
    ]
    aggs += [F.min(c).alias(c) for c in keep]
    out = fact.groupBy(F.col("event_timestamp").cast("date").alias("activity_date"), "user_sk").agg(*aggs)
    return out.select("activity_date", "user_sk", *map(_integer, DAILY_METRICS), *keep,
                      now.alias("created_at"), now.alias("updated_at"))


def touched_days(new_facts: DataFrame) -> DataFrame:
    """Event days of new facts (``_day``): at most one row per calendar
    day, a fixed bound."""
    day = F.col("event_date") if "event_date" in new_facts.columns else F.col("event_timestamp").cast("date")
    return new_facts.select(day.alias("_day")).distinct()


def month_of_day(day):
    return F.date_format(day, "yyyy-MM")


def refresh_daily(fact: DataFrame, previous: DataFrame | None, new_facts: DataFrame,
                  now: Column | None = None) -> DataFrame:
    """Recompute the daily fact only for the days touched by new facts
    and upsert it into the previous daily rows of the touched months (C9
    semantics: metrics replaced, created_at kept, nothing deleted).

    Returns every row of the touched months (untouched days kept), so a
    dynamic partition overwrite of the month partitions leaves every other
    month's files untouched. On stored layers the semi-joins are on the
    partition columns (event day, activity month) with broadcast lists
    bounded by the calendar, so only the touched days of facts and the
    touched months of daily rows are read."""
    days = F.broadcast(touched_days(new_facts))
    fact_day = F.col("event_date") if "event_date" in fact.columns else F.col("event_timestamp").cast("date")
    scoped = fact.join(days, fact_day == F.col("_day"), "left_semi")
    fresh = build_daily(scoped, now)
    prev = None
    if previous is not None:
        months = F.broadcast(touched_days(new_facts).select(month_of_day(F.col("_day")).alias("_month")).distinct())
        prev_month = F.col("activity_month") if "activity_month" in previous.columns \
            else month_of_day(F.col("activity_date"))
        prev = previous.join(months, prev_month == F.col("_month"), "left_semi")
    return upsert(prev, fresh.drop("created_at", "updated_at"), ["activity_date", "user_sk"], DAILY_METRICS, now)
