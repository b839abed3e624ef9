"""The query catalog: one callable per operator, ``(spark, sf_dir) ->
DataFrame``, each over the whole given tables.

Outputs carry natural keys (user_id, document_id) instead of surrogate
keys, integers as BIGINT and rounded ratios as DOUBLE, so they compare
directly with the oracle SQL in ``starloom.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.inet import is_inet
from starloom.operators import dims, facts, marts, profile, quality, reports, staging
from starloom.plans import daily_load
from starloom.plans.warehouse import BROKEN_EVERY, EARLY_CUTOFF, Warehouse, number_of
from starloom.schemas import CALENDAR_MONTHS, NOT_NULL, UNIQUE_KEYS, VARCHAR_LIMITS
from starloom.session import scratch_path
from starloom.sources.layers import read_layer
from starloom.sources.raw import ingest_raw, raw_inventory, stamp_batch
from starloom.streaming import ingest as stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _out(df: DataFrame) -> DataFrame:
    """Integers as BIGINT, decimals as DOUBLE (after their exact rounding)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def query(name: str):
    def deco(fn: Callable[[Warehouse], DataFrame]) -> Callable:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return _out(fn(Warehouse(spark, sf_dir)))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return deco


# ---------------------------------------------------------------- sources
@query("raw_ingest")
def _raw_ingest(w: Warehouse) -> DataFrame:
    """A1: the whole delivery arrives twice (in-batch repeats) after the
    early batches were loaded: only the later events are inserted, once."""
    delivery = w.raw.unionByName(w.raw)
    return ingest_raw(delivery.select("event_id", "raw_payload", "batch_id"), w.raw_early) \
        .select("event_id", "batch_id")


@query("raw_payload_json")
def _raw_payload_json(w: Warehouse) -> DataFrame:
    """A2: the serialized payload, read back field by field."""
    p = F.col("raw_payload")
    j = lambda path: F.get_json_object(p, path)
    return w.raw.select(
        "event_id", "batch_id",
        j("$.event_type").alias("event_type"),
        j("$.event_timestamp").alias("event_timestamp_text"),
        j("$.user_id").alias("user_id"),
        j("$.properties.document_id").alias("document_id"),
        F.coalesce(j("$.properties.edit_duration_sec"), j("$.properties.duration_sec")).cast("bigint")
        .alias("duration_seconds"),
        j("$.properties.feature_name").alias("feature_name"),
        j("$.context.platform").alias("platform"),
        j("$.context.ip_address").alias("ip_address"),
    )


@query("batch_stamp")
def _batch_stamp(w: Warehouse) -> DataFrame:
    """A3: stamp events with the batch id of their event day."""
    stamped = stamp_batch(w.staging.select("event_id", "event_timestamp"),
                          day=F.col("event_timestamp").cast("date"))
    return stamped.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n_events"))


@query("batch_inventory")
def _batch_inventory(w: Warehouse) -> DataFrame:
    """Raw rows per batch and payload event type."""
    return raw_inventory(w.raw)


# ---------------------------------------------------------------- staging
@query("staging_parse")
def _staging_parse(w: Warehouse) -> DataFrame:
    """B1: top-level fields, timestamp cast."""
    return w.staging.select("event_id", "event_type", "event_timestamp", "user_id", "session_id", "batch_id")


@query("staging_nested")
def _staging_nested(w: Warehouse) -> DataFrame:
    """B2: properties.* and context.* fields."""
    return w.staging.select("event_id", "document_id", "feature_id", "platform", "user_agent", "ip_address")


@query("staging_duration")
def _staging_duration(w: Warehouse) -> DataFrame:
    """Duration from edit_duration_sec or duration_sec."""
    return w.staging.select("event_id", "event_type", "duration_seconds")


@query("staging_casts")
def _staging_casts(w: Warehouse) -> DataFrame:
    """Strict TIMESTAMP / INTEGER casts."""
    return w.staging.select("event_id", "event_timestamp", "duration_seconds", "characters_added")


@query("staging_properties")
def _staging_properties(w: Warehouse) -> DataFrame:
    """The kept properties object, read back."""
    p = F.col("properties")
    return w.staging.select(
        "event_id",
        F.get_json_object(p, "$.document_id").alias("prop_document_id"),
        F.get_json_object(p, "$.feature_name").alias("prop_feature_name"),
        F.get_json_object(p, "$.plan").alias("prop_plan"),
        F.get_json_object(p, "$.billing_cycle").alias("prop_billing_cycle"),
        F.get_json_object(p, "$.reason").alias("prop_reason"))


@query("ip_valid")
def _ip_valid(w: Warehouse) -> DataFrame:
    """Address validity per event, invalid addresses included."""
    return w.staging_broken.select("event_id", "ip_address", is_inet(F.col("ip_address")).alias("ip_valid"))


@query("staging_increment")
def _staging_increment(w: Warehouse) -> DataFrame:
    """After the early batches are staged, a run over all of raw stages
    only the rest."""
    return staging.new_events(staging.parse_events(w.raw), w.staging_early, ids=staging.payload_ids(w.raw)).select("event_id", "batch_id")


@query("staging_contract")
def _staging_contract(w: Warehouse) -> DataFrame:
    """NOT NULL and key rules of staging, as violation counts of broken events."""
    return staging.contract_report(w.staging_broken)


@query("staging_quarantine")
def _staging_quarantine(w: Warehouse) -> DataFrame:
    """Good rows vs rejects per reason, over broken events."""
    good, rejects = staging.split_valid(w.raw_broken)
    return staging.quarantine_summary(good, rejects)


# ------------------------------------------------------------- dimensions
@query("dim_date")
def _dim_date(w: Warehouse) -> DataFrame:
    """The whole calendar, with the number of event facts of each day."""
    used = w.fact_events.groupBy("date_key").agg(F.count(F.lit(1)).alias("n_events"))
    return w.dim_date.join(used, "date_key", "left").withColumn("n_events", F.coalesce("n_events", F.lit(0)))


@query("dim_features")
def _dim_features(w: Warehouse) -> DataFrame:
    """The seeded features with their keys and how often the facts
    use them (0 for unused ones)."""
    uses = w.fact_events.where(F.col("feature_sk").isNotNull()).groupBy("feature_sk") \
        .agg(F.count(F.lit(1)).alias("n_events"))
    return w.dim_features.join(uses, "feature_sk", "left").select(
        "feature_sk", "feature_id", "feature_name", "feature_category", "is_premium",
        F.coalesce("n_events", F.lit(0)).alias("n_events"))


@query("dim_users")
def _dim_users(w: Warehouse) -> DataFrame:
    """C2."""
    return w.dim_users.select("user_id", "email", "signup_date", "current_plan", "account_status", "is_current")


@query("dim_documents")
def _dim_documents(w: Warehouse) -> DataFrame:
    """C4."""
    return w.dim_documents.select("document_id", "title", "owner_user_id", "created_at")


@query("surrogate_keys")
def _surrogate_keys(w: Warehouse) -> DataFrame:
    """Keys are unique and dense (1..n) per dimension."""
    def stats(df: DataFrame, name: str, natural: str, sk: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(natural).alias("n_keys"),
                      F.min(sk).alias("min_key"), F.max(sk).alias("max_key")) \
            .select(F.lit(name).alias("dimension"), "n_rows", "n_keys", "min_key", "max_key")
    return stats(w.dim_users, "dim_users", "user_id", "user_sk").unionByName(
        stats(w.dim_documents, "dim_documents", "document_id", "document_sk"))


@query("dim_users_scd2")
def _dim_users_scd2(w: Warehouse) -> DataFrame:
    """Every user version after applying the subscription changes."""
    users = w.dim_users
    start = users.agg(F.max("user_sk")).first()[0] or 0
    out = dims.apply_scd2(users, profile.plan_changes(w.staging), start)
    return out.select("user_id", "current_plan", "account_status", "is_current", "effective_date", "end_date")


# ------------------------------------------------------------------ facts
@query("fact_events")
def _fact_events(w: Warehouse) -> DataFrame:
    """C6 with natural keys next to the key flags."""
    f = w.fact_for(w.staging, keep=("user_id", "document_id", "feature_id"))
    return f.select(
        "event_id", "user_id", "document_id", "feature_id",
        F.col("document_sk").isNotNull().alias("has_document_key"),
        F.col("feature_sk").isNotNull().alias("has_feature_key"),
        "date_key", "event_type", "session_id", "platform", "event_timestamp", "duration_seconds",
        "characters_added")


@query("fact_events_dropped")
def _fact_events_dropped(w: Warehouse) -> DataFrame:
    """C6f over product events plus the 1995-2001 order stream; users whose
    number leaves 3 when divided by 7 have no current row."""
    stg = w.staging_with_orders
    users = dims.build_dim_users(stg, effective_from_first_event=True).withColumn("is_current", number_of("user_id") % 7 != 3)
    return facts.explain_dropped(stg, users, w.dim_date)


def _daily_out(w: Warehouse, daily: DataFrame) -> DataFrame:
    return w.with_user_id(daily).select(
        "activity_date", "user_id", "total_events", "login_count", "documents_edited", "documents_created",
        "total_active_seconds", "distinct_features_used", *[c for c in ("_action",) if c in daily.columns])


@query("fact_daily_user_activity")
def _daily(w: Warehouse) -> DataFrame:
    """C7."""
    return _daily_out(w, w.daily)


@query("daily_upsert")
def _daily_upsert(w: Warehouse) -> DataFrame:
    """The daily rows of the early load, upserted with a rerun over all
    facts: metrics replaced, new keys inserted."""
    early = facts.build_daily(w.fact_for(w.staging_early))
    merged = facts.upsert(early, w.daily.drop("created_at", "updated_at"), ["activity_date", "user_sk"],
                          facts.DAILY_METRICS)
    return _daily_out(w, merged).withColumnRenamed("_action", "action")


@query("daily_incremental")
def _daily_incremental(w: Warehouse) -> DataFrame:
    """The early daily table refreshed month by month with the late
    facts: equals a full rebuild."""
    stored = w.fact_for(w.staging, keep=("batch_id",))
    stored = w._materialize(stored, "facts", stored.schema)  # as a load stores them: built once, read by every branch
    early = facts.build_daily(stored.where(F.col("batch_id") <= EARLY_CUTOFF))
    late = stored.where(F.col("batch_id") > EARLY_CUTOFF)
    refreshed = facts.refresh_daily(stored, early, late).drop("_action")
    months = facts.touched_days(late).select(facts.month_of_day(F.col("_day")).alias("_month")).distinct()
    untouched = early.join(F.broadcast(months), facts.month_of_day(F.col("activity_date")) == F.col("_month"),
                           "left_anti")
    cols = ["activity_date", "user_sk", *facts.DAILY_METRICS]
    return _daily_out(w, untouched.select(*cols).unionByName(refreshed.select(*cols)))


# ------------------------------------------------------------------ views
@query("retention_cohorts")
def _retention(w: Warehouse) -> DataFrame:
    """D1a (as written)."""
    return w.retention


@query("retention_cohorts_true")
def _retention_true(w: Warehouse) -> DataFrame:
    """D1b (cohort-size denominator)."""
    return w.retention_true


@query("feature_adoption_funnel")
def _funnel(w: Warehouse) -> DataFrame:
    """D2."""
    return w.funnel


@query("churn_risk_scores")
def _churn(w: Warehouse) -> DataFrame:
    """D3."""
    return w.churn.drop("user_sk")


@query("key_stability")
def _key_stability(w: Warehouse) -> DataFrame:
    """Churn by user_id over all user versions (two loads with an SCD2
    step between them)."""
    users_all, daily = w.two_load_scenario()
    return marts.churn_risk(users_all, daily, w.as_of, by="user_id")


# ---------------------------------------------------------------- reports
@query("feature_avg_uses")
def _feature_avg_uses(w: Warehouse) -> DataFrame:
    """E1."""
    return reports.feature_avg_uses(w.funnel)


@query("churn_distribution")
def _churn_distribution(w: Warehouse) -> DataFrame:
    """E2."""
    return reports.churn_distribution(w.churn)


@query("dau_trend")
def _dau_trend(w: Warehouse) -> DataFrame:
    """E3."""
    return reports.dau_trend(w.daily, w.as_of)


def _layer_counts(w: Warehouse) -> DataFrame:
    return reports.layer_counts(w.raw, w.staging, w.fact_events)


@query("layer_counts")
def _layers(w: Warehouse) -> DataFrame:
    """E4."""
    return _layer_counts(w)


@query("layer_pct_first")
def _layer_pct_first(w: Warehouse) -> DataFrame:
    """E5a."""
    return reports.layer_pct_first(_layer_counts(w))


@query("layer_pct_of_raw")
def _layer_pct_of_raw(w: Warehouse) -> DataFrame:
    """E5b."""
    return reports.layer_pct_of_raw(_layer_counts(w))


@query("duplicate_events")
def _duplicate_events(w: Warehouse) -> DataFrame:
    """E6, over broken events."""
    return reports.duplicate_events(w.staging_broken)


@query("table_counts")
def _table_counts(w: Warehouse) -> DataFrame:
    """E7."""
    return reports.table_counts(w.dim_date, w.fact_events, w.funnel)


@query("total_users")
def _total_users(w: Warehouse) -> DataFrame:
    """E8."""
    return reports.total_users(w.dim_users)


@query("retention_matrix")
def _retention_matrix(w: Warehouse) -> DataFrame:
    """Cohorts x months since signup (D1b rates)."""
    return reports.retention_matrix(w.retention_true, list(range(CALENDAR_MONTHS)))


# ---------------------------------------------------------------- quality
def _tables(w: Warehouse) -> dict[str, DataFrame]:
    """Every table that rules are declared for."""
    return {"raw_events": w.raw_broken, "staging_events": w.staging_broken, "dim_users": w.dim_users, "dim_documents": w.dim_documents,
            "dim_features": w.dim_features, "dim_date": w.dim_date, "fact_events": w.keyed_fact_events,
            "fact_daily_user_activity": w.daily, "user_retention_cohorts": w.retention,
            "feature_adoption_funnel": w.funnel, "churn_risk_scores": w.churn}


@query("chk_not_null")
def _chk_not_null(w: Warehouse) -> DataFrame:
    """G1: every declared NOT NULL column; raw and staging hold broken events."""
    t = _tables(w)
    return _union([quality.chk_not_null(t[name], name) for name in NOT_NULL])


@query("chk_unique")
def _chk_unique(w: Warehouse) -> DataFrame:
    """Every declared key; raw and staging hold broken events."""
    t = _tables(w)
    return _union([quality.chk_unique(t[name], name, keys) for name, all_keys in UNIQUE_KEYS.items() for keys in all_keys])


@query("chk_one_current")
def _chk_one_current(w: Warehouse) -> DataFrame:
    """G3, with a second current row of every tenth user."""
    users = w.dim_users
    return quality.chk_one_current(users.unionByName(users.where(number_of("user_id") % 10 == 1)))


@query("chk_foreign_keys")
def _chk_foreign_keys(w: Warehouse) -> DataFrame:
    """G4, against dimensions that lack some of their rows."""
    f = w.fact_events
    users = w.dim_users.where(number_of("user_id") % 10 != 2)
    docs = w.dim_documents.where(number_of("document_id") % 10 != 3)
    features, dates = w.dim_features.where("feature_id <> 'comments'"), w.dim_date.where("month <> 2")
    checks = [
        quality.chk_foreign_key(f, "fact_events", "user_sk", users, "user_sk", False),
        quality.chk_foreign_key(f, "fact_events", "document_sk", docs, "document_sk", True),
        quality.chk_foreign_key(f, "fact_events", "feature_sk", features, "feature_sk", True),
        quality.chk_foreign_key(f, "fact_events", "date_key", dates, "date_key", False),
        quality.chk_foreign_key(w.daily, "fact_daily_user_activity", "user_sk", users, "user_sk", False),
    ]
    return _union(checks)


@query("chk_lengths")
def _chk_lengths(w: Warehouse) -> DataFrame:
    """Every declared limit; raw and staging hold broken events."""
    t = _tables(w)
    return _union([quality.chk_lengths(t[name], name) for name in VARCHAR_LIMITS])


@query("chk_reconcile")
def _chk_reconcile(w: Warehouse) -> DataFrame:
    """G6, with some facts lost after the daily rows were made."""
    kept = w.fact_events.where(number_of("event_id") % BROKEN_EVERY != 0)
    return quality.chk_reconcile(kept, w.daily)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --------------------------------------------------------------- profiles
@query("event_mix")
def _event_mix(w: Warehouse) -> DataFrame:
    """X1."""
    return profile.event_mix(w.staging)


@query("platform_mix")
def _platform_mix(w: Warehouse) -> DataFrame:
    """X2."""
    return profile.platform_mix(w.staging)


@query("hour_profile")
def _hour_profile(w: Warehouse) -> DataFrame:
    """X3."""
    return profile.hour_profile(w.staging)


@query("volume_trend")
def _volume_trend(w: Warehouse) -> DataFrame:
    """X4."""
    return profile.volume_trend(w.fact_events, w.dim_date)


@query("session_rollup")
def _session_rollup(w: Warehouse) -> DataFrame:
    """X5."""
    return profile.session_rollup(w.staging)


@query("subscription_lifecycle")
def _subscription_lifecycle(w: Warehouse) -> DataFrame:
    """X6."""
    return profile.subscription_lifecycle(w.staging)


@query("plan_history")
def _plan_history(w: Warehouse) -> DataFrame:
    """X7."""
    return profile.plan_history(w.staging)


# ----------------------------------------------- streaming and daily load
@query("stream_ingest")
def _stream_ingest(w: Warehouse) -> DataFrame:
    """Land the early batches, stream; land everything again (repeats
    included), stream again; read staging back."""
    spark = w.spark
    base = scratch_path(spark, "stream")
    landing, raw_root, core_root = f"{base}/landing", f"{base}/raw", f"{base}/core"
    raw = w.raw.select("event_id", "raw_payload", "batch_id")
    stream.land(raw.where(F.col("batch_id") <= EARLY_CUTOFF), landing)
    stream.stream_ingest(spark, landing, raw_root, core_root, f"{base}/checkpoint")
    stream.land(raw, landing)
    stream.stream_ingest(spark, landing, raw_root, core_root, f"{base}/checkpoint")
    return read_layer(spark, core_root, "staging_events").select("event_id", "batch_id", "event_type", "user_id")


def _run_two_loads(w: Warehouse) -> tuple[str, str, daily_load.RunSummary]:
    spark = w.spark
    base = scratch_path(spark, "daily-load")
    raw_root, core_root = f"{base}/raw", f"{base}/core"
    raw = w.raw.select("event_id", "raw_payload", "batch_id")
    s1 = daily_load.run_load(spark, raw_root, core_root, raw.where(F.col("batch_id") <= EARLY_CUTOFF), w.as_of)
    s2 = daily_load.run_load(spark, raw_root, core_root, raw, w.as_of)
    total = daily_load.RunSummary({k: s1.rows.get(k, 0) + s2.rows.get(k, 0) for k in set(s1.rows) | set(s2.rows)})
    return raw_root, core_root, total


@query("daily_load")
def _daily_load(w: Warehouse) -> DataFrame:
    """H1: two stored runs (early batches, then the whole delivery again);
    rows per stored table, read back."""
    raw_root, core_root, _ = _run_two_loads(w)
    return daily_load.layer_counts(w.spark, raw_root, core_root)


@query("reset_rebuild")
def _reset_rebuild(w: Warehouse) -> DataFrame:
    """H2: downstream layers rebuilt under a new core root from the kept raw
    layer; rows per stored table."""
    raw_root, core_root, _ = _run_two_loads(w)
    fresh = daily_load.new_core_root(core_root.rsplit("/", 1)[0])
    daily_load.run_load(w.spark, raw_root, fresh, None, w.as_of)
    return daily_load.layer_counts(w.spark, raw_root, fresh)


@query("stored_user_versions")
def _stored_user_versions(w: Warehouse) -> DataFrame:
    """C3 in the stored load: user versions after a load that applies the
    subscription events, and a rerun of it that must add nothing."""
    base = scratch_path(w.spark, "versions-load")
    raw = w.raw.select("event_id", "raw_payload", "batch_id")
    for _ in range(2):
        daily_load.run_load(w.spark, f"{base}/raw", f"{base}/core", raw, w.as_of, apply_plan_changes=True)
    return read_layer(w.spark, f"{base}/core", "dim_users").select(
        "user_id", "current_plan", "account_status", "is_current", "effective_date", "end_date")


@query("run_summary")
def _run_summary(w: Warehouse) -> DataFrame:
    """H3: rows written per table over the two runs, every step of them, from
    the writes' observed metrics."""
    _, _, total = _run_two_loads(w)
    return total.to_df(w.spark).withColumnRenamed("step", "table_name")
