"""H1-H3: the stored, idempotent daily run.

Order: raw ingest -> staging -> dimensions (dates, features, users,
documents) -> event facts -> daily facts (touched months only) -> the three
views. Each step is one Spark write; state passes only through the stored
tables, so re-running any step (or the whole run) writes nothing new.

Layout: ``<raw_root>/raw_events`` holds the immutable raw layer;
``<core_root>/`` holds staging, core and analytics. A reset (H2) starts a new
versioned core root and keeps raw.
"""

from __future__ import annotations

import datetime as _dt
import os
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators import dims, facts, marts, profile, staging
from starloom.plans import quality_log
from starloom.schemas import FOREIGN_KEYS, NOT_NULL, UNIQUE_KEYS, VARCHAR_LIMITS
from starloom.session import configure
from starloom.sources.layers import (
    current,
    exists,
    maximum,
    position,
    read_keys,
    read_layer,
    since,
    vacuum,
    write_layer,
)
from starloom.sources.raw import ingest_raw
from starloom.streaming.ingest import store_rejects

VIEWS = ("user_retention_cohorts", "feature_adoption_funnel", "churn_risk_scores")
#: Tables that every run writes, in the order of its steps.
STEPS = ("raw_events", "staging_events", "dim_date", "dim_features", "dim_users", "dim_documents", "fact_events",
         "fact_daily_user_activity", "feature_user_usage", "user_activity", "user_month_activity", *VIEWS, "churn_risk_by_user")


@dataclass
class RunSummary:
    """H3: rows written per step in one run (true counts, from observed
    metrics of the writes themselves)."""

    rows: dict[str, int] = field(default_factory=dict)
    seconds: dict[str, float] = field(default_factory=dict)

    def to_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(sorted(self.rows.items()), "step string, n_rows bigint")


def _write(df: DataFrame, root: str, table: str, mode: str, summary: RunSummary, sources: dict[str, int] | None = None) -> None:
    t0 = time.perf_counter()
    n = write_layer(df, root, table, mode, sources)
    summary.rows[table] = summary.rows.get(table, 0) + n
    summary.seconds[table] = round(summary.seconds.get(table, 0.0) + time.perf_counter() - t0, 3)


def new_core_root(base: str) -> str:
    """H2: a fresh versioned core root (downstream layers empty, keys
    restart at 1); raw stays where it is."""
    return os.path.join(base, f"core-{_dt.datetime.now(_dt.timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:6]}")


def run_load(spark: SparkSession, raw_root: str, core_root: str, incoming: DataFrame | None = None,
             as_of: _dt.date | str | None = None, apply_plan_changes: bool = False,
             quarantine: bool = False) -> RunSummary:
    """H1: one full run. ``incoming``: (event_id, raw_payload, batch_id)
    rows delivered since the last run (may repeat old ones).

    ``apply_plan_changes``: after the user rows are inserted, the increment's
    subscription events version the user dimension (C3 fed by X7) before
    facts bind the current versions; off by default, as in the reference,
    where every user stays on the default plan.

    ``quarantine``: events that fail parsing or validation go to the
    ``staging_rejects`` table with their reasons (B9) instead of failing the
    load (the default, as the reference's statement fails)."""
    configure(spark)
    summary = RunSummary()
    as_of = as_of or _dt.date.today()

    # A1: raw, exactly once per event_id.
    if incoming is not None:
        if quarantine:
            delivered, undeliverable = staging.split_deliverable(incoming)
            summary.rows["staging_rejects"] = store_rejects(undeliverable, core_root)
        else:
            delivered = staging.checked_delivery(incoming.select("event_id", "raw_payload", "batch_id"))
        new_raw = ingest_raw(delivered, read_keys(spark, raw_root, "raw_events"))
        _write(new_raw.withColumn("loaded_at", F.localtimestamp()), raw_root, "raw_events", "append", summary)
    if not exists(spark, raw_root, "raw_events"):
        return summary
    for table in STEPS[1:]:
        summary.rows.setdefault(table, 0)

    # B: typed staging rows for payload ids not staged yet (strict). Only the
    # raw loads that staging has not read are parsed; the position is committed with the rows.
    found = since(spark, raw_root, "raw_events", position(spark, core_root, "staging_events", "raw_events"))
    if found is not None:
        candidates, number = found
        staged = read_keys(spark, core_root, "staging_events")
        if quarantine:
            new_stg, rejects = staging.split_valid(candidates, staged)
            summary.rows["staging_rejects"] = summary.rows.get("staging_rejects", 0) + store_rejects(rejects, core_root)
        else:
            # A repeated payload id fails the write of the key index, before the commit.
            new_stg = staging.new_events(staging.parse_events(candidates), staged, strict_unique=False, ids=staging.payload_ids(candidates))
        _write(new_stg, core_root, "staging_events", "append", summary, {"raw_events": number})
    if not exists(spark, core_root, "staging_events"):
        return summary

    # The increment of this load: what the facts have not read of staging,
    # whoever wrote it. A user or document without a row has all its staging
    # rows in here - every earlier load inserted rows for everything it took in -
    # so the dimensions aggregate the increment only.
    found = since(spark, core_root, "staging_events", position(spark, core_root, "fact_events", "staging_events"))

    # Dimensions, insert-if-absent with keys after the max.
    # They do not depend on each other, so their jobs run side by side.
    def load_dates():
        prev = read_layer(spark, core_root, "dim_date")
        _write(dims.build_dim_date(spark, existing=prev), core_root, "dim_date", "append", summary)

    def load_features():
        prev = read_layer(spark, core_root, "dim_features")
        _write(dims.build_dim_features(spark, prev), core_root, "dim_features", "append", summary)

    def load_users():
        prev = read_layer(spark, core_root, "dim_users")
        # Versions are dated by first event when changes, which carry event time, may follow.
        new = dims.build_dim_users(found[0], prev, start=maximum(spark, core_root, "dim_users"),
                                   effective_from_first_event=apply_plan_changes)
        _write(new, core_root, "dim_users", "append", summary)

    def load_documents():
        prev = read_layer(spark, core_root, "dim_documents")
        new = dims.build_dim_documents(found[0], prev, start=maximum(spark, core_root, "dim_documents"))
        _write(new, core_root, "dim_documents", "append", summary)

    _side_by_side(spark, load_dates, load_features, *([load_users, load_documents] if found else []))

    if apply_plan_changes:
        version_users(spark, core_root, summary)
    users = read_layer(spark, core_root, "dim_users")
    features = read_layer(spark, core_root, "dim_features")
    if found:
        load_facts(spark, core_root, found, users, features, summary)
    fact = read_layer(spark, core_root, "fact_events")

    # Daily facts; only the days of facts that no daily refresh
    # has read are recomputed, so facts of a load that stopped before this
    # step are picked up by the next one.
    added = since(spark, core_root, "fact_events", position(spark, core_root, "fact_daily_user_activity", "fact_events"))
    daily_prev = read_layer(spark, core_root, "fact_daily_user_activity")
    if daily_prev is None:
        _write(facts.build_daily(fact), core_root, "fact_daily_user_activity", "overwrite", summary,
               {"fact_events": added[1] if added else 0})
    elif added:
        refreshed = facts.refresh_daily(fact, daily_prev, added[0]).drop("_action")
        _write(refreshed, core_root, "fact_daily_user_activity", "partitions", summary, {"fact_events": added[1]})

    # Rollups of the append-only facts: each load adds one of its own facts,
    # the views below merge them, so nothing here reads history.
    rollups: dict[str, DataFrame] = {}
    _side_by_side(spark, *[(lambda n=n: rollups.update({n: maintain_rollup(spark, core_root, n, summary)})) for n in ROLLUPS])

    # The views from the rollups, each replaced by one commit.
    views = {
        "user_retention_cohorts": marts.retention_cohorts(users, rollups["user_month_activity"], "group"),
        "feature_adoption_funnel": marts.funnel_from_rollup(rollups["feature_user_usage"], features),
        "churn_risk_scores": marts.churn_risk(users, rollups["user_activity"], as_of),
        # The same per user over all versions (activity of closed
        # versions kept); equals D3 while no user row was ever closed.
        "churn_risk_by_user": marts.churn_risk(users, rollups["user_activity"], as_of, by="user_id"),
    }
    _side_by_side(spark, *[(lambda n=name, d=df: _write(d, core_root, n, "overwrite", summary)) for name, df in views.items()])
    for table in (*views, *ROLLUPS, "fact_daily_user_activity", "dim_users"):
        vacuum(spark, core_root, table)
    return summary


def version_users(spark: SparkSession, core_root: str, summary: RunSummary) -> None:
    """C3 in the stored load: staging's subscription events go to the change
    log, and those that the user versions have not read are applied."""
    new = since(spark, core_root, "staging_events", position(spark, core_root, "user_changes", "staging_events"))
    if new is not None:
        _write(profile.plan_changes(new[0]), core_root, "user_changes", "append", RunSummary(), {"staging_events": new[1]})
    new = since(spark, core_root, "user_changes", position(spark, core_root, "dim_users", "user_changes"))
    if new is not None:
        versioned = dims.apply_scd2(read_layer(spark, core_root, "dim_users"), new[0], maximum(spark, core_root, "dim_users"),
                                    earlier=read_layer(spark, core_root, "user_changes"))
        _write(versioned, core_root, "dim_users", "overwrite", RunSummary(), {"user_changes": new[1]})
    summary.rows["dim_users_versions"] = read_layer(spark, core_root, "dim_users").count()


def load_facts(spark: SparkSession, core_root: str, found: tuple[DataFrame, int], users: DataFrame, features: DataFrame,
               summary: RunSummary) -> None:
    """Facts for the increment, and for earlier rows whose date has come
    into the calendar since. Rows outside of it are kept aside in
    ``staging_unplaced`` and retried from there; staging itself is not read again."""
    increment, number = found
    dates = read_layer(spark, core_root, "dim_date")
    lo, hi = dates.agg(F.min("full_date"), F.max("full_date")).first()
    placed = (F.col("event_timestamp") >= F.lit(lo).cast("timestamp_ntz")) & \
        (F.col("event_timestamp") < F.date_add(F.lit(hi), 1).cast("timestamp_ntz"))
    waiting = read_layer(spark, core_root, "staging_unplaced")
    aside = since(spark, core_root, "staging_events", position(spark, core_root, "staging_unplaced", "staging_events"))
    if aside is not None:
        _write(aside[0].where(~placed), core_root, "staging_unplaced", "append", RunSummary(), {"staging_events": aside[1]})
    rows = increment.drop("event_month")
    if waiting is not None:
        rows = rows.unionByName(waiting.where(placed))
    new_facts = facts.build_fact_events(rows, users, read_layer(spark, core_root, "dim_documents"), features, dates,
                                        existing=read_keys(spark, core_root, "fact_events"), event_keys=True,
                                        start=maximum(spark, core_root, "fact_events"))
    _write(new_facts, core_root, "fact_events", "append", summary, {"staging_events": number})


#: Rollups of the facts: what a load adds, and how its parts are merged.
ROLLUPS = {
    "feature_user_usage": (marts.feature_user_rollup, marts.merge_feature_rollup),
    "user_activity": (marts.user_activity_rollup, marts.merge_user_activity),
    "user_month_activity": (marts.user_month_activity, marts.merge_user_months),
}
#: Parts of a rollup that are merged into one.
ROLLUP_PARTS = 16


def read_rollup(spark: SparkSession, core_root: str, table: str) -> DataFrame:
    """A rollup of all facts that it has read: its parts, merged."""
    return ROLLUPS[table][1](read_layer(spark, core_root, table))


def maintain_rollup(spark: SparkSession, core_root: str, table: str, summary: RunSummary) -> DataFrame:
    """A rollup of all facts, kept current by adding the rollup of the facts
    that it has not read; its position is committed with those rows, so a stop in
    between cannot skip or count facts twice. Now and then its parts are merged."""
    new = since(spark, core_root, "fact_events", position(spark, core_root, table, "fact_events"))
    if new is not None:
        _write(ROLLUPS[table][0](new[0]), core_root, table, "append", summary, {"fact_events": new[1]})
    elif not exists(spark, core_root, table):
        _write(ROLLUPS[table][0](read_layer(spark, core_root, "fact_events")), core_root, table, "append", summary)
    if len(current(spark, core_root, table).loads) > ROLLUP_PARTS:
        _write(read_rollup(spark, core_root, table), core_root, table, "overwrite", RunSummary())
    return read_rollup(spark, core_root, table)


_INHERITED = ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel", "spark.scheduler.pool")


def _side_by_side(spark: SparkSession, *steps) -> None:
    """Run independent steps as concurrent Spark jobs (the scheduler shares
    the executors between them); the caller's job group and pool carry over
    to the step threads; the first failure is raised."""
    sc = spark.sparkContext
    props = {k: sc.getLocalProperty(k) for k in _INHERITED}

    def run(step):
        for k, v in props.items():
            if v is not None:
                sc.setLocalProperty(k, v)
        return step()

    with ThreadPoolExecutor(max_workers=len(steps)) as pool:
        for f in [pool.submit(run, step) for step in steps]:
            f.result()


def layer_counts(spark: SparkSession, raw_root: str, core_root: str) -> DataFrame:
    """Rows per stored table, read back from storage (rollups merged), in one
    aggregation over all of them."""
    found = []
    for table in STEPS:
        if table in ROLLUPS:
            df = read_rollup(spark, core_root, table) if exists(spark, core_root, table) else None
        else:
            df = read_layer(spark, raw_root if table == "raw_events" else core_root, table)
        if df is not None:
            found.append((table, df))
    out = spark.createDataFrame([(table, 0) for table, _ in found], "table_name string, one bigint")  # empty tables count 0
    for table, df in found:
        out = out.unionByName(df.select(F.lit(table).alias("table_name"), F.lit(1).cast("bigint").alias("one")))
    return out.groupBy("table_name").agg(F.sum("one").alias("n_rows"))


def quality_report(spark: SparkSession, raw_root: str, core_root: str) -> DataFrame:
    """G1-G6 over the stored layers, raw and views included: one row per rule
    with its violation count (all 0 after a good run)."""
    from starloom.operators import quality

    t = {name: read_layer(spark, raw_root if name == "raw_events" else core_root, name)
         for name in dict.fromkeys([*NOT_NULL, *UNIQUE_KEYS, *VARCHAR_LIMITS])}
    checks = []
    for name, df in t.items():
        if name in NOT_NULL:
            checks.append(quality.chk_not_null(df, name))
        for keys in UNIQUE_KEYS.get(name, []):
            checks.append(quality.chk_unique(df, name, keys))
        if name in VARCHAR_LIMITS:
            checks.append(quality.chk_lengths(df, name))
    checks.append(quality.chk_one_current(t["dim_users"]))
    for child, col, parent, pcol, nullable in FOREIGN_KEYS:
        checks.append(quality.chk_foreign_key(t[child], child, col, t[parent], pcol, nullable))
    rec = quality.chk_reconcile(t["fact_events"], t["fact_daily_user_activity"])
    checks.append(rec.agg(F.count_if(F.col("difference") != 0).cast("bigint").alias("violations")).select(
        F.lit("fact_daily_user_activity").alias("table_name"), F.lit("reconcile").alias("rule"),
        F.lit("total_events").alias("column_name"), "violations"))
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out


def main(argv: list[str] | None = None) -> int:
    """Command line: load landed JSON-lines events (event_id, raw_payload,
    batch_id) into the warehouse once, print the run summary as JSON."""
    import argparse
    import json

    from starloom.session import build_session
    from starloom.streaming.ingest import LANDING_SCHEMA

    p = argparse.ArgumentParser(prog="python -m starloom.plans.daily_load", description=main.__doc__)
    p.add_argument("--landing", help="folder of landed JSON-lines events (omit to rebuild from raw)")
    p.add_argument("--raw-root", required=True)
    p.add_argument("--core-root", required=True)
    p.add_argument("--as-of", help="reference date of the churn view (default: today)")
    p.add_argument("--master", help="e.g. local[*] (default: what spark-submit or the cluster set)")
    p.add_argument("--apply-plan-changes", action="store_true")
    p.add_argument("--quarantine", action="store_true", help="set invalid events aside instead of failing")
    p.add_argument("--check", action="store_true", help="also run the quality report; exit 1 on violations")
    p.add_argument("--check-new", action="store_true", help="the same, reading of the event layers only what no such report has read")
    a = p.parse_args(argv)
    spark = build_session(master=a.master)
    incoming = spark.read.schema(LANDING_SCHEMA).json(a.landing) if a.landing else None
    summary = run_load(spark, a.raw_root, a.core_root, incoming, a.as_of, a.apply_plan_changes, a.quarantine)
    out = {"rows": summary.rows, "seconds": summary.seconds}
    failing = 0
    if a.check or a.check_new:
        made = quality_log.report if a.check_new else quality_report
        failing = made(spark, a.raw_root, a.core_root).where("violations != 0").count()
        out["quality_violations"] = failing
    print(json.dumps(out))
    return 1 if failing else 0


if __name__ == "__main__":
    raise SystemExit(main())
