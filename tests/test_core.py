import datetime as dt

from pyspark.sql import functions as F

from conftest import event
from starloom.operators import dims, facts, marts, profile, reports, staging
from starloom.operators.keys import assign_keys
from starloom.sources.layers import upsert


def _stg(raw_rows, events):
    return staging.parse_events(raw_rows([(e["event_id"], e, "b") for e in events]))


def test_dim_date_calendar(spark):
    d = dims.build_dim_date(spark)
    assert d.count() == 2557
    rows = {r.full_date: r for r in d.where(F.col("full_date").isin(
        dt.date(2024, 5, 1), dt.date(2021, 1, 3), dt.date(2024, 3, 3))).collect()}
    may = rows[dt.date(2024, 5, 1)]
    assert may.month_name == "May      " and may.day_name == "Wednesday" and may.date_key == 20240501
    assert rows[dt.date(2021, 1, 3)].week_of_year == 53
    sunday = rows[dt.date(2024, 3, 3)]
    assert sunday.day_of_week == 0 and sunday.is_weekend


def test_keys_dense_unique_and_stable(spark):
    df = spark.range(1000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"))
    keyed = assign_keys(df, ["k"], "sk", start=10)
    a = {r.k: r.sk for r in keyed.collect()}
    b = {r.k: r.sk for r in keyed.collect()}
    assert a == b
    assert sorted(a.values()) == list(range(11, 1011))


def test_out_of_calendar_and_unknown_lookups(spark, raw_rows):
    stg = _stg(raw_rows, [
        event("old", ts="2019-12-31T23:00:00Z"),
        event("new", ts="2027-01-01T01:00:00Z"),
        event("ok", etype="feature_used", props={"feature_id": "nope", "duration_sec": 5}),
        event("doc", etype="document_created", props={"document_id": "d1"}),
    ])
    users = dims.build_dim_users(stg)
    docs = dims.build_dim_documents(stg.where(F.col("event_id") != "doc"))
    f = facts.build_fact_events(stg, users, docs, dims.build_dim_features(spark), dims.build_dim_date(spark))
    got = {r.event_id: r for r in f.collect()}
    assert set(got) == {"ok", "doc"}
    assert got["ok"].feature_sk is None and got["doc"].document_sk is None
    dropped = {r.reason: r.n_events for r in facts.explain_dropped(stg, users, dims.build_dim_date(spark)).collect()}
    assert dropped == {"no_current_user": 0, "date_out_of_range": 2}


def test_late_event_keeps_signup_and_negative_months(spark, raw_rows):
    first = _stg(raw_rows, [event("a", ts="2024-03-10T00:00:00Z")])
    users = dims.build_dim_users(first)
    later = _stg(raw_rows, [event("a", ts="2024-03-10T00:00:00Z"), event("b", ts="2024-01-05T00:00:00Z")])
    assert dims.build_dim_users(later, users).count() == 0  # no new row, signup unchanged
    f = facts.build_fact_events(later, users, dims.build_dim_documents(later), dims.build_dim_features(spark),
                                dims.build_dim_date(spark))
    ret = marts.retention_cohorts(users, facts.build_daily(f))
    months = sorted(r.months_since_signup for r in ret.collect())
    assert months == [-2, 0]


def test_user_without_facts_gives_null_retention_row(spark, raw_rows):
    stg = _stg(raw_rows, [event("x", ts="2019-06-01T00:00:00Z", user="ghost"), event("y", user="u1")])
    users = dims.build_dim_users(stg)
    f = facts.build_fact_events(stg, users, dims.build_dim_documents(stg), dims.build_dim_features(spark),
                                dims.build_dim_date(spark))
    daily = facts.build_daily(f)
    ret = {(r.cohort_month, r.activity_month): r for r in marts.retention_cohorts(users, daily).collect()}
    ghost = ret[(dt.date(2019, 6, 1), None)]
    assert ghost.months_since_signup is None and ghost.retained_users == 0 and float(ghost.retention_rate) == 0.0
    churn = marts.churn_risk(users, daily, "2024-03-10").collect()
    assert [r.user_id for r in churn] == ["u1"]


def test_churn_thresholds(spark):
    as_of = dt.date(2024, 7, 15)
    rows = [(i + 1, f"u{d}", as_of - dt.timedelta(days=d)) for i, d in enumerate([7, 8, 14, 15, 30, 31])]
    users = spark.createDataFrame([(sk, uid, "free", "active", True) for sk, uid, _ in rows],
                                  "user_sk long, user_id string, current_plan string, account_status string, is_current boolean")
    daily = spark.createDataFrame([(d, sk, 1) for sk, _, d in rows], "activity_date date, user_sk long, total_events long")
    got = {r.user_id: r.churn_risk_category for r in marts.churn_risk(users, daily, as_of).collect()}
    assert got == {"u7": "active", "u8": "low", "u14": "low", "u15": "medium", "u30": "medium", "u31": "high"}


def test_closed_version_activity_only_in_user_id_rollup(spark):
    users = spark.createDataFrame([
        (1, "u1", "free", "active", False), (2, "u1", "pro", "active", True)],
        "user_sk long, user_id string, current_plan string, account_status string, is_current boolean")
    daily = spark.createDataFrame([(dt.date(2024, 7, 1), 1, 5)], "activity_date date, user_sk long, total_events long")
    assert marts.churn_risk(users, daily, "2024-07-15").count() == 0
    d5 = marts.churn_risk(users, daily, "2024-07-15", by="user_id").collect()
    assert [(r.user_id, r.lifetime_events, r.current_plan) for r in d5] == [("u1", 5, "pro")]


def test_upsert_replaces_metrics_keeps_created(spark):
    t0, t1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    target = spark.createDataFrame([(dt.date(2024, 1, 1), 1, 3, t0, t0)],
                                   "activity_date date, user_sk long, total_events long, created_at timestamp_ntz, updated_at timestamp_ntz")
    source = spark.createDataFrame([(dt.date(2024, 1, 1), 1, 5), (dt.date(2024, 1, 2), 1, 1)],
                                   "activity_date date, user_sk long, total_events long")
    got = {r.activity_date: r for r in upsert(target, source, ["activity_date", "user_sk"], ["total_events"],
                                               F.lit(t1).cast("timestamp_ntz")).collect()}
    upd = got[dt.date(2024, 1, 1)]
    assert upd.total_events == 5 and upd.created_at == t0 and upd.updated_at == t1 and upd._action == "updated"
    assert got[dt.date(2024, 1, 2)]._action == "inserted"


def test_scd2_closes_and_opens_versions(spark, raw_rows):
    stg = _stg(raw_rows, [
        event("a0", ts="2024-01-01T00:00:00Z"),
        event("a1", etype="subscription_started", ts="2024-02-01T00:00:00Z", props={"plan": "pro"}),
        event("a2", etype="subscription_upgraded", ts="2024-02-05T00:00:00Z", props={"plan": "pro"}),
        event("a3", etype="subscription_cancelled", ts="2024-03-01T00:00:00Z", props={"reason": "other"}),
    ])
    users = dims.build_dim_users(stg, effective_from_first_event=True)
    out = dims.apply_scd2(users, profile.plan_changes(stg), start=1).orderBy("effective_date").collect()
    assert [(r.current_plan, r.account_status, r.is_current) for r in out] == [
        ("free", "active", False), ("pro", "active", False), ("free", "cancelled", True)]
    assert out[0].end_date == out[1].effective_date and out[1].end_date == out[2].effective_date
    assert len({r.user_sk for r in out}) == 3
    hist = profile.plan_history(stg).collect()
    assert len(hist) == 3 and sum(r.valid_to is None for r in hist) == 1


def test_layer_pct_first_uses_core(spark):
    counts = spark.createDataFrame([("Raw", 100), ("Staging", 100), ("Core", 50)], "layer string, record_count long")
    first = {r.layer: float(r.pct_of_raw) for r in reports.layer_pct_first(counts).collect()}
    assert first == {"Raw": 200.0, "Staging": 200.0, "Core": 100.0}
    raw = {r.layer: float(r.pct_of_raw) for r in reports.layer_pct_of_raw(counts).collect()}
    assert raw == {"Raw": 100.0, "Staging": 100.0, "Core": 50.0}


def test_retention_variants_differ(spark):
    users = spark.createDataFrame([(1, dt.date(2024, 1, 3), True), (2, dt.date(2024, 1, 9), True)],
                                  "user_sk long, signup_date date, is_current boolean")
    daily = spark.createDataFrame([(dt.date(2024, 1, 3), 1), (dt.date(2024, 1, 9), 2), (dt.date(2024, 2, 1), 1)],
                                  "activity_date date, user_sk long")
    a = {r.months_since_signup: (r.cohort_size, float(r.retention_rate)) for r in marts.retention_cohorts(users, daily).collect()}
    b = {r.months_since_signup: (r.cohort_size, float(r.retention_rate))
         for r in marts.retention_cohorts(users, daily, "cohort").collect()}
    assert a == {0: (2, 100.0), 1: (1, 100.0)}
    assert b == {0: (2, 100.0), 1: (2, 50.0)}


def test_scd2_places_a_late_change_inside_history(spark, raw_rows):
    stg = _stg(raw_rows, [
        event("b0", ts="2024-01-01T00:00:00Z", user="u9"),
        event("b1", etype="subscription_started", ts="2024-02-01T00:00:00Z", user="u9", props={"plan": "pro"}),
    ])
    users = dims.build_dim_users(stg, effective_from_first_event=True)
    v2 = dims.apply_scd2(users, profile.plan_changes(stg), start=1)
    late = _stg(raw_rows, [event("b2", etype="subscription_cancelled", ts="2024-01-15T00:00:00Z", user="u9",
                                 props={"reason": "other"})])
    v3 = dims.apply_scd2(v2, profile.plan_changes(late), start=2).orderBy("effective_date").collect()
    assert [(r.current_plan, r.account_status, str(r.effective_date)[:10], str(r.end_date)[:10] if r.end_date else None,
             r.is_current) for r in v3] == [
        ("free", "active", "2024-01-01", "2024-01-15", False),
        ("free", "cancelled", "2024-01-15", "2024-02-01", False),
        ("pro", "active", "2024-02-01", None, True)]
    before = {r.user_sk for r in v2.collect()}
    assert before <= {r.user_sk for r in v3}  # existing versions keep their keys


def test_given_events_are_dealt_over_tasks(spark, tmp_path):
    """One row group of events must not make, store and parse all documents in one task."""
    from starloom.sources.driver import product_events

    spark.sql("""SELECT id AS event_id, id % 9 AS user_id, 'view' AS event_type, 1.0D AS value, '{"k": 3}' AS props,
                 timestamp_ntz'2024-01-01 00:00:00' AS ts FROM range(1000)""").coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    events = product_events(spark, str(tmp_path))
    plan = events._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions" in plan and plan.index("Project") < plan.index("RebalancePartitions")
    assert events.count() == 1000


def test_given_orders_are_dealt_over_tasks(spark):
    from starloom.sources.driver import order_events

    plan = order_events(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions" in plan and plan.index("Project") < plan.index("RebalancePartitions")
