import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from starloom.operators import dims, quality
from starloom.plans import daily_load
from starloom.plans.catalog import QUERIES
from starloom.plans.warehouse import EARLY_CUTOFF, Warehouse
from starloom.session import scratch_path
from starloom.sources.layers import read_layer, write_layer
from starloom.streaming import ingest as stream

SF = "/root/testdata/sf0.001"


def test_two_runs_then_rerun_writes_nothing(spark):
    w = Warehouse(spark, SF)
    base = scratch_path(spark, "test-load")
    raw_root, core_root = f"{base}/raw", f"{base}/core"
    raw = w.raw.select("event_id", "raw_payload", "batch_id")
    as_of = dt.date(2024, 7, 15)
    daily_load.run_load(spark, raw_root, core_root, raw.where(F.col("batch_id") <= EARLY_CUTOFF), as_of)
    daily_load.run_load(spark, raw_root, core_root, raw, as_of)
    counts = {r.table_name: r.n_rows for r in daily_load.layer_counts(spark, raw_root, core_root).collect()}
    n = w.staging.count()
    assert counts["raw_events"] == n and counts["staging_events"] == n and counts["fact_events"] == n
    assert counts["dim_date"] == 2557 and counts["dim_features"] == 8
    again = daily_load.run_load(spark, raw_root, core_root, raw, as_of)
    for table in ("raw_events", "staging_events", "dim_users", "dim_documents", "dim_date", "dim_features",
                  "fact_events"):
        assert again.rows[table] == 0, table
    # Daily facts equal a full rebuild; quality checks pass on the stored layers.
    fact = read_layer(spark, core_root, "fact_events")
    daily = read_layer(spark, core_root, "fact_daily_user_activity")
    assert quality.chk_reconcile(fact, daily).where("difference != 0").count() == 0
    users = read_layer(spark, core_root, "dim_users")
    assert quality.chk_one_current(users).first().violations == 0
    assert quality.chk_unique(daily, "daily", ["activity_date", "user_sk"]).first().violations == 0
    assert quality.chk_unique(fact, "fact_events", ["event_sk"]).first().violations == 0
    assert daily.count() == w.daily.count()
    report = daily_load.quality_report(spark, raw_root, core_root)
    failing = [tuple(r) for r in report.where("violations != 0").collect()]
    assert failing == [] and report.count() > 40


def test_quality_report_covers_raw_and_views(spark, raw_rows):
    from conftest import event

    base = scratch_path(spark, "test-quality")
    raw_root, core_root = f"{base}/raw", f"{base}/core"
    known = dims.build_dim_features(spark).first().feature_id
    rows = [(f"e{i}", event(f"e{i}", "feature_used", props={"feature_id": known}), "2024-03-01") for i in range(3)]
    daily_load.run_load(spark, raw_root, core_root, raw_rows(rows), dt.date(2024, 7, 15))
    for view in daily_load.VIEWS:
        stored = read_layer(spark, core_root, view)
        one = spark.createDataFrame(stored.limit(1).collect(), stored.schema)
        write_layer(one, core_root, view, "append")
    raw = read_layer(spark, raw_root, "raw_events")
    one = spark.createDataFrame(raw.limit(1).collect(), raw.schema)
    write_layer(one.withColumn("event_id", F.lit("x" * 256)), raw_root, "raw_events", "append")
    failing = {(r.table_name, r.rule): r.violations for r in
               daily_load.quality_report(spark, raw_root, core_root).where("violations != 0").collect()}
    assert {t for t, rule in failing if rule == "unique"} == set(daily_load.VIEWS)
    assert [t for t, rule in failing if rule != "unique"] == ["raw_events"] and set(failing.values()) == {1}


def test_run_summary_tells_every_step(spark, monkeypatch):
    real, stored = daily_load.run_load, []

    def load(spark, raw_root, core_root, *args):
        summary = real(spark, raw_root, core_root, *args)
        stored.append({t: read_layer(spark, raw_root if t == "raw_events" else core_root, t).count()
                       for t in summary.rows})
        return summary
    monkeypatch.setattr(daily_load, "run_load", load)
    got = {r.table_name: r.n_rows for r in QUERIES["run_summary"](spark, SF).collect()}
    early, full = stored
    overwritten = {*daily_load.VIEWS, "churn_risk_by_user"}  # the rollups grow by parts
    want = {t: n + early[t] * (t in overwritten) for t, n in full.items()}
    # Daily facts: those of the early run, and the months that the second one touched.
    w = Warehouse(spark, SF)
    month = lambda c: F.trunc(F.col(c).cast("date"), "month").alias("month")
    touched = w.staging.where(F.col("batch_id") > EARLY_CUTOFF).select(month("event_timestamp")).distinct()
    want["fact_daily_user_activity"] = early["fact_daily_user_activity"] + w.daily.select(
        month("activity_date")).join(touched, "month").count()
    assert len(got) == 15 and got == want


def test_stream_replays_add_nothing(spark):
    w = Warehouse(spark, SF)
    base = scratch_path(spark, "test-stream")
    raw = w.raw.select("event_id", "raw_payload", "batch_id")
    stream.land(raw, f"{base}/landing")
    stream.land(raw, f"{base}/landing")  # the same events delivered twice
    stream.stream_ingest(spark, f"{base}/landing", f"{base}/raw", f"{base}/core", f"{base}/ckpt",
                         max_files_per_trigger=3)
    stg = read_layer(spark, f"{base}/core", "staging_events")
    assert stg.count() == w.staging.count()
    assert stg.select("event_id").distinct().count() == stg.count()


def test_stream_quarantines_bad_events(spark, raw_rows):
    from conftest import event
    base = scratch_path(spark, "test-stream-bad")
    rows = raw_rows([("ok1", event("ok1"), "b"), ("bad", "{broken", "b"),
                     ("ip", event("ip", ctx={"platform": "web", "ip_address": "300.0.0.1"}), "b")])
    stream.land(rows, f"{base}/landing")
    stream.stream_ingest(spark, f"{base}/landing", f"{base}/raw", f"{base}/core", f"{base}/ckpt")
    stg = read_layer(spark, f"{base}/core", "staging_events")
    assert [r.event_id for r in stg.collect()] == ["ok1"]
    rej = spark.read.parquet(f"{base}/core/staging_rejects")
    assert sorted(sum((r.reasons for r in rej.collect()), [])) == ["bad_ip", "malformed_json"]


def test_stored_views_equal_recompute(spark):
    from starloom.operators import marts
    w = Warehouse(spark, SF)
    base = scratch_path(spark, "test-funnel")
    raw = w.raw.select("event_id", "raw_payload", "batch_id")
    as_of = dt.date(2024, 7, 15)
    for part in (raw.where(F.col("batch_id") <= EARLY_CUTOFF), raw):
        daily_load.run_load(spark, f"{base}/raw", f"{base}/core", part, as_of)
    core = f"{base}/core"
    fact, features = read_layer(spark, core, "fact_events"), read_layer(spark, core, "dim_features")
    users, daily = read_layer(spark, core, "dim_users"), read_layer(spark, core, "fact_daily_user_activity")
    fresh = {
        "feature_adoption_funnel": marts.feature_adoption(fact, features),
        "user_retention_cohorts": marts.retention_cohorts(users, daily),
        "churn_risk_scores": marts.churn_risk(users, daily, as_of),
        "churn_risk_by_user": marts.churn_risk(users, daily, as_of, by="user_id"),
    }
    for name, df in fresh.items():
        stored = read_layer(spark, core, name)
        assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, df.select(*stored.columns).collect())), name


def test_reset_rebuilds_downstream_from_kept_raw(spark):
    w = Warehouse(spark, SF)
    base = scratch_path(spark, "test-reset")
    raw_root = f"{base}/raw"
    as_of = dt.date(2024, 7, 15)
    daily_load.run_load(spark, raw_root, f"{base}/core", w.raw.select("event_id", "raw_payload", "batch_id"), as_of)
    fresh_root = daily_load.new_core_root(base)
    summary = daily_load.run_load(spark, raw_root, fresh_root, None, as_of)  # raw kept, nothing delivered
    assert "raw_events" not in summary.rows
    assert summary.rows["fact_events"] == w.staging.count()
    users = read_layer(spark, fresh_root, "dim_users")
    assert users.agg(F.min("user_sk")).first()[0] == 1


def test_load_with_plan_changes_keeps_invariants(spark):
    w = Warehouse(spark, SF)
    base = scratch_path(spark, "test-scd2-load")
    raw = w.raw.select("event_id", "raw_payload", "batch_id")
    as_of = dt.date(2024, 7, 15)
    for part in (raw.where(F.col("batch_id") <= EARLY_CUTOFF), raw):
        daily_load.run_load(spark, f"{base}/raw", f"{base}/core", part, as_of, apply_plan_changes=True)
    users = read_layer(spark, f"{base}/core", "dim_users")
    assert users.where(~F.col("is_current")).count() > 0          # some versions were closed
    assert users.where("current_plan != 'free'").count() > 0      # plans moved off the default
    report = daily_load.quality_report(spark, f"{base}/raw", f"{base}/core")
    assert [tuple(r) for r in report.where("violations != 0").collect()] == []
    n_users = w.staging.select("user_id").distinct().count()
    assert users.where("is_current").count() == n_users


def test_stream_on_a_processing_time_trigger(spark):
    w = Warehouse(spark, SF)
    base = scratch_path(spark, "test-stream-live")
    stream.land(w.raw.select("event_id", "raw_payload", "batch_id"), f"{base}/landing")
    q = stream.stream_ingest(spark, f"{base}/landing", f"{base}/raw", f"{base}/core", f"{base}/ckpt",
                             every="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert read_layer(spark, f"{base}/core", "staging_events").count() == w.staging.count()


def test_daily_catches_up_after_a_load_stopped_before_it(spark, monkeypatch):
    """Facts written by a load that stopped before its daily step reach the
    daily table in the next load."""
    w = Warehouse(spark, SF)
    base = scratch_path(spark, "test-crash")
    core = f"{base}/core"
    raw = w.raw.select("event_id", "raw_payload", "batch_id")
    as_of = dt.date(2024, 7, 15)
    daily_load.run_load(spark, f"{base}/raw", core, raw.where(F.col("batch_id") <= EARLY_CUTOFF), as_of)
    # The second load stops right after its fact write.

    def crash(*_):
        raise RuntimeError("stopped")
    monkeypatch.setattr(daily_load.facts, "refresh_daily", crash)
    with pytest.raises(RuntimeError, match="stopped"):
        daily_load.run_load(spark, f"{base}/raw", core, raw, as_of)
    monkeypatch.undo()
    daily_load.run_load(spark, f"{base}/raw", core, None, as_of)  # nothing new delivered
    daily = read_layer(spark, core, "fact_daily_user_activity")
    fact = read_layer(spark, core, "fact_events")
    from starloom.operators import quality
    assert quality.chk_reconcile(fact, daily).where("difference != 0").count() == 0
    assert daily.count() == w.daily.count()


def test_command_line_load(spark, capsys):
    import json
    w = Warehouse(spark, SF)
    base = scratch_path(spark, "test-cli")
    stream.land(w.raw.select("event_id", "raw_payload", "batch_id"), f"{base}/landing")
    code = daily_load.main(["--landing", f"{base}/landing", "--raw-root", f"{base}/raw", "--core-root",
                            f"{base}/core", "--as-of", "2024-07-15", "--check"])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert code == 0 and out["quality_violations"] == 0
    assert out["rows"]["fact_events"] == w.staging.count()


def test_load_quarantines_or_fails_on_bad_events(spark, raw_rows):
    import pytest
    from py4j.protocol import Py4JJavaError
    from pyspark.errors import PySparkException

    from conftest import event
    rows = raw_rows([("ok1", event("ok1"), "b"), ("bad", "{broken", "b")])
    base = scratch_path(spark, "test-load-bad")
    with pytest.raises((PySparkException, Py4JJavaError)):  # a failed write surfaces as either
        daily_load.run_load(spark, f"{base}/strict/raw", f"{base}/strict/core", rows, dt.date(2024, 7, 15))
    summary = daily_load.run_load(spark, f"{base}/q/raw", f"{base}/q/core", rows, dt.date(2024, 7, 15),
                                  quarantine=True)
    assert summary.rows["staging_events"] == 1 and summary.rows["staging_rejects"] == 1
    assert read_layer(spark, f"{base}/q/core", "fact_events").count() == 1


def _events(raw_rows, ids, **kw):
    from conftest import event
    return raw_rows([(i, event(i, **kw), "b1") for i in ids])


def _ids(spark, root, table):
    df = read_layer(spark, root, table)
    return [] if df is None else sorted(r.event_id for r in df.select("event_id").collect())


def test_stream_replay_after_a_crash_between_the_writes(spark, raw_rows, monkeypatch):
    base = scratch_path(spark, "test-crash")
    batch = _events(raw_rows, ["a", "b"])

    def crash(*_):
        raise RuntimeError("stopped")
    monkeypatch.setattr(stream, "stage_new_raw", crash)
    with pytest.raises(RuntimeError):
        stream.load_micro_batch(batch, f"{base}/raw", f"{base}/core")
    monkeypatch.undo()
    assert _ids(spark, f"{base}/raw", "raw_events") == ["a", "b"]
    for _ in range(2):
        stream.load_micro_batch(batch, f"{base}/raw", f"{base}/core")
        assert _ids(spark, f"{base}/core", "staging_events") == ["a", "b"]
        assert _ids(spark, f"{base}/raw", "raw_events") == ["a", "b"]


def test_staging_committed_during_a_load_with_an_old_stamp(spark, raw_rows):
    """Rows whose stamps lie before the newest fact still reach the facts."""
    from starloom.operators import staging
    from starloom.sources.layers import write_layer
    base = scratch_path(spark, "test-late")
    raw_root, core = f"{base}/raw", f"{base}/core"
    daily_load.run_load(spark, raw_root, core, _events(raw_rows, ["a"]))
    late = staging.parse_events(_events(raw_rows, ["late"])).withColumn(
        "processed_at", F.localtimestamp() - F.expr("INTERVAL 1 DAY"))
    write_layer(late, core, "staging_events", "append")
    for _ in range(2):
        daily_load.run_load(spark, raw_root, core, _events(raw_rows, ["a"]))
        assert _ids(spark, core, "fact_events") == ["a", "late"]
    daily = read_layer(spark, core, "fact_daily_user_activity")
    assert daily.agg(F.sum("total_events")).first()[0] == 2


def test_rejects_are_stored_once_and_nothing_is_dropped(spark, raw_rows):
    from conftest import event
    base = scratch_path(spark, "test-rejects")
    rows = spark.createDataFrame(
        [("ok", json.dumps(event("ok")), "b"), (None, json.dumps(event("n")), "b"), ("p", None, "b"), ("bad", "{broken", "b"),
         ("q", json.dumps(event("q")), None), ("ip", json.dumps(event("ip", ctx={"platform": "web", "ip_address": "300.0.0.1"})), "b")],
        "event_id string, raw_payload string, batch_id string")
    for _ in range(3):
        daily_load.run_load(spark, f"{base}/raw", f"{base}/core", rows, quarantine=True)
    assert _ids(spark, f"{base}/raw", "raw_events") == ["ip", "ok"]
    assert _ids(spark, f"{base}/core", "staging_events") == ["ok"]
    want = ["bad_ip", "malformed_json", "missing_batch_id", "missing_event_id", "missing_raw_payload"]
    reasons = lambda root: sorted(x for r in read_layer(spark, root, "staging_rejects").collect() for x in r.reasons)
    assert reasons(f"{base}/core") == want
    # The same through the stream, with a line that is no JSON at all.
    stream.land(rows, f"{base}/landing")
    spark.createDataFrame([("{no json",)], "value string").coalesce(1).write.mode("append").text(f"{base}/landing")
    stream.stream_ingest(spark, f"{base}/landing", f"{base}/raw2", f"{base}/core2", f"{base}/ckpt")
    assert reasons(f"{base}/core2") == sorted([*want, "malformed_line"])


def test_strict_load_fails_before_a_malformed_event_is_stored(spark, raw_rows):
    base = scratch_path(spark, "test-strict")
    with pytest.raises(Exception, match="invalid raw event"):
        daily_load.run_load(spark, f"{base}/raw", f"{base}/core", raw_rows([("x", "{broken", "b")]))
    daily_load.run_load(spark, f"{base}/raw", f"{base}/core", _events(raw_rows, ["a"]))
    assert _ids(spark, f"{base}/raw", "raw_events") == ["a"]


def test_plan_changes_in_the_stored_load_follow_event_time(spark, raw_rows):
    from conftest import event
    base = scratch_path(spark, "test-plan")
    rows = raw_rows([("1", event("1", ts="2024-03-01T10:00:00.000000Z"), "b"),
                     ("2", event("2", "subscription_upgraded", ts="2024-03-02T10:00:00.000000Z", props={"plan": "pro"}), "b"),
                     ("3", event("3", "subscription_upgraded", ts="2024-03-02T10:00:00.000000Z", props={"plan": "enterprise"}), "b")])
    counts = []
    for _ in range(2):
        daily_load.run_load(spark, f"{base}/raw", f"{base}/core", rows, apply_plan_changes=True)
        users = read_layer(spark, f"{base}/core", "dim_users")
        assert [r.current_plan for r in users.where("is_current").collect()] == ["enterprise"]
        counts.append(users.count())
    assert counts[0] == counts[1]
    # The same changes applied to the result open nothing either.
    from starloom.operators import dims, profile
    changes = profile.plan_changes(read_layer(spark, f"{base}/core", "staging_events"))
    assert dims.apply_scd2(users, changes, 100).count() == counts[0]
