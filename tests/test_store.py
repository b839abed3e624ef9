"""The stored layers: snapshots and commits, key indexes, positions, and the
steps of the load that rest on them."""

import datetime as dt
import json
import re

import pytest
from pyspark.sql import functions as F

from conftest import event
from starloom.operators import dims, facts, profile, staging
from starloom.plans import daily_load
from starloom.plans.warehouse import EARLY_CUTOFF, Warehouse
from starloom.session import scratch_path
from starloom.sources import layers
from starloom.sources.layers import read_keys, read_layer, since, write_layer
from starloom.sources.raw import ingest_raw
from starloom.streaming import ingest as stream

SF = "/root/testdata/sf0.001"
AS_OF = dt.date(2024, 7, 15)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def halves(spark):
    raw = Warehouse(spark, SF).raw.select("event_id", "raw_payload", "batch_id")
    return raw.where(F.col("batch_id") <= EARLY_CUTOFF), raw


@pytest.fixture(scope="module")
def loaded(spark, halves):
    """A warehouse after the early load."""
    base = scratch_path(spark, "test-store")
    daily_load.run_load(spark, f"{base}/raw", f"{base}/core", halves[0], AS_OF)
    return base


def _content(spark, base):
    """All stored tables without keys and stamps that depend on the run."""
    drop = {"loaded_at", "processed_at", "created_at", "updated_at", "effective_date", "event_sk"}
    out = {}
    for table in daily_load.STEPS:
        df = daily_load.read_rollup(spark, f"{base}/core", table) if table in daily_load.ROLLUPS \
            else read_layer(spark, f"{base}/raw" if table == "raw_events" else f"{base}/core", table)
        out[table] = _rows(df.select(*sorted(c for c in df.columns if c not in drop)))
    return out


def test_a_stopped_write_leaves_the_table_and_the_next_load_ends_right(spark, raw_rows, monkeypatch):
    """A load that stops at any table's commit leaves that table readable as
    it was, and the load after it ends like one that never stopped."""
    up = lambda i, plan: event(f"s{i}", "subscription_upgraded", ts="2024-03-20T10:00:00Z", user=f"u{i % 3}", props={"plan": plan})
    early = raw_rows([(f"e{i}", event(f"e{i}", "feature_used", ts=f"2024-0{1 + i % 3}-05T10:00:00Z", user=f"u{i % 3}",
                                      props={"feature_id": "comments", "duration_sec": i}), "b1") for i in range(9)])
    late = raw_rows([(f"l{i}", event(f"l{i}", "document_edited", ts=f"2024-0{2 + i % 3}-15T10:00:00Z", user=f"u{i % 4}",
                                     props={"document_id": f"d{i}", "edit_duration_sec": 5}), "b2") for i in range(9)]
                    + [(f"s{i}", up(i, "pro"), "b2") for i in range(3)])
    base, whole = scratch_path(spark, "test-stop"), scratch_path(spark, "test-whole")
    load = lambda b, part: daily_load.run_load(spark, f"{b}/raw", f"{b}/core", part, AS_OF, True)
    for b in (base, whole):
        load(b, early)
    load(whole, late)
    real = layers._commit
    for table in ("raw_events", "staging_events", "dim_users", "fact_events", "fact_daily_user_activity", "user_activity", "churn_risk_scores"):
        root = f"{base}/raw" if table == "raw_events" else f"{base}/core"
        before = _rows(read_layer(spark, root, table))

        def stop(spark, root, name, version, table=table):
            if name == table:
                raise RuntimeError("stopped")
            return real(spark, root, name, version)
        monkeypatch.setattr(layers, "_commit", stop)
        with pytest.raises(RuntimeError, match="stopped"):
            load(base, late)
        monkeypatch.undo()
        assert _rows(read_layer(spark, root, table)) == before, table
    load(base, late)
    assert _content(spark, base) == _content(spark, whole)


def _way_to_the_join(plan: str, mark: str) -> list[str]:
    """The operators from the scan of ``mark`` up to the first join."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if mark in line)
    depth = lambda line: len(line) - len(line.lstrip(" :+-|*"))
    way, now = [], depth(lines[at])
    for line in reversed(lines[:at]):
        if depth(line) < now:
            way.append(line.strip())
            now = depth(line)
            if "Join" in line:
                break
    return way


def test_probes_move_no_stored_layer(spark, loaded, halves):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        core, raw = f"{loaded}/core", halves[1]
        parsed = staging.parse_events(raw)
        users, docs = read_layer(spark, core, "dim_users"), read_layer(spark, core, "dim_documents")
        new = {
            "raw_events": ingest_raw(raw, read_keys(spark, f"{loaded}/raw", "raw_events")),
            "staging_events": staging.new_events(parsed, read_keys(spark, core, "staging_events"), strict_unique=False),
            "fact_events": facts.build_fact_events(parsed, users, docs, read_layer(spark, core, "dim_features"),
                                                   read_layer(spark, core, "dim_date"), existing=read_keys(spark, core, "fact_events")),
        }
        late = raw.where(F.col("batch_id") > EARLY_CUTOFF).count()
        for table, df in new.items():
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "Bucketed: true" in plan and "starloom_keys_" in plan, table
            way = _way_to_the_join(plan, "starloom_keys_")
            assert "LeftSemi" in way[-1] and not any("Exchange" in x or "Sort" in x for x in way), (table, way)
            assert df.count() == late
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_key_index_survives_compaction(spark, raw_rows):
    base = scratch_path(spark, "test-compact")
    rows = lambda ids: raw_rows([(i, event(i), "b") for i in ids])
    for ids in (["a", "b"], ["c"], ["d", "a"]):
        new = ingest_raw(rows(ids), read_keys(spark, base, "raw_events"))
        write_layer(new.withColumn("loaded_at", F.localtimestamp()), base, "raw_events")
    layers.compact_keys(spark, base, "raw_events")
    assert len(layers.current(spark, base, "raw_events").keys) == 1
    assert sorted(r.event_id for r in read_keys(spark, base, "raw_events").df.collect()) == ["a", "b", "c", "d"]
    assert ingest_raw(rows(["a", "d", "e"]), read_keys(spark, base, "raw_events")).count() == 1


def test_a_repeated_key_is_not_committed(spark, raw_rows):
    base = scratch_path(spark, "test-repeat")
    twice = [(k, json.dumps(event("same")), "b") for k in ("r1", "r2")]  # two raw rows, one payload id
    df = spark.createDataFrame(twice, "event_id string, raw_payload string, batch_id string")
    with pytest.raises(layers.DuplicateKey, match="unique constraint on event_id: same"):
        daily_load.run_load(spark, f"{base}/raw", f"{base}/core", df, AS_OF)
    assert read_layer(spark, f"{base}/raw", "raw_events").count() == 2
    assert read_layer(spark, f"{base}/core", "staging_events") is None


def test_a_load_scans_only_what_it_has_not_read(spark, halves, monkeypatch):
    base = scratch_path(spark, "test-since")
    daily_load.run_load(spark, f"{base}/raw", f"{base}/core", halves[0], AS_OF)
    old = {t: set(read_layer(spark, r, t).inputFiles()) for t, r in (
        ("raw_events", f"{base}/raw"), ("staging_events", f"{base}/core"), ("fact_events", f"{base}/core"))}
    seen = []
    real = layers.write_layer

    def watch(df, root, table, *args):
        if table not in daily_load.VIEWS:
            seen.append((table, set(df.inputFiles())))
        return real(df, root, table, *args)
    monkeypatch.setattr(daily_load, "write_layer", watch)
    daily_load.run_load(spark, f"{base}/raw", f"{base}/core", halves[1], AS_OF)
    assert {t for t, _ in seen} >= {"staging_events", "fact_events", "user_activity", "staging_unplaced"}
    for table, files in seen:
        for source, done in old.items():
            if (table, source) == ("fact_daily_user_activity", "fact_events"):
                continue  # the touched days are read again
            assert not files & done, (table, source)


def test_increments_are_folders_of_new_commits(spark, loaded):
    core = f"{loaded}/core"
    version = layers.current(spark, core, "staging_events")
    assert since(spark, core, "staging_events", version.number) is None
    df, number = since(spark, core, "staging_events", 0)
    assert number == version.number and df.count() == read_layer(spark, core, "staging_events").count()
    assert version.sources == {"raw_events": layers.current(spark, f"{loaded}/raw", "raw_events").number}
    assert layers.maximum(spark, core, "fact_events") == read_layer(spark, core, "fact_events").agg(F.max("event_sk")).first()[0]


def test_writers_do_not_overwrite_each_other(spark):
    base = scratch_path(spark, "test-conflict")
    one = spark.createDataFrame([("u", dt.date(2024, 1, 1))], "user string, d date").select(
        F.lit(1).alias("user_sk"), F.lit(1).alias("lifetime_events"), F.col("d").alias("last_active_date"))
    write_layer(one, base, "user_activity")
    stale = layers.current(spark, base, "user_activity")
    write_layer(one, base, "user_activity")
    assert not layers._commit(spark, base, "user_activity", layers.replace(stale, number=stale.number + 1))
    assert read_layer(spark, base, "user_activity").count() == 2
    write_layer(read_layer(spark, base, "user_activity"), base, "user_activity", "overwrite")  # from itself
    assert read_layer(spark, base, "user_activity").count() == 2
    assert read_layer(spark, base, "user_activity", stale).count() == 1  # the older commit still reads
    for _ in range(layers.KEPT_COMMITS + 5):
        write_layer(one, base, "user_activity", "overwrite")
    assert layers.vacuum(spark, base, "user_activity") > 0 and read_layer(spark, base, "user_activity").count() == 1


def test_events_outside_the_calendar_wait_aside(spark, raw_rows, monkeypatch):
    base = scratch_path(spark, "test-aside")
    core = f"{base}/core"
    rows = raw_rows([("in", event("in"), "b"), ("far", event("far", ts="2031-05-05T10:00:00Z"), "b"),
                     ("old", event("old", ts="1999-05-05T10:00:00Z"), "b")])
    daily_load.run_load(spark, f"{base}/raw", core, rows, AS_OF)
    ids = lambda table: sorted(r.event_id for r in read_layer(spark, core, table).select("event_id").collect())
    assert ids("fact_events") == ["in"] and ids("staging_unplaced") == ["far", "old"]
    more = dims.build_dim_date(spark, dt.date(2031, 1, 1), dt.date(2031, 12, 31))
    gap = dims.build_dim_date(spark, dt.date(2027, 1, 1), dt.date(2030, 12, 31))
    write_layer(gap.unionByName(more), core, "dim_date")
    for i in range(2):
        daily_load.run_load(spark, f"{base}/raw", core, raw_rows([(f"n{i}", event(f"n{i}"), "b2")]), AS_OF)
    assert ids("fact_events") == ["far", "in", "n0", "n1"] and ids("staging_unplaced") == ["far", "old"]


def test_rollups_grow_with_the_increment(spark, halves, monkeypatch, raw_rows):
    base = scratch_path(spark, "test-rollup")
    core = f"{base}/core"
    daily_load.run_load(spark, f"{base}/raw", core, halves[0], AS_OF)
    one = raw_rows([("one", event("one", "feature_used", user="user_1", props={"feature_id": "comments", "duration_sec": 9}), "b")])
    rows = daily_load.run_load(spark, f"{base}/raw", core, one, AS_OF).rows
    assert [rows[t] for t in daily_load.ROLLUPS] == [1, 1, 1]
    monkeypatch.setattr(daily_load, "ROLLUP_PARTS", 1)
    daily_load.run_load(spark, f"{base}/raw", core, halves[1], AS_OF)
    fact = read_layer(spark, core, "fact_events")
    for table, (rollup, _) in daily_load.ROLLUPS.items():
        assert len(layers.current(spark, core, table).loads) == 1
        stored = daily_load.read_rollup(spark, core, table)
        assert _rows(stored) == _rows(rollup(fact).select(*stored.columns)), table


def _changes(rows):
    return [(u, dt.datetime(2024, 3, d), i, plan, "active") for u, d, i, plan in rows]


def test_changes_at_one_time_in_one_load_or_two(spark):
    schema = "user_id string, change_ts timestamp_ntz, change_id string, current_plan string, account_status string"
    first = staging.parse_events(spark.createDataFrame(
        [("e", json.dumps(event("e", ts="2024-03-01T00:00:00Z", user="u")), "b")], "event_id string, raw_payload string, batch_id string"))
    dim = dims.build_dim_users(first, effective_from_first_event=True).cache()
    make = lambda rows: spark.createDataFrame(_changes(rows), schema)
    a, b, c = ("u", 5, "a", "pro"), ("u", 5, "b", "free"), ("u", 5, "c", "pro")
    shown = ["change_id", "current_plan", "is_current", "effective_date", "end_date"]
    whole = dims.apply_scd2(dim, make([a, b, c]), 1)
    for parts in ([[a], [b, c]], [[c], [a, b, c]]):
        now, log = dim, []
        for part in parts:
            now = dims.apply_scd2(now, make(part), now.count(), earlier=make(log) if log else None).cache()
            log += part
        assert _rows(now.select(*shown)) == _rows(whole.select(*shown)), parts
    # The change that opened nothing (pro again) counts once a late one comes before it.
    x, again, late = ("u", 5, "x", "pro"), ("u", 9, "y", "pro"), ("u", 7, "z", "free")
    now = dims.apply_scd2(dim, make([x, again]), 1).cache()
    now = dims.apply_scd2(now, make([late]), 10, earlier=make([x, again]))
    assert _rows(now.select(*shown)) == _rows(dims.apply_scd2(dim, make([x, again, late]), 1).select(*shown))


def test_equal_rejects_are_counted(spark):
    bad = [(None, "{}", "b")] * 5 + [("x", "{broken", "b")] * 3
    schema = "event_id string, raw_payload string, batch_id string"
    base = scratch_path(spark, "test-counted")

    def stored(root):
        rows = read_layer(spark, root, "staging_rejects").groupBy("reject_id").agg(F.sum("n_rows").alias("n")).collect()
        return sorted(r.n for r in rows)
    for n, want in ((8, [3, 5]), (8, [3, 5]), (2, [3, 5])):  # a replay, and a part of it, add nothing
        daily_load.run_load(spark, f"{base}/raw", f"{base}/core", spark.createDataFrame(bad[:n], schema), AS_OF, quarantine=True)
        assert stored(f"{base}/core") == want
    daily_load.run_load(spark, f"{base}/raw", f"{base}/core", spark.createDataFrame(bad + bad[:2] + [(None, "{}", "c")], schema),
                        AS_OF, quarantine=True)
    assert stored(f"{base}/core") == [1, 3, 7]  # two more at once, and one of another delivery
    stream.load_micro_batch(spark.createDataFrame(bad, stream.LANDING_SCHEMA.simpleString().replace(",_corrupt_record:string", "")),
                            f"{base}/raw2", f"{base}/core2")
    assert stored(f"{base}/core2") == [3, 5]


@pytest.mark.parametrize("literal, ok", [("12", True), ('"12"', True), ("12.0", False), ("1e1", False), ("1.5", False), ('"12.0"', False)])
def test_integers_by_their_literal(spark, literal, ok):
    payload = json.dumps(event("e", "document_edited", props={"edit_duration_sec": "@"})).replace('"@"', literal)
    raw = spark.createDataFrame([("e", payload, "b")], "event_id string, raw_payload string, batch_id string")
    good, rejects = staging.split_valid(raw)
    if ok:
        assert [r.duration_seconds for r in staging.parse_events(raw).collect()] == [12] == [r.duration_seconds for r in good.collect()]
    else:
        with pytest.raises(Exception, match="CAST_INVALID_INPUT|cannot be cast"):
            staging.parse_events(raw).collect()
        assert [r.reasons for r in rejects.collect()] == [["bad_integer"]] and good.count() == 0


def test_number_texts_stay_as_written(spark):
    payload = ('{"event_id": 1.50, "event_type": 1e3, "event_timestamp": "2024-03-01T10:00:00Z", "user_id": 7, "user_id": 012e, '
               '"session_id": 0.10, "properties": {"document_id": 1, "document_id": 2.0, "feature_id": "a: 1, \\\\\\" 2.50 \\\\\\\\"}, '
               '"context": {"platform": true, "user_agent": -3.10}}').replace("012e", "8.00")
    raw = spark.createDataFrame([("e", payload, "b")], "event_id string, raw_payload string, batch_id string")
    r = staging.parse_events(raw).first()
    assert (r.event_id, r.event_type, r.user_id, r.session_id, r.document_id, r.platform) == ("1.50", "1e3", "8.00", "0.10", "2.0", "true")
    assert (r.feature_id, r.user_agent) == ('a: 1, \\" 2.50 \\\\', "-3.10") or (r.feature_id, r.user_agent) == ('a: 1, " 2.50 \\', "-3.10")
    odd = spark.createDataFrame([("a", '[{"event_id": "x"}]', "b"), ("c", '"text"', "b"), ("d", '{"properties": 5, "context": [1]}', "b")],
                                "event_id string, raw_payload string, batch_id string")
    good, rejects = staging.split_valid(odd)
    assert good.count() == 0 and all(set(x.reasons) >= {"missing_event_id", "missing_user_id"} for x in rejects.collect())


def test_staging_layout_skips_files_by_month_type_and_user(spark, halves):
    """A filter on month, type and user reads a small share of the row groups."""
    import pyarrow.parquet as pq

    base = scratch_path(spark, "test-layout")
    spark.conf.set("parquet.block.size", "4096")
    try:
        n = 40
        events = Warehouse(spark, SF).staging.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(n)))) \
            .withColumn("event_id", F.concat("event_id", F.lit("-"), "k")).drop("k")
        write_layer(events, base, "staging_events")
    finally:
        spark.conf.unset("parquet.block.size")
    df = read_layer(spark, base, "staging_events")
    user = df.where("event_type = 'document_edited' AND event_month = '2024-02'").first().user_id
    picked = df.where((F.col("event_month") == "2024-02") & (F.col("event_type") == "document_edited") & (F.col("user_id") == user))
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*event_month", plan) and "EqualTo(event_type,document_edited)" in plan
    total = read = 0
    for f in df.inputFiles():
        meta = pq.ParquetFile(f.removeprefix("file://")).metadata
        for g in range(meta.num_row_groups):
            total += 1
            stats = {meta.row_group(g).column(c).path_in_schema: meta.row_group(g).column(c).statistics for c in range(meta.num_columns)}
            read += "event_month=2024-02" in f and all(
                stats[c].min <= v <= stats[c].max for c, v in (("event_type", "document_edited"), ("user_id", user)))
    assert total > 40 and read < 0.2 * total and picked.count() > 0


def test_the_kept_report_reads_new_rows_and_finds_old_faults(spark, raw_rows, monkeypatch):
    from starloom.plans import quality_log

    base = scratch_path(spark, "test-report")
    raw_root, core = f"{base}/raw", f"{base}/core"
    load = lambda ids, b: daily_load.run_load(spark, raw_root, core, raw_rows(
        [(i, event(i, "document_edited", ts="2024-03-01T10:00:00Z", props={"document_id": "d1"}), b) for i in ids]), AS_OF)
    failing = lambda df: {(r.table_name, r.rule, r.column_name): r.violations for r in df.where("violations <> 0").collect()}
    load(["a", "b", "c"], "b1")
    assert failing(quality_log.report(spark, raw_root, core)) == {}
    whole = {tuple(r) for r in daily_load.quality_report(spark, raw_root, core).collect()}
    assert {tuple(r) for r in quality_log.report(spark, raw_root, core).collect()} >= {r for r in whole if r[1] != "reconcile"}
    old = {t: set(read_layer(spark, r, t).inputFiles()) for t, r in (("raw_events", raw_root), ("staging_events", core), ("fact_events", core))}
    load(["d"], "b2")
    # An old event stored again, with its old key, an unknown user, and too long a platform.
    fact = read_layer(spark, core, "fact_events").where("event_id = 'a'")
    bad = fact.withColumn("user_sk", F.lit(999).cast("bigint")).withColumn("platform", F.lit("p" * 60))
    write_layer(spark.createDataFrame(bad.collect(), bad.schema), core, "fact_events")
    seen = []
    real = quality_log._check_new

    def watch(spark, root, core_root, table, new):
        seen.append((table, set(new.inputFiles())))
        return real(spark, root, core_root, table, new)
    monkeypatch.setattr(quality_log, "_check_new", watch)
    got = failing(quality_log.report(spark, raw_root, core))
    assert {t for t, _ in seen} == set(old) and not any(files & old[t] for t, files in seen)
    want = {("fact_events", "unique", "event_id"): 1, ("fact_events", "unique", "event_sk"): 1, ("fact_events", "foreign_key", "user_sk"): 1,
            ("fact_events", "max_length", "platform"): 1, ("fact_daily_user_activity", "reconcile", "total_events"): 1}
    assert got == want == failing(daily_load.quality_report(spark, raw_root, core))
    del want["fact_daily_user_activity", "reconcile", "total_events"]  # no new facts, no day to reconcile
    assert failing(quality_log.report(spark, raw_root, core)) == want


def test_daily_metrics_stay_in_the_integer_range(spark):
    fact = lambda seconds: spark.createDataFrame(
        [(dt.datetime(2024, 3, 1), 1, "document_edited", s, None) for s in seconds],
        "event_timestamp timestamp_ntz, user_sk long, event_type string, duration_seconds int, feature_sk long")
    assert facts.build_daily(fact([2**31 - 1])).first().total_active_seconds == 2**31 - 1
    with pytest.raises(Exception, match="integer out of range in total_active_seconds: 2147483648"):
        facts.build_daily(fact([2**31 - 1, 1])).collect()


def test_plan_changes_come_from_a_log(spark, raw_rows):
    base = scratch_path(spark, "test-log")
    core = f"{base}/core"
    up = lambda i, plan, ts: (i, event(i, "subscription_upgraded", ts=ts, props={"plan": plan}), "b")
    ts = "2024-03-02T10:00:00.000000Z"
    parts = [[("0", event("0", ts="2024-03-01T10:00:00.000000Z"), "b"), up("a", "pro", ts)], [up("b", "enterprise", ts), up("c", "pro", ts)]]
    for part in parts:
        daily_load.run_load(spark, f"{base}/raw", core, raw_rows(part), AS_OF, apply_plan_changes=True)
    whole = f"{base}/whole"
    daily_load.run_load(spark, f"{whole}/raw", f"{whole}/core", raw_rows(sum(parts, [])), AS_OF, apply_plan_changes=True)
    shown = ["user_id", "change_id", "current_plan", "is_current", "end_date"]
    assert _rows(read_layer(spark, core, "dim_users").select(*shown)) == _rows(read_layer(spark, f"{whole}/core", "dim_users").select(*shown))
    assert read_layer(spark, core, "user_changes").count() == 3
    assert profile.plan_changes(read_layer(spark, core, "staging_events")).count() == 3
