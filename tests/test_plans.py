"""Plan shape: the strategies the operators promise show up in the physical
plan."""

from starloom.operators import facts, marts, staging
from starloom.plans.warehouse import Warehouse

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_increment_is_an_anti_join(spark):
    w = Warehouse(spark, SF)
    plan = _plan(staging.new_events(staging.parse_events(w.raw), w.staging_early))
    assert "LeftAnti" in plan


def test_fixed_size_dimensions_are_broadcast(spark):
    w = Warehouse(spark, SF)
    plan = w.fact_events._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("broadcast") >= 2


def test_scan_reads_only_needed_columns_and_pushes_filters(spark):
    w = Warehouse(spark, SF)
    plan = _plan(w.staging_late.select("event_id"))
    assert "PushedFilters: [IsNotNull(batch_id), GreaterThan(batch_id,batch_20240115)]" in plan
    assert "ReadSchema: struct<event_id:string,batch_id:string>" in plan


def test_feature_adoption_aggregates_in_two_levels(spark):
    w = Warehouse(spark, SF)
    plan = w.funnel._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") >= 3  # (feature, user), feature, name


def test_daily_has_no_expand(spark):
    w = Warehouse(spark, SF)
    plan = _plan(facts.build_daily(w.fact_events))
    assert "Expand" not in plan


def test_retention_dedups_activity_first(spark):
    w = Warehouse(spark, SF)
    plan = w.retention._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan
    assert marts.RETENTION_COLUMNS == w.retention.columns


def _single_partition_over_scan(plan: str) -> list[str]:
    """SinglePartition exchanges whose input reaches a file scan without an
    aggregation in between (event-sized data in one task)."""
    lines = plan.splitlines()
    bad = []
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" not in line:
            continue
        depth = len(line) - len(line.lstrip(" :+-|"))
        for nxt in lines[i + 1:]:
            d = len(nxt) - len(nxt.lstrip(" :+-|"))
            if d <= depth:
                break
            if "HashAggregate" in nxt or "ObjectHashAggregate" in nxt or "SortAggregate" in nxt:
                break
            if "FileScan" in nxt:
                bad.append(line.strip())
                break
    return bad


def test_no_single_partition_exchange_over_events(spark):
    w = Warehouse(spark, SF)
    for df in (w.fact_events, w.daily, w.funnel, w.retention_true, w.churn, w.dim_users, w.dim_documents):
        assert _single_partition_over_scan(_plan(df)) == []


def test_incremental_daily_refresh_prunes_months(spark):
    import datetime as dt

    from pyspark.sql import functions as F

    from starloom.plans import daily_load
    from starloom.session import scratch_path
    from starloom.sources.layers import read_layer
    base = scratch_path(spark, "test-prune")
    daily_load.run_load(spark, f"{base}/raw", f"{base}/core", Warehouse(spark, SF).raw.select(
        "event_id", "raw_payload", "batch_id"), dt.date(2024, 7, 15))
    fact = read_layer(spark, f"{base}/core", "fact_events")
    daily = read_layer(spark, f"{base}/core", "fact_daily_user_activity")
    new = fact.where(F.col("event_date") == F.lit("2024-03-05").cast("date"))
    refreshed = facts.refresh_daily(fact, daily, new)
    refreshed.write.format("noop").mode("overwrite").save()
    plan = _plan(refreshed)
    import re
    filters = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan)
    assert any("event_date" in f and ("2024-03-05" in f or "19787" in f or "dynamicpruning" in f) for f in filters)
    assert any("activity_month" in f for f in filters)
    days = {r.activity_date.isoformat()[:7] for r in refreshed.select("activity_date").distinct().collect()}
    assert days == {"2024-03"}


def test_dau_trend_prunes_stored_months(spark):
    import datetime as dt
    import re

    from starloom.operators import reports
    from starloom.plans import daily_load
    from starloom.session import scratch_path
    from starloom.sources.layers import read_layer
    base = scratch_path(spark, "test-dau")
    daily_load.run_load(spark, f"{base}/raw", f"{base}/core", Warehouse(spark, SF).raw.select(
        "event_id", "raw_payload", "batch_id"), dt.date(2024, 7, 15))
    daily = read_layer(spark, f"{base}/core", "fact_daily_user_activity")
    plan = _plan(reports.dau_trend(daily, dt.date(2024, 7, 15)))
    filters = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan)
    assert any("activity_month" in f and "2024-06" in f for f in filters)


def test_queries_of_raw_do_not_wait_for_staging(spark, tmp_path):
    import os

    from starloom.plans import warehouse
    from starloom.plans.catalog import QUERIES
    sf = str(tmp_path / "tables")
    os.symlink(SF, sf)
    layers = lambda: {k[2] for k in warehouse._STORED if k[1] == sf}
    assert QUERIES["raw_ingest"](spark, sf).count() > 0
    assert layers() == {"raw_events"}
    assert QUERIES["staging_parse"](spark, sf).count() > 0
    assert layers() == {"raw_events", "staging_events"}


def test_dropped_rows_parse_the_order_stream_once(spark):
    from starloom.operators import dims
    w = Warehouse(spark, SF)
    stg = w.staging_with_orders
    users = dims.build_dim_users(stg, effective_from_first_event=True)
    plan = facts.explain_dropped(stg, users, w.dim_date)._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" not in plan and "parse_json" not in plan
