"""Benchmark: the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full (noop sink: every row computed, nothing
collected to the driver). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from starloom.plans.catalog import QUERIES  # noqa: E402
from starloom.session import build_session  # noqa: E402

HEADLINE = [
    "staging_parse",
    "dim_users",
    "dim_documents",
    "fact_events",
    "fact_daily_user_activity",
    "feature_adoption_funnel",
    "retention_cohorts",
    "retention_cohorts_true",
    "churn_risk_scores",
    "churn_distribution",
    "dau_trend",
    "daily_incremental",
    "chk_reconcile",
    "session_rollup",
    "plan_history",
    "daily_load",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(m.group(1)) if m else None
    # Stage / task metrics come from Spark's event log in a scratch folder
    # (no UI, no REST): shuffle bytes and stage counts per query.
    log_dir = tempfile.mkdtemp(prefix="starloom-eventlog-")
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(2, cpus),
                          extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                                 "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false"})
    # Warm the JVM (class loading, codegen caches) on the smallest tables.
    warm_dir = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    if os.path.isdir(warm_dir):
        QUERIES["feature_adoption_funnel"](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in HEADLINE:
        spark.sparkContext.setJobGroup(name, name)
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    spark.sparkContext.setJobGroup("count", "count")
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    total = round(sum(times.values()), 3)
    app_id = spark.sparkContext.applicationId
    spark.stop()
    try:
        shuffle = shuffle_by_group(log_dir, app_id)
    except (OSError, ValueError, KeyError):  # metrics are extra; the timings stand alone
        shuffle = {}
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": total,
        "unit": "sec",
        "queries": times,
        "sf": sf,
        "events": events,
        "daily_load_events_per_sec": round(events / times["daily_load"], 1) if times.get("daily_load") else None,
        "shuffle_write_bytes": {k: v["bytes"] for k, v in shuffle.items() if k in times},
        "stages": {k: v["stages"] for k, v in shuffle.items() if k in times},
    }))


def shuffle_by_group(log_dir: str, app_id: str) -> dict[str, dict[str, int]]:
    """Shuffle bytes written and stages run per job group, from the event
    log."""
    path = next((os.path.join(log_dir, f) for f in os.listdir(log_dir) if app_id in f), None)
    if path is None:
        return {}
    job_group: dict[int, str] = {}
    stage_group: dict[int, str] = {}
    out: dict[str, dict[str, int]] = {}
    with open(path) as fh:
        for line in fh:
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                job_group[ev["Job ID"]] = group
                for sid in ev.get("Stage IDs", []):
                    stage_group[sid] = group
            elif kind == "SparkListenerStageCompleted":
                group = stage_group.get(ev["Stage Info"]["Stage ID"])
                if group:
                    out.setdefault(group, {"bytes": 0, "stages": 0})["stages"] += 1
            elif kind == "SparkListenerTaskEnd":
                group = stage_group.get(ev.get("Stage ID"))
                metrics = (ev.get("Task Metrics") or {}).get("Shuffle Write Metrics") or {}
                if group:
                    out.setdefault(group, {"bytes": 0, "stages": 0})["bytes"] += int(
                        metrics.get("Shuffle Bytes Written", 0))
    return out


if __name__ == "__main__":
    main()
