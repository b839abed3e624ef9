"""Time of stored loads over several million events.

    python tools/load_run.py /root/testdata/sf0.1 30

writes the given events so many times (each copy with users and event ids of its
own) as landed JSON, loads the history, then the last day as an increment, then
the same day again. Prints one JSON line: events, seconds and events a second of each load.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from starloom.plans import daily_load, warehouse  # noqa: E402
from starloom.session import build_session, scratch_path  # noqa: E402
from starloom.sources.driver import adapt_events, read_table  # noqa: E402
from starloom.sources.raw import to_payload  # noqa: E402


def main(sf_dir: str, copies: int) -> None:
    spark = build_session(master="local[8]", shuffle_partitions=16)
    base = scratch_path(spark, "load-run")
    events = read_table(spark, sf_dir, "events")
    most = events.agg(F.max("event_id").alias("e"), F.max("user_id").alias("u")).first()
    # Whole multiples of 18 keep the adapter's signup months and plans of a user.
    step = (most.u // 18 + 1) * 18
    copied = events.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))).select(
        *(c for c in events.columns if c not in ("event_id", "user_id")),
        (F.col("event_id") + F.col("copy") * (most.e + 1)).alias("event_id"), (F.col("user_id") + F.col("copy") * step).alias("user_id"))
    to_payload(adapt_events(copied)).select("event_id", "raw_payload", "batch_id").write.parquet(f"{base}/landed")
    landed = spark.read.parquet(f"{base}/landed")
    last = landed.agg(F.max("batch_id")).first()[0]
    out = {}
    for name, part in (("history", landed.where(F.col("batch_id") < last)), ("day", landed.where(F.col("batch_id") == last)),
                       ("day_again", landed.where(F.col("batch_id") == last))):
        n = part.count()
        began = time.perf_counter()
        summary = daily_load.run_load(spark, f"{base}/raw", f"{base}/core", part, warehouse.AS_OF)
        took = time.perf_counter() - began
        out[name] = {"events": n, "seconds": round(took, 1), "events_per_sec": round(n / took),
                     "fact_rows": summary.rows.get("fact_events", 0)}
    print(json.dumps({"copies": copies, **out}))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1].rstrip("/"), int(sys.argv[2]) if len(sys.argv) > 2 else 30)
