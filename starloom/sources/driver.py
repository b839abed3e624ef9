"""Inputs from the given parquet tables.

The given ``events`` table is not in the product's event shape; the adapter
below maps it deterministically onto product events (ten event types, eight
features, four platforms, users spread over several signup months). The same
mapping is written as DuckDB SQL in ``starloom.plans.oracle`` so both engines
start from identical rows.

``orders`` gives a second, multi-year event stream (1995-2001) whose dates lie
before the calendar: it feeds the dropped-row report.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.schemas import FEATURE_SEED

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; parquet carries its schema, nothing is inferred."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _feature_of(k: Column) -> Column:
    ids = [fid for fid, _, _, _ in FEATURE_SEED]
    expr = F.when(k % 8 == 0, F.lit(ids[0]))
    for i, fid in enumerate(ids[1:-1], start=1):
        expr = expr.when(k % 8 == i, F.lit(fid))
    return expr.otherwise(F.lit(ids[-1]))


def feature_name_of(feature_id: Column) -> Column:
    """Display name the event carries next to a feature id."""
    expr = None
    for fid, name, _, _ in FEATURE_SEED:
        expr = (F.when if expr is None else expr.when)(feature_id == fid, F.lit(name))
    return expr


def adapt_events(events: DataFrame) -> DataFrame:
    """Given ``events`` -> product events in staging shape (plus the three
    subscription properties and the batch id)."""
    k = F.get_json_object("props", "$.k").cast("int")
    e1 = events.select(
        "event_id", "user_id", "event_type", k.alias("k"), "ts",
        (F.col("user_id") % 6).cast("int").alias("u6"),
        F.floor(F.col("user_id") / 6).cast("int") % 3,
    ).toDF("event_id", "user_id", "event_type", "k", "ts", "u6", "u3")
    shift_days = 30 * (F.col("u3") + F.least(F.col("k") % 6, F.col("u6")))
    e2 = e1.withColumn("ets", F.col("ts") + F.make_dt_interval(shift_days))

    et, kk, eid = F.col("event_type"), F.col("k"), F.col("event_id")
    etype = (
        F.when((et == "view") & (kk % 10 < 7), "document_edited")
        .when((et == "view") & (kk % 10 < 9), "document_shared")
        .when(et == "view", "document_deleted")
        .when((et == "purchase") & (kk % 2 == 0), "document_created")
        .when((et == "purchase") & (kk % 6 == 1), "subscription_started")
        .when((et == "purchase") & (kk % 6 == 3), "subscription_upgraded")
        .when(et == "purchase", "subscription_cancelled")
        .when(et == "click", "feature_used")
        .when(et == "signup", "user_login")
        .otherwise("user_logout")
    )
    platform = (
        F.when(eid % 20 < 12, "web").when(eid % 20 < 17, "mobile")
        .when(eid % 20 < 19, "desktop").otherwise("api")
    )
    e3 = e2.withColumn("etype", etype).withColumn("platform", platform)

    t, uid = F.col("etype"), F.col("user_id").cast("string")
    is_sub = t.isin("subscription_started", "subscription_upgraded")
    return e3.select(
        F.concat(F.lit("evt_"), eid.cast("string")).alias("event_id"),
        t.alias("event_type"),
        F.col("ets").alias("event_timestamp"),
        F.concat(F.lit("usr_"), uid).alias("user_id"),
        F.concat(F.lit("ses_"), uid, F.lit("_"), F.date_format("ets", "yyyyMMdd")).alias("session_id"),
        F.when(t.like("document%"), F.concat(F.lit("doc_"), kk.cast("string"))).alias("document_id"),
        F.when(t == "feature_used", _feature_of(kk)).alias("feature_id"),
        F.when(t == "document_edited", 10 + (kk * 36) % 3591)
        .when(t == "feature_used", 5 + (kk * 7) % 296).alias("duration_seconds"),
        F.when(t == "document_edited", (eid * 37 % 5001).cast("int")).alias("characters_added"),
        "platform",
        F.concat(F.lit("Mozilla/5.0 ("), F.col("platform"), F.lit(")")).alias("user_agent"),
        F.concat(F.lit("192.168."), (F.col("user_id") % 255 + 1).cast("string"), F.lit("."),
                 (kk + 1).cast("string")).alias("ip_address"),
        F.when(is_sub, F.when(kk % 4 == 1, "pro").otherwise("enterprise")).alias("plan"),
        F.when(is_sub, F.when(eid % 2 == 0, "monthly").otherwise("annual")).alias("billing_cycle"),
        F.when(t == "subscription_cancelled",
               F.when(eid % 4 == 0, "too_expensive").when(eid % 4 == 1, "not_using")
               .when(eid % 4 == 2, "competitor").otherwise("other")).alias("reason"),
        F.concat(F.lit("batch_"), F.date_format("ts", "yyyyMMdd")).alias("batch_id"),
    )


def adapt_orders(orders: DataFrame) -> DataFrame:
    """Given ``orders`` -> subscription events of customers (1995-2001), in
    the same shape as :func:`adapt_events`."""
    st, key = F.col("o_orderstatus"), F.col("o_orderkey")
    etype = (F.when(st == "F", "subscription_started").when(st == "O", "subscription_upgraded")
             .otherwise("subscription_cancelled"))
    cust = F.col("o_custkey").cast("string")
    o = orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", etype.alias("etype"))
    t = F.col("etype")
    is_sub = t != "subscription_cancelled"
    return o.select(
        F.concat(F.lit("ord_"), key.cast("string")).alias("event_id"),
        t.alias("event_type"),
        F.col("o_orderdate").alias("event_timestamp"),
        F.concat(F.lit("cus_"), cust).alias("user_id"),
        F.concat(F.lit("ses_cus_"), cust, F.lit("_"), F.date_format("o_orderdate", "yyyyMMdd")).alias("session_id"),
        F.lit(None).cast("string").alias("document_id"),
        F.lit(None).cast("string").alias("feature_id"),
        F.lit(None).cast("int").alias("duration_seconds"),
        F.lit(None).cast("int").alias("characters_added"),
        F.lit("api").alias("platform"),
        F.lit("Mozilla/5.0 (api)").alias("user_agent"),
        F.concat(F.lit("10.0."), (F.col("o_custkey") % 256).cast("string"), F.lit("."),
                 (key % 256).cast("string")).alias("ip_address"),
        F.when(is_sub, F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "enterprise")
               .otherwise("pro")).alias("plan"),
        F.when(is_sub, F.when(key % 2 == 0, "monthly").otherwise("annual")).alias("billing_cycle"),
        F.when(~is_sub, F.lit("other")).alias("reason"),
        F.concat(F.lit("batch_"), F.date_format("o_orderdate", "yyyyMMdd")).alias("batch_id"),
    )


def product_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Rows are small here and documents later: dealt out now, they are made, stored and
    # parsed by all tasks, however few row groups the table has.
    events = read_table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "props", "ts")
    return adapt_events(events.hint("rebalance"))


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Dealt out like the product events.
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    return adapt_orders(orders.hint("rebalance"))
