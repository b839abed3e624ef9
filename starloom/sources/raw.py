"""Raw layer: payload serialization, batch stamping, exactly-once ingest and
the raw inventory."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.json import json_timestamp_text, payload_field
from starloom.sources.driver import feature_name_of
from starloom.sources.layers import KeyIndex, insert_absent


def to_payload(events: DataFrame) -> DataFrame:
    """Staging-shaped event rows -> (event_id, raw_payload, batch_id).

    The payload is the whole event as one JSON document; NULL fields are left
    out, so each event type carries only its own properties.
    """
    t = F.col("event_type")
    props = F.struct(
        F.col("document_id").alias("document_id"),
        F.when(t == "document_edited", F.col("duration_seconds")).alias("edit_duration_sec"),
        F.col("characters_added").alias("characters_added"),
        F.col("feature_id").alias("feature_id"),
        feature_name_of(F.col("feature_id")).alias("feature_name"),
        F.when(t != "document_edited", F.col("duration_seconds")).alias("duration_sec"),
        F.col("plan").alias("plan"),
        F.col("billing_cycle").alias("billing_cycle"),
        F.col("reason").alias("reason"),
    )
    context = F.struct("platform", "ip_address", "user_agent")
    doc = F.struct(
        "event_id", "event_type",
        json_timestamp_text(F.col("event_timestamp")).alias("event_timestamp"),
        "user_id", "session_id",
        props.alias("properties"),
        context.alias("context"),
    )
    return events.select(
        "event_id",
        F.to_json(doc, {"ignoreNullFields": "true"}).alias("raw_payload"),
        "batch_id",
    )


def batch_id_for(day: Column, suffix: Column | None = None) -> Column:
    """``batch_YYYYMMDD`` (daily scripts) or with an extra suffix (CLI runs)."""
    base = F.concat(F.lit("batch_"), F.date_format(day, "yyyyMMdd"))
    return base if suffix is None else F.concat(base, F.lit("_"), suffix)


def stamp_batch(df: DataFrame, day: Column | None = None, suffix: Column | None = None) -> DataFrame:
    """Set ``batch_id`` from a day (kept when no day is given) and
    ``loaded_at`` to the load time."""
    if day is not None:
        df = df.withColumn("batch_id", batch_id_for(day, suffix))
    return df.withColumn("loaded_at", F.localtimestamp())


def ingest_raw(incoming: DataFrame, existing: DataFrame | KeyIndex | None, order_col: str | None = None) -> DataFrame:
    """Rows of ``incoming`` whose event_id is not in ``existing`` raw (or its
    key index) yet.

    Repeats of one event_id inside the batch keep one row: the first by
    ``order_col`` when given (delivery order), else the smallest payload,
    so reruns pick the same row. The result is what an append must write;
    its count is the true inserted count.
    """
    # MIN over a struct that starts with the ranking column and holds every
    # column is a total order: a recomputed task picks the same row even when
    # the same payload arrived in two batches.
    lead = [order_col] if order_col else ["raw_payload"]
    cols = lead + [c for c in incoming.columns if c not in ("event_id", *lead)]
    first = (incoming.groupBy("event_id")
             .agg(F.min(F.struct(*cols)).alias("_r"))
             .select("event_id", *[F.col(f"_r.{c}").alias(c) for c in incoming.columns if c != "event_id"]))
    return insert_absent(first, existing, ["event_id"])


def raw_inventory(raw: DataFrame) -> DataFrame:
    """Rows per batch and per payload event type (the raw access paths)."""
    et = payload_field(F.try_parse_json("raw_payload"), "event_type")
    return (raw.select("batch_id", et.alias("event_type"))
            .groupBy("batch_id", "event_type")
            .agg(F.count(F.lit(1)).alias("n_events")))
