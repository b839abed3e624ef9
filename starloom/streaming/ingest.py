"""Raw ingest + raw -> staging as an incremental stream of landed files.

Landing format: JSON lines, one raw row per line
(``event_id``, ``raw_payload`` = the event's JSON text, ``batch_id``). The
file source tracks which files were processed in its checkpoint; each
micro-batch is loaded with the same anti-joins as the batch path, so a
replayed micro-batch (after a failure) or a re-delivered file adds nothing:
exactly-once by event_id, without a watermark-bounded dedup state.
The daily batch becomes ``trigger(availableNow=True)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators import staging
from starloom.session import configure
from starloom.sources.layers import position, read_keys, read_layer, since, write_layer
from starloom.sources.raw import ingest_raw

LANDING_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType(), True),
    T.StructField("raw_payload", T.StringType(), True),
    T.StructField("batch_id", T.StringType(), True),
    # A line that is no such row, as it landed.
    T.StructField("_corrupt_record", T.StringType(), True),
])


def land(raw: DataFrame, landing_dir: str) -> None:
    """Drop raw rows as new JSON-lines files into the landing folder."""
    raw.select("event_id", "raw_payload", "batch_id").write.mode("append").json(landing_dir)


def load_micro_batch(batch: DataFrame, raw_root: str, core_root: str) -> None:
    """One micro-batch: new raw rows (exactly once by event_id), then the
    staging rows of every raw load that staging has not read - that of
    this batch, and those of an earlier one that stopped between the two
    writes. Rows that raw cannot store, and rows that do not parse or validate, go to the
    ``staging_rejects`` table with their reasons instead of failing the
    stream (B9), so one bad event cannot stop ingestion and none is lost."""
    spark = batch.sparkSession
    good_raw, bad_raw = staging.split_deliverable(batch)
    new_raw = ingest_raw(good_raw, read_keys(spark, raw_root, "raw_events"))
    write_layer(new_raw.withColumn("loaded_at", F.localtimestamp()), raw_root, "raw_events", "append")
    store_rejects(bad_raw, core_root)
    stage_new_raw(spark, raw_root, core_root)


def store_rejects(rejects: DataFrame, core_root: str) -> int:
    """Rejects (and numbers of them) that are not stored yet; rows written."""
    stored = read_layer(rejects.sparkSession, core_root, "staging_rejects")
    return write_layer(staging.new_rejects(rejects, stored), core_root, "staging_rejects", "append")


def stage_new_raw(spark: SparkSession, raw_root: str, core_root: str) -> None:
    """Staging rows and rejects of the raw loads that staging has not read."""
    found = since(spark, raw_root, "raw_events", position(spark, core_root, "staging_events", "raw_events"))
    if found is None:
        return
    candidates, number = found
    good, rejects = staging.split_valid(candidates, read_keys(spark, core_root, "staging_events"))
    store_rejects(rejects, core_root)
    write_layer(good, core_root, "staging_events", "append", {"raw_events": number})


def stream_ingest(spark: SparkSession, landing_dir: str, raw_root: str, core_root: str, checkpoint: str,
                  max_files_per_trigger: int | None = None, every: str | None = None):
    """Start the stream. By default ``availableNow``: process every landed
    file not seen yet, then stop, and return the finished query. With
    ``every`` (e.g. ``"5 minutes"``) it keeps running on a processing-time
    trigger and the running query is returned."""
    configure(spark)
    reader = spark.readStream.schema(LANDING_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.json(landing_dir)
    writer = (stream.writeStream
              .foreachBatch(lambda df, _epoch: load_micro_batch(df, raw_root, core_root))
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    q = writer.start()
    if not every:
        q.awaitTermination()
    return q
