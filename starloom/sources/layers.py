"""Stored layers: snapshots, a commit log a table, and key indexes.

Layout of a table::

    <root>/<table>/load_id=<id>/[<partition>=<value>/]part-*.parquet
    <root>/<table>/_log/<number>.json
    <root>/<table>__keys/load_id=<id>/part-*_<bucket>*.parquet

Every write goes to a folder of its own. It counts once its commit, a small
file with the next number, is there: the newest commit names the folders (and,
for tables whose partitions are replaced one by one, the partitions) that
make up the table. A write that stops leaves the table as it was, readers of an older
commit go on reading its folders, and a table can be overwritten from itself.
Folders that no commit names are removed by ``vacuum``.

A commit also keeps

- ``sources``: how far this table has read the tables it is made from, as the
  number of their commit. Result and position change in one step, so a load
  finds exactly what it has not read yet (``since``), whatever stopped before.
- ``maxima``: the largest surrogate key, measured by the write itself.

Tables with a key (``LAYER_KEYS``) have a key index: the key column alone,
bucketed and sorted by it, in buckets that match the shuffle partitions. Probes for
stored keys (``insert_absent``) read it without moving it.
"""

from __future__ import annotations

import hashlib
import json
import os
import uuid
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.schemas import (
    LAYER_KEYS,
    LAYER_MAXIMA,
    LAYER_PARTITIONS,
    LAYER_SCHEMAS,
    PARTITION_TYPES,
    REBALANCE_ON_WRITE,
    REPLACED_BY_PARTITION,
    SORT_ON_WRITE,
)
from starloom.session import configure

#: Commits that stay, the newest ones; their folders stay too.
KEPT_COMMITS = 10
#: Folders of an increment that are listed one by one (beyond: one listing of the table).
LISTED_FOLDERS = 256


class CommitConflict(RuntimeError):
    """Another writer changed a table while it was being overwritten."""


class DuplicateKey(RuntimeError):
    """A load holds a key value more than once."""


@dataclass(frozen=True)
class Version:
    """A commit: ``loads`` are (folder, number of its commit, its partition
    values that count, or None for all)."""

    number: int = 0
    loads: list = field(default_factory=list)
    keys: list[str] = field(default_factory=list)
    buckets: int = 0
    sources: dict[str, int] = field(default_factory=dict)
    maxima: dict[str, int] = field(default_factory=dict)


@dataclass(frozen=True)
class KeyIndex:
    """The stored keys of a table, bucketed by ``key``."""

    df: DataFrame
    key: str


# ------------------------------------------------------------------ the log
def layer_path(root: str, table: str) -> str:
    return os.path.join(root, table)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at, jvm


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, at, _ = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def current(spark: SparkSession, root: str, table: str) -> Version | None:
    """The newest commit of a table, None before the first."""
    log = os.path.join(layer_path(root, table), "_log")
    commits = [n for n in _names(spark, log) if n.endswith(".json") and not n.startswith(".")]
    if not commits:
        return None
    fs, at, jvm = _fs(spark, os.path.join(log, commits[-1]))
    stream = fs.open(at)
    try:
        text = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return Version(**json.loads(text))


def exists(spark: SparkSession, root: str, table: str) -> bool:
    return current(spark, root, table) is not None


def _commit(spark: SparkSession, root: str, table: str, version: Version) -> bool:
    """Add ``version`` as the commit with its number; False if that number is
    taken. The file is written aside and renamed, so no reader sees half of it."""
    log = os.path.join(layer_path(root, table), "_log")
    fs, at, jvm = _fs(spark, os.path.join(log, f"{version.number:012d}.json"))
    aside = jvm.org.apache.hadoop.fs.Path(os.path.join(log, f".{uuid.uuid4().hex}.new"))
    out = fs.create(aside, False)
    try:
        out.write(bytearray(json.dumps(asdict(version)).encode("utf-8")))
    finally:
        out.close()
    if fs.exists(at) or not fs.rename(aside, at):
        fs.delete(aside, False)
        return False
    commits = [n for n in _names(spark, log) if n.endswith(".json")]
    for name in commits[:-KEPT_COMMITS]:
        fs.delete(jvm.org.apache.hadoop.fs.Path(os.path.join(log, name)), False)
    return True


# ------------------------------------------------------------------ reading
def _partition_cols(table: str) -> list[str]:
    return LAYER_PARTITIONS.get(table, [])


def with_layout_columns(df: DataFrame, table: str) -> DataFrame:
    """Add the derived partition column a stored layer is laid out by."""
    if table == "fact_events" and "event_date" not in df.columns:
        return df.withColumn("event_date", F.col("event_timestamp").cast("date"))
    if table == "staging_events" and "event_month" not in df.columns:
        return df.withColumn("event_month", F.date_format("event_timestamp", "yyyy-MM"))
    if table == "fact_daily_user_activity" and "activity_month" not in df.columns:
        return df.withColumn("activity_month", F.date_format("activity_date", "yyyy-MM"))
    return df


def _schema(table: str) -> T.StructType:
    schema = LAYER_SCHEMAS[table]
    return T.StructType([T.StructField("load_id", T.StringType(), True), *schema.fields,
                         *(T.StructField(c, PARTITION_TYPES.get(c, T.StringType()), True)
                           for c in _partition_cols(table) if c not in schema.fieldNames())])


def _live(table: str, loads: list) -> Column:
    """Partition filter: the folders, and their partitions, that count."""
    whole = [i for i, _, parts in loads if parts is None]
    keep = F.col("load_id").isin(whole) if whole else F.lit(False)
    for i, _, parts in loads:
        if parts is not None:
            keep = keep | ((F.col("load_id") == i) & F.col(_partition_cols(table)[0]).isin(parts))
    return keep


def read_layer(spark: SparkSession, root: str, table: str, version: Version | None = None) -> DataFrame | None:
    """The stored table with its declared schema (and its partition columns),
    as of its newest commit or of ``version``; None before the first commit.
    Nothing is inferred."""
    version = version or current(spark, root, table)
    if version is None:
        return None
    df = spark.read.schema(_schema(table)).parquet(layer_path(root, table))
    return df.where(_live(table, version.loads)).drop("load_id")


def since(spark: SparkSession, root: str, table: str, number: int) -> tuple[DataFrame, int] | None:
    """What the commits after ``number`` added to an append-only table, and
    the number of its newest commit; None when there is nothing new."""
    version = current(spark, root, table)
    new = [load for load in version.loads if load[1] > number] if version else []
    if not new:
        return None
    path = layer_path(root, table)
    folders = [os.path.join(path, f"load_id={i}") for i, _, _ in new] if len(new) <= LISTED_FOLDERS else [path]
    df = spark.read.schema(_schema(table)).option("basePath", path).parquet(*folders)
    return df.where(_live(table, new)).drop("load_id"), version.number


def position(spark: SparkSession, root: str, table: str, source: str) -> int:
    """Number of the commit of ``source`` up to which ``table`` holds it."""
    version = current(spark, root, table)
    return version.sources.get(source, 0) if version else 0


def maximum(spark: SparkSession, root: str, table: str) -> int:
    """Largest surrogate key ever stored (0 when empty): read from the commit."""
    version = current(spark, root, table)
    return version.maxima.get(LAYER_MAXIMA[table], 0) if version else 0


# ------------------------------------------------------------- key indexes
def _key_table(spark: SparkSession, root: str, table: str, buckets: int) -> str:
    """The catalog name of a table's key index, registered in this session."""
    path, key = layer_path(root, table) + "__keys", LAYER_KEYS[table]
    name = "starloom_keys_" + hashlib.sha256(path.encode()).hexdigest()[:24]
    if not configure(spark).catalog.tableExists(name):
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (`{key}` STRING, load_id STRING) USING parquet PARTITIONED BY (load_id) "
                  f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'")
    return name


def read_keys(spark: SparkSession, root: str, table: str) -> KeyIndex | None:
    """The key index of a stored table; None before its first commit."""
    version = current(spark, root, table)
    if version is None or not version.keys:
        return None
    name = _key_table(spark, root, table, version.buckets)
    spark.catalog.refreshTable(name)
    key = LAYER_KEYS[table]
    return KeyIndex(spark.table(name).where(F.col("load_id").isin(version.keys)).select(key), key)


def _write_keys(spark: SparkSession, root: str, table: str, load_id: str, rows: DataFrame, buckets: int) -> None:
    """Index the keys of a folder; a key that it holds twice fails the write."""
    key = LAYER_KEYS[table]
    seen = Observation(f"keys_{uuid.uuid4().hex[:8]}")
    counted = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).observe(
        seen, F.max("n").alias("most"), F.max(F.when(F.col("n") > 1, F.col(key))).alias("repeated"))
    counted.select(key, F.lit(load_id).alias("load_id")).write.mode("append").insertInto(_key_table(spark, root, table, buckets))
    if (seen.get.get("most") or 0) > 1:
        raise DuplicateKey(f"duplicate key value violates unique constraint on {key}: {seen.get["repeated"]}")


def compact_keys(spark: SparkSession, root: str, table: str) -> None:
    """Merge a key index's folders into one (one file a bucket)."""
    version = current(spark, root, table)
    if version is None or len(version.keys) < 2:
        return
    index, load_id = read_keys(spark, root, table), _new_id(version)
    index.df.repartition(version.buckets, index.key).withColumn("load_id", F.lit(load_id)) \
        .write.mode("append").insertInto(_key_table(spark, root, table, version.buckets))
    # Folders that were added meanwhile stay beside the merged one.
    while True:
        now = current(spark, root, table)
        rest = [k for k in now.keys if k not in set(version.keys)]
        if _commit(spark, root, table, replace(now, number=now.number + 1, keys=[load_id, *rest])):
            return


# ------------------------------------------------------------------ writing
def _new_id(version: Version | None) -> str:
    return f"{(version.number if version else 0) + 1:08d}-{uuid.uuid4().hex[:8]}"


def write_layer(df: DataFrame, root: str, table: str, mode: str = "append", sources: dict[str, int] | None = None) -> int:
    """Write one layer and commit it; the number of rows written.

    ``append``: add rows (callers anti-join first for insert-if-absent);
    ``overwrite``: replace all; ``partitions``: replace the partitions present in
    ``df``. ``sources``: positions that this write brings the table to."""
    if mode not in ("append", "overwrite", "partitions"):
        raise ValueError(f"unknown write mode {mode!r}")
    parts = _partition_cols(table)
    if mode == "partitions" and table not in REPLACED_BY_PARTITION:
        raise ValueError(f"{table} is not replaced by partition")
    spark = df.sparkSession
    before = current(spark, root, table)
    load_id = _new_id(before)
    folder = os.path.join(layer_path(root, table), f"load_id={load_id}")

    df = with_layout_columns(df, table)
    df = df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in _schema(table).fields if f.name != "load_id"))
    if table in REBALANCE_ON_WRITE:
        # AQE rebalances the rows by these columns before the write: few files
        # per partition, and a hot partition is split over tasks.
        df = df.hint("rebalance", *REBALANCE_ON_WRITE[table])
    if table in SORT_ON_WRITE:
        df = df.sortWithinPartitions(*parts, *SORT_ON_WRITE[table])
    # Rows and largest key, measured on the write itself (last step of the plan).
    seen = Observation(f"{table}_{uuid.uuid4().hex[:8]}")
    top = LAYER_MAXIMA.get(table)
    df = df.observe(seen, F.count(F.lit(1)).alias("n"), *([F.max(top).alias("top")] if top else []))
    writer = df.write.format("parquet")
    (writer.partitionBy(*parts) if parts else writer).save(folder)
    n, largest = int(seen.get.get("n") or 0), int(seen.get.get("top") or 0)

    buckets = before.buckets if before and before.buckets else 0
    if n and table in LAYER_KEYS:
        buckets = buckets or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
        written = spark.read.schema(_schema(table)).option("basePath", layer_path(root, table)).parquet(folder)
        _write_keys(spark, root, table, load_id, written, buckets)
    touched = None
    if table in REPLACED_BY_PARTITION:
        touched = [p.split("=", 1)[1] for p in _names(spark, folder) if p.startswith(f"{parts[0]}=")]

    base = before or Version()
    if before and not n and mode == "append" and not sources:
        return 0
    while True:
        number = base.number + 1
        new = [[load_id, number, touched]] if n else []
        if mode == "overwrite":
            loads = new
        elif mode == "partitions":
            kept = ([i, k, [p for p in own if p not in touched]] for i, k, own in base.loads)
            loads = [load for load in kept if load[2]] + new
        else:
            loads = [*base.loads, *new]
        version = Version(
            number, loads, [*base.keys, load_id] if n and table in LAYER_KEYS else base.keys, buckets or base.buckets,
            {**base.sources, **(sources or {})}, {**base.maxima, **({top: max(largest, base.maxima.get(top, 0))} if top else {})})
        if _commit(spark, root, table, version):
            return n
        if mode != "append" or sources:
            raise CommitConflict(f"{table} was changed by another writer")
        base = current(spark, root, table)


def vacuum(spark: SparkSession, root: str, table: str) -> int:
    """Delete the folders that none of the kept commits names (left by stopped
    or replaced writes); not to be run beside a writer. Returns their number."""
    newest = current(spark, root, table)
    named = {i for i, _, _ in newest.loads} if newest else set()
    if len([n for n in _names(spark, layer_path(root, table)) if n.startswith("load_id=")]) - len(named) <= KEPT_COMMITS:
        return 0  # not worth reading the commits
    log = os.path.join(layer_path(root, table), "_log")
    live: set[str] = set()
    for name in _names(spark, log):
        if not name.endswith(".json"):
            continue
        fs, at, jvm = _fs(spark, os.path.join(log, name))
        stream = fs.open(at)
        version = Version(**json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
        stream.close()
        live |= {i for i, _, _ in version.loads} | set(version.keys)
    gone = 0
    for path in (layer_path(root, table), layer_path(root, table) + "__keys"):
        for name in _names(spark, path):
            if name.startswith("load_id=") and name.split("=", 1)[1] not in live:
                fs, at, _ = _fs(spark, os.path.join(path, name))
                gone += bool(fs.delete(at, True))
    return gone


# --------------------------------------------------------------- set logic
def insert_absent(new: DataFrame, existing: DataFrame | KeyIndex | None, keys: list[str], probe: DataFrame | None = None) -> DataFrame:
    """Rows of ``new`` whose key is not stored yet (ON CONFLICT DO NOTHING).

    The stored keys are probed, not shuffled: they are semi-joined with the
    (distinct) new keys - the build side - which yields the few keys already
    stored; the new rows are then anti-joined with those. Of a key index each bucket is
    read by one task and meets its share of the new keys there: only the new
    rows move, however many there are. ``probe``: the keys of ``new`` (or more), where
    they come cheaper than with the rows."""
    if existing is None:
        return new
    probe = (new if probe is None else probe).select(*keys).distinct()
    if isinstance(existing, KeyIndex):
        hits = existing.df.join(probe.hint("shuffle_hash"), keys, "left_semi")
        return new.join(hits.hint("shuffle_hash"), keys, "left_anti")
    hits = existing.select(*keys).join(probe, keys, "left_semi")
    return new.join(hits, keys, "left_anti")


def upsert(target: DataFrame | None, source: DataFrame, keys: list[str], update_cols: list[str],
           now: Column | None = None) -> DataFrame:
    """Insert-or-update on ``keys`` (ON CONFLICT DO UPDATE).

    Matched keys take the source's ``update_cols`` and ``updated_at = now``
    and keep ``created_at``; new keys are inserted with both stamps = now;
    target rows without a source row are kept unchanged. Output has an
    ``_action`` column: inserted / updated / kept.
    """
    now = now if now is not None else F.localtimestamp()
    if target is None:
        return (source.select(*keys, *update_cols)
                .withColumn("created_at", now).withColumn("updated_at", now)
                .withColumn("_action", F.lit("inserted")))
    s = source.select(*keys, *update_cols, F.lit(True).alias("_in_s"))
    t = target.select(*keys, *[F.col(c).alias(f"_t_{c}") for c in update_cols],
                      F.col("created_at").alias("_t_created"), F.col("updated_at").alias("_t_updated"),
                      F.lit(True).alias("_in_t"))
    j = s.join(t, keys, "full_outer")
    in_s = F.col("_in_s").isNotNull()
    in_t = F.col("_in_t").isNotNull()
    out = [F.col(k) for k in keys]
    out += [F.when(in_s, F.col(c)).otherwise(F.col(f"_t_{c}")).alias(c) for c in update_cols]
    out += [
        F.when(in_t, F.col("_t_created")).otherwise(now).alias("created_at"),
        F.when(in_s, now).otherwise(F.col("_t_updated")).alias("updated_at"),
        F.when(in_s & in_t, "updated").when(in_s, "inserted").otherwise("kept").alias("_action"),
    ]
    return j.select(*out)
