"""Shared helpers of the operators: written intermediates and row streams."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.session import scratch_path, shared_dir

#: Rows of a batch that are turned into Python objects at once.
SLICE_ROWS = 256


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Give the Python workers this package (once per application), as
    ``--py-files`` would; Spark's own file server carries it."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        package = Path(__file__).resolve().parents[1]
        target = os.path.join(tempfile.mkdtemp(prefix="starloom-src-"), "starloom-src.zip")
        with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
            for f in sorted(package.rglob("*.py")):
                z.write(f, f.relative_to(package.parent))
        spark.sparkContext.addPyFile(target)
        _SHIPPED.add(app)
    return spark


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below ``spark.checkpoint.dir`` and read it
    back: lineage is cut, ids are fixed, and a lost executor only costs a
    re-read."""
    spark = df.sparkSession
    path = scratch_path(spark, os.path.join(f"llm-{spark.sparkContext.applicationId}", name))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete this application's intermediates (results read from them are
    void afterwards)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(
        f"{shared_dir(spark)}/starloom/llm-{spark.sparkContext.applicationId}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def col(df: DataFrame, name: str) -> Column:
    """The column of that exact name (dots and back-ticks included)."""
    return df["`" + name.replace("`", "``") + "`"]


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Cut batches, so that few rows live as Python objects at a time."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def free_name(taken: list[str], name: str) -> str:
    """``name``, with underscores appended while it is taken (names differ
    by more than case, as Spark resolves them)."""
    lower = {t.lower() for t in taken}
    while name.lower() in lower:
        name += "_"
    return name


def quoted(field) -> str:
    return f"`{field.name.replace('`', '``')}` {field.dataType.simpleString()}"


def text_or_empty(df: DataFrame, name: str) -> Column:
    return F.coalesce(col(df, name).cast("string"), F.lit(""))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    packed = b"".join(b.column(0).to_numpy(zero_copy_only=False).astype(np.int64).tobytes() for b in batches)
    yield pa.RecordBatch.from_arrays([pa.array([packed], pa.binary())], ["packed"])


def collect_longs(df: DataFrame) -> np.ndarray:
    """The sorted values of a bounded one-column table of longs, 8 bytes each
    on their way to the driver."""
    rows = df.mapInArrow(_pack, "packed binary").collect()
    return np.sort(np.frombuffer(b"".join(r.packed for r in rows), np.int64))


def runs(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.Table]:
    """Runs of rows that agree in ``names`` (of any type), from rows sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        codes = [b.column(c).to_numpy(zero_copy_only=False) for c in names]
        new = np.zeros(max(0, b.num_rows - 1), bool)
        for c in codes:
            new |= (c[1:] != c[:-1]).astype(bool)
        edges = [0, *(np.flatnonzero(new) + 1).tolist(), b.num_rows]
        for s, e in zip(edges, edges[1:]):
            if s == e:
                continue
            this = tuple(c[s] for c in codes)
            if held and this != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(b.slice(s, e - s))
            last = this
    if held:
        yield pa.Table.from_batches(held)


#: Keys that are joined by broadcast at most, because each has many rows.
HEAVY_KEYS = 10_000


def spread_join(rows: DataFrame, keyed: DataFrame, key: str, n: str) -> DataFrame:
    """Inner join of ``rows`` with ``keyed``, which has one row a key and in
    ``n`` the number of that key's rows. Keys with more than a HEAVY_KEYS-th
    of all rows (so at most HEAVY_KEYS keys) meet their rows by broadcast;
    no other key is large enough to matter to a task."""
    total = keyed.agg(F.sum(n)).first()[0] or 0
    heavy = F.col(n) > max(total / HEAVY_KEYS, 100)
    hot = F.broadcast(keyed.where(heavy))
    cold = rows.join(F.broadcast(keyed.where(heavy).select(key)), key, "left_anti")
    return rows.join(hot, key).unionByName(cold.join(keyed.where(~heavy), key))
