"""Token counts with overlap resynchronisation.

A document of up to ``chunk_chars`` is encoded as it is. A longer one is cut
into chunks that reach ``overlap_chars`` into their successor; chunks are
dealt over all tasks and encoded there with the offsets of their pre-tokens.
Two neighbours are spliced at an offset that is a pre-token boundary in both
and lies further from the left chunk's end than its split pattern and special
strings can look ahead. From such an offset on both splits see the same
characters in the same state, so they are the same for good: the boundary is
proven, not likely. Where an overlap holds no such offset the document is cut
again with chunks and overlaps WIDEN times as wide, in the end as one chunk.

Defined results: a null text counts as empty (0 bytes, 0 tokens); every input
row gives one row, repeated rows and null or repeated keys included; an empty
table gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.bpe import encoder
from starloom.llm.common import col, materialize, slices, text_or_empty

CHUNK_CHARS = 16_384
OVERLAP_CHARS = 512
WIDEN = 8


def _short_counts(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in slices(batches):
            n = [enc.count(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("key"), b.column("n_bytes"), pa.array(n, pa.int64())], ["key", "n_bytes", "n_tokens"])
    return run


def _cut(chunk: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1):
            uid, text = b.column("uid")[0].as_py(), b.column("text")[0].as_py()
            n = max(1, -(-(len(text) - overlap) // chunk))
            for k in range(n):
                last = k == n - 1
                yield pa.RecordBatch.from_pydict({
                    "uid": pa.array([uid], pa.int64()), "k": pa.array([k], pa.int64()),
                    "last": pa.array([last]),
                    "own": pa.array([0 if last else chunk], pa.int64()),
                    "text": pa.array([text[k * chunk:] if last else text[k * chunk:(k + 1) * chunk + overlap]],
                                     pa.string())})
    return run


_CHUNK = "uid long, k long, last boolean, own long, text string"
_MARKS = "uid long, k long, last boolean, total long, head array<int>, head_tokens array<int>, " \
         "tail array<int>, tail_tokens array<int>"


def _marks(path: str, overlap: int):
    """Boundaries and the tokens before them: in the first ``overlap``
    characters (head) and past the successor's start (tail), both counted
    from where the later chunk of the two starts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in slices(batches, 16):
            out = {c: [] for c in ("total", "head", "head_tokens", "tail", "tail_tokens")}
            for text, own, last in zip(b.column("text").to_pylist(), b.column("own").to_pylist(),
                                       b.column("last").to_pylist()):
                pre = enc.pretokens(text)
                at = [0, *accumulate(map(len, pre))]
                tokens = [0, *accumulate(len(x) // 4 for x in enc.ids_of(pre))]
                end = len(text) - enc.horizon
                head = [(a, t) for a, t in zip(at, tokens) if a <= overlap]
                tail = [] if last else [(a - own, t) for a, t in zip(at, tokens) if own <= a <= end]
                out["total"].append(tokens[-1])
                for name, found in (("head", head), ("tail", tail)):
                    out[name].append([a for a, _ in found])
                    out[f"{name}_tokens"].append([t for _, t in found])
            ints = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column("uid"), b.column("k"), b.column("last"), pa.array(out["total"], pa.int64()),
                 *(pa.array(out[c], ints) for c in ("head", "head_tokens", "tail", "tail_tokens"))],
                ["uid", "k", "last", "total", "head", "head_tokens", "tail", "tail_tokens"])
    return run


def _joints(marks: DataFrame) -> DataFrame:
    """Per pair of neighbours: the tokens of the left one before the first
    shared boundary less those of the right one (null: none is shared)."""
    left = marks.where(~F.col("last")).select("uid", (F.col("k") + 1).alias("k"), "tail", "tail_tokens")
    right = marks.where(F.col("k") > 0).select("uid", "k", "head", "head_tokens")
    at = F.array_min(F.array_intersect("tail", "head"))
    both = left.join(right, ["uid", "k"]).withColumn("at", at)
    before = lambda name: F.get(F.col(f"{name}_tokens"), F.array_position(F.col(name), F.col("at")).cast("int") - 1)
    return both.select("uid", (before("tail") - before("head")).cast("long").alias("n"))


def long_counts(long_docs: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """(uid, n_tokens) of (uid, text) rows, by chunks."""
    n_tasks = max(1, int(long_docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cut = lambda df: materialize(
        df.mapInArrow(_cut(chunk, overlap), _CHUNK).repartition(n_tasks, "uid", "k"), "chunks")
    chunks, done = cut(long_docs), []
    while True:
        marks = materialize(chunks.mapInArrow(_marks(path, overlap), _MARKS), "marks")
        joints = materialize(_joints(marks), "joints")
        bad = joints.where(F.col("n").isNull()).select("uid").distinct()
        sums = (joints.unionByName(marks.where("last").select("uid", F.col("total").alias("n")))
                .groupBy("uid").agg(F.sum("n").alias("n_tokens")))
        done.append(sums.join(bad, "uid", "left_anti"))
        if bad.isEmpty():
            break
        piece = F.when(F.col("last"), F.col("text")).otherwise(F.substring("text", 1, F.col("own")))
        whole = (chunks.join(bad, "uid", "left_semi").groupBy("uid")
                 .agg(F.sort_array(F.collect_list(F.struct("k", piece.alias("t")))).alias("p"))
                 .select("uid", F.array_join(F.transform("p", lambda x: x["t"]), "").alias("text")))
        chunk, overlap = chunk * WIDEN, overlap * WIDEN
        chunks = cut(whole)
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def token_counts(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text",
                 chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS) -> DataFrame:
    """(key, n_bytes, n_tokens) of every row, for the tokenizer file at
    ``path`` (the same path on every executor)."""
    rows = docs.select(col(docs, key).alias("key"), text_or_empty(docs, text).alias("text"))
    fits = F.char_length("text") <= chunk_chars + overlap_chars
    n_bytes = F.octet_length("text").cast("long").alias("n_bytes")
    key_type = rows.schema["key"].dataType.simpleString()
    short = (rows.where(fits).select("key", n_bytes, "text")
             .mapInArrow(_short_counts(path), f"key {key_type}, n_bytes long, n_tokens long"))
    # Row ids are fixed by writing the long rows before any use.
    long_docs = materialize(rows.where(~fits).select(F.monotonically_increasing_id().alias("uid"), "key", n_bytes,
                                                     "text"), "long")
    counted = long_counts(long_docs.select("uid", "text"), path, chunk_chars, overlap_chars)
    long = long_docs.select("uid", "key", "n_bytes").join(counted, "uid").select("key", "n_bytes", "n_tokens")
    return short.unionByName(long)
