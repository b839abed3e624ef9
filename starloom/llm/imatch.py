"""I-Match fingerprints with several randomised lexicons.

A text's terms are its distinct words, A-Z lower-cased and without punctuation
at their ends. The lexicon keeps the terms whose document frequency, counted over
all documents, lies in a band: at least ``low`` and at most ``high`` of all documents.
LEXICONS random subsets of it, of different densities, are drawn by a hash of
the term, each on its own. In each, a text's sorted distinct terms are hashed to 16 bits (as
a set: the sum of their mixed hashes, mixed again); the fingerprint is the row of these
hashes. A likeness is the share of the lexicons, among those in which either text has
terms, where both hashes agree: dense lexicons tell small changes of short texts,
sparse ones keep agreeing for texts of which half has changed.

Every term is counted. As every kept term occurs in at least ``low`` of the
documents, there are at most (mean distinct terms of a text) / low of them, however
many documents: that bound makes them fit for a broadcast. It is checked; a band of more than
MOST_TERMS terms stays a table, and the texts' terms are joined with it.

Defined results: null texts are empty; a text without terms in any of the
lexicons has a fingerprint of its whole text instead, like only to itself; every row
gives a row, repeated rows too; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import col, collect_longs, free_name, materialize, quoted, slices, text_or_empty
from starloom.llm.near_dup import mix

LEVELS, PER_LEVEL = 8, 12  # densities 1/2, 1/4, ..., with so many lexicons each
LEXICONS = LEVELS * PER_LEVEL
LOW, HIGH = 2e-4, 0.1
MOST_TERMS = 8_000_000  # of a band that is broadcast: 64 MB
FLUSH_TERMS = 500_000  # counted in a task before they are passed on
ENDS = b".,;:!?\"'()[]{}<>|#$%&*-_=+/\\~^@`"

STEP = 1024  # terms that are drawn at once

# A level has bits of the dice for itself: 1 + 2 + ... + LEVELS of 64.
_MASKS = np.array([((1 << (level + 1)) - 1) << (level * (level + 1) // 2) for level in range(LEVELS)], np.uint64)
_SEED = np.arange(1, PER_LEVEL + 1, dtype=np.uint64)[:, None] * np.uint64(0xD6E8FEB86659FD93)
_PLACE = np.arange(1, LEXICONS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)


# Words are hashed as polynomials over random values of their bytes, all of a text at once.
CHUNK = 1 << 16  # bytes of a text at once; a word beyond that is hashed by itself
_WORD_SPACE, _WORD_END = 2, 1
_KIND = np.zeros(256, np.uint8)
_KIND[list(ENDS)] = _WORD_END
_KIND[[0x20, *range(0x09, 0x0E)]] = _WORD_SPACE
with np.errstate(over="ignore"):
    _BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    _BASE = 0xD1342543DE82EF95
    _POWER = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(CHUNK - 1, _BASE, np.uint64)]))
    _BACK = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(CHUNK - 1, pow(_BASE, -1, 1 << 64), np.uint64)]))


def _chunk_terms(raw: bytes) -> np.ndarray:
    if len(raw) > CHUNK:
        term = raw.strip(ENDS)
        return np.array([xxhash.xxh3_64_intdigest(term)] if term else [], np.uint64)
    b = np.frombuffer(raw, np.uint8)
    kind = _KIND.take(b)
    core = np.flatnonzero(kind == 0)
    if not len(core):
        return np.zeros(0, np.uint64)
    # Of each word, the first and the last byte that is no mark.
    word = np.cumsum(kind == _WORD_SPACE, dtype=np.int32).take(core)
    turn = np.flatnonzero(word[1:] != word[:-1])
    first, after = core[np.concatenate([[0], turn + 1])], core[np.concatenate([turn, [len(core) - 1]])] + 1
    total = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_BYTE.take(b) * _POWER[:len(b)], out=total[1:])
    return mix((total[after] - total[first]) * _BACK[first] + (after - first).astype(np.uint64))


def _chunks(raw: bytes) -> Iterator[bytes]:
    """Whole words, up to CHUNK bytes together."""
    if len(raw) <= CHUNK:
        yield raw
        return
    held, size = [], 0
    for word in raw.split():
        if held and size + len(word) >= CHUNK:
            yield b" ".join(held)
            held, size = [], 0
        held.append(word)
        size += len(word) + 1
    yield b" ".join(held)


def terms(text: str) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the terms."""
    parts = [_chunk_terms(c) for c in _chunks(text.encode("utf-8", "surrogatepass").lower())]
    found = np.sort(np.concatenate(parts) if len(parts) > 1 else parts[0])
    return found[np.concatenate([[True], found[1:] != found[:-1]])] if len(found) else found


def fingerprint(text: str, lexicon: np.ndarray) -> str:
    """``i`` and 4 hex digits a lexicon (0000: no terms), or ``t`` and a digest."""
    t = terms(text)
    if len(t) and len(lexicon):
        t = t[lexicon[np.minimum(np.searchsorted(lexicon, t), len(lexicon) - 1)] == t]
    else:
        t = t[:0]
    return fingerprint_of(t, text)


def fingerprint_of(t: np.ndarray, text: str) -> str:
    """The fingerprint of a text whose distinct terms in the band are ``t``."""
    total, any_term = np.zeros(LEXICONS, np.uint64), np.zeros(LEXICONS, bool)
    half = np.uint64(32)
    for at in range(0, len(t), STEP):
        part = t[at:at + STEP]
        member = ((mix(part + _SEED)[None] & _MASKS[:, None, None]) == 0).reshape(LEXICONS, len(part)).astype(np.float64)
        mixed = mix(part)
        # Sums of 32-bit halves, and numbers of members, are exact as doubles.
        counted, low, high = (member @ v.astype(np.float64) for v in (np.ones_like(mixed), mixed & np.uint64(0xFFFFFFFF), mixed >> half))
        total += low.astype(np.uint64) + (high.astype(np.uint64) << half)
        any_term |= counted > 0
    digest = mix(total + _PLACE) % np.uint64(0xFFFF) + np.uint64(1)
    if not any_term.any():
        return "t" + hashlib.sha1(text.encode("utf-8", "surrogatepass")).hexdigest()
    return "i" + np.where(any_term, digest, 0).astype(">u2").tobytes().hex()


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    waiting: list[np.ndarray] = []

    def merge() -> None:
        nonlocal found, counts
        new, n = np.unique(np.concatenate([found[:0], *waiting]), return_counts=True)
        both, at = np.unique(np.concatenate([found, new]), return_inverse=True)
        total = np.zeros(len(both), np.int64)
        total[at[:len(found)]] = counts
        total[at[len(found):]] += n
        found, counts = both, total
        waiting.clear()

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(counts)], ["term", "n"])

    n_waiting = 0
    for b in slices(batches):
        for text in b.column("text").to_pylist():
            waiting.append(terms(text))
            n_waiting += len(waiting[-1])
        if n_waiting > FLUSH_TERMS:
            merge()
            n_waiting = 0
            if len(found) > FLUSH_TERMS:
                yield flush()
                found, counts = found[:0], counts[:0]
    merge()
    yield flush()


def fit_lexicon(docs: DataFrame, text: str = "text", low: float = LOW, high: float = HIGH) -> np.ndarray | DataFrame:
    """The terms in the band, from the counts of all documents: their sorted
    hashes, or a table of them (``term``) if they are more than MOST_TERMS."""
    rows = docs.select(text_or_empty(docs, text).alias("text"))
    n = rows.count()
    df = rows.mapInArrow(_count_terms, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    band = df.where((F.col("n") >= max(2, low * n)) & (F.col("n") <= max(2, high * n))).select("term")
    band = materialize(band, "band")
    if band.count() > MOST_TERMS:
        return band
    return np.sort(collect_longs(band).view(np.uint64))


_NO_TERMS = np.frombuffer(b"0000", "<u4")[0]


def like(x: str, y: str) -> float:
    """Share of agreeing lexicons of two fingerprints, 0 to 1."""
    if x == y:
        return 1.0
    if x[0] != "i" or y[0] != "i":
        return 0.0
    # The four digits of a lexicon are compared as they stand.
    p, q = (np.frombuffer(v.encode("ascii"), "<u4", LEXICONS, 1) for v in (x, y))
    either = (p != _NO_TERMS) | (q != _NO_TERMS)
    return int(((p == q) & either).sum()) / max(1, int(either.sum()))


def fingerprints(df: DataFrame, lexicon: np.ndarray | DataFrame, texts: list[str],
                 near: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """``df`` with each of the text columns ``texts`` replaced by its fingerprint,
    and a column for each of ``near``: the likeness of those two. It is taken in the
    same worker: a second one a task would cost its memory again."""
    near = near or {}
    if isinstance(lexicon, DataFrame):
        return _joined_fingerprints(df, lexicon, texts, near)
    sent = df.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A next document's text comes again as the next row's own.
        of = lru_cache(maxsize=4)(lambda text: fingerprint(text, sent.value))
        for b in slices(batches):
            cols = {name: b.column(name).to_pylist() for name in texts}
            made = {name: [] for name in texts}
            for i in range(b.num_rows):
                for name in texts:
                    made[name].append(of(cols[name][i] or ""))
            yield _with_fingerprints(b, b.schema.names, made, near)

    return df.mapInArrow(run, _made_schema(df.schema.fields, near))


def _made_schema(fields, near: dict) -> str:
    return ", ".join([quoted(f) for f in fields] + [f"`{name}` double" for name in near])


def _with_fingerprints(b: pa.RecordBatch, names: list[str], made: dict[str, list[str]], near: dict) -> pa.RecordBatch:
    shares = [pa.array(list(map(like, made[x], made[y])), pa.float64()) for x, y in near.values()]
    return pa.RecordBatch.from_arrays(
        [pa.array(made[n], pa.string()) if n in made else b.column(n) for n in names] + shares, [*names, *near])


def _joined_fingerprints(df: DataFrame, band: DataFrame, texts: list[str], near: dict) -> DataFrame:
    """``fingerprints`` with a band of any size: (row, text, term) rows are
    joined with it, and what is left of a row's terms comes back to it."""
    row_id, found = free_name(df.columns, "row_"), free_name(df.columns, "found_")
    rows = materialize(df.withColumn(row_id, F.monotonically_increasing_id()), "fingerprint-rows")

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 64):
            ids = b.column(row_id).to_numpy()
            for which, name in enumerate(texts):
                lists = [terms(t or "") for t in b.column(name).to_pylist()]
                sizes = [len(t) for t in lists]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(ids, sizes)), pa.array(np.full(sum(sizes), which, np.int32)),
                     pa.array(np.concatenate(lists).view(np.int64))], [row_id, "which", "term"])

    pairs = rows.select(row_id, *(col(rows, t) for t in texts)).mapInArrow(explode, f"{row_id} long, which int, term long")
    # One list a row, no longer than its texts.
    kept = (pairs.join(band, "term").groupBy(row_id)
            .agg(F.collect_list(F.struct("which", "term")).alias(found)))
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 64):
            made = {name: [] for name in texts}
            cols = [b.column(name).to_pylist() for name in texts]
            for i in range(b.num_rows):
                held = b.column(found)[i].values
                which, term = ((held.field(f).to_numpy() for f in (0, 1)) if held is not None
                               else (np.zeros(0, np.int32), np.zeros(0, np.int64)))
                for j, name in enumerate(texts):
                    made[name].append(fingerprint_of(term[which == j].view(np.uint64), cols[j][i] or ""))
            yield _with_fingerprints(b, names, made, near)

    return rows.join(kept, row_id, "left").mapInArrow(run, _made_schema(df.schema.fields, near))


def _likeness(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([like(x, y) for x, y in zip(a, b)], dtype="float64")


def likeness(a: str, b: str) -> Column:
    """The likeness of two fingerprint columns."""
    return F.pandas_udf(_likeness, T.DoubleType())(F.col(a), F.col(b))


# ------------------------------------------------------------ next document
def _spread(bounds: list[tuple]):
    """Rows to the bucket that their place falls in; a bucket's first row
    also goes to the end of the one before (the very first: of the last)."""
    first = {x: i for i, x in enumerate(bounds)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(3).compress
        for b in slices(batches):
            at, bucket, extra = [], [], []
            for i, (key, h) in enumerate(zip(b.column("key").to_pylist(), b.column("h").to_pylist())):
                place = (key is not None, key if key is not None else 0, h)
                at.append(i)
                bucket.append(max(0, bisect_right(bounds, place) - 1))
                extra.append(False)
                if place in first:
                    at.append(i)
                    bucket.append((first[place] - 1) % len(bounds))
                    extra.append(True)
            rows = pa.array(at, pa.int64())
            packed = pa.array([squeeze(t.encode("utf-8", "surrogatepass")) for t in b.column("text").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket, pa.int32()), pa.array(extra), b.column("key").take(rows), b.column("h").take(rows), packed.take(rows)],
                ["bucket", "extra", "key", "h", "packed"])
    return run


def _follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row with its successor's text; rows come in order, one is held."""
    unpack = zstandard.ZstdDecompressor().decompress
    held: tuple | None = None  # bucket, key, text
    schema: pa.DataType | None = None
    for b in slices(batches, 64):
        schema = b.schema.field("key").type
        keys, texts, nexts = [], [], []
        for bucket, extra, key, packed in zip(*(b.column(c).to_pylist() for c in ("bucket", "extra", "key", "packed"))):
            text = unpack(packed).decode("utf-8", "surrogatepass") if packed else ""
            if held and held[0] == bucket:
                keys.append(held[1])
                texts.append(held[2])
                nexts.append(text)
            held = None if extra else (bucket, key, text)
        yield pa.RecordBatch.from_arrays([pa.array(keys, schema), pa.array(texts, pa.string()), pa.array(nexts, pa.string())],
                                         ["key", "text", "next_text"])


def successors(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text, next_text): every row and the text of the next one by
    (key, hash of the text), null keys first; after the last comes the first."""
    rows = docs.select(col(docs, key).alias("key"), text_or_empty(docs, text).alias("text")).withColumn("h", F.xxhash64("text"))
    tasks = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    place = F.struct(F.col("key"), F.col("h"))
    # The first place of each range: one row a task.
    firsts = (rows.select("key", "h").repartitionByRange(tasks, F.asc_nulls_first("key"), "h")
              .groupBy(F.spark_partition_id().alias("p")).agg(F.min(place).alias("first")).collect())
    bounds = sorted({(r["first"]["key"] is not None, r["first"]["key"] if r["first"]["key"] is not None else 0, r["first"]["h"])
                     for r in firsts})
    kind = rows.schema["key"].dataType.simpleString()
    dealt = rows.mapInArrow(_spread(bounds), f"bucket int, extra boolean, key {kind}, h long, packed binary")
    ordered = dealt.repartitionById(tasks, F.col("bucket")).sortWithinPartitions("bucket", "extra", F.asc_nulls_first("key"), "h")
    return ordered.select("bucket", "extra", "key", "packed").mapInArrow(_follow, f"key {kind}, text string, next_text string")
