"""Removal of repeated word spans with suffix automata of reference shards.

A window is ``window`` consecutive words. Windows whose word sequence starts
in a document with a smaller key are repeats; the maximal spans of words that
they cover are removed. The corpus is its own reference, so the reference
grows with it, and neither goes through the driver as a whole:

1. Every window has a minimizer, the least hash of its GRAM-word runs. Equal
   windows have equal minimizers, so only windows whose minimizer occurs in
   two different texts can repeat (found by one grouped count, without cap).
2. Runs of windows with one such minimizer are cut out as pieces. Equal
   pieces become one, with the smallest key that holds it.
3. Pieces are dealt to reference shards by minimizer. The automaton of a
   shard is built in ascending key order, then the shard's pieces are streamed
   through it: the matching statistics tell each window's smallest owner.
   A shard holds about SHARD_WORDS words. A minimizer that alone exceeds that
   is dealt window by window instead, equal windows once.
4. Owners go back to all places of a piece; windows owned by a smaller key mark
   their words.

A shard's automaton meets its documents where both are dealt, in place of a
broadcast: the reference has no size bound. The list of shared minimizers and of
copies is broadcast only after its size has been counted; beyond
``broadcast_rows`` joins do the same. Texts equal to one with a smaller key
leave early: all of their windows are repeats.

Defined results: a null text has no words; rows with a null key are never
changed and never a reference; rows with equal keys do not repeat each other;
texts with fewer words than a window are kept whole; repeated rows give
repeated results; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.automaton import SuffixAutomaton
from starloom.llm.common import col, collect_longs, free_name, materialize, quoted, slices, text_or_empty
from starloom.llm.near_dup import _STEP, _hash, mix

WINDOW = 13
GRAM = 4
PIECE_WINDOWS = 32  # windows of a piece at most
WORD_BYTES = 6  # of a word's hash in a piece
SHARD_WORDS = 200_000
BROADCAST_ROWS = 2_000_000  # 16 MB of 64-bit hashes


def word_hashes(text: str) -> np.ndarray:
    words = text.encode("utf-8", "surrogatepass").split()
    return np.fromiter(map(_hash.__getitem__, words), np.uint64, len(words))


def minimizers(h: np.ndarray, window: int) -> np.ndarray:
    """The minimizer of every window of a word-hash sequence."""
    if len(h) < window:
        return np.zeros(0, np.int64)
    gram = min(GRAM, window)
    with np.errstate(over="ignore"):
        total, weight = np.zeros(len(h) - gram + 1, np.uint64), np.uint64(1)
        for i in range(gram):
            weight = weight * _STEP
            total += h[i:len(h) - gram + 1 + i] * weight
        total = mix(total)
    # Running minimum over window - gram + 1 values, by doubling.
    need, have, least = window - gram + 1, 1, total
    while have < need:
        step = min(have, need - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    return least.view(np.int64)


def _found(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Membership in a sorted array."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _list_minimizers(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            out = [np.unique(minimizers(word_hashes(t), window)) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("class"), b.column("row"), pa.array(out, pa.list_(pa.int64()))],
                                             ["class", "row", "minimizers"])
    return run


def _cut_pieces(window: int, shared=None, copies=None):
    """Pieces of the texts whose shared minimizers come with the row, or are
    broadcast (then rows of ``copies`` are passed over)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key_type = None
        for b in slices(batches):
            key_type = b.schema.field("key").type
            at, out = [], {c: [] for c in ("pos", "minimizer", "piece", "words")}
            skip = _found(b.column("row").to_numpy(), copies.value) if copies else np.zeros(b.num_rows, bool)
            texts = b.column("text").to_pylist()
            for i, text in enumerate(texts):
                if skip[i]:
                    continue
                h = word_hashes(text)
                m = minimizers(h, window)
                known = shared.value if shared else np.sort(np.array(b.column("wanted")[i].as_py(), np.int64))
                hit = _found(m, known)
                if not hit.any():
                    continue
                packed = h.view(np.uint8).reshape(-1, 8)[:, :WORD_BYTES]
                starts = np.flatnonzero(np.concatenate([[True], m[1:] != m[:-1]]))
                for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(m)]):
                    if not hit[s]:
                        continue
                    for p in range(s, e, PIECE_WINDOWS):
                        words = packed[p:min(e, p + PIECE_WINDOWS) + window - 1].tobytes()
                        at.append(i)
                        out["pos"].append(p)
                        out["minimizer"].append(int(m[s]))
                        out["piece"].append(xxhash.xxh3_128_digest(words))
                        out["words"].append(words)
            rows = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column("class").take(rows), b.column("key").take(rows), pa.array(out["pos"], pa.int32()),
                 pa.array(out["minimizer"], pa.int64()), pa.array(out["piece"], pa.binary()), pa.array(out["words"], pa.binary())],
                ["class", "key", "pos", "minimizer", "piece", "words"])
    return run


def _shard_owners(window: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["owner", "piece"], kind="stable")
        sizes = (pdf["words"].str.len() // WORD_BYTES).to_numpy()
        flat = np.frombuffer(b"".join(pdf["words"]), np.uint8).reshape(-1, WORD_BYTES)
        _, ids = np.unique(np.pad(flat, ((0, 0), (0, 8 - WORD_BYTES))).reshape(-1).view(np.uint64), return_inverse=True)
        ends = np.cumsum(sizes)
        sequences = [ids[e - n:e].tolist() for e, n in zip(ends.tolist(), sizes.tolist())]
        automaton = SuffixAutomaton()
        for sequence, owner in zip(sequences, pdf["owner"].tolist()):
            automaton.add(sequence, owner)
        return pd.DataFrame({"piece": pdf["piece"].to_numpy(), "owners": [automaton.owners(s, window) for s in sequences]})
    return run


class Repeats:
    """Repeated windows of (key, text) rows."""

    def __init__(self, rows: DataFrame, window: int, broadcast_rows: int, shard_words: int):
        self.window, self.broadcast_rows, self.shard_words = window, broadcast_rows, shard_words
        self.spark = rows.sparkSession
        kind = rows.schema["key"].dataType.simpleString()
        self.key_type = kind
        named = rows.where(F.col("key").isNotNull()).select("key", F.md5(F.col("text").cast("binary")).alias("class"), "text")
        self.docs = named.withColumn("row", F.xxhash64("key", "class"))
        # Texts that occur again, and the smallest key of each.
        self.classes = materialize(named.groupBy("class").agg(F.min("key").alias("first"), F.count("*").alias("n"))
                                   .where("n > 1"), "classes")

    def pieces(self) -> DataFrame:
        listed = self.docs.select("class", "row", "text").mapInArrow(
            _list_minimizers(self.window), "class string, row long, minimizers array<long>")
        exploded = listed.select("row", F.xxhash64("class").alias("c"), F.explode("minimizers").alias("minimizer"))
        shared = materialize(exploded.groupBy("minimizer").agg(F.min("c").alias("lo"), F.max("c").alias("hi"))
                             .where("lo <> hi").select("minimizer"), "shared")
        copies = self.docs.select("key", "class", "row").join(self.classes, "class").where(F.col("key") > F.col("first"))
        copies = materialize(copies.select("row").distinct(), "copies")
        schema = f"class string, key {self.key_type}, pos int, minimizer long, piece binary, words binary"
        if shared.count() <= self.broadcast_rows and copies.count() <= self.broadcast_rows:
            sent = [self.spark.sparkContext.broadcast(collect_longs(df)) for df in (shared, copies)]
            return materialize(self.docs.mapInArrow(_cut_pieces(self.window, *sent), schema), "pieces")
        wanted = (exploded.select("row", "minimizer").join(shared, "minimizer").join(copies, "row", "left_anti")
                  .groupBy("row").agg(F.collect_set("minimizer").alias("wanted")))
        return materialize(self.docs.join(wanted, "row").mapInArrow(_cut_pieces(self.window), schema), "pieces")

    def owners(self, pieces: DataFrame) -> DataFrame:
        """(piece, first, owners): of a run of a piece's windows from number
        ``first`` on, the smallest key that holds each."""
        distinct = materialize(pieces.groupBy("piece").agg(F.first("minimizer").alias("minimizer"), F.first("words").alias("words"),
                                                           F.min("key").alias("owner")), "distinct")
        size = F.octet_length("words") / WORD_BYTES
        loads = distinct.groupBy("minimizer").agg(F.sum(size).alias("load"))
        total = distinct.agg(F.sum(size)).first()[0] or 0
        shards = int(max(1, -(-total // self.shard_words)))
        hot = materialize(loads.where(F.col("load") > self.shard_words).select("minimizer"), "hot")
        schema = f"piece binary, owners array<{self.key_type}>"
        build = lambda df, by: df.withColumn("shard", F.pmod(F.xxhash64(by), F.lit(shards))) \
            .groupBy("shard").applyInPandas(_shard_owners(self.window), schema)
        plain = distinct.join(hot, "minimizer", "left_anti").select("piece", "words", "owner", "minimizer")
        out = build(plain, "minimizer").select("piece", F.lit(0).alias("first"), "owners")
        if hot.isEmpty():
            return out
        span = self.window * WORD_BYTES
        windows = distinct.join(hot, "minimizer").select(
            "piece", "owner", "words", F.explode(F.sequence(F.lit(0), (size - self.window).cast("int"))).alias("first"))
        windows = windows.select("piece", "owner", "first",
                                 F.col("words").substr(F.col("first") * WORD_BYTES + 1, F.lit(span)).alias("w"))
        windows = materialize(windows, "windows")
        single = windows.groupBy("w").agg(F.min("owner").alias("owner")).select(F.col("w").alias("piece"), F.col("w").alias("words"), "owner")
        owned = build(single, "piece").select(F.col("piece").alias("w"), "owners")
        return out.unionByName(windows.join(owned, "w").select("piece", "first", "owners"))

    def spans(self) -> DataFrame:
        """(class, key, marks): numbers of the windows to remove of the
        first document of each text that has any."""
        pieces = self.pieces()
        found = materialize(self.owners(pieces), "owners")
        at = F.transform("owners", lambda o, i: F.when(o < F.col("key"), F.col("pos") + F.col("first") + i))
        marks = (pieces.select("class", "key", "pos", "piece").join(found, "piece")
                 .select("class", "key", F.array_compact(at).alias("marks")).where(F.size("marks") > 0))
        return marks.groupBy("class", "key").agg(F.flatten(F.collect_set("marks")).alias("marks"))


def _squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts in compressed form, for the shuffle."""
    squeeze = zstandard.ZstdCompressor(3).compress
    for b in slices(batches):
        i = b.schema.get_field_index("text_")
        packed = pa.array([squeeze(t.encode("utf-8", "surrogatepass")) for t in b.column(i).to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([packed if j == i else c for j, c in enumerate(b.columns)], b.schema.names)


def _apply(window: int, tidy: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for b in slices(batches):
            *kept, packed_texts, all_marks, copies = b.columns
            n_words, spans, texts = [], [], []
            for packed, marks, copy in zip(packed_texts.to_pylist(), all_marks.to_pylist(), copies.to_pylist()):
                text = unpack(packed) if packed else b""
                words = text.split()
                gone = np.zeros(len(words) + 1, bool)
                if copy and len(words) >= window:
                    gone[:-1] = True
                elif marks:
                    step = np.zeros(len(words) + 1, np.int64)
                    first = np.unique(np.array(marks.split(","), np.int64))
                    np.add.at(step, first, 1)
                    np.add.at(step, first + window, -1)
                    gone[:-1] = np.cumsum(step)[:-1] > 0
                edge = np.flatnonzero(np.diff(np.concatenate([[False], gone]).astype(np.int8)))
                n_words.append(len(words))
                spans.append([{"start": int(s), "end": int(e)} for s, e in zip(edge[::2], edge[1::2])])
                if tidy or len(edge):
                    text = b" ".join([w for w, g in zip(words, gone.tolist()) if not g])
                texts.append(text.decode("utf-8", "surrogatepass"))
            out = [*kept, pa.array(n_words, pa.int64()), pa.array(spans, span), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(out, [f"c{i}" for i in range(len(out))])
    return run


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW,
                   keep: list[str] | None = None, tidy: bool = True, broadcast_rows: int = BROADCAST_ROWS,
                   shard_words: int = SHARD_WORDS) -> DataFrame:
    """The columns ``keep`` (all but the text, if not given) of every row and
    ``n_words_``, ``spans_`` (removed word spans, end exclusive) and
    ``kept_text_`` (kept words, one space between; with ``tidy=False`` texts that
    lose nothing stay as they are). An output whose name is taken by a
    kept column gets further underscores."""
    names = [c for c in docs.columns if c != text] if keep is None else keep
    rows = docs.select(col(docs, key).alias("key"), text_or_empty(docs, text).alias("text"))
    repeats = Repeats(rows, window, broadcast_rows, shard_words)
    # Marks as text: lists are slow to hand over row by row.
    marks = repeats.spans().select("class", F.col("key").alias("marked"), F.array_join(F.col("marks").cast("array<string>"), ",").alias("marks"))
    kept = [f"c{i}" for i in range(len(names))]
    plain = docs.select(*(col(docs, c).alias(k) for c, k in zip(names, kept)), col(docs, key).alias("key"), text_or_empty(docs, text).alias("text_"))
    plain = plain.withColumn("class", F.md5(F.col("text_").cast("binary")))
    packed = plain.mapInArrow(_squeeze, ", ".join(quoted(f) if f.name != "text_" else "text_ binary" for f in plain.schema.fields))
    # A text has one first key, and marks at most for that key.
    met = repeats.classes.select("class", "first").join(marks, "class", "full")
    joined = packed.join(met, "class", "left").select(
        *kept, "text_", F.when(F.col("key") == F.col("marked"), F.col("marks")).alias("marks"),
        F.coalesce(F.col("key") > F.col("first"), F.lit(False)).alias("copy"))
    fields = [quoted(f) for f in joined.schema.fields[:len(kept)]]
    n = len(kept)
    done = joined.mapInArrow(_apply(window, tidy), ", ".join(
        [*fields, f"c{n} long", f"c{n + 1} array<struct<start: bigint, end: bigint>>", f"c{n + 2} string"]))
    return done.toDF(*names, *(free_name(names, x) for x in ("n_words_", "spans_", "kept_text_")))
