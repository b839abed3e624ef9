"""Packing of token pieces into fixed-size sequences.

Every document's ids (and one end id) are cut at multiples of the sequence
length. Full pieces are sequences of their own. The rest of each document goes
to one of many randomised groups of about ``group_docs`` documents, and each
group is packed on its own by first-fit decreasing: bins stand in a tournament
tree that holds the largest free capacity below each node, so the first bin
that fits is found in one walk from the root.

Groups are dealt by a hash of a row id, never by a document's key or text, so
copies and repeated keys spread evenly and no group grows with the data.

Defined results: a null text packs as empty (the end id alone); every input
row is packed, repeated rows and null keys included; ties in length keep the
order of (key, row); an empty table gives an empty result; other columns of
the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.bpe import encoder
from starloom.llm.common import col, materialize, slices, text_or_empty

SEQUENCE_TOKENS = 1024
GROUP_DOCS = 4096
END_ID = 0


def _pieces(path: str, size: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(path), end_id.to_bytes(4, "little")
        for b in slices(batches, 64):
            row, start, length, total, ids = [], [], [], [], []
            for i, text in enumerate(b.column("text").to_pylist()):
                doc = enc.encode(text) + end
                n = len(doc) // 4
                for at in range(0, n, size):
                    row.append(i)
                    start.append(at)
                    length.append(min(size, n - at))
                    total.append(n)
                    ids.append(doc[4 * at:4 * (at + size)])
            yield pa.RecordBatch.from_arrays(
                [b.column("key").take(pa.array(row, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, length, total)),
                 pa.array(ids, pa.binary())], ["key", "start", "length", "doc_tokens", "ids"])
    return run


def token_pieces(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text",
                 size: int = SEQUENCE_TOKENS, end_id: int = END_ID) -> DataFrame:
    """(key, start, length, doc_tokens, ids): each document's ids as
    little-endian unsigned 32-bit integers, cut every ``size``."""
    rows = docs.select(col(docs, key).alias("key"), text_or_empty(docs, text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(_pieces(path, size, end_id),
                           f"key {kind}, start long, length long, doc_tokens long, ids binary")


class CapacityTree:
    """Tournament tree over bins: each node knows the largest free capacity
    below it; unopened bins are full-sized."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.free = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> tuple[int, int]:
        """Put ``size`` into the first bin that has room: (bin, free before)."""
        free, at = self.free, 1
        if free[1] < size:
            raise ValueError(f"no bin holds {size}")
        while at < self.leaves:
            at *= 2
            if free[at] < size:
                at += 1
        before, leaf = free[at], at - self.leaves
        free[at] -= size
        while at > 1:
            at //= 2
            most = max(free[2 * at], free[2 * at + 1])
            if free[at] == most:
                break
            free[at] = most
        return leaf, before


def first_fit_decreasing(lengths: list[int], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) of each length, in input order; equal lengths are placed
    in input order."""
    tree, out = CapacityTree(len(lengths), capacity), [(0, 0)] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        leaf, before = tree.place(lengths[i])
        out[i] = (leaf, capacity - before)
    return out


def pack(pieces: DataFrame, n_docs: int, size: int = SEQUENCE_TOKENS, group_docs: int = GROUP_DOCS) -> DataFrame:
    """``pieces`` (with ``length`` of 1 to ``size``; other columns are kept)
    plus ``sequence_id`` and ``offset``. ``n_docs``: rows that the pieces came
    from, of which each leaves one piece below ``size`` at most."""
    groups = max(1, -(-n_docs // group_docs))
    pieces = materialize(pieces, "pieces")  # both branches below read them; texts are encoded once
    # An odd sequence id is a packed one, an even one a full piece's own.
    full = pieces.where(F.col("length") >= size).select(
        "*", (F.monotonically_increasing_id() * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = pieces.where(F.col("length") < size).withColumn("row_", F.monotonically_increasing_id())
    rest = rest.withColumn("group_", F.pmod(F.xxhash64("row_"), F.lit(groups)))

    def place(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("row_", kind="stable")
        at = first_fit_decreasing(pdf["length"].tolist(), size)
        base = int(pdf["group_"].iloc[0]) << 24
        return pdf.assign(sequence_id=[2 * (base + b) + 1 for b, _ in at], offset=[o for _, o in at])[out]

    out = [*pieces.columns, "sequence_id", "offset"]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    packed = rest.groupBy("group_").applyInPandas(place, f"{fields}, sequence_id long, offset long")
    return full.unionByName(packed)
