"""Jaccard join on word n-grams: T-occurrence search with DivideSkip.

A document is the set of its shingles (64-bit hashes); documents with one set
are one class. Two sets of similarity t or more have at least T = ceil(t * n)
shingles in common, n the size of either, so each shares a shingle of its
n - T + 1 rarest, in any order that holds for all sets, with the other's.
The order is by document counts, kept for all shingles in a table of fixed
size (cells that several shingles share only change the order, never a result).

A bucket is a shingle that several classes have among their rarest; a class
stays in it if, by sizes, places and numbers of shared shingles, it can be
linked with another one there. The sets of a bucket's classes get an inverted index, and each class asks for those
that occur T times in the lists of its shingles: the longest lists are set
aside, the short ones are merged with a heap, and what occurs there often
enough is looked up in the long ones by binary search. Counts are exact, so
the similarity is checked on them. Large buckets are dealt into blocks.

First every class goes to its largest bucket only. Then buckets that still hold
several components are searched (of those with the same classes, one). In a
block, classes of the largest component need not ask: all others do.

Defined results: null texts and texts without words have an empty set, are
linked with nothing and are their own component; a text with fewer words than
a shingle has its whole word sequence as its only one; every input row gives
a row, repeated rows too; a component's id is its smallest key, null keys
rank last; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import col, materialize, runs, slices, spread_join, text_or_empty
from starloom.llm.components import components
from starloom.llm.near_dup import class_id, shingle_set

CELL_BITS, RANGE_BITS = 22, 16
CELLS = 1 << CELL_BITS
#: Shingles that a task holds before they are counted.
HELD = 1 << 19
#: Shingles of a block's side, counting 256 at least for a set.
SET_BLOCK = 1 << 20
#: Share of the list lengths' logarithm in the cost of merging (DivideSkip's only parameter).
MU = 0.0085
#: Binary searches made at once.
PROBES = 1 << 20
#: Classes or texts that a task remembers to have handed on.
REMEMBERED = 200_000
#: Members of a bucket that are compared by shifts of the sorted rows, and those compared by a matrix at most.
NEIGHBOURS, MATRIX_ROWS = 64, 4096
#: Bits of the filter that keeps texts nobody needs from being moved.
FILTER_BITS = 26


def least_overlap(size: int, percent: int) -> int:
    return -(-percent * size // 100)


def _cells(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def _add(counters: np.ndarray, held: list[np.ndarray]) -> None:
    cells, n = np.unique(_cells(np.concatenate(held)), return_counts=True)
    counters[cells] += n.astype(np.uint32)


def _ranges(values: np.ndarray, size: int) -> Iterator[pa.RecordBatch]:
    """The parts of an array that hold anything, packed."""
    for i, part in enumerate(values.reshape(-1, size)):
        if part.any():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())],
                                             ["range", "packed"])


_SIGNED = "text_id string, n_shingles long, cid long, range int, packed binary"


def _sign(size: int):
    """Set size and class of every row; then the task's shingle counts by cell."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters, held, n_held, schema = np.zeros(CELLS, np.uint32), [], 0, None
        for b in slices(batches):
            schema = pa.schema([b.schema.field("key"), b.schema.field("text_id"), ("n_shingles", pa.int64()), ("cid", pa.int64()),
                                ("range", pa.int32()), ("packed", pa.binary())])
            n, cid = [], []
            for text in b.column("text").to_pylist():
                s = shingle_set(text, size)
                n.append(len(s))
                cid.append(class_id(s) if len(s) else None)
                held.append(s)
                n_held += len(s)
            if n_held > HELD:
                _add(counters, held)
                held, n_held = [], 0
            made = {"key": b.column("key"), "text_id": b.column("text_id"), "n_shingles": pa.array(n, pa.int64()), "cid": pa.array(cid, pa.int64())}
            yield pa.RecordBatch.from_arrays([made.get(f.name, pa.nulls(len(n), f.type)) for f in schema], schema=schema)
        if schema is None:
            return
        if held:
            _add(counters, held)
        for part in _ranges(counters, 1 << RANGE_BITS):
            made = dict(zip(part.schema.names, part.columns))
            yield pa.RecordBatch.from_arrays([made.get(f.name, pa.nulls(1, f.type)) for f in schema], schema=schema)
    return run


def _sum_counters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of all tasks, as bytes on a logarithmic scale."""
    for t in runs(batches, ["range"]):
        total = np.zeros(1 << RANGE_BITS, np.uint64)
        for packed in t.column("packed"):
            total += np.frombuffer(zlib.decompress(packed.as_py()), np.uint32)
        level = np.minimum(np.rint(8 * np.log2(1 + total.astype(np.float64))), 255).astype(np.uint8)
        yield pa.RecordBatch.from_arrays([t.column("range").slice(0, 1).combine_chunks(), pa.array([level.tobytes()], pa.binary())],
                                         ["range", "part"])


def _marks(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h, low = hashes.view(np.uint64), np.uint64((1 << FILTER_BITS) - 1)
    return (h & low).astype(np.int64), ((h >> np.uint64(FILTER_BITS)) & low).astype(np.int64)


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bits = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    for b in batches:
        for at in _marks(b.column("hash").to_numpy()):
            np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
    yield from _ranges(bits, 1 << RANGE_BITS)


def _unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for t in runs(batches, ["range"]):
        bits = np.zeros(1 << RANGE_BITS, np.uint8)
        for packed in t.column("packed"):
            bits |= np.frombuffer(zlib.decompress(packed.as_py()), np.uint8)
        yield pa.RecordBatch.from_arrays([t.column("range").slice(0, 1).combine_chunks(), pa.array([bits.tobytes()], pa.binary())],
                                         ["range", "part"])


def gather(parts: DataFrame, unite, size: int) -> bytes:
    """An array of fixed size from its (range, packed) parts, united by Spark."""
    out = bytearray(size)
    united = parts.select("range", "packed").repartition("range").sortWithinPartitions("range").mapInArrow(unite, "range int, part binary")
    for r in united.collect():
        out[r.range << RANGE_BITS:(r.range + 1) << RANGE_BITS] = r.part
    return bytes(out)


def _wanted(filter_):
    """Rows whose hash is marked, each text once a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, done = np.frombuffer(filter_.value, np.uint8), set()
        for b in batches:
            keep = np.ones(b.num_rows, bool)
            for at in _marks(b.column("hash").to_numpy()):
                keep &= (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
            ids = b.column("text_id")
            for i in np.flatnonzero(keep).tolist():
                name = ids[i].as_py()
                if name in done:
                    keep[i] = False
                elif len(done) < REMEMBERED:
                    done.add(name)
            yield b.select(["text_id", "text"]).filter(pa.array(keep))
    return run


def _prefix(size: int, percent: int, levels):
    """The rarest shingles of every class and their places, once a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = np.frombuffer(levels.value, np.uint8)
        done: set[int] = set()
        for b in slices(batches):
            token, cid, place, sizes = [], [], [], []
            for text in b.column("text").to_pylist():
                s = shingle_set(text, size)
                if not len(s) or (c := class_id(s)) in done:
                    continue
                if len(done) > REMEMBERED:
                    done.clear()
                done.add(c)
                n = len(s)
                first = np.argsort(level[_cells(s)], kind="stable")[:n - least_overlap(n, percent) + 1]
                token.append(s[first].view(np.int64))
                cid.append(np.full(len(first), c, np.int64))
                place.append(np.arange(len(first), dtype=np.int32))
                sizes.append(np.full(len(first), n, np.int32))
            if token:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (token, cid, place, sizes)],
                                                 ["token", "cid", "place", "size"])
    return run


def may_link(percent: int, size, place, shared, size_, place_, shared_):
    """Whether two sets that meet at a shingle can be linked and meet there
    first. With o shingles in common at least, the first common one has at most
    size - o others before it in either set, and the rarest of both have
    o - T + 1 in common, T the larger set's least overlap: a set that shares
    fewer of its rarest with anyone is out."""
    least = -(-percent * (size + size_) // (100 + percent))
    larger = np.maximum(size, size_)
    common = least + percent * -larger // 100 + 1
    return (100 * np.minimum(size, size_) >= percent * larger) & (place <= size - least) & (place_ <= size_ - least) \
        & (np.minimum(shared, shared_) >= common)


def _matched(percent: int, bucket: np.ndarray, rest: list[np.ndarray]) -> np.ndarray:
    """Rows (sorted by bucket) that may be linked with another one of their bucket."""
    hit = np.zeros(len(bucket), bool)
    edges = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
    sizes = np.diff(edges)
    small = np.repeat(sizes <= NEIGHBOURS, sizes)
    for d in range(1, min(NEIGHBOURS, int(sizes.max(initial=1)))):
        i = np.flatnonzero((bucket[:-d] == bucket[d:]) & small[:-d])
        i = i[may_link(percent, *(x[i] for x in rest), *(x[i + d] for x in rest))]
        hit[i] = hit[i + d] = True
    for at, n in zip(edges[:-1][sizes > NEIGHBOURS].tolist(), sizes[sizes > NEIGHBOURS].tolist()):
        if n > MATRIX_ROWS:
            hit[at:at + n] = True  # goes on as it is, to be searched in blocks
            continue
        own = [x[at:at + n] for x in rest]
        for r in range(0, n, 256):
            near = may_link(percent, *(x[r:r + 256, None] for x in own), *(x[None, :] for x in own))
            near[np.arange(len(near)), np.arange(r, r + len(near))] = False
            hit[at + r:at + r + len(near)] |= near.any(axis=1)
    return hit


def _possible(percent: int):
    """Members that can have a partner in their bucket."""
    names = ["bucket", "cid", "size", "place", "shared"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None

        def found(columns):
            hit = _matched(percent, columns[0], columns[2:])
            return pa.RecordBatch.from_arrays([pa.array(x[hit]) for x in columns[:2]], names[:2])

        for b in batches:
            if not b.num_rows:
                continue
            new = [b.column(c).to_numpy().astype(np.int64) for c in names]
            held = new if held is None else [np.concatenate(x) for x in zip(held, new)]
            # The last bucket may go on in the next batch.
            last = int(np.searchsorted(held[0], held[0][-1]))
            if last:
                yield found([x[:last] for x in held])
                held = [x[last:] for x in held]
        if held is not None:
            yield found(held)
    return run


class Index:
    """Inverted lists of a block's sets."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets, self.n = sets, len(sets)
        self.sizes = np.array([len(s) for s in sets], np.int64)
        tokens, self.lists = np.unique(np.concatenate(sets), return_inverse=True)
        # A posting is list * n + member; sorted, a list's members are consecutive and ascending.
        self.postings = np.sort(self.lists * self.n + np.repeat(np.arange(self.n), self.sizes))
        self.starts = np.searchsorted(self.postings, np.arange(len(tokens) + 1) * self.n)
        self.ends = np.cumsum(self.sizes)

    def partners(self, x: int, percent: int) -> np.ndarray:
        """Members whose sets have the similarity asked for with set ``x``."""
        size = int(self.sizes[x])
        least = least_overlap(size, percent)
        lists = self.lists[self.ends[x] - size:self.ends[x]]
        length = self.starts[lists + 1] - self.starts[lists]
        shared = length > 1  # the others hold x alone
        lists, length = lists[shared], length[shared]
        if len(lists) < least:
            return np.zeros(0, np.int64)
        order = np.argsort(length, kind="stable")
        lists = lists[order]
        longest = int(length[order[-1]])
        aside = min(least - 1, int(least / (MU * math.log2(longest) + 1)))
        short, long = lists[:len(lists) - aside], lists[len(lists) - aside:]
        found, times = [], []
        merged = heapq.merge(*((self.postings[self.starts[k]:self.starts[k + 1]] - k * self.n).tolist() for k in short.tolist()))
        for member, occurrences in groupby(merged):
            n = sum(1 for _ in occurrences)
            if n >= least - aside and member != x:
                found.append(member)
                times.append(n)
        member, total = np.array(found, np.int64), np.array(times, np.int64)
        if not len(member):
            return member
        # The similarity bounds the sizes of partners on both sides.
        fits = (100 * self.sizes[member] >= percent * size) & (percent * self.sizes[member] <= 100 * size)
        member, total = member[fits], total[fits]
        step = max(1, PROBES // max(1, len(member)))
        for at in range(0, len(long), step):
            probes = long[at:at + step, None] * self.n + member
            place = np.minimum(np.searchsorted(self.postings, probes), len(self.postings) - 1)
            total = total + (self.postings[place] == probes).sum(axis=0)
            left = len(long) - at - step
            member, total = (v[total + max(0, left) >= least] for v in (member, total))
            if not len(member):
                return member
        return member[100 * total >= percent * (size + self.sizes[member] - total)]


def join_components(sets: list[np.ndarray], root: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links that join the components of a block's members."""
    _, root = np.unique(root, return_inverse=True)
    index, asked, out = Index(sets), np.zeros(len(sets), bool), []
    while True:
        waiting = ~asked & (root != np.bincount(root).argmax())
        if not waiting.any():
            return out
        x = int(waiting.argmax())
        asked[x] = True
        for y in index.partners(x, percent).tolist():
            if root[y] != root[x]:
                out.append((x, y))
                root[root == root[y]] = root[x]


def _search(size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs(batches, ["bucket", "i", "j"]):
            cid, first = np.unique(t.column("cid").to_numpy(), return_index=True)
            texts = t.column("text")
            sets = [shingle_set(texts[int(i)].as_py(), size) for i in first]
            links = join_components(sets, t.column("root").to_numpy()[first], percent)
            yield pa.RecordBatch.from_arrays([pa.array([int(cid[p[k]]) for p in links], pa.int64()) for k in (0, 1)], ["a", "b"])
    return run


class Join:
    """Links between classes, found in two rounds over the buckets."""

    def __init__(self, docs: DataFrame, classes: DataFrame, size: int, percent: int, levels: bytes):
        self.size, self.percent = size, percent
        spark = docs.sparkSession
        self.tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
        made = docs.select("text").mapInArrow(_prefix(size, percent, spark.sparkContext.broadcast(levels)),
                                              "token long, cid long, place int, size int")
        made = materialize(made, "prefixes")
        shared = made.groupBy("token").agg(F.min("cid").alias("lo"), F.max("cid").alias("hi"), F.count("*").alias("n")) \
            .where("lo <> hi").select("token", "n")
        met = spread_join(made, materialize(shared, "shared"), "token", "n")
        met = materialize(met.select(F.col("token").alias("bucket"), "cid", "place", "size").distinct(), "met")
        met = met.join(met.groupBy("cid").agg(F.count("*").alias("shared")), "cid")
        self.members = materialize(met.repartition(self.tasks, "bucket").sortWithinPartitions("bucket")
                                   .mapInArrow(_possible(percent), "bucket long, cid long"), "members")
        need = self.members.select("cid").distinct().join(classes.select("cid", "text_id", F.col("n_shingles").alias("size")), "cid")
        self.texts = self.texts_of(docs, materialize(need, "need"))
        self.roots = spark.createDataFrame([], "node long, root long")

    @staticmethod
    def texts_of(docs: DataFrame, need: DataFrame) -> DataFrame:
        """(cid, size, text) of the classes in ``need``. A filter of fixed size keeps
        back the rows that are not wanted (but for a few, which the join
        drops); it says which rows may be left out, never which ones count."""
        hashed = F.xxhash64("text_id").alias("hash")
        wanted = gather(need.select(hashed).mapInArrow(_mark, "range int, packed binary"), _unite, 1 << (FILTER_BITS - 3))
        rows = docs.select("text_id", "text", hashed).mapInArrow(
            _wanted(docs.sparkSession.sparkContext.broadcast(wanted)), "text_id string, text string")
        return materialize(rows.dropDuplicates(["text_id"]).join(need, "text_id").select("cid", "size", "text"), "texts")

    def rooted(self, rows: DataFrame) -> DataFrame:
        """``rows`` and the root of their ``cid``."""
        return rows.join(self.roots.withColumnRenamed("node", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))

    def search(self, rows: DataFrame) -> None:
        """Look for links in the buckets of ``rows`` (bucket, cid, root), in
        blocks whose sides have about SET_BLOCK shingles."""
        rows = materialize(rows, "searched")
        loads = rows.join(self.texts.select("cid", "size"), "cid").groupBy("bucket").agg(
            F.ceil(F.sum(F.greatest("size", F.lit(256))) / SET_BLOCK).cast("int").alias("parts"), F.count("*").alias("n"))
        parted = spread_join(rows, materialize(loads, "loads"), "bucket", "n") \
            .withColumn("part", F.pmod(F.xxhash64("cid"), F.col("parts")).cast("int")) \
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        blocks = parted.select("bucket", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "cid", "root") \
            .join(self.texts.select("cid", "text"), "cid")
        found = blocks.repartition(self.tasks, "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j") \
            .mapInArrow(_search(self.size, self.percent), "a long, b long")
        found = materialize(found, "links")
        if not found.isEmpty():
            known = self.roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
            self.roots = components(found.unionByName(known))

    def at_home(self) -> DataFrame:
        """Every class in its largest bucket."""
        sizes = materialize(self.members.groupBy("bucket").agg(F.count("*").alias("n")), "sizes")
        home = spread_join(self.members, sizes, "bucket", "n").groupBy("cid").agg(F.max(F.struct("n", "bucket")).alias("h")) \
            .select("cid", "h.bucket")
        home = materialize(home, "home")
        shared = home.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
        return spread_join(home, materialize(shared, "homes"), "bucket", "n").select("bucket", "cid", F.col("cid").alias("root"))

    def open_buckets(self) -> DataFrame:
        """Buckets that hold several components; of those with the same classes, one."""
        rows = materialize(self.rooted(self.members), "rooted")
        split = rows.groupBy("bucket").agg(
            F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("n"), F.bit_xor(F.xxhash64("cid")).alias("x"),
            F.sum(F.xxhash64("cid", F.lit(1)).cast("decimal(38,0)")).alias("y")).where("lo <> hi")
        once = split.groupBy("n", "x", "y").agg(F.min("bucket").alias("bucket")).select("bucket", "n")
        return spread_join(rows, materialize(once, "open"), "bucket", "n").select("bucket", "cid", "root")


def ngram_join(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """(key, n_shingles, component) of every row: documents whose shingle
    sets have 100 * |both| >= percent * |either| are linked."""
    words = text_or_empty(docs, text)
    rows = docs.select(col(docs, key).alias("key"), F.md5(words.cast("binary")).alias("text_id"), words.alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    signed = materialize(rows.mapInArrow(_sign(shingle_words), f"key {kind}, {_SIGNED}"), "signed")
    levels = gather(signed.where("range is not null"), _sum_counters, CELLS)
    signed = signed.where("range is null").select("key", "text_id", "n_shingles", "cid")
    classes = materialize(signed.where("cid is not null").groupBy("cid").agg(
        F.min("key").alias("key"), F.min("text_id").alias("text_id"), F.max("n_shingles").alias("n_shingles"), F.count("*").alias("n")),
        "classes")
    join = Join(rows, classes, shingle_words, percent, levels)
    join.search(join.at_home())
    join.search(join.open_buckets())
    rooted = materialize(join.rooted(classes.select("cid", "key", "n")), "class-roots")
    smallest = rooted.groupBy("root").agg(F.min("key").alias("component"), F.count("*").alias("classes"))
    of_class = spread_join(rooted.withColumnRenamed("n", "copies"), materialize(smallest, "components"), "root", "classes")
    of_class = materialize(of_class.select("cid", "component", F.col("copies").alias("n")), "class-components")
    linked = spread_join(signed.where("cid is not null").select("key", "n_shingles", "cid"), of_class, "cid", "n") \
        .select("key", "n_shingles", "component")
    empty = signed.where("cid is null").select("key", "n_shingles", F.col("key").alias("component"))
    return linked.unionByName(empty)
