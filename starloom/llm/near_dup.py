"""Near-duplicates: MinHash bands, odd sketches, exact confirmation.

Each document's set of word shingles (64-bit hashes) gives SAMPLES MinHash
values. Bands of ROWS values propose candidates; at the similarities asked for
a pair shares one of the BANDS bands but for about one in 10^7. The same samples,
numbered, are folded into an odd sketch: a bitmap in which each sample flips
one bit. The population count of two sketches' XOR estimates how many samples
differ, and a pair goes on only if its estimate is within DEVIATIONS standard
deviations of the threshold. What goes on is confirmed on the full sets.

Documents with one set are one class and enter once, however many copies there
are. In a band bucket all members are compared with LEADERS leaders, never each
with each. Only buckets that then still hold members of different components
have more to tell (of buckets with the same members, one). Their sketches are
compared across components in blocks of bounded size, and a member goes on if
any sketch of another component is close. The sets of those members meet in
blocks again: counts of common shingles are one matrix product, and a block gives
at most the links that join its components - never its pairs.

Defined results: null texts and texts without words have an empty set, are
linked with nothing and are their own component; a text with fewer words than
a shingle has its whole word sequence as its only one; every input row gives
a row, repeated rows too; a component's id is its smallest key, null keys
rank last; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import col, materialize, slices, text_or_empty
from starloom.llm.components import components

BANDS, ROWS = 32, 4
SAMPLES = BANDS * ROWS
SKETCH_WORDS = 16  # of 64 bits
SKETCH_BITS = 64 * SKETCH_WORDS
DEVIATIONS = 4.5
LEADERS = 2
SKETCH_BLOCK = 2048  # sketches of a block's side
SET_BLOCK = 1 << 20  # shingles of a block's side, counting 1024 at least for a set
COLUMNS = 4096  # shingles of one matrix product
CACHE_WORDS = 150_000

_random = np.random.default_rng(20240101)
_MUL = _random.integers(0, 1 << 63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _random.integers(0, 1 << 63, SAMPLES, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)  # odd; weights of the words in a shingle are its powers
_NUMBER = np.arange(1, SAMPLES + 1, dtype=np.uint64) * _STEP


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_hash = _WordHash()


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: nearby inputs give unrelated outputs."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of ``size`` words, A-Z
    lower-cased; of the whole sequence if there are fewer words."""
    # bytes.lower() maps A-Z alone and bytes.split() parts at 0x20 and 0x09-0x0D.
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_hash.__getitem__, words), np.uint64, len(words))
    n = min(size, len(h))
    total, weight = np.full(len(h) - n + 1, n, np.uint64), np.uint64(1)
    with np.errstate(over="ignore"):
        for i in range(n):
            weight = weight * _STEP
            total += h[i:len(h) - n + 1 + i] * weight
        return np.unique(mix(total))


def samples(shingles: np.ndarray) -> np.ndarray:
    """The MinHash values of a set that is not empty."""
    least = np.full(SAMPLES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 1024):
        np.minimum(least, (shingles[at:at + 1024, None] * _MUL + _ADD).min(axis=0), out=least)
    return least


def bands(values: np.ndarray) -> np.ndarray:
    """One 64-bit hash a band; bands with other numbers never agree."""
    rows = mix(values + _NUMBER).reshape(BANDS, ROWS)
    total = rows[:, 0].copy()
    for i in range(1, ROWS):
        total = mix(total * _STEP + rows[:, i])
    return total.view(np.int64)


def odd_sketch(values: np.ndarray) -> np.ndarray:
    """Parity bitmap of the numbered samples."""
    bit = (mix(values ^ _NUMBER) % np.uint64(SKETCH_BITS)).astype(np.int64)
    parity = (np.bincount(bit, minlength=SKETCH_BITS) & 1).astype(np.uint8)
    return np.packbits(parity).view(np.int64)


def most_bits(similarity: float) -> int:
    """The largest XOR population count of two sketches that goes on to
    confirmation."""
    least = similarity - DEVIATIONS * (similarity * (1 - similarity) / SAMPLES) ** 0.5
    flips = 2 * SAMPLES * (1 - least)
    mean = SKETCH_BITS / 2 * (1 - (1 - 2 / SKETCH_BITS) ** flips)
    return int(np.ceil(mean))


def differing_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """XOR population counts of rows of sketches."""
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)


def _sketches(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, SKETCH_WORDS)


def _close(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 4096):
            near = differing_bits(_sketches(b.column("sa")), _sketches(b.column("sb"))) <= limit
            yield b.select(["a", "b"]).filter(pa.array(near))
    return run


def blocks(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.Table]:
    """Runs of rows that agree in ``names``, from rows sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        codes = [b.column(c).to_numpy() for c in names]
        new = np.zeros(b.num_rows - 1, bool)
        for c in codes:
            new |= c[1:] != c[:-1]
        edges = [0, *(np.flatnonzero(new) + 1).tolist(), b.num_rows]
        for s, e in zip(edges, edges[1:]):
            this = tuple(c[s] for c in codes)
            if held and this != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(b.slice(s, e - s))
            last = this
    if held:
        yield pa.Table.from_batches(held)


def _sides(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the block's first and second side (the same for a block with itself)."""
    part, i, j = (t.column(c).to_numpy() for c in ("part", "i", "j"))
    return np.flatnonzero(part == i), np.flatnonzero(part == j)


def _near_members(limit: int):
    """Members with a close sketch of another component in their block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in blocks(batches, ["bucket", "i", "j"]):
            root = t.column("root").to_numpy()
            sketch = _sketches(t.column("sketch"))
            x, y = _sides(t)
            hit = np.zeros(t.num_rows, bool)
            for at in range(0, len(x), 64):
                rows = x[at:at + 64]
                near = (root[rows][:, None] != root[y][None, :]) & (differing_bits(sketch[rows][:, None, :], sketch[y][None, :, :]) <= limit)
                hit[rows[near.any(axis=1)]] = True
                hit[y[near.any(axis=0)]] = True
            yield from t.select(["bucket", "cid", "root"]).filter(pa.array(hit)).combine_chunks().to_batches()
    return run


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets."""
    n = len(sets)
    total = np.zeros((n, n), np.int64)
    if not n:
        return total
    values, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(n), [len(x) for x in sets])
    shared = np.flatnonzero(count > 1)
    place = np.full(len(values), -1, np.int64)
    place[shared] = np.arange(len(shared))
    column = place[column]
    row, column = row[column >= 0], column[column >= 0]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for at in range(0, len(shared), COLUMNS):
        s, e = np.searchsorted(column, [at, at + COLUMNS])
        dense = np.zeros((n, COLUMNS), np.float32)
        dense[row[s:e], column[s:e] - at] = 1
        total += (dense @ dense.T).astype(np.int64)
    np.fill_diagonal(total, [len(x) for x in sets])
    return total


def _block_links(percent: int):
    """Links that join the components of a block, by exact counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in blocks(batches, ["bucket", "i", "j"]):
            cid, root = t.column("cid").to_numpy(), t.column("root").to_numpy()
            sets = [np.frombuffer(x, np.uint64) for x in t.column("set").to_pylist()]
            size = np.array([len(x) for x in sets], np.int64)
            both = common_counts(sets)
            linked = (100 * both >= percent * (size[:, None] + size[None, :] - both)) & (root[:, None] != root[None, :])
            now = dict.fromkeys(root.tolist())
            now = {r: r for r in now}

            def find(r: int) -> int:
                while now[r] != r:
                    r = now[r]
                return r
            out = []
            for x, y in zip(*(v.tolist() for v in np.nonzero(np.triu(linked, 1)))):
                p, q = find(int(root[x])), find(int(root[y]))
                if p != q:
                    now[p] = q
                    out.append((int(cid[x]), int(cid[y])))
            yield pa.RecordBatch.from_arrays([pa.array([v[k] for v in out], pa.int64()) for k in (0, 1)], ["a", "b"])
    return run


_SIGNED = "text_hash long, n_shingles long, cid long, bands array<long>, sketch binary"


def _sign(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longs = pa.list_(pa.int64())
        for b in slices(batches):
            n, cid, band, sketch = [], [], [], []
            for text in b.column("text").to_pylist():
                s = shingle_set(text, size)
                n.append(len(s))
                if not len(s):
                    cid.append(None)
                    band.append(None)
                    sketch.append(None)
                    continue
                with np.errstate(over="ignore"):
                    values = samples(s)
                    band.append(bands(values))
                    sketch.append(odd_sketch(values).tobytes())
                cid.append(class_id(s))
            yield pa.RecordBatch.from_arrays(
                [b.column("key"), b.column("text_hash"), pa.array(n, pa.int64()), pa.array(cid, pa.int64()), pa.array(band, longs), pa.array(sketch, pa.binary())],
                ["key", "text_hash", "n_shingles", "cid", "bands", "sketch"])
    return run


def class_id(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.md5(shingles.tobytes()).digest()[:8], "little", signed=True)


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 64):
            cids, sets = [], []
            for cid, text in zip(b.column("cid").to_pylist(), b.column("text").to_pylist()):
                s = shingle_set(text, size)
                if len(s) and class_id(s) == cid:  # a repeated key may bring another text
                    cids.append(cid)
                    sets.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(cids, pa.int64()), pa.array(sets, pa.binary())], ["cid", "set"])
    return run


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 64):
            linked = []
            for x, y in zip(b.column("set_a").to_pylist(), b.column("set_b").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(x) + len(y) - len(np.union1d(x, y))
                linked.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], ["a", "b"]).filter(pa.array(linked, pa.bool_()))
    return run


class Links:
    """Confirmed links between classes, found round by round."""

    def __init__(self, docs: DataFrame, classes: DataFrame, size: int, percent: int):
        self.docs, self.classes, self.size, self.percent = docs, classes, size, percent
        self.limit = most_bits(percent / 100)
        buckets = classes.select("cid", F.explode("bands").alias("bucket"))
        shared = buckets.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
        self.buckets = materialize(buckets.join(shared, "bucket").select("bucket", "cid", "n"), "buckets")
        self.roots = docs.sparkSession.createDataFrame([], "node long, root long")

    def sets_of(self, ends: DataFrame) -> DataFrame:
        """(cid, set) of the classes in ``ends``."""
        # By key and text, so that rows of one key do not all meet each other's classes.
        need = self.classes.join(ends.select("cid").distinct(), "cid").select("cid", "at")
        texts = self.docs.select(F.struct("key", "text_hash").alias("at"), "text").join(need, "at").select("cid", "text")
        sets = texts.mapInArrow(_sets(self.size), "cid long, set binary")
        return materialize(sets.groupBy("cid").agg(F.first("set").alias("set")), "sets")

    def join_up(self, linked: DataFrame) -> None:
        """Bring the components up to date."""
        linked = materialize(linked, "confirmed")
        if not linked.isEmpty():
            known = self.roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
            self.roots = components(linked.unionByName(known))

    def rooted(self, rows: DataFrame) -> DataFrame:
        """``rows`` and the root of their ``cid``."""
        return rows.join(self.roots.withColumnRenamed("node", "cid"), "cid", "left") \
            .withColumn("root", F.coalesce("root", "cid"))

    def by_leaders(self) -> None:
        """Members of every bucket against its LEADERS leaders."""
        names = [f"lead{i}" for i in range(LEADERS)]
        rank = lambda i: F.struct(F.xxhash64("cid", F.lit(i)), F.col("cid").alias("cid"))
        leaders = self.buckets.groupBy("bucket").agg(*(F.min(rank(i)).alias(x) for i, x in enumerate(names)))
        met = self.buckets.join(leaders, "bucket") \
            .select("cid", F.explode(F.array(*(f"{x}.cid" for x in names))).alias("lead")).where("cid <> lead")
        met = met.select(F.least("cid", "lead").alias("a"), F.greatest("cid", "lead").alias("b")).distinct()
        of = lambda side: self.classes.select(F.col("cid").alias(side), F.col("sketch").alias(f"s{side}"))
        pairs = materialize(met.join(of("a"), "a").join(of("b"), "b").mapInArrow(_close(self.limit), "a long, b long"), "pairs")
        sets = self.sets_of(pairs.select(F.explode(F.array("a", "b")).alias("cid")))
        of = lambda side: sets.select(F.col("cid").alias(side), F.col("set").alias(f"set_{side}"))
        self.join_up(pairs.join(of("b"), "b").join(of("a"), "a").select("a", "b", "set_a", "set_b")
                     .mapInArrow(_confirm(self.percent), "a long, b long"))

    def open_buckets(self) -> DataFrame:
        """(bucket, cid, root) of the buckets that hold more than one
        component; of buckets with the same members, one."""
        rooted = materialize(self.rooted(self.buckets), "rooted")
        split = rooted.groupBy("bucket").agg(
            F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("n"),
            F.bit_xor(F.xxhash64("cid")).alias("x"), F.sum(F.xxhash64("cid", F.lit(1)).cast("decimal(38,0)")).alias("y")).where("lo <> hi")
        once = split.groupBy("n", "x", "y").agg(F.min("bucket").alias("bucket"))
        return rooted.join(once.select("bucket"), "bucket")

    def dealt(self, rows: DataFrame, load, most: int, columns: list[str]) -> DataFrame:
        """``rows`` of buckets dealt into blocks whose sides carry about ``most``
        of ``load``, sorted by (bucket, i, j)."""
        loads = rows.groupBy("bucket").agg(F.ceil(F.sum(load) / most).cast("int").alias("parts"))
        parted = rows.join(loads, "bucket").withColumn("part", F.pmod(F.xxhash64("cid"), F.col("parts")).cast("int")) \
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        parted = parted.select("bucket", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", *columns)
        tasks = max(1, int(self.docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        return parted.repartition(tasks, "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")

    def by_block(self) -> None:
        """Members of open buckets against members of other components."""
        rows = materialize(self.open_buckets().join(self.classes.select("cid", "sketch"), "cid"), "open")
        near = self.dealt(rows, F.lit(1), SKETCH_BLOCK, ["cid", "root", "sketch"]) \
            .mapInArrow(_near_members(self.limit), "bucket long, cid long, root long")
        near = materialize(near.distinct(), "near")
        if near.isEmpty():
            return
        # Members that are left may again be the same ones in many buckets.
        alike = near.groupBy("bucket").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("cid")).alias("x"),
                                           F.sum(F.xxhash64("cid", F.lit(1)).cast("decimal(38,0)")).alias("y"))
        near = near.join(alike.groupBy("n", "x", "y").agg(F.min("bucket").alias("bucket")).select("bucket"), "bucket")
        with_sets = near.join(self.sets_of(near), "cid")
        self.join_up(self.dealt(with_sets, F.greatest(F.octet_length("set") / 8, F.lit(1024)), SET_BLOCK, ["cid", "root", "set"])
                     .mapInArrow(_block_links(self.percent), "a long, b long"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle_words: int = 5,
                    percent: int = 80) -> DataFrame:
    """(key, n_shingles, component, kept) of every row: documents whose
    shingle sets have 100 * |both| >= percent * |either| are linked."""
    words = text_or_empty(docs, text)
    rows = docs.select(col(docs, key).alias("key"), F.xxhash64(words).alias("text_hash"), words.alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    signed = materialize(rows.mapInArrow(_sign(shingle_words), f"key {kind}, {_SIGNED}"), "signed")
    classes = materialize(
        signed.where(F.col("cid").isNotNull()).groupBy("cid")
        .agg(F.min("key").alias("key"), F.min(F.struct("key", "text_hash")).alias("at"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")), "classes")
    links = Links(rows, classes, shingle_words, percent)
    links.by_leaders()
    links.by_block()
    rooted = links.rooted(classes.select("cid", "key"))
    smallest = rooted.groupBy("root").agg(F.min("key").alias("component"))
    of_class = rooted.join(smallest, "root").select("cid", "component")
    with_set = signed.where(F.col("cid").isNotNull()).select("key", "n_shingles", "cid").join(of_class, "cid") \
        .select("key", "n_shingles", "component")
    empty = signed.where(F.col("cid").isNull()).select("key", "n_shingles", F.col("key").alias("component"))
    return with_set.unionByName(empty).withColumn("kept", F.col("key").eqNullSafe(F.col("component")))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the one
    with the smallest (key, hash of the text), null keys first; of repeated rows (equal key
    and text) one. Texts without words are no duplicates of each other."""
    own = F.struct(col(docs, key).alias("key"), F.xxhash64(text_or_empty(docs, text)).alias("h"))
    keyed = docs.select(own.alias("k"), text_or_empty(docs, text).alias("t"))
    kept = near_duplicates(keyed, "k", "t", shingle_words, percent).where("kept").select(F.col("key").alias("k")).distinct()
    row = F.struct(*(col(docs, c).alias(f"c{i}") for i, c in enumerate(docs.columns)))
    # One of each (key, text) before the shuffle, so repeated rows do not meet in one task.
    once = docs.select(own.alias("k"), row.alias("r")).groupBy("k").agg(F.first("r").alias("r"))
    return once.join(kept, "k", "left_semi").select(*(F.col(f"r.c{i}").alias(c) for i, c in enumerate(docs.columns)))
