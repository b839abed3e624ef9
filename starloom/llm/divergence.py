"""Divergence of sources: hash-consed segment trees over term ids.

Terms are counted by (lang, source); those in at least ``min_docs`` documents
of their language are kept. Terms are dealt to buckets by hash; in a bucket
the kept terms of a language are numbered in UTF-8 order, and the counts of a
group (a source of the language) are the leaves of a segment tree over those
numbers. Nodes are hash-consed: equal subtrees of any groups are one node.
Two groups are compared by walking both trees at once from the roots; equal
pairs of nodes met on a level are walked once and carry their number, so a
pair of leaves (two counts) is priced once however often it occurs.

The price of a term is floor((p - q)^2 / q) with p = 1 + floor(SCALE * (count
+ 1) / (N + V)), V kept terms of the language, N their occurrences in the
group; all arithmetic is on integers and exact.

Defined results: null texts, languages and sources count as ''; a group
without terms has zero counts; repeated rows are documents of their own; a
language without kept terms has pairs of value 0 and no terms; an empty
table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import materialize, runs, text_or_empty

SCALE = 1_000_000_000
#: Entries that a task counts before it hands them on.
FLUSH = 400_000
#: Groups on each side of a comparison block.
GROUPS = 512
#: Distinct pairs of nodes that are walked together.
WALK = 1 << 18
_SAFE = (2**63 - 1) // SCALE - 1

#: Letters A-Z to a-z; all bytes that are no letter and below 0x80 part terms.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))

_COUNTED = "lang string, source string, term binary, n long, docs long"
_KEPT = "lang string, bucket int, source string, whole boolean, terms binary, ids array<int>, counts array<long>"
_PRICED = "lang string, source string, part string, item string, value long"


def _batch(columns: dict[str, list], types: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[c], t) for c, t in types.items()], list(types))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of the terms of a task's groups."""
    def dealt(seen: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in seen.items():
            rows = len(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * rows, pa.string()), pa.array([source] * rows, pa.string()), pa.array(list(n), pa.binary()),
                 pa.array(list(n.values()), pa.int64()), pa.array(list(map(docs.__getitem__, n)), pa.int64())],
                ["lang", "source", "term", "n", "docs"])

    seen: dict[tuple, tuple[Counter, Counter]] = {}
    held = 0
    for b in batches:
        for lang, source, text in zip(*(b.column(c) for c in ("lang", "source", "text"))):
            terms = text.as_py().translate(_TERM_BYTES).split()
            if not terms:
                continue
            group = (lang.as_py(), source.as_py())
            n, docs = seen.get(group) or seen.setdefault(group, (Counter(), Counter()))
            held -= len(n)
            n.update(terms)
            docs.update(set(terms))
            held += len(n)
            if held > FLUSH:
                yield from dealt(seen)
                seen, held = {}, 0
    yield from dealt(seen)


def _total(place: np.ndarray, n: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(size, np.int64)
    np.add.at(out, place, n)
    return out


def _keep(min_docs: int):
    """Kept terms of a (lang, bucket) and the counts of its groups."""
    types = {"lang": pa.string(), "bucket": pa.int32(), "source": pa.string(), "whole": pa.bool_(), "terms": pa.binary(),
             "ids": pa.list_(pa.int32()), "counts": pa.list_(pa.int64())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs(batches, ["lang", "bucket"]):
            term = t.column("term").combine_chunks().dictionary_encode()
            source = t.column("source").combine_chunks().dictionary_encode()
            place, n = term.indices.to_numpy(), t.column("n").to_numpy()
            kept = np.flatnonzero(_total(place, t.column("docs").to_numpy(), len(term.dictionary)) >= min_docs)
            if not len(kept):
                continue
            kept = kept[pc.sort_indices(term.dictionary.take(pa.array(kept))).to_numpy()]  # by bytes
            number = np.full(len(term.dictionary), -1, np.int64)
            number[kept] = np.arange(len(kept))
            here = number[place] >= 0
            key, at = np.unique(source.indices.to_numpy()[here].astype(np.int64) * len(kept) + number[place[here]], return_inverse=True)
            counts = _total(at, n[here], len(key))
            owner, ids = np.divmod(key, len(kept))
            lang, bucket = t.column("lang")[0].as_py(), t.column("bucket")[0].as_py()
            words = b" ".join(term.dictionary.take(pa.array(kept)).to_pylist())
            made = [(None, True, words, None, _total(ids, counts, len(kept)))]
            edges = [0, *(np.flatnonzero(np.diff(owner)) + 1).tolist(), len(owner)]
            for s, e in zip(edges, edges[1:]):
                made.append((source.dictionary[int(owner[s])].as_py(), False, None, ids[s:e], counts[s:e]))
            yield _batch(dict(zip(types, map(list, zip(*((lang, bucket, *row) for row in made))))), types)
    return run


def shares(counts: np.ndarray, n: np.ndarray | int, v: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / (n + v)), exact for counts of any size."""
    if counts.size and counts.max() > _SAFE:
        counts = counts.astype(object)
    return 1 + SCALE * (counts + 1) // (n + v)


def prices(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / q); shares are at most SCALE + 1, their squares fit."""
    return (p - q) * (p - q) // q


class Trees:
    """Hash-consed segment trees of the rows of a count table."""

    def __init__(self, counts: np.ndarray):
        self.values, ids = np.unique(counts, return_inverse=True)
        ids = ids.reshape(counts.shape)
        width = 1 << max(0, counts.shape[1] - 1).bit_length()
        self.blank = len(self.values)  # the leaf beyond the last term
        ids = np.pad(ids, ((0, 0), (0, width - counts.shape[1])), constant_values=self.blank)
        size, self.levels = self.blank + 1, []
        while ids.shape[1] > 1:
            nodes, at = np.unique(ids[:, 0::2] * size + ids[:, 1::2], return_inverse=True)
            self.levels.append((nodes // size, nodes % size, size))
            ids, size = at.reshape(len(ids), -1), len(nodes)
        self.roots = ids[:, 0]

    def walk(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Trees ``a[i]`` and ``b[i]`` walked at once for every i: (i, count
        in a, count in b, times), each pair of counts once for an i."""
        i, x, y, times = np.arange(len(a)), self.roots[a], self.roots[b], np.ones(len(a), np.int64)
        for left, right, below in reversed(self.levels):
            i, times = np.concatenate([i, i]), np.concatenate([times, times])
            x, y = np.concatenate([left[x], right[x]]), np.concatenate([left[y], right[y]])
            key, at = np.unique((i * below + x) * below + y, return_inverse=True)
            total = np.zeros(len(key), np.int64)
            np.add.at(total, at, times)
            times = total
            i, key = np.divmod(key, below * below)
            x, y = np.divmod(key, below)
        real = x < self.blank  # both trees end at the same leaf
        return i[real], self.values[x[real]], self.values[y[real]], times[real]


def _price(top: int):
    types = {"lang": pa.string(), "source": pa.string(), "part": pa.string(), "item": pa.string(), "value": pa.int64()}

    def rows(made: list[tuple]) -> pa.RecordBatch:
        return _batch(dict(zip(types, map(list, zip(*made)))) if made else {c: [] for c in types}, types)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, int] = {}
        best: dict[tuple, list[tuple]] = {}  # of a group: its top (-value, term) so far
        for t in runs(batches, ["lang", "bucket", "i", "j"]):
            whole = t.filter(t.column("whole"))
            groups = t.filter(pc.invert(t.column("whole")))
            if not whole.num_rows or not groups.num_rows:
                continue
            lang, i, j = (t.column(c)[0].as_py() for c in ("lang", "i", "j"))
            terms = whole.column("terms")[0].as_py().split(b" ")
            source, part = groups.column("source").to_pylist(), groups.column("part").to_numpy()
            n, v = groups.column("n").to_numpy(), groups.column("v")[0].as_py()
            counts = np.zeros((groups.num_rows, len(terms)), np.int64)
            for row, (ids, own) in enumerate(zip(groups.column("ids"), groups.column("counts"))):
                if ids.is_valid:
                    counts[row, ids.values.to_numpy()] = own.values.to_numpy()
            if i == j:
                all_counts = whole.column("counts")[0].values.to_numpy()
                q = shares(all_counts, whole.column("n")[0].as_py(), v)
                for row in range(groups.num_rows):
                    p = shares(counts[row], n[row], v)
                    at = np.flatnonzero((counts[row] > 0) & (p > q))
                    f = prices(p[at], q[at])
                    own = best.setdefault((lang, source[row]), [])
                    if len(own) == top:
                        high = f >= -own[-1][0]
                        at, f = at[high], f[high]
                    if len(at):
                        own += ((-value, terms[k]) for k, value in zip(at.tolist(), f.tolist()))
                        best[lang, source[row]] = heapq.nsmallest(top, own)  # ties in UTF-8 order
            trees = Trees(counts)
            step = max(1, WALK // len(terms))
            x, y = np.triu_indices(groups.num_rows, 1)
            if i != j:
                across = part[x] != part[y]
                x, y = x[across], y[across]
            for at in range(0, len(x), step):
                a, b = x[at:at + step], y[at:at + step]
                k, ca, cb, times = trees.walk(a, b)
                p, q = shares(ca, n[a][k], v), shares(cb, n[b][k], v)
                for s, o, f in ((a, b, prices(p, q)), (b, a, prices(q, p))):
                    total = np.zeros(len(a), f.dtype)
                    np.add.at(total, k, f * times)
                    for one, other, value in zip(s.tolist(), o.tolist(), total.tolist()):
                        key = (lang, source[one], source[other])
                        sums[key] = sums.get(key, 0) + int(value)
            if len(sums) > FLUSH:
                yield rows([(g, s, "pair", o, x) for (g, s, o), x in sums.items()])
                sums = {}
        yield rows([(g, s, "pair", o, x) for (g, s, o), x in sums.items()])
        yield rows([(g, s, "term", term.decode("utf-8", "surrogatepass"), -value) for (g, s), own in best.items() for value, term in own])
    return run


def term_counts(docs: DataFrame, min_docs: int) -> DataFrame:
    """Kept terms by (lang, bucket), of the language as a whole and of its
    sources. ``docs``: (lang, source, text) without nulls."""
    tasks = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    counted = docs.select("lang", "source", F.col("text").cast("binary").alias("text")).mapInArrow(_count, _COUNTED) \
        .withColumn("bucket", F.pmod(F.xxhash64("term"), F.lit(4 * tasks)).cast("int"))
    return counted.repartition(tasks, "lang", "bucket").sortWithinPartitions("lang", "bucket").mapInArrow(_keep(min_docs), _KEPT)


def audit(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", min_docs: int = 3,
          top: int = 200) -> DataFrame:
    """(lang, source, part, item, value, rank): how far every source's terms
    are from those of the other sources of its language (part ``pair``, item
    the other source), and the ``top`` terms it uses more than its language
    does (part ``term``, item the term); ranks by value, ties by item."""
    docs = docs.select(*(text_or_empty(docs, c).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))))
    kept = materialize(term_counts(docs, min_docs), "terms")
    total = F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)
    sizes = kept.where("whole").groupBy("lang").agg(F.sum(F.size("counts")).alias("v"), F.sum(total).alias("lang_n"))
    used = kept.where("not whole").groupBy("lang", "source").agg(F.sum(total).alias("n"))
    groups = materialize(
        docs.groupBy("lang", "source").agg(F.lit(1).alias("one")).join(used, ["lang", "source"], "left").join(sizes, "lang", "left")
        .select("lang", "source", *(F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("n", "v", "lang_n"))), "groups")
    parts = groups.groupBy("lang").agg(F.ceil(F.count("*") / GROUPS).cast("int").alias("parts"), F.max("lang_n").alias("lang_n"))
    dealt = groups.drop("lang_n").join(parts.drop("lang_n"), "lang").withColumn("part", F.pmod(F.xxhash64("source"), F.col("parts")).cast("int"))

    # Every group stands in every bucket that has terms of its language, with zero counts if need be.
    buckets = kept.where("whole").select("lang", "bucket")
    own = kept.where("not whole").select("lang", "bucket", "source", "ids", "counts")
    empty = {"terms": "binary", "ids": "array<int>"}
    rows = dealt.join(buckets, "lang").join(own, ["lang", "bucket", "source"], "left") \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))) \
        .select("lang", "bucket", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"),
                F.lit(False).alias("whole"), "part", "source", "n", "v", F.lit(None).cast(empty["terms"]).alias("terms"), "ids", "counts")
    whole = kept.where("whole").join(parts, "lang") \
        .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))) \
        .withColumn("j", F.explode(F.sequence(F.col("i"), F.col("parts") - 1))) \
        .select("lang", "bucket", "i", "j", "whole", F.lit(0).alias("part"), "source", F.col("lang_n").alias("n"),
                F.lit(0).cast("long").alias("v"), "terms", F.lit(None).cast(empty["ids"]).alias("ids"), "counts")
    tasks = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    priced = rows.unionByName(whole).repartition(tasks, "lang", "bucket", "i", "j") \
        .sortWithinPartitions("lang", "bucket", "i", "j").mapInArrow(_price(top), _PRICED)
    # All pairs of a language exist, also where no term is kept.
    pairs = groups.select("lang", "source").join(groups.select("lang", F.col("source").alias("item")), "lang") \
        .where("source <> item").select("lang", "source", F.lit("pair").alias("part"), "item", F.lit(0).cast("long").alias("value"))
    values = priced.unionByName(pairs).groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    return values.withColumn("rank", F.row_number().over(order)).where((F.col("part") == "pair") | (F.col("rank") <= top)) \
        .select("lang", "source", "part", "item", "value", "rank")
