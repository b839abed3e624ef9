"""Exact top-k inner products with an impact-ordered, score-at-a-time index.

Vectors are dealt by row into blocks. A block's index cuts the postings of
each dimension into segments by the size of the component; a segment's
impact for a query is the query's component times the segment's largest. A
batch of queries walks the segments of all dimensions together, level by level
of falling impact. As every vector has a component in every dimension, segments
are columns of a matrix that is zero outside them, and a level's segments are
added to the scores gathered so far by one product. After each level a vector's
score can at most be what it has gathered plus the impacts of its segments that
are still to come. A query stops when few vectors could still reach the k-th
exact score found so far; those possible members are rescored exactly. All
others are proven out. A query that cannot stop after the last level rescores
the block.

Queries run against all rows: a block's index is built once a cell, and the
queries are streamed to it. A cell is a block of vectors and a block of queries;
only k rows a query leave it.

Defined results: rows with a null id or a null vector, and vectors holding a
null or non-finite component, or one beyond LARGEST, take no part; rows that
share an id are rows of their own; vectors meet only vectors of their own length;
a query never meets its own id; ties go to the smaller id; with fewer than
k candidates all are returned; an empty table gives an empty result. Scores
wrap at 64 bits as Spark's own long arithmetic does without ANSI checks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import col, materialize, slices

VECTOR_BLOCK = 16_384
QUERY_BLOCK = 8_192
INDEX_CELLS = 1 << 20  # components of an index at most; larger blocks hold several, which share what a query has found
BATCH = 64  # queries that walk together
LEVELS = (1 / 12, 1 / 24, 1 / 48)  # impact levels of a walk, as shares of the best impact
CUTS = (0.25, 0.5, 0.75)  # quantiles of component sizes between the segments of a dimension
LARGEST = 1 << 27  # quantised components that take part at most
MOST_TASKS = 100_000  # of the search; further cells follow in the same tasks
STOP_SHARE = 16  # a walk stops once one row in so many can still be a member


class ImpactIndex:
    """Posting segments of a block of integer vectors (rows of ``x``)."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        self.ids, self.x = ids, x
        n, dims = x.shape
        size = np.abs(x)
        self.most = int(size.max()) if x.size else 0
        edges = np.unique(np.quantile(size, CUTS).astype(np.int64)) if x.size else np.zeros(0, np.int64)
        self.classes = len(edges) + 1
        self._class = np.searchsorted(edges, size).astype(np.int8)
        #: Largest component and number of postings of the segment (class, dimension).
        self.top = np.zeros((self.classes, dims), np.int64)
        self.postings = np.zeros((self.classes, dims), np.int64)
        for c in range(self.classes):
            here = self._class == c
            self.top[c] = np.where(here, size, 0).max(axis=0, initial=0)
            self.postings[c] = here.sum(axis=0)
        self._by_id = np.argsort(ids, kind="stable")
        self._forms: dict[type, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

    def _form(self, kind: type) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Components by segment, membership by segment, and the vectors."""
        if kind not in self._forms:
            n, dims = self.x.shape
            member = np.stack([self._class == c for c in range(self.classes)], axis=1).reshape(n, self.classes * dims).astype(kind)
            vectors = self.x.astype(kind)
            self._forms = {kind: (member * np.tile(vectors, self.classes), member, vectors)}
        return self._forms[kind]

    def _own(self, own: int) -> np.ndarray:
        lo, hi = (np.searchsorted(self.ids, own, side, sorter=self._by_id) for side in ("left", "right"))
        return self._by_id[lo:hi]

    def _best(self, rows: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort((self.ids[rows], -scores))[:k]
        return self.ids[rows][order], scores[order]

    def search(self, q: np.ndarray, k: int, own: int) -> tuple[np.ndarray, np.ndarray, int]:
        """(ids, scores) of the k best other than id ``own``, best first, and
        the number of postings that were walked."""
        return self.search_batch(q[None, :], k, np.array([own]), np.array([-np.inf]))[0]

    def search_batch(self, qs: np.ndarray, k: int, owns: np.ndarray, floors: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, int]]:
        """``search`` for each row of ``qs``. Rows that score below a query's
        floor may be left out: k better or equal ones are known elsewhere."""
        n, dims = self.x.shape
        mine = [self._own(own) for own in owns.tolist()]
        found: list = [None] * len(qs)
        # All sums on the way are integers that the floating-point form holds exactly.
        reach = self.most * int(np.abs(qs).max(initial=0)) * dims
        exact = 0 < reach < 1 << 52
        live = np.array([i for i in range(len(qs)) if exact and n - len(mine[i]) > k], int)
        if exact:
            kind = np.float32 if reach < 1 << 23 else np.float64
            values, member, vectors = self._form(kind)
        if len(live):
            impact = np.abs(qs)[:, None, :] * self.top
            best = impact.max(axis=(1, 2))
            seen = np.zeros(impact.shape, bool)
            gathered = np.zeros((len(live), n), kind)
            for share in LEVELS:
                level = impact[live] > (best[live] * share)[:, None, None]
                fresh = level & ~seen[live]
                seen[live] = level
                gathered += np.where(fresh, qs[live][:, None, :], 0).reshape(len(live), -1).astype(kind) @ values.T
                bound = np.where(level, 0, impact[live]).reshape(len(live), -1).astype(kind) @ member.T
                bound += gathered
                goes_on = np.ones(len(live), bool)
                for at, i in enumerate(live.tolist()):
                    row, q = bound[at], qs[i].astype(kind)
                    row[mine[i]] = -np.inf
                    top = np.argpartition(row, n - k)[n - k:]
                    floor = max(floors[i], float((vectors[top] @ q).min()))
                    possible = np.flatnonzero(row >= floor)
                    if len(possible) * STOP_SHARE <= n:
                        scores = (vectors[possible] @ q).astype(np.int64)
                        found[i] = (*self._best(possible, scores, k), int(self.postings[seen[i]].sum()))
                        goes_on[at] = False
                live, gathered = live[goes_on], gathered[goes_on]
                if not len(live):
                    break
        for i in range(len(qs)):
            if found[i] is None:
                scores = (vectors @ qs[i].astype(kind)).astype(np.int64) if exact else self.x @ qs[i]
                rows = np.delete(np.arange(n), mine[i])
                found[i] = (*self._best(rows, scores[rows], k), n * dims)
        return found


def _vectors(column: pa.ListArray, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dims)


def _search_cells(k: int):
    """Rows come sorted: a cell's vectors of one length, then its queries."""
    def indexes(ids: list[np.ndarray], parts: list[np.ndarray], dims: int) -> list[ImpactIndex]:
        if not ids:
            return []
        all_ids, x = np.concatenate(ids), np.concatenate(parts)
        n = max(1, -(-len(x) * max(1, dims) // INDEX_CELLS))
        return [ImpactIndex(i, v) for i, v in zip(np.array_split(all_ids, n), np.array_split(x, n))]

    def answer(built: list[ImpactIndex], owns: np.ndarray, qs: np.ndarray) -> pa.RecordBatch:
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(owns)
        for index in built:
            floors = np.array([scores[k - 1] if len(scores) == k else -np.inf for _, scores in best])
            for i, (more_ids, more, _) in enumerate(index.search_batch(qs, k, owns, floors)):
                ids, scores = np.concatenate([best[i][0], more_ids]), np.concatenate([best[i][1], more])
                order = np.lexsort((ids, -scores))[:k]
                best[i] = (ids[order], scores[order])
        queries = np.repeat(owns, [len(ids) for ids, _ in best])
        return pa.RecordBatch.from_arrays(
            [pa.array(queries, pa.int64()), *(pa.array(np.concatenate(c), pa.int64()) for c in zip(*best))],
            ["query_id", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, parts, built = None, [], [], None
        for b in slices(batches, BATCH):
            marks = np.stack([b.column(c).cast(pa.int64()).to_numpy(zero_copy_only=False) for c in ("cell", "dims", "asks")])
            edges = [0, *(np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1).tolist(), b.num_rows]
            for s, e in zip(edges, edges[1:]):
                if s == e:
                    continue
                cell, dims, asks = marks[:, s].tolist()
                if (cell, dims) != key:
                    key, ids, parts, built = (cell, dims), [], [], None
                run_ids, x = b.column("id").slice(s, e - s).to_numpy(), _vectors(b.column("v").slice(s, e - s), dims)
                if not asks:
                    ids.append(run_ids)
                    parts.append(x)
                    continue
                if built is None:
                    built, ids, parts = indexes(ids, parts, dims), [], []
                if built:
                    yield answer(built, run_ids, x)
    return run


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64) -> DataFrame:
    """(id, v): integer vectors of the rows that take part; repeated ids stay
    rows of their own. Vectors with a component beyond LARGEST take no part:
    their inner products would not fit a long."""
    raw = vectors.select(col(vectors, id_col).cast("long").alias("id"), col(vectors, vector_col).alias("e"))
    bad = lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) > LARGEST / scale)
    fit = raw.where(F.col("id").isNotNull() & F.col("e").isNotNull() & ~F.coalesce(F.exists("e", bad), F.lit(False)))
    v = F.transform("e", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return fit.select("id", v.alias("v"))


def top_k(index: DataFrame, is_query, k: int = 20, vector_block: int = VECTOR_BLOCK,
          query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of ``index`` (id, v) for
    each row that ``is_query`` (a Column of id) holds for. A vector is sent once
    per ``query_block`` queries, a query once per ``vector_block`` vectors."""
    index = materialize(index.select("id", "v", F.size("v").alias("dims"), F.monotonically_increasing_id().alias("row")), "vectors")
    sizes = index.agg(F.count("*").alias("n"), F.count(F.when(is_query, 1)).alias("q")).first()
    n_v, n_q = max(1, -(-sizes.n // vector_block)), max(1, -(-sizes.q // query_block))
    deal = lambda seed, n: F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = index.select("id", "v", "dims", F.lit(0).alias("asks"), deal(1, n_v).alias("vb"), every(n_q).alias("qb"))
    right = index.where(is_query).select("id", "v", "dims", F.lit(1).alias("asks"), every(n_v).alias("vb"), deal(2, n_q).alias("qb"))
    rows = left.unionByName(right).select("id", "v", "dims", "asks", (F.col("vb").cast("long") * n_q + F.col("qb")).alias("cell"))
    tasks = min(n_v * n_q, MOST_TASKS)
    dealt = rows.repartitionById(tasks, F.pmod("cell", F.lit(tasks)).cast("int")).sortWithinPartitions("cell", "dims", "asks")
    found = dealt.mapInArrow(_search_cells(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
