"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are counted over whole texts (no language, source or id among
them). Training takes a bounded, documented sample: of the labelled rows that
may be learnt from, the ``TRAIN_ROWS`` with the smallest hash of their id; their
statistics are the only rows the driver ever sees. Feature values are binned
by the sample's quantiles, trees of fixed depth grow level by level from
histograms of gradients, and the fitted trees are complete binary trees in
flat arrays, so a batch of documents goes down all trees in ``DEPTH`` numpy steps.

Defined results: a null text scores as an empty one; every input row is scored,
repeated rows and null keys included; a row whose key is null is never held
out and never learnt from; labels that are null are passed over; without usable
labels every score is 0.5, with one class alone it is near that class's label;
an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import col, free_name, quoted, slices, text_or_empty

TRAIN_ROWS = 20_000
FOLDS = 5
TREES, DEPTH, BINS = 80, 4, 64
LEARNING_RATE, L2, MIN_ROWS = 0.15, 1.0, 8
THRESHOLD = 0.3

FEATURES = (
    "log_bytes", "log_words", "upper", "lower", "digit", "space", "newline", "high", "symbol", "stop", "bang", "bar",
    "word_len", "long_words", "distinct", "top_word", "repeats", "no_letter", "symbol_end", "upper_words", "distinct_lines",
    "log_line_words", "top_line", "byte_entropy",
)

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_BYTES = np.arange(256)
_CLASSES = np.stack([
    (_BYTES >= 65) & (_BYTES <= 90), (_BYTES >= 97) & (_BYTES <= 122), (_BYTES >= 48) & (_BYTES <= 57), _BYTES == 32,
    _BYTES == 10, _BYTES >= 128, np.isin(_BYTES, list(b"#$%&*+-/<=>@\\^_`{}~[]()|")), np.isin(_BYTES, list(b".,;:")),
    np.isin(_BYTES, list(b"!?")), _BYTES == 124]).astype(np.float64)


def statistics(text: str) -> list[float]:
    """The FEATURES of one whole text."""
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    n = max(1, len(raw))
    histogram = np.bincount(raw, minlength=256)
    shares = (_CLASSES @ histogram / n).tolist()
    p = histogram[histogram > 0] / n
    words = _WORD.findall(text)
    w = max(1, len(words))
    counts: dict[str, int] = {}
    for x in words:
        counts[x] = counts.get(x, 0) + 1
    lengths = list(map(len, words))
    lines = [x for x in text.split("\n") if x.strip()]
    per_line: dict[str, int] = {}
    for x in lines:
        per_line[x] = per_line.get(x, 0) + 1
    m = max(1, len(lines))
    return [
        float(np.log1p(len(raw))), float(np.log1p(len(words))), *shares, sum(lengths) / w, sum(x > 20 for x in lengths) / w,
        len(counts) / w, max(counts.values(), default=0) / w, sum(map(str.__eq__, words, words[1:])) / w,
        sum(c for x, c in counts.items() if not any(map(str.isalpha, x))) / w,
        sum(c for x, c in counts.items() if x[-1] in "#$%&*|!") / w,
        sum(c for x, c in counts.items() if len(x) > 1 and x.isupper()) / w,
        len(per_line) / m, float(np.log1p(len(words) / m)), max(per_line.values(), default=0) / m,
        float(-(p * np.log2(p)).sum()) if len(raw) else 0.0]


@dataclass
class Trees:
    """Complete binary trees, level order: node i has children 2i+1 and 2i+2."""

    prior: float
    feature: np.ndarray  # (trees, 2^depth - 1)
    cut: np.ndarray  # go right above it
    leaf: np.ndarray  # (trees, 2^depth)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 of each row of ``x``."""
        trees, inner = self.feature.shape
        at = np.zeros((len(x), trees), np.int64)
        tree = np.arange(trees)[None, :]
        rows = np.arange(len(x))[:, None]
        for _ in range((inner + 1).bit_length() - 1):
            at = 2 * at + 1 + (x[rows, self.feature[tree, at]] > self.cut[tree, at])
        return 1 / (1 + np.exp(-(self.prior + self.leaf[tree, at - inner].sum(axis=1))))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Boosted trees for the logistic loss."""
    inner = (1 << depth) - 1
    if not len(y):
        return Trees(0.0, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)))
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model = Trees(float(np.log(mean / (1 - mean))), np.zeros((trees, inner), np.int64),
                  np.full((trees, inner), np.inf), np.zeros((trees, inner + 1)))
    n, width = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(width)]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], 1)
    # A bin number above b means a value above edges[b].
    flat = binned + np.arange(width) * BINS
    margin = np.full(n, model.prior)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, here = (1 << level) - 1, 1 << level
            cell = ((node - first)[:, None] * (width * BINS) + flat).ravel()
            size = here * width * BINS
            gs, hs, cs = (np.bincount(cell, None if v is None else np.repeat(v, width), size).reshape(here, width, BINS)
                          for v in (g, h, None))
            gl, hl, cl = (np.cumsum(v, axis=2) for v in (gs, hs, cs))
            gt, ht, ct = gl[:, :, -1:], hl[:, :, -1:], cl[:, :, -1:]
            gain = gl**2 / (hl + L2) + (gt - gl)**2 / (ht - hl + L2) - gt**2 / (ht + L2)
            gain[(cl < MIN_ROWS) | (ct - cl < MIN_ROWS)] = 0
            best = gain.reshape(here, -1).argmax(axis=1)
            for i, b in enumerate(best.tolist()):
                j, k = divmod(b, BINS)
                if gain[i, j, k] > 1e-9 and k < len(edges[j]):
                    model.feature[t, first + i], model.cut[t, first + i] = j, edges[j][k]
            node = 2 * node + 1 + (x[np.arange(n), model.feature[t, node]] > model.cut[t, node])
        leaf = node - inner
        value = -np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + L2) * LEARNING_RATE
        model.leaf[t] = value
        margin += value[leaf]
    return model


def held_out(key: Column) -> Column:
    """Whether a row's label is kept for measuring: crc32 of the id as text."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, 64):
        x = [statistics(t) for t in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), b.column("y"), b.column("h")], ["x", "y", "h"])


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
          rows: int = TRAIN_ROWS) -> Trees:
    """Fit on at most ``rows`` labelled documents that are not held out. A
    label counts once for every row of its document among the sampled labels."""
    k = col(labels, key)
    known = labels.select(k.alias("key"), col(labels, label).cast("double").alias("y")).where(
        k.isNotNull() & F.col("y").isin(0.0, 1.0) & ~held_out(F.col("key")))
    # The sample is bounded, so it may go to every executor; texts stay where they are.
    sample = known.groupBy("key").agg(F.max("y").alias("y")).orderBy(F.xxhash64("key"), "key").limit(rows)
    texts = docs.select(col(docs, key).alias("key"), text_or_empty(docs, text).alias("text"))
    found = texts.join(F.broadcast(sample), "key").select("text", "y", F.xxhash64("key", "text").alias("h"))
    # Repeated documents could pass the bound: the sample keeps it.
    got = found.mapInArrow(_measure, "x array<double>, y double, h long").orderBy("h", "y").limit(rows).toPandas()
    x = np.stack(got["x"].to_list()) if len(got) else np.zeros((0, len(FEATURES)))
    return fit(x, got["y"].to_numpy(np.float64))


def _scores(model: Trees):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            *kept, text = b.columns
            x = np.array([statistics(t) for t in text.to_pylist()]).reshape(b.num_rows, len(FEATURES))
            yield pa.RecordBatch.from_arrays([*kept, pa.array(model.score(x))], [f"c{i}" for i in range(len(kept) + 1)])
    return run


def score(docs: DataFrame, model: Trees, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all, if not given) of every row and ``score_``
    (further underscores, should a kept column be called so)."""
    names = docs.columns if keep is None else keep
    rows = docs.select(*(col(docs, c).alias(f"c{i}") for i, c in enumerate(names)), text_or_empty(docs, text).alias("text"))
    fields = [quoted(f) for f in rows.schema.fields[:-1]]
    scored = rows.mapInArrow(_scores(model), ", ".join([*fields, f"c{len(names)} double"]))
    return scored.toDF(*names, free_name(names, "score_"))
