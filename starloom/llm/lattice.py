"""SentencePiece encoding and decoding as a relational lattice.

Texts are normalised as the model says (identity, a space in front, spaces
escaped) and parted before every run of escaped spaces, and where letters meet
punctuation that the model has in no piece beside them; no piece crosses such a
place, so each part - a word - has a lattice of its own. For the distinct words:

1. substrings of 2 to the longest piece's length are exploded,
2. equi-joined to the piece table (its size is the model's, so it is broadcast),
3. the edges found are grouped by word,
4. a Spark higher-order ``aggregate`` folds the edges into a segmentation.

A unigram model's fold is Viterbi: the best score to each position, left to
right. The pieces of a BPE model are chosen by merges, and the best sum of
scores is not what the library gives for it, so its fold takes the edges by
score (leftmost first on ties), each if it joins exactly two present pieces. One pass
is exact if no merge makes way for a better edge than itself; for words that hold a piece
for which this does not hold (see ``late_pieces``) the fold looks for the best edge
step after step. The state of either is a word's cut positions.

Words of up to LONG characters fold in Spark with positions as bits of a
long. Longer ones are folded from the same edges in the task, where the
positions are a list.

All steps are narrow: a task lists the words of its documents that it has not met, lets them pass
through explode, join, grouping and fold, and spells its documents, which travel as the
numbers of their words, with the result. Nothing is shuffled or stored, and a hot word costs
no more than any other. A task keeps about WORDS words or CHARS characters of them at most
and then starts over; the fewer tasks, the fewer words are met twice (see ``large_tasks``).

Defined results: a null text is empty and has no pieces; characters that no
piece holds are spelled by their UTF-8 bytes; every input row gives a row,
repeated rows and null keys too; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import col, slices, text_or_empty

SPACE = "▁"  # fixed value of the format: an escaped space
LONG = 60
WORDS = 1_000_000
CHARS = 16_000_000
SPLITS = 5
DOCS = 64  # documents that travel together


@dataclass(frozen=True)
class Pieces:
    """What a model file says: normal pieces with scores, byte pieces, rules."""

    bpe: bool
    prefix: bool
    pieces: tuple[tuple[str, int, float], ...]  # piece, id, score
    byte_id: tuple[int, ...]
    unknown: int
    longest: int
    late: frozenset[str]  # pieces of a BPE model that one pass by score may miss
    words: str  # pattern of the words of a normalised text
    spelled: tuple[bytes, ...]  # text of every id


def word_pattern(pieces: list[str], few: int = 3) -> str:
    """Pattern of the words of a normalised text. A word starts at a run of
    escaped spaces, and between letters or digits and punctuation that stand side
    by side in no piece. Punctuation with up to ``few`` alphanumeric neighbours
    counts as such; those neighbours, and all other characters, never part."""
    beside: dict[str, set[str]] = {}
    for p in pieces:
        for a, b in zip(p, p[1:]):
            for mark, other in ((a, b), (b, a)):
                if not mark.isalnum() and mark not in (SPACE, "_") and mark.isprintable():
                    beside.setdefault(mark, set())
                    if other.isalnum():
                        beside[mark].add(other)
    marks = {m for m, others in beside.items() if len(others) <= few}
    if not marks:
        return f"{SPACE}*[^{SPACE}]+|{SPACE}+"
    spared = "".join(map(re.escape, sorted({o for m in marks for o in beside[m]})))
    among = "".join(map(re.escape, sorted(marks)))
    run, rest = f"(?:[^\\W_{spared}]+|[{among}]+)", f"(?:(?![{SPACE}{among}])[\\W_{spared}])+"
    return f"{SPACE}*(?:{run}(?:{rest}{run}?)*|(?:{rest}{run}?)+)|{SPACE}+"


def late_pieces(ranks: dict[str, float]) -> frozenset[str]:
    """Pieces whose merges do not come in the order of (rank, start).

    A merge that comes after one of a worse rank joins what that one made. Up to then
    nothing crossed its ends, so what happened between them is what happens to its
    piece alone: it is enough to merge every piece on its own."""
    late = set()
    for piece in ranks:
        tokens, last = [(c, i) for i, c in enumerate(piece)], (float("-inf"), 0)
        while len(tokens) > 1:
            found = [(ranks[a + b], i, k) for k, ((a, i), (b, _)) in enumerate(zip(tokens, tokens[1:])) if a + b in ranks]
            if not found:
                break
            rank, i, k = min(found)
            if (rank, i) < last:
                late.add(piece)
                break
            last = rank, i
            tokens[k:k + 2] = [(tokens[k][0] + tokens[k + 1][0], i)]
    return frozenset(late)


def load(path: str) -> Pieces:
    """Read a model file; raises ValueError where its rules go beyond this operator."""
    from sentencepiece import sentencepiece_model_pb2  # here, as Python workers have no use for it

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as fh:
        model.ParseFromString(fh.read())
    rules, kind = model.normalizer_spec, sentencepiece_model_pb2.ModelProto.SentencePiece
    if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
        raise ValueError(f"{path}: only identity normalisation with escaped spaces is supported")
    normal = tuple((p.piece, i, p.score) for i, p in enumerate(model.pieces) if p.type == kind.NORMAL)
    if any(p.type in (kind.USER_DEFINED, kind.UNUSED) for p in model.pieces) or any(SPACE in p.lstrip(SPACE) for p, _, _ in normal):
        raise ValueError(f"{path}: user-defined pieces and pieces across words are not supported")
    byte = {int(p.piece[1:-1], 16): i for i, p in enumerate(model.pieces) if p.type == kind.BYTE}
    spelled = [b""] * len(model.pieces)
    for p, i, _ in normal:
        spelled[i] = p.replace(SPACE, " ").encode()
    for b, i in byte.items():
        spelled[i] = bytes([b])
    unknown = next(i for i, p in enumerate(model.pieces) if p.type == kind.UNKNOWN)
    spelled[unknown] = model.trainer_spec.unk_surface.encode()
    bpe = model.trainer_spec.model_type == sentencepiece_model_pb2.TrainerSpec.BPE
    return Pieces(bpe, rules.add_dummy_prefix, normal,
                  tuple(byte[b] for b in range(256)) if len(byte) == 256 else (), unknown,
                  max((len(p) for p, _, _ in normal), default=0),
                  late_pieces({p: -score for p, _, score in normal if len(p) > 1} if bpe else {}), word_pattern([p for p, _, _ in normal]), tuple(spelled))


# ---------------------------------------------------------------- folds
# An edge of a BPE model is packed: its rank, start (32 bits), whether it is late (1 bit) and size (7 bits).
def _start(edge: Column) -> Column:
    return F.call_function("shiftright", edge, F.lit(8)).bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")


def _unpacked(edge: int) -> tuple[int, int, int]:
    start = edge >> 8 & 0xFFFFFFFF
    return edge >> 40, start, start + (edge & 127)


def _bpe_fold(edges: Column, n: Column) -> Column:
    """Cut positions (bits 0 to n) after all merges; ``edges`` are packed, in the order
    in which they are taken."""
    start = _start
    end = lambda x: start(x) + x.bitwiseAND(127).cast("int")
    bit = lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), i)
    ends = lambda x: bit(start(x)).bitwiseOR(bit(end(x)))
    inner = lambda x: (bit(end(x)) - 1).bitwiseAND(F.bitwise_not(bit(start(x) + 1) - 1))
    fold_edges = F.transform(edges, lambda x: F.struct(ends(x).alias("ends"), inner(x).alias("inner")))
    joins = lambda cuts: lambda x: (cuts.bitwiseAND(x["ends"]) == x["ends"]) & (F.bit_count(cuts.bitwiseAND(x["inner"])) == 1)
    state = F.struct((bit(n + 1) - 1).alias("cuts"), fold_edges.alias("edges"))

    def step(s: Column, _: Column) -> Column:
        best = F.get(F.filter(s["edges"], joins(s["cuts"])), F.lit(0))
        cuts = F.coalesce(s["cuts"].bitwiseAND(F.bitwise_not(best["inner"])), s["cuts"])
        return F.struct(cuts.alias("cuts"), s["edges"].alias("edges"))

    return F.aggregate(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), state, step, lambda s: s["cuts"])


def _one_pass_fold(edges: Column, n: Column) -> Column:
    """As ``_bpe_fold``, for words without late pieces."""
    bits = lambda k: F.call_function("shiftleft", F.lit(1).cast("long"), k) - 1

    def step(cuts: Column, x: Column) -> Column:
        start, size = _start(x), x.bitwiseAND(127).cast("int")
        ends = F.call_function("shiftleft", bits(size) + 2, start)
        inner = F.call_function("shiftleft", bits(size - 1), start + 1)
        joins = (F.bitwise_not(cuts).bitwiseAND(ends) == 0) & (F.bit_count(cuts.bitwiseAND(inner)) == 1)
        return F.when(joins, cuts.bitwiseAND(F.bitwise_not(inner))).otherwise(cuts)

    return F.aggregate(edges, bits(n + 1), step)


def _viterbi_fold(edges: Column, n: Column) -> Column:
    """Cut positions of the best path; ``edges`` are (score, start, end) by
    (end, start), one of each span, with single characters among them."""
    bit = lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), i)
    node = lambda score, cuts: F.struct(score.cast("double").alias("score"), cuts.cast("long").alias("cuts"))
    start = F.transform(F.sequence(F.lit(0), n), lambda i: F.when(i == 0, node(F.lit(0.0), F.lit(1))).otherwise(
        node(F.lit(float("-inf")), F.lit(0))))

    def step(best: Column, e: Column) -> Column:
        at = F.get(best, e["start"])
        score = at["score"] + e["score"]
        new = node(score, at["cuts"].bitwiseOR(bit(e["end"])))
        return F.transform(best, lambda x, i: F.when((i == e["end"]) & (score > x["score"]), new).otherwise(x))

    return F.aggregate(edges, start, step, lambda best: F.get(best, n)["cuts"])


def long_merges(n: int, edges: list[tuple[float, int, int]]) -> list[int]:
    """Cut positions of a long word from its (rank, start, end) edges."""
    rank = {(s, e): r for r, s, e in edges}
    after, before = list(range(1, n + 2)), list(range(-1, n))
    gone, heap = [False] * (n + 1), []

    def offer(s: int) -> None:
        mid = after[s]
        if mid < n:
            r = rank.get((s, after[mid]))
            if r is not None:
                heappush(heap, (r, s, mid, after[mid]))
    for s in range(n):
        offer(s)
    while heap:
        _, s, mid, e = heappop(heap)
        if gone[s] or gone[mid] or gone[e] or after[s] != mid or after[mid] != e:
            continue
        gone[mid] = True
        after[s], before[e] = e, s
        offer(s)
        if s > 0:
            offer(before[s])
    return [i for i in range(n + 1) if not gone[i]]


def long_viterbi(n: int, edges: list[tuple[float, int, int]]) -> list[int]:
    """Cut positions of the best path, as the fold finds it."""
    best, came = [0.0] + [float("-inf")] * n, [0] * (n + 1)
    for score, s, e in edges:
        if best[s] + score > best[e]:
            best[e], came[e] = best[s] + score, s
    cuts = [n]
    while cuts[-1]:
        cuts.append(came[cuts[-1]])
    return cuts[::-1]


# ---------------------------------------------------------------- stages
_WORD_ROW = "word string, docs binary"  # either is set


class _Numbers(dict):
    """Numbers of words in the order in which they are first asked for; ``fresh`` are those not listed yet."""

    def __init__(self) -> None:
        self.fresh: list[str] = []
        self.chars = 0

    def __missing__(self, word: str) -> int:
        self.fresh.append(word)
        self.chars += len(word)
        self[word] = n = len(self)
        return n


def _list_words(model: Pieces):
    """Words not met in this task yet, then the documents that need them, as numbers of words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(1).compress
        # With plain spaces: most words then take a byte a character here.
        found, front = re.compile(model.words.replace(SPACE, " ")).findall, " " if model.prefix else ""
        known = _Numbers()
        for b in slices(batches, DOCS):
            start_over = len(known) > WORDS or known.chars > CHARS
            if start_over:
                known.clear()
                known.chars = 0
            coded = [np.fromiter(map(known.__getitem__, words), "<i4", len(words)).tobytes()
                     for words in (found(front + t.replace(SPACE, " ")) if t else [] for t in b.column("text").to_pylist())]
            fresh, known.fresh = [w.replace(" ", SPACE) for w in known.fresh], []
            n = len(fresh)
            whole = pa.BufferOutputStream()
            rows = pa.RecordBatch.from_arrays([b.column("key"), pa.array(coded, pa.binary())], ["key", "words"])
            with pa.ipc.new_stream(whole, rows.schema.with_metadata({"start_over": str(int(start_over))})) as out:
                out.write_batch(rows)
            yield pa.RecordBatch.from_arrays([pa.array([*fresh, None], pa.string()),
                                              pa.array([None] * n + [squeeze(whole.getvalue())], pa.binary())], ["word", "docs"])
    return run


def split_words(text: str, model: Pieces) -> list[str]:
    """The normalised text, parted before every run of escaped spaces and
    where letters and punctuation meet that no piece holds side by side."""
    if not text:
        return []
    return re.findall(model.words, (SPACE if model.prefix else "") + text.replace(" ", SPACE))


_EDGE = "struct<key: double, start: int, end: int>"


def _group_edges():
    """Consecutive edges of a word, which is named in the first row, as one row; rows of documents pass."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.RecordBatch | None = None
        for b in batches:
            if rest is not None and rest.num_rows:
                b = pa.Table.from_batches([rest, b]).combine_chunks().to_batches()[0]
            # The last word of a batch may go on in the next one.
            starts = np.flatnonzero(firsts(b))
            if not len(starts):
                continue
            cut = int(starts[-1])
            rest = b.slice(cut)
            if cut:
                yield grouped(b.slice(0, cut), starts[:-1])
        if rest is not None and rest.num_rows:
            yield grouped(rest, np.zeros(1, int))

    def firsts(b: pa.RecordBatch) -> np.ndarray:
        return b.column("word").is_valid().to_numpy(zero_copy_only=False) | b.column("docs").is_valid().to_numpy(zero_copy_only=False)

    def grouped(b: pa.RecordBatch, starts: np.ndarray) -> pa.RecordBatch:
        real = b.column("edge").is_valid().to_numpy(zero_copy_only=False)
        before = np.concatenate([[0], np.cumsum(real)])
        offsets = before[np.concatenate([starts, [b.num_rows]])]
        edges = b.column("edge").filter(pa.array(real))
        first = pa.array(starts, pa.int64())
        return pa.RecordBatch.from_arrays([b.column("word").take(first), b.column("docs").take(first),
                                           pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), edges)], ["word", "docs", "edges"])
    return run


class _Spelled:
    """Ids of numbered words, one after the other in an array that grows by halves."""

    def __init__(self) -> None:
        self.ids, self.ends = np.zeros(0, "<u4"), np.zeros(1, np.int64)
        self.n = 0

    def add(self, ids: np.ndarray, ends: np.ndarray) -> None:
        have, n = int(self.ends[self.n]), self.n + len(ends)
        if have + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids[:have], np.zeros(len(ids) + have // 2, "<u4")])
        if n >= len(self.ends):
            self.ends = np.concatenate([self.ends[:self.n + 1], np.zeros(len(ends) + self.n // 2, np.int64)])
        self.ids[have:have + len(ids)] = ids
        self.ends[self.n + 1:n + 1] = have + ends
        self.n = n

    def of(self, words: np.ndarray) -> np.ndarray:
        """Ids of a sequence of words."""
        start, size = self.ends[words], self.ends[words + 1] - self.ends[words]
        before = np.cumsum(size) - size
        return self.ids[np.arange(int(size.sum())) + np.repeat(start - before, size)]


def _spell(model: Pieces):
    """Ids of the words as they come, then of the documents made of them."""
    ids = {p: np.array([i], "<u4").tobytes() for p, i, _ in model.pieces}

    def char(c: str) -> bytes:
        if not model.byte_id:
            return np.array([model.unknown], "<u4").tobytes()
        return np.array([model.byte_id[x] for x in c.encode("utf-8", "surrogatepass")], "<u4").tobytes()

    def of_words(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words in a row, and where those of each word end."""
        words, n = b.column("word").to_pylist(), b.num_rows
        size = np.fromiter(map(len, words), np.int64, n)
        base = np.cumsum(size) - size
        # Cuts of all words in a row: the last of a word is the first of the next.
        bits = b.column("cuts").fill_null(0).to_numpy(zero_copy_only=False)
        row, place = np.nonzero(bits[:, None] >> np.arange(LONG + 1) & 1)
        starts = place < size[row]
        row, cut = row[starts], (base[row] + place)[starts]
        long = b.column("cuts").is_null().to_numpy(zero_copy_only=False)
        for k in np.flatnonzero(long).tolist():
            found = json.loads(b.column("edges")[k].as_py())
            at = long_merges(len(words[k]), [_unpacked(e) for e in found]) if model.bpe else \
                long_viterbi(len(words[k]), [(e["key"], e["start"], e["end"]) for e in found])
            row, cut = np.concatenate([row, np.full(len(at) - 1, k)]), np.concatenate([cut, base[k] + np.array(at[:-1], np.int64)])
        if long.any():
            order = np.argsort(cut, kind="stable")
            row, cut = row[order], cut[order]
        whole, cuts = "".join(words), cut.tolist()
        parts = [ids.get(p) or char(p) for p in map(whole.__getitem__, map(slice, cuts, [*cuts[1:], len(whole)]))]
        ends = np.cumsum(np.bincount(row, minlength=n))
        size = np.cumsum([0, *map(len, parts)]) // 4
        return np.frombuffer(b"".join(parts), "<u4"), size[ends]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        known = _Spelled()
        stale = []
        for b in batches:
            docs = b.column("docs").to_pylist()
            at = 0
            for k in [*np.flatnonzero(b.column("docs").is_valid().to_numpy(zero_copy_only=False)).tolist(), b.num_rows]:
                if k > at:
                    stale.append(of_words(b.slice(at, k - at)))
                at = k + 1
                if k == b.num_rows:
                    break
                rows = pa.ipc.open_stream(unpack(docs[k])).read_all().combine_chunks()
                if rows.schema.metadata[b"start_over"] == b"1":
                    known = _Spelled()
                for part in stale:
                    known.add(*part)
                stale = []
                spelled = [known.of(np.frombuffer(w, "<i4")).tobytes() for w in rows.column("words").to_pylist()]
                yield pa.RecordBatch.from_arrays([one_chunk(rows.column("key")), pa.array(spelled, pa.binary())], ["key", "ids"])
    return run


def one_chunk(column: pa.ChunkedArray) -> pa.Array:
    return column.chunk(0) if column.num_chunks else pa.array([], column.type)


def piece_table(spark: SparkSession, model: Pieces) -> DataFrame:
    """Pieces with their scores, those of a BPE model also with their ranks."""
    if not model.bpe:
        return spark.createDataFrame([(p, float(s)) for p, _, s in model.pieces], "sub string, score double")
    rank = {s: r for r, s in enumerate(sorted({s for _, _, s in model.pieces}, reverse=True))}
    return spark.createDataFrame([(p, rank[s], p in model.late) for p, _, s in model.pieces], "sub string, score long, late boolean")


def _folded(docs: DataFrame, model: Pieces, key: str, text: str) -> DataFrame:
    """Distinct words of each task with their cut positions, each batch of documents after its words."""
    if model.bpe and model.longest > 127:
        raise ValueError("pieces of more than 127 characters are not supported")
    spark = docs.sparkSession
    rows = docs.select(col(docs, key).alias("key"), text_or_empty(docs, text).alias("text"))
    words = rows.mapInArrow(_list_words(model), _WORD_ROW)
    n = F.char_length("word")
    shortest = 2 if model.bpe else 1
    # Rows of documents have no word and pass through both explodes once.
    starts = words.select("*", F.explode_outer(F.when(n >= shortest, F.sequence(F.lit(0), n - shortest))).alias("start"))
    longest = F.least(F.lit(model.longest), n - F.col("start"))
    spans = starts.select("*", F.explode_outer(F.when(F.col("start").isNotNull(), F.sequence(F.lit(shortest), longest))).alias("size"))
    exploded = spans.select("*", F.col("word").substr(F.col("start") + 1, F.col("size")).alias("sub"))
    joined = exploded.join(F.broadcast(piece_table(spark, model)), "sub", "left")
    if not model.bpe:
        # A character that is no piece of its own still is an edge, at the unknown's price.
        price = min((s for _, _, s in model.pieces), default=0.0) - 10
        joined = joined.withColumn("score", F.when(F.col("size") == 1, F.coalesce("score", F.lit(price))).otherwise(F.col("score")))
    hit, first = F.col("score").isNotNull(), F.col("start").isNull() | ((F.col("start") == 0) & (F.col("size") == shortest))
    # A word keeps the row of its first span, with or without an edge; the text goes on there only.
    if model.bpe:
        kind, shift = "bigint", lambda x, k: F.call_function("shiftleft", x.cast("long"), F.lit(k))
        edge = shift(F.col("score"), 40).bitwiseOR(shift(F.col("start"), 8)).bitwiseOR(
            F.when(F.col("late"), F.lit(128)).otherwise(F.lit(0)).cast("long")).bitwiseOR(F.col("size").cast("long"))
    else:
        kind, edge = _EDGE, F.struct(F.col("score").alias("key"), "start", (F.col("start") + F.col("size")).alias("end"))
    joined = joined.where(hit | first).select(F.when(first, F.col("word")).alias("word"), "docs", F.when(hit, edge).alias("edge"))
    grouped = joined.mapInArrow(_group_edges(), f"word string, docs binary, edges array<{kind}>")
    if model.bpe:
        order = F.sort_array("edges")
    else:
        order = F.transform(F.sort_array(F.transform("edges", lambda x: F.struct(x["end"].alias("end"), x["start"].alias("start"), x["key"].alias("key")))),
                            lambda x: F.struct(x["key"].alias("key"), x["key"].alias("score"), x["start"].alias("start"), x["end"].alias("end")))
    edges = F.col("edges")
    if not model.bpe:
        cuts = _viterbi_fold(edges, n)
    elif not model.late:
        cuts = _one_pass_fold(edges, n)
    else:
        late = F.exists(edges, lambda x: x.bitwiseAND(128) != 0)
        cuts = F.when(late, _bpe_fold(edges, n)).otherwise(_one_pass_fold(edges, n))
    folded = grouped.withColumn("edges", order).withColumn("cuts", F.when(n <= LONG, cuts))
    # Only long words need their edges further on (as text: lists are slow to hand over row by row).
    return folded.select("word", "docs", "cuts", F.when(n > LONG, F.to_json("edges")).alias("edges"))


def large_tasks(table: DataFrame) -> DataFrame:
    """A given table with some SPLITS of its splits a task, in as many tasks as fill all cores."""
    splits, cores = table.rdd.getNumPartitions(), table.sparkSession.sparkContext.defaultParallelism
    return table.coalesce(min(max(splits, 1), cores * max(1, round(splits / (SPLITS * cores)))))


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids) of every row: little-endian unsigned 32-bit piece ids, as
    the model file at ``path`` segments the text, without added pieces."""
    model = load(path)
    return _folded(docs, model, key, text).mapInArrow(_spell(model), f"key {_kind(docs, key)}, ids binary")


def _kind(docs: DataFrame, key: str) -> str:
    return docs.select(col(docs, key)).schema[0].dataType.simpleString()


def _decode(model: Pieces, ids: str):
    """The batches with the text of their ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelled = pa.array(model.spelled, pa.binary())
        for b in slices(batches):
            out = []
            for raw in b.column(ids).to_pylist():
                found = spelled.take(pa.array(np.frombuffer(raw, "<u4"))) if raw else None
                text = b"" if found is None else found.buffers()[2].to_pybytes()
                out.append((text[1:] if model.prefix and text[:1] == b" " else text).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.string())], [*b.schema.names, "text"])
    return run


def decode(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``encoded`` with ``text``: the text that the piece ids spell (bytes that
    are no UTF-8 become U+FFFD)."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)
    return encoded.mapInArrow(_decode(load(path), ids), f"{fields}, text string")


def round_trip(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``decode(encode(docs))``, with both in the same Python workers: (key, ids, text)."""
    model = load(path)
    spell, read = _spell(model), _decode(model, "ids")
    return _folded(docs, model, key, text).mapInArrow(lambda batches: read(spell(batches)), f"key {_kind(docs, key)}, ids binary, text string")


def library(path: str):
    """The library's own processor of a file, to compare with."""
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)
