"""The operators on small tables: brute force, nulls, empty and long texts,
ties, repeated rows, empty tables, extra columns with clashing names."""

import hashlib
import itertools
import random
import re

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2
from tokenizers import Tokenizer

from starloom.llm import imatch, lattice, near_dup, packing, quality, sharding, substrings, token_counts, topk, warc
from starloom.llm.common import clear_scratch, ship
from starloom.session import scratch_path

BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
#: Names that operators use inside.
CLASH = ["key", "row", "class", "n_tokens", "set", "cid", "root", "c0", "score_", "spans_", "sequence_id", "a.b", "ids"]
SCHEMA = "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in CLASH)


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)
    yield
    clear_scratch(spark)


def table(spark, rows):
    """(doc_id, text) rows with extra columns."""
    return spark.createDataFrame([(k, t, *[f"x{i}" for i in range(len(CLASH))]) for k, t in rows], SCHEMA)


def words(rng, n, vocabulary=300):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def corpus():
    rng = random.Random(11)
    base = [words(rng, rng.randint(3, 60)) for _ in range(12)]
    passage = words(rng, 30, 10_000)
    rows = [(100 + i, t) for i, t in enumerate(base)]
    rows += [(200 + i, base[0]) for i in range(8)]  # copies
    near = words(rng, 60, 10_000).split()
    for i in range(10):  # near copies in a chain
        near[rng.randrange(60)] = f"e{i}"
        rows.append((50 + i, " ".join(near)))
    rows += [(300 + i, f"{words(rng, 9)} {passage} {words(rng, 7)}") for i in range(5)]
    rows += [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (6, "Two  words"), (7, "two WORDS"), (None, base[1]),
             (None, None), (8, "z " * 400), (9, "é <|endoftext|> ½ 日本 " * 9), (9, "é <|endoftext|> ½ 日本 " * 9),
             (10, base[2]), (10, base[3]), (11, "b" * 900), (12, words(rng, 900, 50))]
    rng.shuffle(rows)
    return rows


ROWS = corpus()


def test_token_counts(spark):
    lib = Tokenizer.from_file(BPE)
    want = sorted((str(k), len((t or "").encode()), len(lib.encode(t or "", add_special_tokens=False).ids)) for k, t in ROWS)
    for chunk, overlap in ((40, 12), (16_384, 512)):
        got = token_counts.token_counts(table(spark, ROWS), BPE, chunk_chars=chunk, overlap_chars=overlap).collect()
        assert sorted((str(r.key), r.n_bytes, r.n_tokens) for r in got) == want
    assert token_counts.token_counts(table(spark, []), BPE).count() == 0


def test_packing(spark):
    lib = Tokenizer.from_file(BPE)
    pieces = packing.token_pieces(table(spark, ROWS), BPE, size=64, end_id=0)
    got = packing.pack(pieces, len(ROWS), size=64, group_docs=16).collect()
    bins, docs = {}, {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
        docs.setdefault(r.key, []).append((r.start, np.frombuffer(bytes(r.ids), "<u4").tolist()))
        assert len(r.ids) == 4 * r.length <= 256
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    assert len(bins) <= 1.25 * sum(r.length for r in got) / 64 + 1 + -(-len(ROWS) // 16)
    for k in {k for k, _ in ROWS}:
        want = sorted(i for kk, t in ROWS if kk == k for i in [*lib.encode(t or "", add_special_tokens=False).ids, 0])
        assert sorted(i for _, ids in docs[k] for i in ids) == want
    assert packing.pack(packing.token_pieces(table(spark, []), BPE), 0).count() == 0


def pages():
    big, other = "<p>é" + "x" * 2500, "y" * 1000
    return [(1, "http://a/1", big), (7, "http://a/7", big), (3, None, big), (4, "http://b\r\nX: y", other), (5, "u", "y" * 999), (6, "u", "y" * 999),
            (8, "u", None), (9, "u", ""), (10, "u", "z" * 70_000), (None, "n", big), (12, "r", "q" * 1500), (12, "r", "q" * 1500), (2, "u", "q" * 1500),
            (13, "u", "WARC/1.1\r\n\r\n0\r\n\r\n" * 90)]


def test_warc_round_trip(spark):
    rows = pages()
    df = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], "page_id long, url string, html string, key string, sha string, revisit int")
    got = sorted((str(r.key), r.record_type, r.digest, str(r.refers_to), r.payload_bytes, r.status) for r in warc.round_trip(df).collect())
    top = {}
    for k, _, h in rows:
        top[h or ""] = max(top.get(h or "", -1), -1 if k is None else k)
    want = []
    for k, _, h in rows:
        data = (h or "").encode()
        again = len(data) >= 1000 and k != top[h or ""]
        want.append((str(k), "revisit" if again else "response", hashlib.sha1(data).hexdigest(), str(top[h]) if again else "None", len(data), "ok"))
    assert got == sorted(want)
    assert warc.round_trip(df.limit(0)).count() == 0


def test_warc_faults_are_reported(spark):
    df = spark.createDataFrame([(1, "u", "z" * 70_000)], "page_id long, url string, html string")
    path = scratch_path(spark, "warc-test")
    warc.write_warc(df, path)
    found = spark.read.format("binaryFile").load(path).select("content").mapInArrow(warc._parse, warc._RECORD)
    assert [r.payload.decode() for r in warc.read_warc(spark, path).collect()] == ["z" * 70_000]
    n = found.count()
    assert n > 3
    status = lambda x: [r.status for r in warc.reassemble(x).collect()]
    assert status(found) == [None]
    assert status(found.where("number <> 2")) == ["segments"] and status(found.where(f"number <> {n}")) == ["segments"]
    assert status(found.where("number <> 1")) == ["segments"]
    assert status(found.withColumn("total", F.col("total") + 1)) == ["length"]


def test_top_k(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(0, 0.2, 8).astype("float32").tolist()) for i in range(120)]
    rows += [(200 + i, rows[0][1]) for i in range(30)]  # ties
    rows += [(300, None), (301, [None] * 8), (302, [float("nan")] * 8), (303, [float("inf")] * 8), (None, rows[1][1]), (0, rows[0][1]),
             (304, [0.5, 0.25]), (306, [0.1, 0.1]), (320, []), (305, [0.0] * 8)]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, id int, v int")
    got = topk.top_k(topk.quantised(df), F.col("id") % 20 == 0, k=6, vector_block=40, query_block=3)
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got.collect())
    kept = [(i, np.floor(64 * np.array(v, float)).astype(int)) for i, v in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    # As in the query's SQL, rows that share an id are rows of their own, and no candidates of each other.
    want = []
    for q in {i for i, _ in kept if i % 20 == 0}:
        best = sorted((-int(x @ v), i) for j, x in kept if j == q for i, v in kept if i != q and len(v) == len(x))[:6]
        want += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    assert got == sorted(want)
    assert topk.top_k(topk.quantised(df.limit(0)), F.col("id") % 20 == 0).count() == 0


def components_by_force(rows, size, percent):
    sets = [set(near_dup.shingle_set(t or "", size).tolist()) for _, t in rows]
    at = list(range(len(rows)))

    def find(i):
        while at[i] != i:
            i = at[i]
        return i
    for i, j in itertools.combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j]):
            at[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(i)
    out = []
    for members in groups.values():
        keys = [rows[i][0] for i in members if rows[i][0] is not None]
        out += [(str(rows[i][0]), len(sets[i]), str(min(keys) if keys else None)) for i in members]
    return sorted(out)


def test_near_duplicates(spark, monkeypatch):
    for size in (2, 5):
        got = near_dup.near_duplicates(table(spark, ROWS), shingle_words=size).collect()
        assert sorted((str(r.key), r.n_shingles, str(r.component)) for r in got) == components_by_force(ROWS, size, 80)
        assert all(r.kept == (r.key == r.component) for r in got)
    assert near_dup.near_duplicates(table(spark, [])).count() == 0


def test_near_duplicates_in_blocks(spark, monkeypatch):
    """A family around the threshold, with blocks of a few members."""
    monkeypatch.setattr(near_dup, "SKETCH_BLOCK", 4)
    monkeypatch.setattr(near_dup, "SET_BLOCK", 4096)
    monkeypatch.setattr(near_dup, "LEADERS", 1)
    rng, base, rows = random.Random(5), [f"v{i}" for i in range(120)], []
    for i in range(60):
        t = list(base)
        for p in rng.sample(range(120), rng.randint(2, 9)):
            t[p] = f"n{i}x{p}"
        rows.append((i, " ".join(t)))
    got = near_dup.near_duplicates(table(spark, rows), shingle_words=2).collect()
    assert sorted((str(r.key), r.n_shingles, str(r.component)) for r in got) == components_by_force(rows, 2, 80)


def test_keep_one(spark):
    df = table(spark, ROWS)
    kept = near_dup.keep_one(df)
    assert kept.columns == df.columns
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(rows) == len(set(rows))
    ids = [k for k, _ in rows]
    assert {2, 3, 4, 100, 101}.issuperset({k for k in ids if k in (2, 3, 4)}) and 5 not in ids and not set(range(200, 208)) & set(ids)


def repeats_by_force(rows, window):
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    first = {}
    for (k, _), w in zip(rows, split):
        for i in range(len(w) - window + 1):
            if k is not None:
                g = tuple(w[i:i + window])
                first[g] = min(k, first.get(g, k))
    out = []
    for (k, _), w in zip(rows, split):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if k is not None and first[tuple(w[i:i + window])] < k:
                gone[i:i + window] = [True] * window
        out.append((str(k), len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return sorted(out)


@pytest.mark.parametrize("broadcast_rows, shard_words", [(substrings.BROADCAST_ROWS, substrings.SHARD_WORDS), (0, 60)])
def test_remove_repeats(spark, broadcast_rows, shard_words):
    got = substrings.remove_repeats(table(spark, ROWS), broadcast_rows=broadcast_rows, shard_words=shard_words)
    assert got.columns[-3:] == ["n_words_", "spans__", "kept_text_"]  # spans_ is taken
    got = sorted((str(r.doc_id), r.n_words_, sum(s.end - s.start for s in r["spans__"]), r.kept_text_) for r in got.collect())
    assert got == repeats_by_force(ROWS, 13)


def test_remove_repeats_of_an_empty_table_and_untidy(spark):
    assert substrings.remove_repeats(table(spark, [])).count() == 0
    got = substrings.remove_repeats(table(spark, [(1, "a  b\n")]), keep=["doc_id"], tidy=False).collect()
    assert got[0].kept_text_ == "a  b\n"


def test_minimax_shards(spark, monkeypatch):
    monkeypatch.setattr(sharding, "SUB_ROWS", 3)
    rng = random.Random(9)
    rows = [(i, f"g{rng.randrange(40)}", rng.randint(0, 50)) for i in range(150)] + [(200 + i, "hot", 9) for i in range(30)]
    rows += [(300, None, 5), (301, None, 6), (None, "g1", 3), (7, "g1", 4), (7, "g1", 4)]
    df = spark.createDataFrame(rows, "id long, g string, s long")
    for n_shards in (1, 5, 16):
        got = sharding.minimax_shards(df, n_shards, "id", "g", "s", block_groups=7).collect()
        groups = {}
        for i, g, s in rows:
            a, b = groups.get(g, (float("inf"), 0))
            groups[g] = (min(a, float("inf") if i is None else i), b + s)
        sizes = [b for _, (a, b) in sorted(groups.items(), key=lambda x: (x[1][0], x[0] or ""))]

        def need(c):
            shards, room = 1, c
            for b in sizes:
                if b > room:
                    shards, room = shards + 1, c
                room -= b
            return shards
        best = next(c for c in range(max(sizes), sum(sizes) + 1) if need(c) <= n_shards)
        total, slots, where = {}, {}, {}
        for r in got:
            total[r.shard] = total.get(r.shard, 0) + r.s
            slots.setdefault(r.shard, []).append(r.slot)
            where.setdefault(r.g, set()).add(r.shard)
        assert max(total.values()) == best and max(total) < n_shards and len(got) == len(rows)
        assert all(sorted(v) == list(range(len(v))) for v in slots.values())
        assert all(len(v) == 1 for v in where.values())
    assert sharding.minimax_shards(df.limit(0), 4, "id", "g", "s").count() == 0


def test_successors_and_fingerprints(spark, monkeypatch):
    got = imatch.successors(table(spark, ROWS)).collect()
    plain = lambda rows: sorted((k is not None, k or 0, t or "") for k, t in rows)
    assert plain((r.key, r.text) for r in got) == plain(ROWS)
    # Each row's text is followed as often as it occurs; unique keys have one certain successor.
    assert sorted(r.next_text for r in got) == sorted(t or "" for _, t in ROWS)
    order = sorted(k for k, _ in ROWS if k is not None)
    by = {}
    for k, t in ROWS:
        by.setdefault(k, set()).add(t or "")
    for r in got:
        if r.key is not None and order.count(r.key) == 1:
            i = order.index(r.key) + 1
            assert r.next_text in by[order[i] if i < len(order) else None]
    assert imatch.successors(table(spark, [(1, "a b")])).collect()[0].next_text == "a b"
    assert imatch.successors(table(spark, [])).count() == 0
    docs = table(spark, ROWS)
    lexicon = imatch.fit_lexicon(docs, low=0.0, high=0.5)
    df = {}
    for _, t in ROWS:
        for x in imatch.terms(t or "").tolist():
            df[x] = df.get(x, 0) + 1
    assert lexicon.tolist() == sorted(x for x, n in df.items() if 2 <= n <= 0.5 * len(ROWS))
    made = imatch.fingerprints(docs.select("doc_id", "text"), lexicon, ["text"]).collect()
    want = sorted((str(k), imatch.fingerprint(t or "", lexicon)) for k, t in ROWS)
    assert sorted((str(r.doc_id), r.text) for r in made) == want
    assert len(imatch.fit_lexicon(table(spark, []))) == 0
    # A band too large to be broadcast is joined, with the same result.
    monkeypatch.setattr(imatch, "MOST_TERMS", 0)
    band = imatch.fit_lexicon(docs, low=0.0, high=0.5)
    joined = imatch.fingerprints(docs.select("doc_id", "text", F.lit(1).alias("row_")), band, ["text"], near={"own": ("text", "text")}).collect()
    assert sorted((str(r.doc_id), r.text) for r in joined) == want and all(r.own == 1.0 for r in joined)


def test_lattice_equals_the_library(spark, monkeypatch):
    monkeypatch.setattr(lattice, "WORDS", 50)
    monkeypatch.setattr(lattice, "DOCS", 3)
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = [*ROWS, (20, "internationalization" * 9), (21, "x.y,z;²m. U+²5? ▁▁ a\x00b \x01\x02"), (22, "   spaces   "), (23, "▁"), (24, "😀")]
    back = lattice.decode(lattice.encode(table(spark, rows), PIECES), PIECES).collect()
    got = sorted((str(r.key), np.frombuffer(bytes(r.ids), "<u4").tolist(), r.text) for r in back)
    want = sorted((str(k), lib.encode(t or ""), lib.decode(lib.encode(t or ""))) for k, t in rows)
    assert got == want
    assert lattice.encode(table(spark, []), PIECES).count() == 0


def test_unigram_lattice_equals_the_library(spark, tmp_path):
    """A hand-written unigram model: Viterbi in Spark against the library."""
    model = sentencepiece_model_pb2.ModelProto()
    kinds = sentencepiece_model_pb2.ModelProto.SentencePiece
    model.trainer_spec.model_type = sentencepiece_model_pb2.TrainerSpec.UNIGRAM
    model.normalizer_spec.name, model.normalizer_spec.remove_extra_whitespaces = "identity", False
    rng = random.Random(4)
    pieces = {"".join(rng.choice("abc") for _ in range(rng.randint(2, 5))) for _ in range(60)} | {"▁a", "▁bc", "▁", "a", "b", "c", "▁▁"}
    for name, kind in (("<unk>", kinds.UNKNOWN), ("<s>", kinds.CONTROL), ("</s>", kinds.CONTROL)):
        model.pieces.add(piece=name, score=0.0, type=kind)
    for p in sorted(pieces):
        model.pieces.add(piece=p, score=-rng.uniform(1, 9) * len(p) ** 0.5, type=kinds.NORMAL)
    path = str(tmp_path / "unigram.model")
    with open(path, "wb") as fh:
        fh.write(model.SerializeToString())
    lib = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = [(i, " ".join("".join(rng.choice("abc") for _ in range(rng.randint(1, 12))) for _ in range(6))) for i in range(25)]
    rows += [(30, "abc" * 40), (31, ""), (32, None)]
    back = lattice.decode(lattice.encode(table(spark, rows), path), path).collect()
    for r in back:
        text = dict(rows)[r.key] or ""
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == lib.encode(text) and r.text == text


def test_quality(spark):
    rng = random.Random(2)
    rows = [(i, words(rng, 40) if i % 2 else " ".join(f"w{rng.randrange(9)}###" for _ in range(40))) for i in range(400)]
    docs = table(spark, [*rows, (None, "x"), (5, None), (6, ""), (7, "w " * 20_000)])
    labels = spark.createDataFrame([*[(i, i % 2, 0, "x") for i in range(0, 400)], (None, 1, 0, "x"), (3, None, 1, "x")],
                                   "doc_id long, quality int, toxic int, text string")
    model = quality.train(docs, labels, rows=200)
    got = quality.score(docs, model)
    assert got.columns == [*docs.columns, "score__"]  # score_ is taken
    scored = [(r.doc_id, r.text, r["score__"]) for r in got.collect()]
    assert len(scored) == 404 and all(0 <= s <= 1 for _, _, s in scored)
    held = spark.createDataFrame([(i,) for i in range(400)], "doc_id long").where(quality.held_out(F.col("doc_id"))).collect()
    held = {r.doc_id for r in held}
    assert 40 < len(held) < 120
    texts = {k: t for k, t in rows}
    assert all((s >= 0.5) == bool(k % 2) for k, t, s in scored if k in held and t == texts.get(k))
    assert quality.score(table(spark, []), model).count() == 0
    none = quality.train(docs, labels.limit(0))
    assert {r["score__"] for r in quality.score(docs, none).collect()} == {0.5}


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(13)
    good = [(i, words(rng, 60, 5000), "en", "s", 1) for i in range(120)]
    passage = words(rng, 40, 100_000)
    rows = [*good, *[(1000 + i, good[3][1], "en", "s", 1) for i in range(5)],
            *[(2000 + i, " ".join(f"w{rng.randrange(99)}###" for _ in range(50)), "en", "s", 1) for i in range(80)],
            *[(3000 + i, f"{words(rng, 50, 5000)} {passage} {words(rng, 20, 5000)}", "en", "s", 1) for i in range(3)],
            (4000, None, None, None, None), (None, "", "en", "s", 0), (5, good[5][1], "en", "s", 1)]
    path = str(tmp_path)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([*[(i, 1, 0) for i in range(120)], *[(2000 + i, 0, 0) for i in range(80)]],
                          "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dup", "substring", "packing"]
    now, seen = spark.read.parquet(f"{path}/documents.parquet"), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, path)
        if i < 3:
            assert out.columns == docs.columns
        out.write.parquet(f"{path}/out{i}")
        now = spark.read.parquet(f"{path}/out{i}")
        seen.append(now.collect())
    after_quality = {r.doc_id for r in seen[0]}
    assert not {k for k in after_quality if k and 2000 <= k < 2080} and set(range(120)) <= after_quality
    ids = [r.doc_id for r in seen[1]]
    assert ids.count(5) == 1 and set(range(120)) <= set(ids) and not set(range(1000, 1005)) & set(ids)
    texts = {r.doc_id: r.text for r in seen[2]}
    assert passage in texts[3000] and passage not in texts[3001] and passage not in texts[3002]
    assert all(texts[i] == good[i][1] for i in range(120))
    packed = corpus_pipeline.run(spark, path).collect()
    key = lambda r: (str(r.doc_id), r.start, r.length, bytes(r.ids))
    assert sorted(map(key, packed)) == sorted(map(key, seen[3]))
    lib = Tokenizer.from_file(BPE)
    for k, t in texts.items():
        mine = b"".join(bytes(r.ids) for r in sorted((r for r in packed if r.doc_id == k), key=lambda r: r.start))
        if ids.count(k) == 1:
            assert np.frombuffer(mine, "<u4").tolist() == [*lib.encode(t, add_special_tokens=False).ids, 0]


def test_late_pieces_of_a_bpe_model_equal_the_library(spark, tmp_path):
    """Merges that make way for a better one: a pass over the edges by score is not enough."""
    model = sentencepiece_model_pb2.ModelProto()
    kinds = sentencepiece_model_pb2.ModelProto.SentencePiece
    model.trainer_spec.model_type = sentencepiece_model_pb2.TrainerSpec.BPE
    model.normalizer_spec.name, model.normalizer_spec.remove_extra_whitespaces = "identity", False
    for name, kind in (("<unk>", kinds.UNKNOWN), ("<s>", kinds.CONTROL), ("</s>", kinds.CONTROL)):
        model.pieces.add(piece=name, score=0.0, type=kind)
    rng = random.Random(9)
    pieces = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(2, 4))) for _ in range(40)} | {"▁a", "▁b"})
    rng.shuffle(pieces)
    for i, p in enumerate([*pieces, "▁", "a", "b", "c"]):
        model.pieces.add(piece=p, score=-float(i), type=kinds.NORMAL)
    path = str(tmp_path / "late.model")
    with open(path, "wb") as fh:
        fh.write(model.SerializeToString())
    assert lattice.load(path).late
    lib = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = [(i, " ".join("".join(rng.choice("abc") for _ in range(rng.randint(1, 14))) for _ in range(8))) for i in range(25)]
    rows += [(30, "abc" * 40), (31, ""), (32, None)]
    for r in lattice.round_trip(table(spark, rows), path).collect():
        text = dict(rows)[r.key] or ""
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == lib.encode(text) and r.text == text


def test_lattice_has_three_python_nodes_a_stage(spark):
    from starloom.llm.queries import QUERIES
    plan = QUERIES["op9_sentencepiece"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 3


def test_words_are_shared_by_the_splits_of_a_task(spark, tmp_path):
    path = str(tmp_path / "documents.parquet")
    cores = spark.sparkContext.defaultParallelism
    spark.range(9000).repartition(cores * 12).write.parquet(path)
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")  # a split for each file
    try:
        docs = spark.read.parquet(path)
        assert docs.rdd.getNumPartitions() == cores * 12
        assert lattice.large_tasks(docs).rdd.getNumPartitions() == cores * 2 and lattice.large_tasks(docs).count() == 9000
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert lattice.large_tasks(spark.read.parquet(path)).count() == 9000
