"""The registered queries on the sf0.001 tables: SQL where there is some,
else brute force over the whole tables."""

import hashlib
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from starloom.llm import lattice
from starloom.llm.queries import BYTE_BPE, ORACLE, PIECES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.fixture(scope="module")
def texts(duck):
    return dict(duck.execute("SELECT doc_id, coalesce(text, '') FROM documents").fetchall())


def rows(table):
    names = sorted(table.column_names)
    return sorted(zip(*(table.column(n).to_pylist() for n in names)), key=repr), names


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, duck, name):
    assert rows(QUERIES[name](spark, SF).toArrow()) == rows(duck.execute(ORACLE[name]).to_arrow_table())


def test_counts_and_pieces(spark, texts):
    lib = Tokenizer.from_file(public_tokenizers.path(BYTE_BPE))
    ids = {k: lib.encode(t, add_special_tokens=False).ids for k, t in texts.items()}
    got = {r.doc_id: r for r in QUERIES["op2_token_counts"](spark, SF).collect()}
    assert set(got) == set(ids)
    for k, r in got.items():
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[k].encode()), len(ids[k]), len(ids[k]) > 512)
    pieces = QUERIES["op4_packing"](spark, SF).collect()
    bins, total = {}, {}
    for r in pieces:
        own = np.array([*ids[r.doc_id], 0], "<u4")
        assert r.doc_tokens == len(own) and r.ids_crc32 == zlib.crc32(own[r.start:r.start + r.length].tobytes())
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
        total[r.doc_id] = total.get(r.doc_id, 0) + r.length
    assert total == {k: len(v) + 1 for k, v in ids.items()}
    for places in bins.values():
        ends = np.cumsum([0, *(n for _, n in sorted(places))])
        assert [o for o, _ in sorted(places)] == ends[:-1].tolist() and ends[-1] <= 1024
    assert len(bins) <= 1.05 * sum(total.values()) / 1024 + 1


def test_fingerprints(spark, texts):
    got = {r.doc_id: r for r in QUERIES["op7_imatch"](spark, SF).collect()}
    order = sorted(texts)
    wins = 0
    for i, k in enumerate(order):
        text, following = texts[k], texts[order[(i + 1) % len(order)]]
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        r = got[k]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1
        wins += r.near_edited > r.near_next
        for other in (j for j in order if texts[j] == text):
            assert got[other].fingerprint == r.fingerprint
    assert len(got) == len(order) and wins > 0.75 * len(order)


def test_shards(spark, texts):
    got = QUERIES["op8_sharding"](spark, SF).collect()
    assert len(got) == len(texts)
    slots, sizes, where = {}, {}, {}
    for r in got:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
        slots.setdefault(r.shard, []).append(r.slot)
        sizes[r.shard] = sizes.get(r.shard, 0) + r.size
        where.setdefault(raw, set()).add(r.shard)
    assert set(slots) <= set(range(16)) and all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert all(len(v) == 1 for v in where.values())
    assert max(sizes.values()) <= sum(sizes.values()) / 16 + max(len(t) + 1 for t in where)


def test_sentencepiece(spark, texts):
    lib = lattice.library(public_tokenizers.path(PIECES))
    got = {r.doc_id: r for r in QUERIES["op9_sentencepiece"](spark, SF).collect()}
    for k, t in texts.items():
        ids = lib.encode(t)
        assert (got[k].n_pieces, got[k].ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        assert got[k].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()


def test_quality(spark, duck):
    labels = dict(duck.execute("SELECT doc_id, quality FROM labels").fetchall())
    got = QUERIES["op10_quality"](spark, "/root/testdata/sf0.01").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.3) for r in got)
    more = dict(duck.execute("SELECT doc_id, quality FROM read_parquet('/root/testdata/sf0.01/labels.parquet')").fetchall())
    held = [(r.predicted, more[r.doc_id]) for r in got if r.held_out and r.doc_id in more]
    assert labels and len(held) > 30 and sum(p == q for p, q in held) >= 0.95 * len(held)
