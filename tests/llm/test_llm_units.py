"""The numpy and Python parts against brute force, without Spark."""

import itertools
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from starloom.llm import imatch, lattice, near_dup, packing, quality, substrings, warc
from starloom.llm.automaton import SuffixAutomaton
from starloom.llm.bpe import SPLIT, BpeEncoder, byte_alphabet
from starloom.llm.topk import ImpactIndex

BPE = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "a", "  a  b ", "it's we'll 'tis '", "\n\n x\t\ty\r\n", "tab\x1fsep \x85 x", "½ ² ³ a²b", "日本語 テキスト。", "אבג د ٣٤",
       "a<|endoftext|>b <|endoftext|><|endoftext|", "é́ ñ", "😀😀 x", "…“q”—", "a" * 3000, "x_y __ _", "१२३ Ⅷ", "\x00\x01 ﻿"]


def test_bpe_ids_equal_the_library():
    enc, lib = BpeEncoder(BPE), Tokenizer.from_file(BPE)
    for text in ODD:
        assert "".join(enc.pretokens(text)) == text
        assert np.frombuffer(enc.encode(text), "<u4").tolist() == lib.encode(text, add_special_tokens=False).ids, repr(text)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_bpe_ids_equal_the_library_on_any_text(text):
    enc, lib = test_bpe_ids_equal_the_library_on_any_text.both
    assert np.frombuffer(enc.encode(text), "<u4").tolist() == lib.encode(text, add_special_tokens=False).ids


test_bpe_ids_equal_the_library_on_any_text.both = (BpeEncoder(BPE), Tokenizer.from_file(BPE))


def test_bpe_constants():
    assert SPLIT == public_tokenizers.PATTERN
    assert sorted(byte_alphabet().values()) == list(range(256))


def test_bpe_rejects_other_files():
    with pytest.raises(ValueError):
        BpeEncoder(public_tokenizers.path("word_bpe_49k.json"))


@pytest.mark.parametrize("payload", [b"", b"x", b"0\r\n\r\n", bytes(range(256)) * 40])
def test_chunked_framing_round_trip(payload):
    assert warc.dechunked(warc.chunked(payload, 7)) == payload


def test_dechunk_extensions_trailers_and_faults():
    assert warc.dechunked(b"3;a=b\r\nabc\r\n0\r\nX: y\r\n\r\n") == b"abc"
    for bad in (b"", b"zz\r\n", b"5\r\nabc\r\n0\r\n\r\n", b"-1\r\n"):
        with pytest.raises(ValueError):
            warc.dechunked(bad)


def test_impact_index_equals_brute_force():
    rng = np.random.default_rng(5)
    for _ in range(120):
        n, d = int(rng.integers(1, 50)), int(rng.integers(0, 6))
        scale = int(rng.choice([1, 30, 10**6, 10**9]))
        x = rng.integers(-scale, scale + 1, (n, d))
        if n > 2 and rng.random() < 0.4:
            x[n // 2:] = x[0]
        ids, k = rng.permutation(n), int(rng.integers(1, 8))
        index = ImpactIndex(ids, x)
        for j in range(n):
            scores = x @ x[j]
            order = np.lexsort((ids, -scores))
            order = order[ids[order] != ids[j]][:k]
            got = index.search(x[j], k, ids[j])
            assert np.array_equal(got[0], ids[order]) and np.array_equal(got[1], scores[order])


def test_impact_index_stops_before_all_postings():
    x = np.random.default_rng(1).integers(-20, 21, (4000, 32))
    index = ImpactIndex(np.arange(4000), x)
    assert index.search(x[0], 10, 0)[2] < 4000 * 32


def test_first_fit_decreasing_equals_plain_first_fit():
    rng = random.Random(3)
    for _ in range(40):
        lengths = [rng.randint(1, 60) for _ in range(rng.randint(1, 80))]
        free, want = [], {}
        for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
            at = next((b for b, f in enumerate(free) if f >= lengths[i]), len(free))
            if at == len(free):
                free.append(60)
            want[i] = (at, 60 - free[at])
            free[at] -= lengths[i]
        assert packing.first_fit_decreasing(lengths, 60) == [want[i] for i in range(len(lengths))]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=14), max_size=6), st.integers(1, 5))
def test_automaton_owners_equal_brute_force(sequences, window):
    automaton = SuffixAutomaton()
    first = {}
    for owner, s in enumerate(sequences):
        automaton.add(s, owner)
        for i in range(len(s) - window + 1):
            first.setdefault(tuple(s[i:i + window]), owner)
    for s in [*sequences, [0, 1, 2, 3, 9, 0, 0, 1]]:
        assert automaton.owners(s, window) == [first.get(tuple(s[i:i + window])) for i in range(len(s) - window + 1)]


def test_equal_windows_have_equal_minimizers():
    rng = random.Random(2)
    words = [rng.choice("abcdef") for _ in range(400)]
    h = substrings.word_hashes(" ".join(words))
    m = substrings.minimizers(h, 13)
    assert len(m) == len(words) - 12
    by = {}
    for i, value in enumerate(m.tolist()):
        assert by.setdefault(tuple(words[i:i + 13]), value) == value


def test_shingle_sets():
    sets = lambda t, n=2: set(near_dup.shingle_set(t, n).tolist())
    assert sets("") == sets(" \t\n") == set()
    assert sets("A b A b") == sets("a B a b a") and len(sets("a b a b")) == 2
    assert len(sets("one")) == 1 and sets("one") != sets("two") and not sets("a b") & sets("b a")
    assert sets("É x") != sets("é x") and sets("a\xa0b") != sets("a b")


def test_odd_sketch_estimates_similarity():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 62, 1000).astype(np.uint64)
    with np.errstate(over="ignore"):
        for share in (1.0, 0.9, 0.5):
            other = base.copy()
            k = int(1000 * (1 - share))
            other[:k] = rng.integers(0, 1 << 62, k)
            true = len(np.intersect1d(base, other)) / len(np.union1d(base, other))
            a, b = (near_dup.odd_sketch(near_dup.samples(np.unique(x))).view(np.uint64) for x in (base, other))
            z = int(near_dup.differing_bits(a, b))
            estimate = 1 + near_dup.SKETCH_BITS / 2 * np.log(1 - 2 * z / near_dup.SKETCH_BITS) / (2 * near_dup.SAMPLES)
            assert abs(estimate - true) < 0.15
            assert (z <= near_dup.most_bits(0.8)) == (share > 0.6)


def test_common_counts():
    rng = np.random.default_rng(6)
    sets = [np.unique(rng.integers(0, 60, rng.integers(0, 40)).astype(np.uint64)) for _ in range(30)]
    got = near_dup.common_counts(sets)
    for i, j in itertools.product(range(30), repeat=2):
        assert got[i, j] == len(np.intersect1d(sets[i], sets[j]))


def test_fingerprints():
    lexicon = imatch.terms(" ".join(f"w{i}" for i in range(400)))
    text = " ".join(f"w{i}" for i in range(200))
    like = lambda a, b: imatch._likeness([imatch.fingerprint(a, lexicon)], [imatch.fingerprint(b, lexicon)])[0]
    assert imatch.fingerprint("W1, w2!", lexicon) == imatch.fingerprint("w2 w1 w2", lexicon)
    assert like(text, text + " zzz") == 1.0
    assert 0 < like(text, " ".join(f"w{i}" for i in range(100, 300))) < 1
    assert like(text, " ".join(f"w{i}" for i in range(200, 400))) < 0.05
    assert imatch.fingerprint("", lexicon)[0] == imatch.fingerprint("zz", lexicon)[0] == "t" and like("", "zz") == 0.0
    assert like("", "") == 1.0 and imatch.fingerprint("w1", lexicon[:0])[0] == "t"


def test_every_term_is_in_lexicons_of_its_own():
    words = [f"w{i}" for i in range(300)]
    lexicon = imatch.terms(" ".join(words))
    assert len(lexicon) == 300  # no term is left out by its hash
    # A text of one band term is told by that term, with more than the term as without.
    assert all(imatch.fingerprint(w, lexicon)[0] == "i" for w in words)
    assert all(imatch.fingerprint(w, lexicon) == imatch.fingerprint(f"{w} qqq", lexicon) for w in words)
    # One term less: each of the densest lexicons held it with a chance of its own of one half.
    row = lambda w: np.frombuffer(bytes.fromhex(imatch.fingerprint(" ".join(w), lexicon)[1:]), ">u2")
    whole = row(words)
    changed = np.array([row(words[:i] + words[i + 1:]) != whole for i in range(300)])
    assert (np.abs(changed[:, :imatch.PER_LEVEL].mean(axis=0) - 0.5) < 0.15).all()
    # Lexicons of 9 and more of these terms differ from each other.
    dense = 5 * imatch.PER_LEVEL
    assert len({c.tobytes() for c in changed.T[:dense]}) == dense


def test_boosted_trees_learn_and_traverse():
    rng = np.random.default_rng(7)
    x = rng.normal(size=(1500, 5))
    y = ((x[:, 1] > 0.3) ^ (x[:, 3] > 0)).astype(float)
    model = quality.fit(x[:1000], y[:1000], trees=40)
    assert ((model.score(x[1000:]) > 0.5) == y[1000:]).mean() > 0.93
    # One row by plain recursion.
    total, inner = model.prior, model.feature.shape[1]
    for t in range(len(model.feature)):
        at = 0
        while at < inner:
            at = 2 * at + 1 + int(x[3, model.feature[t, at]] > model.cut[t, at])
        total += model.leaf[t, at - inner]
    assert abs(1 / (1 + np.exp(-total)) - model.score(x[3:4])[0]) < 1e-12


def test_classifier_without_or_with_one_class():
    width = len(quality.FEATURES)
    assert quality.fit(np.zeros((0, width)), np.zeros(0)).score(np.zeros((2, width))).tolist() == [0.5, 0.5]
    assert quality.fit(np.ones((20, width)), np.ones(20)).score(np.zeros((1, width)))[0] > 0.9
    for text in ODD:
        assert len(quality.statistics(text)) == width and np.isfinite(quality.statistics(text)).all()


def test_words_never_cut_a_piece():
    model = lattice.load(public_tokenizers.path("piece_bpe_32k.model"))
    assert lattice.split_words("Ab,c.  d ", model) == ["▁Ab", ",", "c", ".", "▁▁d", "▁"]
    for text in [*ODD, *(p.replace("▁", " ") for p, _, _ in model.pieces[::7])]:
        assert "".join(lattice.split_words(text, model)) == (("▁" + text.replace(" ", "▁")) if text else "")
    bare = lambda p: lattice.split_words(p.lstrip("▁").replace("▁", " "), model)
    assert all(len(bare(p)) == 1 for p, _, _ in model.pieces if p.strip("▁"))


def test_long_words_fold_as_the_library_does():
    path = public_tokenizers.path("piece_bpe_32k.model")
    model, lib = lattice.load(path), lattice.library(path)
    rank = {p: -s for p, _, s in model.pieces}
    for text in ("internationalization" * 20, "aaaaabaaaab" * 15, "thththe" * 30):
        word = "▁" + text
        edges = [(rank[word[s:e]], s, e) for s in range(len(word)) for e in range(s + 2, min(len(word), s + model.longest) + 1)
                 if word[s:e] in rank]
        at = lattice.long_merges(len(word), edges)
        assert [word[s:e] for s, e in zip(at, at[1:])] == lib.encode(text, out_type=str)


def test_long_viterbi_equals_brute_force():
    rng = random.Random(8)
    for _ in range(60):
        n = rng.randint(1, 8)
        edges = sorted(((rng.uniform(-9, 0), s, e) for s in range(n) for e in range(s + 1, n + 1) if e == s + 1 or rng.random() < 0.4),
                       key=lambda x: (x[2], x[1]))
        score = {(s, e): v for v, s, e in edges}
        paths = ([0, *c, n] for k in range(n) for c in itertools.combinations(range(1, n), k))
        best = max((p for p in paths if all(x in score for x in zip(p, p[1:]))), key=lambda p: sum(score[x] for x in zip(p, p[1:])))
        assert lattice.long_viterbi(n, edges) == best


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("aB1.,!é \t\x1c\u2028", max_size=9), max_size=30), st.integers(2, 40))
def test_terms_are_the_stripped_words(parts, chunk):
    text = " ".join(parts)
    plain = lambda t: {w.strip(imatch.ENDS) for w in t.encode().lower().split()} - {b""}
    found = imatch.terms(text)
    assert found.tolist() == sorted({int(imatch.terms(w.decode())[0]) for w in plain(text)})
    assert len(found) == len(plain(text))
    assert imatch._chunk_terms(b" ".join(imatch._chunks(text.encode().lower()))).size >= len(found)


def test_terms_of_long_texts_and_words():
    words = [f"w{i}" for i in range(30_000)]
    whole = imatch.terms(" ".join(words))
    assert len(whole) == 30_000 and set(imatch.terms("(w7) W29999!").tolist()) <= set(whole.tolist())
    assert len(imatch.terms("x" * 200_000 + " w7 " + "x" * 200_000 + ".")) == 2


def test_fingerprint_hashes_each_lexicon_as_a_set():
    """Against sets drawn term by term."""
    t = imatch.terms(" ".join(f"w{i}" for i in range(2_500)))
    seed = [int(x) for x in imatch._SEED[:, 0]]
    mixed = lambda x: int(imatch.mix(np.array([x % 2**64], np.uint64))[0])
    want = []
    for level in range(imatch.LEVELS):
        for j in range(imatch.PER_LEVEL):
            own = [int(x) for x in t.tolist() if not mixed(x + seed[j]) & int(imatch._MASKS[level])]
            want.append(mixed(sum(map(mixed, own)) + int(imatch._PLACE[len(want)])) % 0xFFFF + 1 if own else 0)
    got = np.frombuffer(bytes.fromhex(imatch.fingerprint_of(t, "")[1:]), ">u2")
    assert got.tolist() == want


def test_late_pieces_are_those_that_one_pass_misses():
    assert lattice.late_pieces({"ab": 5.0, "abc": 2.0, "bc": 9.0}) == {"abc"}
    assert lattice.late_pieces({"ab": 1.0, "abc": 2.0, "bc": 9.0}) == frozenset()
    model = lattice.load(public_tokenizers.path("piece_bpe_32k.model"))
    assert model.late == {"▁" * 16}
