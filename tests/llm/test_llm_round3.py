"""The divergence audit, the repair of conversations and the n-gram join on
small tables: brute force, nulls, empty and long texts, ties, repeated rows,
empty tables, extra columns with clashing names."""

import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest

from starloom.llm import conversations, divergence, ngram_join
from starloom.llm.common import clear_scratch, ship, spread_join

CLASH = ["key", "n", "v", "part", "bucket", "terms", "ids", "counts", "cid", "root", "token", "ckey", "known", "hash", "symbol", "a.b", "rank"]


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)
    yield
    clear_scratch(spark)


def table(spark, rows, schema):
    extra = ", ".join(f"`{c}` string" for c in CLASH)
    return spark.createDataFrame([(*r, *CLASH) for r in rows], f"{schema}, {extra}")


# ------------------------------------------------------------------ divergence
def audit_by_hand(rows, min_docs, top):
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    docs, used, groups = Counter(), Counter(), set()
    for lang, source, text in rows:
        lang, source, text = lang or "", source or "", text or ""
        groups.add((lang, source))
        found = term.findall(text.translate(lower))
        docs.update((lang, t) for t in set(found))
        used.update((lang, source, t) for t in found)
    out = set()
    for lang in {g for g, _ in groups}:
        kept = sorted(t for (g, t), n in docs.items() if g == lang and n >= min_docs)
        sources = sorted(s for g, s in groups if g == lang)
        n = {s: sum(used[lang, s, t] for t in kept) for s in sources}
        def p(count, total):
            return 1 + 10**9 * (count + 1) // (total + len(kept))
        shares = {s: [p(used[lang, s, t], n[s]) for t in kept] for s in sources}
        whole = [p(sum(used[lang, s, t] for s in sources), sum(n.values())) for t in kept]
        for s in sources:
            pairs = [(sum((x - y) ** 2 // y for x, y in zip(shares[s], shares[o])), o) for o in sources if o != s]
            terms = [((x - y) ** 2 // y, t) for t, x, y in zip(kept, shares[s], whole) if used[lang, s, t] and x > y]
            for part, items in (("pair", pairs), ("term", terms)):
                for rank, (value, item) in enumerate(sorted(items, key=lambda v: (-v[0], v[1].encode())), 1):
                    if part == "pair" or rank <= top:
                        out.add((lang, s, part, item, value, rank))
    return out


def prose(rng, n):
    return " ".join(rng.choice(["Été", "the", "THE", "x", "naïve", "zo", "q9q", "日本", "b-c", "ab"]) + rng.choice(["", "s", "1", "é"])
                    for _ in range(n))


@pytest.mark.parametrize("groups", [2, 512])
def test_divergence_equals_brute_force(spark, monkeypatch, groups):
    monkeypatch.setattr(divergence, "GROUPS", groups)
    rng = random.Random(5)
    rows = [(rng.choice(["en", "de", None, "xx"]), rng.choice(["a", "b", "c", None, "é", "z", "B"]), prose(rng, rng.randint(0, 40)))
            for _ in range(150)]
    rows += [("en", "empty", None), ("solo", "s", "word word"), ("mute", "a", ""), ("mute", "b", "1 2 3"), ("en", "a", "the " * 3000)]
    rows += [("de", "copies", "zo the ab")] * 20
    for top in (3, 200):
        got = divergence.audit(table(spark, rows, "lang string, source string, text string"), top=top)
        assert {tuple(r) for r in got.collect()} == audit_by_hand(rows, 3, top)


def test_divergence_of_an_empty_table(spark):
    assert divergence.audit(table(spark, [], "lang string, source string, text string")).count() == 0


def test_equal_subtrees_are_one_node_and_walked_once():
    counts = np.array([[1, 0, 0, 0, 1, 0, 0, 0, 7], [1, 0, 0, 0, 1, 0, 0, 0, 0]])
    trees = divergence.Trees(counts)
    assert len(trees.levels[1][0]) < 2 * 4 - 1  # (1,0,0,0) stands twice in both trees
    i, a, b, times = trees.walk(np.array([0]), np.array([1]))
    assert sorted(zip(a.tolist(), b.tolist(), times.tolist())) == [(0, 0, 6), (1, 1, 2), (7, 0, 1)] and set(i) == {0}


def test_shares_stay_exact_beyond_64_bits():
    big = np.array([10**11, 5], np.int64)
    assert divergence.shares(big, 10**12, 7).tolist() == [1 + 10**9 * (10**11 + 1) // (10**12 + 7), 1 + 6 * 10**9 // (10**12 + 7)]


# --------------------------------------------------------------- conversations
def repair_by_hand(symbols):
    """Least (cost, edits) over all edit scripts, by search over positions."""
    best = {(0, 0): (0, "")}
    todo = [(0, "", 0, 0)]
    import heapq
    done = {}
    while todo:
        cost, edits, at, state = heapq.heappop(todo)
        if (at, state) in done:
            continue
        done[at, state] = (cost, edits)
        ways = []
        for letter in "ua":
            if (state, letter) in conversations.MOVES:
                ways.append((5, "I", at, conversations.MOVES[state, letter]))
        if at < len(symbols):
            s = symbols[at]
            ways.append((2, "D", at + 1, state))
            if s != "x":
                extra = 5 if s.isupper() else 0
                if (state, s.lower()) in conversations.MOVES:
                    ways.append((extra, "K", at + 1, conversations.MOVES[state, s.lower()]))
                for letter in "ua":
                    if (state, letter) in conversations.MOVES:
                        ways.append((1 + extra, "R", at + 1, conversations.MOVES[state, letter]))
        for more, edit, next_at, next_state in ways:
            heapq.heappush(todo, (cost + more, edits + edit, next_at, next_state))
    assert best
    return min(done[len(symbols), s] for s in conversations.ENDS if (len(symbols), s) in done)


def test_cheapest_edits_with_and_without_rules():
    rng = random.Random(3)
    made = conversations.Grammar()
    for pairs in (["ua", "xx", "Su"], ["", "ox"], ["", "u"]):
        assert made.extend([(p, 9) for p in pairs])
    strings = ["".join(p) for n in range(4) for p in itertools.product("suaoUx", repeat=n)]
    strings += ["".join(rng.choice("suaoSUAOxuaua") for _ in range(rng.randint(4, 14))) for _ in range(300)]
    strings += ["ua" * 6, "sua" + "x" * 7 + "uau", "xxxxua" * 3]
    for s in strings:
        want = repair_by_hand(s)
        assert conversations.cheapest(s, made.matrix) == want, s
        packed = conversations.compress(s, made.rules)
        assert conversations.cheapest(packed, made.matrix) == want, s


def conversation_rows():
    rng = random.Random(8)
    rows = []
    for c in range(40):
        for t in range(rng.randint(1, 9)):
            rows.append((c, t if rng.random() < 0.9 else None, rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None]),
                         rng.choice(["Hi.", "Yes!", "no end", " \t", "", None, "Why? \n", "é. ", "x.\v"])))
    rows += [(None, 0, "user", "Q."), (None, 1, "assistant", "A.")]
    rows += [(100, t, "user" if t % 2 == 0 else "assistant", f"line {t}.") for t in range(700)]  # one long conversation
    rows += [(101, 3, "user", "Same.")] * 50 + [(102, t, "user", "Again.") for t in range(60)]
    rows += [(103, 0, "user", "long " * 40_000 + "."), (103, 1, "assistant", "ok.")]
    return rows


def test_conversations_equal_brute_force(spark):
    import hashlib

    rows = conversation_rows()
    given = table(spark, rows, "conv_id long, turn long, role string, text string")
    made = conversations.ordered(given)
    plans = conversations.repair_plans(made)
    got = {r.ckey: r for r in plans.collect()}
    kept = {}
    for r in conversations.repaired(made, plans).collect():
        kept.setdefault(r.ckey, []).append((r.position, r.role, r.text))
    hashed = {r.ckey: r.sha256 for r in conversations.digests(conversations.repaired(made, plans)).collect()}
    by = {}
    for c, t, role, text in rows:
        by.setdefault(c, []).append((t is not None, t or 0, role if role is not None else " ", text if text is not None else " "))
    for c, own in by.items():
        own.sort(key=lambda r: (*r[:3], hashlib.md5(r[3].encode()).digest()))
        seen, symbols, faults, before, illegal = set(), "", Counter(), None, 0
        for _, _, role, text in own:
            full = text.rstrip(" \t\n\v\f\r")
            letter = role[:1]
            illegal += before is not None and before + letter not in ("su", "ua", "au")
            before = letter
            fault = "blank" if not full else "duplicate" if (role, text) in seen else "truncated" if full[-1] not in ".!?" else ""
            seen.add((role, text))
            faults[fault] += 1
            letter = letter if letter in ("s", "u", "a") and letter else "o"
            symbols += "x" if fault in ("blank", "duplicate") else letter.upper() if fault else letter
        turns = [t for known, t, _, _ in own if known]
        cost, audit = repair_by_hand(symbols)
        r = got.pop("" if c is None else f"={c}")
        assert (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit) == (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults["blank"], faults["duplicate"], faults["truncated"],
            illegal, cost, audit)
        fixed, at, stays = [], 0, sum(e != "D" for e in audit)
        for e in audit:
            place = len(fixed)
            new = "user" if (place - stays % 2) % 2 == 0 else "assistant"
            if e == "I":
                fixed.append((place, new, ""))
                continue
            if e != "D":
                fixed.append((place, own[at][2] if e == "K" else new, own[at][3]))
            at += 1
        assert kept.get(r.ckey, []) == fixed
        assert re.fullmatch("(s?(ua)+)?", "".join(role[0] for _, role, _ in fixed))
        lines = "\n".join(f"{role}:{text}" for _, role, text in fixed)
        assert hashed.get(r.ckey, hashlib.sha256(b"").hexdigest()) == hashlib.sha256(lines.encode()).hexdigest()
    assert not got


def test_conversations_of_an_empty_table(spark):
    made = conversations.ordered(table(spark, [], "conv_id long, turn long, role string, text string"))
    plans = conversations.repair_plans(made)
    assert plans.count() == 0 and conversations.digests(conversations.repaired(made, plans)).count() == 0


def test_rules_are_shared_and_bounded(spark):
    strings = spark.createDataFrame([("suauaua", 5), ("uauauaxx", 3), ("o", 9), ("", 1)], "symbols string, n long")
    made = conversations.grammar(strings)
    assert ("ua", "") in made.rules and all(made.rows[s] <= conversations.RULE_ROWS for _, s in made.rules)
    assert conversations.flat(made.matrix[""][0][3][1]) == "KK"


# ------------------------------------------------------------------ n-gram join
def join_by_hand(rows, size, percent):
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        n = min(size, len(w))
        sets.append(frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if w else frozenset())
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i
    for i, j in itertools.combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
            up[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[find(i)] = min(least.get(find(i), k), k)
    return sorted(((k, len(sets[i]), least.get(find(i)) if sets[i] else k) for i, (k, _) in enumerate(rows)), key=repr)


def corpus():
    rng = random.Random(21)

    def words(n, vocabulary=10_000):
        return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]
    rows, passage = [], words(40)
    for group in range(12):  # near copies, chains of them
        text = words(rng.choice([8, 30, 120, 400]))
        for i in range(rng.randint(2, 9)):
            text = list(text)
            text[rng.randrange(len(text))] = f"e{group}_{i}"
            rows.append((1000 * group + i, " ".join(text)))
    rows += [(20_000 + i, " ".join(words(20) + passage + words(20))) for i in range(15)]  # a common passage is no near copy
    rows += [(30_000 + i, rows[0][1]) for i in range(60)]
    base = words(200)
    rows += [(40_000 + i, " ".join(base[:200 - i * 4])) for i in range(12)]  # prefixes of falling size
    rows += [(1, None), (2, ""), (3, " \n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "One  two"), (None, "one two"), (None, None),
             (8, "z " * 900), (9, "é 日本 " * 9), (9, "é 日本 " * 9), (10, "a b c d e f"), (10, "quite another text stands here now")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [2048, ngram_join.SET_BLOCK])
def test_ngram_join_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "SET_BLOCK", block)
    rows = corpus()
    for size, percent in ((4, 85), (2, 60)):
        got = ngram_join.ngram_join(table(spark, rows, "doc_id long, text string"), shingle_words=size, percent=percent)
        assert sorted(map(tuple, got.collect()), key=repr) == join_by_hand(rows, size, percent)


def test_ngram_join_of_empty_tables(spark):
    assert ngram_join.ngram_join(table(spark, [], "doc_id long, text string")).count() == 0
    blank = ngram_join.ngram_join(table(spark, [(1, None), (2, " ")], "doc_id long, text string"))
    assert sorted(map(tuple, blank.collect())) == [(1, 0, 1), (2, 0, 2)]


def test_divide_skip_finds_all_partners():
    rng = np.random.default_rng(2)
    base = np.unique(rng.integers(0, 1 << 62, 300, dtype=np.uint64))
    sets = [np.unique(np.concatenate([base[rng.random(len(base)) > cut], rng.integers(0, 1 << 62, 20, dtype=np.uint64)]))
            for cut in (0, 0.02, 0.05, 0.1, 0.3) for _ in range(12)]
    index = ngram_join.Index(sets)
    for percent in (50, 80, 85, 95):
        for x, s in enumerate(sets):
            want = [y for y, o in enumerate(sets) if y != x and 100 * len(np.intersect1d(s, o)) >= percent * len(np.union1d(s, o))]
            assert sorted(index.partners(x, percent).tolist()) == want


def test_members_without_a_possible_partner_leave():
    rng = np.random.default_rng(9)
    sizes = rng.choice([1, 2, 3, 40, 63, 64, 65, 300, 383], 60)
    bucket = np.repeat(np.arange(60), sizes)
    rest = [rng.integers(1, 60, len(bucket)), rng.integers(0, 9, len(bucket)), rng.integers(1, 12, len(bucket))]
    got = ngram_join._matched(85, bucket, rest)
    for i in range(len(bucket)):
        others = [j for j in np.flatnonzero(bucket == bucket[i]) if j != i]
        want = any(ngram_join.may_link(85, *(x[i] for x in rest), *(x[j] for x in rest)) for j in others)
        assert got[i] == want
    # Linked sets always count as possible where they meet first, however large.
    for n, m, common in ((20, 20, 19), (100, 117, 100), (100, 100, 92), (1, 1, 1), (400, 470, 400)):
        assert 100 * common >= 85 * (n + m - common)
        least = -(-85 * (n + m) // 185)
        shared = common - max(ngram_join.least_overlap(n, 85), ngram_join.least_overlap(m, 85)) + 1
        assert ngram_join.may_link(85, n, n - common, shared, m, m - common, shared) and least <= common


def test_heavy_keys_meet_their_rows(spark):
    rows = spark.createDataFrame([(1, i) for i in range(900)] + [(k, 0) for k in range(2, 50)], "k long, x long")
    keyed = rows.groupBy("k").count().where("k <> 5")
    want = Counter(r.k for r in rows.collect() if r.k != 5)
    assert Counter(r.k for r in spread_join(rows, keyed, "k", "count").collect()) == want


# ------------------------------------------- faults found in earlier operators
def test_repeated_vectors_are_candidates_and_large_ones_take_no_part(spark):
    from pyspark.sql import functions as F

    from starloom.llm import topk
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.0]), (1, [0.25, 0.0]), (2, [3e38, -3e38]), (3, [-1.0, 2.0]), (20, [0.0, 1.0]), (20, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = topk.top_k(topk.quantised(df), F.col("id") % 20 == 0, k=3).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got if r.query_id == 0) == [
        (0, 1, 1, 2048), (0, 2, 1, 1024), (0, 3, 20, 0)]


def test_many_texts_under_one_key(spark):
    """Rows of one key meet their own classes only."""
    import time

    from starloom.llm import near_dup
    rng = random.Random(4)
    texts = [" ".join(f"w{rng.randrange(3000)}" for _ in range(30)) for _ in range(600)]
    texts += [t + " more" for t in texts]
    took = []
    for keys in (range(1200), [7] * 1200):
        df = table(spark, list(zip(keys, texts)), "doc_id long, text string")
        began = time.time()
        got = near_dup.near_duplicates(df).collect()
        took.append(time.time() - began)
        assert len(got) == 1200
    assert took[1] < 3 * took[0] + 5


def test_shards_of_rows_with_clashing_names(spark):
    from starloom.llm import sharding
    rows = [(i, f"g{i % 7}", 1 + i % 5, "a", "b", "c", "d", "e") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, digest string, size long, n string, at string, shard string, k_ string, `a.b` string")
    got = sharding.minimax_shards(df, 4, "doc_id", "digest", "size")
    assert got.columns == [*df.columns, "shard_", "slot"] and got.count() == 40
    assert {(r.n, r.at, r.shard, r.k_) for r in got.collect()} == {("a", "b", "c", "d")}


def test_stages_keep_odd_columns(spark):
    import corpus_pipeline
    rng = random.Random(6)
    base = [" ".join(f"w{rng.randrange(400)}" for _ in range(60)) for _ in range(8)]
    rows = [(i, t, "en", "s", len(t), "x", "y", "z") for i, t in enumerate(base + base[:2])] + [(90, None, None, None, None, "x", "y", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, `a.b` string, cid string, n string")
    for name, stage in corpus_pipeline.STAGES[1:3]:
        out = stage(spark, df, "/root/testdata/sf0.001")
        assert out.columns == df.columns and {r["a.b"] for r in out.collect()} == {"x"}, name
    kept = corpus_pipeline.STAGES[0][1](spark, df, "/root/testdata/sf0.001")
    assert kept.columns == df.columns
    kept.collect()


def test_payloads_with_many_copies_are_revisits(spark):
    """Payloads met by broadcast, by join, and those that occur once."""
    from starloom.llm import warc
    from starloom.session import scratch_path
    hot, pair, once = "h" * 2000, "p" * 1500, "o" * 1200
    pages = [(i, "u", hot) for i in range(150)] + [(200, "u", pair), (201, "u", pair), (202, "u", once), (203, "u", "s"), (204, "u", "s")]
    path = scratch_path(spark, "warc-hot")
    warc.write_warc(table(spark, pages, "page_id long, url string, html string"), path)
    got = {int(r.key): (r.record_type, r.refers_to and int(r.refers_to)) for r in warc.read_warc(spark, path).collect()}
    want = {i: ("revisit", 149) for i in range(149)} | {149: ("response", None), 200: ("revisit", 201)}
    assert got == want | {i: ("response", None) for i in (201, 202, 203, 204)}
