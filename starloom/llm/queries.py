"""The registered queries of the operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import conversations, divergence, imatch, lattice, near_dup, ngram_join, packing, quality, sharding, substrings, token_counts, topk, warc
from starloom.llm.common import ship
from starloom.sources.driver import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

BYTE_BPE, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
OVER_LIMIT = 512


def query(name: str):
    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(ship(spark), sf_dir)
        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        return fn
    return deco


@query("op1_warc")
def _warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to an archive and read back."""
    back = warc.round_trip(read_table(spark, sf_dir, "pages"))
    return back.select(F.col("key").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"),
                       "record_type", "refers_to")


ORACLE["op1_warc"] = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
           FROM pages),
m AS (SELECT payload_digest, max(page_id) AS top FROM p GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {warc.MIN_REVISIT} AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {warc.MIN_REVISIT} AND page_id <> top THEN top END AS refers_to
FROM p JOIN m USING (payload_digest)"""


@query("op2_token_counts")
def _token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole document."""
    counts = token_counts.token_counts(read_table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))
    return counts.select(F.col("key").alias("doc_id"), "n_bytes", "n_tokens",
                         (F.col("n_tokens") > OVER_LIMIT).alias("over_limit"))


@query("op4_packing")
def _packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids in sequences of at most 1024 tokens."""
    docs = read_table(spark, sf_dir, "documents")
    pieces = packing.token_pieces(docs, public_tokenizers.path(BYTE_BPE))
    pieces = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(pieces, docs.count()).select(
        F.col("key").alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query("op7_imatch")
def _imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document, of its edited text and of the next document."""
    docs = read_table(spark, sf_dir, "documents")
    lexicon = imatch.fit_lexicon(docs)
    rows = imatch.successors(docs).withColumn("n_chars", F.char_length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    kept = F.col("text").substr(F.lit(1), (F.col("n_chars") - half).cast("int"))
    rows = rows.withColumn("edited", F.concat(kept, F.col("next_text").substr(F.lit(1), half)))
    rows = rows.withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))
    made = imatch.fingerprints(rows, lexicon, ["text", "edited", "next_text"],
                               near={"near_edited": ("text", "edited"), "near_next": ("text", "next_text")})
    return made.select(F.col("key").alias("doc_id"), "n_chars", "edited_sha256", F.col("text").alias("fingerprint"),
                       F.col("edited").alias("edited_fingerprint"), "near_edited", "near_next")


SHARDS = 16


@query("op8_sharding")
def _sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of nearly equal bytes, equal texts together."""
    text = F.coalesce("text", F.lit(""))
    rows = read_table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.md5(text.cast("binary")).alias("digest"))
    sharded = sharding.minimax_shards(rows, SHARDS, key="doc_id", group="digest", size="size")
    return sharded.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                          F.lit(None).cast("int").alias("grown_shard"))


TOP_K, QUERY_EVERY = 20, 20


@query("op3_topk_search")
def _topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best of all vectors for every 20th vector."""
    index = topk.quantised(read_table(spark, sf_dir, "embeddings"))
    return topk.top_k(index, F.col("id") % QUERY_EVERY == 0, TOP_K)


ORACLE["op3_topk_search"] = f"""
WITH v AS (SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum([p[1] * p[2] FOR p IN list_zip(q.v, c.v)]) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % {QUERY_EVERY} = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {TOP_K}"""


@query("op5_substring_dedup")
def _substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the 13-word windows that a smaller doc_id has."""
    kept = substrings.remove_repeats(read_table(spark, sf_dir, "documents"), keep=["doc_id"])
    removed = F.aggregate("spans_", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return kept.select("doc_id", F.col("n_words_").alias("n_words"), removed.alias("n_removed"),
                       F.sha2(F.col("kept_text_").cast("binary"), 256).alias("kept_sha256"))


ORACLE["op5_substring_dedup"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
i AS (SELECT doc_id, unnest(range(1, len(w) - 11)) AS i, w FROM d WHERE len(w) >= 13),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g FROM i),
f AS (SELECT g, min(doc_id) AS first FROM g GROUP BY 1),
r AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM g JOIN f USING (g) WHERE first < doc_id),
p AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS word FROM d),
k AS (SELECT p.doc_id, count(r.p) AS n_removed, string_agg(word, ' ' ORDER BY p.p) FILTER (r.p IS NULL) AS kept
      FROM p LEFT JOIN r ON r.doc_id = p.doc_id AND r.p = p.p GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)"""


@query("op6_minhash_dedup")
def _minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents by 2-word shingles."""
    found = near_dup.near_duplicates(read_table(spark, sf_dir, "documents"), shingle_words=2, percent=80)
    return found.select(F.col("key").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), "kept")


ORACLE["op6_minhash_dedup"] = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) >= 2 THEN [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]
                               WHEN len(w) = 1 THEN w ELSE [] END) AS s FROM w)),
n AS (SELECT w.doc_id, count(s.s) AS n_shingles FROM w LEFT JOIN s ON s.doc_id = w.doc_id GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
      WHERE 100 * n >= 80 * (x.n_shingles + y.n_shingles - n)),
l AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
c(doc_id, r) AS (SELECT doc_id, doc_id FROM n UNION SELECT l.b, c.r FROM c JOIN l ON l.a = c.doc_id WHERE c.r < l.b)
SELECT n.doc_id, n_shingles, min(c.r) AS component_id, n.doc_id = min(c.r) AS kept FROM n JOIN c USING (doc_id) GROUP BY 1, 2"""


@query("op9_sentencepiece")
def _sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded to piece ids and decoded again."""
    path = public_tokenizers.path(PIECES)
    back = lattice.round_trip(lattice.large_tasks(read_table(spark, sf_dir, "documents")), path)
    return back.select(F.col("key").alias("doc_id"), (F.octet_length("ids") / 4).cast("long").alias("n_pieces"),
                       F.crc32("ids").alias("ids_crc32"), F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


@query("op10_quality")
def _quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = read_table(spark, sf_dir, "documents")
    model = quality.train(docs, read_table(spark, sf_dir, "labels"))
    scored = quality.score(docs, model, keep=["doc_id"])
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), F.col("score_").alias("score"),
                         F.when(F.col("score_") >= quality.THRESHOLD, 1).otherwise(0).alias("predicted"))


@query("op11_divergence")
def _divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources of every language against each other and against the language."""
    return divergence.audit(read_table(spark, sf_dir, "documents"))


ORACLE["op11_divergence"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT lang, source, r, unnest(w) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM t GROUP BY 1, 2 HAVING count(DISTINCT r) >= 3),
l AS (SELECT lang, count(*) AS v, sum(n) AS n FROM k GROUP BY 1),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN k USING (lang, term) GROUP BY 1, 2, 3),
m AS (SELECT lang, source, sum(n) AS n FROM c GROUP BY 1, 2),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS used,
             1 + 1000000000 * CAST(coalesce(c.n, 0) + 1 AS HUGEINT) // (coalesce(m.n, 0) + l.v) AS p,
             1 + 1000000000 * CAST(k.n + 1 AS HUGEINT) // (l.n + l.v) AS q
      FROM g JOIN k USING (lang) JOIN l USING (lang) LEFT JOIN m ON m.lang = g.lang AND m.source = g.source
      LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
s AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
o AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
      UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p WHERE used > 0 AND p > q),
r AS (SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
             CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM o)
SELECT * FROM r WHERE part = 'pair' OR rank <= 200"""


@query("op12_conversations")
def _conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation damaged, audited and repaired."""
    given = read_table(spark, sf_dir, "conversations")
    of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(of("conv_id"), F.lit(":"), of("turn")).cast("binary")) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.translate(of("text"), ".!?", "")).otherwise(of("text"))
    damaged = given.where(fault != 0).select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(of("role")).alias("role"), text.alias("text"),
        F.explode(F.when(fault == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"))
    rows = conversations.ordered(damaged)
    plans = conversations.repair_plans(rows)
    hashed = conversations.digests(conversations.repaired(rows, plans))
    every = given.groupBy("conv_id").agg(F.lit(1).alias("one")) \
        .select("conv_id", F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("ckey"))
    found = every.join(plans, "ckey", "left").join(hashed, "ckey", "left")
    longs = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return found.select("conv_id", *(F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in longs),
                        F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


ORACLE["op12_conversations"] = r"""
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t),
g AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
h AS (SELECT *, xor(list_reduce(list_transform(string_split(k, ''), lambda x: CAST(ord(x) AS BIGINT)),
                    lambda c, b: xor(t[CAST(xor(c, b) & 255 AS BIGINT) + 1], c >> 8), CAST(4294967295 AS BIGINT)), 4294967295) % 20 AS f
      FROM g, crc),
d AS (SELECT conv_id, turn, CASE f WHEN 4 THEN 'user' ELSE role END AS role,
             CASE f WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
             unnest(CASE f WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy FROM h),
o AS (SELECT *, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS z,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i,
             row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth FROM d),
q AS (SELECT *, CASE WHEN z = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN right(z, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
             substr(role, 1, 1) AS c, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM o),
n AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
             count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
             count(*) FILTER (fault = 'truncated') AS truncated,
             count(*) FILTER (i > 1 AND before || c NOT IN ('su', 'ua', 'au')) AS illegal FROM q GROUP BY 1),
m(f, c, t) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
ins(f, t, cost, edit) AS (VALUES (0, 0, 0, ''), (1, 1, 0, ''), (2, 2, 0, ''), (3, 3, 0, ''), (0, 2, 5, 'I'), (0, 3, 10, 'II'),
    (1, 2, 5, 'I'), (1, 3, 10, 'II'), (2, 3, 5, 'I'), (3, 2, 5, 'I')),
e AS (SELECT q.conv_id, q.i, s.f, s.f AS t, 2 AS cost, 'D' AS edit FROM q, (SELECT DISTINCT f FROM ins) s
      UNION ALL SELECT conv_id, i, m.f, m.t, CASE fault WHEN 'truncated' THEN 5 ELSE 0 END, 'K' FROM q JOIN m ON m.c = q.c WHERE fault IN ('', 'truncated')
      UNION ALL SELECT conv_id, i, m.f, m.t, CASE fault WHEN 'truncated' THEN 6 ELSE 1 END, 'R' FROM q, m WHERE fault IN ('', 'truncated') AND m.c <> 's'),
w AS (SELECT e.conv_id, e.i, ins.f, e.t, min({'cost': ins.cost + e.cost, 'edit': ins.edit || e.edit}) AS w
      FROM e JOIN ins ON ins.t = e.f GROUP BY 1, 2, 3, 4),
p(conv_id, i, s, best) AS (
    SELECT conv_id, CAST(0 AS BIGINT), 0, {'cost': 0, 'audit': ''} FROM n
    UNION ALL SELECT w.conv_id, w.i, w.t, min({'cost': p.best.cost + w.w.cost, 'audit': p.best.audit || w.w.edit})
    FROM p JOIN w ON w.conv_id IS NOT DISTINCT FROM p.conv_id AND w.i = p.i + 1 AND w.f = p.s GROUP BY 1, 2, 3),
b AS (SELECT n.conv_id, min({'cost': p.best.cost + ins.cost, 'audit': p.best.audit || ins.edit}) AS b
      FROM n JOIN p ON p.conv_id IS NOT DISTINCT FROM n.conv_id AND p.i = n.n JOIN ins ON ins.f = p.s AND ins.t IN (0, 3) GROUP BY 1),
x AS (SELECT conv_id, b.audit AS audit, unnest(string_split(b.audit, '')) AS edit, unnest(range(1, length(b.audit) + 1)) AS j FROM b WHERE b.audit <> ''),
y AS (SELECT *, count(*) FILTER (edit <> 'I') OVER u AS i, count(*) FILTER (edit <> 'D') OVER u - 1 AS place,
             length(replace(audit, 'D', '')) % 2 AS odd FROM x WINDOW u AS (PARTITION BY conv_id ORDER BY j)),
l AS (SELECT y.conv_id, y.j, CASE WHEN edit = 'K' THEN q.role WHEN (place + odd) % 2 = 0 THEN 'user' ELSE 'assistant' END || ':' ||
             CASE WHEN edit = 'I' THEN '' ELSE q.text END AS line
      FROM y LEFT JOIN q ON q.conv_id IS NOT DISTINCT FROM y.conv_id AND q.i = y.i WHERE edit <> 'D'),
r AS (SELECT conv_id, string_agg(line, chr(10) ORDER BY j) AS whole FROM l GROUP BY 1)
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(b.b.cost, 0) AS BIGINT) AS cost,
       coalesce(b.b.audit, '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN b ON b.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM a.conv_id"""


@query("op13_ngram_join")
def _ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents by 4-word shingles."""
    found = ngram_join.ngram_join(read_table(spark, sf_dir, "documents"), shingle_words=4, percent=85)
    return found.select(F.col("key").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))


ORACLE["op13_ngram_join"] = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) >= 4 THEN [array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)]
                               WHEN len(w) >= 1 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w)),
n AS (SELECT w.doc_id, count(s.s) AS n_shingles FROM w LEFT JOIN s ON s.doc_id = w.doc_id GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
      WHERE 100 * n >= 85 * (x.n_shingles + y.n_shingles - n)),
l AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
c(doc_id, r) AS (SELECT doc_id, doc_id FROM n UNION SELECT l.b, c.r FROM c JOIN l ON l.a = c.doc_id WHERE c.r < l.b)
SELECT n.doc_id, n_shingles, min(c.r) AS component_id FROM n JOIN c USING (doc_id) GROUP BY 1, 2"""
