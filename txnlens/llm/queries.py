"""Queries of the operators over the given tables, and the SQL that checks those that SQL can express."""

from __future__ import annotations

from pyspark.sql import functions as F

from txnlens.llm import automaton, bpe, collocations, cotraining, html, packing, prefixtrie, repeats, rules, simhash
from txnlens.llm import toolcalls, topk, triebpe
from txnlens.llm.common import read_table

QUERIES: dict = {}
SQL: dict = {}


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def register(name: str, sql: str | None = None):
    def add(build):
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build
    return add


@register("op1_html_extraction")
def op1_html_extraction(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = html.extract(pages)
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


_OP2_SQL = """
WITH d AS (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS x, row_number() OVER () AS r FROM documents),
win AS (SELECT r, i, md5(substr(x, 2 * i + 1, 800)) AS h
        FROM (SELECT r, x, unnest(range(0, CAST(length(x) // 2 - 399 AS BIGINT))) AS i FROM d WHERE length(x) >= 800)),
hit AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY h) AS n FROM win) WHERE n > 1),
edge AS (SELECT r, i, CASE WHEN i - lag(i) OVER (PARTITION BY r ORDER BY i) <= 400 THEN 0 ELSE 1 END AS e FROM hit),
runs AS (SELECT r, min(i) AS a, max(i) + 400 AS b
         FROM (SELECT r, i, sum(e) OVER (PARTITION BY r ORDER BY i) AS g FROM edge) GROUP BY r, g),
lost AS (SELECT r, list(struct_pack(a := a, b := b) ORDER BY a) AS l, sum(b - a) AS n FROM runs GROUP BY r)
SELECT doc_id, CAST(length(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(len(l), 0) AS BIGINT) AS n_spans,
  sha256(unhex(CASE WHEN n IS NULL THEN x ELSE array_to_string(list_transform(range(0, len(l) + 1), lambda k:
    substr(x, CASE WHEN k = 0 THEN 1 ELSE 2 * l[k].b + 1 END, CASE WHEN k = len(l) THEN length(x)
    WHEN k = 0 THEN 2 * l[1].a ELSE 2 * (l[k + 1].a - l[k].b) END)), '') END)) AS kept_sha256
FROM d LEFT JOIN lost ON d.r = lost.r"""


@register("op2_suffix_dedup", _OP2_SQL)
def op2_suffix_dedup(spark, sf_dir):
    left = repeats.dedup(read_table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@register("op3_quality_classifier")
def op3_quality_classifier(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    model = cotraining.fit(docs, read_table(spark, sf_dir, "labels"))
    scored = cotraining.classify(docs, model)
    return scored.select("doc_id", "quality_.*", F.col("kept_").alias("kept"))


@register("op4_best_fit_packing")
def op4_best_fit_packing(spark, sf_dir):
    packed = packing.pack(read_table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), added=True)
    return packed.drop("ids")


_WORDS = "list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"
_OP6_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
win AS (SELECT doc_id, i, sha256(array_to_string(w[i:i + 49], ' ')) AS h
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
hit AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY h) AS f FROM win) WHERE f < doc_id),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM hit, (SELECT unnest(range(50)) AS k)),
lost AS (SELECT doc_id, list(i) AS l, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
  CASE WHEN n IS NULL THEN sha256(array_to_string(w, ' '))
       ELSE sha256(coalesce(array_to_string(list_filter(w, lambda x, i: NOT list_contains(l, i)), ' '), '')) END AS kept_sha256
FROM d LEFT JOIN lost ON d.doc_id = lost.doc_id"""


_OP5_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
           FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
        CAST(list_inner_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10"""


@register("op5_exact_top_k", _OP5_SQL)
def op5_exact_top_k(spark, sf_dir):
    return topk.top_k(read_table(spark, sf_dir, "embeddings"), lambda key: key % 100 == 0)


@register("op6_substring_dedup", _OP6_SQL)
def op6_substring_dedup(spark, sf_dir):
    left = automaton.dedup(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select("doc_id", "dedup_.n_words", "dedup_.n_removed", F.sha2("dedup_.kept", 256).alias("kept_sha256"))


@register("op7_quality_rules")
def op7_quality_rules(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    field = rules.fit_field(docs, read_table(spark, sf_dir, "labels"))
    return rules.judge(docs, field).select("doc_id", "rules_.*")


@register("op8_byte_bpe")
def op8_byte_bpe(spark, sf_dir):
    shared = bpe.tables(spark, tokenizer_file("byte_bpe_multi_50k.tiktoken"))
    encoded = bpe.encode(read_table(spark, sf_dir, "documents"), shared)
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2(bpe.decode(shared)("ids"), 256).alias("decoded_sha256"))


_OP9_SQL = """
WITH calls AS (SELECT conv_id, turn, 't' || turn AS call_id, text, count(*) OVER (PARTITION BY conv_id, turn) AS n_calls
               FROM conversations WHERE role = 'user'),
results AS (SELECT conv_id, 't' || (turn - 1) AS call_id, min(text) AS content, count(*) AS n_results
            FROM conversations WHERE role = 'assistant' GROUP BY ALL),
known AS (SELECT DISTINCT conv_id, turn FROM calls)
SELECT c.conv_id, c.call_id, CAST(c.turn AS BIGINT) AS position, CAST(0 AS BIGINT) AS wave, false AS cyclic,
  CAST(n_calls AS BIGINT) AS n_calls, CAST(coalesce(n_results, 0) AS BIGINT) AS n_results,
  CAST(CASE WHEN c.turn >= 2 AND k.turn IS NULL THEN 1 ELSE 0 END AS BIGINT) AS missing_deps,
  coalesce(length(c.text) BETWEEN 1 AND 2000 AND c.turn >= 0, false) AS valid,
  sha256('{"arguments":{' || CASE WHEN c.text IS NULL THEN '' ELSE '"text":' || CAST(to_json(c.text) AS VARCHAR) || ',' END
    || '"turn":' || c.turn || '},"id":"' || c.call_id || '","name":"ask","result":' || coalesce(CAST(to_json(r.content) AS VARCHAR), 'null')
    || '}') AS message_sha256
FROM calls c LEFT JOIN results r ON c.conv_id = r.conv_id AND c.call_id = r.call_id
LEFT JOIN known k ON c.conv_id = k.conv_id AND k.turn = c.turn - 2"""


@register("op9_tool_call_linking", _OP9_SQL)
def op9_tool_call_linking(spark, sf_dir):
    calls, results = toolcalls.conversation_calls(read_table(spark, sf_dir, "conversations"))
    linked = toolcalls.link(calls, results, {"ask": toolcalls.ASK})
    return linked.select("conv_id", "call_id", "position", "wave", "cyclic", "n_calls", "n_results", "missing_deps", "valid",
                         F.sha2("message", 256).alias("message_sha256"))


@register("op10_simhash_near_dedup")
def op10_simhash_near_dedup(spark, sf_dir):
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hexadecimal("fp").alias("fingerprint"), "component_id")


_CRC = """xor(4294967295, list_reduce(list_concat([CAST(4294967295 AS BIGINT)],
  list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
  lambda c, b: list_reduce(list_concat([xor(c, b)], CAST(range(8) AS BIGINT[])),
    lambda v, k: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)))"""
_OP11_SQL = f"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
             PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS j
           FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 5 AS first, {_CRC} % 9 AS h FROM (SELECT DISTINCT conv_id FROM t)),
m AS (SELECT c.conv_id, first, h, count(t.j) AS m FROM c LEFT JOIN t ON t.conv_id = first AND t.j <= h GROUP BY ALL),
r AS (SELECT m.conv_id, t.j AS d, role, text FROM m JOIN t ON t.conv_id = first AND t.j <= h
      UNION ALL SELECT m.conv_id, m + t.j - h, role, text FROM m JOIN t ON t.conv_id = m.conv_id AND t.j > h),
p AS (SELECT conv_id, d, strlen(text) AS bytes, count(*) OVER (PARTITION BY conv_id) AS size,
        sha256(string_agg(sha256(role) || sha256(text), '') OVER (PARTITION BY conv_id ORDER BY d)) AS node FROM r
      UNION ALL SELECT c.conv_id, 0, 0, (SELECT count(*) FROM r WHERE r.conv_id = c.conv_id), '' FROM c),
n AS (SELECT node, min(conv_id) AS conv_id, min(d) AS d, count(*) AS n_convs, (count(*) - 1) * min(bytes) AS saved,
        sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE d = size), '')) AS ends
      FROM p GROUP BY node),
e AS (SELECT n.node, a.node AS parent, b.conv_id AS parent_conv FROM n JOIN p a ON a.conv_id = n.conv_id AND a.d = n.d - 1
      JOIN n b ON b.node = a.node),
k AS (SELECT parent AS node, count(*) AS n_children FROM e GROUP BY parent),
u AS (SELECT a.node, count(*) FILTER (WHERE k.node IS NULL) AS n_leaves, sum(saved) AS saved
      FROM n JOIN p a ON a.conv_id = n.conv_id AND a.d <= n.d LEFT JOIN k ON k.node = n.node GROUP BY a.node)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, e.parent_conv AS parent_conv_id, CAST(n.n_convs AS BIGINT) AS n_convs,
  CAST(coalesce(k.n_children, 0) AS BIGINT) AS n_children, CAST(u.n_leaves AS BIGINT) AS n_leaves,
  CAST(u.saved AS BIGINT) AS saved_tokens, n.ends AS ends_sha256
FROM n JOIN u ON u.node = n.node LEFT JOIN e ON e.node = n.node LEFT JOIN k ON k.node = n.node"""


@register("op11_conversation_prefix_trie", _OP11_SQL)
def op11_conversation_prefix_trie(spark, sf_dir):
    return prefixtrie.prefix_trie(read_table(spark, sf_dir, "conversations"))


@register("op12_prefix_trie_bpe")
def op12_prefix_trie_bpe(spark, sf_dir):
    shared = triebpe.tables(spark, tokenizer_file("byte_bpe_50k.json"))
    encoded = triebpe.encode(read_table(spark, sf_dir, "documents"), shared, round_trip=True)
    return encoded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


_OP13_SQL = """
WITH d AS (SELECT coalesce(lang, 'und') AS lang,
             string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[.,;:!?\x0A-\x0D]') AS pieces FROM documents),
p AS (SELECT lang, list_filter(string_split_regex(unnest(pieces), '[\x20\x09]+'), lambda w: w <> '') AS w FROM d),
f AS (SELECT lang, w[i:i + k - 1] AS g, k, count(*) AS n
      FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, (SELECT unnest(range(1, 5)) AS k)) GROUP BY ALL),
total AS (SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE n >= 30),
cut AS (SELECT a.lang, a.g, a.n AS a, l.n AS l, r.n AS r,
          CAST((CAST(2000000 AS HUGEINT) * a.n) // (CAST(l.n AS HUGEINT) + r.n) AS BIGINT) AS score, x
        FROM (SELECT *, unnest(range(1, k)) AS x FROM c WHERE k > 1) a
        JOIN c l ON l.lang = a.lang AND l.g = a.g[1:x] JOIN c r ON r.lang = a.lang AND r.g = a.g[x + 1:a.k]),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, x) AS o FROM cut) WHERE o = 1),
inside AS (SELECT DISTINCT s.lang, s.g FROM
             (SELECT lang, k, n, g, unnest(range(2, k)) AS m FROM c WHERE k > 2) b,
             LATERAL (SELECT unnest(range(1, b.k - b.m + 2)) AS i) t JOIN c s ON s.lang = b.lang AND s.g = b.g[i:i + b.m - 1]
             AND CAST(100 AS HUGEINT) * b.n >= CAST(80 AS HUGEINT) * s.n),
kept AS (SELECT b.lang, array_to_string(b.g, ' ') AS phrase, a, l, r, total.n, score
         FROM best b JOIN total ON total.lang = b.lang
         WHERE NOT EXISTS (SELECT 1 FROM inside i WHERE i.lang = b.lang AND i.g = b.g))
SELECT * FROM (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank,
                 phrase, a, l, r, n, score FROM kept) WHERE rank <= 2000"""


@register("op13_phrase_collocations", _OP13_SQL)
def op13_phrase_collocations(spark, sf_dir):
    return collocations.collocations(read_table(spark, sf_dir, "documents"))
