"""The queries of the operators, and DuckDB's version of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefeed.llm.embedding_dedup import near_duplicates
from tidefeed.llm.ngram_join import similar_documents
from tidefeed.llm.packing import pack_documents
from tidefeed.llm.pitman_yor import scored_texts
from tidefeed.llm.prefix_trie import restarted_trie
from tidefeed.llm.secret_scan import KINDS, secrets, written
from tidefeed.llm.sentencepiece_codec import round_trip
from tidefeed.llm.shared import table
from tidefeed.llm.source_audit import source_divergence
from tidefeed.llm.suffix_dedup import without_repeats
from tidefeed.llm.token_counts import line_tokens
from tidefeed.llm.topk_search import integers, top_k, whole_vectors
from tidefeed.llm.toxicity import toxicity
from tidefeed.llm.url_filters import filter_urls

#: (rule, verdict) of op1.
URL_RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "rule string, verdict string")
    judged = filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = similar_documents(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "n_links")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = without_repeats(table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("starts").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_tokens(table(spark, sf_dir, "documents"))


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets(table(spark, sf_dir, "documents"))
    counts = [
        F.size(F.filter("base.kind", lambda k: k == KINDS.index(name))).cast("long").alias(f"n_{name}")
        for name in ("assign", "access", "hex")
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(written("base").cast("binary"), 256).alias("base_sha256"),
        written("spans").alias("spans"),
    )


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whole_vectors(table(spark, sf_dir, "embeddings"), "embedding").where("vec_id IS NOT NULL")
    vectors = rows.select(F.col("vec_id").alias("id"), integers("embedding").alias("vector"))
    return top_k(vectors, vectors.where("id % 20 = 0"))


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each text's ids, as a digest, and the text that they decode to, as a digest."""
    rows = round_trip(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_ids"),
        F.crc32("ids").alias("ids_crc32"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6
    base = F.col("conv_id") - F.col("conv_id") % 100
    return restarted_trie(table(spark, sf_dir, "conversations"), start, 5, base)


def op12_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    held_out = F.crc32(number.cast("binary")) % 7 == 2
    return scored_texts(table(spark, sf_dir, "documents"), held_out)


def op13_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


def queries() -> dict:
    return {
        "op1_url_filters": op1_url_filters,
        "op2_ngram_jaccard": op2_ngram_jaccard,
        "op3_packing": op3_packing,
        "op4_toxicity": op4_toxicity,
        "op5_suffix_dedup": op5_suffix_dedup,
        "op6_token_counts": op6_token_counts,
        "op7_secret_scans": op7_secret_scans,
        "op8_exact_top_k": op8_exact_top_k,
        "op9_embedding_dedup": op9_embedding_dedup,
        "op10_sentencepiece": op10_sentencepiece,
        "op11_prefix_trie": op11_prefix_trie,
        "op12_lm_scoring": op12_lm_scoring,
        "op13_source_audit": op13_source_audit,
    }


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _op1_sql() -> str:
    rules = ", ".join(f"('{rule}', '{verdict}')" for rule, verdict in URL_RULES)
    return f"""
WITH rules AS (
    SELECT rule, verdict, split_part(rule, '/', 1) AS rule_host,
           rule[strpos(rule, '/'):] AS rule_path
    FROM (VALUES {rules}) AS t(rule, verdict)
), parts AS (
    SELECT page_id, row_number() OVER () AS nth,
           coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
                              '{_UPPER}', '{_LOWER}'), '') AS host,
           coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages
), best AS (
    SELECT nth, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
    FROM parts JOIN rules
      ON (host = rule_host OR host LIKE '%.' || rule_host) AND starts_with(path, rule_path)
    GROUP BY nth
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN best USING (nth)"""


_OP2_SQL = f"""
WITH RECURSIVE words AS (
    SELECT doc_id, [x for x in
        string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                           '[\\x20\\x09-\\x0D]+') if x <> ''] AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, unnest(
        CASE WHEN len(w) >= 5
             THEN [array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)]
             WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
    FROM words
), sizes AS (
    SELECT doc_id, count(s) AS n FROM words LEFT JOIN shingles USING (doc_id) GROUP BY doc_id
), common AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
    SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
    WHERE 100 * c >= 75 * (p.n + q.n - c)
), both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reach AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION
    SELECT reach.doc_id, both_ways.y FROM reach JOIN both_ways ON reach.other = both_ways.x
)
SELECT doc_id, any_value(n) AS n_shingles, min(other) AS component_id,
       coalesce(any_value(c), 0) AS n_links
FROM sizes JOIN reach USING (doc_id)
LEFT JOIN (SELECT x AS doc_id, count(*) AS c FROM both_ways GROUP BY x) USING (doc_id)
GROUP BY doc_id"""

_OP8_SQL = """
WITH v AS (
    SELECT vec_id, [floor(64 * CAST(x AS DOUBLE)) for x in embedding] AS x
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
           CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER)
              AS rank
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20"""

_OP11_SQL = """
WITH bytes AS (
    SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)
                ORDER BY i) AS crc
    FROM range(256) AS r(i)
), own AS (
    SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
                              coalesce(text, '')) AS i
    FROM conversations WHERE conv_id IS NOT NULL
), sizes AS (
    SELECT c, n, c - c % 100 AS b,
           xor(list_reduce(list_concat([4294967295::BIGINT],
                   [ascii(x)::BIGINT for x in string_split(c::VARCHAR, '')]),
                   lambda a, x: xor(crc[(xor(a, x) & 255) + 1], a >> 8)), 4294967295) % 6 AS h
    FROM (SELECT c, count(*) AS n FROM own GROUP BY c), bytes
), members AS (
    SELECT s.c, s.b, s.h, least(s.h, coalesce(t.n, 0)) AS taken,
           least(s.h, coalesce(t.n, 0)) + greatest(s.n - s.h, 0) AS turns
    FROM sizes s LEFT JOIN sizes t ON t.c = s.b
), rebuilt AS (
    SELECT m.c, i AS d, role, text FROM members m JOIN own ON own.c = m.b AND i <= taken
    UNION ALL
    SELECT m.c, i - h + taken, role, text FROM members m JOIN own ON own.c = m.c AND i > h
), paths AS (
    SELECT c, d, length(text) AS cp,
           sha256(string_agg(sha256(role) || sha256(text), '') OVER (PARTITION BY c ORDER BY d)) AS k
    FROM rebuilt
    UNION ALL
    SELECT c, 0, 0, '' FROM members
), nodes AS (
    SELECT k, any_value(d) AS d, min(c) AS c, count(*) AS n, (count(*) - 1) * any_value(cp) AS saved
    FROM paths GROUP BY k
), links AS (
    SELECT n.k, p.k AS parent FROM nodes n JOIN paths p ON p.c = n.c AND p.d = n.d - 1
), children AS (
    SELECT parent AS k, count(*) AS n_children FROM links GROUP BY parent
), totals AS (
    SELECT p.k, sum(CASE WHEN n_children IS NULL THEN 1 ELSE 0 END) AS leaves, sum(saved) AS saved
    FROM nodes n LEFT JOIN children x ON x.k = n.k JOIN paths p ON p.c = n.c AND p.d <= n.d
    GROUP BY p.k
), ends AS (
    SELECT k, string_agg(c::VARCHAR, ',' ORDER BY c) AS ids
    FROM paths JOIN members USING (c) WHERE d = turns GROUP BY k
)
SELECT n.c AS conv_id, n.d::BIGINT AS depth, up.c AS parent_conv_id, n.n::BIGINT AS n_convs,
       coalesce(n_children, 0)::BIGINT AS n_children, leaves::BIGINT AS n_leaves,
       totals.saved::BIGINT AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM nodes n JOIN totals USING (k) LEFT JOIN links l ON l.k = n.k LEFT JOIN nodes up ON up.k = l.parent
LEFT JOIN children x ON x.k = n.k LEFT JOIN ends e ON e.k = n.k"""

_OP13_SQL = f"""
WITH d AS (
    SELECT row_number() OVER () AS nth, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(coalesce(text, ''), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
    FROM documents
), t AS (
    SELECT nth, lang, source, translate(unnest(terms), '{_UPPER}', '{_LOWER}') AS term FROM d
), kept AS (
    SELECT lang, term FROM t GROUP BY ALL HAVING count(DISTINCT nth) >= 3
), sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang
), g AS (SELECT DISTINCT lang, source FROM d
), c AS (
    SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL
), counts AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0)::HUGEINT AS n, v
    FROM g JOIN kept k USING (lang) JOIN sizes USING (lang)
    LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), p AS (
    SELECT lang, source, term, n, 1 + (1000000000 * (n + 1))
           // (sum(n) OVER (PARTITION BY lang, source) + v)::HUGEINT AS p
    FROM counts
), q AS (
    SELECT lang, term, 1 + (1000000000 * (n + 1)) // (sum(n) OVER (PARTITION BY lang) + v)::HUGEINT AS q
    FROM (SELECT lang, term, sum(n)::HUGEINT AS n, any_value(v) AS v FROM counts GROUP BY ALL)
), sums AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), best AS (
    SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value
    FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER
              AS rank
    FROM (SELECT * FROM pairs UNION ALL SELECT * FROM best)
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 200"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_url_filters": _op1_sql(),
        "op2_ngram_jaccard": _OP2_SQL,
        "op8_exact_top_k": _OP8_SQL,
        "op11_prefix_trie": _OP11_SQL,
        "op13_source_audit": _OP13_SQL,
    }
