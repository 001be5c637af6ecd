"""The queries of the corpus operators over the given tables, and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclemart.llm import (
    bagminhash, bpe, decontaminate, filter_audit, gam, katz, lexical, line_dedup, sharding, srs, token_counts, url_rules, warc,
)
from cyclemart.llm.common import table

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def register(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return register


def queries() -> dict[str, QueryFn]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    """The tokenizer file that the token queries use; it is installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


# --- 1: approximate nearest neighbours -------------------------------------------------
@query("op1_srs_neighbours")
def op1_srs_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return srs.nearest(vectors, vectors.filter(F.col("vec_id") % 100 == 0), k=10)


# --- 2: LM scoring ----------------------------------------------------------------------
@query("op2_katz_scores")
def op2_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.train_and_score(table(spark, sf_dir, "documents"), katz.held_out("doc_id")).scores


# --- 3: BPE encoding and decoding ----------------------------------------------------
@query("op3_bpe")
def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(table(spark, sf_dir, "documents"), vocabulary_path())


# --- 4: sharding ----------------------------------------------------------------------
SHARDS = 8


@query("op4_jump_shards", f"""
WITH RECURSIVE crc_table AS (
  SELECT list(c ORDER BY b) AS t
  FROM (SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
        FROM range(256) r(b))
), crcs AS (
  SELECT doc_id, text, xor(list_reduce(list_prepend(4294967295::BIGINT,
           list_transform(range(octet_length(encode(coalesce(text, '')))), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
         lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32
  FROM (SELECT doc_id, text, hex(encode(coalesce(text, ''))) AS h FROM documents), crc_table
), hop(doc_id, size, text_crc32, n, state, shard, reach) AS (
  SELECT doc_id, size, text_crc32, n, state, -1::BIGINT, 0::BIGINT
  FROM (SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size, text_crc32,
               CASE WHEN doc_id < 0 THEN doc_id::HUGEINT + 18446744073709551616 ELSE coalesce(doc_id, 0)::HUGEINT END AS state
        FROM crcs), (VALUES ({SHARDS}), ({SHARDS + 1})) t(n)
  UNION ALL
  SELECT doc_id, size, text_crc32, n, next_state, reach,
         floor((reach + 1) * (2147483648.0::DOUBLE / ((next_state // 8589934592) + 1)::DOUBLE))::BIGINT
  FROM (SELECT *, (state * 2862933555777941757 + 1) % 18446744073709551616 AS next_state FROM hop WHERE reach < n)
), done AS (SELECT * FROM hop WHERE reach >= n)
SELECT a.doc_id, a.size, a.text_crc32, 'key' AS law, a.shard::INTEGER AS shard,
       row_number() OVER (PARTITION BY a.shard ORDER BY a.doc_id) - 1 AS slot, b.shard::INTEGER AS grown_shard
FROM done a JOIN done b ON a.doc_id = b.doc_id AND a.n = {SHARDS} AND b.n = {SHARDS + 1}
""")
def op4_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"), SHARDS)


# --- 5: line dedup ----------------------------------------------------------------------
@query("op5_line_dedup", r"""
WITH lines AS (SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
numbered AS (SELECT doc_id, p, regexp_replace(ls[p], '^\s+|\s+$', '', 'g') AS x FROM lines, unnest(range(1, len(ls) + 1)) u(p)),
ranked AS (SELECT doc_id, p, x, row_number() OVER (PARTITION BY doc_id ORDER BY p) - 1 AS r FROM numbered WHERE x <> ''),
runs AS (SELECT doc_id, r, x || chr(10) || lead(x, 1) OVER w || chr(10) || lead(x, 2) OVER w AS k
         FROM ranked WINDOW w AS (PARTITION BY doc_id ORDER BY r)),
seen AS (SELECT doc_id, r, first_value(doc_id) OVER w AS fd, first_value(r) OVER w AS fr
         FROM runs WHERE k IS NOT NULL WINDOW w AS (PARTITION BY k ORDER BY doc_id, r)),
gone AS (SELECT DISTINCT doc_id, unnest(range(CASE WHEN doc_id = fd THEN greatest(r, fr + 3) ELSE r END, r + 3)) AS r
         FROM seen WHERE NOT (doc_id = fd AND r = fr)),
lost AS (SELECT doc_id, list(p) AS ps FROM gone JOIN ranked USING (doc_id, r) GROUP BY doc_id)
SELECT doc_id, len(ls) AS n_lines, coalesce(len(ps), 0) AS n_removed,
       md5(CASE WHEN ps IS NULL THEN text ELSE array_to_string(list_filter(ls, lambda x, i: NOT list_contains(ps, i)), chr(10)) END) AS text_md5
FROM lines LEFT JOIN lost USING (doc_id)
""")
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lines = F.size(F.split(F.coalesce(F.col("text"), F.lit("")), "\n", -1))
    return line_dedup.dedup_lines(docs.withColumn("n_lines", lines)).select(
        "doc_id", "n_lines", F.size("removed_lines").alias("n_removed"), F.md5("text").alias("text_md5"))


# --- 6: benchmark decontamination -------------------------------------------------------
@query("op6_benchmark_leaks", r"""
WITH w AS (
  SELECT 'd' AS kind, doc_id AS id, list_filter(regexp_split_to_array(lower(text), '\s+'), lambda x: x <> '') AS ws FROM documents
  UNION ALL
  SELECT 'i', item_id, list_filter(regexp_split_to_array(lower(text), '\s+'), lambda x: x <> '') FROM benchmark
), s AS (
  SELECT DISTINCT kind, id, array_to_string(ws[i:i + 4], ' ') AS shingle FROM w, unnest(range(1, len(ws) - 3)) u(i)
), items AS (
  SELECT id AS item_id, shingle, count(*) OVER (PARTITION BY id) AS item_shingles FROM s WHERE kind = 'i'
)
SELECT id AS doc_id, item_id, item_shingles, count(*) AS shared, count(*) / item_shingles AS containment
FROM s JOIN items USING (shingle) WHERE kind = 'd'
GROUP BY id, item_id, item_shingles HAVING count(*) / item_shingles >= 0.8
""")
def op6_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("t").withColumnRenamed("k", "doc_id")


# --- 7: URL filters -------------------------------------------------------------------
#: Fixed values of the contract: host, path, verdict.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
_RULE_ROWS = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@query("op7_url_rules", f"""
WITH rules(r_host, r_path, verdict) AS (VALUES {_RULE_ROWS}),
cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), parsed AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
), ranked AS (
  SELECT p.page_id, p.host, p.path, r.r_host || r.r_path AS rule, r.verdict,
         row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.r_host || r.r_path) DESC, length(r.r_host) DESC) AS rn
  FROM parsed p LEFT JOIN rules r
    ON (p.host = r.r_host OR ends_with(p.host, '.' || r.r_host)) AND starts_with(p.path, r.r_path)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM ranked WHERE rn = 1
""")
def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql(f"SELECT * FROM VALUES {_RULE_ROWS} AS t(host, path, verdict)")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_rules.judge_urls(pages, rules).drop("url")


# --- 8: quality classifier --------------------------------------------------------------
ACCEPT = 0.7


@query("op8_gam_quality")
def op8_gam_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = gam.train(docs, table(spark, sf_dir, "labels"))
    return gam.score(docs, model).select(
        "doc_id", gam.held_out("doc_id").alias("held_out"), "score",
        F.when(F.col("score") >= ACCEPT, 1).otherwise(0).alias("predicted"))


# --- 9: WARC --------------------------------------------------------------------------
@query("op9_warc_archive", """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, html, sha1(html) AS h, octet_length(encode(html)) AS payload_bytes,
             min(page_id) OVER (PARTITION BY html) AS first_page FROM p)
SELECT page_id, payload_bytes,
       (SELECT string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                 ((('0x' || substr(h, (i // 4 * 5 + 1)::BIGINT, 5))::BIGINT >> ((3 - i % 4) * 5)::BIGINT) & 31)::BIGINT + 1, 1), '' ORDER BY i)
        FROM range(32) t(i)) AS payload_digest,
       CASE WHEN page_id = first_page THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_page THEN first_page END AS refers_to
FROM d
""")
def op9_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read_summary(warc.write_archive(table(spark, sf_dir, "pages")))


# --- 10: MinHash near-dedup -------------------------------------------------------------
@query("op10_bagminhash_classes", r"""
WITH RECURSIVE texts AS (
  SELECT text, min(doc_id) AS node, count(*) AS copies FROM documents GROUP BY text
), w AS (
  SELECT node, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                 '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS ws FROM texts
), s AS (
  SELECT node, array_to_string(ws[i:i + 4], ' ') AS shingle, count(*) AS n
  FROM w, unnest(range(1, len(ws) - 3)) u(i) GROUP BY ALL
), sizes AS (SELECT node, sum(n) AS total FROM s GROUP BY node),
shared AS (
  SELECT a.node AS x, b.node AS y, sum(least(a.n, b.n)) AS inter FROM s a JOIN s b ON a.shingle = b.shingle AND a.node < b.node GROUP BY ALL
), links AS (
  SELECT x, y FROM shared JOIN sizes p ON p.node = x JOIN sizes q ON q.node = y WHERE inter / (p.total + q.total - inter) >= 0.8
), reach(node, other) AS (
  SELECT node, node FROM texts
  UNION
  SELECT r.node, l.y FROM reach r JOIN (SELECT x, y FROM links UNION ALL SELECT y, x FROM links) l ON l.x = r.other
), classes AS (SELECT node, min(other) AS class_id FROM reach GROUP BY node)
SELECT doc_id, class_id, copies FROM documents JOIN texts USING (text) JOIN classes USING (node)
""")
def op10_bagminhash_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bagminhash.near_duplicates(table(spark, sf_dir, "documents")).drop("t")


# --- 11: ranked lexical search ------------------------------------------------------------
BEST = 50
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


@query("op11_lexical_search", f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{_TERM}') AS ts FROM documents
), tf AS (SELECT r, doc_id, term, count(*) AS tf FROM docs, unnest(ts) u(term) GROUP BY ALL),
sizes AS (SELECT r, sum(tf)::BIGINT AS n FROM tf GROUP BY r),
whole AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM sizes),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
wanted AS (
  SELECT DISTINCT item_id, term
  FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{_TERM}')) AS term FROM benchmark)
), scores AS (
  SELECT item_id, r, doc_id, sum(floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::BIGINT
           * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // terms))))::BIGINT AS score
  FROM wanted JOIN tf USING (term) JOIN df USING (term) JOIN sizes USING (r), whole
  GROUP BY ALL
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
WHERE rank <= {BEST}
""")
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), BEST)


# --- 12: filter interaction audit -----------------------------------------------------------
@query("op12_filter_audit", r"""
WITH m AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
), f AS (
  SELECT doc_id, part, [len(ws) < 100, 100 * len(list_distinct(ws)) < 80 * len(ws),
         100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text), regexp_matches(text, '[#$%&*|]'),
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)] AS fails FROM m
), marks AS (SELECT doc_id, max(quality) = 1 AS good, max(toxic) = 1 AS toxic FROM labels GROUP BY doc_id),
counts AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM f LEFT JOIN marks USING (doc_id) GROUP BY part, fails
), five AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM five a, five b, five c, five d, five e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), seen AS (
  SELECT part, filter_order, step, n, good, toxic, list_transform(string_split(filter_order, ''), lambda x: fails[ascii(x) - 64]) AS o,
         len(list_filter(fails, lambda x: x)) AS failed
  FROM counts, orders, unnest(range(1, 6)) s(step)
), steps AS (
  SELECT part, filter_order, step,
         sum(CASE WHEN NOT list_contains(o[1:step], true) THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN o[step] AND NOT list_contains(o[1:step - 1], true) THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN o[step] AND list_contains(o[1:step - 1], true) THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN o[step] AND failed = 1 THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN o[step] AND NOT list_contains(o[1:step - 1], true) THEN good ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN o[step] AND NOT list_contains(o[1:step - 1], true) THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM seen GROUP BY part, filter_order, step
)
SELECT part, filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, filter_order[step]))::BIGINT AS shapley
FROM steps
""")
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


# --- 13: token counts ---------------------------------------------------------------------
TOKEN_LIMIT = 2048


@query("op13_token_counts")
def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary_path("word_bpe_49k.json"))
    return token_counts.over_limit(counts, TOKEN_LIMIT)
