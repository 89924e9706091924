"""The registered queries of the text operators: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm import (debruijn, filter_audit, license_scan, line_crf, mixing, rans_output, simhash_dedup, spelling,
                           suffix_repeats, token_counts, vector_topk, warc, winnow)
from riskframe.llm.common import table
from riskframe.llm.license_rules import SIDE, STRENGTH, rules

TOKEN_LIMIT = 4_096
GOOD = 0.7


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(tokenizer_path("piece_bpe_32k.model"), "rb") as f:
        counts = token_counts.token_counts(table(spark, sf_dir, "documents"), f.read())
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), width=4, max_bits=4)


def op3_vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_topk.top_k(table(spark, sf_dir, "embeddings"), F.expr("id % 20 = 0"), k=20, scale=64)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_repeats.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def usable():
    """Rows that labels may be learnt from."""
    return F.crc32(F.col("doc_id").cast("string")) % 4 != 2


def op7_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = line_crf.train(docs, table(spark, sf_dir, "labels"), usable())
    return line_crf.quality_scores(docs, model).select(
        "doc_id", F.coalesce(~usable(), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= GOOD).cast("int").alias("predicted"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return debruijn.remove_repeated_windows(table(spark, sf_dir, "documents")).drop("kept")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def word_tokenizer() -> str:
    with open(tokenizer_path("word_bpe_49k.json"), encoding="utf-8") as f:
        return f.read()


def op10_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rans_output.token_files(table(spark, sf_dir, "documents"), word_tokenizer())


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_labels(table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _license_sql() -> str:
    """The licence scan in SQL: windows around the anchors, rules by anchor and keyword, the two ways to drop a detection."""
    text = lambda x: "'" + x.replace("'", "''") + "'"
    values = ",\n".join(f"({rank},{tier},{text(label)},{text(anchor)},{text(keyword)},{text(pattern)})"
                        for rank, tier, label, anchor, keyword, pattern in rules())
    low = f"translate(t, {text(winnow.UPPER)}, {text(winnow.LOWER)})"
    spaces = lambda x: f"(length({x}) - length(replace({x}, ' ', '')))"
    return f"""
WITH rules(rule, tier, label, anchor, keyword, pattern) AS (VALUES
{values}),
phrases(words, label) AS (VALUES (['mit', 'license'], 'mit'), (['apache', 'license'], 'apache'),
                                 (['general', 'public', 'license'], 'gpl')),
d AS (SELECT row_number() OVER () AS k, doc_id, list_filter(string_split_regex({low}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'),
        lambda x: x <> '') AS w FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)),
x AS (SELECT k, w, unnest(range(len(w))) AS i FROM d),
b AS (SELECT k, i, label FROM x JOIN phrases ON w[i + 1:i + len(words)] = words),
a AS (SELECT k, i, w[i + 1] AS anchor, greatest(i - {SIDE}, 0) AS start,
             ' ' || array_to_string(w[greatest(i - {SIDE}, 0) + 1:i], ' ') || CASE WHEN i > 0 THEN ' ' ELSE '' END || '@'
             || array_to_string(w[i + 1:i + {SIDE} + 1], ' ') || ' ' AS win
      FROM x WHERE w[i + 1] IN (SELECT anchor FROM rules)),
m AS (SELECT k, start, win, tier, rule, label, regexp_extract(win, pattern, 0) AS m
      FROM a JOIN rules USING (anchor) WHERE contains(win, keyword)),
f AS (SELECT k, tier, rule, label, start + {spaces("substring(win, 1, instr(win, m) - 1)")} AS first, {spaces("m")} AS n
      FROM m WHERE m <> ''),
e AS (SELECT k, tier, rule, label, first, first + n - 2 AS last FROM f),
s AS (SELECT * FROM e WHERE NOT EXISTS (FROM e o WHERE o.k = e.k AND (
        (o.tier <= e.tier AND o.first <= e.first AND o.last >= e.last
           AND (o.first, o.last, o.tier, o.rule) <> (e.first, e.last, e.tier, e.rule)
           AND ((o.first, o.last) <> (e.first, e.last) OR o.tier < e.tier OR o.rule < e.rule))
        OR (o.tier < e.tier AND (e.first BETWEEN o.first AND o.last OR e.last BETWEEN o.first AND o.last))))),
bb AS (SELECT k, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, list(label) AS base FROM b GROUP BY k),
ss AS (SELECT k, count(*) AS n, list(label) AS named, min(tier) AS best FROM s GROUP BY k)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, array_to_string(list_sort(list_distinct(coalesce(base, []))), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []), coalesce(named, [])))), ',') AS labels,
       greatest(coalesce({list(STRENGTH)}[best + 1], 0), CASE WHEN n_base > 0 THEN {STRENGTH[license_scan.NAME_TIER]} ELSE 0 END)::DOUBLE
         AS score, coalesce(n, 0)::BIGINT AS n_detections
FROM d LEFT JOIN bb USING (k) LEFT JOIN ss USING (k)"""


ORACLE_SQL = {
    "op11_license_scan": _license_sql(),
    "op13_filter_audit": """
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
             list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
l AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
      FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
f AS (SELECT part, d.doc_id, (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
             + 4 * (100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 3 * length(t))::INT
             + 8 * regexp_matches(t, '[#$%&*|]')::INT
             + 16 * coalesce(d.doc_id IS NULL OR d.doc_id > min(d.doc_id) OVER (PARTITION BY t), false)::INT
             - 16 * (d.doc_id IS NULL AND min(d.doc_id) OVER (PARTITION BY t) IS NULL)::INT AS m
      FROM d),
c AS (SELECT part, m, count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (toxic) AS x
      FROM f LEFT JOIN l ON f.doc_id = l.doc_id GROUP BY part, m),
t(l) AS (VALUES (0), (1), (2), (3), (4)),
o AS (SELECT [a.l, b.l, c.l, d.l, e.l] AS p FROM t a, t b, t c, t d, t e
      WHERE (1 << a.l) + (1 << b.l) + (1 << c.l) + (1 << d.l) + (1 << e.l) = 31
        AND len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
s AS (SELECT array_to_string(list_transform(p, lambda i: 'ABCDE'[i + 1]), '') AS filter_order, unnest(range(1, 6)) AS step, p FROM o),
q AS (SELECT filter_order, step, 1 << p[step] AS own,
             list_sum(list_transform(p[1:step], lambda i: 1 << i)) - (1 << p[step]) AS before FROM s),
r AS (SELECT part, filter_order, step, own,
        coalesce(sum(n) FILTER (m & (before + own)::INT = 0), 0) AS kept, coalesce(sum(n) FILTER (m & before::INT = 0 AND m & own <> 0), 0) AS removed,
        coalesce(sum(n) FILTER (m & before::INT <> 0 AND m & own <> 0), 0) AS redundant, coalesce(sum(n) FILTER (m = own), 0) AS unique_fails,
        coalesce(sum(g) FILTER (m & before::INT = 0 AND m & own <> 0), 0) AS good_lost,
        coalesce(sum(x) FILTER (m & before::INT = 0 AND m & own <> 0), 0) AS toxic_lost
      FROM c, q GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM r""",
    "op3_vector_topk": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS q FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id AND a.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""",
    "op4_warc": """
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
           FROM pages),
f AS (SELECT payload_digest, min(page_id) AS head FROM p WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN head <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN head <> page_id THEN head END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)""",
    "op9_mixing": """
WITH d AS (SELECT doc_id, source, len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> ''))::BIGINT
             AS size, md5(coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS n FROM d GROUP BY source),
w AS (SELECT *, [5.0, 2.0, 1.0][n % 3 + 1]::DOUBLE AS weight, 2.0::DOUBLE * source_size AS cap FROM s),
r AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, n
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                / sum(weight) OVER (ORDER BY cap / weight, n ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate FROM w),
l AS (SELECT rate FROM r WHERE rate * weight <= cap ORDER BY cap / weight, n LIMIT 1),
t AS (SELECT source, source_size, least(cap, coalesce((SELECT rate FROM l), 0) * weight) AS target FROM r),
o AS (SELECT d.*, source_size, target, floor(target)::BIGINT AS goal,
             coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id NULLS FIRST
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CASE WHEN source_size = 0 THEN 0
            ELSE goal // source_size * size + greatest(least(pos + size, goal % source_size) - pos, 0) END::BIGINT AS taken
FROM o""",
}

QUERIES = {f.__name__: f for f in (
    op1_token_counts, op2_simhash_dedup, op3_vector_topk, op4_warc, op5_decontamination, op6_suffix_dedup,
    op7_quality_crf, op8_substring_dedup, op9_mixing, op10_token_output, op11_license_scan,
    op12_spelling_variants, op13_filter_audit)}
