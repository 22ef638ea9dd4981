"""One query per operator over the given tables, and SQL for DuckDB where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rejoinder.llm import html_text, pii, projected_search, topk, toxicity
from rejoinder.llm.decontamination import find_items
from rejoinder.llm.filter_audit import audit_filters
from rejoinder.llm.line_dedup import line_report, repeated_lines
from rejoinder.llm.near_dedup import near_duplicates
from rejoinder.llm.packing import pack_documents
from rejoinder.llm.prefix_trie import conversation_trie
from rejoinder.llm.suffix_dedup import remove_repeats
from rejoinder.llm.token_counts import count_tokens

TOKEN_LIMIT = 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find_personal_data(docs, pii.train(docs))
    kinds = F.transform("base", lambda s: F.split_part(s, F.lit(":"), F.lit(1)))
    counts = [F.size(F.array_remove(kinds, kind)) for kind in pii.KINDS]
    counts = [(F.size("base") - n).cast("long").alias(f"n_{kind}") for kind, n in zip(pii.KINDS, counts)]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(F.array_join("base", ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join("spans", ",").alias("spans"),
    )


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.withColumn("kept", F.col("doc_id") == F.col("component_id"))


OP5_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(words) = 0 THEN []
    WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i : i + 4], ' ')) END) AS g
  FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), l AS (
  SELECT x, y FROM p JOIN n i ON i.doc_id = x JOIN n j ON j.doc_id = y WHERE 100 * c >= 75 * (i.n + j.n - c)
), e AS (
  SELECT x, y FROM l UNION SELECT y, x FROM l
), r AS (
  SELECT doc_id, doc_id AS reach FROM documents
  UNION
  SELECT r.doc_id, e.y FROM r JOIN e ON e.x = r.reach
), c AS (
  SELECT doc_id, min(reach) AS component_id FROM r GROUP BY doc_id
)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM c LEFT JOIN n USING (doc_id)
"""


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    report = line_report(docs, repeated_lines(docs))
    return report.select("doc_id", "n_lines", F.size("removed").alias("n_removed"), F.array_join("removed", ",").alias("removed"))


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.search(vectors, F.col("vec_id") % 50 == 0)


OP7_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    items = F.sort_array(F.array_distinct(F.flatten(F.collect_list("matches.item"))))
    held = found.groupBy("doc_id").agg(items.alias("items"))
    return held.select("doc_id", F.size("items").alias("n_items"), F.array_join(F.col("items").cast("array<string>"), ",").alias("items"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"))


OP11_SQL = r"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), o AS (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY pos) AS turns FROM t GROUP BY conv_id
), h AS (
  SELECT conv_id, turns, CAST(xor(list_reduce(
      list_transform(range(1, length(CAST(conv_id AS VARCHAR)) + 1), lambda i: CAST(ascii(substr(CAST(conv_id AS VARCHAR), i, 1)) AS BIGINT)),
      lambda c, b: list_reduce(range(8), lambda d, j: xor(d >> 1, 3988292384 * (d & 1)), xor(c, b)),
      4294967295), 4294967295) % 4 AS BIGINT) AS h
  FROM o
), r AS (
  SELECT h.conv_id, list_concat(coalesce(f.turns, [])[1 : h.h], h.turns[h.h + 1 :]) AS turns
  FROM h LEFT JOIN o f ON f.conv_id = h.conv_id - h.conv_id % 20
), p AS (
  SELECT conv_id, d AS depth, turns[1 : d] AS path, CASE WHEN d > 0 THEN turns[1 : d - 1] END AS above, d = len(turns) AS ends
  FROM r, (SELECT unnest(range(0, (SELECT max(len(turns)) + 1 FROM r))) AS d) WHERE d <= len(turns)
), n AS (
  SELECT path, depth, above, min(conv_id) AS conv_id, count(*) AS n_convs,
    CASE WHEN depth = 0 THEN 0 ELSE len(regexp_extract_all(path[depth].text, '[^\x20\x09-\x0D]+')) END AS words,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM p GROUP BY path, depth, above
), c AS (
  SELECT above AS path, count(*) AS n_children FROM n WHERE above IS NOT NULL GROUP BY above
), k AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN c USING (path)
), s AS (
  SELECT path[1 : d] AS path, sum((n_convs - 1) * words) AS saved_tokens, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves
  FROM k, (SELECT unnest(range(0, (SELECT max(depth) + 1 FROM n))) AS d) WHERE d <= depth GROUP BY 1
)
SELECT k.conv_id, k.depth, a.conv_id AS parent_conv_id, k.n_convs, k.n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves,
  CAST(s.saved_tokens AS BIGINT) AS saved_tokens, k.ends_sha256
FROM k JOIN s ON s.path = k.path LEFT JOIN n a ON a.path = k.above
"""


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP12_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
    min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least
  FROM documents
), l AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
), m AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(l.toxic, 0) AS toxic,
    CASE WHEN len(words) < 200 THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END
    + CASE WHEN 100 * len(regexp_extract_all(text, '[A-Z]')) > 2 * length(text) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN t.doc_id > least THEN 16 ELSE 0 END AS mask
  FROM t LEFT JOIN l USING (doc_id)
), c AS (
  SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, mask
), f AS (
  SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS v(name, bit)
), o AS (
  SELECT a.name || b.name || c.name || d.name || e.name AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM f a, f b, f c, f d, f e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5
), s AS (
  SELECT filter_order, step, bits[step] AS bit, CAST(coalesce(list_sum(bits[1 : step - 1]), 0) AS INTEGER) AS before
  FROM o, (SELECT unnest(range(1, 6)) AS step)
), r AS (
  SELECT part, filter_order, step, bit,
    sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & before <> 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM c, s GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM r
"""


def op13_projected_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projected_search.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_token_counts": op2_token_counts,
    "op3_personal_data": op3_personal_data,
    "op4_toxicity": op4_toxicity,
    "op5_near_dedup": op5_near_dedup,
    "op6_line_dedup": op6_line_dedup,
    "op7_topk": op7_topk,
    "op8_html_text": op8_html_text,
    "op9_packing": op9_packing,
    "op10_decontamination": op10_decontamination,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_filter_audit": op12_filter_audit,
    "op13_projected_search": op13_projected_search,
}

ORACLE_SQL: dict[str, str] = {
    "op5_near_dedup": OP5_SQL,
    "op7_topk": OP7_SQL,
    "op11_prefix_trie": OP11_SQL,
    "op12_filter_audit": OP12_SQL,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
