"""The registered queries of this package: thin, with production parameters, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe_tree, conversations, divergence, fuzzy_lines, language, outliers, packing, page_text, simhash, token_counts, token_files, toxicity, winnowing
from tidemark.llm.shared import held_out, table
from tidemark.session import scratch_path

ORACLE: dict[str, str] = {}


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.groups(table(spark, sf_dir, "documents"), words_in_shingle=4)


def op2_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = outliers.judge(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    counted = token_counts.count_tokens(docs, public_tokenizers.path("word_bpe_49k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 2048)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack(packing.cut_documents(docs, public_tokenizers.path("byte_bpe_50k.json")))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs.where(~held_out(F.col("doc_id"))))
    return language.identify(docs, model, "doc_id", held_out(F.col("doc_id")).alias("held_out"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    weights = toxicity.train(docs.where(~held_out(F.col("doc_id"))), labels.where(~held_out(F.col("doc_id"))))
    scored = toxicity.score(docs, weights, "doc_id", held_out(F.col("doc_id")).alias("held_out"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op7_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = fuzzy_lines.remove_repeated(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "text", "n_lines", "n_removed")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return token_files.checked(spark, path)


def op9_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnowing.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_items = F.coalesce(F.size("items"), F.lit(0)).cast("long")
    listed = F.coalesce(F.array_join("items", ","), F.lit(""))
    return found.select("doc_id", "n_words", "n_hit", n_items.alias("n_items"), F.sha2(listed, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op10_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    found = page_text.main_texts(pages, page_text.train_on(pages), "page_id", "url")
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


def op11_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_tree.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), "doc_id")


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return conversations.repair(conversations.damage(rows), rows)


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
ORACLE["op9_winnowing"] = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
     i AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
     iw AS MATERIALIZED (
       SELECT DISTINCT item_id, array_to_string(w[s : s + least(10, len(w)) - 1], ' ') AS x, least(10, len(w)) AS n
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM i WHERE len(w) > 0)),
     lengths AS (SELECT DISTINCT n FROM iw),
     dw AS (SELECT r, n, s, array_to_string(w[s : s + n - 1], ' ') AS x
            FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d JOIN lengths ON len(w) >= n)),
     hit AS MATERIALIZED (SELECT r, s, dw.n, item_id FROM dw JOIN iw ON dw.x = iw.x AND dw.n = iw.n),
     covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT r, unnest(range(s, s + n)) AS p FROM hit) GROUP BY r),
     items AS (SELECT r, count(*) AS n_items, string_agg(t, ',' ORDER BY t) AS ids
               FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS t FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN items USING (r)
"""

ORACLE["op13_divergence"] = """
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
     w AS MATERIALIZED (SELECT r, lang, source, term, count(*) AS n
       FROM (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d) GROUP BY ALL),
     kept AS MATERIALIZED (SELECT lang, term FROM w GROUP BY lang, term HAVING count(*) >= 3),
     v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
     c AS MATERIALIZED (SELECT lang, source, term, sum(n) AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL),
     g AS MATERIALIZED (SELECT lang, source, coalesce(s, 0) AS s, coalesce(v, 0) AS v FROM (SELECT DISTINCT lang, source FROM d)
            LEFT JOIN (SELECT lang, source, sum(n) AS s FROM c GROUP BY ALL) USING (lang, source) LEFT JOIN v USING (lang)),
     p AS MATERIALIZED (SELECT lang, source, term, coalesce(n, 0) AS n, 1 + 1000000000 * (coalesce(n, 0)::HUGEINT + 1) // (s + v)::HUGEINT AS p
            FROM g JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)),
     l AS (SELECT lang, term, 1 + 1000000000 * (n::HUGEINT + 1) // (sum(n) OVER (PARTITION BY lang) + count(*) OVER (PARTITION BY lang))::HUGEINT AS q
            FROM (SELECT lang, term, sum(n) AS n FROM c GROUP BY lang, term)),
     pairs AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
               FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
     parts AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
               FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
               LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
               UNION ALL
               SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p JOIN l USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INT) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
WHERE part = 'pair' OR rank <= 200
"""

QUERIES = {f.__name__: f for f in (op1_simhash, op2_outliers, op3_token_counts, op4_packing, op5_language, op6_toxicity, op7_fuzzy_lines, op8_token_files, op9_winnowing, op10_page_text, op11_bpe_tree, op12_conversations, op13_divergence)}
