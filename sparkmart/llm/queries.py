"""One query for each operator: whole tables, production parameters.

``QUERIES`` maps a key to a function of (spark, sf_dir); ``SQL`` has the same
result for another engine where SQL can express it.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.llm import (align_tokens, bpe, decontaminate, exact_dedup, fill_middle, jaccard_groups,
                            link_trust, masked_lm, pii, quotes, rans, simhash, toxicity)
from sparkmart.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


#: Fixed by the task.
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
         ("allow", "com/fr/"), ("block", "com/de/")]


@_query
def op1_link_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = link_trust.verdicts(table(spark, sf_dir, "pages"), RULES)
    return found.select("page_id", "host", "path", "rule", "verdict")


@_query
def op2_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quotes.conversations(table(spark, sf_dir, "conversations"))
    return found.withColumn("text_sha256", F.sha2("own_text", 256)).drop("own_text")


@_query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query
def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


@_query
def op5_rans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rans.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


@_query
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@_query
def op7_masked_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masked_lm.pseudo_likelihood(table(spark, sf_dir, "documents"))


@_query
def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"),
                       public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                       public_tokenizers.PATTERN)


@_query
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


SQL["op9_exact_dedup"] = """
SELECT doc_id,
       max(doc_id) OVER w AS keep_id,
       count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW w AS (PARTITION BY coalesce(text, ''))
"""


@_query
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


#: Words of documents and items, the items' windows, and where they occur.
SQL_WINDOWS = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM {docs}),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + 12], ' ') AS t
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
occ AS (
  SELECT p.doc_id, p.i, p.n, win.item_id
  FROM (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS t
        FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
              FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)) p
  JOIN win ON win.n = p.n AND win.t = p.t),
hit AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM occ) GROUP BY doc_id),
its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM occ) GROUP BY doc_id)
"""

SQL["op10_decontamination"] = SQL_WINDOWS.format(docs="documents") + """
SELECT d.doc_id, len(d.w) AS n_words, coalesce(hit.n_hit, 0) AS n_hit, coalesce(its.n_items, 0) AS n_items,
       sha256(coalesce(its.ids, '')) AS items_sha256,
       coalesce(hit.n_hit, 0) > 0 AND 20 * coalesce(hit.n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN hit ON hit.doc_id = d.doc_id LEFT JOIN its ON its.doc_id = d.doc_id
"""


@_query
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokens.cross_align(table(spark, sf_dir, "documents"),
                                    public_tokenizers.path("byte_bpe_50k.json"),
                                    public_tokenizers.path("piece_bpe_32k.model"),
                                    public_tokenizers.PATTERN)


@_query
def op12_jaccard_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups.linked(table(spark, sf_dir, "documents"))


@_query
def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.fill_in_middle(table(spark, sf_dir, "documents"))
