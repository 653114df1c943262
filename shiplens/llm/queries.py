"""The registered queries of these operators over the given tables, with production parameters."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiplens.llm import (
    bpe, decontaminate, exact_topk, html_text, merkle, near_dups, quality_model, ranked_search, run_index, secret_spans,
    token_files, toxicity, url_rules,
)
from shiplens.llm.rows import table

#: Fixed values of the token file query.
VOCABULARY, END_ID = "byte_bpe_50k.json", 2


@lru_cache(4)
def vocabulary_file(name: str = VOCABULARY) -> bytes:
    """A public tokenizer file's content, which travels with the tasks that need it."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as file:
        return file.read()


def op1_run_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_index.digest(run_index.remove_repeats(table(spark, sf_dir, "documents")))


def op2_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages"), url_rules.production_rules())


def op3_secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_spans.digest(secret_spans.scan(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op4_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)


def op5_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(table(spark, sf_dir, "documents"))


def op6_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that are selected, with their expected grade and tail probability."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    selected = quality_model.select(docs, table(spark, sf_dir, "labels"))
    return selected.select("doc_id", "expected_grade", "tail_probability", F.lit(True).alias("kept"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_files.files_of(table(spark, sf_dir, "documents"), vocabulary_file(), END_ID)
    return token_files.digests(spark, path)


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary_file())


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.with_repeats(table(spark, sf_dir, "pages"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.digest(merkle.prove(table(spark, sf_dir, "documents"), claim=merkle.tampered()))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.predictions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: Scores of whole numbers, for vectors of whole, finite components.
TOPK_SQL = """
WITH whole AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored
)
SELECT query_id, CAST(place AS INTEGER) AS "rank", vec_id, score FROM ranked WHERE place <= 5"""


def _pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    if root not in sys.path:
        sys.path.insert(0, root)
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_run_index, op2_url_rules, op3_secret_spans, op4_exact_topk, op5_near_dups, op6_quality_model,
        op7_token_files, op8_bpe, op9_decontaminate, op10_html_text,
        op11_merkle, op12_ranked_search, op13_toxicity,
    )
} | {"pipeline": _pipeline}
ORACLES = {"op2_url_rules": url_rules.judge_sql(), "op4_exact_topk": TOPK_SQL, "op11_merkle": merkle.digest_sql(),
           "op12_ranked_search": ranked_search.SEARCH_SQL}
