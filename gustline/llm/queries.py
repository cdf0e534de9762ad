"""The corpus queries, each on the whole of its given table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gustline.llm import (
    exact, language, mixing, order_minhash, packing, periodic, prefix_trie, secrets, simhash, token_counts, topk, toxicity, warc,
)
from gustline.llm.common import fold, held_out, table
from gustline.session import staged_path

TOKENIZER = "byte_bpe_50k.json"
TOKEN_LIMIT = 512


TOXIC_FROM = 0.3


def _learns(doc_id: Column) -> Column:
    """Rows that labels may be learned from."""
    return F.coalesce(fold(doc_id) != 2, F.lit(False))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(_learns(F.col("doc_id")))
    model = toxicity.fit(docs, labels)
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), toxicity.score(docs, model).alias("found"))
    return scored.select("doc_id", "held_out", "found.score", "found.windows").select(
        "doc_id", "held_out", "score", F.when(F.col("score") >= TOXIC_FROM, 1).otherwise(0).alias("predicted"), "windows"
    )


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    n = token_counts.count_tokens(docs, public_tokenizers.path(TOKENIZER))
    return docs.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        n.alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = staged_path(spark, "warc")
    warc.write_archive(table(spark, sf_dir, "pages"), archive)
    return warc.page_rows(warc.read_archive(spark, archive))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_apart(table(spark, sf_dir, "documents"))


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.learn(docs.where(_learns(F.col("doc_id"))))
    found = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), language.identify(docs, model).alias("found"))
    return found.select(
        "doc_id", "held_out", F.col("found.lang").alias("lang_pred"), "found.score", F.size("found.spans").alias("n_spans")
    )


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.digest(order_minhash.compare_edits(table(spark, sf_dir, "documents")))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    planted = periodic.with_planted_run(F.col("doc_id"), F.col("text"))
    return periodic.digest(docs.select("doc_id", periodic.periodic_runs(planted).alias("found")))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = prefix_trie.paths_of(table(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_trie(prefix_trie.rebuilt(paths))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_token_counts": op2_token_counts,
    "op3_secret_scan": op3_secret_scan,
    "op4_warc": op4_warc,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_source_mix": op6_source_mix,
    "op7_language": op7_language,
    "op8_top_k": op8_top_k,
    "op9_simhash": op9_simhash,
    "op10_order_minhash": op10_order_minhash,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_exact_dedup": op12_exact_dedup,
    "op13_prefix_trie": op13_prefix_trie,
}
