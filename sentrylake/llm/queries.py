"""The registered queries of this folder: one for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentrylake.llm import (
    forest, licenses, lm_scoring, mixing, packing, periodic_runs, repeats, secrets, simhash, spelling, toxicity, url_filters,
    vector_dedup)
from sentrylake.llm.common import fold, table


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def count(kind: str):
        return F.size(F.filter("secrets.base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(secrets.spans_text(F.col("secrets.base")), 256).alias("base_sha256"),
        secrets.spans_text(F.col("secrets.spans")).alias("spans"))


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken")


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_texts(table(spark, sf_dir, "documents"), fold("doc_id", 5, 1))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = toxicity.held_out()
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), ~out)
    scored = toxicity.score(docs.withColumn("held_out", out), model, out="score")
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op6_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.word_counts(table(spark, sf_dir, "documents"), change=spelling.with_dropped_letters)
    return spelling.spelling_variants(words.where("n >= 5"), ratio=5)


def op12_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = url_filters.rule_table(spark, url_filters.RULES)
    return url_filters.judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.with_repeated_tails(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic_runs.find_runs(docs).withColumn("best", periodic_runs.strongest(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    written = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(written, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


# Each operator's query, by number.
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scans": op1_secret_scans,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_toxicity": op3_toxicity,
    "op4_mix_sources": op4_mix_sources,
    "op5_nearest_neighbours": op5_nearest_neighbours,
    "op6_license_scans": op6_license_scans,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_embedding_near_dedup": op8_embedding_near_dedup,
    "op9_suffix_array_dedup": op9_suffix_array_dedup,
    "op10_simhash_near_dedup": op10_simhash_near_dedup,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_url_filters": op12_url_filters,
    "op13_periodic_runs": op13_periodic_runs,
}
ORACLES: dict[str, str] = {
    "op8_embedding_near_dedup": vector_dedup.oracle_sql(), "op12_url_filters": url_filters.oracle_sql(url_filters.RULES)}
