"""The corpus pipeline: toxic documents go, near-duplicates go, secrets are masked, sources are mixed, the rest is packed.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; all but the last return the columns of ``documents``. ``run`` writes
each stage's rows to the shared folder and reads them for the next one.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentrylake.llm import mixing, packing, secrets, simhash, toxicity
from sentrylake.llm.common import cut, reachable, table


def _with_text(docs: DataFrame, text) -> DataFrame:
    """``docs`` with another text, and ``n_chars`` kept in step."""
    changed = docs.withColumn("text", text)
    return changed.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else changed


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out documents that score 0.5 or more. The model is trained on labelled rows that the split lets it use."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), ~toxicity.held_out())
    row = docs.select(F.struct("*").alias("row"), "text")
    scored = toxicity.score(row, model, out="score").where("score < 0.5")
    return scored.select("row.*")


def _named(docs: DataFrame) -> DataFrame:
    """Each row with its text and the key (no id, id, hash of the text) that tells it from other rows."""
    return docs.select(F.struct("*").alias("row"), "text", F.struct(
        F.col("doc_id").isNull().alias("no_id"), "doc_id", F.xxhash64("text").alias("hash")).alias("key"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class: the smallest id, rows without an id last. Of repeated rows one stays."""
    reachable(spark)
    named = _named(docs)
    found = simhash.near_duplicates(named, id_column="key")
    counts = found.groupBy("key", "component_id").agg(F.count("*").alias("n"))
    other = cut(counts.where((F.col("key") != F.col("component_id")) | (F.col("n") > 1)), "near-duplicates")
    single = named.join(other.select("key"), "key", "left_anti")
    repeated = other.where(F.col("key") == F.col("component_id")).select("key")
    one = named.join(repeated, "key", "left_semi").dropDuplicates(["key"])
    return single.select("row.*").unionByName(one.select("row.*"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret found in a text by a mark."""
    found = secrets.scan(docs.select(F.struct("*").alias("row"), "text"))
    masked = found.withColumn("clean", F.when(
        F.size("secrets.spans") > 0, secrets.redact(F.col("text"), F.col("secrets.spans"))).otherwise(F.col("text")))
    changed = _with_text(masked.select("row.*", F.col("clean").alias("_clean")), F.col("_clean"))
    return changed.drop("_clean").select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents so that the sources come near their targets."""
    mixed = mixing.mix(docs.select(F.struct("*").alias("row"), "doc_id", "text", "source"))
    copies = mixed.where("mix.epochs > 0").select("row", F.explode(F.expr("sequence(1L, mix.epochs)")))
    return copies.select("row.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places every piece of every document in a sequence of 1024 tokens."""
    reachable(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("drop_toxic", drop_toxic), ("drop_near_duplicates", drop_near_duplicates), ("mask_secrets", mask_secrets),
    ("mix_sources", mix_sources), ("pack_sequences", pack_sequences)]

ORACLE_SQL = None  # trained scores, fingerprints and token ids are not expressible in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
