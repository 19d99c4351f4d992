import corpus_pipeline
from pyspark.sql import functions as F


def test_stages_keep_the_columns_and_take_effect(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60).cache()
    more = spark.createDataFrame([
        (9001, "word " * 30 + "token = \"" + "0a1b" * 10 + "\" end", "en", "src0", 1),
        (9001, "word " * 30 + "token = \"" + "0a1b" * 10 + "\" end", "en", "src0", 1),
        (9002, "Word " * 30 + "token = \"" + "0a1b" * 10 + "\" end", "en", None, 1),
        (None, None, None, None, None)], docs.schema)
    docs = docs.unionByName(more).withColumn("row", F.lit("clash"))
    kept = docs
    counts = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, kept, sf_dir).cache()
        counts[name] = out.count()
        if name != "pack_sequences":
            assert out.columns == docs.columns
            kept = out
        if name == "drop_near_duplicates":
            ids = [r.doc_id for r in out.select("doc_id").collect()]
            assert ids.count(9001) == 1 and 9002 not in ids
        if name == "mask_secrets":
            row = out.where("doc_id = 9001").first()
            assert row.text == "word " * 30 + "[SECRET]\" end" and row.n_chars == len(row.text)
    assert counts["drop_toxic"] < docs.count()
    assert counts["drop_near_duplicates"] == counts["mask_secrets"]
    placed = out.select("sequence_id", "offset").distinct().count()
    assert placed == counts["pack_sequences"] >= counts["mix_sources"]


def test_empty_documents(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.count() == 0


def test_run_on_whole_tables(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 0 and "sequence_id" in out.columns
