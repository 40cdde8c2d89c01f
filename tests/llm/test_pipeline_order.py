"""The training order of the mix can be read back from the pipeline's result."""

from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import mixing
from tidemark.llm.common import stored


def test_order_survives_writing_and_reading(spark):
    docs = spark.range(400).select(
        F.col("id").alias("doc_id"),
        F.concat_ws(" ", F.sequence(F.lit(0), F.col("id") % 7)).alias("text"),
        F.concat(F.lit("s"), (F.col("id") % 3).cast("string")).alias("source"),
    )
    places = mixing.schedule(docs).select("doc_id", F.explode("positions").alias("p")).collect()
    expected = [r.doc_id for r in sorted(places, key=lambda r: (r.p, r.doc_id))]
    mixed = stored(corpus_pipeline.mix_sources(spark, docs, ""), "mixed")
    mixed = spark.read.parquet(mixed.stored_at)
    out = stored(corpus_pipeline.encode_tokens(spark, mixed, ""), "coded")
    got = out.orderBy("shard", "shard_row").collect()
    assert len(expected) > 400 and [r.doc_id for r in got] == expected
    assert all(r.round_trip for r in got)


def test_rows_without_files_have_no_order(spark):
    docs = spark.createDataFrame([(1, "a b", 5)], "doc_id long, text string, shard int")
    row = corpus_pipeline.encode_tokens(spark, docs, "").first()
    assert row.shard is None and row.shard_row is None and row.round_trip
