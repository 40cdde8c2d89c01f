"""One query per corpus operator, over its whole table, and what DuckDB should find."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from tidemark.llm import (
    bpe,
    centroids,
    covertree,
    language,
    license_scan,
    mixing,
    pii,
    quality,
    resampling,
    setsketch,
    suffix_dedup,
    topk,
    toxicity,
)
from tidemark.llm.common import held_out, table, tokenizer
from tidemark.llm.oracles import SQL

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    if fn.__name__ in SQL:
        ORACLES[fn.__name__] = SQL[fn.__name__]
    return fn


@query
def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, *tokenizer(), decoded="decoded")
    return coded.select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels")
    lexicon = toxicity.train(toxicity.sample(docs, labels, ~held_out(F.col("doc_id"))))
    return toxicity.assess(docs, lexicon).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "n_terms"
    )


@query
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = mixing.schedule(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        "taken",
        F.round(F.get("positions", F.lit(0)), 6).alias("first_position"),
    )


@query
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.judge(docs).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


@query
def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.train(docs, ~held_out(F.col("doc_id")))
    return language.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected"
    )


@query
def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op7_setsketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(table(spark, sf_dir, "documents"), words=2)


@query
def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.with_spans(pii.scan(table(spark, sf_dir, "documents")))
    count = lambda k: F.size(F.filter("base", lambda s: s["rank"] == k)).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{kind}") for k, kind in enumerate(pii.KINDS)],
        F.sha2(pii.spelled(F.col("base")), 256).alias("base_sha256"),
        pii.spelled(F.col("spans")).alias("spans"),
        (F.size("spans") - F.size("base")).cast("long").alias("n_added"),
    )


@query
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scanner = license_scan.train(spark, docs)
    return license_scan.scan(docs, scanner).select(
        "doc_id",
        F.size("verdicts").cast("long").alias("n_cue_paragraphs"),
        F.size(F.flatten(F.transform("verdicts", lambda v: v["families"]))).cast("long").alias("n_licences"),
        "family",
        F.array_join("families", ",").alias("families"),
    )


@query
def op11_covertree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = centroids.kept_vectors(table(spark, sf_dir, "embeddings"))
    found = centroids.fit(kept)
    return centroids.with_inertia(centroids.assign(kept, found), found)


@query
def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
