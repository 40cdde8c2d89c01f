"""From raw documents to training tokens, stage by stage.

Each stage is a function (spark, docs, sf_dir) -> DataFrame over all that the
stage before kept; ``run`` writes every result and reads it back, so a stage
starts from files and survives lost executors. All stages but the last return the
columns of ``docs``.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import bpe, language, mixing, pii, setsketch
from tidemark.llm.common import held_out, stored, table, tokenizer


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents whose language the classifier rejects."""
    model = language.train(docs, ~held_out(F.col("doc_id")))
    # names of its own, so that columns of the input are never replaced
    text = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.col("text").alias("text"))
    return language.predict(text, model).filter(~F.col("rejected")).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates (five-word shingles, 0.8)."""
    return setsketch.deduplicate(docs, words=5).select(docs.columns)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind and counts the characters again."""
    out = pii.redact(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes documents by their sources' target weights, in training order."""
    return mixing.mix(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the packed token ids, their number, whether they decode to the text, and the order.

    The order is that of the mix: ``shard`` is the number of the file that holds the
    row, ``shard_row`` its place there. Both are NULL for rows that come from no file.
    """
    # one pass and one Python worker a core; the pass adds columns of its own names
    coded = bpe.encode(_in_file_order(docs), *tokenizer(), to="token_ids", decoded="_decoded")
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return coded.withColumns(
        {
            "n_tokens": (F.length("token_ids") / 4).cast("long"),
            "round_trip": F.col("_decoded") == text,
        }
    ).drop("_decoded")


def _in_file_order(docs: DataFrame) -> DataFrame:
    """Adds where the sorted files hold a row; Spark itself reads files in any order."""
    number = F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1)
    order = {"shard": number.try_cast("int"), "shard_row": F.col("_metadata.row_index")}
    try:
        return docs.withColumns(order)
    except AnalysisException:  # no files behind these rows
        nothing = F.lit(None)
        return docs.withColumns({"shard": nothing.cast("int"), "shard_row": nothing.cast("long")})


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("pii", redact_personal_data),
    ("mixing", mix_sources),
    ("bpe", encode_tokens),
]

# SQL can express neither the classifier nor the tokenizer; tests hold each stage
# against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
