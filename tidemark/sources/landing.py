"""Reading landed newline-delimited JSON, tolerant of bad lines and bad bytes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.clean import null_tokens as drop_tokens
from tidemark.sources.schemas import LANDING_FOLDERS, raw_schema

CORRUPT = "_corrupt_record"
NULL_TOKENS = ("NULL", "null", "")
PARTITIONS = ("year", "month", "day")


def parse_lines(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Fields of JSON lines (column ``value``), each as the text it was written in.

    A line that is no JSON object keeps its text in ``_corrupt_record``; bad
    bytes are replaced, not fatal; blank lines are skipped. Works on a batch and
    on a stream, and next to partition columns.
    """
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = (
        lines.withColumn("_source_file", F.col("_metadata.file_path"))
        .filter(F.trim("value") != "")
        .withColumn("_parsed", F.from_json("value", full, options))
    )
    unreadable = F.when(F.col("_parsed").isNull(), F.col("value"))
    others = [c for c in lines.columns if c != "value"]
    return parsed.select(
        *[F.col(f"_parsed.{f.name}") for f in schema.fields],
        *others,
        F.coalesce(F.col(f"_parsed.{CORRUPT}"), unreadable).alias(CORRUPT),
        "_source_file",
    )


def stamp_load(df: DataFrame, as_of: str | datetime | None = None) -> DataFrame:
    """Add the load time: one value per batch, now unless given."""
    loaded = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    return df.withColumn("_loaded_at", loaded)


def null_out(df: DataFrame, tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """Replace null spellings in every text column."""
    skip = {CORRUPT, "_source_file"}
    texts = [
        f.name
        for f in df.schema
        if isinstance(f.dataType, T.StringType) and f.name not in skip
    ]
    return df.withColumns({c: drop_tokens(F.col(c), tokens) for c in texts})


def project_text(df: DataFrame, json_col: str, columns: Sequence[str]) -> DataFrame:
    """Add the named fields of a JSON text column, each as the text it was written in."""
    fields = T.StructType([T.StructField(name, T.StringType()) for name in columns])
    parsed = df.withColumn("_parsed", F.from_json(F.col(json_col), fields))
    return parsed.withColumns({name: F.col(f"_parsed.{name}") for name in columns}).drop("_parsed")


def read_landing(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    null_tokens: Sequence[str] = NULL_TOKENS,
    as_of: str | datetime | None = None,
    only: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(good, bad) rows of the files below ``path``.

    Declared fields are read as text, exactly as written; others are ignored.
    ``only`` filters on the ``year / month / day`` folders, which skips files.
    Bad rows keep the unreadable line in ``_corrupt_record``.
    """
    lines = spark.read.text(path)
    if only is not None:
        lines = lines.filter(only)
    landed = null_out(stamp_load(parse_lines(lines, schema), as_of), null_tokens)
    good = landed.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    bad = landed.filter(F.col(CORRUPT).isNotNull()).select(
        "_source_file", "_loaded_at", CORRUPT
    )
    return good, bad


def read_entity(
    spark: SparkSession,
    root: str,
    entity: str,
    as_of: str | datetime | None = None,
    only: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(good, bad) rows of one entity's landing folder: the raw table."""
    path = f"{root.rstrip('/')}/{LANDING_FOLDERS[entity]}"
    return read_landing(spark, path, raw_schema(entity), as_of=as_of, only=only)


def read_with_status(
    spark: SparkSession, path: str, schema: T.StructType, as_of: str | datetime | None = None
) -> DataFrame:
    """All rows, bad ones included: the input of the load log."""
    return stamp_load(parse_lines(spark.read.text(path), schema), as_of)


def route(df: DataFrame, type_col: str, sinks: Mapping[str, str]) -> dict[str, DataFrame]:
    """Split one feed by entity type; several types may share a sink."""
    wanted: dict[str, list[str]] = {}
    for value, sink in sinks.items():
        wanted.setdefault(sink, []).append(value)
    return {sink: df.filter(F.col(type_col).isin(*values)) for sink, values in wanted.items()}


def unrouted(df: DataFrame, type_col: str, sinks: Mapping[str, str]) -> DataFrame:
    """Rows no sink takes, NULL types included."""
    return df.filter(~F.coalesce(F.col(type_col).isin(*sinks), F.lit(False)))
