"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.session import scratch, tune

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once below the shared folder: later plans start from files."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete the files of frames that :func:`stored` returned, once nothing reads them any more."""
    for df in frames:
        session = df.sparkSession
        target = session.sparkContext._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        target.getFileSystem(session.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once.

    A plain Column that is mentioned inside a lambda is evaluated again for
    every element; a lambda variable is not.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


# Words are runs of anything but space and \t \n \v \f \r.
BLANK = r"[\x20\x09-\x0D]"
NOT_BLANK = r"[^\x20\x09-\x0D]"


def spaced(text: Column) -> Column:
    """``text`` (NULL as empty) with every blank turned into a space."""
    out = F.replace(F.coalesce(text, F.lit("")), F.lit("\n"), F.lit(" "))
    rare = r"[\x09\x0B-\x0D]"
    return F.when(F.rlike(text, F.lit(rare)), F.regexp_replace(out, rare, " ")).otherwise(out)


def words(text: Column) -> Column:
    """The maximal runs of non-blanks, in order."""
    return F.array_remove(F.split(spaced(text), " "), "")


def occurrences(text: Column, characters: str) -> Column:
    """How many of ``characters`` are in ``text``; most texts have none and are only searched."""
    group = "[" + "".join(f"\\{c}" for c in characters) + "]"
    found = F.length(text) - F.length(F.regexp_replace(text, group, ""))
    return F.when(F.rlike(text, F.lit(group)), found).otherwise(0).cast("long")


def held_out(doc_id: Column) -> Column:
    """The third of the rows that no classifier may learn from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def tokenizer() -> tuple[str, str]:
    """Path of the public vocabulary and the pattern that splits texts."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
