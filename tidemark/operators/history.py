"""Slowly changing history (type 2): apply a snapshot, derive a dimension, check it."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidemark.functions.clean import KEY_TIME_FORMAT, version_key

VERSION_COLS = ("scd_id", "updated_at", "valid_from", "valid_to")
FLOOR = "1900-01-01 00:00:00"
CEILING = "9999-12-31 00:00:00"


def _instant(ts: str | datetime) -> Column:
    return F.lit(ts).cast("timestamp")


def _stamp(keys: Sequence[str], run_ts: Column) -> dict[str, Column]:
    parts = [c for k in keys for c in (F.col(k).cast("string"), F.lit("|"))]
    return {
        "scd_id": F.md5(F.concat(*parts, F.date_format(run_ts, KEY_TIME_FORMAT))),
        "updated_at": run_ts,
        "valid_from": run_ts,
        "valid_to": F.lit(None).cast("timestamp"),
    }


def scd2_apply(
    history: DataFrame | None,
    source: DataFrame,
    keys: Sequence[str],
    check_cols: Sequence[str],
    run_ts: str | datetime,
    close_missing: bool = True,
) -> DataFrame:
    """History after one snapshot of ``source`` (unique on ``keys``) at ``run_ts``.

    A new key opens a version. A difference in any check column (NULL equals
    NULL) closes the open version and opens another. A key that left the source
    is closed when ``close_missing``; it opens again when it comes back.

    Only open versions are joined, once; the changed pairs then yield two rows
    each. Closed versions pass by without a shuffle.

    A column that is text on one side only becomes text, old versions included:
    values are compared as text, and nothing of the history is lost to a cast.
    """
    now = _instant(run_ts)
    keys = list(keys)
    fresh = source.withColumns(_stamp(keys, now))
    if history is None:
        return fresh

    history, fresh = _common_types(history, fresh)
    # schemas are fetched once: every look at `.columns` asks the JVM
    had, has, sourced = history.columns, fresh.columns, source.columns
    columns = [*had, *[c for c in sourced if c not in had]]
    closed = history.filter(F.col("valid_to").isNotNull())
    current = history.filter(F.col("valid_to").isNull())
    old = current.select(*[F.col(c).alias(f"old_{c}") for c in had], F.lit(True).alias("has_old"))
    new = fresh.select(*[F.col(c).alias(f"new_{c}") for c in has], F.lit(True).alias("has_new"))
    # rows without a key match nothing: a second condition spreads them out
    same_key = [F.col(f"old_{k}") == F.col(f"new_{k}") for k in keys]
    old = old.withColumn("old__slice", _slice_of([f"old_{k}" for k in keys], old.columns))
    new = new.withColumn("new__slice", _slice_of([f"new_{k}" for k in keys], new.columns))
    pairs = old.join(new, [*same_key, F.col("old__slice") == F.col("new__slice")], "full")

    def stored(side: str, c: str, present: Sequence[str]) -> Column:
        return F.col(f"{side}_{c}") if c in present else F.lit(None)

    differs = F.lit(False)
    for c in check_cols:
        differs = differs | ~stored("old", c, had).eqNullSafe(stored("new", c, has))
    both = F.col("has_old") & F.col("has_new")
    sides = (
        F.when(F.col("has_old").isNull(), F.array(F.lit(1)))
        .when(both & differs, F.array(F.lit(0), F.lit(1)))
        .otherwise(F.array(F.lit(0)))
    )
    ended = (both & differs) | (F.lit(close_missing) & F.col("has_new").isNull())
    staged = pairs.withColumn("_ended", ended).withColumn("_side", F.explode(sides))
    is_old = F.col("_side") == 0
    out = []
    for c in columns:
        before, after = stored("old", c, had), stored("new", c, has)
        if c == "valid_to":
            before = F.when(F.col("_ended"), now)
        out.append(F.when(is_old, before).otherwise(after).alias(c))
    return closed.unionByName(staged.select(*out), allowMissingColumns=True)


def _common_types(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both frames with the columns as text that are of two kinds; numbers stay numbers."""
    kinds = {f.name: f.dataType for f in a.schema}
    number = (T.NumericType,)
    mixed = [
        f.name
        for f in b.schema
        if f.name in kinds
        and kinds[f.name] != f.dataType
        and not (isinstance(kinds[f.name], number) and isinstance(f.dataType, number))
    ]
    if not mixed:
        return a, b

    def as_text(df: DataFrame) -> DataFrame:
        plain = {f.name: isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)) for f in df.schema}
        text = {c: F.to_json(c) if plain[c] else F.col(c).cast("string") for c in mixed}
        return df.withColumns(text)

    return as_text(a), as_text(b)


def _slice_of(keys: Sequence[str], columns: Sequence[str]) -> Column:
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    some = F.pmod(F.xxhash64(*columns), F.lit(1 << 20)).cast("int")
    return F.when(missing, some).otherwise(0)


def backdate_first(
    history: DataFrame, key: str, from_col: str = "valid_from", floor_ts: str = FLOOR
) -> DataFrame:
    """Add ``effective_valid_from``: ``floor_ts`` on each key's earliest version.

    The earliest start is a combinable minimum joined back, so no task has to
    hold all versions of one key. Two versions of a key that share the earliest
    start are malformed and show up in :func:`overlaps`.
    """
    first = (
        history.filter(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("_key"))
        .agg(F.min(from_col).alias("_first"), F.lit(0).alias("_first_slice"))
    )
    # versions without a key belong to no entity: each is its own first
    sliced = history.withColumn("_slice", _slice_of([key], history.columns))
    match = (F.col(key) == F.col("_key")) & (F.col("_slice") == F.col("_first_slice"))
    dated = sliced.join(first, match, "left").drop("_slice", "_first_slice")
    dated = dated.withColumn("_first", F.coalesce("_first", F.when(F.col(key).isNull(), F.col(from_col))))
    start = F.when(F.col(from_col) == F.col("_first"), _instant(floor_ts)).otherwise(F.col(from_col))
    return dated.withColumn("effective_valid_from", start).drop("_key", "_first")


def scd2_dim(
    history: DataFrame,
    key: str,
    key_name: str,
    sep: str = "|",
    floor_ts: str = FLOOR,
) -> DataFrame:
    """Dimension rows: version key, effective start, current flag."""
    dated = backdate_first(history, key, "valid_from", floor_ts)
    return dated.withColumns(
        {
            key_name: version_key(F.col(key), F.col("valid_from"), sep),
            "is_current_record": F.col("valid_to").isNull(),
        }
    )


def overlaps(
    dim: DataFrame,
    key: str,
    version: str,
    from_col: str = "effective_valid_from",
    to_col: str = "valid_to",
    slice_unit: str = "month",
) -> DataFrame:
    """Versions that begin before an earlier version of the same key has ended.

    Returns one row per such version with the latest end seen before it, instead
    of every pair. The history of a key is cut into time slices: slice maxima
    are combined first, then each slice is walked on its own with the maximum of
    all earlier slices carried in. Windows of no length cover nothing and are
    left out.
    """
    spans = dim.select(
        F.col(key).alias("entity_id"),
        F.col(version).alias("version_key"),
        F.col(from_col).alias("_from"),
        F.coalesce(F.col(to_col), _instant(CEILING)).alias("_to"),
    ).filter(F.col("entity_id").isNotNull() & (F.col("_from") < F.col("_to")))
    sliced = spans.withColumn("_slice", F.date_trunc(slice_unit, "_from"))

    earlier = Window.partitionBy("entity_id").orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    carried = (
        sliced.groupBy("entity_id", "_slice")
        .agg(F.max("_to").alias("_slice_end"))
        .withColumn("_carried", F.max("_slice_end").over(earlier))
        .drop("_slice_end")
    )
    inside = Window.partitionBy("entity_id", "_slice").orderBy("_from", "version_key").rowsBetween(
        Window.unboundedPreceding, -1
    )
    walked = sliced.join(carried, ["entity_id", "_slice"]).withColumn(
        "covered_until", F.greatest("_carried", F.max("_to").over(inside))
    )
    return walked.filter(F.col("covered_until") > F.col("_from")).select(
        "entity_id", "version_key", F.col("_from").alias("starts_at"), "covered_until"
    )
