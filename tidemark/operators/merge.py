"""Keyed upsert of one batch into a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def merge_upsert(
    target: DataFrame | None,
    batch: DataFrame,
    keys: Sequence[str],
    order_guard: str | None = None,
    sync_schema: bool = True,
) -> DataFrame:
    """Target after replacing matched keys by, and adding, the rows of ``batch``.

    ``batch`` must be unique on ``keys``. It wins even when its rows are older,
    unless ``order_guard`` names a column: then a target row with a greater
    value stays. NULL keys match nothing. With ``sync_schema`` the result takes
    the batch's columns and types, otherwise the target's.
    """
    if target is None:
        return batch
    keys = list(keys)
    if order_guard is not None:
        seen = target.select(*keys, F.col(order_guard).alias("_stored_order"))
        batch_cols = batch.columns
        batch = (
            batch.join(seen, keys, "left")
            .filter(F.col("_stored_order").isNull() | (F.col(order_guard) >= F.col("_stored_order")))
            .select(*batch_cols)
        )
    columns = batch.columns if sync_schema else target.columns
    untouched = _unmatched(target, batch, keys)
    if sync_schema:
        untouched = _retyped(untouched, batch)
    else:
        batch = _retyped(batch, target)
    return untouched.unionByName(batch, allowMissingColumns=True).select(*columns)


def _unmatched(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key is not in ``batch``; rows with a NULL key are spread out."""
    some = F.pmod(F.xxhash64(*target.columns), F.lit(1 << 20)).cast("int")
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    rows = target.withColumn("_slice", F.when(missing, some).otherwise(0))
    known = batch.select(*[F.col(k).alias(f"_new_{k}") for k in keys], F.lit(0).alias("_new_slice"))
    match = F.col("_slice") == F.col("_new_slice")
    for k in keys:
        match = match & (F.col(k) == F.col(f"_new_{k}"))
    return rows.join(known, match, "left_anti").drop("_slice")


def _retyped(df: DataFrame, like: DataFrame) -> DataFrame:
    """Shared columns in the types of ``like``; a value that does not fit is NULL."""
    wanted = {f.name: f.dataType for f in like.schema}
    changed = {
        f.name: F.col(f.name).try_cast(wanted[f.name])
        for f in df.schema
        if f.name in wanted and wanted[f.name] != f.dataType
    }
    return df.withColumns(changed) if changed else df


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt")).filter(F.col("cnt") > 1)


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Return ``df``, or raise when a key occurs twice (NULL keys never match)."""
    known = df
    for k in keys:
        known = known.filter(F.col(k).isNotNull())
    repeated = repeated_keys(known, keys).limit(1).count()
    if repeated:
        raise ValueError(f"batch holds several rows for one key of {list(keys)}")
    return df
