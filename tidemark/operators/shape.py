"""Projection, quarantine and schema synchronisation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.clean import flag


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name, built as a balanced tree: many frames stay quick to analyse."""
    level = list(frames)
    while len(level) > 1:
        pairs = [level[i : i + 2] for i in range(0, len(level), 2)]
        level = [p[0].unionByName(p[1]) if len(p) == 2 else p[0] for p in pairs]
    return level[0]


def project_from_config(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Select the configured columns in order; unknown or repeated names fail."""
    unknown = [n for n in names if n not in df.columns]
    repeated = sorted({n for n in names if list(names).count(n) > 1})
    if unknown or repeated:
        raise ValueError(f"unknown columns {unknown}, repeated columns {repeated}")
    return df.select(*names)


def rename_project(df: DataFrame, roles: Mapping[str, str]) -> DataFrame:
    """Select the columns of ``roles`` under their role names."""
    return df.select(*[F.col(c).alias(name) for c, name in roles.items()])


def quarantine(
    df: DataFrame,
    bad_when: Column,
    reasons: Sequence[tuple[Column, str]],
    default: str,
    reason_col: str = "quarantine_reason",
) -> tuple[DataFrame, DataFrame]:
    """(clean, bad); bad rows carry the first reason that applies."""
    reason = F.lit(default)
    for condition, text in reversed(list(reasons)):
        reason = F.when(condition, text).otherwise(reason)
    bad = flag(bad_when)
    return df.filter(~bad), df.filter(bad).withColumn(reason_col, reason)


def sync_columns(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """Stored rows in the batch's shape: new columns NULL, dropped ones gone."""
    return batch.limit(0).unionByName(stored, allowMissingColumns=True).select(*batch.columns)


def schema_changes(stored: DataFrame, batch: DataFrame) -> dict[str, list[str]]:
    """Names of added, removed and retyped columns."""
    old = {f.name: f.dataType for f in stored.schema}
    new = {f.name: f.dataType for f in batch.schema}
    return {
        "added": [c for c in new if c not in old],
        "removed": [c for c in old if c not in new],
        "retyped": [c for c in new if c in old and old[c] != new[c]],
    }
