"""Newest row per key, and incremental reading above a high-water mark."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Window, functions as F

_RANK = "_row_rank"
_HASH = "_key_hash"
PLACE = "_place_"
_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def _column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def keep_latest(
    df: DataFrame,
    keys: Sequence[str],
    order_cols: Sequence[str | Column],
    tie_cols: Sequence[str | Column] | None = None,
) -> DataFrame:
    """Keep one row per ``keys``: the greatest by ``order_cols``, NULL first.

    ``tie_cols`` make the choice total; without them a hash over the whole row
    does, so the result depends neither on input order nor on partitioning.

    Filtering the row number to 1 lets Spark cut every key to one row per input
    partition before the shuffle, so a key holding a large share of the table
    never reaches one task whole. The window is keyed by a hash ahead of the keys
    themselves: sorting then compares longs, not long equal text prefixes.
    """
    ties = [F.xxhash64(*df.columns)] if tie_cols is None else [_column(c) for c in tie_cols]
    order = [c.desc_nulls_first() for c in [*map(_column, order_cols), *ties]]
    rank = F.row_number().over(Window.partitionBy(_HASH, *keys).orderBy(*order))
    hashed = df.withColumn(_HASH, F.xxhash64(*keys))
    return hashed.withColumn(_RANK, rank).filter(F.col(_RANK) == 1).drop(_RANK, _HASH)


def newest(df: DataFrame, keys: Sequence[str | Column], order_cols: Sequence[str | Column]) -> DataFrame:
    """All rows that tie for the greatest by ``order_cols`` of their key, NULL first.

    Rows that are not among them are cut before the shuffle as in :func:`keep_latest`.
    The keys stay in columns that begin with ``PLACE``; the rows of a key are in one
    task, so :func:`one_of` chooses within them without another shuffle.
    """
    named = {f"{PLACE}{i}": _column(k) for i, k in enumerate(keys)}
    # the hash is compared first, as in keep_latest
    placed = df.withColumn(f"{PLACE}hash", F.xxhash64(*named.values())).withColumns(named)
    order = [c.desc_nulls_first() for c in map(_column, order_cols)]
    rank = F.rank().over(Window.partitionBy(*places(placed)).orderBy(*order))
    return placed.withColumn(_RANK, rank).filter(F.col(_RANK) == 1).drop(_RANK)


def one_of(df: DataFrame, keys: Sequence[str], ties: Sequence[str]) -> DataFrame:
    """Of the rows of :func:`newest`, one per place and ``keys``, by a hash over ``ties``."""
    order = F.xxhash64(*ties).desc_nulls_first()
    rank = F.row_number().over(Window.partitionBy(*places(df), *keys).orderBy(order))
    return df.withColumn(_RANK, rank).filter(F.col(_RANK) == 1).drop(_RANK)


def places(df: DataFrame) -> list[str]:
    """The columns of ``df`` that :func:`newest` has added."""
    return [c for c in df.columns if c.startswith(PLACE)]


def high_water(df: DataFrame | None, mark_col: str, default: datetime) -> datetime:
    """Greatest ``mark_col`` as an aware datetime; ``default`` on no rows.

    The one value is fetched so that :func:`since` filters by a literal, which
    reaches the file scan as a pushed filter.
    """
    if df is None:
        return default
    micros = df.agg(F.unix_micros(F.max(F.col(mark_col).cast("timestamp")))).first()[0]
    return default if micros is None else _EPOCH + timedelta(microseconds=micros)


def since(df: DataFrame, mark_col: str, mark: datetime | None) -> DataFrame:
    """Rows at or above the mark. The boundary batch is read again on purpose."""
    return df if mark is None else df.filter(F.col(mark_col) >= F.lit(mark))
