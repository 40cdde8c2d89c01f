"""Session rollup and count reconciliation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.clean import flag, seconds_between


def session_rollup(
    events: DataFrame,
    session: str,
    ts: str,
    type_col: str,
    steps: Mapping[str, int],
    carry_min: Sequence[str] = (),
) -> DataFrame:
    """One row per session id: bounds, size, furthest step, a flag per step.

    A single aggregation of combinable functions: every input partition is
    folded to one row per session before the shuffle.
    """
    code = F.col(type_col)
    step = F.lit(None).cast("int")
    for name, number in steps.items():
        step = F.when(code == name, number).otherwise(step)
    return events.groupBy(session).agg(
        F.min(ts).alias("session_started_at"),
        F.max(ts).alias("session_ended_at"),
        *[F.min(c).alias(c) for c in carry_min],
        F.count(F.lit(1)).alias("event_count"),
        F.max(step).alias("furthest_funnel_step"),
        *[flag(F.bool_or(code == name)).alias(f"had_{name}") for name in steps],
    )


def session_metrics(sessions: DataFrame) -> DataFrame:
    """Add the duration, and whether a booking was begun but not finished."""
    return sessions.withColumns(
        {
            "session_duration_seconds": seconds_between(
                F.col("session_started_at"), F.col("session_ended_at")
            ),
            "abandoned_after_booking_start": F.col("had_booking_start")
            & ~F.col("had_booking_complete"),
        }
    )


def funnel_gaps(sessions: DataFrame, chain: Sequence[str]) -> DataFrame:
    """Sessions that reached a later step of ``chain`` without the one before."""
    gap = F.lit(False)
    for before, after in zip(chain, chain[1:]):
        gap = gap | (F.col(f"had_{after}") & ~F.col(f"had_{before}"))
    return sessions.filter(gap)


def reconcile_counts(whole: DataFrame, parts: Mapping[str, DataFrame], name: str) -> DataFrame:
    """One row: the size of ``whole``, of each part, and whether they add up."""
    out = whole.agg(F.count(F.lit(1)).alias(name))
    total = F.lit(0)
    for part, frame in parts.items():
        # one row each
        out = out.crossJoin(frame.agg(F.count(F.lit(1)).alias(part)))
        total = total + F.col(part)
    return out.withColumn("reconciles", F.col(name) == total)
