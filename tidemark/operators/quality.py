"""Declarative data-quality checks, reported as (check_name, violations)."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.joins import orphans
from tidemark.operators.merge import repeated_keys
from tidemark.operators.shape import union_all

E164 = r"^\+1[0-9]{10}$"


@dataclass(frozen=True)
class Check:
    """``bad_row`` judges single rows of ``table``; ``violations`` whole tables.

    ``judged_by`` names the columns of ``table`` that decide a violation. Counting
    then folds the table to its distinct values first, so a join behind it never
    sees the rows of a frequent key one by one.
    """

    name: str
    table: str
    bad_row: Column | None = None
    violations: Callable[[Mapping[str, DataFrame]], DataFrame] | None = None
    judged_by: tuple[str, ...] = ()

    def rows(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        """The violating rows themselves."""
        if self.violations is not None:
            return self.violations(tables)
        return tables[self.table].filter(self.bad_row)

    def count(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        """One row with the number of violating rows."""
        if not self.judged_by:
            return self.rows(tables).agg(F.count(F.lit(1)).alias("violations"))
        folded = tables[self.table].groupBy(*self.judged_by).agg(F.count(F.lit(1)).alias("_rows"))
        found = self.rows({**tables, self.table: folded})
        return found.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("violations"))


def rule(name: str, table: str, bad_row: Column) -> Check:
    return Check(name, table, bad_row=bad_row)


def relation(
    name: str,
    table: str,
    violations: Callable[[Mapping[str, DataFrame]], DataFrame],
    judged_by: Sequence[str] = (),
) -> Check:
    return Check(name, table, violations=violations, judged_by=tuple(judged_by))


def not_null(table: str, column: str) -> Check:
    return rule(f"not_null_{table}_{column}", table, F.col(column).isNull())


def accepted(table: str, column: str, values: Sequence) -> Check:
    return rule(f"accepted_values_{table}_{column}", table, ~F.col(column).isin(*values))


def unique(table: str, column: str) -> Check:
    def find(tables: Mapping[str, DataFrame]) -> DataFrame:
        return repeated_keys(tables[table].filter(F.col(column).isNotNull()), [column])

    return relation(f"unique_{table}_{column}", table, find)


def fk(table: str, column: str, parent: str, field: str) -> Check:
    def find(tables: Mapping[str, DataFrame]) -> DataFrame:
        return orphans(tables[table], tables[parent], column, field, keep_null=False)

    return relation(f"relationships_{table}_{column}_{parent}", table, find, [column])


def not_e164(x: Column) -> Column:
    return ~x.rlike(E164)


def out_of_range(columns: Sequence[str], low: float, high: float) -> Column:
    """True when any of the columns is outside; NULLs do not count."""
    outside = F.lit(False)
    for c in columns:
        outside = outside | F.coalesce(~F.col(c).between(low, high), F.lit(False))
    return outside


def run_checks(checks: Sequence[Check], tables: Mapping[str, DataFrame]) -> DataFrame:
    """One frame of (check_name, violations) for all checks.

    Row checks of a table share a single aggregate over one scan of it; the
    others add one counting branch each. Everything runs as one job.
    """
    by_table: dict[str, list[Check]] = defaultdict(list)
    parts: list[DataFrame] = []
    for check in checks:
        if check.bad_row is not None:
            by_table[check.table].append(check)
        else:
            parts.append(
                check.count(tables).select(F.lit(check.name).alias("check_name"), "violations")
            )
    for table, group in by_table.items():
        counts = [F.count_if(c.bad_row).alias(f"c{i}") for i, c in enumerate(group)]
        pairs = F.array(
            *[
                F.struct(F.lit(c.name).alias("check_name"), F.col(f"c{i}").alias("violations"))
                for i, c in enumerate(group)
            ]
        )
        parts.append(tables[table].agg(*counts).select(F.inline(pairs)))
    return union_all(parts)


class QualityError(RuntimeError):
    """A layer has violations; what comes after it must not run."""


def gate(report: DataFrame) -> None:
    """Raise :class:`QualityError` naming the checks that found violations."""
    failed = report.filter(F.col("violations") > 0).orderBy("check_name").collect()
    if failed:
        listed = ", ".join(f"{r.check_name}={r.violations}" for r in failed)
        raise QualityError(listed)
