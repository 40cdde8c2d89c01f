"""Star joins: as-of, current state, role dependent, by date; and orphan search.

No join here carries a broadcast hint except those on the date dimension, whose
size is its number of days, and on a list of hot keys, whose length is bounded by
the shuffle width. For the others Spark decides from file sizes, or at run time
from the measured size of the shuffled side. Keys are compared as what they are;
only a text key against another type is compared as text. A second integer
condition carries the distribution: rows whose key is NULL, which can match
nothing, are scattered by it, and a key that holds more than a shuffle
partition's share of the fact is cut into slices. Find such keys with
:func:`hot_keys` and pass them as ``hot``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F, types as T

from tidemark.operators.history import CEILING

MAX_BROADCAST_DAYS = 200_000
NULL_SLICES = 1 << 20

HotKeys = Sequence[tuple[str, int]]


def _pick(dim: DataFrame, keys: Sequence[str], cols: Mapping[str, str]) -> DataFrame:
    """Project a dimension to its join keys (renamed aside) and wanted columns."""
    return dim.select(
        *[F.col(k).alias(f"_dim_{i}") for i, k in enumerate(keys)],
        *[F.col(c).alias(name) for c, name in cols.items()],
    )


def _named(cols: Sequence[str] | Mapping[str, str]) -> dict[str, str]:
    return dict(cols) if isinstance(cols, Mapping) else {c: c for c in cols}


def scattered(key: Column, spread: Sequence[str]) -> Column:
    """Slice 0 for a key, some slice for a NULL: the second join condition.

    Only the columns in ``spread`` are read for it, and the number stays the same
    when a lost task runs again.
    """
    some = F.pmod(F.xxhash64(*spread), F.lit(NULL_SLICES)).cast("int")
    return F.when(key.isNull(), some).otherwise(F.lit(0))


def width_of(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(
    fact: DataFrame, keys: Mapping[str, str | Column], width: int | None = None
) -> dict[str, HotKeys]:
    """For every name in ``keys``: [(key text, slices)] of its overfull keys.

    A key is overfull when it holds more than one of ``width`` shuffle partitions'
    share of the rows (the session's width unless given). There are fewer than
    ``width`` such keys per name, so those with the most rows are all that is
    fetched. One job over a stored fact serves all names and counts its rows too.
    """
    width = width or width_of(fact)
    rows = Observation("fact rows")
    columns = {n: F.col(k) if isinstance(k, str) else k for n, k in keys.items()}
    pairs = F.array(
        *[F.struct(F.lit(n).alias("name"), c.cast("string").alias("key")) for n, c in columns.items()]
    )
    top = (
        fact.observe(rows, F.count(F.lit(1)).alias("n"))
        .select(F.explode(pairs).alias("p"))
        .filter(F.col("p.key").isNotNull())
        .groupBy("p.name", "p.key")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("n").desc(), "name", "key")
        .limit(width * len(columns))
        .collect()
    )
    out: dict[str, list] = {n: [] for n in columns}
    if not top:  # of an empty plan nothing is observed
        return out
    share = rows.get["n"] / width
    for r in top:
        if r.n > share:
            out[r.name].append((r.key, max(2, int(r.n / share))))
    return out


def _text(key: Column) -> Column:
    return key.cast("string")


def _comparable(fact: DataFrame, dim: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Both sides' keys (``key``, ``_dim_0``), as text when just one of them is text."""
    kinds = {isinstance(f.schema[c].dataType, T.StringType) for f, c in ((fact, key), (dim, "_dim_0"))}
    if len(kinds) == 1:
        return fact, dim
    return fact.withColumn(key, _text(F.col(key))), dim.withColumn("_dim_0", _text(F.col("_dim_0")))


def _slice(
    fact: DataFrame, dim: DataFrame, key: str, hot: HotKeys, spread: Sequence[str]
) -> tuple[DataFrame, DataFrame, Column]:
    """Number the slices of hot keys: fact rows get one, dimension rows all.

    Returns both sides and the whole join condition. The listed keys are turned
    back into the fact's type, so both sides find them by the same equality as
    the join itself.
    """
    fact, dim = _comparable(fact, dim, key)
    fact = fact.withColumn("_fact_slice", scattered(F.col(key), spread))
    dim = dim.withColumn("_dim_slice", F.lit(0))
    if hot:
        kind = fact.schema[key].dataType
        listed = fact.sparkSession.createDataFrame(list(hot), "_hot string, _slices int")
        listed = F.broadcast(listed.withColumn("_hot", F.col("_hot").cast(kind)))
        one = F.pmod(F.xxhash64(*spread), F.col("_slices")).cast("int")
        fact = (
            fact.join(listed, F.col(key) == F.col("_hot"), "left")
            .withColumn("_fact_slice", F.coalesce(one, F.col("_fact_slice")))
            .drop("_hot", "_slices")
        )
        every = F.explode(F.sequence(F.lit(0), F.coalesce("_slices", F.lit(1)) - 1))
        dim = (
            dim.join(listed, F.col("_dim_0") == F.col("_hot"), "left")
            .withColumn("_dim_slice", every)
            .drop("_hot", "_slices")
        )
    match = (F.col(key) == F.col("_dim_0")) & (F.col("_fact_slice") == F.col("_dim_slice"))
    return fact, dim, match


_HELPERS = ("_fact_key", "_dim_0", "_fact_slice", "_dim_slice")


def _spread(fact: DataFrame, spread_by: str | Sequence[str] | None) -> list[str]:
    if spread_by is None:
        return fact.columns[:1]
    return [spread_by] if isinstance(spread_by, str) else list(spread_by)


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str | Column,
    dim_key: str,
    cols: Sequence[str] | Mapping[str, str],
    spread_by: str | Sequence[str] | None = None,
    hot: HotKeys = (),
) -> DataFrame:
    """Left join on one key, adding ``cols`` of ``dim`` (optionally renamed).

    ``spread_by`` names columns that vary between the fact's rows, by default
    its first one, the identifier in all tables here.
    """
    key = F.col(fact_key) if isinstance(fact_key, str) else fact_key
    keyed = fact.withColumn("_fact_key", key)
    side = _pick(dim, [dim_key], _named(cols))
    keyed, side, match = _slice(keyed, side, "_fact_key", hot, _spread(fact, spread_by))
    return keyed.join(side, match, "left").drop(*_HELPERS)


def current_join(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    cols: Sequence[str] | Mapping[str, str],
    flag_col: str = "is_current_record",
    hot: HotKeys = (),
) -> DataFrame:
    """Left join against the current versions only."""
    return lookup_join(fact, dim.filter(F.col(flag_col)), fact_key, dim_key, cols, hot=hot)


def role_key(role_col: str, roles: Mapping[str, str]) -> Column:
    """The column that ``roles`` names for each row's role; NULL for other roles."""
    key = F.lit(None).cast("string")
    for role, column in roles.items():
        key = F.when(F.col(role_col) == role, F.col(column).cast("string")).otherwise(key)
    return key


def role_join(
    fact: DataFrame,
    dim: DataFrame,
    role_col: str,
    roles: Mapping[str, str],
    dim_key: str,
    cols: Sequence[str] | Mapping[str, str],
    hot: HotKeys = (),
    spread_by: str | Sequence[str] | None = None,
) -> DataFrame:
    """Left join where ``roles[role value]`` names the fact column to match.

    One key expression instead of an OR of conditions keeps it an equality join.
    A role outside ``roles`` has no key and matches nothing.
    """
    return lookup_join(fact, dim, role_key(role_col, roles), dim_key, cols, spread_by, hot)


def asof_join(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    fact_ts: str,
    cols: Sequence[str] | Mapping[str, str],
    from_col: str = "effective_valid_from",
    to_col: str = "valid_to",
    spread_by: str | Sequence[str] | None = None,
    hot: HotKeys = (),
) -> DataFrame:
    """Every fact row with the version valid at ``fact_ts``; windows are half open.

    Versions and facts of a key are put in one order of time and the version last
    begun is carried forward to each fact, so rows grow with facts plus versions
    and not with their product, however many versions a key has. A key in ``hot``
    is cut into slices, of which each has all versions of the key and a share of
    its facts. Where versions overlap, the one begun last holds (of those that
    begin together, the one that ends last); a version without length or without
    a key never holds.
    """
    versions = dim.select(
        F.col(dim_key).alias("_dim_0"),
        F.col(from_col).alias("_starts"),
        F.coalesce(F.col(to_col), F.lit(CEILING).cast("timestamp")).alias("_ends"),
        *[F.col(c).alias(name) for c, name in _named(cols).items()],
    )
    versions = versions.filter(F.col("_dim_0").isNotNull() & (F.col("_starts") < F.col("_ends")))
    keyed = fact.withColumn("_fact_key", F.col(fact_key))
    keyed, versions, _ = _slice(keyed, versions, "_fact_key", hot, _spread(fact, spread_by))
    names, held = fact.columns, ["_ends", *_named(cols).values()]
    carried = F.struct(*[F.col(c) for c in held])
    kind = versions.select(carried.alias("v")).schema["v"].dataType
    facts = keyed.select(
        F.col("_fact_key").alias("_k"),
        F.col("_fact_slice").alias("_s"),
        F.col(fact_ts).alias("_at"),
        F.lit(None).cast("timestamp").alias("_until"),
        F.lit(None).cast(kind).alias("_version"),
        F.lit(True).alias("_is_fact"),
        *[F.col(c).alias(f"_f_{i}") for i, c in enumerate(names)],
    )
    begun = versions.select(
        F.col("_dim_0").alias("_k"),
        F.col("_dim_slice").alias("_s"),
        F.col("_starts").alias("_at"),
        F.col("_ends").cast("timestamp").alias("_until"),
        carried.alias("_version"),
        F.lit(False).alias("_is_fact"),
    )
    # a version that begins with the fact comes before it
    order = Window.partitionBy("_k", "_s").orderBy("_at", "_is_fact", "_until")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    walked = facts.unionByName(begun, allowMissingColumns=True).withColumn(
        "_now", F.last("_version", ignorenulls=True).over(so_far)
    )
    holds = F.col("_at") < F.col("_now")["_ends"]
    return walked.filter("_is_fact").select(
        *[F.col(f"_f_{i}").alias(c) for i, c in enumerate(names)],
        *[F.when(holds, F.col("_now")[c]).alias(c) for c in held[1:]],
    )


def date_join(
    fact: DataFrame,
    dim_date: DataFrame,
    when: str,
    cols: Sequence[str] | Mapping[str, str],
    days: int | None = None,
) -> DataFrame:
    """Left join of the calendar day of ``when`` (date or timestamp).

    ``days`` is the known length of ``dim_date``; the side is broadcast when it
    is given and small, and left to Spark otherwise.
    """
    side = _pick(dim_date, ["full_date"], _named(cols))
    if days is not None and days <= MAX_BROADCAST_DAYS:
        side = F.broadcast(side)
    return fact.join(side, F.to_date(F.col(when)) == F.col("_dim_0"), "left").drop("_dim_0")


def orphans(
    child: DataFrame,
    parent: DataFrame,
    fk: str,
    pk: str,
    keep_null: bool = True,
    spread_by: str | Sequence[str] | None = None,
    hot: HotKeys = (),
) -> DataFrame:
    """Child rows without a parent. ``keep_null`` counts a NULL key as an orphan.

    The rows of a key in ``hot`` are cut into slices that each look for the parent.
    """
    rows = child if keep_null else child.filter(F.col(fk).isNotNull())
    keyed = rows.withColumn("_fact_key", F.col(fk))
    keys = parent.select(F.col(pk).alias("_dim_0"))
    keyed, keys, match = _slice(keyed, keys, "_fact_key", hot, _spread(rows, spread_by))
    return keyed.join(keys, match, "left_anti").select(*rows.columns)


def role_violations(
    fact: DataFrame,
    role_col: str,
    parties: Mapping[str, Mapping[str, str]],
    dims: Mapping[str, tuple[DataFrame, str]],
) -> DataFrame:
    """Rows in which a party named by the role is missing from its dimension.

    ``parties`` maps role -> {dimension name: fact column}; ``dims`` maps
    dimension name -> (frame, key). Roles that are not listed are not judged; they
    have no key, and are spread by all columns of the fact.
    """
    out = fact
    names = sorted({n for p in parties.values() for n in p})
    for name in names:
        dim, key = dims[name]
        found = dim.select(key).dropDuplicates().withColumn("_found", F.lit(True))
        columns = {role: p[name] for role, p in parties.items() if name in p}
        out = role_join(
            out, found, role_col, columns, key, {"_found": f"_has_{name}"}, spread_by=fact.columns
        )
    missing = F.lit(False)
    for role, wanted in parties.items():
        absent = F.lit(False)
        for name in wanted:
            absent = absent | F.col(f"_has_{name}").isNull()
        missing = missing | ((F.col(role_col) == role) & absent)
    return out.filter(missing).select(*fact.columns)


def mismatches(
    left: DataFrame,
    right: DataFrame,
    on: str,
    left_col: str,
    right_col: str,
    spread_by: str | Sequence[str] | None = None,
    hot: HotKeys = (),
) -> DataFrame:
    """Rows of ``left`` whose partner in ``right`` disagrees; NULL never disagrees."""
    keyed = left.withColumn("_fact_key", F.col(on))
    side = _pick(right, [on], {right_col: "_other"})
    keyed, side, match = _slice(keyed, side, "_fact_key", hot, _spread(left, spread_by))
    differs = F.col(left_col) != F.col("_other")
    return keyed.join(side, match & differs, "inner").select(*left.columns)
