"""Mixing sources to target weights along a time-varying curriculum.

A source's weight is a piecewise linear schedule over training time 0..1. Its
integral, scaled to the source's target, is the number of words wanted from that
source up to any time; inverting it turns a document's place in its source's
queue into a training position, and the mix is the documents range-sorted by it.

A queue is ordered by a digest of the document, and cut into buckets of that
digest. Only the buckets' totals are summed along a source, so no task sees more
than one bucket, however large a source is. A pass through a queue takes all of
a source; a target above the source's size begins a second pass.

Defined results: a NULL or empty text has size 0 and is never taken; NULL is a
source of its own, after all others; repeated rows have places of their own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import stored, words

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_PASSES = 2
ROWS_PER_BUCKET = 20_000
_DIGITS = 5  # hexadecimal digits of a digest that choose a bucket

# (time, factor) knots of the schedules, repeating over the sources like the
# weights: one fades out, one stays, one fades in.
SCHEDULES: tuple[tuple[tuple[float, float], ...], ...] = (
    ((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)),
)


def sizes(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(doc_id, source, size, digest): all that mixing needs to know of a document."""
    size = F.size(words(F.col(text_col))).cast("long")
    return with_digest(docs.select("doc_id", "source", size.alias("size")))


def with_digest(sized: DataFrame) -> DataFrame:
    """Adds ``digest``, which orders a source's queue."""
    key = F.concat_ws(":", F.col("doc_id").cast("string"), F.col("size").cast("string"))
    return sized.withColumn("digest", F.md5(key.cast("binary")))


def targets(
    sized: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    passes: float = MAX_PASSES,
) -> DataFrame:
    """One row per source: its total ``source_size``, ``weight`` and ``target`` words.

    Filling all sources in proportion to their weights until each is at its cap
    or the words are handed out has a closed form: in the order of cap per unit
    of weight, the capped sources come first.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    # one row per source from here on
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place % len(weights) + 1)
    step = totals.withColumn("place", place).withColumn("weight", weight)
    step = step.withColumn("_cap", F.col("source_size") * float(passes))
    order = Window.orderBy((F.col("_cap") / F.col("weight")).asc(), F.col("place").asc())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    step = step.withColumns(
        {
            "_words": F.sum("source_size").over(whole) * float(share),
            "_given": F.coalesce(F.sum("_cap").over(before), F.lit(0.0)),
            "_weights": F.sum("weight").over(whole)
            - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
        }
    )
    # the level reached if every source from here on stays below its cap
    level = (F.col("_words") - F.col("_given")) / F.col("_weights")
    fits = level * F.col("weight") <= F.col("_cap")
    step = step.withColumn("_level", F.max(F.when(fits, level)).over(whole))
    target = F.least(F.col("_cap"), F.coalesce(F.col("_level") * F.col("weight"), F.col("_cap")))
    return step.select("source", "source_size", "place", "weight", target.alias("target"))


def _segments(knots: Sequence[tuple[float, float]]) -> list[tuple[float, float, float, float]]:
    """(start, factor at start, slope, integral before) of every piece, integral scaled to 1."""
    total = sum((t1 - t0) * (f0 + f1) / 2 for (t0, f0), (t1, f1) in zip(knots, knots[1:]))
    out, before = [], 0.0
    for (t0, f0), (t1, f1) in zip(knots, knots[1:]):
        out.append((t0, f0 / total, (f1 - f0) / (t1 - t0) / total, before))
        before += (t1 - t0) * (f0 + f1) / 2 / total
    return out


def training_time(share: Column, schedule: Column, schedules=SCHEDULES) -> Column:
    """The time at which the demand of schedule number ``schedule`` reaches ``share``.

    Within a piece, demand is ``before + f x + slope x^2 / 2``; the root is
    written so that a slope of zero needs no case of its own.
    """
    out = F.lit(None).cast("double")
    for number, knots in enumerate(schedules):
        time = F.lit(None).cast("double")
        for start, factor, slope, before in _segments(knots):
            want = share - before
            root = F.sqrt(F.greatest(F.lit(factor * factor) + 2 * slope * want, F.lit(0.0)))
            reached = start + 2 * want / (factor + root)
            time = F.when(share >= before, reached).otherwise(time)
        out = F.when(schedule == number, time).otherwise(out)
    return F.least(out, F.lit(1.0))


def queue_offsets(
    listed: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    passes: int = MAX_PASSES,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> tuple[DataFrame, int]:
    """The words before each (source, bucket) of the queues, with the source's target.

    Returns that table and the number of buckets, which follows the row count and
    has no influence on any document's place.
    """
    buckets = max(1, min(16**_DIGITS, -(-listed.count() // rows_per_bucket)))
    per_source = targets(listed, weights, share, passes)
    along = Window.partitionBy("source").orderBy("_bucket")
    table = (
        listed.groupBy("source", _bucket(buckets).alias("_bucket"))
        .agg(F.sum("size").alias("_words"))
        .withColumn("_offset", F.sum("_words").over(along) - F.col("_words"))
        .join(
            per_source.withColumnRenamed("source", "_of"),
            F.col("source").eqNullSafe(F.col("_of")),
        )
        .select(
            F.col("source").alias("_of"),
            F.col("_bucket").alias("_at"),
            "_offset",
            "source_size",
            "place",
            "target",
        )
    )
    return table, buckets


def _bucket(buckets: int) -> Column:
    prefix = F.conv(F.substring("digest", 1, _DIGITS), 16, 10).cast("long")
    return F.floor(prefix * buckets / 16**_DIGITS)


def place(
    rows: DataFrame,
    offsets: DataFrame,
    buckets: int,
    passes: int = MAX_PASSES,
    schedules=SCHEDULES,
) -> DataFrame:
    """``rows`` (with ``source``, ``size``, ``digest``) and their places in the mix.

    Adds ``source_size``, ``target``, ``taken`` and ``positions``, one training
    time per copy. Copy number c is taken when its middle word lies within the
    target, so a source ends at most half a document from its target.
    """
    placed = rows.withColumn("_bucket", _bucket(buckets)).join(
        offsets, F.col("source").eqNullSafe(F.col("_of")) & (F.col("_bucket") == F.col("_at"))
    )
    queue = Window.partitionBy("source", "_bucket").orderBy("digest", "doc_id", "size")
    upto = queue.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    middle = F.col("_offset") + F.sum("size").over(upto) - F.col("size") / 2
    placed = placed.withColumn("_middle", middle)
    copies = F.array(*[F.col("_middle") + F.col("source_size") * c for c in range(passes)])
    inside = F.filter(copies, lambda m: (m < F.col("target")) & (F.col("size") > 0))
    number = F.col("place") % len(schedules)
    return (
        placed.withColumn("_inside", inside)
        .withColumns(
            {
                "taken": F.col("size") * F.size("_inside"),
                "positions": F.transform(
                    "_inside", lambda m: training_time(m / F.col("target"), number, schedules)
                ),
            }
        )
        .drop("_bucket", "_of", "_at", "_offset", "_middle", "_inside", "place")
    )


def schedule(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """One row per document: its source's size and target, ``taken``, ``positions``.

    Range-sorted by first position; documents that are not taken come last.
    """
    listed = stored(sizes(docs, text_col), "mix-sizes")
    offsets, buckets = queue_offsets(listed, **options)
    first = F.get(F.col("positions"), F.lit(0)).asc_nulls_last()
    return place(listed, offsets, buckets).orderBy(first, "doc_id").drop("digest")


def mix(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The mix itself: every copy of a taken document, range-sorted by position.

    The columns are those of ``docs``; a document that is taken twice is there twice.
    Copies of one position follow by id, then by a hash of their text, so that a rerun
    gives the same order.
    """
    listed = stored(sizes(docs, text_col), "mix-sizes")
    offsets, buckets = queue_offsets(listed, **options)
    whole = F.struct(*[F.col(c) for c in docs.columns]).alias("_row")
    size = F.size(words(F.col(text_col))).cast("long").alias("size")
    rows = with_digest(docs.select("doc_id", "source", size, whole))
    copies = place(rows, offsets, buckets).select("_row", F.explode("positions").alias("_position"))
    row = F.col("_row")
    return copies.orderBy("_position", row["doc_id"], F.xxhash64(row[text_col])).select("_row.*")
