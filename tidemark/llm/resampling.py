"""Importance resampling towards a target distribution.

1. Features. A text's features are its runs of 1 to ``longest`` words; each falls
   into one of ``buckets`` by its checksum. Corpus and target texts are counted by
   bucket, in combinable aggregations.
2. Weights. The gain of every bucket is held in one array, and a document's weight
   is the sum of the entries that its features point to. The array has ``buckets``
   entries whatever the input, and travels inside the plan.
3. Cutoff. Weight plus a Gumbel number drawn from the id is the score; scores are
   written once. The score of the last document to draw is found by bisection:
   each job counts, exactly, the rows at or above several numbers, four halvings at
   a time. Where that score is tied, the doc_id of the last one is found in the
   same way. Nothing is sorted or collected to find the cutoff.
4. Ranks. Only the drawn rows are shuffled, dealt by ranges of (score, doc_id) and
   written; each range is numbered on its own, after the rows of the ranges before.

A hot source, word or score is no group anywhere; rows that tie in all columns are
told apart by their place in the written scores, so ranges can split them.

Defined results: a NULL or empty text has no features and weight 0; a row with a
NULL id has a NULL score and is never drawn, nor counted among those to draw from;
a repeated row is a document of its own; an empty target or corpus counts nothing.
Other columns are not read, so their names do not matter.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import let, stored

BUCKETS = 10_000
PROBES = 15  # numbers counted in one job
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Runs of digits, letters a-z and all characters beyond ASCII, A-Z lower-cased."""
    given = F.coalesce(text, F.lit(""))
    plain = F.octet_length(given) == F.length(given)
    low = F.when(plain, F.lower(given)).otherwise(F.translate(given, _UPPER, _LOWER))
    return F.array_remove(F.split(low, _BETWEEN), "")


def _runs(words: Column, longest: int) -> Column:
    """All runs of 1 to ``longest`` of ``words``."""
    if longest == 1:
        return words

    def runs(w: Column, k: int) -> Column:
        if k == 1:
            return w
        starts = F.sequence(F.lit(1), F.size(w) - (k - 1))
        joined = F.transform(starts, lambda i: F.array_join(F.slice(w, i, k), " "))
        return F.when(F.size(w) >= k, joined).otherwise(F.array().cast("array<string>"))

    return let(words, lambda w: F.concat(*[runs(w, k) for k in range(1, longest + 1)]))


def _bucketed(texts: DataFrame, text_col: str, longest: int, buckets: int, *keep: Column) -> DataFrame:
    """``keep``, n_words and the bucket of every feature of each row."""
    split = texts.select(*keep, words_of(F.col(text_col)).alias("words"))
    kept = [F.col(c) for c in split.columns if c != "words"]
    number = lambda f: (F.crc32(f) % buckets).cast("int")
    return split.select(
        *kept,
        F.size("words").cast("long").alias("n_words"),
        F.transform(_runs(F.col("words"), longest), number).alias("places"),
    )


def bucket_counts(texts: DataFrame, text_col: str = "text", longest: int = 1, buckets: int = BUCKETS) -> list[int]:
    """How many features of all ``texts`` fall into each bucket."""
    placed = _bucketed(texts, text_col, longest, buckets).select(F.explode("places").alias("place"))
    out = [0] * buckets
    # one row per bucket at most
    for r in placed.groupBy("place").agg(F.count(F.lit(1)).alias("n")).collect():
        out[r.place] = r.n
    return out


def gains(corpus: list[int], target: list[int]) -> list[int]:
    """Thousandths of the log ratio of target to corpus frequency, by bucket."""
    n, s_all, t_all = len(corpus), sum(corpus), sum(target)
    return [
        math.floor(1000 * math.log(float((t + 1) * (s_all + n)) / float((s + 1) * (t_all + n))))
        for s, t in zip(corpus, target)
    ]


def score(
    docs: DataFrame,
    gain: list[int],
    seed: int,
    text_col: str = "text",
    id_col: str = "doc_id",
    longest: int = 1,
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every row."""
    own = F.col(id_col).cast("long").alias("doc_id")
    # a foldable text: the plan holds the array as one literal
    table = F.split(F.lit(",".join(map(str, gain))), ",").cast("array<long>")
    placed = _bucketed(docs, text_col, longest, len(gain), own)
    weight = F.aggregate("places", F.lit(0).cast("long"), lambda sum_, p: sum_ + F.get(table, p))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    draw = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")
    return placed.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_features"), weight.alias("weight")
    ).withColumn("score", F.col("weight") + draw)


def _bisect(rows: DataFrame, test, low: int, high: int, wanted: int) -> int:
    """The greatest number below ``high`` for which ``test(number)`` holds for ``wanted`` rows.

    ``test`` holds for fewer rows the greater the number, and for enough at ``low``.
    """
    while high - low > 1:
        gap = high - low
        probes = sorted({low + gap * i // (PROBES + 1) for i in range(1, PROBES + 1)} - {low})
        found = rows.agg(*[F.count_if(test(p)).alias(f"at_{i}") for i, p in enumerate(probes)]).first()
        for p, n in zip(probes, found):
            if n >= wanted:
                low = p
            else:
                high = p
                break
    return low


def cutoff(scored: DataFrame, wanted: int) -> tuple[int, int]:
    """(score, doc_id) of the ``wanted``-th row by falling score, then rising doc_id."""
    ends = scored.agg(F.min("score").alias("low"), F.max("score").alias("high")).first()
    last = _bisect(scored, lambda p: F.col("score") >= p, ends.low, ends.high + 1, wanted)
    tied = scored.filter(F.col("score") == last)
    above = scored.filter(F.col("score") > last).count()
    ends = tied.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).first()
    # ids are mirrored, so that here too a greater number takes fewer rows
    found = _bisect(tied, lambda p: F.col("doc_id") <= F.lit(-p), -ends.high, 1 - ends.low, wanted - above)
    return last, -found


def resample(
    docs: DataFrame,
    target: DataFrame,
    per_cent: int = 10,
    min_words: int = 20,
    seed: int = 2024,
    longest: int = 1,
    buckets: int = BUCKETS,
    text_col: str = "text",
    id_col: str = "doc_id",
    target_text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row; rank is NULL for those not drawn.

    Of the rows with ``min_words`` words, ``per_cent`` of a hundred are drawn (rounded down).
    """
    gain = gains(
        bucket_counts(docs, text_col, longest, buckets),
        bucket_counts(target, target_text_col, longest, buckets),
    )
    scored = score(docs, gain, seed, text_col, id_col, longest)
    # the place tells equal rows apart once it is written
    scored = stored(scored.withColumn("place", F.monotonically_increasing_id()), "scores")
    columns = ["doc_id", "n_features", "weight", "score"]
    eligible = F.col("score").isNotNull() & (F.col("n_words") >= min_words)
    wanted = per_cent * scored.filter(eligible).count() // 100
    nobody = F.lit(None).cast("long").alias("rank")
    if wanted == 0:
        return scored.select(*columns, nobody)
    last, last_id = cutoff(scored.filter(eligible), wanted)
    tied = (F.col("score") == last) & (F.col("doc_id") <= last_id)
    drawn = F.coalesce(eligible & ((F.col("score") > last) | tied), F.lit(False))
    ranked = _ranked(scored.filter(drawn), wanted)
    return scored.filter(~drawn).select(*columns, nobody).unionByName(ranked.select(*columns, "rank"))


def _ranked(drawn: DataFrame, wanted: int) -> DataFrame:
    """``drawn`` with rank; rows of a repeated id at the cutoff beyond ``wanted`` get none."""
    spark = drawn.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("score").desc(), F.col("doc_id"), F.col("n_features"), F.col("place")]
    dealt = drawn.repartitionByRange(width, *order).withColumn("part", F.spark_partition_id())
    dealt = stored(dealt, "drawn")
    before, offsets = 0, []
    # a row per range, of which there are `width` at most
    for r in dealt.groupBy("part").agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect():
        offsets.append((r.part, before))
        before += r.n
    starts = F.broadcast(spark.createDataFrame(offsets, "part int, start long"))
    own = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    numbered = dealt.withColumn("own", own).join(starts, "part")
    rank = F.col("own") + F.col("start")
    return numbered.withColumn("rank", F.when(rank <= wanted, rank).cast("long"))
