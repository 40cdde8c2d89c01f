"""Personal data: exact base patterns, then bootstrapped contextual extraction.

Base entities (e-mail, IP address, card, phone) are regular expressions with a
validity test. They seed the bootstrap: every identifier-like string of the corpus
is a node, every lexical context (two words before; one before and one after) is
another, and an edge counts how often they meet. Scores run over the graph: a
pattern is as reliable as the share of its places that labelled instances take, an
unseen instance of the right shape as the best pattern it stands in. Instances that
reach the score are seeds of the next round, so they support patterns that hold no
base entity. Patterns with a high score and enough different seeds label the unseen
instances in the texts.

Every step is built-in column functions, groupings and joins. Regular expressions
are possessive and begin only where a run begins, so they are linear in the text
and do not recurse. Edges are counted before they are joined, and a frequent
context is only ever summed.

Defined results: a NULL text is an empty one; rows that repeat an id with another
text are told apart by a hash of the text; a row repeated as a whole counts every
time and gets the same result each time; columns of the input that clash with added ones are replaced.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import discard, let, stored

KINDS = ("email", "ip", "card", "phone")
ALPHA = 1.0  # doubt added to every pattern's denominator
ROUNDS = 6
MIN_SCORE = 0.8
MIN_SEEDS = 5

_LOCAL = r"[A-Za-z0-9._%+-]"
# \G lets a match begin right behind the one before; otherwise it begins with its run.
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
# a token with an @ (base entities are masked by it), or one with a digit and the digit groups behind it
_GROUP = r"[0-9][^\s@]*+(?!\S)"
_CANDIDATE = rf"(?<!\S)(?:[^\s@]*+@\S*+|[^\s0-9@]*+{_GROUP}(?: [(+]?{_GROUP})*+)"
_SPAN = "array<struct<start:int,rank:int,end:int,text:string>>"
_FOUND = "array<struct<start:int,end:int,text:string,left:string,right:string>>"


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the digits pass the Luhn test (digits are counted from the right)."""

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 1, twice).otherwise(d)

    places = F.sequence(F.lit(0), F.length(digits) - 1)
    return F.aggregate(places, F.lit(0), add) % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.rlike(m, F.lit(rf"^{_PART}(?:\.{_PART}){{3}}$"))
    n = F.length(_digits(m))
    if kind == "card":
        return F.when(n.between(14, 19), _luhn(_digits(m))).otherwise(False)
    return n.between(10, 15)


def _matches(text: Column, pattern: str, kind: str) -> Column:
    """Valid matches with their places: pieces between matches and matches, added up."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    pairs = F.filter(
        F.arrays_zip(pieces.alias("p"), found.alias("m")), lambda x: x["m"].isNotNull()
    )
    rank = KINDS.index(kind)

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["p"])
        end = start + F.length(x["m"])
        one = F.array(
            F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), x["m"].alias("text"))
        )
        kept = F.when(_valid(kind, x["m"]), F.concat(acc["spans"], one)).otherwise(acc["spans"])
        return F.struct(end.alias("at"), kept.alias("spans"))

    empty = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("spans"))
    spans = F.aggregate(pairs, empty, step, lambda acc: acc["spans"])
    quick = F.contains(text, F.lit("@")) if kind == "email" else F.rlike(text, F.lit("[0-9]"))
    if kind == "phone":
        quick = F.contains(text, F.lit("+"))
    return F.when(quick, spans).otherwise(F.array().cast(_SPAN))


def base_spans(text: Column) -> Column:
    """All base entities, by start, then kind."""
    return F.sort_array(F.concat(*[_matches(text, p, kind) for kind, p in PATTERNS.items()]))


def masked(text: Column, spans: Column) -> Column:
    """``text`` with every character of ``spans`` turned into @, so that places stay."""
    return F.when(F.size(spans) == 0, text).otherwise(
        _replaced(text, spans, lambda s, at: F.repeat(F.lit("@"), s["end"] - at))
    )


def candidates(text: Column) -> Column:
    """Identifier-like strings of a masked text with their places and the words around them."""
    found = F.regexp_extract_all(text, F.lit(_CANDIDATE), F.lit(0))
    pieces = F.split(text, _CANDIDATE, -1)
    after = F.slice(pieces, 2, F.size(pieces))
    triples = F.filter(
        F.arrays_zip(pieces.alias("p"), found.alias("m"), after.alias("n")),
        lambda x: x["m"].isNotNull(),
    )

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["p"])
        end = start + F.length(x["m"])
        one = F.struct(
            start.alias("start"),
            end.alias("end"),
            x["m"].alias("text"),
            F.lower(F.regexp_extract(x["p"], r"(\S+\s+)?(\S+)\s*$", 0)).alias("left"),
            F.lower(F.regexp_extract(x["n"], r"^\s*(\S+)", 1)).alias("right"),
        )
        return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(one)).alias("spans"))

    empty = F.struct(F.lit(0).alias("at"), F.array().cast(_FOUND).alias("spans"))
    spans = F.aggregate(triples, empty, step, lambda acc: acc["spans"])
    return F.when(F.rlike(text, F.lit("[0-9@]")), spans).otherwise(F.array().cast(_FOUND))


@dataclass(frozen=True)
class Settings:
    alpha: float = ALPHA
    rounds: int = ROUNDS
    min_score: float = MIN_SCORE
    min_seeds: int = MIN_SEEDS


def scan(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, _h, base, found): what the regular expressions see in every row; stored."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("_text"))
    text = F.col("_text")
    base = let(
        base_spans(text),
        lambda b: F.struct(b.alias("base"), let(masked(text, b), candidates).alias("found")),
    )
    rows = rows.select("doc_id", F.xxhash64("_text").alias("_h"), base.alias("_all"))
    rows = rows.select("doc_id", "_h", "_all.base", "_all.found")
    return stored(rows, "pii-scan")


def occurrences(scanned: DataFrame) -> DataFrame:
    """One row per identifier-like string: place, instance, contexts, seed kind or NULL."""
    rows = scanned.filter(F.size("found") > 0).select("doc_id", "_h", "base", F.explode("found").alias("c"))
    inside = F.filter("base", lambda s: (s["start"] < F.col("c.end")) & (s["end"] > F.col("c.start")))
    left, right = (F.regexp_replace(f"c.{side}", "@+", "@") for side in ("left", "right"))
    words = F.split(F.trim(F.regexp_replace(left, r"\s+", " ")), " ")
    one = F.element_at(words, -1)
    before = F.when(F.size(words) == 2, F.concat(F.lit("< "), F.concat_ws(" ", words)))
    around = F.when(
        (one != "") & (right != ""), F.concat(F.lit("<> "), one, F.lit(" "), right)
    )
    entity = F.get(inside, F.lit(0))
    return rows.select(
        "doc_id",
        "_h",
        F.col("c.start").alias("start"),
        F.col("c.text").alias("text"),
        F.lower(F.coalesce(entity["text"], F.col("c.text"))).alias("instance"),
        F.array_compact(F.array(before, around)).alias("contexts"),
        entity["rank"].alias("seed"),
    )


def reliable_patterns(seen: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(pattern, kind, score, seeds) of the patterns that may label what they surround."""
    counted = stored(
        seen.select("instance", "seed", F.explode("contexts").alias("pattern"))
        .groupBy("pattern", "instance")
        .agg(F.count(F.lit(1)).alias("n"), F.min("seed").alias("seed")),
        "pii-edges",
    )
    total = counted.groupBy("pattern").agg(F.sum("n").alias("total"))
    # only instances of a kind's shape can be of the kind; all others count in `total` alone
    kinds = F.filter(F.array(*[F.lit(k) for k in range(len(KINDS))]), lambda k: _shaped(k, F.col("instance")))
    kind = F.explode(F.when(F.col("seed").isNotNull(), F.array("seed")).otherwise(kinds))
    named = counted.select("pattern", "instance", "n", "seed", kind.alias("kind"))
    edges = stored(named.join(total, "pattern"), "pii-shaped")
    unseen = edges.filter("seed is null")

    def supported(labels: DataFrame | None) -> DataFrame:
        weighed = edges.withColumn("w", F.when(F.col("seed").isNotNull(), F.lit(1.0)))
        if labels is not None:
            grown = labels.select("instance", "kind", "r")
            weighed = edges.join(grown, ["instance", "kind"], "left").withColumn(
                "w", F.when(F.col("seed").isNotNull(), F.lit(1.0)).otherwise(F.col("r"))
            )
        # sums of fractions differ in their last places from run to run
        score = F.round(F.sum(F.col("n") * F.col("w")) / (F.first("total") + settings.alpha), 9)
        return (
            weighed.filter("w > 0")
            .groupBy("pattern", "kind")
            .agg(score.alias("score"), F.count_if(F.col("w") >= settings.min_score).alias("seeds"))
        )

    patterns = stored(supported(None), "pii-patterns")
    for _ in range(settings.rounds):
        labels = (
            unseen.join(patterns, ["pattern", "kind"])
            .groupBy("instance", "kind")
            .agg(F.max("score").alias("r"))
        )
        earlier, patterns = patterns, stored(supported(labels), "pii-patterns")
        discard(earlier)
    good = (F.col("score") >= settings.min_score) & (F.col("seeds") >= settings.min_seeds)
    return patterns.filter(good).select("pattern", "kind", "score", "seeds")


def _shaped(kind: Column, text: Column) -> Column:
    """Whether an unseen instance looks like its kind, loosely."""
    n = F.length(_digits(text))
    return (
        F.when(kind == 0, F.contains(text, F.lit("@")))
        .when(kind == 1, F.rlike(text, F.lit(r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]")))
        .when(kind == 2, n.between(12, 19) & ~F.contains(text, F.lit("@")))
        .otherwise(n.between(7, 15) & ~F.contains(text, F.lit("@")))
    )


def discovered(scanned: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(_id, _key, added): the spans that contexts add, per row of ``scanned``."""
    seen = occurrences(scanned)
    patterns = reliable_patterns(seen, settings)
    core = r"[A-Za-z0-9+](?:.*[A-Za-z0-9])?"
    found = (
        seen.filter("seed is null")
        .select("doc_id", "_h", "start", "text", F.explode("contexts").alias("pattern"))
        .join(patterns, "pattern")
        .filter(_shaped(F.col("kind"), F.col("text")))
        .groupBy("doc_id", "_h", "start", "text")
        .agg(F.max(F.struct("score", (-F.col("kind")).alias("k"))).alias("best"))
    )
    start = F.col("start") + F.length(F.regexp_extract("text", r"^[^A-Za-z0-9+]*", 0))
    body = F.regexp_extract("text", core, 0)
    span = F.struct(
        start.cast("int").alias("start"),
        (-F.col("best.k")).cast("int").alias("rank"),
        (start + F.length(body)).cast("int").alias("end"),
        body.alias("text"),
    )
    return found.groupBy(F.col("doc_id").alias("_id"), F.col("_h").alias("_key")).agg(
        F.sort_array(F.collect_list(span)).alias("added")
    )


def with_spans(scanned: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``scanned`` with ``spans``: base and added ones, by start, then kind."""
    added = discovered(scanned, settings)
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_key"))
    spans = F.sort_array(F.concat("base", F.coalesce("added", F.array().cast(_SPAN))))
    return scanned.join(added, same, "left").withColumn("spans", spans).drop("_id", "_key", "added")


def spelled(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.element_at(names, s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def _replaced(text: Column, spans: Column, new: Callable[[Column, Column], Column]) -> Column:
    """``text`` with ``new(span, at)`` for what each span adds to those before it, up to ``at``."""

    def step(acc: Column, s: Column) -> Column:
        kept = F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        at = F.greatest(acc["at"], s["start"])
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.concat(acc["out"], kept, new(s, at)).alias("out"),
        )

    return F.aggregate(
        spans,
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        step,
        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))),
    )


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with every span (overlapping ones together) replaced by its kind."""
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    return _replaced(
        text,
        spans,
        lambda s, at: F.when(s["start"] == at, F.element_at(names, s["rank"] + 1)).otherwise(""),
    )


def redact(
    docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", settings: Settings = Settings()
) -> DataFrame:
    """``docs`` with every base and discovered entity replaced in the text."""
    found = with_spans(scan(docs, text_col, id_col), settings).select(
        F.col("doc_id").alias("id"), F.col("_h").alias("key"), "spans"
    )
    # rows without any entity need no partner; repeated rows have the same spans
    found = found.filter(F.size("spans") > 0).dropDuplicates(["id", "key"])
    # one struct, so that no column of the input can clash with the ones added here
    rows = docs.select(
        F.struct(*[F.col(c) for c in docs.columns]).alias("row"),
        F.col(id_col).alias("own"),
        F.coalesce(F.col(text_col), F.lit("")).alias("whole"),
    )
    same = F.col("own").eqNullSafe(F.col("id")) & (F.xxhash64("whole") == F.col("key"))
    new = F.when(F.col("spans").isNull(), F.col("row")[text_col]).otherwise(redacted(F.col("whole"), F.col("spans")))
    out = rows.join(found, same, "left").select("row", new.alias("new"))
    return out.select(
        *[F.col("new").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns]
    )
