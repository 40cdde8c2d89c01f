"""Quality rules: one threshold table compiled into one projection.

Every measure and every rule is a Spark column, so a row is judged while it is
scanned, without a shuffle. Defined results: a NULL text counts as an empty one;
an empty text has no words and fails the base; columns of the input that clash
with the names added here are replaced by them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import NOT_BLANK, let, occurrences, spaced

SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEATED = 20  # per cent of the words

# Common function words of the four languages of the corpus.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "is", "for", "that", "was", "with", "on", "this", "are", "as",
    "by", "from", "at", "it", "an", "be", "a", "he", "or",
    "der", "die", "das", "und", "ist", "für", "den", "von", "zu", "mit", "im", "ein", "eine", "auf",
    "des", "nicht", "sich", "auch",
    "le", "la", "les", "de", "des", "et", "un", "une", "est", "dans", "que", "qui", "pour", "par",
    "sur", "du", "au", "en", "il", "elle",
    "el", "los", "las", "y", "del", "una", "por", "con", "no", "se", "lo", "su", "para", "al",
)


@dataclass(frozen=True)
class Rule:
    """``low <= measure <= high`` for documents of at least ``from_words`` words."""

    name: str
    measure: str
    low: float = float("-inf")
    high: float = float("inf")
    from_words: int = 0


# Chosen to keep what people call clean; the base rules catch most repetition.
RULES = (
    Rule("word_length", "mean_word_chars", 2.0, 12.0),
    Rule("symbol_ratio", "symbols_per_word", high=0.2),
    Rule("shouting", "exclamations_per_word", high=0.5),
    Rule("repeated_lines", "dup_line_ratio", high=0.5),
    Rule("stop_words", "stop_word_ratio", 0.01, from_words=100),
)


def window_hashes(tokens: Column) -> Column:
    """A 64-bit hash of every five-word window, by its first word's place."""

    def window(i: Column) -> Column:
        return F.xxhash64(*[F.get(tokens, i + k) for k in range(WINDOW)])

    return F.when(
        F.size(tokens) > WINDOW,
        F.transform(F.sequence(F.lit(0), F.size(tokens) - WINDOW), window),
    ).otherwise(F.array().cast("array<bigint>"))


def repeated_words(hashes: Column) -> Column:
    """How many words lie in a window that occurs at least twice.

    Most texts have no repeated window, which one distinct count shows; only the
    windows of the others are sorted.
    """
    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def twin(p: Column, j: Column, x: Column) -> Column:
        return F.coalesce(F.get(p, j)["h"] == x["h"], F.lit(False))

    def covered(p: Column) -> Column:
        repeated = F.filter(p, lambda x, j: twin(p, j - 1, x) | twin(p, j + 1, x))
        return F.aggregate(
            F.sort_array(F.transform(repeated, lambda x: x["i"])),
            F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
            lambda acc, i: F.struct(
                (acc["n"] + i + WINDOW - F.greatest(acc["end"], i)).alias("n"),
                (i + WINDOW).alias("end"),
            ),
            lambda acc: acc["n"],
        )

    repeats = F.size(F.array_distinct(hashes)) < F.size(hashes)
    return F.when(repeats, let(pairs, covered)).otherwise(0).cast("long")


def measures(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with the counts and ratios that the rules look at."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split("_text", "\n"), lambda line: F.rlike(line, F.lit(NOT_BLANK)))
    # Helper columns: what is used more than once is computed once, in generated code.
    step = df.withColumn("_text", text).withColumn("_spaced", spaced(F.col("_text")))
    step = step.withColumns({"_parts": F.split("_spaced", " "), "_lines": lines})
    step = step.withColumn("_words", F.array_remove("_parts", ""))
    step = step.withColumn("_windows", window_hashes(F.col("_words")))
    stop = F.size(F.filter("_words", lambda w: F.lower(w).isin(*sorted(set(STOP_WORDS)))))
    step = step.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": (F.length("_spaced") - F.size("_parts") + 1).cast("long"),
            "n_symbols": occurrences(F.col("_text"), SYMBOLS),
            "n_exclamations": occurrences(F.col("_text"), "!"),
            "n_lines": F.size("_lines"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": repeated_words(F.col("_windows")),
            "n_stop_words": stop,
        }
    )
    n = F.greatest(F.col("n_words"), F.lit(1))
    return step.withColumns(
        {
            "mean_word_chars": F.col("word_chars") / n,
            "symbols_per_word": F.col("n_symbols") / n,
            "exclamations_per_word": F.col("n_exclamations") / n,
            "dup_line_ratio": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
            "stop_word_ratio": F.col("n_stop_words") / n,
        }
    ).drop("_text", "_spaced", "_parts", "_words", "_lines", "_windows")


def compiled(rules: tuple[Rule, ...] = RULES) -> dict[str, Column]:
    """Each rule as a Boolean column: true where the document breaks it."""
    out = {}
    for r in rules:
        value = F.col(r.measure)
        inside = F.lit(True)
        if r.low != float("-inf"):
            inside = inside & (value >= r.low)
        if r.high != float("inf"):
            inside = inside & (value <= r.high)
        out[r.name] = ~inside & (F.col("n_words") >= r.from_words)
    return out


def judge(df: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``df`` with its measures, ``base_failed``, ``broken`` (rule names) and ``kept``."""
    step = measures(df, text_col)
    broken = F.filter(
        F.array(*[F.when(bad, F.lit(name)) for name, bad in compiled(rules).items()]),
        lambda name: name.isNotNull(),
    )
    base = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words")
    )
    return step.withColumns({"base_failed": base, "broken": broken}).withColumn(
        "kept", ~F.col("base_failed") & (F.size("broken") == 0)
    )
