"""Quality rules: a threshold table compiled into one Spark projection.

Every rule is a row ``Rule(name, metric, low, high)``; ``metric`` names a column
expression of ``METRICS``. ``compile_rules`` turns the table into one boolean column, so
Catalyst sees plain built-in functions and no user function runs.

Defined edge cases: a null text counts as an empty one (no words, base_failed, not kept);
other columns may be null or clash with the metric names (input columns other than the key
and the text are dropped by ``measure`` unless named in ``carry``); repeated rows are
measured one by one; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"

# Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to in is that for it as with was on be by this are from or an at not "
    "le la les de des du et en un une que qui dans est pour par sur au avec ne pas "
    "der die das und ist von zu den mit im ein eine nicht auf für sich dem auch es "
    "el los las y que una por con para se su al lo como más del"
).split()


@dataclass(frozen=True)
class Rule:
    name: str
    metric: str
    low: float | None = None
    high: float | None = None


#: The production table; bounds are inclusive.
RULES = (
    Rule("enough words", "n_words", low=50),
    Rule("word length", "mean_word_chars", low=2, high=20),
    Rule("symbols per word", "symbols_per_word", high=0.25),
    Rule("stop words", "stop_ratio", low=0.03),
    Rule("repeated lines", "dup_line_ratio", high=0.5),
    Rule("capitals", "capital_ratio", high=0.5),
    Rule("repeated word windows", "repeat_ratio", high=0.5),
)


def _ratio(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))


METRICS = {
    "n_words": F.col,
    "mean_word_chars": lambda _: _ratio("word_chars", "n_words"),
    "symbols_per_word": lambda _: _ratio("n_symbols", "n_words"),
    "stop_ratio": lambda _: _ratio("n_stop_words", "n_words"),
    "dup_line_ratio": lambda _: _ratio("n_dup_lines", "n_lines"),
    "capital_ratio": lambda _: _ratio("n_capitals", "word_chars"),
    "repeat_ratio": lambda _: _ratio("n_repeat_words", "n_words"),
}


def compile_rules(rules=RULES) -> Column:
    """One boolean column: every rule of the table holds."""
    kept = F.lit(True)
    for r in rules:
        value = METRICS[r.metric](r.metric)
        if r.low is not None:
            kept = kept & (value >= F.lit(r.low))
        if r.high is not None:
            kept = kept & (value <= F.lit(r.high))
    return kept


def measure(docs: DataFrame, text: str = "text", key: str = "doc_id", carry: tuple[str, ...] = ()) -> DataFrame:
    """key, ``carry`` columns and the counts that the rules are made of, row by row and without a shuffle."""
    words, hashes, ordered, spots = (F.col(c) for c in ("__words", "__hashes", "__ordered", "__spots"))
    keep = [key, *carry]
    counts = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_capitals", "n_stop_words"]
    stops = sorted({v for w in STOP_WORDS for v in (w, w.capitalize())})

    split = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("__text")).select(
        *keep,
        F.array_remove(F.split("__text", SPACE), "").alias("__words"),
        F.filter(F.split("__text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("__lines"),
        F.regexp_count("__text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace("__text", "[^A-Z]+", "")).cast("long").alias("n_capitals"),
    )
    counted = split.select(
        *keep,
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        "n_symbols",
        F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        "n_capitals",
        F.size(F.filter(words, lambda w: w.isin(stops))).cast("long").alias("n_stop_words"),
        # a hash for each window of three words; the last two places have none
        F.slice(
            F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))),
            F.lit(1),
            F.greatest(F.size(words) - 2, F.lit(0)),
        ).alias("__hashes"),
    )
    # Only a text with a repeated window pays for the sort that finds where they are.
    sorted_ = counted.select(
        *keep,
        *counts,
        F.when(
            F.size(F.array_distinct(hashes)) < F.size(hashes),
            F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ).alias("__ordered"),
    )
    placed = sorted_.select(
        *keep,
        *counts,
        F.sort_array(
            F.transform(
                F.filter(
                    ordered,
                    lambda x, k: (x["h"] == F.get(ordered, k - 1)["h"]) | (x["h"] == F.get(ordered, k + 1)["h"]),
                ),
                lambda x: x["i"],
            )
        ).alias("__spots"),
    )
    # A window covers three words, or as many as lie before the next repeated window. The partition number keeps
    # filters on the result above this projection; pushed below it, they would repeat all that it is made of.
    return placed.select(
        *keep,
        *counts,
        F.when(F.spark_partition_id() >= 0, F.coalesce(
            F.aggregate(
                F.transform(spots, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(spots, k + 1) - x, F.lit(3)))),
                F.lit(0).cast("long"),
                lambda a, x: a + x,
            ),
            F.lit(0).cast("long"),
        )).alias("n_repeat_words"),
    )


def judge(measured: DataFrame, rules=RULES) -> DataFrame:
    """Adds base_failed and kept."""
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return measured.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & compile_rules(rules))


def quality(docs: DataFrame, rules=RULES, text: str = "text", key: str = "doc_id") -> DataFrame:
    """A row for each document: the counts, base_failed and kept."""
    return judge(measure(docs, text, key), rules)


def keep_good(docs: DataFrame, rules=RULES, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The documents that all rules accept, with their own columns; a map-only stage."""
    row = "__row"
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row))
    named = packed.select(row, F.col(row)[key].alias("__key"), F.col(row)[text].alias("__body"))
    return judge(measure(named, "__body", "__key", carry=(row,)), rules).where("kept").select(f"{row}.*")
