"""Quality rules as a short-circuit cascade, in column expressions only.

Each rule's cost and its rejections are measured on a bounded sample. Rules run
in the order of rejections per cost, given what earlier rules already rejected;
a row leaves at its first rejection and later rules never look at it.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.clashes import without
from quire.scratch import materialise

SPACE = " \t\n\x0b\x0c\r"
SPACES = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
# Rows on which costs and rejections are measured; they decide the order alone, never a verdict.
SAMPLE_ROWS = 2_000
# Tasks that measure it.
SAMPLE_PARTS = 8


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, and only where the result is needed."""
    return F.element_at(F.transform(F.array(value), use), 1)


def words_of(text: Column) -> Column:
    bare = F.btrim(text, F.lit(SPACE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACES))


def word_chars(text: Column) -> Column:
    return F.length(F.translate(text, SPACE, "")).cast("long")


def symbols(text: Column) -> Column:
    return (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long")


def _filled_lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(SPACE)) != "")


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    return let(_filled_lines(text), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def repeat_words(words: Column, window: int = WINDOW) -> Column:
    """Words that lie in a window found twice or more, each counted once.

    Windows are 64-bit hashes. Only a text that has a repeated window gets the
    sort that finds where they are.
    """

    def hashes(own: Column) -> Column:
        return let(
            F.transform(own, lambda w: F.xxhash64(w)),
            lambda h: F.transform(
                F.sequence(F.lit(0), F.size(own) - window),
                lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(window)]),
            ),
        )

    def covered(windows: Column) -> Column:
        sorted_ = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(p: Column) -> Column:
            twice = F.filter(
                p,
                lambda x, k: (F.get(p, k - 1)["h"].eqNullSafe(x["h"])) | (F.get(p, k + 1)["h"].eqNullSafe(x["h"])),
            )
            return F.sort_array(F.transform(twice, lambda x: x["i"]))

        return let(
            let(sorted_, starts),
            lambda s: F.aggregate(
                F.transform(s, lambda x, k: F.least(F.lit(window), F.coalesce(F.get(s, k + 1) - x, F.lit(window)))),
                F.lit(0).cast("long"),
                lambda total, n: total + n,
            ),
        )

    return let(
        words,
        lambda own: F.when(F.size(own) < window, F.lit(0).cast("long")).otherwise(
            let(
                hashes(own),
                lambda windows: F.when(
                    F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")
                ).otherwise(covered(windows)),
            )
        ),
    )


def features(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and shout_words.

    Computed on the whole text; a null text counts as an empty one. Columns of
    these names are replaced.
    """
    docs = without(docs, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    own = F.coalesce(F.col(text), F.lit(""))
    counted = let(
        words_of(own),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            repeat_words(w).alias("n_repeat_words"),
        ),
    )
    return docs.withColumn("_counted", counted).select(
        *docs.columns,
        "_counted.n_words",
        word_chars(own).alias("word_chars"),
        symbols(own).alias("n_symbols"),
        duplicate_lines(own).alias("n_dup_lines"),
        "_counted.n_repeat_words",
    )


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > 20 * n_words)


@dataclass(frozen=True)
class Rule:
    """``rejects`` is true for a text to be thrown out; it never yields null."""

    name: str
    rejects: Column


def text_rules(text: str = "text") -> list[Rule]:
    """The standard rules, each on the whole text and free of the others' work."""
    own = F.coalesce(F.col(text), F.lit(""))
    size = F.greatest(word_chars(own), F.lit(1))
    n_lines = F.size(_filled_lines(own))
    return [
        Rule("few_words", F.size(words_of(own)) < MIN_WORDS),
        Rule(
            "repeated_words",
            let(words_of(own), lambda w: 100 * repeat_words(w) > 20 * F.size(w)),
        ),
        *method_rules(own, F.size(words_of(own)), size, symbols(own), duplicate_lines(own), n_lines),
    ]


def method_rules(
    own: Column, n_words: Column, size: Column, n_symbols: Column, n_dup_lines: Column, n_lines: Column
) -> list[Rule]:
    """Rules beyond the base ones, on the text and on counts that may be at hand."""
    letters = F.length(F.regexp_replace(own, "[^\\p{L}]+", ""))
    capitals = F.length(F.regexp_replace(own, "[^\\p{Lu}]+", ""))
    return [
        Rule("symbols", 100 * n_symbols > 6 * size),
        Rule("repeated_lines", (n_lines >= 4) & (100 * n_dup_lines > 30 * n_lines)),
        Rule("shouting", own.rlike("\\p{Lu}{3}") & (2 * capitals > letters) & (letters >= 40)),
        Rule("exclamations", 100 * (F.length(own) - F.length(F.replace(own, F.lit("!"), F.lit("")))) > 6 * size),
        Rule("long_words", size > 60 * F.greatest(n_words, F.lit(1))),
    ]


@dataclass(frozen=True)
class Measured:
    """What the sample told about one rule."""

    name: str
    seconds: float
    rejected: int


def measure(
    docs: DataFrame, rules: list[Rule], sample_rows: int = SAMPLE_ROWS, earlier: list[Rule] | None = None
) -> tuple[list[int], list[Measured]]:
    """Order of the rules, and each rule's cost and rejections on a sample of about ``sample_rows``.

    Rows are counted, which reads no column, and each is drawn with the same
    chance, so no more than the sample moves. Rows that ``earlier`` rules reject
    are left out: the others never meet them. The sample is written once. One
    job counts which rules reject together, so that a rule is credited only with
    rows no earlier rule took. An empty sample leaves the given order.
    """
    share = min(1.0, sample_rows / max(1, docs.count()))
    drawn = docs.sample(share, seed=11) if share < 1 else docs
    drawn = drawn.repartition(SAMPLE_PARTS)
    for rule in earlier or []:
        drawn = drawn.where(~rule.rejects)
    drawn = materialise(drawn, "sample")
    marks = [r.rejects.alias(f"r{k}") for k, r in enumerate(rules)]
    groups = drawn.select(*marks).groupBy(*[f"r{k}" for k in range(len(rules))]).count().collect()

    def seconds(column: Column) -> float:
        took = []
        for _ in range(2):
            began = time.perf_counter()
            drawn.agg(F.count_if(column)).collect()
            took.append(time.perf_counter() - began)
        return min(took)

    idle = seconds(F.lit(True))
    costs = [max(seconds(r.rejects) - idle, 1e-4) for r in rules]
    order: list[int] = []
    measured: list[Measured] = []
    left = [(tuple(g)[:-1], g["count"]) for g in groups]
    while len(order) < len(rules):
        took = {k: sum(n for marks_, n in left if marks_[k]) for k in range(len(rules)) if k not in order}
        best = max(took, key=lambda k: (took[k] / costs[k], -costs[k]))
        order.append(best)
        measured.append(Measured(rules[best].name, costs[best], took[best]))
        left = [(m, n) for m, n in left if not m[best]]
    return order, measured


def first_rejection(rules: list[Rule]) -> Column:
    """Name of the first rule that rejects, or null; later rules are not evaluated."""
    column = F.when(rules[0].rejects, F.lit(rules[0].name))
    for rule in rules[1:]:
        column = column.when(rule.rejects, F.lit(rule.name))
    return column


def quality_filter(
    docs: DataFrame, rules: list[Rule] | None = None, sample_rows: int = SAMPLE_ROWS
) -> tuple[DataFrame, list[Measured]]:
    """``docs`` plus ``failed_rule`` (null: kept), and what the sample showed, in the order chosen.

    The set of kept rows does not depend on the order. A null or empty text has
    no words and fails; repeated rows get the same verdict; an empty table gives
    an empty one; other columns pass through, but for a ``failed_rule``, which is
    replaced.
    """
    rules = rules or text_rules()
    order, measured = measure(docs, rules, sample_rows)
    return docs.withColumn("failed_rule", first_rejection([rules[k] for k in order])), measured


def quality_report(docs: DataFrame, id_column: str = "doc_id", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Counts and verdict of every row: the base rules on the counts, then the cascade of the others."""
    own = F.coalesce(F.col("text"), F.lit(""))
    # on the sample each rule pays for all it needs; over the table the counts are at hand
    order, _ = measure(docs.select("text"), text_rules()[2:], sample_rows, text_rules()[:2])
    counted = features(docs.select(F.col(id_column), "text"))
    rules = method_rules(
        own,
        F.col("n_words"),
        F.greatest(F.col("word_chars"), F.lit(1)),
        F.col("n_symbols"),
        F.col("n_dup_lines"),
        F.size(_filled_lines(own)),
    )
    failed = base_failed(F.col("n_words"), F.col("n_repeat_words"))
    return counted.withColumn("base_failed", failed).select(
        id_column,
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        F.when(F.col("base_failed"), F.lit(False))
        .otherwise(first_rejection([rules[k] for k in order]).isNull())
        .alias("kept"),
    )
