"""License scan: ordered signature rules over words, in column expressions only.

A keyword gate passes over texts, then over rules; only the patterns whose
keyword occurs are run. Overlapping detections are resolved by priority and
containment.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.license_rules import CONFIDENCE, Signature, signatures
from quire.llm.quality import let

# Characters of no word, before and after A-Z become a-z.
NO_WORD = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Phrases of the base labels.
PHRASES = [
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
]
BASE_SCORE = 0.9
# Marks around a detection, characters of no word; detections of a rule that are placed by walking.
BEGIN, END = "\x01", "\x02"
WALKED = 16


def spaced_words(text: Column) -> Column:
    """The words of a text between single blanks, none at the ends; letters as they are."""
    return F.btrim(F.regexp_replace(text, NO_WORD, " "))


def count_words(spaced: Column) -> Column:
    n = F.length(spaced) - F.length(F.replace(spaced, F.lit(" "), F.lit(""))) + 1
    return F.when(spaced == "", F.lit(0)).otherwise(n).cast("long")


def _blanks(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def whole(pattern: str) -> str:
    """A pattern of whole words that leaves the blanks around it to its neighbours."""
    return f"(?<= )(?:{pattern})(?= )"


def places(padded: Column, phrase: str, n_words: Column) -> Column:
    """Number of places of a phrase, its first and its last start in words."""
    size = len(phrase.split(" "))
    return let(
        F.split(padded, whole(phrase), -1),
        lambda p: F.when(
            F.size(p) > 1,
            F.struct(
                (F.size(p) - 1).cast("long").alias("n"),
                (_blanks(F.element_at(p, 1)) - 1).cast("long").alias("first"),
                (n_words - (_blanks(F.element_at(p, -1)) - 1) - size).cast("long").alias("last"),
            ),
        ),
    )


def spans(padded: Column, rule: Column) -> Column:
    """Detections of one rule: word intervals [start, end).

    A few detections are placed by walking along the pieces between them. More
    are marked in the text, whose words are then counted once, as every step of
    a walk copies what was found so far.
    """
    pieces = F.split(padded, rule["pattern"], -1)
    found = F.regexp_extract_all(padded, rule["pattern"], F.lit(0))
    empty = F.array().cast("array<struct<start:int,end:int>>")

    def walked(p: Column, m: Column) -> Column:
        return F.aggregate(
            F.sequence(F.lit(0), F.size(m) - 1),
            F.struct(F.lit(0).alias("at"), empty.alias("out")),
            lambda acc, k: let(
                acc["at"] + _blanks(F.get(p, k)) - 1,
                lambda start: let(
                    start + _blanks(F.get(m, k)) + 1,
                    lambda end: F.struct(
                        end.alias("at"),
                        F.concat(acc["out"], F.array(F.struct(start.alias("start"), end.alias("end")))).alias("out"),
                    ),
                ),
            ),
        )["out"]

    def marked() -> Column:
        text = F.regexp_replace(padded, F.concat(F.lit("("), rule["pattern"], F.lit(")")), F.lit(f"{BEGIN}$1{END}"))
        return let(
            F.split(text, " "),
            lambda words: F.zip_with(
                F.array_compact(F.transform(words, lambda w, i: F.when(w.startswith(BEGIN), i - 1))),
                F.array_compact(F.transform(words, lambda w, i: F.when(w.endswith(END), i))),
                lambda start, end: F.struct(start.alias("start"), end.alias("end")),
            ),
        )

    return let(
        found,
        lambda m: F.when(F.size(m) == 0, empty)
        .when(F.size(m) <= WALKED, let(pieces, lambda p: walked(p, m)))
        .otherwise(marked()),
    )


def _rule_table(rules: list[Signature]) -> Column:
    rows = [
        {"rule": k, "label": r.label, "keyword": " " + r.keyword, "pattern": whole(r.pattern), "priority": r.priority}
        for k, r in enumerate(rules)
    ]
    return F.from_json(
        F.lit(json.dumps(rows)), "array<struct<rule:int,label:string,keyword:string,pattern:string,priority:int>>"
    )


def gate(rules: list[Signature]) -> str:
    """One pattern that finds any keyword at the start of a word; case is ignored for A-Z only.

    Keywords are grouped by their first characters, so that most words fail at
    one or two comparisons.
    """
    heads = sorted({r.keyword for r in rules} | {p for p, _ in PHRASES})
    least = [h for h in heads if not any(o != h and h.startswith(o) for o in heads)]
    groups: dict[str, dict[str, list[str]]] = {}
    for h in least:
        groups.setdefault(h[0], {}).setdefault(h[1], []).append(h[2:])
    inner = {
        a: "|".join(f"{b}(?:{'|'.join(rest)})" for b, rest in sorted(more.items())) for a, more in sorted(groups.items())
    }
    return "(?i) (?:" + "|".join(f"{a}(?:{more})" for a, more in inner.items()) + ")"


def detections(padded: Column, rules: list[Signature]) -> Column:
    """All detections of the rules whose keyword occurs at the start of a word, by start, the longer first.

    Fields are named and signed so that their order is that of the array: of
    equal intervals the higher priority and then the earlier rule comes first.
    """
    passed = F.filter(_rule_table(rules), lambda r: F.contains(padded, r["keyword"]))
    return F.sort_array(
        F.flatten(
            F.transform(
                passed,
                lambda r: F.transform(
                    spans(padded, r),
                    lambda s: F.struct(
                        s["start"].alias("start"),
                        (-s["end"]).alias("minus_end"),
                        (-r["priority"]).alias("minus_priority"),
                        r["rule"].alias("rule"),
                        r["label"].alias("label"),
                    ),
                ),
            )
        )
    )


def surviving(found: Column) -> Column:
    """Labels and highest priority of the sorted detections not contained in another of the same or higher priority.

    A detection is contained in an earlier one of enough priority exactly if the
    furthest end of those is not before its own, so one pass over a text's
    detections decides, keeping one end per priority.
    """
    levels = sorted(CONFIDENCE)
    none = F.array().cast("array<string>")

    def step(acc: Column, d: Column) -> Column:
        end, level = -d["minus_end"], -d["minus_priority"]
        reach = F.lit(None).cast("int")
        for known in levels:
            reach = F.when(level == known, acc[f"reach{known}"]).otherwise(reach)
        stays = reach < end
        return F.struct(
            *[
                F.when(level >= known, F.greatest(acc[f"reach{known}"], end)).otherwise(acc[f"reach{known}"]).alias(f"reach{known}")
                for known in levels
            ],
            F.when(stays, F.array_union(acc["labels"], F.array(d["label"]))).otherwise(acc["labels"]).alias("labels"),
            F.when(stays, F.greatest(acc["level"], level)).otherwise(acc["level"]).alias("level"),
        )

    begin = F.struct(
        *[F.lit(-1).alias(f"reach{known}") for known in levels], none.alias("labels"), F.lit(-1).alias("level")
    )
    return F.aggregate(found, begin, step)


def scan(docs: DataFrame, id_column: str = "doc_id", rules: list[Signature] | None = None) -> DataFrame:
    """One row per document: words, base places and labels, all labels, and a score.

    Words are runs of 0-9, A-Z (as a-z) and characters beyond ASCII. Base
    labels mark phrases that stand word by word in the text; ``n_base`` counts
    their places, ``first_word`` and ``last_word`` are the least and greatest
    start. ``labels`` adds those of the surviving detections. ``score`` is the
    confidence of the surest one, 0 without any. Every row is scanned where it
    lies. A null or empty text has no
    words and no labels (empty strings); repeated rows are scanned each; an
    empty table gives an empty one; other columns are ignored.
    """
    rules = rules if rules is not None else signatures()
    spaced = spaced_words(F.coalesce(F.col("text"), F.lit("")))
    words = docs.select(F.col(id_column).alias("_id"), spaced.alias("_spaced"))
    hit = F.concat(F.lit(" "), F.col("_spaced")).rlike(gate(rules))
    padded = F.concat(F.lit(" "), F.translate("_spaced", UPPER, LOWER), F.lit(" "))
    gated = words.select(
        "_id",
        count_words(F.col("_spaced")).alias("n_words"),
        F.when(hit, padded).alias("_padded"),
    )
    n = F.col("n_words")
    base = F.array(*[places(F.col("_padded"), p, n) for p, _ in PHRASES])
    gated_in = F.col("_padded").isNotNull()
    scanned = gated.select(
        "_id",
        "n_words",
        F.when(gated_in, base).alias("_base"),
        F.when(gated_in, surviving(detections(F.col("_padded"), rules))).alias("_told"),
    )
    confidence = F.lit(0.0)
    for level, value in CONFIDENCE.items():
        confidence = F.when(F.col("_told.level") == level, F.lit(value)).otherwise(confidence)
    held = F.filter("_base", lambda b: b.isNotNull())
    names = F.array(*[F.lit(label) for _, label in PHRASES])
    base_labels = F.filter(
        F.transform("_base", lambda b, k: F.when(b.isNotNull(), F.get(names, k))), lambda x: x.isNotNull()
    )
    none = F.array().cast("array<string>")
    labels = F.coalesce("_told.labels", none)
    return scanned.select(
        F.col("_id").alias(id_column),
        "n_words",
        F.coalesce(F.aggregate(held, F.lit(0).cast("long"), lambda t, b: t + b["n"]), F.lit(0)).alias("n_base"),
        F.array_min(F.transform(held, lambda b: b["first"])).alias("first_word"),
        F.array_max(F.transform(held, lambda b: b["last"])).alias("last_word"),
        F.array_join(F.sort_array(F.coalesce(base_labels, none)), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union(F.coalesce(base_labels, none), labels)), ",").alias("labels"),
        F.greatest(
            F.when(F.size(F.coalesce(base_labels, none)) > 0, F.lit(BASE_SCORE)).otherwise(F.lit(0.0)),
            confidence,
        ).alias("score"),
    )
