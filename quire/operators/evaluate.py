"""Overlap scores for answers and hits.

Four figures in place of a judge model: they count shared words and given
labels, and do not equal a model's judgement.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import words
from quire.scratch import broadcast_if_small


def distinct_words(text) -> Column:
    return F.array_distinct(words(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))))


def share_found(part: Column, whole: Column) -> Column:
    """Share of the words of ``part`` that occur in ``whole``; 0 for no words."""
    return F.coalesce(
        F.try_divide(F.size(F.array_intersect(part, whole)).cast("double"), F.size(part).cast("double")),
        F.lit(0.0),
    )


def answer_overlap(answers: DataFrame, keys: list[str]) -> DataFrame:
    """Query relevance and groundedness of each answer.

    ``answers``: keys, question_text, answer_text, context_text.
    """
    q, a, c = (distinct_words(t) for t in ("question_text", "answer_text", "context_text"))
    return answers.select(
        *keys,
        F.round(share_found(q, a), 6).alias("query_relevance"),
        F.round(share_found(a, c), 6).alias("groundedness"),
    )


def flag_rate(hits: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Per question: labelled hits, share of good ones, share of flagged ones.

    ``hits`` is a materialised result; only the labels of its rows are joined.
    """
    theirs = labels.join(broadcast_if_small(hits.select(key).distinct()), key, "left_semi")
    return (
        hits.join(theirs, key, "left")
        .groupBy("question_id")
        .agg(
            F.count("*").alias("hits"),
            F.count("quality").alias("labelled"),
            F.round(F.avg(F.col("quality").cast("double")), 6).alias("retrieval_relevance"),
            F.round(F.avg(F.col("toxic").cast("double")), 6).alias("flagged_share"),
        )
    )


def recall_at_k(hits: DataFrame, expected: DataFrame, on: list[str]) -> DataFrame:
    """Share of the expected (question, id) pairs among the hits."""
    found = expected.join(hits.select(*on).distinct().withColumn("_hit", F.lit(1)), on, "left")
    return found.groupBy(on[0]).agg(
        F.count("*").alias("expected"),
        F.round(F.avg(F.coalesce("_hit", F.lit(0)).cast("double")), 6).alias("recall"),
    )
