"""Search refinement: frequent words of the hits that the query lacks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.functions.text import is_term, words
from quire.operators.joins import not_in_query

# Words considered and words shown.
CONSIDERED = 10
SHOWN = 5


def refinement_terms(hit_texts: DataFrame, questions: DataFrame) -> DataFrame:
    """Suggested words per question with the refined query.

    ``hit_texts``: question_id, text. Words are counted per question, the ten
    most frequent are kept (ties by word), then words of the question and
    single occurrences drop out and up to five are shown.
    """
    per = W.partitionBy("question_id").orderBy(F.desc("frequency"), "term")
    counted = (
        hit_texts.select("question_id", F.explode_outer(words("text")).alias("term"))
        .filter(is_term("term"))
        .groupBy("question_id", "term")
        .agg(F.count("*").alias("frequency"))
    )
    top = counted.withColumn("_n", F.row_number().over(per)).filter(F.col("_n") <= CONSIDERED).drop("_n")
    own = questions.select("question_id", F.explode(words("question_text")).alias("term")).distinct()
    left = not_in_query(top.filter(F.col("frequency") > 1), own, ["question_id", "term"])
    return (
        left.withColumn("position", F.row_number().over(per).cast("long"))
        .filter(F.col("position") <= SHOWN)
        .join(questions.select("question_id", "question_text"), "question_id")
        .select(
            "question_id",
            "position",
            "term",
            "frequency",
            F.concat_ws(" ", "question_text", "term").alias("refined_query"),
        )
    )
