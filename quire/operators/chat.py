"""Conversation preparation and reading."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NO_RESPONSE = "No response"


def prepare_messages(messages: DataFrame, system_text: Column) -> DataFrame:
    """Each conversation starts with a fresh system message.

    ``messages``: conv_id, turn, role, text. An opening system message is
    replaced, otherwise one is put before the first turn; other messages keep
    their turns. The opening rows are found by a pre-aggregated minimum and
    removed by a join on (conversation, turn), so no conversation is gathered.
    """
    system_turn = F.when(F.col("role") == "system", F.col("turn"))
    opening = messages.groupBy("conv_id").agg(
        F.min("turn").alias("turn"),
        F.coalesce(F.min("turn") == F.min(system_turn), F.lit(False)).alias("has_system"),
    )
    replaced = opening.filter("has_system").select("conv_id", "turn")
    fresh = opening.select(
        "conv_id",
        F.when(F.col("has_system"), F.col("turn")).otherwise(F.col("turn") - 1).alias("turn"),
        F.lit("system").alias("role"),
        system_text.alias("text"),
    )
    others = messages.select("conv_id", "turn", "role", "text").join(
        replaced, ["conv_id", "turn"], "left_anti"
    )
    return fresh.unionByName(others)


def last_assistant(messages: DataFrame) -> DataFrame:
    """Last assistant message of each conversation."""
    answer = F.max_by("text", F.when(F.col("role") == "assistant", F.col("turn")))
    return messages.groupBy("conv_id").agg(F.coalesce(answer, F.lit(NO_RESPONSE)).alias("response"))


def last_exchange(messages: DataFrame) -> DataFrame:
    """Last user message and last assistant message of each conversation."""
    return messages.groupBy("conv_id").agg(
        F.max_by("text", F.when(F.col("role") == "user", F.col("turn"))).alias("question_text"),
        F.coalesce(
            F.max_by("text", F.when(F.col("role") == "assistant", F.col("turn"))), F.lit(NO_RESPONSE)
        ).alias("answer_text"),
    )
