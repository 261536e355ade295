"""Conversations and request health."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.dates import fill_template, temporal_context
from quire.operators import chat, evaluate, health
from quire.plans.registry import query
from quire.sources.tables import read_parquet

SYSTEM = "You answer from the document archive. Today is {current_date}, {financial_year}."
TODAY = "2024-07-01"
# The test log has minutes between requests, so the time ranges are wider.
THROTTLED_SECONDS = 6 * 3600.0
CALM_SECONDS = 24 * 3600.0


@query(
    "chat_prepare",
    """WITH opening AS (SELECT conv_id, min(turn) AS turn, arg_min(role, turn) AS role
  FROM conversations GROUP BY conv_id)
SELECT conv_id, CASE WHEN role = 'system' THEN turn ELSE turn - 1 END AS turn, 'system' AS role,
  'You answer from the document archive. Today is July 01, 2024, FY2025 (July 2024 - June 2025).' AS text FROM opening
UNION ALL
SELECT c.conv_id, c.turn, c.role, c.text FROM conversations c JOIN opening o USING (conv_id)
WHERE NOT (c.role = 'system' AND c.turn = o.turn)""",
)
def chat_prepare(spark, sf):
    context = temporal_context(F.lit(TODAY).cast("date"))
    return chat.prepare_messages(read_parquet(spark, sf, "conversations"), fill_template(SYSTEM, context))


@query(
    "last_assistant",
    """SELECT conv_id, coalesce(arg_max(text, turn) FILTER (role = 'assistant'), 'No response') AS response
FROM conversations GROUP BY conv_id""",
)
def last_assistant(spark, sf):
    return chat.last_assistant(read_parquet(spark, sf, "conversations"))


@query(
    "chat_overlap",
    r"""SELECT conv_id, round(coalesce(len(list_intersect(q, a))::DOUBLE / nullif(len(q), 0), 0), 6) AS query_relevance,
  round(coalesce(len(list_intersect(a, q))::DOUBLE / nullif(len(a), 0), 0), 6) AS groundedness FROM (
  SELECT conv_id,
    list_distinct(list_filter(string_split_regex(lower(coalesce(arg_max(text, turn) FILTER (role = 'user'), '')), '\s+'), lambda w: w <> '')) AS q,
    list_distinct(list_filter(string_split_regex(lower(coalesce(arg_max(text, turn) FILTER (role = 'assistant'), 'No response')), '\s+'), lambda w: w <> '')) AS a
  FROM conversations GROUP BY conv_id)""",
)
def chat_overlap(spark, sf):
    """Last answers scored against the last questions, which serve as context."""
    rows = chat.last_exchange(read_parquet(spark, sf, "conversations"))
    return evaluate.answer_overlap(rows.withColumn("context_text", F.col("question_text")), ["conv_id"])


def request_log(spark: SparkSession, sf: str) -> DataFrame:
    """Events as a request log: a tenth of the value as seconds, large errors throttled."""
    error = F.col("event_type") == "error"
    return read_parquet(spark, sf, "events").select(
        F.col("user_id").alias("client"),
        F.col("event_id").alias("request_id"),
        "ts",
        (F.col("value") / 10).alias("seconds"),
        (~error).alias("success"),
        (error & (F.col("value") >= 100)).alias("throttled"),
    )


HEALTH = f"""WITH log AS (SELECT user_id AS client, event_id AS request_id, ts, epoch_us(ts) AS at_us,
  value / 10 AS seconds, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS error,
  CASE WHEN event_type = 'error' AND value >= 100 THEN epoch_us(ts) END AS throttled_at FROM events),
figures AS (SELECT client, request_id, at_us, count(*) OVER w AS total_requests, sum(error) OVER w AS errors,
  avg(seconds) OVER (PARTITION BY client ORDER BY ts, request_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS mean_recent,
  (at_us - max(throttled_at) OVER w) / 1000000.0::DOUBLE AS since_throttled
  FROM log WINDOW w AS (PARTITION BY client ORDER BY ts, request_id ROWS UNBOUNDED PRECEDING)),
judged AS (SELECT *, errors / total_requests AS error_rate,
  coalesce(since_throttled < {THROTTLED_SECONDS}, false)
    OR (total_requests > 10 AND errors / total_requests > 0.2)
    OR (total_requests > 5 AND mean_recent > 5.0) AS reduce_now,
  coalesce(since_throttled >= {CALM_SECONDS}, true) AND total_requests > 10 AND mean_recent < 2.0
    AND errors / total_requests < 0.05 AS increase_now FROM figures),
advised AS (SELECT client, request_id, total_requests, errors::BIGINT AS errors, round(error_rate, 6) AS error_rate,
  round(mean_recent, 6) AS mean_recent, round(since_throttled, 6) AS since_throttled,
  CASE WHEN reduce_now THEN 'reduce' WHEN increase_now THEN 'increase' ELSE 'hold' END AS action,
  round(CASE WHEN reduce_now THEN least(2.0::DOUBLE, 0.05::DOUBLE * least(10, errors + 1)) ELSE 0.05::DOUBLE END, 6) AS delay
  FROM judged)
"""


@query("request_health", HEALTH + "SELECT * FROM advised")
def request_health(spark, sf):
    return health.request_health(request_log(spark, sf), THROTTLED_SECONDS, CALM_SECONDS)


@query(
    "health_summary",
    HEALTH
    + """SELECT client, action, count(*) AS requests, round(avg(delay), 6) AS avg_delay
FROM advised GROUP BY client, action""",
)
def health_summary(spark, sf):
    return health.health_summary(
        health.request_health(request_log(spark, sf), THROTTLED_SECONDS, CALM_SECONDS)
    )
