"""Routing, prompts, payloads and answers."""

from __future__ import annotations

from collections import Counter

from pyspark import TaskContext
from pyspark.sql import functions as F

from quire.functions.dates import (
    fill_template,
    filing_due,
    is_recent,
    is_upcoming,
    same_financial_year,
    same_quarter,
    temporal_context,
)
from quire.functions.payloads import chat_payload, payload_answer
from quire.operators import answers, reports
from quire.plans.corpus import BRIEF_CHARS, analysis, markdown, pagetext, routed, with_tables
from quire.plans.registry import query
from quire.sources.tables import read_parquet

ANALYSIS = with_tables("analysis")
TODAY = "1998-08-01"
TEMPLATE = "Today is {current_date}, a {current_day}, in {current_quarter} of {financial_year}. {season_context}."
QUESTION = "What is this document about?"
ROLE = "You answer questions about the document below."


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


@query(
    "run_summary",
    ANALYSIS
    + """SELECT processing_category, count(*) AS total_docs, count(result) AS successful,
  count(*) - count(result) AS failed, round(count(result) * 100.0::DOUBLE / count(*), 2) AS success_rate,
  round(avg(estimated_tokens), 4) AS avg_tokens, round(avg(file_size_mb), 6) AS avg_size_mb
FROM analysis GROUP BY processing_category""",
)
def run_summary(spark, sf):
    return reports.run_summary(analysis(spark, sf))


@query(
    "run_failures",
    ANALYSIS
    + """SELECT processing_category, count(*) AS failed_count, round(avg(estimated_tokens), 4) AS avg_tokens,
  round(avg(file_size_mb), 6) AS avg_size_mb FROM analysis WHERE result IS NULL GROUP BY processing_category""",
)
def run_failures(spark, sf):
    return reports.run_failures(analysis(spark, sf))


@query(
    "sample_answers",
    ANALYSIS
    + """SELECT file_name, processing_category, estimated_tokens, file_size_mb, substr(result, 1, 200) AS analysis_preview
FROM analysis WHERE result IS NOT NULL ORDER BY estimated_tokens, file_name LIMIT 10""",
)
def sample_answers(spark, sf):
    return answers.sample_answers(analysis(spark, sf))


@query(
    "flatten_answers",
    ANALYSIS
    + """SELECT 'doc_' || sha256(file_path || '|' || result) AS id, file_path, file_name, character_count,
  estimated_tokens, file_size_bytes, file_size_mb, processing_category, result AS analysis_result,
  error AS analysis_error_message, 'text' AS model_used
FROM analysis WHERE result IS NOT NULL AND result <> ''""",
)
def flatten_answers(spark, sf):
    return answers.flatten_answers(analysis(spark, sf)).drop("processed_at")


@query(
    "failed_answers",
    ANALYSIS + "SELECT file_name, error AS analysis_error_message FROM analysis WHERE result IS NULL",
)
def failed_answers(spark, sf):
    return answers.failed_rows(analysis(spark, sf)).select(
        "file_name", F.col("analysis_result.errorMessage").alias("analysis_error_message")
    )


@query(
    "route_prompts",
    ANALYSIS
    + f"""SELECT file_name, processing_category, estimated_tokens, CASE WHEN processing_category = 'SMALL_DOC'
  THEN {_text(answers.FULL_HEAD)} || markdown_content || {_text(answers.FULL_TAIL)}
  ELSE {_text(answers.BRIEF_HEAD)} || left(markdown_content, {BRIEF_CHARS}) || {_text(answers.BRIEF_NOTE)}
    || {_text(answers.BRIEF_TAIL)} END AS prompt FROM analysis""",
)
def route_prompts(spark, sf):
    return routed(spark, sf).select("file_name", "processing_category", "estimated_tokens", "prompt")


@query(
    "model_answers",
    ANALYSIS
    + """SELECT file_name, CASE WHEN character_count >= 500 THEN 'words: ' || len(string_split(prompt, ' ')) END AS result,
  CASE WHEN character_count < 500 THEN 'ValueError: too short' END AS error FROM (
  SELECT *, markdown_content AS prompt FROM analysis)""",
)
def model_answers(spark, sf):
    """A caller's function in place of a model; short texts make it fail."""

    def model(text: str) -> str:
        if len(text) < 500:
            raise ValueError("too short")
        return f"words: {len(text.split(' '))}"

    rows = routed(spark, sf).drop("prompt")
    return answers.call_model(rows, model, prompt="markdown_content").select(
        "file_name",
        F.col("analysis_result.result").alias("result"),
        F.col("analysis_result.errorMessage").alias("error"),
    )


class WordClient:
    """Stands in for a model's client: it knows how often its task set one up, and fails calls with a short text."""

    set_ups: Counter = Counter()

    def __init__(self) -> None:
        task = TaskContext.get()
        self.task = (task.stageId(), task.taskAttemptId())
        self.set_ups[self.task] += 1

    def __call__(self, texts: list[str]) -> list[str | Exception]:
        if any(len(t) < 100 for t in texts):
            raise ConnectionError("a text is too short")
        short = ValueError("too short")
        return [short if len(t) < 500 else f"words: {len(t.split(' '))}, set-ups: {self.set_ups[self.task]}" for t in texts]


@query(
    "client_answers",
    ANALYSIS
    + """SELECT file_name, CASE WHEN character_count >= 500
    THEN 'words: ' || len(string_split(markdown_content, ' ')) || ', set-ups: 1' END AS result,
  CASE WHEN character_count < 100 THEN 'ConnectionError: a text is too short'
    WHEN character_count < 500 THEN 'ValueError: too short' END AS error FROM analysis""",
)
def client_answers(spark, sf):
    """One client a task, asked for many prompts at once; a failing call loses no answer of its other prompts."""
    rows = routed(spark, sf).drop("prompt")
    return answers.call_client(rows, WordClient, prompt="markdown_content").select(
        "file_name",
        F.col("analysis_result.result").alias("result"),
        F.col("analysis_result.errorMessage").alias("error"),
    )


@query(
    "context_prompt",
    with_tables("pagetext")
    + f"""SELECT doc_id, count(*) AS pages_used, {_text(ROLE)} || chr(10) || chr(10)
  || string_agg(ocr_text, chr(10) ORDER BY page_number) || chr(10) || chr(10) || {_text(QUESTION)} AS prompt
FROM pagetext WHERE page_number <= 10 GROUP BY doc_id""",
)
def context_prompt(spark, sf):
    return answers.context_prompt(pagetext(spark, sf), QUESTION, ROLE)


@query(
    "chat_payload",
    """SELECT page_id, 'model' AS model, 'user' AS role,
  'data:image/jpeg;base64,' || to_base64(encode(html)) AS image_url, url AS prompt, 4096 AS max_tokens,
  0.0::DOUBLE AS temperature FROM pages""",
)
def payloads(spark, sf):
    """Payload built as JSON, then its fields read back."""
    rows = read_parquet(spark, sf, "pages").select(
        "page_id", chat_payload("url", F.encode("html", "UTF-8")).alias("payload")
    )

    def read(path, kind="string"):
        return F.get_json_object("payload", path).cast(kind)

    return rows.select(
        "page_id",
        read("$.model").alias("model"),
        read("$.messages[0].role").alias("role"),
        read("$.messages[0].content[0].image_url.url").alias("image_url"),
        read("$.messages[0].content[1].text").alias("prompt"),
        read("$.max_tokens", "int").alias("max_tokens"),
        read("$.temperature", "double").alias("temperature"),
    )


@query(
    "payload_answer",
    with_tables("pagetext")
    + """SELECT doc_id, page_number, CASE WHEN page_number <> 2 THEN ocr_text END AS ocr_text,
  CASE WHEN page_number = 2 THEN 'no choices' END AS "errorMessage" FROM pagetext""",
)
def payload_answers(spark, sf):
    """Second pages get a response without choices."""
    choice = F.struct(F.struct(F.col("ocr_text").alias("content")).alias("message"))
    bodies = pagetext(spark, sf).select(
        "doc_id",
        "page_number",
        F.when(F.col("page_number") == 2, F.lit('{"choices": []}'))
        .otherwise(F.to_json(F.struct(F.array(choice).alias("choices"))))
        .alias("body"),
    )
    error = F.when(payload_answer("body").isNull(), F.lit("no choices"))
    return answers.read_answers(
        bodies.withColumn("error", error), "body", ["doc_id", "page_number"], "error"
    )


CONTEXT_SQL = """SELECT o_orderkey, strftime(o_orderdate, '%B %d, %Y') AS "current_date",
  dayname(o_orderdate) AS current_day, 'Q' || quarter(o_orderdate) || ' ' || year(o_orderdate) AS current_quarter,
  'FY' || fy || ' (July ' || (fy - 1) || ' - June ' || fy || ')' AS financial_year,
  CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'Summer is a period of low economic activity'
    WHEN month(o_orderdate) IN (3, 4, 5) THEN 'Autumn Business is in full swing'
    WHEN month(o_orderdate) IN (6, 7, 8) THEN 'Winter is when end of financial year happens'
    ELSE 'Spring is when new projects and initiatives typically kick off' END AS season_context
FROM (SELECT *, year(o_orderdate) + CASE WHEN month(o_orderdate) >= 7 THEN 1 ELSE 0 END AS fy FROM orders)"""


@query("temporal_context", CONTEXT_SQL)
def temporal(spark, sf):
    columns = temporal_context("o_orderdate")
    return read_parquet(spark, sf, "orders").select(
        "o_orderkey", *[c.alias(n) for n, c in columns.items()]
    )


@query(
    "temporal_prompt",
    f"""SELECT o_orderkey, 'Today is ' || current_date || ', a ' || current_day || ', in ' || current_quarter
  || ' of ' || financial_year || '. ' || season_context || '.' AS prompt FROM ({CONTEXT_SQL})""".replace(
        "current_date", "cur_date"
    ),
)
def temporal_prompt(spark, sf):
    prompt = fill_template(TEMPLATE, temporal_context("o_orderdate"))
    return read_parquet(spark, sf, "orders").select("o_orderkey", prompt.alias("prompt"))


@query(
    "date_window",
    f"""WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, DATE '{TODAY}' AS t FROM orders)
SELECT o_orderkey, d BETWEEN t - 30 AND t AS recent, d BETWEEN t AND t + 60 AS upcoming,
  date_trunc('quarter', d) = date_trunc('quarter', t) AS this_quarter,
  year(d) + (month(d) >= 7)::INT = year(t) + (month(t) >= 7)::INT AS this_financial_year,
  t <= d + 45 AS quarterly_open, t <= d + 75 AS half_yearly_open,
  t <= CAST(d + INTERVAL 4 MONTH AS DATE) AS annual_open
FROM o""",
)
def date_window(spark, sf):
    day, today = F.col("o_orderdate").cast("date"), F.lit(TODAY).cast("date")
    return read_parquet(spark, sf, "orders").select(
        "o_orderkey",
        is_recent(day, today).alias("recent"),
        is_upcoming(day, today).alias("upcoming"),
        same_quarter(day, today).alias("this_quarter"),
        same_financial_year(day, today).alias("this_financial_year"),
        (today <= filing_due(day, "quarter")).alias("quarterly_open"),
        (today <= filing_due(day, "half")).alias("half_yearly_open"),
        (today <= filing_due(day, "year")).alias("annual_open"),
    )


@query(
    "extract_udf",
    with_tables("markdown")
    + """SELECT file_name, extraction_success, error_message, character_count, page_count,
  markdown_content FROM markdown""",
)
def extract_udf(spark, sf):
    """The same extraction through a caller's Python parser."""
    from quire.operators.extract import extract_with
    from quire.plans.corpus import store

    rows = extract_with(store(spark, sf), lambda body, name: body.decode("utf-8"))
    return rows.select(
        "file_name", "extraction_success", "error_message", "character_count", "page_count", "markdown_content"
    )


@query(
    "extract_native",
    with_tables("markdown")
    + """SELECT file_name, volume_path, directory, extraction_success, error_message, character_count, page_count,
  round(processing_time_seconds, 6) AS processing_time_seconds, markdown_content FROM markdown""",
)
def extract_native(spark, sf):
    return markdown(spark, sf).select(
        "file_name",
        "volume_path",
        "directory",
        "extraction_success",
        "error_message",
        "character_count",
        "page_count",
        F.round("processing_time_seconds", 6).alias("processing_time_seconds"),
        "markdown_content",
    )


@query(
    "mapped_rows",
    """SELECT page_id, upper(left(url, 5)) AS scheme, length(html) AS characters FROM pages""",
)
def mapped_rows(spark, sf):
    """Caller functions before and after a model call, on Arrow batches."""
    from pyspark.sql import types as T

    schema = T.StructType(
        [
            T.StructField("page_id", T.LongType()),
            T.StructField("scheme", T.StringType()),
            T.StructField("characters", T.LongType()),
        ]
    )
    return answers.map_rows(
        read_parquet(spark, sf, "pages"),
        lambda r: {**r, "scheme": r["url"][:5]},
        lambda r: {"page_id": r["page_id"], "scheme": r["scheme"].upper(), "characters": len(r["html"])},
        schema,
    )


@query(
    "processing_class",
    ANALYSIS
    + """SELECT processing_category, count(*) AS documents, sum(character_count)::BIGINT AS characters
FROM analysis GROUP BY processing_category""",
)
def processing_class(spark, sf):
    return analysis(spark, sf).groupBy("processing_category").agg(
        F.count("*").alias("documents"), F.sum("character_count").alias("characters")
    )
