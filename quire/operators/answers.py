"""Prompts, model calls and the answer contract."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.contracts import ANSWER, FLATTENED_ANALYSIS
from quire.functions.ids import row_key
from quire.functions.payloads import payload_answer
from quire.functions.predicates import has_text
from quire.functions.sizes import (
    SIZE_THRESHOLD_BYTES,
    TOKEN_THRESHOLD,
    document_class,
    estimated_tokens,
    is_small_document,
    megabytes,
)

# Fixed value: characters of a large document that go into its prompt.
BRIEF_CHARS = 300_000
# Prompts a client is asked for at once.
CLIENT_ROWS = 32

# Own wording; callers pass their own templates.
FULL_HEAD = "Summarise the document below.\n\n"
FULL_TAIL = "\n\nGive:\n1. Topics\n2. Findings\n3. Who needs it\n4. Summary\n"
BRIEF_HEAD = "Summarise the opening part of a long document.\n\n"
BRIEF_NOTE = "\n\n[the rest of the document was left out]"
BRIEF_TAIL = "\n\nGive:\n1. Topics\n2. Purpose\n3. Key points\n"


def routed_prompt(
    text="markdown_content",
    characters="character_count",
    size="file_size_bytes",
    token_threshold: float = TOKEN_THRESHOLD,
    size_threshold: int = SIZE_THRESHOLD_BYTES,
    brief_chars: int = BRIEF_CHARS,
) -> Column:
    """Full prompt for a small document, a cut one with a notice otherwise."""
    text = F.col(text) if isinstance(text, str) else text
    small = is_small_document(characters, size, token_threshold, size_threshold)
    return F.when(small, F.concat(F.lit(FULL_HEAD), text, F.lit(FULL_TAIL))).otherwise(
        F.concat(F.lit(BRIEF_HEAD), F.left(text, F.lit(brief_chars)), F.lit(BRIEF_NOTE), F.lit(BRIEF_TAIL))
    )


def route_documents(markdown: DataFrame, keep: list[str] = (), **limits) -> DataFrame:
    """Rows to analyse: sizes, processing category, prompt and ``keep`` columns."""
    thresholds = {k: v for k, v in limits.items() if k in ("token_threshold", "size_threshold")}
    return markdown.filter(
        F.col("extraction_success") & F.col("markdown_content").isNotNull()
    ).select(
        F.col("volume_path").alias("file_path"),
        "file_name",
        "character_count",
        estimated_tokens("character_count").alias("estimated_tokens"),
        "file_size_bytes",
        F.round(megabytes("file_size_bytes"), 2).alias("file_size_mb"),
        document_class("character_count", "file_size_bytes", **thresholds).alias("processing_category"),
        routed_prompt(**limits).alias("prompt"),
        *keep,
    )


def context_prompt(
    pages: DataFrame,
    question: str,
    role: str = "You answer questions about the document below.",
    n: int = 10,
    doc: str = "doc_id",
) -> DataFrame:
    """Per document: role line, the texts of its first ``n`` pages, a question.

    A group holds at most ``n`` rows, as page numbers are unique per document.
    """
    ordered = F.array_sort(F.collect_list(F.struct("page_number", "ocr_text")))
    return (
        pages.filter(F.col("page_number") <= n)
        .groupBy(doc)
        .agg(ordered.alias("_pages"))
        .select(
            doc,
            F.size("_pages").cast("long").alias("pages_used"),
            F.concat(
                F.lit(role + "\n\n"),
                F.array_join(F.transform("_pages", lambda p: p["ocr_text"]), "\n"),
                F.lit("\n\n" + question),
            ).alias("prompt"),
        )
    )


def answer_struct(result, error) -> Column:
    result = F.col(result) if isinstance(result, str) else result
    error = F.col(error) if isinstance(error, str) else error
    return F.struct(result.cast("string").alias("result"), error.cast("string").alias("errorMessage"))


def with_provenance(df: DataFrame, model: str, **constants) -> DataFrame:
    """Constant provenance columns and the time the row is produced."""
    for name, value in constants.items():
        df = df.withColumn(name, F.lit(value))
    return df.withColumn("model_used", F.lit(model)).withColumn("processed_at", F.current_timestamp())


def call_model(df: DataFrame, fn: Callable[[str], str], prompt: str = "prompt", out: str = "analysis_result") -> DataFrame:
    """Answer column from a caller's function; a failing row keeps its error."""
    return call_client(df, lambda: lambda texts: [fn(t) for t in texts], prompt, out, batch_rows=1)


def call_client(
    df: DataFrame,
    connect: Callable[[], Callable[[list[str]], list[str | Exception]]],
    prompt: str = "prompt",
    out: str = "analysis_result",
    batch_rows: int = CLIENT_ROWS,
) -> DataFrame:
    """Answer column from a caller's client, set up once per task and asked for ``batch_rows`` prompts at a time.

    ``connect()`` returns the client: a function from prompts to as many
    answers, where an exception in place of an answer fails that row alone. If a
    call itself fails or gives another number of answers, its prompts are asked
    again one by one, so one bad prompt costs its neighbours no answer. A row
    without a prompt is not sent and has neither answer nor error. Rows keep
    their order; a task holds one Arrow batch of prompts and their answers.
    """

    def ask(client, texts: list[str]) -> list[tuple[str | None, str | None]]:
        try:
            found = list(client(texts))
            if len(found) != len(texts):
                raise ValueError(f"{len(found)} answers to {len(texts)} prompts")
        except Exception as e:  # noqa: BLE001 - errors are data here
            if len(texts) == 1:
                return [(None, f"{type(e).__name__}: {e}")]
            return [ask(client, [t])[0] for t in texts]
        return [(None, f"{type(x).__name__}: {x}") if isinstance(x, Exception) else (x, None) for x in found]

    def run(batches):
        import pandas as pd

        client = connect()
        for prompts in batches:
            rows: list[tuple[str | None, str | None]] = [(None, None)] * len(prompts)
            sent = [i for i, text in enumerate(prompts) if text is not None]
            for lo in range(0, len(sent), batch_rows):
                part = sent[lo : lo + batch_rows]
                for i, answer in zip(part, ask(client, [prompts.iloc[i] for i in part])):
                    rows[i] = answer
            yield pd.DataFrame(rows, columns=["result", "errorMessage"])

    return df.withColumn(out, _iterator_udf(run)(F.col(prompt)))


def _iterator_udf(run):
    """A pandas UDF over the batches of a task."""
    import pandas as pd

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(run, ANSWER)


def map_rows(df: DataFrame, before: Callable[[dict], dict], after: Callable[[dict], dict], schema: T.StructType) -> DataFrame:
    """Pre- and post-process rows of each Arrow batch with caller functions."""

    def run(batches):
        import pandas as pd

        names = [f.name for f in schema.fields]
        for pdf in batches:
            rows = [after(before(r)) for r in pdf.to_dict("records")]
            yield pd.DataFrame(rows, columns=names)

    return df.mapInPandas(run, schema)


def flatten_answers(analysis: DataFrame) -> DataFrame:
    """Flatten the answer struct, keep rows with text, add a content key."""
    flat = analysis.withColumn("analysis_error_message", F.col("analysis_result.errorMessage")).withColumn(
        "analysis_result", F.col("analysis_result.result")
    )
    return (
        flat.filter(has_text("analysis_result"))
        .withColumn("id", row_key("file_path", "analysis_result"))
        .select(*FLATTENED_ANALYSIS.fieldNames())
    )


def read_answers(responses: DataFrame, body: str, keys: list[str], error: str | None = None) -> DataFrame:
    """Answer text of response bodies, with the row's keys and error."""
    return responses.select(
        *keys,
        payload_answer(body).alias("ocr_text"),
        (F.lit(None).cast("string") if error is None else F.col(error)).alias("errorMessage"),
    )


def failed_rows(analysis: DataFrame) -> DataFrame:
    return analysis.filter(F.col("analysis_result.result").isNull())


def succeeded_rows(analysis: DataFrame) -> DataFrame:
    return analysis.filter(F.col("analysis_result.result").isNotNull())


def sample_answers(analysis: DataFrame, n: int = 10, size: int = 200) -> DataFrame:
    """Shortest answered documents with a preview of the answer."""
    return (
        succeeded_rows(analysis)
        .select(
            "file_name",
            "processing_category",
            "estimated_tokens",
            "file_size_mb",
            F.substring("analysis_result.result", 1, size).alias("analysis_preview"),
        )
        .orderBy("estimated_tokens", "file_name")
        .limit(n)
    )
