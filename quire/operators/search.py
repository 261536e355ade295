"""Two-stage search over a table of questions, and reports on its hits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.functions.columns import as_col
from quire.functions.dates import in_window, window_days
from quire.functions.predicates import has_text
from quire.functions.text import base_name, contains_any, first_filled, words
from quire.operators.similarity import RANK_DIGITS, top_k, with_columns
from quire.scratch import checkpoint

# Words that make a question temporal, and the search parameters
# (first-stage hits, files, chunks per file, chunks shown) it then gets.
TEMPORAL_KEYWORDS = [
    "recent",
    "latest",
    "current",
    "soon",
    "upcoming",
    "now",
    "today",
    "this week",
    "this month",
]
PLAIN = {"search_k": 10, "max_files": 5, "chunk_k": 3, "max_chunks": 8}
TEMPORAL = {"search_k": 15, "max_files": 7, "chunk_k": 4, "max_chunks": 10}
FALLBACK_K = 10
FALLBACK_SHOWN = 5
CHUNK_PREVIEW = 400
FALLBACK_PREVIEW = 300
# Column that tells the folders of an index in months.
MONTH = "index_month"

# Fields that may name the file of a summary, the first filled one counts.
FILE_FIELDS = ["file_name", "filename", "source"]

# Name parts that tell the role of a hit's field, in test order.
FIELD_ROLES = {
    "content": ["content", "text", "chunk", "body", "markdown", "analysis_result"],
    "source": ["source", "filename", "file_name", "document", "doc"],
    "page": ["page", "page_number"],
    "score": ["score", "similarity", "relevance", "distance"],
}
FIELD_SECTIONS = {
    "metadata": ["metadata", "timestamp", "size", "id", "type"],
    "content": ["content", "text", "markdown", "ocr"],
}


def is_temporal(question, whole_words: bool = False) -> Column:
    return contains_any(question, TEMPORAL_KEYWORDS, whole_words)


def with_search_plan(questions: DataFrame, text: str = "question_text", whole_words: bool = False) -> DataFrame:
    """Temporal flag and the search parameters that follow from it."""
    flag = is_temporal(text, whole_words)
    chosen = [
        F.when(F.col("has_temporal"), F.lit(TEMPORAL[n])).otherwise(F.lit(PLAIN[n])).cast("long").alias(n)
        for n in PLAIN
    ]
    return questions.withColumn("has_temporal", flag).select("*", *chosen)


def write_dated_index(index: DataFrame, day: str, path: str) -> DataFrame:
    """Writes an index in folders by the month of a date column and returns it as read back, with ``index_month``."""
    rows = index.withColumn(MONTH, F.trunc(day, "month")).hint("rebalance", MONTH)
    rows.write.partitionBy(MONTH).parquet(path)
    return index.sparkSession.read.schema(rows.schema).parquet(path)


def dated(index: DataFrame, day: str, today: Column, window: str | None) -> DataFrame:
    """Rows of a relative-date window (``dates.in_window``), before any of them is scored; without one, all rows.

    Of an index in months (``write_dated_index``) only the window's folders are
    read. ``today`` is a constant date. A row without a date is in no window.
    """
    if window is None:
        return index
    rows = index.filter(in_window(day, today, window))
    if MONTH not in index.columns:
        return rows
    first, last = window_days(today, window)
    return rows.filter(F.col(MONTH).between(F.trunc(first, "month"), F.trunc(last, "month")))


def relevant_files(hits: DataFrame) -> DataFrame:
    """Distinct files per question, best score first, then by name."""
    per = W.partitionBy("question_id")
    best = hits.groupBy("question_id", "file_name").agg(F.max("score").alias("file_score"))
    return best.select(
        "question_id",
        "file_name",
        F.row_number().over(per.orderBy(F.desc("file_score"), "file_name")).cast("long").alias("file_rank"),
        F.count("*").over(per).alias("n_files"),
    )


def first_stage(summaries: DataFrame, questions: DataFrame) -> DataFrame:
    """Files found through the summaries: question_id, file_name, file_rank, n_files.

    ``summaries`` has id, vector and some of ``FILE_FIELDS``, the first filled of
    which names the file. The result holds at most ``search_k`` rows per question
    and is kept in the shared folder, because the second stage and the fallback
    both read it. Files are ordered by the full score of their best hit.
    """
    most = max(PLAIN["search_k"], TEMPORAL["search_k"])
    hits = checkpoint(
        top_k(summaries, questions, most, digits=RANK_DIGITS)
        .join(questions.select("question_id", "search_k"), "question_id")
        .filter(F.col("rank") <= F.col("search_k"))
        .select("question_id", "id", "score")
    )
    name = first_filled(*[c for c in FILE_FIELDS if c in summaries.columns])
    named = with_columns(hits, summaries.select("id", name.alias("file_name")), "id", ["file_name"])
    return checkpoint(relevant_files(named.filter(has_text("file_name"))))


def two_stage_search(
    summaries: DataFrame, pages: DataFrame, questions: DataFrame, files: DataFrame | None = None
) -> DataFrame:
    """Best page chunks within the files that the summaries point to.

    ``summaries``: id, file_name (or another of ``FILE_FIELDS``), vector. ``pages``: id, source_filename,
    vector; written in key folders (``similarity.write_keyed_index``), only the folders of the files found are read. ``questions``: question_id, vector and the columns of
    ``with_search_plan``. A question without files gets the best pages of the
    whole index instead (mode ``fallback``). ``files``: the result of
    ``first_stage``, if at hand.
    """
    questions = checkpoint(questions)  # read by every step below
    files = first_stage(summaries, questions) if files is None else files
    plan = questions.select("question_id", "max_files", "chunk_k", "max_chunks")
    scoped = (
        files.join(plan, "question_id")
        .filter(F.col("file_rank") <= F.col("max_files"))
        .select("question_id", "file_name", "file_rank", "n_files", "chunk_k", "max_chunks")
    )
    most = max(PLAIN["chunk_k"], TEMPORAL["chunk_k"])
    chunks = (
        top_k(
            pages,
            questions.join(files.select("question_id").distinct(), "question_id", "left_semi"),
            most,
            scope=[(scoped.select("question_id", "file_name"), "source_filename")],
            group="source_filename",
        )
        .withColumnRenamed("source_filename", "file_name")
        .withColumnRenamed("rank", "chunk_rank")
        .join(scoped, ["question_id", "file_name"])
        .filter(F.col("chunk_rank") <= F.col("chunk_k"))
    )
    per = W.partitionBy("question_id")
    order = per.orderBy("file_rank", "chunk_rank")
    detailed = chunks.select(
        "question_id",
        F.lit("detailed").alias("mode"),
        F.row_number().over(order).cast("long").alias("position"),
        "file_name",
        "id",
        "score",
        F.count("*").over(per).alias("n_chunks"),
        "n_files",
        "max_chunks",
    ).filter(F.col("position") <= F.col("max_chunks"))

    found = detailed.drop("max_chunks")
    rest = questions.join(files, "question_id", "left_anti")
    if rest.isEmpty():
        return found
    wide = checkpoint(top_k(pages, rest, FALLBACK_K))
    unscoped = (
        with_columns(wide, pages.withColumnRenamed("source_filename", "file_name"), "id", ["file_name"])
        .select(
            "question_id",
            F.lit("fallback").alias("mode"),
            F.col("rank").alias("position"),
            "file_name",
            "id",
            "score",
            F.count("*").over(per).alias("n_chunks"),
            F.lit(0).cast("long").alias("n_files"),
        )
        .filter(F.col("position") <= FALLBACK_SHOWN)
    )
    return found.unionByName(unscoped)


def render_hits(questions: DataFrame, hits: DataFrame, texts: DataFrame, files: DataFrame) -> DataFrame:
    """One text block per question: header, file list, numbered chunks.

    ``hits`` is a materialised result, ``texts`` has id and chunk_text. A question has at most ten chunks, so the
    lists stay short. A question without chunks gets a message. ``files`` is the result of ``first_stage``: the
    list names all files that the header counts.
    """
    size = F.when(F.col("mode") == "fallback", F.lit(FALLBACK_PREVIEW)).otherwise(F.lit(CHUNK_PREVIEW))
    line = F.concat(
        F.lit("Chunk "),
        F.col("position").cast("string"),
        F.lit(" (from "),
        F.coalesce(F.nullif(F.col("file_name"), F.lit("")), F.lit("unknown")),
        F.lit("): "),
        F.left(F.col("chunk_text"), size),
        F.lit("..."),
    )
    blocks = (
        with_columns(hits, texts, "id", ["chunk_text"])
        .select("question_id", "mode", "n_chunks", "n_files", "position", "file_name", line.alias("line"))
        .groupBy("question_id")
        .agg(
            F.first("mode").alias("mode"),
            F.first("n_chunks").alias("n_chunks"),
            F.first("n_files").alias("n_files"),
            F.array_sort(F.collect_list(F.struct("position", "line"))).alias("lines"),
        )
    )
    named = files.groupBy("question_id").agg(F.array_sort(F.collect_set("file_name")).alias("files"))
    blocks = blocks.join(named, "question_id", "left")
    count = F.col("n_chunks").cast("string")
    header = F.when(
        F.col("mode") == "fallback", F.concat(F.lit("Found "), count, F.lit(" chunks in all files."))
    ).otherwise(
        F.concat(
            F.lit("Found "),
            count,
            F.lit(" chunks from "),
            F.col("n_files").cast("string"),
            F.lit(" files"),
            F.when(F.col("has_temporal"), F.lit(" (recent first)")).otherwise(F.lit("")),
            F.lit(".\nFiles: "),
            F.array_join("files", ", "),
        )
    )
    body = F.array_join(F.transform("lines", lambda x: x["line"]), "\n")
    return questions.join(blocks, "question_id", "left").select(
        "question_id",
        F.when(F.col("mode").isNull(), F.lit("No content found for the files of this question."))
        .otherwise(F.concat(header, F.lit("\n\n"), body))
        .alias("block"),
    )


def search_summary(hits: DataFrame, questions: DataFrame, source: str = "file_name") -> DataFrame:
    """Hits, distinct sources, words of the question, average score per question."""
    counted = hits.groupBy("question_id").agg(
        F.count("*").alias("total_results"),
        F.count_distinct(F.nullif(F.trim(base_name(source)), F.lit(""))).alias("unique_sources"),
        F.round(F.avg("score"), 3).alias("avg_score"),
    )
    return questions.join(counted, "question_id", "left").select(
        "question_id",
        F.coalesce("total_results", F.lit(0)).alias("total_results"),
        F.coalesce("unique_sources", F.lit(0)).alias("unique_sources"),
        F.size(words("question_text")).cast("long").alias("query_terms"),
        F.coalesce(F.format_number("avg_score", 3), F.lit("N/A")).alias("avg_relevance"),
    )


def _class_of(name: Column, classes: dict[str, list[str]], other: str) -> Column:
    low = F.lower(name)
    chosen = F.when(F.lit(False), F.lit(""))
    for label, parts in classes.items():
        hit = F.lit(False)
        for part in parts:
            hit = hit | low.contains(part)
        chosen = chosen.when(hit, F.lit(label))
    return chosen.otherwise(F.lit(other))


def hit_fields(hits: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """One row per hit and field: its value as text, its role and its section."""
    entries = F.array(
        *[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields]
    )
    return (
        hits.select(*keys, F.explode(entries).alias("_e"))
        .select(*keys, "_e.field", "_e.value")
        .withColumn("role", _class_of(F.col("field"), FIELD_ROLES, "none"))
        .withColumn("section", _class_of(F.col("field"), FIELD_SECTIONS, "other"))
    )


def numbered(hits: DataFrame, per: list[str], score: str = "score", key: str = "id") -> DataFrame:
    """Rank number of each hit."""
    order = W.partitionBy(*per).orderBy(F.desc(as_col(score)), as_col(key))
    return hits.withColumn("rank", F.row_number().over(order).cast("long"))
