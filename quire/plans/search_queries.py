"""Similarity search, two-stage search and reports on hits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.vectors import norm, with_hashed_counts, with_unit
from quire.operators import approximate, evaluate, refine, search, similarity, terms
from quire.operators.answers import flatten_answers
from quire.operators.pages import vector_ready
from quire.plans.corpus import (
    CLOSENESS,
    LIMITS,
    SCORE,
    analysis,
    asked_questions,
    document_index,
    pagetext,
    questions,
    store,
    vectors_sql,
    with_tables,
)
from quire.plans.registry import query
from quire.scratch import checkpoint, materialise, scratch_path
from quire.sources.sinks import export_csv
from quire.sources.tables import read_parquet

QUESTIONS = "SELECT item_id AS question_id, text AS question_text FROM benchmark"
HITS_K = 10


def _embedded(table: str, text: str) -> str:
    return vectors_sql(table, text)


def document_hits(spark: SparkSession, sf: str, k: int = HITS_K) -> DataFrame:
    """Best documents per question with file name and score (k rows each)."""
    index = document_index(spark, sf)
    hits = checkpoint(similarity.top_k(index, questions(spark, sf), k))
    return similarity.with_columns(hits, store(spark, sf), "doc_id", ["file_name", "volume_path", "text"])


HITS_TABLES = {
    "asked": f"SELECT * FROM ({_embedded('(' + QUESTIONS + ')', 'question_text')})",
    "docs": _embedded("store", "text"),
    "hits": f"""SELECT * FROM (SELECT q.question_id, q.question_text, d.doc_id AS id, d.file_name,
    d.volume_path, d.text, {SCORE} AS score,
    row_number() OVER (PARTITION BY q.question_id ORDER BY {CLOSENESS} DESC, d.doc_id) AS rank
  FROM asked q, docs d) WHERE rank <= {HITS_K}""",
}
HITS = with_tables("store", **HITS_TABLES)


@query("document_search", HITS + "SELECT question_id, id, score, rank, file_name FROM hits")
def document_search(spark, sf):
    return document_hits(spark, sf).select("question_id", "id", "score", "rank", "file_name")


# The day the dated search is asked on.
ASKED_ON = "2024-02-10"


@query(
    "dated_search",
    with_tables(
        "store",
        asked=HITS_TABLES["asked"],
        docs=_embedded(
            f"(SELECT * FROM store WHERE modification_time::DATE BETWEEN DATE '{ASKED_ON}' - 30 AND DATE '{ASKED_ON}')", "text"
        ),
    )
    + f"""SELECT question_id, id, score, rank FROM (SELECT q.question_id, d.doc_id AS id, {SCORE} AS score,
  row_number() OVER (PARTITION BY q.question_id ORDER BY {CLOSENESS} DESC, d.doc_id) AS rank
FROM asked q, docs d) WHERE rank <= 5""",
)
def dated_search(spark, sf):
    """Best documents of the last thirty days, from an index in months."""
    docs = store(spark, sf).select(F.col("doc_id").alias("id"), "text", F.to_date("modification_time").alias("day"))
    index = search.write_dated_index(similarity.embed(docs, "text").drop("text"), "day", scratch_path(spark, "dated-index"))
    recent = search.dated(index, "day", F.lit(ASKED_ON).cast("date"), "recent")
    return similarity.top_k(recent, questions(spark, sf), 5)


CENTROIDS = """WITH parts AS (SELECT label, unnest(embedding)::DOUBLE AS x,
    generate_subscripts(embedding, 1) AS i FROM embeddings),
means AS (SELECT label, i, avg(x) AS m FROM parts GROUP BY label, i),
asked AS (SELECT label AS question_id, list(m ORDER BY i) AS v FROM means GROUP BY label),
docs AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)
"""


def centroid_questions(spark, sf) -> DataFrame:
    """One question per label: the mean of its vectors."""
    vectors = read_parquet(spark, sf, "embeddings")
    return similarity.centroids(vectors, "label", "embedding").withColumnRenamed("label", "question_id")


@query(
    "knn_topk",
    CENTROIDS
    + f"""SELECT * FROM (SELECT q.question_id, d.vec_id AS id, {SCORE} AS score,
  row_number() OVER (PARTITION BY q.question_id ORDER BY {CLOSENESS} DESC, d.vec_id) AS rank
FROM asked q, docs d) WHERE rank <= 5""",
)
def knn_topk(spark, sf):
    index = read_parquet(spark, sf, "embeddings")
    return similarity.top_k(index, centroid_questions(spark, sf), 5, "vec_id", "embedding")


@query(
    "knn_in_label",
    CENTROIDS
    + f"""SELECT * FROM (SELECT q.question_id, d.vec_id AS id, {SCORE} AS score,
  row_number() OVER (PARTITION BY q.question_id ORDER BY {CLOSENESS} DESC, d.vec_id) AS rank
FROM asked q JOIN docs d ON d.label = q.question_id) WHERE rank <= 3""",
)
def knn_in_label(spark, sf):
    index = read_parquet(spark, sf, "embeddings")
    asked = centroid_questions(spark, sf).withColumn("own", F.col("question_id"))
    return similarity.within(index, asked, 3, "label", "own", id_col="vec_id", vector="embedding")


# The key of each table as SQL: one bit per plane, the planes drawn by the same rule; as many bits as rows ask for.
_SIGN = f"1 - 2 * ((x * x % {approximate.PRIME}) * {approximate.SECOND} % {approximate.PRIME} % 2)"
LSH_TABLES = f"""n AS (SELECT count(*) AS rows, len(any_value(v)) AS width FROM docs),
b AS (SELECT greatest({approximate.LEAST_BITS}, ceil(log2(rows::DOUBLE / {approximate.KEY_ROWS})))::BIGINT AS bits, width FROM n),
planes AS (SELECT t, j, list({_SIGN} ORDER BY i)::DOUBLE[] AS p FROM (
    SELECT t, j, i, ((t * bits + j) * width + i + 1) * {approximate.FIRST} % {approximate.PRIME} AS x
    FROM b, range({approximate.TABLES}) AS a(t), range(bits) AS c(j), range(width) AS d(i)) GROUP BY t, j),
index_keys AS (SELECT vec_id, t, sum(CASE WHEN list_dot_product(v, p) >= 0 THEN 1::BIGINT << j ELSE 0 END) AS key
  FROM docs, planes GROUP BY vec_id, t),
asked_keys AS (SELECT question_id, t, sum(CASE WHEN list_dot_product(v, p) >= 0 THEN 1::BIGINT << j ELSE 0 END) AS key
  FROM asked, planes GROUP BY question_id, t),
met AS (SELECT DISTINCT question_id, vec_id FROM asked_keys JOIN index_keys USING (t, key)),
"""
LSH_HITS = f"""near AS (SELECT * FROM (SELECT q.question_id, d.vec_id AS id, {SCORE} AS score,
  row_number() OVER (PARTITION BY q.question_id ORDER BY {CLOSENESS} DESC, d.vec_id) AS rank
FROM met m JOIN asked q ON q.question_id = m.question_id JOIN docs d ON d.vec_id = m.vec_id) WHERE rank <= 5)
"""


@query("knn_lsh", CENTROIDS + ", " + LSH_TABLES + LSH_HITS + "SELECT * FROM near")
def knn_lsh(spark, sf):
    """Approximate: only rows sharing a key with the question are scored, each exactly."""
    index = read_parquet(spark, sf, "embeddings")
    return approximate.approximate_top_k(index, centroid_questions(spark, sf), 5, "vec_id", "embedding")


def planted_questions(spark, sf) -> DataFrame:
    """A question near every hundredth vector: every other number is a fifth larger, the others a fifth smaller."""
    index = read_parquet(spark, sf, "embeddings").filter(F.col("vec_id") % 100 == 0)
    moved = F.transform("embedding", lambda x, i: x.cast("double") * F.when(i % 2 == 0, F.lit(1.2)).otherwise(F.lit(0.8)))
    return index.select(F.col("vec_id").alias("question_id"), moved.alias("vector"))


@query(
    "knn_planted",
    "WITH docs AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),\n"
    "asked AS (SELECT vec_id AS question_id, list_transform(v, lambda x, i: x * CASE WHEN i % 2 = 1 THEN 1.2 ELSE 0.8 END) "
    "AS v FROM docs WHERE vec_id % 100 = 0),\n"
    + LSH_TABLES
    + LSH_HITS
    + """SELECT question_id, n.id, score, rank, (SELECT count(*) FROM met m WHERE m.question_id = n.question_id) AS scored
FROM near n""",
)
def knn_planted(spark, sf):
    """Approximate hits of questions whose nearest vector is known, and how many rows were scored for each."""
    index = read_parquet(spark, sf, "embeddings")
    asked = checkpoint(planted_questions(spark, sf))
    written = approximate.write_index(index, scratch_path(spark, "lsh"), "vec_id", "embedding")
    hits = approximate.search_index(written, asked, 5)
    numbered = with_unit(asked.withColumn("asked", F.col("question_id")), "vector", "vector")
    scored = approximate.candidates(written, numbered.select("asked", "vector")).groupBy("asked").count()
    return hits.join(scored, hits["question_id"] == scored["asked"]).select(
        "question_id", "id", "score", "rank", F.col("count").alias("scored")
    )


@query(
    "knn_recall",
    CENTROIDS
    + f"""SELECT label AS question_id, count(*) AS expected, round(avg(CASE WHEN h.id IS NULL THEN 0 ELSE 1 END), 6) AS recall
FROM embeddings e LEFT JOIN (SELECT * FROM (SELECT q.question_id, d.vec_id AS id,
  row_number() OVER (PARTITION BY q.question_id ORDER BY {CLOSENESS} DESC, d.vec_id) AS rank
FROM asked q, docs d) WHERE rank <= 20) h ON h.question_id = e.label AND h.id = e.vec_id GROUP BY label""",
)
def knn_recall(spark, sf):
    """How many of a label's vectors its centroid finds among the best 20."""
    index = read_parquet(spark, sf, "embeddings")
    hits = similarity.top_k(index, centroid_questions(spark, sf), 20, "vec_id", "embedding")
    expected = index.select(F.col("label").alias("question_id"), F.col("vec_id").alias("id"))
    return evaluate.recall_at_k(hits, expected, ["question_id", "id"])


_TERMS = "list_filter(string_split_regex(lower({0}), '\\s+'), lambda w: w <> '')"
TFIDF = f"""WITH counts AS (SELECT doc_id AS id, term, count(*) AS tf FROM (
  SELECT doc_id, unnest({_TERMS.format("text")}) AS term FROM documents) GROUP BY doc_id, term),
rarity AS (SELECT term, ln(((SELECT count(*) FROM documents) + 1)::DOUBLE / (count(*) + 1)) AS idf FROM counts GROUP BY term),
postings AS (SELECT id, term, tf * idf / sqrt(sum((tf * idf) * (tf * idf)) OVER (PARTITION BY id)) AS weight
  FROM counts JOIN rarity USING (term) WHERE idf > 0),
asked AS (SELECT question_id, term, tf * idf / sqrt(sum((tf * idf) * (tf * idf)) OVER (PARTITION BY question_id)) AS own
  FROM (SELECT question_id, term, count(*) AS tf FROM (
    SELECT item_id AS question_id, unnest({_TERMS.format("text")}) AS term FROM benchmark) GROUP BY question_id, term)
  JOIN rarity USING (term) WHERE idf > 0),
scored AS (SELECT question_id, id, round(sum(weight * own), 12) AS s FROM postings JOIN asked USING (term) GROUP BY question_id, id)
SELECT question_id, id, round(s, 6) + 0.0 AS score, rank FROM (SELECT *,
  row_number() OVER (PARTITION BY question_id ORDER BY s DESC, id) AS rank FROM scored) WHERE rank <= 5"""


@query("tfidf_embed_search", TFIDF)
def tfidf_embed_search(spark, sf):
    """Best documents by weighted words, through an inverted index."""
    docs = read_parquet(spark, sf, "documents").select("doc_id", "text")
    return terms.search_terms(terms.term_index(docs, "doc_id", "text"), asked_questions(spark, sf), 5)


@query(
    "embed_text",
    "WITH d AS (" + _embedded("documents", "text") + ")\n"
    + "SELECT doc_id, round(sqrt(list_dot_product(v, v)), 6) AS norm, v[1]::BIGINT AS first_bucket,"
    " v[64]::BIGINT AS last_bucket, list_sum(v)::BIGINT AS words FROM d",
)
def embed_text(spark, sf):
    docs = with_hashed_counts(read_parquet(spark, sf, "documents"), "text", "v").select("doc_id", "v")
    return docs.select(
        "doc_id",
        F.round(norm("v"), 6).alias("norm"),
        F.col("v")[0].cast("long").alias("first_bucket"),
        F.col("v")[63].cast("long").alias("last_bucket"),
        F.aggregate("v", F.lit(0.0), lambda a, x: a + x).cast("long").alias("words"),
    )


# Two-stage search: summaries are the flattened answers, chunks the page texts.
def summary_index(spark, sf) -> DataFrame:
    """The summary index as a written table. Large documents have their name in another field, the largest as source."""
    rows = flatten_answers(analysis(spark, sf))
    small = F.col("processing_category") == "SMALL_DOC"
    large = F.col("estimated_tokens") >= 2 * LIMITS["token_threshold"]
    named = rows.select(
        "id",
        F.when(small, F.col("file_name")).alias("file_name"),
        F.when(~small, F.when(large, F.lit("")).otherwise(F.col("file_name"))).alias("filename"),
        F.col("file_name").alias("source"),
        "analysis_result",
    )
    return materialise(similarity.embed(named, "analysis_result").drop("analysis_result"), "summary-index")


def page_index(spark, sf) -> DataFrame:
    """The page index, written in folders by file."""
    rows = vector_ready(pagetext(spark, sf)).select("id", "source_filename", "ocr_text")
    return similarity.write_keyed_index(
        similarity.embed(rows, "ocr_text"), "source_filename", scratch_path(spark, "page-index")
    )


_KEYWORDS = " OR ".join(f"contains(lower(question_text), '{w}')" for w in search.TEMPORAL_KEYWORDS)


def _by_kind(name: str) -> str:
    return f"CASE WHEN has_temporal THEN {search.TEMPORAL[name]} ELSE {search.PLAIN[name]} END::BIGINT"


PLAN_SQL = ", ".join(f"{_by_kind(n)} AS {n}" for n in search.PLAIN)
TWO_STAGE_TABLES = {
    "asked": f"SELECT *, {PLAN_SQL} FROM (SELECT *, {_KEYWORDS} AS has_temporal FROM "
    f"({_embedded('(' + QUESTIONS + ')', 'question_text')}))",
    "summaries": _embedded(
        "(SELECT 'doc_' || sha256(file_path || '|' || result) AS id, coalesce(nullif(CASE WHEN small THEN file_name END, ''), "
        "nullif(CASE WHEN NOT small THEN CASE WHEN large THEN '' ELSE file_name END END, ''), file_name) AS file_name, result "
        "FROM (SELECT *, processing_category = 'SMALL_DOC' AS small, "
        f"estimated_tokens >= {2 * LIMITS['token_threshold']} AS large FROM analysis) "
        "WHERE result IS NOT NULL AND result <> '')",
        "result",
    ),
    "chunks": _embedded(
        "(SELECT doc_id || '_page_' || page_number AS id, source_filename, ocr_text FROM pagetext)",
        "ocr_text",
    ),
    "stage1": f"""SELECT question_id, file_name, max(score) AS file_score FROM (
    SELECT q.question_id, q.search_k, d.file_name, {CLOSENESS} AS score,
      row_number() OVER (PARTITION BY q.question_id ORDER BY {CLOSENESS} DESC, d.id) AS r
    FROM asked q, summaries d) WHERE r <= search_k GROUP BY question_id, file_name""",
    "files": """SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY file_score DESC, file_name) AS file_rank,
    count(*) OVER (PARTITION BY question_id) AS n_files FROM stage1""",
    "stage2": f"""SELECT q.question_id, q.question_text, q.has_temporal, q.chunk_k, q.max_chunks, f.file_name,
      f.file_rank, f.n_files, d.id, d.ocr_text, {SCORE} AS score,
      row_number() OVER (PARTITION BY q.question_id, f.file_name ORDER BY {CLOSENESS} DESC, d.id) AS chunk_rank
    FROM asked q JOIN files f ON f.question_id = q.question_id AND f.file_rank <= q.max_files
    JOIN chunks d ON d.source_filename = f.file_name""",
    "found": """SELECT * FROM (SELECT question_id, question_text, has_temporal, 'detailed' AS mode,
      row_number() OVER (PARTITION BY question_id ORDER BY file_rank, chunk_rank) AS position,
      file_name, id, ocr_text, score, count(*) OVER (PARTITION BY question_id) AS n_chunks, n_files, max_chunks
    FROM stage2 WHERE chunk_rank <= chunk_k) WHERE position <= max_chunks""",
}
TWO_STAGE = with_tables("analysis", "pagetext", **TWO_STAGE_TABLES)


@query(
    "two_stage_search",
    TWO_STAGE + "SELECT question_id, mode, position, file_name, id, score, n_chunks, n_files FROM found",
)
def two_stage_search(spark, sf):
    asked = search.with_search_plan(questions(spark, sf))
    return search.two_stage_search(summary_index(spark, sf), page_index(spark, sf), asked)


@query(
    "search_block",
    TWO_STAGE
    + """, blocks AS (SELECT question_id, min(n_chunks) AS n_chunks, min(n_files) AS n_files, bool_or(has_temporal) AS recent,
    string_agg('Chunk ' || position || ' (from ' || file_name || '): ' || left(ocr_text, 400) || '...', chr(10)
      ORDER BY position) AS body FROM found GROUP BY question_id),
named AS (SELECT question_id, array_to_string(list_sort(list(file_name)), ', ') AS names FROM files GROUP BY question_id)
SELECT a.item_id AS question_id, CASE WHEN b.question_id IS NULL THEN 'No content found for the files of this question.'
  ELSE 'Found ' || n_chunks || ' chunks from ' || n_files || ' files' || CASE WHEN recent THEN ' (recent first)' ELSE '' END
    || '.' || chr(10) || 'Files: ' || names || chr(10) || chr(10) || body END AS block
FROM benchmark a LEFT JOIN blocks b ON b.question_id = a.item_id LEFT JOIN named n ON n.question_id = a.item_id""",
)
def search_block(spark, sf):
    """A block for every question, naming all files that stage one found."""
    asked = checkpoint(search.with_search_plan(questions(spark, sf)))
    summaries, pages = summary_index(spark, sf), page_index(spark, sf)
    files = search.first_stage(summaries, asked)
    hits = checkpoint(search.two_stage_search(summaries, pages, asked, files))
    every = search.with_search_plan(asked_questions(spark, sf))
    return search.render_hits(every, hits, pages.select("id", F.col("ocr_text").alias("chunk_text")), files)


@query(
    "search_plan",
    f"SELECT question_id, has_temporal, {PLAN_SQL} FROM (SELECT *, {_KEYWORDS} AS has_temporal FROM ({QUESTIONS}))",
)
def search_plan(spark, sf):
    asked = read_parquet(spark, sf, "benchmark").select(
        F.col("item_id").alias("question_id"), F.col("text").alias("question_text")
    )
    return search.with_search_plan(asked).drop("question_text")


@query(
    "search_summary",
    HITS
    + """SELECT question_id, count(*) AS total_results, count(DISTINCT split_part(volume_path, '/', -1)) AS unique_sources,
  any_value(len(list_filter(string_split_regex(lower(question_text), '\\s+'), lambda w: w <> ''))) AS query_terms,
  printf('%.3f', avg(score)) AS avg_relevance FROM hits GROUP BY question_id""",
)
def search_summary(spark, sf):
    return search.search_summary(document_hits(spark, sf), asked_questions(spark, sf), "volume_path")


@query(
    "refine_terms",
    HITS
    + """, words AS (SELECT question_id, unnest(list_filter(string_split_regex(lower(text), '\\s+'), lambda w: w <> '')) AS term
  FROM hits),
counted AS (SELECT question_id, term, count(*) AS frequency FROM words
  WHERE length(term) > 4 AND regexp_full_match(term, '\\p{L}+') GROUP BY question_id, term),
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY frequency DESC, term) AS n
  FROM counted) WHERE n <= 10 AND frequency > 1),
own AS (SELECT question_id, question_text,
  list_filter(string_split_regex(lower(question_text), '\\s+'), lambda w: w <> '') AS ws FROM asked)
SELECT question_id, position, term, frequency, question_text || ' ' || term AS refined_query FROM (
  SELECT t.*, o.question_text, row_number() OVER (PARTITION BY question_id ORDER BY frequency DESC, term) AS position
  FROM top t JOIN own o USING (question_id) WHERE NOT list_contains(o.ws, t.term)) WHERE position <= 5""",
)
def refine_terms(spark, sf):
    hits = document_hits(spark, sf).select("question_id", "text")
    return refine.refinement_terms(hits, asked_questions(spark, sf))


@query(
    "hit_fields",
    HITS
    + """SELECT question_id, rank, field, value,
  CASE WHEN field IN ('text') THEN 'content' WHEN field = 'file_name' THEN 'source'
       WHEN field = 'score' THEN 'score' ELSE 'none' END AS role,
  CASE WHEN field = 'text' THEN 'content' WHEN field = 'id' THEN 'metadata' ELSE 'other' END AS section
FROM (SELECT question_id, rank, unnest(['id', 'file_name', 'text']) AS field,
  unnest([CAST(id AS VARCHAR), file_name, text]) AS value FROM hits)""",
)
def hit_fields(spark, sf):
    hits = document_hits(spark, sf)
    return search.hit_fields(hits, ["question_id", "rank"], ["id", "file_name", "text"])


@query(
    "csv_export",
    HITS + "SELECT CAST(rank AS VARCHAR) AS rank, CAST(question_id AS VARCHAR) AS question_id, "
    "CAST(id AS VARCHAR) AS id, file_name FROM hits",
)
def csv_export(spark, sf):
    """Hits written as CSV and read back."""
    path = scratch_path(spark, "csv")
    hits = document_hits(spark, sf).select("question_id", "rank", "id", "file_name", F.array("score").alias("scores"))
    export_csv(hits, path)
    return spark.read.option("header", True).csv(path)


@query(
    "flag_rate",
    HITS
    + """SELECT question_id, count(*) AS hits, count(quality) AS labelled,
  round(avg(quality), 6) AS retrieval_relevance, round(avg(toxic), 6) AS flagged_share
FROM hits h LEFT JOIN labels l ON l.doc_id = h.id GROUP BY question_id""",
)
def flag_rate(spark, sf):
    hits = similarity.top_k(document_index(spark, sf), questions(spark, sf), HITS_K)
    hits = checkpoint(hits.select("question_id", F.col("id").alias("doc_id")))
    return evaluate.flag_rate(hits, read_parquet(spark, sf, "labels"), "doc_id")


_WORDS = "list_distinct(list_filter(string_split_regex(lower({0}), '\\s+'), lambda w: w <> ''))"


@query(
    "eval_overlap",
    HITS
    + f"""SELECT question_id, round(coalesce(len(list_intersect(q, a))::DOUBLE / nullif(len(q), 0), 0), 6) AS query_relevance,
  round(coalesce(len(list_intersect(a, c))::DOUBLE / nullif(len(a), 0), 0), 6) AS groundedness FROM (
  SELECT question_id, {_WORDS.format("any_value(question_text)")} AS q,
    {_WORDS.format("coalesce(max(CASE WHEN rank = 1 THEN text END), '')")} AS a,
    {_WORDS.format("coalesce(string_agg(CASE WHEN rank BETWEEN 2 AND 4 THEN text END, ' ' ORDER BY rank), '')")} AS c
  FROM hits GROUP BY question_id)""",
)
def eval_overlap(spark, sf):
    """The best hit as the answer, the next three as its context."""
    rank = F.col("rank")
    ordered = F.array_sort(F.collect_list(F.when(rank.between(2, 4), F.struct("rank", "text"))))
    gathered = document_hits(spark, sf).groupBy("question_id").agg(
        F.max(F.when(rank == 1, F.col("text"))).alias("answer_text"),
        F.array_join(F.transform(ordered, lambda x: x["text"]), " ").alias("context_text"),
    )
    answers = asked_questions(spark, sf).join(gathered, "question_id", "left")
    return evaluate.answer_overlap(answers, ["question_id"])
