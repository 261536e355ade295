"""Reports over the document store and the extraction results."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions.columns import double_round
from quire.functions.dates import iso_text, millis_to_timestamp, stamp_text
from quire.functions.ids import document_id, row_key
from quire.functions.predicates import extractable, is_pdf_body, splittable, status_filter
from quire.functions.sizes import gigabytes, kilobytes, megabytes
from quire.functions.text import (
    base_name,
    extension,
    normalise_path,
    parent_dir,
    preview,
    thousands,
    title_case,
)
from quire.operators import listing, reports
from quire.plans.corpus import LIMITS, ROOT, markdown, store, with_tables
from quire.plans.registry import query
from quire.sources.tables import query as sql_query
from quire.sources.tables import read_parquet

STORE = with_tables("store")
MARKDOWN = with_tables("markdown")

# Class borders at which all three file size classes occur in the test data.
SMALL_BELOW, MEDIUM_BELOW = 1500, 6000


@query(
    "collection_summary",
    STORE
    + """SELECT file_extension, count(*) AS file_count,
  round(sum(file_size_bytes) / 1048576.0::DOUBLE, 2) AS total_mb,
  round(avg(file_size_bytes) / 1024.0::DOUBLE, 2) AS avg_size_kb,
  min(modification_time) AS oldest_file, max(modification_time) AS newest_file
FROM store WHERE binary_content IS NOT NULL GROUP BY file_extension""",
)
def collection_summary(spark, sf):
    return reports.collection_summary(store(spark, sf))


@query(
    "size_validation",
    STORE
    + """SELECT file_name, file_extension, file_size_bytes,
  CASE WHEN binary_content IS NOT NULL THEN 'Yes' ELSE 'No' END AS has_binary_content,
  octet_length(binary_content) AS binary_size_bytes,
  CASE WHEN octet_length(binary_content) = file_size_bytes THEN 'match'
       WHEN binary_content IS NULL THEN 'no content' ELSE 'mismatch' END AS size_validation
FROM store""",
)
def size_validation(spark, sf):
    return reports.size_validation(store(spark, sf))


@query(
    "eligible_docs",
    STORE
    + """SELECT file_name, file_size_bytes, file_size_bytes <= 5000 AS splittable
FROM store WHERE file_extension = '.pdf' AND octet_length(binary_content) > 0""",
)
def eligible_docs(spark, sf):
    return (
        store(spark, sf)
        .filter(extractable())
        .filter(F.octet_length("binary_content") > 0)
        .select("file_name", "file_size_bytes", splittable(max_bytes=5000).alias("splittable"))
    )


@query(
    "list_view",
    MARKDOWN
    + """SELECT file_name, volume_path, file_extension, file_size_bytes, modification_time, directory,
  extraction_success, error_message, character_count, page_count
FROM markdown WHERE NOT extraction_success AND file_extension = '.pdf'""",
)
def list_view(spark, sf):
    rows = reports.list_view(markdown(spark, sf), status_filter("Failed", ".pdf"))
    return rows.drop("processing_time_seconds", "processing_timestamp")


@query(
    "extraction_report",
    MARKDOWN
    + f"""SELECT category, count(*) AS document_count,
  sum(CASE WHEN extraction_success THEN 1 ELSE 0 END)::BIGINT AS successful_extractions,
  round(sum(CASE WHEN extraction_success THEN 1 ELSE 0 END) * 100.0::DOUBLE / count(*), 1) AS success_rate_percent,
  round(sum(character_count) / 1000000.0::DOUBLE, 2) AS total_content_mb_chars,
  round(avg(processing_time_seconds), 3) AS avg_processing_time_sec,
  sum(page_count)::BIGINT AS total_pages_processed
FROM (
  SELECT 'Overall Processing' AS category, * FROM markdown
  UNION ALL
  SELECT 'File Size: ' || CASE WHEN file_size_bytes < {SMALL_BELOW} THEN 'Small (<1MB)'
    WHEN file_size_bytes < {MEDIUM_BELOW} THEN 'Medium (1-10MB)' ELSE 'Large (>10MB)' END, *
  FROM markdown)
GROUP BY category""",
)
def extraction_report(spark, sf):
    return reports.extraction_report(markdown(spark, sf), SMALL_BELOW, MEDIUM_BELOW)


@query(
    "extraction_report_union",
    MARKDOWN
    + """SELECT 'all' AS part, count(*) AS documents FROM markdown
UNION ALL SELECT file_extension, count(*) FROM markdown GROUP BY file_extension""",
)
def extraction_report_union(spark, sf):
    rows = markdown(spark, sf)
    whole = rows.agg(F.count("*").alias("documents")).select(F.lit("all").alias("part"), "documents")
    each = rows.groupBy(F.col("file_extension").alias("part")).agg(F.count("*").alias("documents"))
    return whole.unionByName(each)


@query(
    "extraction_stats",
    MARKDOWN
    + """SELECT count(*) FILTER (extraction_success) AS successful,
  count(*) FILTER (NOT extraction_success) AS failed,
  round(count(*) FILTER (extraction_success) * 100.0::DOUBLE / count(*), 1) AS success_rate,
  sum(character_count) FILTER (extraction_success)::BIGINT AS total_characters,
  round(avg(character_count) FILTER (extraction_success), 4) AS avg_characters,
  sum(page_count) FILTER (extraction_success)::BIGINT AS total_pages,
  round(avg(processing_time_seconds) FILTER (extraction_success), 6) AS avg_seconds
FROM markdown""",
)
def extraction_stats(spark, sf):
    return reports.extraction_stats(markdown(spark, sf))


@query(
    "failure_patterns",
    MARKDOWN
    + """SELECT error_message, count(*) AS failures FROM markdown
WHERE NOT extraction_success GROUP BY error_message""",
)
def failure_patterns(spark, sf):
    return reports.failure_patterns(markdown(spark, sf))


@query(
    "chars_by_pages",
    MARKDOWN
    + """SELECT page_count, round(avg(character_count), 4) AS avg_character_count
FROM markdown GROUP BY page_count""",
)
def chars_by_pages(spark, sf):
    return reports.chars_by_pages(markdown(spark, sf))


@query(
    "size_distribution",
    MARKDOWN
    + f"""SELECT CASE WHEN character_count / 4 < {LIMITS["token_threshold"]}
    AND file_size_bytes < {LIMITS["size_threshold"]} THEN 'SMALL_DOCUMENTS' ELSE 'LARGE_DOCUMENTS' END AS size_category,
  count(*) AS "count", round(avg(character_count / 4), 4) AS avg_estimated_tokens,
  round(avg(file_size_bytes), 4) AS avg_size_bytes
FROM markdown WHERE extraction_success AND markdown_content IS NOT NULL GROUP BY 1""",
)
def size_distribution(spark, sf):
    return reports.size_distribution(markdown(spark, sf), **LIMITS)


@query(
    "row_counts",
    MARKDOWN
    + """SELECT count(*) AS total_rows, count(*) FILTER (extraction_success) AS successful,
  count(*) FILTER (file_extension = '.pdf') AS pdf_files FROM markdown""",
)
def row_counts(spark, sf):
    return reports.row_counts(
        markdown(spark, sf), successful=F.col("extraction_success"), pdf_files=F.col("file_extension") == ".pdf"
    )


@query(
    "total_size",
    STORE
    + """SELECT coalesce(sum(file_size_bytes), 0)::BIGINT AS total_bytes,
  round(coalesce(sum(file_size_bytes), 0) / 1048576.0::DOUBLE, 2) AS total_mb FROM store""",
)
def total_size(spark, sf):
    return reports.total_size(store(spark, sf))


@query(
    "markdown_tiles",
    MARKDOWN
    + """SELECT count(*) AS documents, count(*) FILTER (extraction_success) AS successful,
  sum(page_count)::BIGINT AS pages, round(avg(processing_time_seconds), 6) AS avg_seconds FROM markdown""",
)
def markdown_tiles(spark, sf):
    return reports.markdown_tiles(markdown(spark, sf))


@query(
    "point_lookup",
    STORE + "SELECT doc_id, file_name, file_size_bytes FROM store WHERE file_name = 'doc_5.pdf'",
)
def point_lookup(spark, sf):
    """A named parameter in SQL text over a view of the store."""
    store(spark, sf).createOrReplaceTempView("quire_store")
    sql = "SELECT doc_id, file_name, file_size_bytes FROM quire_store WHERE file_name = :name"
    return sql_query(spark, sql, name="doc_5.pdf")


@query(
    "document_ids",
    STORE
    + """SELECT file_name, sha256(volume_path || '|' || coalesce(sha256(binary_content), '')) AS doc_key,
  'doc_' || sha256(file_name || '|' || source) AS row_key FROM store""",
)
def document_ids(spark, sf):
    return store(spark, sf).select(
        "file_name",
        document_id("volume_path", "binary_content").alias("doc_key"),
        row_key("file_name", "source").alias("row_key"),
    )


@query(
    "normalised_paths",
    STORE
    + """SELECT file_name, '/volumes' || volume_path AS from_scheme, '/volumes/' || file_name AS from_bare,
  '/volumes/' || file_name AS from_rooted, format('{:,}', file_size_bytes) AS size_text FROM store""",
)
def normalised_paths(spark, sf):
    def normal(path):
        return normalise_path(path, "store:", "/volumes")

    return store(spark, sf).select(
        "file_name",
        normal(F.concat(F.lit("store:"), "volume_path")).alias("from_scheme"),
        normal(F.col("file_name")).alias("from_bare"),
        normal(F.concat(F.lit("/volumes/"), "file_name")).alias("from_rooted"),
        thousands("file_size_bytes").alias("size_text"),
    )


@query(
    "event_times",
    """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS iso, strftime(ts, '%Y%m%d_%H%M%S') AS stamp,
  strftime(date_trunc('milliseconds', ts), '%Y-%m-%dT%H:%M:%S.%f') AS from_millis FROM events""",
)
def event_times(spark, sf):
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    return read_parquet(spark, sf, "events").select(
        "event_id",
        iso_text("ts").alias("iso"),
        stamp_text("ts").alias("stamp"),
        iso_text(millis_to_timestamp(millis)).alias("from_millis"),
    )


@query(
    "browse_rollup",
    STORE
    + """SELECT CASE WHEN grouping(directory) = 1 THEN 'TOTAL' ELSE directory END AS directory,
  count(*) AS file_count, sum(file_size_bytes)::BIGINT AS total_bytes,
  round(sum(file_size_bytes) / 1048576.0::DOUBLE, 4) AS total_mb
FROM store WHERE file_extension = '.pdf' GROUP BY ROLLUP (directory)""",
)
def browse_rollup(spark, sf):
    return reports.browse_rollup(store(spark, sf))


@query("category_counts", "SELECT source, count(*) AS item_count FROM documents GROUP BY source")
def category_counts(spark, sf):
    return reports.counts_by(read_parquet(spark, sf, "documents"), "source")


@query(
    "category_sample",
    STORE
    + """SELECT directory, file_name, n_items, position, greatest(n_items - 2, 0) AS more FROM (
  SELECT directory, file_name, count(*) OVER (PARTITION BY directory) AS n_items,
    row_number() OVER (PARTITION BY directory ORDER BY file_name) AS position,
    dense_rank() OVER (ORDER BY directory) AS folder FROM store)
WHERE folder <= 5 AND position <= 2""",
)
def category_sample(spark, sf):
    return listing.category_sample(store(spark, sf), "directory", "file_name")


@query(
    "category_listing",
    STORE
    + """SELECT source AS category, 0 AS level, NULL AS item, count(*) AS n_items FROM store GROUP BY source
UNION ALL SELECT source, 1, file_name, NULL FROM store""",
)
def category_listing(spark, sf):
    return listing.category_listing(store(spark, sf), "source", "file_name")


@query("distinct_extensions", STORE + "SELECT DISTINCT file_extension FROM store")
def distinct_extensions(spark, sf):
    return reports.distinct_values(store(spark, sf), "file_extension")


@query(
    "pdf_magic",
    """SELECT page_id, starts_with(html, '<!DO') AS is_html, starts_with(html, '%PDF') AS is_pdf FROM pages""",
)
def pdf_magic(spark, sf):
    body = F.encode("html", "UTF-8")
    return read_parquet(spark, sf, "pages").select(
        "page_id",
        (F.substring(body, 1, 4) == F.lit(b"<!DO")).alias("is_html"),
        is_pdf_body(body).alias("is_pdf"),
    )


@query(
    "random_pick",
    STORE
    + """SELECT file_name, source FROM store WHERE source = 'src7' AND lang = 'en'
ORDER BY md5(file_name || '|42'), file_name LIMIT 3""",
)
def random_pick(spark, sf):
    rows = store(spark, sf).filter(F.col("lang") == "en")
    return reports.random_pick(rows, "source", "src7", "file_name", n=3).select("file_name", "source")


@query(
    "sorted_preview",
    MARKDOWN
    + """SELECT file_name, character_count, CASE WHEN length(markdown_content) > 300
    THEN substr(markdown_content, 1, 300) || '...' ELSE markdown_content END AS preview
FROM markdown WHERE extraction_success ORDER BY character_count DESC, file_name LIMIT 10""",
)
def sorted_preview(spark, sf):
    return (
        markdown(spark, sf)
        .filter(status_filter("Successful"))
        .orderBy(F.desc("character_count"), "file_name")
        .limit(10)
        .select("file_name", "character_count", preview("markdown_content", 300, "...").alias("preview"))
    )


@query(
    "content_search",
    MARKDOWN
    + """SELECT file_name, character_count FROM markdown WHERE contains(markdown_content, 'tion')""",
)
def content_search(spark, sf):
    return (
        markdown(spark, sf)
        .filter(F.col("markdown_content").contains("tion"))
        .select("file_name", "character_count")
    )


@query(
    "path_parts",
    STORE
    + """SELECT volume_path, split_part(volume_path, '/', -1) AS base, directory AS folder,
  lower(regexp_extract(volume_path, '(\\.[^./]*)$', 1)) AS ext,
  upper(source) AS upper_source, 'Doc ' || doc_id AS title,
  round(file_size_bytes / 1024.0::DOUBLE, 2) AS kb, round(file_size_bytes / 1048576.0::DOUBLE, 4) AS mb,
  round(file_size_bytes / 1073741824.0::DOUBLE, 7) AS gb
FROM store""",
)
def path_parts(spark, sf):
    return store(spark, sf).select(
        "volume_path",
        base_name("volume_path").alias("base"),
        parent_dir("volume_path").alias("folder"),
        extension("volume_path").alias("ext"),
        F.upper("source").alias("upper_source"),
        title_case(F.concat_ws("_", F.lit("doc"), F.col("doc_id").cast("string"))).alias("title"),
        double_round(kilobytes("file_size_bytes"), 2).alias("kb"),
        double_round(megabytes("file_size_bytes"), 4).alias("mb"),
        double_round(gigabytes("file_size_bytes"), 7).alias("gb"),
    )
