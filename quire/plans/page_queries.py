"""Page splitting, page reports and page joins."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quire.functions.markup import html_title, html_to_markdown
from quire.functions.payloads import decode_metadata, page_metadata
from quire.operators import extract, joins, pages, reports
from quire.plans.corpus import pagetext, store, with_tables
from quire.plans.registry import query
from quire.scratch import scratch_path
from quire.sources.sinks import write_bucketed_folders, write_bucketed_table
from quire.sources.tables import read_parquet

PAGES = with_tables("pagetext")


@query(
    "split_pages",
    PAGES
    + """SELECT doc_id, source_filename, page_number, total_pages, file_size_bytes, ocr_text FROM pagetext""",
)
def split_pages(spark, sf):
    return pagetext(spark, sf).select(
        "doc_id", "source_filename", "page_number", "total_pages", "file_size_bytes", "ocr_text"
    )


@query(
    "break_pages",
    """SELECT doc_id, CAST(i AS INTEGER) AS page_number, len(parts)::INTEGER AS total_pages, parts[i] AS content
FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE text <> '') d,
  unnest(range(1, len(parts) + 1)) AS u(i)""",
)
def break_pages(spark, sf):
    docs = read_parquet(spark, sf, "documents").select("doc_id", "text")
    return pages.split_text_pages(docs, "text", pages.break_pages("text", "\n"), "content")


@query(
    "page_validation",
    PAGES
    + """SELECT count(DISTINCT doc_id) AS unique_documents, count(*) AS total_pages,
  round(avg(total_pages), 6) AS avg_pages_per_doc, min(page_number)::BIGINT AS min_page_num,
  max(page_number)::BIGINT AS max_page_num, round(avg(octet_length(encode(ocr_text))), 6) AS avg_body_bytes
FROM pagetext""",
)
def page_validation(spark, sf):
    return reports.page_validation(pagetext(spark, sf))


@query(
    "page_monitor",
    PAGES
    + """SELECT count(DISTINCT doc_id) AS total_documents, count(*) AS total_pages,
  count(DISTINCT CASE WHEN t IS NULL THEN doc_id END) AS documents_with_failures,
  round(count(*)::DOUBLE / count(DISTINCT doc_id), 6) AS avg_pages_per_document
FROM (SELECT doc_id, CASE WHEN length(ocr_text) >= 50 THEN ocr_text END AS t FROM pagetext)""",
)
def page_monitor(spark, sf):
    """Pages with fewer than 50 characters count as failed."""
    rows = pagetext(spark, sf).withColumn(
        "ocr_text", F.when(F.length("ocr_text") >= 50, F.col("ocr_text"))
    )
    return reports.page_monitor(rows)


@query(
    "dataset_stats",
    PAGES
    + """SELECT count(*) AS total_rows, max(page_number)::BIGINT AS max_page, count(DISTINCT doc_id) AS total_docs
FROM pagetext""",
)
def dataset_stats(spark, sf):
    return reports.dataset_stats(pagetext(spark, sf))


DOCUMENT_LIST = """SELECT source_filename, max(total_pages)::BIGINT AS total_pages,
  max(file_size_bytes) AS file_size_bytes,
  max(strftime(modification_time, '%Y-%m-%d %H:%M:%S')) AS processing_timestamp
FROM pagetext GROUP BY source_filename"""


@query("document_list", PAGES + DOCUMENT_LIST)
def document_list(spark, sf):
    return reports.document_list(pagetext(spark, sf))


@query(
    "page_tiles",
    PAGES
    + f"""SELECT count(*) AS documents, sum(total_pages)::BIGINT AS pages,
  round(sum(file_size_bytes) / 1048576.0::DOUBLE, 2) AS total_mb FROM ({DOCUMENT_LIST})""",
)
def page_tiles(spark, sf):
    return reports.page_tiles(reports.document_list(pagetext(spark, sf)))


@query(
    "document_pages",
    PAGES
    + """SELECT doc_id, page_number, substr(ocr_text, 1, 200) AS preview FROM pagetext WHERE doc_id = '7'""",
)
def document_pages(spark, sf):
    return pages.document_pages(pagetext(spark, sf), "7")


@query(
    "page_headers",
    PAGES
    + """SELECT doc_id, page_number, page_number || '/' || total_pages AS page_label,
  strftime(modification_time, '%Y-%m-%d') AS ocr_date, length(ocr_text) AS text_length FROM pagetext""",
)
def page_headers(spark, sf):
    return pages.page_headers(pagetext(spark, sf))


@query(
    "nth_page",
    PAGES + """SELECT doc_id, page_number, ocr_text FROM pagetext WHERE page_number = 3""",
)
def nth_page(spark, sf):
    return pages.nth_page(pagetext(spark, sf), 2).select("doc_id", "page_number", "ocr_text")


@query(
    "vector_ready",
    PAGES
    + """SELECT doc_id || '_page_' || page_number AS id, doc_id, source_filename, page_number, total_pages,
  file_size_bytes, ocr_text FROM pagetext WHERE ocr_text <> ''""",
)
def vector_ready(spark, sf):
    return pages.vector_ready(pagetext(spark, sf)).drop(
        "processing_timestamp", "metadata_json", "ocr_timestamp", "ocr_model"
    )


@query(
    "join_results",
    PAGES
    + """SELECT p.doc_id, p.page_number, r.words FROM pagetext p LEFT JOIN (
  SELECT doc_id, page_number, len(string_split(ocr_text, ' ')) AS words FROM pagetext
  WHERE length(ocr_text) >= 50) r ON p.doc_id = r.doc_id AND p.page_number = r.page_number""",
)
def join_results(spark, sf):
    rows = pagetext(spark, sf)
    results = rows.filter(F.length("ocr_text") >= 50).select(
        "doc_id", "page_number", F.size(F.split("ocr_text", " ")).cast("long").alias("words")
    )
    return joins.attach_results(rows.select("doc_id", "page_number"), results)


@query(
    "page_lookup",
    PAGES
    + """SELECT a.doc_id, a.page_number, length(a.ocr_text) AS n, b.total_pages AS other_pages
FROM pagetext a JOIN (SELECT doc_id AS document, page_number AS page, total_pages FROM pagetext) b ON a.doc_id = b.document AND a.page_number = b.page""",
)
def page_lookup(spark, sf):
    rows = pagetext(spark, sf)
    other = rows.select(
        F.col("doc_id").alias("document"),
        F.col("page_number").alias("page"),
        F.col("total_pages").alias("other_pages"),
    )
    left = rows.select("doc_id", "page_number", F.length("ocr_text").cast("long").alias("n"))
    return joins.page_lookup(left, other, {"doc_id": "document", "page_number": "page"}, ["other_pages"])


# Tag by tag what the given pages hold; their bold text is never closed, and some are cut off within a tag or entity.
MARKDOWN = r"""WITH one AS (SELECT page_id, regexp_replace(html, '\s+', ' ', 'g') AS t FROM pages),
bare AS (SELECT page_id, regexp_replace(regexp_replace(t, '<!--.*?-->', '', 'g'), '(?i)<head>.*</head>', '') AS t FROM one),
signs AS (SELECT page_id, regexp_replace(regexp_replace(t, '<a href="([^"]*)">(.*?)</a>', '[\2](\1)', 'g'),
  '<li>', chr(10) || '- ', 'g') AS t FROM bare),
lines AS (SELECT page_id, regexp_replace(replace(replace(t, '<h1>', chr(10) || chr(10) || '# '), '<br>', chr(10)),
  '</?(?:p|div|nav|ul|article|footer|h1|body|html)(?: [^>]*)?>', chr(10) || chr(10), 'g') AS t FROM signs),
plain AS (SELECT page_id, regexp_replace(regexp_replace(t, '<[a-zA-Z/!][^>]*>', '', 'g'), '<[a-zA-Z/!][^>]*$', '') AS t FROM lines),
known AS (SELECT page_id, replace(replace(replace(t, '&copy;', '©'), '&middot;', '·'), '&quot;', '"') AS t FROM plain),
whole AS (SELECT page_id, regexp_replace(t, '&amp;?', '&', 'g') AS t FROM known),
tight AS (SELECT page_id, regexp_replace(t, ' *\n *', chr(10), 'g') AS t FROM whole)
SELECT page_id, trim(regexp_replace(t, '\n{3,}', chr(10) || chr(10), 'g'), ' ' || chr(10)) AS markdown FROM tight"""


@query("html_to_markdown", MARKDOWN)
def html_markdown(spark, sf):
    return read_parquet(spark, sf, "pages").select(
        "page_id", html_to_markdown("html").alias("markdown")
    )


@query(
    "html_extraction",
    f"""SELECT 'page_' || p.page_id || '.html' AS file_name, p.page_id % 50 <> 7 AS extraction_success,
  CASE WHEN p.page_id % 50 = 7 THEN 'No binary data provided' END AS error_message,
  CASE WHEN p.page_id % 50 <> 7 THEN markdown END AS markdown_content,
  CASE WHEN p.page_id % 50 <> 7 THEN length(markdown) ELSE 0 END AS character_count,
  CASE WHEN p.page_id % 50 = 7 OR length(markdown) = 0 THEN 0 ELSE greatest(1, length(markdown) // 2000) END AS page_count
FROM pages p JOIN ({MARKDOWN}) m ON m.page_id = p.page_id""",
)
def html_extraction(spark, sf):
    """Pages as HTML bodies of a document store, one in fifty without a body, turned into markdown."""
    rows = read_parquet(spark, sf, "pages")
    stored = rows.select(
        F.concat(F.lit("page_"), F.col("page_id").cast("string"), F.lit(".html")).alias("file_name"),
        F.col("url").alias("volume_path"),
        F.lit(".html").alias("file_extension"),
        F.octet_length("html").cast("long").alias("file_size_bytes"),
        F.lit(None).cast("timestamp").alias("modification_time"),
        F.lit(None).cast("string").alias("directory"),
        F.when(F.col("page_id") % 50 != 7, F.encode("html", "UTF-8")).alias("binary_content"),
    )
    return extract.extract(stored, extract.html_text, (".html",)).select(
        "file_name", "extraction_success", "error_message", "markdown_content", "character_count", "page_count"
    )


@query(
    "metadata_json",
    """SELECT page_id, url AS source_filepath, regexp_extract(html, '(?is)<title[^>]*>(.*?)</title', 1) AS pdf_title,
  CAST(NULL AS VARCHAR) AS pdf_subject, CAST(octet_length(encode(html)) AS VARCHAR) AS file_size_bytes FROM pages""",
)
def metadata_json(spark, sf):
    encoded = read_parquet(spark, sf, "pages").select(
        "page_id",
        page_metadata(
            source_filepath="url",
            file_size_bytes=F.octet_length("html"),
            pdf_title=html_title("html"),
            pdf_subject=F.lit(""),
        ).alias("metadata"),
    )
    decoded = encoded.select("page_id", decode_metadata("metadata").alias("m"))
    fields = ["source_filepath", "pdf_title", "pdf_subject", "file_size_bytes"]
    return decoded.select("page_id", *[F.col("m")[f].alias(f) for f in fields])


@query("bucketed_pages", PAGES + "SELECT doc_id, page_number, ocr_text FROM pagetext")
def bucketed_pages(spark, sf):
    """Pages written into hash-bucket folders and read back."""
    path = scratch_path(spark, "pages")
    write_bucketed_folders(pagetext(spark, sf), path, buckets=16)
    return spark.read.parquet(path).select("doc_id", "page_number", "ocr_text")


@query(
    "bucketed_join",
    PAGES
    + """SELECT p.doc_id, p.page_number, r.words, b.other_pages FROM pagetext p LEFT JOIN (
  SELECT doc_id, page_number, len(string_split(ocr_text, ' ')) AS words FROM pagetext
  WHERE length(ocr_text) >= 50) r ON p.doc_id = r.doc_id AND p.page_number = r.page_number
JOIN (SELECT doc_id, page_number, total_pages AS other_pages FROM pagetext) b
  ON p.doc_id = b.doc_id AND p.page_number = b.page_number""",
)
def bucketed_join(spark, sf):
    """Pages, results and a second page table, bucketed by the whole page key and joined without a shuffle."""
    key = ["doc_id", "page_number"]
    rows = pagetext(spark, sf)
    results = rows.filter(F.length("ocr_text") >= 50).select(*key, F.size(F.split("ocr_text", " ")).cast("long").alias("words"))
    other = rows.select(F.col("doc_id").alias("document"), F.col("page_number").alias("page"), F.col("total_pages").alias("other_pages"))
    name = f"quire_pages_{uuid.uuid4().hex}"
    pages_ = write_bucketed_table(rows.select(*key), name, key, buckets=16)
    results = write_bucketed_table(results, f"{name}_results", key, buckets=16)
    other = write_bucketed_table(other, f"{name}_other", ["document", "page"], buckets=16)
    answered = joins.attach_results(pages_, results)
    return joins.page_lookup(answered, other, {"doc_id": "document", "page_number": "page"}, ["other_pages"])


class TextPages:
    """Pages of a body as they are decoded; one that begins with a line break cannot be made."""

    def __init__(self, body: bytes, size: int = 2000) -> None:
        self.text, self.size = body.decode("utf-8"), size

    def __len__(self) -> int:
        return -(-len(self.text) // self.size)

    def __iter__(self):
        for start in range(0, len(self.text), self.size):
            page = self.text[start : start + self.size]
            if page[0] == "\n":
                raise ValueError("the page begins with a line break")
            yield page.encode("utf-8")


@query(
    "binary_pages",
    with_tables("pagetext")
    + """, readable AS (SELECT p.*, min(CASE WHEN left(ocr_text, 1) = chr(10) THEN page_number END)
    OVER (PARTITION BY p.doc_id) AS stop
  FROM pagetext p JOIN store s ON CAST(s.doc_id AS VARCHAR) = p.doc_id WHERE s.binary_content IS NOT NULL)
SELECT doc_id, page_number, total_pages, CASE WHEN page_number = stop THEN NULL ELSE octet_length(encode(ocr_text)) END AS page_bytes,
  CASE WHEN page_number = stop THEN 'ValueError: the page begins with a line break' END AS error_message
FROM readable WHERE page_number <= coalesce(stop, page_number)
UNION ALL SELECT CAST(doc_id AS VARCHAR), NULL, NULL, NULL, 'TypeError: cannot convert ''NoneType'' object to bytes'
FROM store WHERE binary_content IS NULL""",
)
def binary_pages(spark, sf):
    """The store's bodies of every extension as pages; a body that breaks keeps its earlier pages and gives an error row."""
    docs = store(spark, sf).select(F.col("doc_id").cast("string").alias("doc_id"), "binary_content")
    return pages.split_binary_pages(docs, TextPages, carry=["doc_id"]).select(
        "doc_id",
        "page_number",
        "total_pages",
        F.octet_length("page_image_png").cast("long").alias("page_bytes"),
        "error_message",
    )
