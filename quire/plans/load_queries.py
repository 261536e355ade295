"""Manifests, load planning, run logs and file inventories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.contracts import PAPER_MANIFEST
from quire.functions.markup import html_title
from quire.functions.predicates import in_categories
from quire.functions.sizes import megabytes
from quire.functions.text import (
    UNSAFE_NAME_CHARS,
    extension,
    owner_key,
    paper_file_name,
    report_file_name,
    safe_file_name,
    url_host,
    url_origin,
)
from quire.operators import joins, manifest, reports
from quire.plans.corpus import ROOT, store, with_tables
from quire.plans.registry import query
from quire.scratch import scratch_path
from quire.sources.files import describe_volume, inventory, list_volume, scan_binary
from quire.sources.sinks import append_evolving, write_observed
from quire.sources.tables import read_evolving, read_manifest, read_parquet, read_run_metadata

LANDING = "/landing"
# A file of at least this size counts as loaded (the test bodies are small).
DONE_MB = 0.003
WANTED = ["en", "fr", "es"]


def papers(spark: SparkSession, sf: str) -> DataFrame:
    """Paper manifest from the pages: title, host as author, path as category."""
    pages = read_parquet(spark, sf, "pages")
    return pages.select(
        html_title("html").alias("title"),
        F.concat(url_host("url"), F.lit(" et al.")).alias("authors"),
        F.lit("2024").alias("year"),
        "url",
        F.regexp_extract("url", r"^https?://[^/]+/([^/?#]*)", 1).alias("category"),
        F.col("page_id").cast("string").alias("item_id"),
        F.octet_length("html").cast("long").alias("body_bytes"),
    )


PAPERS = r"""papers AS (SELECT regexp_extract(html, '(?is)<title[^>]*>(.*?)</title', 1) AS title,
  regexp_extract(url, '^https?://([^/:?#]+)', 1) || ' et al.' AS authors, '2024' AS year, url,
  regexp_extract(url, '^https?://[^/]+/([^/?#]*)', 1) AS category, CAST(page_id AS VARCHAR) AS item_id,
  octet_length(encode(html)) AS body_bytes FROM pages)"""
SAFE = (
    f"trim(regexp_replace(regexp_replace(translate({{0}}, '{UNSAFE_NAME_CHARS}', '_________'), "
    + r"'[^\p{{L}}\p{{N}}_\s.\-]', '', 'g'), '\s+', '_', 'g'))"
)
PLANNED = (
    "WITH "
    + PAPERS
    + f""", named AS (SELECT *, '{LANDING}/' || {SAFE.format("category")} AS target_dir,
  '2024_' || split_part(authors, ' et al.', 1) || '_' || item_id || '_' || {SAFE.format("title")} || '.pdf' AS file_name
  FROM papers WHERE category IN ('en', 'fr', 'es')),
planned AS (SELECT *, target_dir || '/' || file_name AS target_path FROM named)
"""
)


# All categories: the choice of some is the feature of manifest_plan alone
PLANNED_ALL = PLANNED.replace("WHERE category IN ('en', 'fr', 'es')", "")


def planned(spark: SparkSession, sf: str, wanted: list[str] | None = None) -> DataFrame:
    name = paper_file_name("year", "authors", "item_id", "title")
    return manifest.plan_loads(papers(spark, sf), LANDING, name, wanted=wanted or ["all"])


@query("manifest_plan", PLANNED + "SELECT item_id, category, target_dir, file_name, target_path FROM planned")
def manifest_plan(spark, sf):
    return planned(spark, sf, WANTED).select("item_id", "category", "target_dir", "file_name", "target_path")


@query(
    "manifest_json",
    "WITH "
    + PAPERS
    + """SELECT title, CASE WHEN category <> 'fr' THEN authors END AS authors, year, url, category, item_id FROM papers""",
)
def manifest_json(spark, sf):
    """Manifest written as JSON records, some without authors, and read back."""
    path = scratch_path(spark, "manifest")
    authors = F.when(F.col("category") != "fr", F.col("authors"))
    papers(spark, sf).withColumn("authors", authors).drop("body_bytes").write.json(path)
    return read_manifest(spark, path, PAPER_MANIFEST, view="quire_papers")


@query(
    "manifest_dedupe",
    "WITH " + PAPERS + """, hosts AS (SELECT *, regexp_extract(url, '^https?://([^/:?#]+)', 1) AS host FROM papers)
SELECT host, arg_min(item_id, item_id::BIGINT) AS item_id, arg_min(title, item_id::BIGINT) AS title
FROM hosts GROUP BY host""",
)
def manifest_dedupe(spark, sf):
    rows = papers(spark, sf).select(
        url_host("url").alias("host"), "item_id", "title", F.col("item_id").cast("long").alias("n")
    )
    return manifest.dedupe_by(rows, "host", "n").drop("n")


@query(
    "skip_existing",
    PLANNED_ALL
    + f"""SELECT item_id, target_path FROM planned WHERE target_path NOT IN (
  SELECT target_path FROM planned WHERE body_bytes / 1048576.0::DOUBLE > {DONE_MB})""",
)
def skip_existing(spark, sf):
    plan = planned(spark, sf)
    there = plan.select(F.col("target_path").alias("volume_path"), F.col("body_bytes").alias("file_size_bytes"))
    return joins.skip_existing(plan, there, DONE_MB).select("item_id", "target_path")


LOG = PLANNED_ALL + f""", log AS (SELECT item_id, category, file_name,
  body_bytes / 1048576.0::DOUBLE > {DONE_MB} AS success,
  CASE WHEN body_bytes / 1048576.0::DOUBLE > {DONE_MB} THEN body_bytes / 1048576.0::DOUBLE ELSE 0 END AS size_mb,
  CASE WHEN body_bytes / 1048576.0::DOUBLE > {DONE_MB} THEN target_path END AS stored_path,
  category = 'fr' AS special_route FROM planned)
"""


def run_log(spark: SparkSession, sf: str) -> DataFrame:
    """Large bodies arrived, small ones failed; French ones took another route."""
    plan = planned(spark, sf)
    arrived = plan.filter(megabytes("body_bytes") > DONE_MB).select(
        "target_path", F.col("body_bytes").alias("file_size_bytes")
    )
    return manifest.load_log(plan, arrived, ["item_id", "category"], via=F.col("category") == "fr")


SUMMARY = """SELECT count(*) AS attempted, count(*) FILTER (success) AS successful,
  count(*) FILTER (NOT success) AS failed, count(*) FILTER (success AND special_route) AS special_route_successes,
  round(sum(size_mb), 6) AS total_mb, round(sum(size_mb) / 1024.0::DOUBLE, 9) AS total_gb FROM log"""


@query("run_log_summary", LOG + SUMMARY)
def run_log_summary(spark, sf):
    return manifest.run_log_summary(run_log(spark, sf))


@query(
    "failed_loads",
    LOG + "SELECT item_id, file_name, stored_path, size_mb FROM log WHERE NOT success",
)
def failed_loads(spark, sf):
    return manifest.failed_loads(run_log(spark, sf)).select("item_id", "file_name", "stored_path", "size_mb")


@query("run_metadata", LOG + "SELECT item_id, category, success, stored_path FROM log")
def run_metadata(spark, sf):
    """Run metadata written as JSON and its log read back."""
    path = scratch_path(spark, "run")
    manifest.write_run_metadata(run_log(spark, sf), path, volume=LANDING)
    entries = spark.read.json(f"{path}/entries")
    return entries.select("item_id", "category", "success", "stored_path")


@query("run_metadata_summary", LOG + SUMMARY)
def run_metadata_summary(spark, sf):
    path = scratch_path(spark, "run")
    manifest.write_run_metadata(run_log(spark, sf), path, volume=LANDING)
    return read_run_metadata(spark, f"{path}/summary").drop("run_time", "volume")


@query(
    "load_counts",
    "WITH " + PAPERS + "SELECT category, count(*) AS item_count FROM papers GROUP BY category",
)
def load_counts(spark, sf):
    return reports.counts_by(papers(spark, sf).filter(in_categories("category", ["all"])), "category")


@query(
    "suspect_files",
    with_tables("store")
    + f"""SELECT volume_path, file_size_bytes, round(file_size_bytes / 1048576.0::DOUBLE, 6) AS size_mb
FROM store WHERE file_extension = '.pdf' AND file_size_bytes / 1048576.0::DOUBLE < {DONE_MB}""",
)
def suspect_files(spark, sf):
    return manifest.suspect_files(store(spark, sf), ROOT, DONE_MB)


@query(
    "safe_names",
    r"""SELECT page_id, url_origin, safe, 'FY24_' || host || '_' || safe || '_Annual_Report.pdf' AS report_name,
  replace(split_part(owner, '@', 1), '.', '_') AS owner FROM (
  SELECT page_id, regexp_extract(url, '^(https?://[^/?#]+)', 1) || '/' AS url_origin,
    regexp_extract(url, '^https?://([^/:?#]+)', 1) AS host,
    """
    + SAFE.format("url")
    + r""" AS safe, regexp_extract(url, '^https?://([^/:?#]+)', 1) || '@mail' AS owner FROM pages)""",
)
def safe_names(spark, sf):
    pages = read_parquet(spark, sf, "pages")
    return pages.select(
        "page_id",
        url_origin("url").alias("url_origin"),
        safe_file_name("url").alias("safe"),
        report_file_name(url_host("url"), "url").alias("report_name"),
        owner_key(F.concat(url_host("url"), F.lit("@mail"))).alias("owner"),
    )


def landed(spark: SparkSession, sf: str) -> str:
    """Documents written as files, one per source and language, in folders of these names."""
    path = scratch_path(spark, "landing")
    docs = read_parquet(spark, sf, "documents").select("source", "lang", "doc_id", F.col("text").alias("value"))
    dealt = docs.repartition("source", "lang").sortWithinPartitions("source", "lang", "doc_id").drop("doc_id")
    dealt.write.partitionBy("source", "lang").text(path)
    return path


# Every file with its folder, size and the checksum of its body.
LANDED = """SELECT 'source=' || source || '/lang=' || lang AS folder, sum(octet_length(encode(text)) + 1)::BIGINT AS n_bytes"""
BODY = ", md5(string_agg(text || chr(10), '' ORDER BY doc_id)) AS body_md5, '.txt' AS extension"
FILES = " FROM documents GROUP BY source, lang"


def _folder(path: str):
    return F.regexp_extract(path, r"(source=[^/]*/lang=[^/]*)/[^/]*$", 1).alias("folder")


@query("binary_scan", LANDED + BODY + FILES)
def binary_scan(spark, sf):
    files = scan_binary(spark, landed(spark, sf), "*.txt")
    return files.select(
        _folder("path"), F.col("length").alias("n_bytes"), F.md5("content").alias("body_md5"), extension("path").alias("extension")
    )


@query("volume_listing", LANDED + FILES)
def volume_listing(spark, sf):
    files = list_volume(spark, landed(spark, sf))
    return files.filter(extension("path") == ".txt").select(_folder("path"), F.col("size").alias("n_bytes"))


@query(
    "volume_description",
    f"""SELECT '.txt' AS extension, count(*) AS n_files, count(*) AS n_folders, sum(n_bytes)::BIGINT AS n_bytes,
  min(n_bytes) AS smallest, max(n_bytes) AS largest FROM ({LANDED}{FILES})""",
)
def volume_description(spark, sf):
    return describe_volume(spark, landed(spark, sf)).filter(F.col("extension") == ".txt")


@query("file_inventory", LANDED + BODY + FILES)
def file_inventory(spark, sf):
    files = inventory(spark, landed(spark, sf), (".txt",))
    return files.select(
        _folder("volume_path"),
        F.col("file_size_bytes").alias("n_bytes"),
        F.md5("binary_content").alias("body_md5"),
        F.col("file_extension").alias("extension"),
    )


@query(
    "schema_evolution",
    """SELECT doc_id, n_chars, NULL AS lang FROM documents UNION ALL SELECT doc_id, n_chars, lang FROM documents""",
)
def schema_evolution(spark, sf):
    """Files appended before and after a column was added, read as one table."""
    path = scratch_path(spark, "evolving")
    docs = read_parquet(spark, sf, "documents")
    append_evolving(docs.select("doc_id", "n_chars"), path)
    append_evolving(docs.select("doc_id", "n_chars", "lang"), path)
    return read_evolving(spark, path)


@query("observed_write", "SELECT count(*) AS rows_read, sum(n_chars)::BIGINT AS characters FROM documents")
def observed_write(spark, sf):
    """Metrics counted during a write agree with the table written."""
    path = scratch_path(spark, "observed")
    docs = read_parquet(spark, sf, "documents").select("doc_id", "n_chars")
    seen = write_observed(docs, path, chars=F.sum("n_chars"))
    written = spark.read.parquet(path).agg(F.count("*").alias("rows_read"), F.sum("n_chars").alias("characters"))
    return written.filter((F.col("rows_read") == seen["rows_written"]) & (F.col("characters") == seen["chars"]))
