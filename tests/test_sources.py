import os

import pytest
from pyspark.sql import functions as F

from quire import contracts, scratch
from quire.sources import files, sinks, tables
from quire.streaming import ingest


def make_tree(root):
    (root / "a" / "deep" / "er").mkdir(parents=True)
    (root / "b").mkdir()
    (root / "top.pdf").write_bytes(b"%PDF top")
    (root / "a" / "Éa.PDF").write_bytes(b"%PDF a")
    (root / "a" / "deep" / "er" / "x.docx").write_bytes(b"docx")
    (root / "b" / "empty.pdf").write_bytes(b"")
    (root / "b" / "note.txt").write_bytes(b"no")
    return str(root)


def test_inventory_keeps_metadata_of_unreadable_files(spark, tmp_path):
    """A file that is gone when bodies are read keeps its row; one without bytes is not listed."""
    root = make_tree(tmp_path / "t")
    listed = scratch.materialise(files.list_volume(spark, root), "listed")
    os.remove(os.path.join(root, "top.pdf"))
    df = files.inventory(spark, root, listed=listed)
    contracts.assert_contract(df, contracts.DOCUMENT_STORE)
    got = {r.file_name: r for r in df.collect()}
    assert set(got) == {"top.pdf", "Éa.PDF", "x.docx"}
    assert got["top.pdf"].binary_content is None and got["top.pdf"].file_size_bytes == 8
    assert got["Éa.PDF"].file_extension == ".pdf" and got["Éa.PDF"].directory == root + "/a"
    assert got["Éa.PDF"].binary_content == b"%PDF a" and got["Éa.PDF"].volume_path == root + "/a/Éa.PDF"
    assert got["x.docx"].directory.endswith("/a/deep/er")
    assert {r.file_name for r in files.inventory(spark, "file:" + root).collect()} == {"Éa.PDF", "x.docx"}


def test_listing_and_binary_scan(spark, tmp_path):
    root = make_tree(tmp_path / "t")
    assert files.list_documents(spark, root).count() == 2
    scan = files.scan_binary(spark, root)
    assert sorted(r[0] for r in scan.select(F.length("content")).collect()) == [6, 8]
    plan = scan.select("path", "length")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]


def test_manifest_missing_keys_become_null(spark):
    rows = [{"company_name": "A", "ticker": "AA", "requires_login": True}, {"company_name": "B"}]
    df = tables.manifest_from_records(spark, rows, contracts.COMPANY_MANIFEST, view="companies")
    assert [tuple(r) for r in spark.sql("SELECT ticker, requires_login FROM companies ORDER BY 1 NULLS LAST").collect()] == [
        ("AA", True),
        (None, None),
    ]
    assert df.schema == contracts.COMPANY_MANIFEST


def test_manifest_file(spark, tmp_path):
    path = tmp_path / "m.json"
    path.write_text('{"title":"x","year":"2020"}\n{"title":"y"}\n')
    df = tables.read_manifest(spark, str(path), contracts.PAPER_MANIFEST)
    assert [(r.title, r.year) for r in df.orderBy("title").collect()] == [("x", "2020"), ("y", None)]


def test_tables(spark):
    tables.create_schema(spark, "quire_t")
    tables.create_schema(spark, "quire_t")
    df = spark.range(5).withColumn("x", F.col("id") * 2)
    sinks.write_table(df, "quire_t.numbers")
    sinks.write_table(df.withColumn("y", F.lit("new")), "quire_t.numbers", rebalance=True)
    assert tables.read_table(spark, "quire_t.numbers").columns == ["id", "x", "y"]
    sinks.create_table_as(spark, "quire_t.big", "SELECT * FROM quire_t.numbers WHERE x > 4")
    sinks.create_table_as(spark, "quire_t.big", "SELECT * FROM quire_t.numbers WHERE x > 2")
    assert spark.table("quire_t.big").count() == 3
    staged = sinks.write_staged(df, "quire_t.results")
    staged = sinks.write_staged(df.limit(2), "quire_t.results")
    assert staged.count() == 2
    names = {r.table_name for r in tables.list_tables(spark, "quire_t").collect()}
    assert {"numbers", "big", "results_temp"} <= names
    assert "quire_t" in {r.schema_name for r in tables.list_schemas(spark).collect()}
    assert tables.list_catalogs(spark).count() >= 1
    assert tables.query(spark, "SELECT x FROM quire_t.numbers WHERE id = :id", id=3).first()[0] == 6
    assert tables.lookup(spark.table("quire_t.numbers"), id=3, y="new").count() == 1


def test_bucketed_folders_read_one_folder(spark, tmp_path):
    path = str(tmp_path / "pages")
    df = spark.range(200).select(
        F.concat(F.lit("d"), (F.col("id") % 7).cast("string")).alias("doc_id"), F.col("id").alias("page_number")
    )
    sinks.write_bucketed_folders(df, path, buckets=8)
    one = sinks.read_bucketed(spark, path, "doc_id", "d3", buckets=8)
    assert one.count() == df.filter("doc_id = 'd3'").count()
    assert "PartitionFilters: [isnotnull(doc_bucket" in one._jdf.queryExecution().executedPlan().toString()
    assert len([f for f in os.listdir(path) if f.startswith("doc_bucket=")]) <= 8


def test_export_keeps_scalars_only(spark, tmp_path):
    df = spark.createDataFrame([(1, "long " * 400, [1.0], 0.5)], "rank int, t string, v array<double>, score double")
    assert sinks.export_rows(df).columns == ["rank", "t", "score"]
    sinks.export_csv(df, str(tmp_path / "csv"))
    assert len(spark.read.option("header", True).csv(str(tmp_path / "csv")).first().t.strip()) == 1999


def test_observed_write(spark, tmp_path):
    seen = sinks.write_observed(spark.range(10), str(tmp_path / "o"), top=F.max("id"))
    assert (seen["rows_written"], seen["top"]) == (10, 9)
    assert seen["rows_per_second"] == pytest.approx(10 / seen["elapsed_seconds"])


def test_contract_check(spark):
    with pytest.raises(contracts.ContractError, match="doc_id is missing"):
        contracts.assert_contract(spark.range(1), contracts.PARSED_PAGES)


def test_stream_ingest_handles_only_new_files(spark, tmp_path):
    root, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    root.mkdir()

    def run():
        ingest.ingest(ingest.stream_files(spark, str(root)), out, state).awaitTermination()
        return spark.read.parquet(out).count()

    (root / "a.pdf").write_bytes(b"%PDF a")
    (root / "b.PDF").write_bytes(b"%PDF b")
    assert run() == 2
    (root / "c.pdf").write_bytes(b"%PDF c")
    (root / "skip.txt").write_bytes(b"x")
    assert run() == 3
    assert run() == 3


def test_scratch_tables_go_when_released(spark, tmp_path):
    """A released table's files are gone; one not released, and a frame that is no table, stay as they are."""
    made = [scratch.materialise(spark.range(100).groupBy(F.col("id") % 7).count(), "some") for _ in range(2)]
    places = [f.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file:") for f in made]
    assert all(os.path.isdir(p) for p in places)
    scratch.release(made[0], made[0], spark.range(3))
    assert not os.path.exists(places[0]) and made[1].count() == 7
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
