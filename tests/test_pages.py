import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire import contracts
from quire.operators import answers, extract, joins, pages, reports


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=60), max_size=6), size=st.integers(1, 9))
def test_pages_join_back_to_the_text(spark, texts, size):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, t string")
    split = pages.split_text_pages(df, "t", pages.fixed_size_pages("t", size), "page")
    back = {}
    for r in sorted(split.collect(), key=lambda r: (r.doc_id, r.page_number)):
        back.setdefault(r.doc_id, []).append(r.page)
        assert r.total_pages == -(-len(texts[r.doc_id]) // size)
        assert r.page_number == len(back[r.doc_id])
    assert {k: "".join(v) for k, v in back.items()} == {i: t for i, t in enumerate(texts) if t}


def test_no_page_for_missing_text(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, " "), (4, "x\fy\f")], "doc_id long, t string")
    assert [r.doc_id for r in pages.split_text_pages(df, "t").collect()] == [3, 4]
    by_break = pages.split_text_pages(df, "t", pages.break_pages("t"), "p").filter("doc_id = 4")
    assert [(r.page_number, r.p, r.total_pages) for r in by_break.collect()] == [(1, "x", 3), (2, "y", 3), (3, "", 3)]


def test_binary_pages_isolate_errors(spark):
    def cut(body):
        if body == b"bad":
            raise OSError("cannot open")
        return [ValueError("page") if p == b"!" else p for p in body.split(b",")]

    df = spark.createDataFrame([("d1", b"a,!,c"), ("d2", b"bad"), ("d3", b"z")], "doc_id string, binary_content binary")
    got = sorted(
        (tuple(r) for r in pages.split_binary_pages(df, cut, ["doc_id"]).collect()), key=lambda r: (r[0], r[1] or 0)
    )
    assert got == [
        ("d1", 1, 3, b"a", None),
        ("d1", 3, 3, b"c", None),
        ("d2", None, None, None, "OSError: cannot open"),
        ("d3", 1, 1, b"z", None),
    ]


def store(spark):
    rows = [
        ("a.pdf", ".pdf", b"alpha"),
        ("b.doc", ".doc", b"beta"),
        ("c.pdf", ".pdf", None),
        ("d.pdf", ".pdf", b""),
        ("e.pdf", ".pdf", b"\xc3\xa9" * 4000),
    ]
    full = [(n, "/v/" + n, e, len(c or b""), dt.datetime(2024, 1, 1), "/v", c) for n, e, c in rows]
    return spark.createDataFrame(full, contracts.DOCUMENT_STORE)


@pytest.mark.parametrize("how", ["native", "python"])
def test_extraction_statuses(spark, how):
    df = store(spark)
    out = extract.extract(df) if how == "native" else extract.extract_with(df, lambda b, n: b.decode())
    contracts.assert_contract(out, contracts.DOCUMENT_MARKDOWN)
    got = {r.file_name: (r.extraction_success, r.error_message, r.character_count, r.page_count) for r in out.collect()}
    assert got == {
        "a.pdf": (True, None, 5, 1),
        "b.doc": (False, "Unsupported file type: .doc", 0, 0),
        "c.pdf": (False, "No binary data provided", 0, 0),
        "d.pdf": (True, None, 0, 0),
        "e.pdf": (True, None, 4000, 2),
    }


def test_parser_errors_become_rows(spark):
    def parse(body, name):
        raise ValueError("broken " + name)

    got = extract.extract_with(store(spark), parse).filter("file_name = 'a.pdf'").first()
    assert got.error_message == "ValueError: broken a.pdf" and not got.extraction_success


def test_require_rows(spark):
    assert extract.require_rows(spark.range(1), "none").count() == 1
    with pytest.raises(ValueError, match="none"):
        extract.require_rows(spark.range(0), "none")


def test_attach_results_uses_the_whole_page_key(spark):
    p = spark.createDataFrame([("d", i, "t") for i in range(1, 4)], "doc_id string, page_number int, x string")
    r = spark.createDataFrame([("d", 1, "one"), ("d", 3, "three")], "doc_id string, page_number int, result string")
    got = joins.attach_results(p, r).orderBy("page_number").collect()
    assert [x.result for x in got] == ["one", None, "three"]
    with pytest.raises(ValueError, match="both sides"):
        joins.attach_results(p, r.withColumn("x", F.lit(1)))


def test_skip_existing_border(spark):
    plan = spark.createDataFrame([("/a",), ("/b",), ("/c",)], "target_path string")
    have = spark.createDataFrame([("/a", 104_858), ("/b", 104_857)], "volume_path string, file_size_bytes long")
    assert sorted(r[0] for r in joins.skip_existing(plan, have).collect()) == ["/b", "/c"]


def test_prompts_cut_large_documents(spark):
    rows = [("s", 10, 10, "short"), ("l", 400_004, 500_000, "x" * 300_001)]
    df = spark.createDataFrame(rows, "n string, character_count long, file_size_bytes long, markdown_content string")
    got = {r.n: r.p for r in df.select("n", answers.routed_prompt().alias("p")).collect()}
    assert got["s"] == answers.FULL_HEAD + "short" + answers.FULL_TAIL
    assert got["l"] == answers.BRIEF_HEAD + "x" * 300_000 + answers.BRIEF_NOTE + answers.BRIEF_TAIL


def test_answers(spark):
    df = spark.createDataFrame([("a", "q1"), ("b", "boom"), ("c", None)], "k string, prompt string")

    def model(p):
        if p == "boom":
            raise RuntimeError("no")
        return p.upper()

    got = {r.k: tuple(r.analysis_result) for r in answers.call_model(df, model).collect()}
    assert got == {"a": ("Q1", None), "b": (None, "RuntimeError: no"), "c": (None, None)}


def test_client_is_set_up_once_a_task(spark):
    """Calls hold as many prompts as asked for; a failing call is taken apart; answers may be exceptions."""
    df = spark.createDataFrame([(i, f"q{i}" if i % 10 else None) for i in range(100)], "k long, prompt string").repartition(1)

    def connect():
        calls = []

        def client(texts):
            calls.append(len(texts))
            if "q55" in texts:
                raise TimeoutError("late")
            return [KeyError(t) if t == "q7" else f"{t} {len(calls)} {len(texts)}" for t in texts]

        return client

    got = {r.k: tuple(r.analysis_result) for r in answers.call_client(df, connect, batch_rows=16).collect()}
    assert got[10] == (None, None) and got[55] == (None, "TimeoutError: late") and got[7] == (None, "KeyError: 'q7'")
    right = {k: v[0].split(" ") for k, v in got.items() if v[0]}
    assert all(v[0] == f"q{k}" for k, v in right.items()) and len(right) == 88
    calls = {int(v[1]) for v in right.values()}
    # 90 prompts in calls of 16, one of them asked again one by one: the client kept its count throughout
    assert len(calls) == 5 + 15 and max(int(v[2]) for v in right.values()) == 16


def test_bucketed_tables_join_without_a_shuffle(spark, sf):
    from quire.plans.page_queries import bucketed_join

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = bucketed_join(spark, sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("SortMergeJoin") == 2 and "Exchange" not in plan
    assert df.count() > 0


def test_flatten_drops_empty_answers(spark):
    rows = [("/1", ("text", None)), ("/2", (None, "err")), ("/3", ("", None))]
    schema = T.StructType([T.StructField("file_path", T.StringType()), T.StructField("analysis_result", contracts.ANSWER)])
    df = spark.createDataFrame(rows, schema)
    for f in contracts.ANALYSIS.fields:
        if f.name not in df.columns:
            df = df.withColumn(f.name, F.lit(None).cast(f.dataType))
    flat = answers.flatten_answers(df)
    contracts.assert_contract(flat, contracts.FLATTENED_ANALYSIS)
    assert [r.file_path for r in flat.collect()] == ["/1"]
    assert answers.failed_rows(df).count() == 1 and answers.succeeded_rows(df).count() == 2
    assert set(answers.with_provenance(df, "m", mode="x").columns) >= {"model_used", "mode", "processed_at"}


def test_reports_on_empty_input(spark):
    empty = extract.extract(store(spark).filter("1 = 0"))
    row = reports.extraction_stats(empty).first()
    assert (row.successful, row.failed, row.success_rate, row.total_characters) == (0, 0, 0.0, 0)
    assert reports.total_size(empty).first().total_bytes == 0
    no_pages = spark.createDataFrame([], "doc_id string, page_number int, total_pages int, ocr_text string")
    assert reports.page_monitor(no_pages).first().avg_pages_per_document == 0.0


def test_page_monitor_counts_documents_with_a_missing_page(spark):
    rows = [("a", 1, 2, "x"), ("a", 2, 2, None), ("b", 1, 1, "y")]
    df = spark.createDataFrame(rows, "doc_id string, page_number int, total_pages int, ocr_text string")
    row = reports.page_monitor(df).first()
    assert (row.total_documents, row.total_pages, row.documents_with_failures) == (2, 3, 1)


def test_binary_pages_hold_every_document(spark, sf):
    """Documents of every extension, and an error row for each body that cannot be read."""
    from quire.plans.corpus import store
    from quire.plans.page_queries import binary_pages

    bodies = {str(r.doc_id): r.binary_content for r in store(spark, sf).select("doc_id", "binary_content").collect()}
    rows = binary_pages(spark, sf).collect()
    assert {r.doc_id for r in rows} == {k for k, v in bodies.items() if v is None or len(v)}
    failed = [r.doc_id for r in rows if r.error_message is not None]
    broken = {k for k, v in bodies.items() if v and any(v.decode()[i] == "\n" for i in range(0, len(v.decode()), 2000))}
    assert failed and sorted(failed) == sorted({k for k, v in bodies.items() if v is None} | broken)


def test_pages_before_an_error_stay(spark):
    """Pages come one by one: those before a break, the number of the failing one, and no more bytes held than asked for."""

    def lazily(body):
        for k in range(4):
            if body == b"bad" and k == 2:
                raise ValueError("torn")
            yield ValueError("skipped") if body == b"gap" and k == 1 else body * 10

    df = spark.createDataFrame([("a", b"bad"), ("b", b"gap"), ("c", None), ("d", b"ok")], "doc_id string, binary_content binary")
    for size in (1, 1 << 20):
        got = {}
        for r in pages.split_binary_pages(df, lazily, ["doc_id"], batch_bytes=size).collect():
            got.setdefault(r.doc_id, []).append((r.page_number, r.total_pages, r.page_image_png, r.error_message))
        assert got["a"] == [(1, None, b"bad" * 10, None), (2, None, b"bad" * 10, None), (3, None, None, "ValueError: torn")]
        assert [r[0] for r in got["b"]] == [1, 3, 4] and [r[0] for r in got["d"]] == [1, 2, 3, 4]
        assert got["c"] == [(None, None, None, "TypeError: cannot convert 'NoneType' object to bytes")]
