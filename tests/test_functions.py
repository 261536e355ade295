import datetime as dt

import pytest
from pyspark.sql import functions as F

from quire.functions import dates, ids, markup, payloads, predicates, sizes, text


def one(spark, rows, schema, *columns):
    out = spark.createDataFrame(rows, schema).select(*columns).collect()
    return [tuple(r) if len(r) > 1 else r[0] for r in out]


def test_path_parts(spark):
    rows = [("/a/b/Über Report.PDF",), ("x.tar.gz",), ("/a/.hidden",), ("/a/b.c/noext",), ("a.",)]
    got = one(spark, rows, "p string", text.base_name("p"), text.extension("p"), text.parent_dir("p"))
    assert got == [
        ("Über Report.PDF", ".pdf", "/a/b"),
        ("x.tar.gz", ".gz", ""),
        (".hidden", "", "/a"),
        ("noext", "", "/a/b.c"),
        ("a.", ".", ""),
    ]


def test_normalise_path(spark):
    rows = [("store:/volumes/a",), ("store:/x/a",), ("a",), ("/volumes/b",), ("/volumesx/b",)]
    got = one(spark, rows, "p string", text.normalise_path("p", "store:", "/volumes"))
    assert got == ["/volumes/a", "/volumes/x/a", "/volumes/a", "/volumes/b", "/volumes/volumesx/b"]


def test_safe_file_name(spark):
    rows = [('Größe: a/b <c> "d"?',), ("  two   words!  ",), ("50% (net) — x",)]
    got = one(spark, rows, "n string", text.safe_file_name("n"))
    assert got == ["Größe__a_b__c___d__", "_two_words_", "50_net_x"]
    again = one(spark, [(g,) for g in got], "n string", text.safe_file_name("n"))
    assert again == got


def test_file_names(spark):
    row = [("2017", "Lee et al.", "1706.1", "Rivers: all", "ACM", "Acme Group")]
    got = one(
        spark,
        row,
        "y string, a string, i string, t string, k string, c string",
        text.paper_file_name("y", "a", "i", "t"),
        text.report_file_name("k", "c"),
    )
    assert got == [("2017_Lee_1706.1_Rivers__all.pdf", "FY24_ACM_Acme_Group_Annual_Report.pdf")]


def test_owner_key(spark):
    assert one(spark, [("ann.lee@x.org",), (None,)], "e string", text.owner_key("e")) == ["ann_lee", None]
    assert one(spark, [("nobody",)], "e string", text.owner_key("e", strict=False)) == [None]
    with pytest.raises(Exception, match="not an email"):
        one(spark, [("nobody",)], "e string", text.owner_key("e"))


def test_url_origin(spark):
    rows = [("https://www.a.com:8443/x/y?z=1#f",), ("http://b.org",)]
    assert one(spark, rows, "u string", text.url_origin("u")) == ["https://www.a.com:8443/", "http://b.org/"]


def test_terms_and_keywords(spark):
    rows = [("résumé",), ("four",), ("abc123",), ("letters",)]
    assert one(spark, rows, "w string", text.is_term("w")) == [True, False, False, True]
    rows = [("I know it",), ("What is due NOW?",), ("older",)]
    assert one(spark, rows, "q string", text.contains_any("q", ["now"])) == [True, True, False]
    assert one(spark, rows, "q string", text.contains_any("q", ["now"], True)) == [False, True, False]


def test_preview_and_fallback(spark):
    rows = [("abcdef", "", "x"), ("ab", None, None), (None, "s", "t")]
    got = one(spark, rows, "a string, b string, c string", text.preview("a", 3, "..."), text.first_filled("b", "c"))
    assert got == [("abc...", "x"), ("ab", None), (None, "s")]


def test_ids_are_stable_and_content_based(spark):
    df = spark.createDataFrame([("/a", b"x"), ("/a", b"y"), ("/a", None)], "p string, c binary")
    def keys(frame):
        return {r[0] for r in frame.select(ids.document_id("p", "c")).collect()}

    assert len(keys(df)) == 3
    assert keys(df) == keys(df.repartition(5))
    assert one(spark, [("d", 3)], "d string, n int", ids.page_key("d", "n")) == ["d_page_3"]


def test_temporal_context(spark):
    rows = [(dt.date(2024, 6, 30),), (dt.date(2024, 7, 1),), (dt.date(2024, 12, 5),)]
    names = ["current_date", "current_day", "current_quarter", "financial_year", "season_context"]
    c = dates.temporal_context("d")
    got = one(spark, rows, "d date", *[c[n] for n in names])
    assert got[0][:4] == ("June 30, 2024", "Sunday", "Q2 2024", "FY2024 (July 2023 - June 2024)")
    assert got[1][:4] == ("July 01, 2024", "Monday", "Q3 2024", "FY2025 (July 2024 - June 2025)")
    assert got[0][4].startswith("Winter") and got[2][4].startswith("Summer")


def test_date_windows(spark):
    today = F.lit("2024-07-01").cast("date")
    rows = [(dt.date(2024, 6, 1),), (dt.date(2024, 5, 31),), (dt.date(2024, 8, 30),), (dt.date(2024, 8, 31),)]
    got = one(spark, rows, "d date", dates.is_recent("d", today), dates.is_upcoming("d", today))
    assert got == [(True, False), (False, False), (False, True), (False, False)]
    inside = one(spark, rows, "d date", dates.in_window("d", today), dates.in_window("d", today, "financial_year"))
    assert inside == [(True, False), (True, False), (True, True), (True, True)]
    due = one(spark, [(dt.date(2024, 6, 30),)], "d date", *[dates.filing_due("d", p) for p in ("quarter", "half", "year")])
    assert due == [(dt.date(2024, 8, 14), dt.date(2024, 9, 13), dt.date(2024, 10, 30))]
    with pytest.raises(ValueError):
        dates.filing_due("d", "week")


def test_size_borders(spark):
    rows = [(399_996, 4_194_303), (400_000, 10), (399_999, 4_194_304)]
    got = one(spark, rows, "c long, b long", sizes.document_class("c", "b"))
    assert got == ["SMALL_DOC", "LARGE_DOC", "LARGE_DOC"]
    rows = [(1_048_575,), (1_048_576,), (10_485_759,), (10_485_760,)]
    assert [g.split()[0] for g in one(spark, rows, "b long", sizes.file_size_class("b"))] == [
        "Small", "Medium", "Medium", "Large",
    ]
    rows = [(0,), (1,), (1999,), (2000,), (3999,), (4000,)]
    assert one(spark, rows, "c long", sizes.estimated_pages("c")) == [0, 1, 1, 1, 1, 2]


def test_stored_size_check(spark):
    rows = [(b"abc", 3), (None, 3), (b"abc", 4), (b"abc", None)]
    got = one(spark, rows, "c binary, n long", sizes.stored_size_check("c", "n"))
    assert got == ["match", "no content", "mismatch", "mismatch"]


def test_predicates(spark):
    rows = [
        (".pdf", b"%PDF-1", 52_428_800),
        (".pdf", b"x", 52_428_801),
        (".pdf", b"", 0),
        (".pdf", None, 5),
        (".doc", b"%PDF", 5),
    ]
    schema = "file_extension string, binary_content binary, file_size_bytes long"
    got = one(spark, rows, schema, predicates.extractable(), predicates.splittable(), predicates.is_pdf_body("binary_content"))
    assert got == [
        (True, True, True),
        (True, False, False),
        (True, False, False),
        (False, False, None),
        (False, False, True),
    ]
    rows = [(".pdf", 104_857), (".pdf", 104_858), (".txt", 1)]
    assert one(spark, rows, "e string, n long", predicates.suspect_file("e", "n")) == [True, False, False]
    rows = [("a",), ("b",)]
    assert one(spark, rows, "c string", predicates.in_categories("c", ["all"])) == [True, True]
    assert one(spark, rows, "c string", predicates.in_categories("c", ["b"])) == [False, True]
    assert one(spark, [("",), (None,), (" ",)], "t string", predicates.has_text("t")) == [False, False, True]


def test_status_filter(spark):
    df = spark.createDataFrame([(True, ".pdf"), (False, ".pdf"), (False, ".doc")], "extraction_success boolean, file_extension string")
    assert df.filter(predicates.status_filter()).count() == 3
    assert df.filter(predicates.status_filter("Failed")).count() == 2
    assert df.filter(predicates.status_filter("Failed", ".pdf")).count() == 1
    with pytest.raises(ValueError):
        predicates.status_filter("Odd")


def test_html_to_markdown(spark):
    html = (
        "<html><head><title>T</title></head><body><script>var x='<b>';</script><h2 class='a'>Head &amp; tail</h2>"
        "<p>One <b>bold</b> <a href=\"/x\">link</a></p><ul><li>a</li><li>b &lt;c&gt;</li></ul><!-- no --></body></html>"
    )
    got = one(spark, [(html,)], "h string", markup.html_to_markdown("h"))[0]
    assert got == "## Head & tail\n\nOne **bold** [link](/x)\n\n- a\n- b <c>"


MARKDOWN = [
    ("<ul><li>a<ul><li>b <b>c</b> d</ul><li>e</ul>", "- a\n  - b **c** d\n- e"),
    ("<ol><li>x<li>y<ol><li>z</ol></ol><p>after", "1. x\n2. y\n  1. z\n\nafter"),
    ("<p>&#8217;&#x2019;&mdash;&lt;b&gt; &amp;amp; R&amp", "’’—<b> &amp; R&"),
    ("<a href='/q?a=1&amp;b=2' title=\"x > y\">to <i>it</i></a> <a name=n>no</a>", "[to _it_](/q?a=1&b=2) no"),
    ("<p><b>open<br>line<p>next</b></p> <i></i>end", "open\nline\n\nnext\n\nend"),
    ("one <b>two </b>three<b> four</b>", "one **two** three **four**"),
    ("<h1> A  b </h1>\n<h5>c</h5>text", "# A b\n\n#### c\n\ntext"),
    ("<table><tr><td>1</td><td>2</td></tr><tr><th>3</th></tr></table>", "1 | 2 |\n3 |"),
    ("<script>if (a<b) x='</p>'</script><style>p{}</style>a<!-- <p> -->b<scr", "ab"),
    ("a < b <c", "a < b"),
    ("<p>1<br><br>2<hr>3", "1\n\n2\n3"),
    ("", ""),
]


def test_markdown_texts(spark):
    assert [markup.to_markdown(html) for html, _ in MARKDOWN] == [want for _, want in MARKDOWN]
    assert one(spark, [(h,) for h, _ in MARKDOWN] + [(None,)], "h string", markup.html_to_markdown("h")) == [
        *(w for _, w in MARKDOWN),
        None,
    ]
    nested = "<ul><li>" * 5_000 + "<b>" * 5_000 + "x" + "</b>" * 5_000
    assert len(markup.to_markdown(nested + "&amp;" * 200_000)) > 200_000


def test_payload_round_trip(spark):
    df = spark.createDataFrame([("read this", b"\x01" * 100)], "p string, i binary")
    body = df.select(payloads.chat_payload("p", "i").alias("b")).first()[0]
    assert "\\r" not in body and '"image_url":{"url":"data:image/jpeg;base64,AQEB' in body
    answers = [('{"choices":[{"message":{"content":"hi"}}]}',), ('{"choices":[]}',), ("broken",), (None,)]
    assert one(spark, answers, "b string", payloads.payload_answer("b")) == ["hi", None, None, None]


def test_metadata_is_json(spark):
    df = spark.createDataFrame([("a\"b", "")], "t string, s string")
    made = df.select(payloads.page_metadata(title="t", subject="s").alias("m"))
    assert made.first()[0] == '{"title":"a\\"b"}'
    assert made.select(payloads.decode_metadata("m")["title"]).first()[0] == 'a"b'


def test_bad_bytes_are_rows(spark):
    """A body that is no text, a missing body and a missing extension are failed rows with a message."""
    from quire.contracts import DOCUMENT_STORE
    from quire.operators.extract import extract

    rows = [(".pdf", b"\xff\xfe"), (".pdf", b"fine"), (".pdf", None), (None, b"fine"), (".zip", b"fine")]
    store = spark.createDataFrame(rows, "file_extension string, binary_content binary")
    for field in DOCUMENT_STORE.fields:
        if field.name not in store.columns:
            store = store.withColumn(field.name, F.lit(None).cast(field.dataType))
    got = [(r.extraction_success, r.markdown_content, r.error_message) for r in extract(store).collect()]
    assert [g[0] for g in got] == [False, True, False, False, False]
    assert got[1][1] == "fine" and all(g[2] for g in got if not g[0])


def test_markup_head_links_and_entities(spark):
    from quire.functions.markup import html_to_markdown

    page = "<head><script>x</script><title>T</title></head><body>hi <a href='/u'>l</a> it&apos;s</body>"
    assert spark.createDataFrame([(page,)], "h string").select(html_to_markdown("h")).first()[0] == "hi [l](/u) it's"
