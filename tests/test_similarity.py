import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.functions.vectors import with_unit
from quire.operators import approximate, search, similarity, terms


def frame(spark, matrix, ids, name="id", **extra):
    rows = [(i, [float(x) for x in v], *[c[n] for c in extra.values()]) for n, (i, v) in enumerate(zip(ids, matrix))]
    kind = "string" if isinstance(ids[0], str) else "long"
    more = "".join(f", {k} {'string' if isinstance(c[0], str) else 'long'}" for k, c in extra.items())
    return spark.createDataFrame(rows, f"{name} {kind}, vector array<double>{more}")


def brute(matrix, ids, asked, qids, k, allowed=lambda q, i: True):
    def unit(m):
        n = np.linalg.norm(m, axis=1, keepdims=True)
        return m / np.where(n > 0, n, 1)

    scores = np.round(unit(asked) @ unit(matrix).T, 12) + 0.0
    out = set()
    for qi, q in enumerate(qids):
        hits = [(-scores[qi, i], d) for i, d in enumerate(ids) if allowed(q, i) and np.any(matrix[i])]
        for rank, (s, d) in enumerate(sorted(hits)[:k], 1):
            out.add((q, d, round(float(-s), 6) + 0.0, rank))
    return out


def as_set(df):
    return {(r.question_id, r.id, r.score, r["rank"]) for r in df.collect()}


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(7)
    matrix = rng.integers(-2, 3, size=(400, 6)).astype(float)  # many equal scores
    matrix[5] = 0
    return matrix, rng.integers(-2, 3, size=(30, 6)).astype(float) + 0.25


def test_exact_search_equals_brute_force(spark, data):
    matrix, asked = data
    ids, qids = list(range(400)), list(range(100, 130))
    got = similarity.top_k(frame(spark, matrix, ids).repartition(7), frame(spark, asked, qids, "question_id"), 5)
    assert as_set(got) == brute(matrix, ids, asked, qids, 5)


def test_more_questions_than_a_block(spark, data):
    matrix, asked = data
    ids, qids = [f"d{i:03}" for i in range(400)], list(range(30))
    got = similarity.top_k(
        frame(spark, matrix, ids).repartition(3), frame(spark, asked, qids, "question_id"), 4, block_rows=7
    )
    assert as_set(got) == brute(matrix, ids, asked, qids, 4)


def test_search_within_a_document(spark, data):
    matrix, asked = data
    docs = [f"f{i % 3}" if i % 3 else "hot" for i in range(400)]
    qids = list(range(30))
    own = [["hot", "f1", "none"][q % 3] for q in qids]
    index = frame(spark, matrix, list(range(400)), doc=docs).repartition(5)
    questions = frame(spark, asked, qids, "question_id", own=own)
    got = similarity.within(index, questions, 3, "doc", "own")
    assert as_set(got) == brute(matrix, list(range(400)), asked, qids, 3, lambda q, i: docs[i] == own[q])


@pytest.mark.parametrize("most", [200_000, 10])
def test_scopes_sent_or_joined(spark, data, monkeypatch, most):
    """Two scopes at once, as lists sent to the tasks and, beyond their bound, by a join; blocks of questions too."""
    monkeypatch.setattr(similarity, "MAX_SCOPE_ROWS", most)
    matrix, asked = data
    docs, tags = [f"f{i % 7}" for i in range(400)], [f"t{i % 5}" for i in range(400)]
    qids = list(range(30))
    index = frame(spark, matrix, list(range(400)), doc=docs, tag=tags).repartition(5)
    questions = frame(spark, asked, qids, "question_id")
    files = spark.createDataFrame([(q, f"f{(q + j) % 7}") for q in qids for j in range(2)] + [(0, None)], "question_id long, doc string")
    marks = spark.createDataFrame([(q, f"t{q % 5}") for q in qids if q % 2], "question_id long, tag string")

    def allowed(q, i):
        return docs[i] in (f"f{q % 7}", f"f{(q + 1) % 7}") or (q % 2 and tags[i] == f"t{q % 5}")

    for rows in (16_384, 7):
        got = similarity.top_k(index, questions, 3, scope=[(files, "doc"), (marks, "tag")], block_rows=rows)
        assert as_set(got) == brute(matrix, list(range(400)), asked, qids, 3, allowed)


def test_keyed_index_reads_the_folders_of_its_keys(spark, data, tmp_path):
    matrix, asked = data
    docs = [f"f{i % 40}" for i in range(400)]
    index = similarity.write_keyed_index(frame(spark, matrix, list(range(400)), doc=docs), "doc", str(tmp_path / "keyed"))
    questions = frame(spark, asked[:2], [0, 1], "question_id", own=["f3", "none"])
    got = similarity.within(index, questions, 3, "doc", "own")
    plan = got._jdf.queryExecution().toString()
    assert "PartitionFilters: [key_folder" in plan and "PushedFilters: [" in plan and "doc" in plan
    assert as_set(got) == brute(matrix, list(range(400)), asked[:2], [0, 1], 3, lambda q, i: q == 0 and docs[i] == "f3")


@pytest.mark.parametrize("window", ["recent", "upcoming", "quarter", "financial_year"])
def test_windows_read_the_months_they_touch(spark, tmp_path, window):
    from quire.functions import dates

    days = spark.sql("SELECT id, date_add(DATE '2022-01-01', cast(id * 3 AS int)) AS day FROM range(500)")
    days = days.union(spark.sql("SELECT 999L, CAST(NULL AS DATE)"))
    index = search.write_dated_index(days, "day", str(tmp_path / "dated"))
    today = F.lit("2024-02-10").cast("date")
    old = {
        "recent": dates.is_recent,
        "upcoming": dates.is_upcoming,
        "quarter": dates.same_quarter,
        "financial_year": dates.same_financial_year,
    }[window]
    found = search.dated(index, "day", today, window)
    want = {r.id for r in days.filter(old("day", today)).collect()}
    assert {r.id for r in found.collect()} == want and want
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(index_month" in plan
    assert search.dated(index, "day", today, None).count() == 501


def test_top_k_per_group(spark, data):
    matrix, asked = data
    docs = [f"f{i % 4}" for i in range(400)]
    index = frame(spark, matrix, list(range(400)), doc=docs).repartition(5)
    questions = frame(spark, asked, list(range(30)), "question_id")
    got = similarity.top_k(index, questions, 2, group="doc")
    want = set()
    for d in set(docs):
        want |= brute(matrix, list(range(400)), asked, list(range(30)), 2, lambda q, i: docs[i] == d)
    assert as_set(got) == want


def test_no_questions_gives_no_rows(spark, data):
    matrix, asked = data
    questions = frame(spark, asked, list(range(30)), "question_id").filter("question_id < 0")
    assert similarity.top_k(frame(spark, matrix, list(range(400))), questions, 3).count() == 0


def near_data(rows=1200):
    """Vectors in groups, and a question near each group's first vector."""
    rng = np.random.default_rng(3)
    matrix = np.repeat(rng.normal(size=(rows // 12, 24)), 12, axis=0) + rng.normal(scale=0.12, size=(rows, 24))
    return matrix, matrix[::12] + rng.normal(scale=0.05, size=(rows // 12, 24))


@pytest.mark.parametrize("hot_rows", [approximate.HOT_ROWS, 3])
def test_approximate_search(spark, tmp_path, hot_rows):
    """Exact scores, the planted neighbour in nine of ten, few rows scored; hot keys over several salts give the same."""
    matrix, near = near_data()
    index, asked = frame(spark, matrix, list(range(1200))), frame(spark, near, list(range(100)), "question_id")
    written = approximate.write_index(index, str(tmp_path / "lsh"), bits=6, hot_rows=hot_rows)
    assert (written.hot.count() > 0) == (hot_rows == 3)
    hits = as_set(approximate.search_index(written, asked, 5))
    exact = {(q, d): s for q, d, s, _ in brute(matrix, list(range(1200)), near, list(range(100)), 1200)}
    assert all(exact[q, d] == s for q, d, s, _ in hits)
    assert len({q for q, d, _, r in hits if d == 12 * q and r == 1}) >= 90
    want = {(q, d) for q, d, _, _ in brute(matrix, list(range(1200)), near, list(range(100)), 5)}
    assert len({(q, d) for q, d, _, _ in hits} & want) >= 0.9 * len(want)
    numbered = with_unit(asked.withColumn("asked", F.col("question_id")), "vector", "vector")
    assert approximate.candidates(written, numbered).count() < 0.2 * 1200 * 100


def test_approximate_search_reads_few_folders(spark, tmp_path):
    matrix, near = near_data()
    written = approximate.write_index(frame(spark, matrix, list(range(1200))), str(tmp_path / "lsh"), folders=64)
    asked = frame(spark, near[:1], [7], "question_id")
    plan = approximate.candidates(written, asked.select(F.lit(1).alias("asked"), "vector"))._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(folder" in plan or "PartitionFilters: [folder" in plan
    assert written.postings.select("folder").distinct().count() > 8


def test_approximate_edge_rows(spark, tmp_path):
    """Repeated and null ids, rows without a direction, questions without one, an empty index."""
    rows = [(None, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None)]
    index = spark.createDataFrame(rows, "id long, vector array<double>")
    asked = spark.createDataFrame([("q", [2.0, 0.0]), ("q", [2.0, 0.0]), (None, [0.0, 0.0])], "question_id string, vector array<double>")
    hits = approximate.approximate_top_k(index, asked, 2).collect()
    assert sorted((r.question_id, str(r.id), r.score, r["rank"]) for r in hits) == [("q", "1", 1.0, 2)] * 2 + [("q", "None", 1.0, 1)] * 2
    assert approximate.approximate_top_k(index.filter("false"), asked, 2).count() == 0


def test_unit_vectors(spark):
    df = frame(spark, np.array([[3.0, 4.0], [0.0, 0.0]]), [1, 2])
    assert [r.u for r in with_unit(df, "vector", "u").collect()] == [[0.6, 0.8]]


def test_hashed_vectors_count_every_word(spark):
    text = "Alpha beta\n alpha  gamma " * 3000
    df = spark.createDataFrame([(1, text), (2, "  "), (3, None)], "id long, t string")
    rows = similarity.embed(df, "t").collect()
    assert [r.id for r in rows] == [1] and sum(rows[0].vector) == 12_000


def test_term_weights_against_plain_python(spark):
    """Scores of all documents that share a weighing word; a word of every document weighs nothing."""
    import math

    rng = np.random.default_rng(2)
    texts = {i: " ".join(["the", *(f"w{x}" for x in rng.zipf(1.6, 12) if x < 40)]) for i in range(120)}
    asked = {1: "The w1 w2 w2", 2: "w7", 3: "the", 4: "", 5: "unknown w1"}
    df = {}
    for t in texts.values():
        for w in set(t.split()):
            df[w] = df.get(w, 0) + 1

    def weights(t):
        ws = t.lower().split()
        raw = {w: ws.count(w) * math.log((1 + len(texts)) / (1 + df[w])) for w in set(ws) if w in df}
        raw = {w: x for w, x in raw.items() if x > 0}
        size = math.sqrt(sum(x * x for x in raw.values()))
        return {w: x / size for w, x in raw.items()}

    want = set()
    for q, t in asked.items():
        own = weights(t)
        scores = {d: round(sum(x * own[w] for w, x in weights(b).items() if w in own), 12) for d, b in texts.items() if set(own) & set(weights(b))}
        for rank, (d, s) in enumerate(sorted(scores.items(), key=lambda p: (-p[1], p[0]))[:4], 1):
            want.add((q, d, round(s, 6), rank))
    docs = spark.createDataFrame(list(texts.items()), "id long, t string")
    questions = spark.createDataFrame(list(asked.items()), "question_id long, question_text string")
    assert as_set(terms.search_terms(terms.term_index(docs, "id", "t"), questions, 4)) == want


def indexes(spark):
    summaries = spark.createDataFrame(
        [("s1", "a.pdf", [1.0, 0.0]), ("s2", "b.pdf", [0.0, 1.0]), ("s3", None, [1.0, 1.0])],
        "id string, file_name string, vector array<double>",
    )
    pages = spark.createDataFrame(
        [(f"p{i}", ["a.pdf", "b.pdf", "c.pdf"][i % 3], [1.0, float(i)]) for i in range(30)],
        "id string, source_filename string, vector array<double>",
    )
    return summaries, pages


def asked(spark, rows):
    df = spark.createDataFrame(rows, "question_id long, question_text string, vector array<double>")
    return search.with_search_plan(df)


def test_two_stages_use_the_parameters_of_the_question(spark):
    summaries, pages = indexes(spark)
    questions = asked(spark, [(1, "what is it", [1.0, 0.1]), (2, "the latest report", [1.0, 0.1])])
    hits = search.two_stage_search(summaries, pages, questions).collect()
    per = {q: [h for h in hits if h.question_id == q] for q in (1, 2)}
    assert len(per[1]) == 6 and len(per[2]) == 8  # 3 and 4 chunks of two files
    assert {h.file_name for h in hits} == {"a.pdf", "b.pdf"} and {h.n_files for h in hits} == {2}
    ordered = sorted(per[1], key=lambda h: h.position)
    assert [h.file_name for h in ordered] == ["a.pdf"] * 3 + ["b.pdf"] * 3


def test_two_stages_over_an_index_in_folders(spark, tmp_path):
    """The second stage reads the folders of the files found, and finds what it finds in one table."""
    summaries, pages = indexes(spark)
    keyed = similarity.write_keyed_index(pages, "source_filename", str(tmp_path / "pages"))
    questions = asked(spark, [(1, "what is it", [1.0, 0.1]), (2, "the latest report", [0.1, 1.0])])
    found = [search.two_stage_search(summaries, p, questions) for p in (pages, keyed)]
    assert [sorted(map(tuple, f.collect())) for f in found][0] == sorted(map(tuple, found[1].collect()))
    assert "PartitionFilters: [key_folder" in found[1]._jdf.queryExecution().toString()


def test_names_fall_back(spark):
    """The first filled of the fields that may name a file counts; a summary without any names none."""
    rows = [("s1", None, "", "c.pdf", [1.0, 0.0]), ("s2", "", "b.pdf", "x", [0.9, 0.1]), ("s3", None, None, None, [1.0, 0.0])]
    kind = "id string, file_name string, filename string, source string, vector array<double>"
    questions = asked(spark, [(1, "what", [1.0, 0.0])])
    files = search.first_stage(spark.createDataFrame(rows, kind), questions).orderBy("file_rank").collect()
    assert [(f.file_name, f.n_files) for f in files] == [("c.pdf", 2), ("b.pdf", 2)]


def test_files_are_ordered_by_the_full_score(spark):
    """Two files whose scores agree in six digits: the better one comes first, whatever its name."""
    rows = [("s1", "a.pdf", [1.0, 0.0012]), ("s2", "z.pdf", [1.0, 0.0010])]
    summaries = spark.createDataFrame(rows, "id string, file_name string, vector array<double>")
    files = search.first_stage(summaries, asked(spark, [(1, "what", [1.0, 0.0])])).orderBy("file_rank").collect()
    assert [f.file_name for f in files] == ["z.pdf", "a.pdf"]


def test_without_files_the_whole_index_is_searched(spark):
    summaries, pages = indexes(spark)
    questions = asked(spark, [(1, "plain", [1.0, 0.1])])
    hits = search.two_stage_search(summaries.filter("file_name IS NULL"), pages, questions).collect()
    assert [h.mode for h in hits] == ["fallback"] * 5 and {h.n_chunks for h in hits} == {10}


def test_blocks(spark):
    summaries, pages = indexes(spark)
    questions = asked(spark, [(1, "plain", [1.0, 0.1]), (9, "none", [0.0, 0.0])])
    files = search.first_stage(summaries, questions)
    hits = search.two_stage_search(summaries, pages, questions, files)
    texts = pages.select("id", F.concat(F.lit("text of "), "id").alias("chunk_text"))
    blocks = {r.question_id: r.block for r in search.render_hits(questions, hits, texts, files).collect()}
    assert blocks[1].startswith("Found 6 chunks from 2 files.\nFiles: a.pdf, b.pdf\n\nChunk 1 (from a.pdf): text of p0")
    assert blocks[9].startswith("No content found")


def test_field_roles(spark):
    df = spark.createDataFrame([(1, "t", "f", 2, 0.5)], "rank int, analysis_result string, source_filename string, page_number int, score double")
    got = {r.field: (r.role, r.section) for r in search.hit_fields(df, ["rank"], df.columns[1:]).collect()}
    assert got == {
        "analysis_result": ("content", "other"),
        "source_filename": ("source", "other"),
        "page_number": ("page", "other"),
        "score": ("score", "other"),
    }


def test_numbered_breaks_ties_by_key(spark):
    df = spark.createDataFrame([(1, "b", 0.5), (1, "a", 0.5), (1, "c", 0.9)], "q int, id string, score double")
    assert {r.id: r["rank"] for r in search.numbered(df, ["q"]).collect()} == {"c": 1, "a": 2, "b": 3}


def test_repeated_null_and_large_ids(spark):
    """Each question row is answered by itself, in blocks or not; ids come back as they were."""
    big = 2**53 + 1
    index = spark.createDataFrame(
        [(None, [1.0, 0.0]), (big, [0.9, 0.1]), (3, [0.0, 1.0])], "id long, vector array<double>"
    )
    asked = spark.createDataFrame(
        [("q", [1.0, 0.0]), ("q", [1.0, 0.0]), ("q", [0.0, 1.0]), (None, [1.0, 0.0])],
        "question_id string, vector array<double>",
    )
    got = {}
    for rows in (2, 100):
        hits = similarity.top_k(index, asked, 2, block_rows=rows).collect()
        got[rows] = sorted((str(r.question_id), str(r.id), r.score, r["rank"]) for r in hits)
        assert len(hits) == 8
    assert got[2] == got[100]
    assert {r[1] for r in got[2]} == {"None", str(big), "3"}


def test_string_ids_stay_null(spark):
    index = spark.createDataFrame([(None, [1.0, 0.0]), ("a", [0.5, 0.5])], "id string, vector array<double>")
    asked = spark.createDataFrame([(1, [1.0, 0.0])], "question_id long, vector array<double>")
    assert [r.id for r in similarity.top_k(index, asked, 2).orderBy("rank").collect()] == [None, "a"]


def test_questions_without_words_have_answers(spark, sf, tmp_path):
    """Blank and null questions have a row in each report, and a block names every file its header counts."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    from quire.plans import search_queries as plans

    for name in ("documents", "benchmark"):
        table = pq.read_table(f"{sf}/{name}.parquet")
        if name == "benchmark":
            more = {"item_id": pa.array([9001, 9002]).cast(table.schema.field("item_id").type), "text": ["  ", None]}
            table = pa.concat_tables([table, pa.table(more, schema=table.schema.remove_metadata())])
        pq.write_table(table, tmp_path / f"{name}.parquet")
    folder = str(tmp_path)
    blocks = {r.question_id: r.block for r in plans.search_block(spark, folder).collect()}
    assert len(blocks) == len(table)
    assert blocks[9001] == blocks[9002] == "No content found for the files of this question."
    for block in blocks.values():
        if "Files: " in block:
            head, names = block.split("\n")[:2]
            assert int(head.split(" files")[0].split()[-1]) == len(names.removeprefix("Files: ").split(", "))
    summary = {r.question_id: r for r in plans.search_summary(spark, folder).collect()}
    assert len(summary) == len(table) and summary[9001].total_results == 0 and summary[9002].avg_relevance == "N/A"
    overlap = {r.question_id: r for r in plans.eval_overlap(spark, folder).collect()}
    assert len(overlap) == len(table) and overlap[9001].groundedness == overlap[9002].query_relevance == 0


def test_vectors_made_of_texts_are_made_once(spark):
    docs = spark.createDataFrame([(1, "one two"), (2, None), (3, "two")], "id int, text string")
    asked = similarity.embed(spark.createDataFrame([("q", "two")], "question_id string, t string"), "t")
    hits = similarity.top_k(similarity.embed(docs, "text"), asked, 2)
    plan = hits._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert [r.id for r in hits.orderBy("rank").collect()] == [3, 1]
    bare = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [0.0, 1.0])], "id int, vector array<double>")
    near = spark.createDataFrame([("q", [0.1, 1.0])], "question_id string, vector array<double>")
    assert [r.id for r in similarity.top_k(bare, near, 3).orderBy("rank").collect()] == [3, 1]


def test_texts_are_cut_into_slices():
    import pyarrow as pa

    from quire.functions.columns import text_slices

    texts = pa.array(["a" * 50, None, "b" * 500, "", *["c" * 30] * 40])
    found = list(text_slices(iter([texts, pa.array([], pa.string()), texts[:1]]), 400))
    assert pa.concat_arrays(found).equals(pa.concat_arrays([texts, texts[:1]]))
    assert all(len(part) == 1 or sum(len(t or "") + 64 for t in part.to_pylist()) <= 400 for part in found)


def test_term_index_shuffles_no_counts_and_splits_a_large_vocabulary(spark):
    rows = [(n, " ".join(f"W{m}" for m in range(40) if (n * 7 + m) % (m % 5 + 2) == 0) + f"\t x{n} x{n}") for n in range(60)]
    docs = spark.createDataFrame([*rows, (60, None), (61, " ")], "id long, t string")
    counted = terms.word_counts(docs, "id", "t")
    assert "Exchange" not in counted._jdf.queryExecution().executedPlan().toString()
    asked = spark.createDataFrame([(1, "w3 w4 X9"), (2, "w11 x1 none")], "question_id long, question_text string")
    whole = terms.term_index(docs, "id", "t")
    want = [tuple(r) for r in terms.search_terms(whole, asked, 70).orderBy("question_id", "rank").collect()]
    assert len(want) > 20
    lengths = {r.id: round(r.length, 9) for r in whole.lengths.collect()}
    for most in (0, 7, 45):
        split = terms.term_index(docs, "id", "t", most)
        assert {r.id: round(r.length, 9) for r in split.lengths.collect()} == lengths
        assert [tuple(r) for r in terms.search_terms(split, asked, 70).orderBy("question_id", "rank").collect()] == want
