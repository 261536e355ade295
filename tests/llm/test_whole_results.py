"""Whole results: skew, repeated rows, and every written stage of the pipeline against plain Python or SQL."""

import random
import re
import struct
import time
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quire.llm import (
    html_diff,
    licenses,
    line_dedup,
    oracles,
    packing,
    pieces,
    quality,
    queries,
    sharding,
    toxicity,
    word_runs,
)

SCHEMA = "doc_id long, text string"
SPACE = " \t\n\x0b\x0c\r"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def in_order(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: [(x is not None, x) for x in r])


def by_sql(sql, **tables):
    db = duckdb.connect()
    for name, table in tables.items():
        db.register(name, table)
    cursor = db.execute(sql)
    return [d[0] for d in cursor.description], cursor.fetchall()


# ---- op3 ----


def test_pages_do_not_depend_on_reused_exchanges(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    want = in_order(html_diff.extract_pages(pages).collect())
    assert len(want) == pages.count()
    spark.conf.set("spark.sql.exchange.reuse", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "29")
    try:
        assert in_order(html_diff.extract_pages(pages).collect()) == want
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert html_diff.extract_pages(pages.where("false")).count() == 0


def test_lines_are_packed_for_the_exchange(spark, sf):
    """What is dealt out is at most half of the lines, and gives the same lines again."""
    pages = [html_diff.parse(r.html or "").lines for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    pages += [["é 漢 😀 \x00 &", "b"]]
    assert all(html_diff._unpacked(html_diff._packed(lines)) == (lines or [""]) for lines in pages)
    packed = sum(len(html_diff._packed(lines)) for lines in pages)
    assert packed <= 0.5 * sum(len("\n".join(lines).encode()) for lines in pages)


def test_runs_over_many_ranges(spark):
    """A host of nothing but copies over all ranges, between two other pages, gives what one range gives."""
    rows = [(k, f"https://h.example/{k:04d}", "<p>menu</p><p>same</p>") for k in range(1, 300)]
    rows += [(0, "https://h.example/0000", "<p>menu</p><p>first</p>"), (300, "https://h.example/0300", "<p>menu</p><p>last</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = []
    for parts in ("1", "23"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            found.append(in_order(html_diff.extract_pages(df).collect()))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert found[0] == found[1] and len(found[0]) == 301
    assert {r[2] for r in found[0]} == {"first", "same", "last"}


# ---- op8 ----


def test_licenses_of_a_long_text(spark):
    """A text of hits grows in proportion: 200,000 places of a phrase, each of which a rule detects too."""
    text = "mit licence x under the MIT License; " * 100_000
    began = time.perf_counter()
    r = licenses.scan(spark.createDataFrame([(1, text), (2, "plain")], SCHEMA)).where("doc_id = 1").first()
    assert time.perf_counter() - began < 30
    assert (r.n_words, r.n_base, r.first_word, r.last_word) == (700_000, 100_000, 3, 699_996)
    assert r.base_labels == "mit" and "mit" in r.labels.split(",") and r.score == 0.9


def test_both_ways_to_place_detections(spark, monkeypatch):
    texts = ["Apache License, Version 2.0 gpl v2 or later, mit license mit license. " * k for k in (1, 3, 9)]
    df = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    found = []
    for walked in (0, 10_000):
        monkeypatch.setattr(licenses, "WALKED", walked)
        found.append(in_order(licenses.scan(df).collect()))
    assert found[0] == found[1] and "gpl" in str(found[0])


# ---- op9 ----


@pytest.mark.parametrize("parts", ["3", "17"])
def test_lines_count_every_row(spark, parts):
    """Rows without an id and equal rows count one by one, as in the SQL of the query."""
    rng = random.Random(2)
    rows = [(None, "shared by nulls\nown") for _ in range(12)] + [(7, "shared by copies\n shared BY copies ") for _ in range(12)]
    rows += [(k, "nine only") for k in range(100, 109)] + [(8, "twice\ntwice")] * 5 + [(9, None), (10, ""), (None, None)]
    rows += [(200 + k, "\n".join(rng.choice(["a", "b", "A ", "c d", ""]) for _ in range(5))) for k in range(25)]
    rng.shuffle(rows)
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = line_dedup.drop_shared_lines(spark.createDataFrame(rows, SCHEMA)).select(
            "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
        )
        got = in_order(got.collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    ids, texts = zip(*rows)
    table = pa.table({"doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.string())})
    names, want = by_sql(oracles.LINE_DEDUP, documents=table)
    want = [tuple(r[names.index(c)] for c in ("doc_id", "n_lines", "n_dropped", "kept_sha256")) for r in want]
    assert got == in_order(want)
    assert sum(r[2] for r in got) > 40


def test_first_lines_of_equal_rows_stay(spark):
    rows = [(1, "x\ny")] * 3 + [(k, "x") for k in range(2, 12)]
    got = line_dedup.drop_shared_lines(spark.createDataFrame(rows, SCHEMA), keep_first=True).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, set()).add(r.kept_text)
    # the least row by document hash and position keeps the line; equal rows keep it together
    kept = [d for d, t in by.items() if any("x" in x.split("\n") for x in t)]
    assert len(kept) == 1 and all(len(t) == 1 for t in by.values())


# ---- op1 ----


def test_quality_sample_is_drawn_from_all_rows(spark):
    docs = spark.range(200_000).selectExpr("id AS doc_id", "concat('word ', id) AS text").repartition(50)
    order, measured = quality.measure(docs, quality.text_rules(), sample_rows=500)
    assert sorted(order) == list(range(len(measured)))
    assert 300 <= max(m.rejected for m in measured) <= 700  # every row has too few words


# ---- op6 ----


def test_shards_against_plain_columns(spark, sf):
    """Sizes and checksums by hand, the same rows again on a second run, and every row's shard as likely as any."""
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op6_sharding(spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        body = (docs[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(body) + 1, zlib.crc32(body), "rows", None)
    assert in_order(rows) == in_order(queries.op6_sharding(spark, sf).collect())
    n, shards = 3_000, 6
    df = spark.range(0, n, 1, 7).withColumnRenamed("id", "x")
    counts = np.zeros((7, shards))
    for seed in range(8):
        placed = sharding.shuffle_to_shards(df, shards, seed).select("x", "shard").toArrow().to_pandas()
        part = (placed["x"].to_numpy() * 7) // n
        np.add.at(counts, (part, placed["shard"].to_numpy()), 1)
    expected = counts.sum(1, keepdims=True) / shards
    assert ((counts - expected) ** 2 / expected).sum() < 80  # 30 degrees of freedom


# ---- op7 ----


def test_scores_with_plain_edit_distance(spark, sf, monkeypatch):
    """The query's scores are those of a scorer that compares every word with every term by edit distance."""

    def distance(a, b, most):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            new = [i + 1]
            for j, y in enumerate(b):
                new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
            row = new
            if min(row) > most:
                return most + 1
        return row[-1]

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    held_out = toxicity.held_out()
    model = toxicity.learn(docs, spark.read.parquet(f"{sf}/labels.parquet"), held_out)
    got = {r.doc_id: r.score for r in toxicity.score_texts(docs, model).collect()}
    known = {}

    class Plain:
        def __init__(self, terms):
            self.terms = terms

        def match(self, word):
            if word not in known:
                fit = []
                for k, t in enumerate(self.terms):
                    cost = (0 if word.startswith(t.text) else 9) if t.stem else distance(word, t.text, t.edits)
                    if cost <= t.edits:
                        fit.append((cost, -t.weight, k))
                known[word] = (min(fit)[2], min(fit)[0]) if fit else None
            return known[word]

    monkeypatch.setattr(toxicity, "Matcher", Plain)
    scorer = toxicity.Scorer(model.terms, model.innocent)
    own = [r for r in docs.collect() if len(r.text) < 4_000][:60]
    x = scorer(pa.array([r.text for r in own]))
    w = np.array(model.weights)
    plain = 1 / (1 + np.exp(-(x @ w[:-1] + w[-1])))
    for r, score in zip(own, plain):
        assert abs(got[r.doc_id] - score) < 1e-9


# ---- clashing names ----


def test_results_replace_columns_of_their_names(spark):
    """Every operator that passes columns on, over rows that already hold each of its results."""
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    docs = spark.createDataFrame([(1, "a b c"), (2, None), (2, "")], SCHEMA)
    lexicon = toxicity.Model([toxicity.Term("x", False, 1.0)], [1.0] * 4 + [-2.0])
    runs = {
        lambda d: sharding.shuffle_to_shards(d, 2): {"shard", "SLOT"},
        lambda d: line_dedup.drop_shared_lines(d): {"kept_text", "N_lines", "n_dropped", "drop_bitmap"},
        lambda d: quality.features(d): {"n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"},
        lambda d: quality.quality_filter(d)[0]: {"failed_rule"},
        lambda d: packing.pack(d.withColumn("length", F.lit(5).cast("long"))): {"sequence_id", "offset"},
        lambda d: pieces.encode_documents(d, model, keep=d.columns): {"ids", "score"},
        lambda d: pieces.decode_documents(pieces.encode_documents(d, model, keep=d.columns), model): {"decoded"},
        lambda d: toxicity.score_texts(d, lexicon, keep=d.columns): {"score", "predicted"},
        lambda d: word_runs.collapse_runs(d): {"runs", "collapsed"},
    }
    for run, results in runs.items():
        got = run(docs.withColumns({c: F.lit("own") for c in (*results, "note")}))
        assert len({c.lower() for c in got.columns}) == len(got.columns)
        assert {r.lower() for r in results} <= {c.lower() for c in got.columns}
        rows = got.collect()
        assert len(rows) == 3 and all(r.note == "own" for r in rows)
        assert all(r[c] != "own" for r in rows for c in got.columns if c.lower() in {x.lower() for x in results})


# ---- pipeline ----


def plain_lines(texts):
    """Texts without the lines that ten or more of them share."""
    keys = [[x.strip(SPACE).translate(LOW) for x in t.split("\n")] for t in texts]
    held = {}
    for k in keys:
        for line in set(k) - {""}:
            held[line] = held.get(line, 0) + 1
    return ["\n".join(x for x, k in zip(t.split("\n"), ks) if held.get(k, 0) < 10) for t, ks in zip(texts, keys)]


def plain_groups(texts):
    """Least row of the group of near copies of each row."""
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", t.translate(LOW))
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = {}
    for k, s in enumerate(sets):
        for g in s:
            holders.setdefault(g, []).append(k)
    tried = set()
    for own in holders.values():
        for j in own:
            for i in own:
                if i < j and (i, j) not in tried:
                    tried.add((i, j))
                    if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                        a, b = find(i), find(j)
                        root[max(a, b)] = min(a, b)
    return [find(k) for k in range(len(texts))]


def test_written_stages(spark, sf, tmp_path, monkeypatch):
    """What each stage of run() wrote, against plain Python or SQL over what the stage before wrote; ids repeat."""
    import pyarrow.parquet as pq

    import corpus_pipeline as pipeline

    docs = pq.read_table(f"{sf}/documents.parquet")
    rows = docs.to_pylist()
    # unrelated texts under one id, an equal row, and rows without an id
    rows[5]["doc_id"] = rows[6]["doc_id"]
    rows += [dict(rows[9]), dict(rows[10], doc_id=None), dict(rows[11], doc_id=None, text=rows[11]["text"] + " and some more")]
    pq.write_table(pa.Table.from_pylist(rows, docs.schema), tmp_path / "documents.parquet")
    pq.write_table(pq.read_table(f"{sf}/labels.parquet"), tmp_path / "labels.parquet")
    paths = {}
    monkeypatch.setattr(pipeline, "scratch_path", lambda spark, name: paths.setdefault(name, f"{tmp_path}/{name}"))
    out = pipeline.run(spark, str(tmp_path))
    stage = {name: spark.read.parquet(path).collect() for name, path in paths.items()}
    assert list(stage) == [name for name, _ in pipeline.STAGES]
    before = [tuple(r[c] for c in pipeline.COLUMNS) for r in rows]

    table = pa.Table.from_pylist([dict(r, doc_id=k) for k, r in enumerate(rows)], docs.schema)
    names, verdicts = by_sql(oracles.QUALITY, documents=table)
    kept = {r[names.index("doc_id")] for r in verdicts if r[names.index("kept")]}
    assert in_order(stage["quality_rules"]) == in_order(r for k, r in enumerate(before) if k in kept)

    judged = spark.createDataFrame(stage["quality_rules"])
    model = toxicity.learn(judged, spark.read.parquet(f"{sf}/labels.parquet"), toxicity.held_out())
    scorer, w = toxicity.Scorer(model.terms, model.innocent), np.array(model.weights)
    x = scorer(pa.array([r.text for r in stage["quality_rules"]]))
    clean = 1 / (1 + np.exp(-(x @ w[:-1] + w[-1]))) < 0.7
    assert in_order(stage["toxicity"]) == in_order(r for r, ok in zip(stage["quality_rules"], clean) if ok)

    texts = plain_lines([r.text for r in stage["toxicity"]])
    want = [(r.doc_id, t, r.lang, r.source, len(t)) for r, t in zip(stage["toxicity"], texts)]
    assert in_order(stage["line_dedup"]) == in_order(want)

    held = stage["line_dedup"]
    groups = plain_groups([r.text for r in held])
    best = {}
    for k, g in enumerate(groups):
        best[g] = min(best.get(g, k), k, key=lambda i: (held[i].doc_id is None, held[i].doc_id or 0))
    chosen = sorted(((held[k].doc_id is not None, held[k].doc_id or 0) for k in best.values()))
    assert sorted((r.doc_id is not None, r.doc_id or 0) for r in stage["near_copies"]) == chosen
    assert {tuple(r) for r in stage["near_copies"]} <= {tuple(r) for r in held}
    again = plain_groups([r.text for r in stage["near_copies"]])
    assert again == list(range(len(again)))

    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    wanted = []
    for r in stage["near_copies"]:
        ids = [*tokenizer.encode(r.text, add_special_tokens=False).ids, 0]
        first = len(ids) % 2048 or min(len(ids), 2048)
        for piece, (a, b) in enumerate(zip([0, *range(first, len(ids), 2048)], [first, *range(first + 2048, len(ids) + 1, 2048)])):
            wanted.append((r.doc_id, piece, a, b - a, zlib.crc32(struct.pack(f"<{b - a}I", *ids[a:b]))))
    packed = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in stage["packing"]]
    assert in_order(packed) == in_order(wanted)
    sequences = {}
    for r in stage["packing"]:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        ends = [0]
        for offset, length in sorted(parts):
            assert offset == ends[-1]
            ends.append(offset + length)
        assert ends[-1] <= 2048
    total = sum(r.length for r in stage["packing"])
    assert len(sequences) <= -(-total // 2048) + 1
    assert in_order(out.collect()) == in_order(stage["packing"])
