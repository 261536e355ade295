"""Registered queries of the operators against their SQL, and the pipeline against plain Python."""

import re

import duckdb
import pytest

from quire.llm import queries
from tools.check import TABLES, ordered


@pytest.fixture(scope="module")
def db():
    from tests.conftest import SF

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, sf, db, name):
    df = queries.QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    got = ordered(df.select(*columns).collect())
    cursor = db.execute(queries.ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    assert got == ordered([tuple(r[names.index(c)] for c in columns) for r in cursor.fetchall()])


def test_sentencepiece_round_trip(spark, sf):
    rows = queries.op2_sentencepiece(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.round_trip for r in rows)


def test_html(spark, sf):
    """Every given page holds its text in an article of h1 and p blocks."""
    import html

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = queries.op3_html_extraction(spark, sf).collect()
    assert len(rows) == len(pages)
    for r in rows:
        inner = re.search(r"(?s)<article>(.*?)(</article>|$)", pages[r.page_id]).group(1)
        blocks = [re.sub(r"</?b>", "", b).replace("<br>", " ") for b in re.split(r"</?(?:p|h1)>", inner)]
        want = "\n".join(b for b in (" ".join(html.unescape(x).split()) for x in blocks) if b)
        assert r.text == want and r.n_chars == len(want)


def test_shards(spark, sf):
    rows = queries.op6_sharding(spark, sf).collect()
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
    assert sorted(by) == list(range(16))
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in by.values())


def test_licenses_base(spark, sf):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    phrases = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
    for r in queries.op8_license_scan(spark, sf).collect():
        words, starts, labels = word.findall(texts[r.doc_id].translate(low)), [], set()
        for phrase, label in phrases.items():
            own = phrase.split()
            at = [k for k in range(len(words)) if words[k : k + len(own)] == own]
            starts += at
            labels |= {label} if at else set()
        assert (r.n_words, r.n_base, r.base_labels) == (len(words), len(starts), ",".join(sorted(labels)))
        assert (r.first_word, r.last_word) == ((min(starts), max(starts)) if starts else (None, None))
        assert labels <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_packing(spark, sf):
    """Ids equal the reference tokenizer's; pieces tile documents and sequences."""
    import struct
    import zlib

    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    pieces, sequences = {}, {}
    for r in queries.op10_best_fit_packing(spark, sf).collect():
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    total = 0
    for doc, text in docs.items():
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
        total += len(ids)
        at = 0
        own = sorted(pieces[doc], key=lambda r: r.piece)
        for k, r in enumerate(own):
            part = ids[at : at + r.length]
            assert (r.piece, r.start) == (k, at) and len(part) == r.length <= 2048
            assert r.length == 2048 or k == 0
            assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
            at += r.length
        assert at == len(ids)
    for rows in sequences.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    assert len(sequences) <= -(-total // 2048) + 2


def test_toxicity_held_out(spark):
    """Held-out labels of the larger table are told apart."""
    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in queries.op7_toxicity(spark, folder).collect() if r.held_out and r.doc_id in labels]
    right = sum(r.predicted == labels[r.doc_id] for r in rows)
    clean = [r for r in rows if not labels[r.doc_id]]
    assert right >= 0.97 * len(rows)
    assert sum(r.predicted for r in clean) <= 0.005 * len(clean)


def test_pipeline(spark, sf):
    """Each stage's decisions against plain Python over what the stage before kept."""
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = pipeline.quality_stage(spark, docs, sf)
    report = {r.doc_id: r.kept for r in queries.op1_quality_rules(spark, sf).collect()}
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {d for d, k in report.items() if k}
    lines = pipeline.line_stage(spark, kept, sf).collect()
    texts = {r.doc_id: r.text for r in kept.collect()}
    held = {}
    for doc, text in texts.items():
        for line in {x.strip(" \t\n\x0b\x0c\r").lower() for x in text.split("\n")} - {""}:
            held.setdefault(line, set()).add(doc)
    for r in lines:
        want = [x for x in texts[r.doc_id].split("\n") if len(held.get(x.strip(" \t\n\x0b\x0c\r").lower(), ())) < 10]
        assert r.text == "\n".join(want) and r.n_chars == len(r.text)
    out = pipeline.run(spark, sf)
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(out.columns) and out.count() > 0
    assert [s for s, _ in pipeline.STAGES] == ["quality_rules", "toxicity", "line_dedup", "near_copies", "packing"]
