"""Tokens in ORC files, runs of words and conversation repair against plain Python, on the given tables and edge rows."""

import hashlib
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quire.llm import conversations, queries, token_orc, word_runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")
EDGE = [(1, None), (2, ""), (3, " \n\t"), (None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (None, None)]
EDGE += [(5, "x " * 30_000), (7, "Don't İ <|endoftext|> é A.. 12. 3"), (-6, "p q " * 9)]
SCHEMA = "doc_id long, text string"


def word_file():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def digest_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is not None, x) for x in r))


# ---- token ids in ORC files ----


def plain_tokens(rows):
    """doc_id, start, n_tokens, crc of rows in order, by the tokenizers library on whole texts."""
    tokenizer = token_orc._tokenizer(word_file())[0]
    out, at = [], 0
    for key, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((key, at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        at += len(ids)
    return out


def test_orc_tokens_of_documents(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = queries.op11_orc_tokens(spark, sf)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, got.collect())) == plain_tokens(sorted(docs))


def test_orc_tokens_edge_rows(spark, tmp_path):
    docs = spark.createDataFrame(EDGE, SCHEMA).withColumns({c: F.lit("own") for c in ("ids", "n_tokens", "key", "file_no")})
    token_orc.write_tokens(docs, f"{tmp_path}/some", word_file())
    rows = token_orc.starts(token_orc.read_tokens(spark, f"{tmp_path}/some")).collect()
    assert len(rows) == len(EDGE)
    assert [r.start for r in sorted(rows, key=lambda r: r.start)] == list(
        np.cumsum([0] + [r.n_tokens for r in sorted(rows, key=lambda r: r.start)])[:-1]
    )
    ordered = [r.doc_id for r in sorted(rows, key=lambda r: r.start)]
    assert ordered == sorted(ordered, key=lambda d: (d is not None, d))
    own = {t: ids for (_, t), (_, _, _, ids) in zip(EDGE, plain_tokens(EDGE))}
    made = sorted(zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in rows)
    assert made == sorted(own[t] for _, t in EDGE)
    token_orc.write_tokens(docs.where("false"), f"{tmp_path}/none", word_file())
    assert token_orc.starts(token_orc.read_tokens(spark, f"{tmp_path}/none")).count() == 0


def test_word_encoder_splits_as_the_library():
    texts = ["a'b'.  c.d . ..e", "Ä. É! x;: 9,,", "it's. 'S 'll.", " a. b\x1c.", "fí.", "a.\n\nb.", "K.", "…a.!…", "1.5. 2", "İ. क़. ǰ! ŉ. é. É; e\u0301.", "ﬁn. ß, ẞ. ª. º!"]
    tokenizer = token_orc._tokenizer(word_file())[0]
    encoder = token_orc.WordEncoder(word_file())
    for _ in range(2):
        offsets, ids = encoder(pa.array(texts, pa.large_string()), 1)
        for k, text in enumerate(texts):
            want = [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
            assert ids[offsets[k] : offsets[k + 1]].tolist() == want


def test_orc_metadata_prunes(spark, tmp_path):
    """Several stripes a file, encoded as integers, and lookups that leave most rows unread."""
    docs = spark.range(0, 180_000, 3).selectExpr("id AS doc_id", "concat('word ', id % 977, ' end') AS text")
    out = f"{tmp_path}/tokens"
    token_orc.write_tokens(docs, out, word_file(), stripe_bytes=20_000, index_rows=1_000)
    from pyarrow import orc

    files = sorted(str(p) for p in (tmp_path / "tokens").glob("*.orc"))
    footers = [orc.ORCFile(f) for f in files]
    assert max(f.nstripes for f in footers) > 1 and {f.row_index_stride for f in footers} == {1_000}
    assert sum(f.nrows for f in footers) == 60_000

    def rows_read(df):
        df.collect()
        scan = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
        return scan.metrics().apply("numOutputRows").value()

    found = token_orc.read_tokens(spark, out, [30_000])
    assert [r.doc_id for r in found.collect()] == [30_000]
    assert rows_read(token_orc.read_tokens(spark, out, [30_000])) <= 1_000
    # an id between two others lies in the ranges of the statistics: the Bloom filter answers
    assert rows_read(token_orc.read_tokens(spark, out, [30_001])) == 0
    assert rows_read(token_orc.read_tokens(spark, out, [7_000_000])) == 0


# ---- runs of words ----


def plain_runs(words, least=12):
    """Runs by comparing every word with the one q words on, for every q."""
    out = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, 2 * q):
                out.setdefault((i, j - i + q), q)
            i = j
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


def plain_collapse(key, text):
    words = WORD.findall(text or "")
    h = zlib.crc32(str(key).encode()) if key is not None else 1
    if h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (
        key, len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2],
        hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest(),
    )


def test_word_runs_of_documents(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    # plain search is quadratic in a text
    want = {k: plain_collapse(k, t) for k, t in docs if len(t) < 9_000}
    got = {r.doc_id: tuple(r) for r in queries.op12_word_runs(spark, sf).collect()}
    assert len(got) == len(docs) and sum(w[1] > 0 for w in want.values()) > 5
    assert {k: got[k] for k in want} == want


@pytest.mark.parametrize("least", [12, 4, 7])
def test_runs_against_all_periods(least):
    rng = np.random.default_rng(least)
    texts = []
    for _ in range(400):
        n, a, p = rng.integers(0, 70), rng.integers(1, 4), rng.integers(1, 9)
        t = rng.integers(0, a, n).tolist()
        k = int(rng.integers(0, n + 1))
        texts.append(t if rng.random() < 0.5 else (t[:k] + (t[k : k + p] * 20))[:n])
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    found = word_runs.find_runs(np.array([x for t in texts for x in t], np.int64), offsets, least)
    assert found == [plain_runs(t, least) for t in texts]


def test_word_runs_edge_rows(spark):
    docs = spark.createDataFrame(EDGE, SCHEMA).withColumns({"runs": F.lit("own"), "note": F.lit("kept"), "_key": F.lit(0)})
    out = word_runs.collapse_runs(docs)
    assert out.columns == ["doc_id", "note", "_key", "n_words", "runs", "collapsed"]
    got = sorted((r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in out.collect())
    want = []
    for key, text in EDGE:
        words = WORD.findall(text or "")
        runs = [(0, 30_000, 1)] if key == 5 else plain_runs(words)
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        want.append((key or 0, len(words), runs, " ".join(w for i, w in enumerate(words) if i not in gone)))
    assert got == sorted(want)
    assert word_runs.collapse_runs(docs.where("false")).count() == 0


# ---- conversations ----


def plain_best(turns):
    """(cost, audit, repaired) by trying all edits row by row, keeping the best per state."""
    order = {"s": {"": "s"}, "u": {"": "u", "s": "u", "a": "u"}, "a": {"u": "a"}}
    best = {"": (0, "", ())}
    for (role, text), fault in turns:
        new = {}

        def offer(state, cost, audit, rows):
            if state not in new or (cost, audit) < new[state][:2]:
                new[state] = (cost, audit, rows)

        for state, (cost, audit, rows) in best.items():
            offer(state, cost + 2, audit + "D", rows)
            if fault in ("blank", "duplicate"):
                continue
            extra = 5 * (fault == "truncated")
            nxt = order.get(role[:1], {}).get(state)
            if nxt:
                offer(nxt, cost + extra, audit + "K", (*rows, (role, text)))
            for to in ("user", "assistant"):
                nxt = order[to[0]].get(state)
                if nxt:
                    offer(nxt, cost + 1 + extra, audit + "R", (*rows, (to, text)))
        # no repair gains by an insert: deleting the pair it completes costs less
        best = new
    return min(best[s] for s in ("", "a") if s in best)


def plain_repair(rows):
    """Rows (conv, turn, role, text) to the result of the query, in plain Python."""
    held = {}
    for conv, turn, role, text in rows:
        own = held.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        role = "user" if fault == 4 else role
        own += [(turn, role, text)] * (2 if fault == 3 else 1)
    out = []
    for conv, own in held.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0))
        known = [t for t, _, _ in own if t is not None]
        seen, marked, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in own:
            bare = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            marked.append(((role, text), fault))
        illegal = sum(a[0][0][:1] + b[0][0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
        cost, audit, fixed = plain_best(marked)
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest()
        out.append((conv, gaps, *counts.values(), illegal, cost, audit, sha))
    return sorted(out, key=lambda r: tuple((x is not None, x) for x in r))


def test_conversations_of_the_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = queries.op13_conversation_repair(spark, sf)
    assert got.columns == ["conv_id", *conversations.DIGEST]
    assert digest_rows(got) == plain_repair(rows)


CONV = "conv_id long, turn long, role string, text string"


def conv_rows():
    rng = np.random.default_rng(4)
    texts = ["Yes.", "No!", "Why?", "cut", "", " \n", "Tail ", "End. ", None, "Täglich."]
    rows = []
    for conv in range(60):
        for turn in range(int(rng.integers(0, 9))):
            role = rng.choice(["user", "assistant", "system", "tool", ""])
            rows.append((conv, int(turn), str(role), str(rng.integers(0, 9)) + "." if rng.random() < 0.5 else texts[rng.integers(0, 10)]))
    rows += [(None, 1, "user", "Hi."), (None, 2, "assistant", "Ho."), (100, None, None, "x."), (100, None, None, "x.")]
    # one conversation with most of the rows, over several ranges and blocks
    for turn in range(700):
        role = ["user", "assistant"][turn % 2] if rng.random() < 0.9 else "system"
        rows.append((200, turn, role, f"{turn if rng.random() < 0.9 else 1}" + ("." if rng.random() < 0.9 else "")))
    return rows


@pytest.mark.parametrize("block", [conversations.BLOCK_TURNS, 7])
def test_conversations_edge_rows(spark, monkeypatch, block):
    monkeypatch.setattr(conversations, "BLOCK_TURNS", block)
    rows = conv_rows()
    df = spark.createDataFrame(rows, CONV).withColumns({c: F.lit("own") for c in ("conv", "part", "cost", "audit")})
    got = conversations.digest(conversations.repair(conversations.damage(df)))
    assert digest_rows(got) == plain_repair(rows)
    none = conversations.digest(conversations.repair(conversations.damage(df.where("false"))))
    assert none.count() == 0


def test_auction_against_all_paths():
    """Prices, matrices and traces of random symbols against dynamic programming over (cost, audit)."""
    rng = np.random.default_rng(9)

    def best(symbols, exits):
        def closed(now):
            for _ in range(3):
                for g in range(4):
                    for e, c, h in conversations.INSERTS[g]:
                        if now[h] is not None and (now[g] is None or (now[h][0] + c, e + now[h][1]) < now[g]):
                            now[g] = (now[h][0] + c, e + now[h][1])
            return now

        now = closed([None if x is None else (x, "") for x in exits])
        for s in reversed(symbols):
            before = [None] * 4
            for g in range(4):
                for e, c, h in conversations.ARCS[s][g]:
                    if now[h] is not None and (before[g] is None or (now[h][0] + c, e + now[h][1]) < before[g]):
                        before[g] = (now[h][0] + c, e + now[h][1])
            now = closed(before)
        return now

    for k in range(300):
        kind = ["xsuaoSUAO", "ua", "uaUA", "uax", "suaoxA"][k % 5]
        s = "".join(rng.choice(list(kind), int(rng.integers(0, 80))))
        want = best(s, conversations.ENDS)[0]
        assert conversations.entry_prices(s, conversations.ENDS)[0] == want[0]
        assert conversations.traced(s, conversations.ENDS)[0][0] == want[1]
        if k % 5 == 0:
            for e in range(4):
                d = best(s, [0 if g == e else None for g in range(4)])
                assert [row[e] for row in conversations.matrix(s)] == [x and x[0] if x is not None else None for x in d]
