import random

import pytest
from pyspark.sql import functions as F

from quire.operators import chat, evaluate, health, listing, manifest, refine, similarity, sync
from quire.streaming import index_sync


def snapshot(spark, items):
    df = spark.createDataFrame(sorted(items.items()) or [], "key string, text string")
    return sync.with_content_hash(df, "text")


@pytest.mark.parametrize("seed", range(4))
def test_sync_gives_the_source(spark, seed):
    rng = random.Random(seed)
    keys = [f"k{i}" for i in range(40)]
    old = {k: rng.choice("abc") for k in keys if rng.random() < 0.6}
    new = {k: rng.choice("abc") for k in keys if rng.random() < 0.6}
    source, index = snapshot(spark, new), snapshot(spark, old)
    after = {r.key: r.text for r in sync.apply_sync(source, index, "key").collect()}
    assert after == new
    diff = {r.key: r.action for r in sync.sync_diff(source, index, "key").collect()}
    want = {
        k: "insert" if k not in old else "delete" if k not in new else "keep" if old[k] == new[k] else "update"
        for k in old.keys() | new.keys()
    }
    assert diff == want


def test_stream_in_increments_equals_batch(spark, tmp_path):
    src, path, state = str(tmp_path / "src"), str(tmp_path / "index"), str(tmp_path / "state")
    schema = "key string, text string, version long"

    def add(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(schema).parquet(src)
        index_sync.start_sync(stream, path, state, "key", "text", "version").awaitTermination()
        return {r.key: r.text for r in index_sync.current_index(spark, path, "key").collect()}

    assert add([("a", "1", 1), ("b", "1", 1), ("a", "2", 2)]) == {"a": "2", "b": "1"}
    assert add([("b", "3", 3), ("c", "1", 1)]) == {"a": "2", "b": "3", "c": "1"}
    gone = spark.createDataFrame([("a",)], "key string")
    index_sync.append_deletes(spark, path, gone, "key")
    current = {r.key: r.text for r in index_sync.current_index(spark, path, "key").collect()}
    assert current == {"b": "3", "c": "1"}
    assert add([("a", "9", 9)]) == {"a": "9", "b": "3", "c": "1"}
    current["a"] = "9"
    index_sync.compact(spark, path, str(tmp_path / "compact"), "key")
    packed = index_sync.current_index(spark, str(tmp_path / "compact"), "key")
    assert {r.key: r.text for r in packed.collect()} == current


def test_late_rows_replayed_batches_and_deletes(spark, tmp_path):
    src, path = str(tmp_path / "src"), str(tmp_path / "index")
    schema = "key string, text string, version long"

    def add(rows, state="state"):
        if rows:
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(schema).parquet(src)
        index_sync.start_sync(stream, path, str(tmp_path / state), "key", "text", "version").awaitTermination()
        return {r.key: r.text for r in index_sync.current_index(spark, path, "key").collect()}

    assert add([("a", "2", 2), ("b", "2", 2), ("n", "null", None)]) == {"a": "2", "b": "2", "n": "null"}
    gone = spark.createDataFrame([("b",), ("unknown",)], "key string")
    index_sync.append_deletes(spark, path, gone, "key")
    index_sync.append_deletes(spark, path, gone, "key")
    # a stream without its state reads all again: the first batch is written over
    assert add([], "again") == {"a": "2", "n": "null"}
    assert add([("a", "1", 1), ("b", "1", 1)]) == {"a": "2", "n": "null"}
    packed = str(tmp_path / "packed")
    index_sync.compact(spark, path, packed, "key")
    assert {r.key for r in index_sync.current_index(spark, packed, "key").collect()} == {"a", "n"}
    assert add([("b", "3", 3), ("n", "0", 0)]) == {"a": "2", "b": "3", "n": "0"}


@pytest.mark.parametrize("seed", range(2))
def test_index_state_equals_a_replay(spark, tmp_path, seed):
    """Random editions, deletes and late rows against plain rules; a change writes the buckets of its keys only."""
    rng = random.Random(seed)
    src, path = str(tmp_path / "src"), str(tmp_path / "index")
    schema = "key string, text string, version long"
    state: dict = {}
    for epoch in range(4):
        rows = [(f"k{rng.randrange(30)}", rng.choice("abc"), rng.randrange(6)) for _ in range(12 if epoch else 60)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(schema).parquet(src)
        before = set(index_sync.newest_buckets(spark, path))
        index_sync.start_sync(stream, path, str(tmp_path / "state"), "key", "text", "version").awaitTermination()
        new = set(index_sync.newest_buckets(spark, path)) - before
        touched = {r[0] for r in spark.createDataFrame(rows, schema).select(index_sync._bucket("key")).distinct().collect()}
        assert {int(f.rsplit("=", 1)[1]) for f in new} == touched
        hashed = {r.text: r.h for r in sync.with_content_hash(spark.createDataFrame([("a",), ("b",), ("c",)], "text string"), "text", "h").collect()}
        for k, text, version in sorted(rows, key=lambda r: (r[2], hashed[r[1]])):
            if k not in state or (version, epoch, False) >= state[k][0]:
                state[k] = ((version, epoch, False), text)
        gone = rng.sample(sorted(state), 5)
        index_sync.append_deletes(spark, path, spark.createDataFrame([(k,) for k in [*gone, "unknown"]], "key string"), "key")
        for k in gone:
            state[k] = ((state[k][0][0], epoch, True), None)
        want = {k: t for k, (p, t) in state.items() if not p[2]}
        current = index_sync.current_index(spark, path, "key")
        assert {r.key: r.text for r in current.collect()} == want
    plan = current._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "Aggregate" not in plan


def test_late_batch_moves_keys_and_versions_only(spark, tmp_path):
    """Rows below their state are dropped before they are prepared or dealt; no bucket gathers files over batches."""
    src, path, state = str(tmp_path / "src"), str(tmp_path / "index"), str(tmp_path / "state")
    schema = "key string, text string, version long"
    prepared = []

    def prepare(df):
        prepared.append([(r.key, r.version) for r in df.collect()])
        return df.withColumn("size", F.length("text"))

    def add(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(schema).parquet(src)
        index_sync.start_sync(stream, path, state, "key", "text", "version", prepare=prepare).awaitTermination()
        found = {r.key: (r.text, r.size) for r in index_sync.current_index(spark, path, "key").collect()}
        files = index_sync.index_state(spark, path).inputFiles()
        assert len(files) == len({f.rsplit("/", 1)[0] for f in files})
        return found

    first = add([(f"k{n}", "second", 2) for n in range(40)] + [(None, "none", 2)])
    assert first == {f"k{n}": ("second", 6) for n in range(40)} | {None: ("none", 4)}
    assert add([(f"k{n}", "1", 1) for n in range(40)] + [(None, "0", None)]) == first
    assert len(prepared) == 1
    assert add([("k1", "third", 3), ("k1", "1", 1), ("k2", "1", 1), ("new", "n", None), (None, "last", 2)]) == first | {
        "k1": ("third", 5), "new": ("n", 1), None: ("last", 4)
    }
    assert {k for k, _ in prepared[1]} == {"k1", "new", None}


def test_stream_adds_vectors_to_changed_rows(spark, tmp_path):
    src, path, state = str(tmp_path / "src"), str(tmp_path / "index"), str(tmp_path / "state")
    schema = "key string, text string, version long"
    spark.createDataFrame([("a", "one two", 1), ("b", " ", 1)], schema).write.parquet(src)
    stream = spark.readStream.schema(schema).parquet(src)
    index_sync.start_sync(
        stream, path, state, "key", "text", "version", prepare=lambda df: similarity.embed(df, "text")
    ).awaitTermination()
    rows = index_sync.current_index(spark, path, "key").collect()
    assert [(r.key, sum(r.vector)) for r in rows] == [("a", 2.0)]


def expected_health(rows, hot_seconds, calm_seconds):
    """The rules replayed request by request."""
    out, state = {}, {}
    for client, rid, at, seconds, ok, throttled in sorted(rows, key=lambda r: (r[0], r[2], r[1])):
        s = state.setdefault(client, {"times": [], "n": 0, "e": 0, "t": None})
        s["times"].append(seconds)
        s["n"] += 1
        s["e"] += not ok
        if throttled:
            s["t"] = at
        mean = sum(s["times"][-10:]) / len(s["times"][-10:])
        since = None if s["t"] is None else at - s["t"]
        rate = s["e"] / s["n"]
        low = (since is not None and since < hot_seconds) or (s["n"] > 10 and rate > 0.2) or (s["n"] > 5 and mean > 5)
        up = (since is None or since >= calm_seconds) and s["n"] > 10 and mean < 2 and rate < 0.05
        delay = min(2.0, 0.05 * min(10, s["e"] + 1)) if low else 0.05
        out[rid] = (s["n"], s["e"], round(mean, 6), since, "reduce" if low else "increase" if up else "hold", round(delay, 6))
    return out


@pytest.mark.parametrize("pieces", [1, 7, 40])
def test_health_equals_a_replay_for_a_hot_client(spark, pieces):
    rng = random.Random(5)
    rows = []
    for rid in range(600):
        client = "hot" if rng.random() < 0.5 else f"c{rng.randrange(30)}"
        bad = rng.random() < (0.02 if client == "hot" else 0.2)
        fast = 0.1 if client == "hot" and rid > 300 else 1.0
        rows.append((client, rid, float(rng.randrange(3000)), round(rng.random() * 12 * fast, 3), not bad, bad and rng.random() < 0.3))
    df = spark.createDataFrame(rows, "client string, request_id long, at double, seconds double, success boolean, throttled boolean")
    log = df.withColumn("ts", F.timestamp_seconds("at")).drop("at")
    got = {
        r.request_id: (r.total_requests, r.errors, r.mean_recent, r.since_throttled, r.action, r.delay)
        for r in health.request_health(log, 10, 30, pieces=pieces).collect()
    }
    want = expected_health(rows, 10, 30)
    assert got.keys() == want.keys()
    for rid in want:
        assert got[rid] == pytest.approx(want[rid], abs=2e-6)
    assert {w[4] for w in want.values()} == {"reduce", "hold", "increase"}


def messages(spark):
    rows = [
        (1, 0, "system", "old"), (1, 1, "user", "q"), (1, 2, "assistant", "a1"), (1, 3, "assistant", "a2"),
        (2, 0, "user", "hello"), (3, 5, "user", "x"), (3, 6, "system", "late"), (3, 7, "assistant", "y"),
    ]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_prepared_conversations(spark):
    got = {(r.conv_id, r.turn): (r.role, r.text) for r in chat.prepare_messages(messages(spark), F.lit("new")).collect()}
    assert got[(1, 0)] == ("system", "new") and (1, -1) not in got
    assert got[(2, -1)] == ("system", "new") and got[(2, 0)] == ("user", "hello")
    assert got[(3, 4)] == ("system", "new") and got[(3, 6)] == ("system", "late")
    assert len(got) == 10


def test_last_assistant(spark):
    got = {r.conv_id: r.response for r in chat.last_assistant(messages(spark)).collect()}
    assert got == {1: "a2", 2: "No response", 3: "y"}


def test_overlap_scores(spark):
    rows = [(1, "red fox", "the red dog", "the dog"), (2, "", "a", None), (3, "x", "No response", "")]
    df = spark.createDataFrame(rows, "k int, question_text string, answer_text string, context_text string")
    got = {r.k: (r.query_relevance, r.groundedness) for r in evaluate.answer_overlap(df, ["k"]).collect()}
    assert got == {1: (0.5, 0.666667), 2: (0.0, 0.0), 3: (0.0, 0.0)}


def test_refinement_cut_comes_before_query_words(spark):
    words = [f"term{c}" for c in "abcdefghijkl"]
    text = " ".join(w * 1 + " " for i, w in enumerate(words) for _ in range(20 - i)).replace("term", "terms")
    hits = spark.createDataFrame([(1, text + " once1 abc")], "question_id long, text string")
    asked = spark.createDataFrame([(1, "Termsa termsb termsc termsd termse termsf what")], "question_id long, question_text string")
    got = [r.term for r in refine.refinement_terms(hits, asked).orderBy("position").collect()]
    assert got == ["termsg", "termsh", "termsi", "termsj"]


def test_listing(spark):
    df = spark.createDataFrame([("b", "2"), ("a", "9"), ("b", "1")], "c string, i string")
    got = [tuple(r) for r in listing.category_listing(df, "c", "i").collect()]
    assert got == [("a", 0, None, 1), ("a", 1, "9", None), ("b", 0, None, 2), ("b", 1, "1", None), ("b", 1, "2", None)]
    sample = [tuple(r) for r in listing.category_sample(df, "c", "i", 5, 1).collect()]
    assert sample == [("a", "9", 1, 1, 0), ("b", "1", 2, 1, 1)]


def test_labels_and_duplicates(spark):
    df = spark.createDataFrame([("u1", "Oil  & Gas", 2), ("u1", "x", 1), ("u2", " oil & gas ", 3)], "url string, c string, n long")
    assert {r[0] for r in df.filter("n > 1").select(manifest.normalise_label("c")).collect()} == {"oil & gas"}
    assert {(r.url, r.n) for r in manifest.dedupe_by(df, "url", "n").collect()} == {("u1", 1), ("u2", 3)}


def test_suspects_lie_in_the_root_or_one_level_below(spark):
    rows = [("/r/a.pdf", ".pdf", 5, "/r"), ("/r/x/b.pdf", ".pdf", 5, "/r/x"), ("/r/x/y/c.pdf", ".pdf", 5, "/r/x/y"), ("/r/d.pdf", ".pdf", 10**6, "/r")]
    df = spark.createDataFrame(rows, "volume_path string, file_extension string, file_size_bytes long, directory string")
    assert sorted(r.volume_path for r in manifest.suspect_files(df, "/r").collect()) == ["/r/a.pdf", "/r/x/b.pdf"]
