"""Operators on small fixtures: nulls, empty and repeated rows, ties, empty tables, clashing columns."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quire.llm import embed_dedup, html_diff, jaccard, licenses, line_dedup, packing, pieces, quality, sharding, toxicity
from quire.llm.license_rules import CONFIDENCE, signatures

EDGE = [(1, None), (2, ""), (3, " \n\t"), (None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (5, "x " * 30_000)]
SCHEMA = "doc_id long, text string"


def edge_docs(spark):
    """Edge rows with columns whose names clash with those operators make."""
    clash = {c: F.lit("own") for c in ("n_words", "shard", "score", "ids", "doc", "cid", "keep", "label")}
    return spark.createDataFrame(EDGE, SCHEMA).withColumns(clash)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def model_files():
    import public_tokenizers

    return public_tokenizers.path, public_tokenizers.PATTERN


def test_edge_rows_and_empty_tables(spark):
    path, pattern = model_files()
    runs = {
        "quality": lambda d: quality.quality_report(d),
        "pieces": lambda d: pieces.encode_documents(d.select("doc_id", "text"), path("piece_bpe_32k.model")),
        "jaccard": lambda d: jaccard.near_copies(d),
        "licenses": lambda d: licenses.scan(d),
        "lines": lambda d: line_dedup.drop_shared_lines(d.select("doc_id", "text")),
        "shards": lambda d: sharding.shuffle_to_shards(d.select("doc_id", "text"), 4),
        "toxicity": lambda d: toxicity.score_texts(d, toxicity.Model([toxicity.Term("x", False, 1.0)], [1.0] * 4 + [-2.0])),
        "packing": lambda d: packing.pack(packing.tokenize(d, path("byte_bpe_50k.tiktoken"), pattern)).where("piece = 0"),
    }
    for name, run in runs.items():
        assert run(edge_docs(spark)).count() == len(EDGE), name
        assert run(empty_docs(spark)).count() == 0, name


@pytest.mark.parametrize("block_rows", [jaccard.BLOCK_ROWS, 3])
def test_near_copies_brute_force(spark, monkeypatch, block_rows):
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", block_rows)
    word = re.compile(r"[^\x20\x09-\x0D]+")
    rng = random.Random(5)
    bases = [[rng.choice("abcdefghij") + rng.choice("klmnop") for _ in range(60)] for _ in range(5)]
    rows = []
    for k in range(150):
        own = list(rng.choice(bases))
        for _ in range(rng.randint(0, 4)):
            own[rng.randrange(len(own))] = rng.choice(["x", "y", "Z"])
        rows.append((k if k % 11 else None, " ".join(own)))
    rows += [(900, None), (901, ""), (903, "a b"), (904, "A  b"), (905, "b a"), (903, "a b")]
    sets = []
    for _, text in rows:
        w = word.findall((text or "").lower())
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for k, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(k)] = min(least.get(find(k), doc), doc)
    want = [(d, len(s), least.get(find(k)) if s else d) for k, ((d, _), s) in enumerate(zip(rows, sets))]
    got = [tuple(r) for r in jaccard.near_copies(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_suffix_bound():
    rng = np.random.default_rng(3)
    for n in (3, 40, 500, 5000):
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2))
        b = np.unique(np.concatenate([a[: n // 2], rng.integers(0, 1 << 63, n).astype(np.uint64)]))
        pair = [np.array([jaccard.parities(v)], object) for v in (a, b)]
        assert jaccard.least_difference(*pair)[0] <= len(np.setxor1d(a, b))
        assert jaccard.least_difference(pair[0], pair[0])[0] == 0


def test_vectors(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(20, 16))
    rows = []
    for k in range(120):
        v = base[k % 20] + rng.normal(size=16) * 0.12
        rows.append((k, v.tolist(), k % 3))
    rows += [(500, base[0].tolist(), 0), (501, base[0].tolist(), 0), (502, base[0].tolist(), None), (503, None, 0)]
    rows += [(504, [0.0] * 16, 0), (505, [float("nan")] * 16, 0), (None, base[0].tolist(), 0), (506, [], 0), (507, [1.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = embed_dedup.near_vectors(df, block=16).collect()
    ok = [r[1] is not None and r[2] is not None and len(r[1]) == 16 and 0 < np.linalg.norm(r[1]) < np.inf for r in rows]

    def linked(i, j):
        if i == j or not (ok[i] and ok[j]) or rows[i][2] != rows[j][2]:
            return False
        x, y = np.array(rows[i][1]), np.array(rows[j][1])
        return x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.93

    near = [[j for j in range(len(rows)) if linked(i, j)] for i in range(len(rows))]
    want = []
    for i, (vec, _, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        want.append((vec, len(near[i]), least, vec == least))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_quantisation_bound():
    rng = np.random.default_rng(2)
    x, y = rng.normal(size=(300, 32)), rng.normal(size=(200, 32))
    y[:100] = x[:100] + rng.normal(size=(100, 32)) * 0.3
    cosine = (x @ y.T) / np.linalg.norm(x, axis=1)[:, None] / np.linalg.norm(y, axis=1)
    got = {(i, j) for a, b in embed_dedup.close_pairs(x, y, 0.9) for i, j in zip(a.tolist(), b.tolist())}
    assert got == set(zip(*map(np.ndarray.tolist, np.nonzero(cosine >= 0.9))))


def test_communication_matrix():
    counts = [5, 0, 17, 40, 3]
    sizes = sharding.shard_sizes(sum(counts), 4)
    sums = np.zeros((5, 4))
    for seed in range(300):
        m = sharding.communication(counts, sizes, seed)
        assert m.sum(1).tolist() == counts and m.sum(0).tolist() == sizes.tolist()
        sums += m
    assert np.abs(sums / 300 - np.outer(counts, sizes) / sum(counts)).max() < 0.6
    big = sharding.shard_sizes(4_000_000_000, 4)
    m = sharding.communication([1_000_000_000] * 4, big, 1)
    assert m.sum(0).tolist() == big.tolist() and m.sum(1).tolist() == [1_000_000_000] * 4


@pytest.mark.parametrize("keep_first", [False, True])
def test_lines(spark, keep_first):
    rng = random.Random(4)
    pool = [f"line {k}" for k in range(12)]
    rows = [(k, "\n".join(rng.choice(pool + [f"own {k}", "", " LINE 3 "]) for _ in range(6))) for k in range(60)]
    got = line_dedup.drop_shared_lines(spark.createDataFrame(rows, SCHEMA), min_docs=20, keep_first=keep_first).collect()
    held = {}
    for doc, text in rows:
        for line in text.split("\n"):
            if line.strip():
                held.setdefault(line.strip().lower(), set()).add(doc)
    common = {x for x, d in held.items() if len(d) >= 20}
    lost = sum(r.n_dropped for r in got)
    every = sum(x.strip().lower() in common for _, t in rows for x in t.split("\n"))
    assert lost == every - (len(common) if keep_first else 0) and common
    if not keep_first:
        texts = dict(rows)
        for r in got:
            assert r.kept_text == "\n".join(x for x in texts[r.doc_id].split("\n") if x.strip().lower() not in common)


def test_automaton_equals_edit_distance():
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            new = [i + 1]
            for j, y in enumerate(b):
                new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
            row = new
        return row[-1]

    terms = [toxicity.Term("idiot", False, 1.0), toxicity.Term("worthless", False, 0.9), toxicity.Term("lowei", True, 0.8)]
    matcher, rng = toxicity.Matcher(terms), random.Random(2)
    for _ in range(2000):
        word = list(rng.choice(["idiot", "worthless", "loweia"]))
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(word) + 1)
            word[at : at + rng.randint(0, 1)] = rng.choice(["", *"idotwrhlesx"])
        word = "".join(word)
        cost = [distance(word, t.text) if not t.stem else 0 if word.startswith(t.text) else 9 for t in terms]
        fit = [(c, -t.weight, k) for k, (c, t) in enumerate(zip(cost, terms)) if c <= t.edits]
        assert matcher.match(word) == ((min(fit)[2], min(fit)[0]) if fit else None)


def test_quotation_weighs_less():
    scorer = toxicity.Scorer([toxicity.Term("moron", False, 1.0)])
    x = scorer(pa.array(["you are a moron today", 'he said "moron" again', "such a mmoron thing"]))
    assert x[0, 0] > x[2, 0] > x[1, 0] > 0 and x[1, 1] == 0


def test_licenses_brute_force(spark):
    texts = [
        "Licensed under CC BY-NC 4.0.", "cc by nc cc by nc cc by nc", "x CC BY-NC cc by nc. cc-by-nc-sa 4.0",
        "Apache License, Version 2.0 apache license version 2", "GNU General Public License v3; GPLv2, lgpl 2.1",
        "SPDX-License-Identifier: MIT", "İ under the mit licenseé under the mit license", "no words here",
    ]
    rules = signatures()
    assert len(rules) > 200
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(list(enumerate(texts)), SCHEMA)).collect()}
    for k, text in enumerate(texts):
        words = word.findall(text.translate(low))
        padded, found = f" {' '.join(words)} ", []
        for n, rule in enumerate(rules):
            if f" {rule.keyword}" in padded:
                for m in re.finditer(licenses.whole(rule.pattern), padded):
                    start = padded[: m.start()].count(" ") - 1
                    found.append((start, start + m.group().count(" ") + 1, rule.priority, -n, rule.label))
        stays = [
            d for d in found
            if not any(
                e[0] <= d[0] and e[1] >= d[1] and e[2] >= d[2] and (e[:2] != d[:2] or e[2:4] > d[2:4])
                for e in found if e is not d
            )
        ]
        base = set(filter(None, got[k].base_labels.split(",")))
        assert got[k].labels == ",".join(sorted(base | {d[4] for d in stays}))
        assert got[k].score == max([0.9 * bool(base), 0.0] + [CONFIDENCE[d[2]] for d in stays])


def test_cascade_keeps_the_same_rows(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rules = quality.text_rules()
    one, measured = quality.quality_filter(docs, rules)
    other = docs.withColumn("failed_rule", quality.first_rejection(rules[::-1]))
    assert len(measured) == len(rules)
    ids = [sorted(r.doc_id for r in x.where("failed_rule IS NULL").select("doc_id").collect()) for x in (one, other)]
    assert ids[0] == ids[1]


def test_page_zones():
    page = html_diff.parse(
        "<head><title>T</title></head><nav><p>menu</nav><div class='cookie-notice'>we use</div>"
        "<article><header><h1>A &amp; B</h1></header><p>one<br>two<p>three<div class=comments>bad</div></article>"
        "<aside>side</aside><script>var x='</p>'</script><footer>&copy;"
    )
    assert html_diff.main_text(page, None)[0] == "A & B\none two\nthree"


def test_template_is_found_by_difference():
    pages = [html_diff.parse(f"<p>Site name</p><p>Body of {k}</p><p>All rights</p>") for k in (1, 2)]
    assert html_diff.main_text(pages[0], pages[1])[0] == "Body of 1"
    assert html_diff.main_text(pages[0], pages[0])[0] == "Site name\nBody of 1\nAll rights"


def test_common_lines_is_longest():
    def length(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
            row = new
        return row[-1]

    rng = random.Random(8)
    for _ in range(300):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 12))] for _ in range(2))
        assert len(html_diff.common_lines(a, b)) == length(a, b)


def test_pieces_are_the_best_path():
    path, _ = model_files()
    vocabulary = pieces.Vocabulary.load(path("piece_bpe_32k.model"))
    encoder = pieces.PieceEncoder(vocabulary)
    score = {p: s for p, s, t in zip(vocabulary.pieces, vocabulary.scores, vocabulary.types) if t == pieces.NORMAL}
    rng = random.Random(6)
    for _ in range(300):
        text = "".join(rng.choice("the ndiaéo") for _ in range(rng.randint(1, 14)))
        offsets, ids, got = encoder.encode(pa.array([text], pa.large_string()))
        marked = "▁" + text.replace(" ", "▁")
        best = [0.0] + [-1e18] * len(marked)
        for end in range(1, len(marked) + 1):
            for begin in range(end):
                if marked[begin:end] in score:
                    best[end] = max(best[end], best[begin] + score[marked[begin:end]])
        assert got[0] == best[-1] and encoder.decode(ids.tolist()) == text


def test_bin_completion():
    rng = random.Random(7)
    for n in (1, 7, 60, 400):
        lengths = [rng.randint(1, 2047) for _ in range(n)]
        bins = packing.bin_completion(lengths, 2048)
        assert sorted(sum(bins, [])) == sorted(lengths) and max(map(sum, bins)) <= 2048
        counts = {x: lengths.count(x) for x in lengths}
        assert len(bins) <= len(packing.best_fit(counts, 2048))
    # best fit needs three bins here, completion finds two
    assert len(packing.bin_completion([6, 5, 4, 3, 2], 10)) == 2


def test_decoding_of_many_equals_decoding_of_one():
    path, _ = model_files()
    encoder = pieces.PieceEncoder(pieces.Vocabulary.load(path("piece_bpe_32k.model")))
    rng = random.Random(8)
    rows = [[rng.randrange(len(encoder.table)) for _ in range(rng.randrange(9))] for _ in range(600)]
    rows += [[], None, [k for k, b in enumerate(encoder.table) if b == b" "][:1]]
    for part in (rows, rows[300:], [[]], [None], []):
        got = encoder.decode_all(pa.array(part, pa.list_(pa.int32()))).to_pylist()
        assert got == [None if ids is None else encoder.decode(ids) for ids in part]
    valid = encoder.encode(pa.array(["a word", " b", "", "é漢字 x"]))
    lists = pa.ListArray.from_arrays(pa.array(valid[0].astype(np.int32)), pa.array(valid[1]))
    assert encoder.decode_all(lists).to_pylist() == ["a word", " b", "", "é漢字 x"]
    assert encoder.decode_all(lists[1:]).to_pylist() == [" b", "", "é漢字 x"]


def test_bin_completion_goes_back():
    """Bins of many pieces, and the fewest bins that exist where best fit misses them."""
    rng = random.Random(3)
    lengths = [rng.randint(300, 500) for _ in range(200)]
    counts = {x: lengths.count(x) for x in lengths}
    bins, ended = packing.search_bins(lengths, 2048)
    assert sorted(sum(bins, [])) == sorted(lengths) and max(map(sum, bins)) <= 2048
    assert len(bins) == -(-sum(lengths) // 2048) < len(packing.best_fit(counts, 2048)) and ended == "bound"

    def fewest(left: list[int], rooms: tuple[int, ...]) -> int:
        if not left:
            return len(rooms)
        fits = {r for r in rooms if r >= left[0]}
        options = [tuple(sorted([*rooms[: (k := rooms.index(r))], *rooms[k + 1 :], r - left[0]])) for r in fits]
        return min(fewest(left[1:], o) for o in [*options, tuple(sorted([*rooms, 24 - left[0]]))])

    better = 0
    for _ in range(150):
        lengths = [rng.randint(2, 13) for _ in range(8)]
        bins, ended = packing.search_bins(lengths, 24)
        assert ended != "steps" and sorted(sum(bins, [])) == sorted(lengths) and max(map(sum, bins)) <= 24
        assert len(bins) == fewest(sorted(lengths, reverse=True), ())
        better += len(bins) < len(packing.best_fit({x: lengths.count(x) for x in lengths}, 24))
    assert better


def test_difference_decides():
    def page(own, n=20, template="line"):
        return html_diff.parse("".join(f"<p>{template} {k}</p>" for k in range(n)) + own)

    # a short page under a long template
    assert html_diff.main_text(page("<p>one</p>"), page("<p>two</p>"))[0] == "one"
    # beside an article the difference keeps what is not of the template, and article lines come back
    a = page("<article><p>shared</p><p>mine</p></article><p>more of it</p>")
    b = page("<article><p>shared</p><p>yours</p></article>")
    assert html_diff.main_text(a, b)[0] == "shared\nmine\nmore of it"
    # nearly a copy on one side, only the template on the other
    text = "".join(f"<p>text {k}</p>" for k in range(60))
    a, b = page(text + "<p>x</p>", 3), page(text + "<p>y</p>", 3)
    assert html_diff.main_text(a, b, page("<p>other</p>", 3))[0].split("\n")[0] == "text 0"


def test_difference_looks_past_copies_and_borders(spark):
    """Each page has one line of its own under the template of its host, whatever range holds its neighbour."""

    def html_of(host, k):
        return "".join(f"<p>{host} line {i}</p>" for i in range(12)) + f"<p>body {k}</p>"

    rows, want = [], []
    for host in ("a.example", "b.example"):
        for k in range(40):
            # every tenth page has 30 copies under the next addresses, more than a range holds
            for copy in range(31 if k % 10 == 0 else 1):
                rows.append((len(rows), f"https://{host}/p/{k:03d}/{copy:02d}", html_of(host, k)))
                want.append(f"body {k}")
    rows += [(len(rows), "https://c.example/only", "<p>alone</p>"), (len(rows) + 1, None, None)]
    want += ["alone", ""]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        got = {r.page_id: r for r in html_diff.extract_pages(df).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert [got[k].text for k in range(len(rows))] == want
    assert all(got[k].n_shared == 12 for k in range(len(rows) - 2))


def test_article_parts_are_kept():
    """Ids and class words made from titles drop nothing; containers that are boilerplate still go."""
    page = html_diff.parse(
        "<article><h2 id='search-algorithms'>Search</h2><section id='related-work'><p>Before us</p></section>"
        "<p id='share-of-votes' class='notice'>Votes</p><div class='social-history'>History</div>"
        "<section id='notice-periods' class='notice-periods'>Periods</section>"
        "<p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> be</p><svg width='9'><text x='1'>axis</text><text>label</text></svg>"
        "<object data='a.pdf'>A plan</object><div class='share-buttons'>bad</div><div class='x related-posts'>bad</div>"
        "<ul class=share><li>bad</ul><nav>bad</nav><p hidden>bad</p></article><div id='search-box'>bad</div><math>bad</math>"
    )
    want = "Search\nBefore us\nVotes\nHistory\nPeriods\nLet x=1 be\naxis label\nA plan"
    assert html_diff.main_text(page, None)[0] == want


def test_near_copies_goes_on_after_a_capped_round(spark, monkeypatch):
    """A capped round without a new pair does not end the search: the exact round finds the rest."""
    rng = random.Random(5)
    base = [rng.choice("abcdefghij") + rng.choice("klmnop") for _ in range(60)]
    rows = []
    for k in range(60):
        own = list(base)
        for _ in range(3):
            own[rng.randrange(len(own))] = rng.choice(["x", "y", "z"])
        rows.append((k, " ".join(own)))
    df = spark.createDataFrame(rows, SCHEMA)
    want = sorted(map(tuple, jaccard.near_copies(df).collect()))
    fans, pairs = [], jaccard._cross_pairs

    def nothing_new(percent, fan):
        fans.append(fan)
        return (lambda batches: (b.select(["a", "b"]) for b in ())) if fan else pairs(percent, fan)

    monkeypatch.setattr(jaccard, "_cross_pairs", nothing_new)
    assert sorted(map(tuple, jaccard.near_copies(df).collect())) == want
    assert fans[-1] == 0
