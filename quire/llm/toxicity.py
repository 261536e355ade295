"""Toxicity of texts from a learned lexicon, misspellings included.

The lexicon is learned from a bounded sample of labelled texts. A trie of it is
intersected with the Levenshtein automaton of each distinct word; hits are
weighed by the words around them, which tell quotation from abuse.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.arrow import shingle_sets, slices, split_words, texts_of
from quire.scratch import materialise

# Labelled texts of each class that are learned from, and terms kept.
TRAIN_ROWS = 6_000
MAX_TERMS = 2_000
MIN_SUPPORT = 3
STEM_LENGTHS = range(4, 9)
CUTOFF = 0.7
CONTEXT = 4
# Words and marks that show that a term is quoted, or aimed at someone.
REPORTING = frozenset("said says say called calls wrote quote quoted quotes term word words insult insults dit mot sagt sagte wort dijo palabra".split())
AIMED = frozenset("you your you're youre u ur are tu vous es du sie ihr eres usted".split())
QUOTES = "\"“”„«»‹›"
QUOTED_WEIGHT, AIMED_WEIGHT = 0.3, 1.3
MISSPELLED_WEIGHT = 0.6


@dataclass(frozen=True)
class Term:
    text: str
    stem: bool  # also matches longer words
    weight: float

    @property
    def edits(self) -> int:
        """Edits a word may differ by; stems must be met exactly."""
        return 0 if self.stem or len(self.text) < 5 else 1 if len(self.text) < 8 else 2


@dataclass
class Trie:
    """Nodes are numbers; ``room`` is the most edits any term below a node allows."""

    children: list[dict[str, int]] = field(default_factory=lambda: [{}])
    ends: list[list[int]] = field(default_factory=lambda: [[]])
    room: list[int] = field(default_factory=lambda: [0])

    def add(self, term: Term, number: int) -> None:
        node = 0
        self.room[0] = max(self.room[0], term.edits)
        for ch in term.text:
            if ch not in self.children[node]:
                self.children[node][ch] = len(self.children)
                self.children.append({})
                self.ends.append([])
                self.room.append(0)
            node = self.children[node][ch]
            self.room[node] = max(self.room[node], term.edits)
        self.ends[node].append(number)


class Matcher:
    """Levenshtein automata of all terms at once, as a deterministic automaton built on demand.

    A state is a set of (trie node, edits so far), each edit count the least for
    its node, with the stems already met. States are kept per process up to a
    bound; past it they are built anew.
    """

    MAX_STATES = 200_000

    def __init__(self, terms: list[Term]) -> None:
        self.terms = terms
        self.trie = Trie()
        for k, term in enumerate(terms):
            self.trie.add(term, k)
        self.letters = {c for t in terms for c in t.text}
        self.reset()

    def reset(self) -> None:
        self.steps: dict[tuple, tuple | None] = {}
        self.start = self._closed({0: 0}, frozenset())

    def _closed(self, nodes: dict[int, int], met: frozenset) -> tuple | None:
        """Adds what deletions from a term reach, and the stems met."""
        trie, queue = self.trie, list(nodes.items())
        while queue:
            node, e = queue.pop()
            if nodes.get(node, e) < e:
                continue
            for child in trie.children[node].values():
                if e < trie.room[child] and e + 1 < nodes.get(child, 99):
                    nodes[child] = e + 1
                    queue.append((child, e + 1))
        stems = {k for node, e in nodes.items() for k in trie.ends[node] if self.terms[k].stem and e == 0}
        met = met | stems
        return (frozenset(nodes.items()), met) if nodes or met else None

    def step(self, state: tuple, ch: str) -> tuple | None:
        trie, nodes = self.trie, {}

        def reach(node: int, e: int) -> None:
            if e <= trie.room[node] and e < nodes.get(node, 99):
                nodes[node] = e

        for node, e in state[0]:
            for c, child in trie.children[node].items():
                reach(child, e if c == ch else e + 1)
            reach(node, e + 1)
        return self._closed(nodes, state[1])

    def match(self, word: str) -> tuple[int, int] | None:
        """(term, edits) of the best term for a word: fewest edits, then most weight."""
        state, steps = self.start, self.steps
        for ch in word:
            key = (state, ch if ch in self.letters else "")
            nxt = steps.get(key, 0)
            if nxt == 0:
                if len(steps) > self.MAX_STATES:
                    self.reset()
                    steps = self.steps
                nxt = steps[key] = self.step(state, key[1])
            if nxt is None:
                return None
            state = nxt
        best = [(0, -self.terms[k].weight, k) for k in state[1]]
        for node, e in state[0]:
            best += [(e, -self.terms[k].weight, k) for k in self.trie.ends[node] if e <= self.terms[k].edits]
        return (min(best)[2], min(best)[0]) if best else None


def core(word: str) -> str:
    """A word without marks around it."""
    a, b = 0, len(word)
    while a < b and not word[a].isalnum():
        a += 1
    while b > a and not word[b - 1].isalnum():
        b -= 1
    return word[a:b]


N_FEATURES = 4


class Scorer:
    """Features of texts: weighed hits, distinct terms not quoted, density, quoted share.

    A word near a term is a misspelling unless it is among ``innocent``, the
    near words that clean texts of the sample hold.
    """

    def __init__(self, terms: list[Term], innocent: frozenset[str] = frozenset()) -> None:
        self.matcher, self.innocent = Matcher(terms), innocent
        self.known: dict[str, tuple[int, int] | None] = {}

    def _match(self, word: str) -> tuple[int, int] | None:
        if word not in self.known:
            if len(self.known) > 300_000:
                self.known.clear()
            bare = core(word)
            got = self.matcher.match(bare)
            self.known[word] = None if got and got[1] and bare in self.innocent else got
        return self.known[word]

    def misspellings(self, texts: pa.Array) -> set[str]:
        """Words of the texts that are near a term but not the term."""
        words = pc.unique(split_words(pc.utf8_lower(texts))[1]).to_pylist()
        return {core(w) for w in words if (got := self._match(w)) and got[1]}

    def __call__(self, texts: pa.Array) -> np.ndarray:
        out = np.zeros((len(texts), N_FEATURES))
        offsets, words = split_words(pc.utf8_lower(texts))
        if not len(words) or not self.matcher.terms:
            return out
        coded = words.dictionary_encode()
        names = coded.dictionary.to_pylist()
        found = [self._match(w) for w in names]
        hit = np.array([f is not None for f in found])
        codes = coded.indices.to_numpy()
        at = np.flatnonzero(hit[codes])
        owner = np.searchsorted(offsets, at, side="right") - 1
        distinct: dict[int, set[int]] = {}
        for place, doc in zip(at.tolist(), owner.tolist()):
            term, edits = found[codes[place]]
            low, high = max(int(offsets[doc]), place - CONTEXT), min(int(offsets[doc + 1]), place + CONTEXT + 1)
            near = [names[c] for c in codes[low:high].tolist()]
            weight = self.matcher.terms[term].weight
            if edits:
                weight *= MISSPELLED_WEIGHT
            if self._quoted(near, place - low):
                weight *= QUOTED_WEIGHT
                out[doc, 3] += 1
            else:
                distinct.setdefault(doc, set()).add(term)
                if any(core(w) in AIMED for w in near):
                    weight *= AIMED_WEIGHT
            out[doc, 0] += weight
        sizes = np.maximum(np.diff(offsets), 1)
        out[:, 3] /= np.maximum(np.bincount(owner, minlength=len(texts)), 1)
        for doc, terms in distinct.items():
            out[doc, 1] = len(terms)
        out[:, 2] = np.minimum(1.0, 100 * out[:, 0] / sizes)
        out[:, :2] = np.log1p(out[:, :2])
        return out

    @staticmethod
    def _quoted(near: list[str], place: int) -> bool:
        """Quotation marks on both sides, or a reporting word just before."""
        before, after = near[: place + 1], near[place:]
        marks = any(w[0] in QUOTES for w in before) and any(core_end(w) for w in after)
        return marks or any(core(w) in REPORTING for w in near[max(0, place - 3) : place])


def core_end(word: str) -> bool:
    return any(ch in QUOTES for ch in word[1:])


@dataclass(frozen=True)
class Model:
    terms: list[Term]
    weights: list[float]  # the intercept last
    innocent: frozenset[str] = frozenset()

    def score(self, features: np.ndarray) -> np.ndarray:
        w = np.array(self.weights)
        return 1 / (1 + np.exp(-np.clip(features @ w[:-1] + w[-1], -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.05) -> list[float]:
    """Newton steps with a quadratic penalty on all weights but the intercept."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x1.shape[1])
    ridge = np.diag([penalty] * x.shape[1] + [1e-6])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        step = np.linalg.solve(
            (x1 * (p * (1 - p))[:, None]).T @ x1 + ridge + 1e-9 * np.eye(len(w)), x1.T @ (y - p) - ridge @ w
        )
        w += np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-6:
            break
    return w.tolist()


def training_ids(labels: DataFrame, flag: str, held_out: Column, rows: int) -> DataFrame:
    """At most ``rows`` labelled ids of each class that are not held out, by a hash of the id."""
    known = labels.where(F.col(flag).isNotNull() & F.col("doc_id").isNotNull() & ~held_out)
    known = known.groupBy("doc_id").agg(F.max(flag).alias("_toxic"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    return known.where("_toxic > 0").orderBy(*order).limit(rows).union(known.where("_toxic <= 0").orderBy(*order).limit(rows))


def _distinct_sample(docs: DataFrame, labels: DataFrame, flag: str, held_out: Column, rows: int) -> DataFrame:
    """Texts with label and fold, one of each group of near copies.

    Copies would make every word of a text look like a term of its class. Texts
    that share one of four minima of hashed shingles count as copies.
    """
    ids = training_ids(labels, flag, held_out, rows)
    joined = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")

    def minima(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salts = np.array([0, 0x5BD1E995A5A5A5A5, 0x27D4EB2F165667C5, 0x165667B19E3779F9], np.uint64)
        for batch in slices(batches, "text"):
            sets = shingle_sets(texts_of(batch, "text"), 3)
            least = [[int(((s ^ salt) * np.uint64(0x9E3779B97F4A7C15)).min() >> np.uint64(1)) if len(s) else -1 for salt in salts] for s in sets]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(least, pa.list_(pa.int64()))], names=[*batch.schema.names, "_least"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in joined.schema)
    drawn = materialise(
        joined.mapInArrow(minima, kinds + ", _least array<long>").withColumn("_row", F.monotonically_increasing_id()), "labelled"
    )
    seen: list[set[int]] = [set() for _ in range(4)]
    keep: list[tuple[int, int]] = []
    # narrow rows of the bounded sample
    for row, toxic, least in drawn.select("_row", "_toxic", "_least").orderBy(F.xxhash64("doc_id"), "_row").toLocalIterator():
        if not any(v in s for v, s in zip(least, seen)):
            keep.append((row, len(keep) % 2))
        for v, s in zip(least, seen):
            s.add(v)
    spark = docs.sparkSession
    folds = F.broadcast(spark.createDataFrame(keep, "_row long, _fold int"))
    return materialise(drawn.join(folds, "_row").select("text", "_toxic", "_fold"), "labelled")


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts that hold each word and each stem, by class and fold."""
    for batch in slices(batches, "text"):
        counts: Counter = Counter()
        texts = texts_of(batch, "text").to_pylist()
        for text, toxic, fold in zip(texts, batch.column("_toxic").to_pylist(), batch.column("_fold").to_pylist()):
            words = {core(w) for w in text.lower().split()}
            group = 2 * fold + (toxic > 0)
            for w in words:
                if len(w) >= 3:
                    counts[(w, False, group)] += 1
            for stem in {w[:n] for w in words for n in STEM_LENGTHS if len(w) > n}:
                counts[(stem, True, group)] += 1
        cols = list(zip(*[(*k, n) for k, n in counts.items()])) or [(), (), (), ()]
        kinds = (pa.string(), pa.bool_(), pa.int32(), pa.int64())
        yield pa.RecordBatch.from_pydict({n: pa.array(c, k) for n, c, k in zip(("term", "stem", "grp", "n"), cols, kinds)})


def select_terms(rows: list[tuple[str, bool, int, int]], toxic: int, clean: int, vocabulary: int) -> list[Term]:
    """Terms too frequent in toxic texts for chance, each with a smoothed log-odds weight in 0..1.

    ``rows``: term, stem, toxic and clean texts that hold it. A term must beat
    the bound n * KL(share, base) >= ln(vocabulary) + 2. A stem must stand for
    words of its own; what a kept stem covers is left out.
    """
    base = min(0.9, max(1e-3, toxic / max(1, toxic + clean)))
    scored = []
    for term, stem, t, c in rows:
        share = t / (t + c)
        if t < MIN_SUPPORT or share < 0.8:
            continue
        rest = (1 - share) * math.log((1 - share) / (1 - base)) if share < 1 else 0.0
        if (t + c) * (share * math.log(share / base) + rest) < math.log(vocabulary + 1) + 2:
            continue
        odds = math.log((t + 0.5) / (toxic + 1)) - math.log((c + 0.5) / (clean + 1))
        scored.append((t, -len(term), term, stem, max(0.0, min(1.0, odds / 4))))
    found = {s[2]: s[0] for s in scored if s[3]}
    words = {s[2]: s[0] for s in scored if not s[3]}
    kept: list[Term] = []
    stems: set[str] = set()
    for t, _, term, stem, weight in sorted(scored, key=lambda s: (not s[3], -s[1], -s[0], s[2])):
        if any(term[:n] in stems for n in STEM_LENGTHS if n <= len(term)):
            continue
        if stem:
            # one word alone, or with its inflections, is better kept as a word
            if max((n for w, n in words.items() if w.startswith(term)), default=0) > 0.6 * t:
                continue
            # as long a stem as loses next to nothing
            longer = [w for w, n in found.items() if len(w) == len(term) + 1 and w.startswith(term) and n >= 0.97 * t]
            if longer:
                continue
            stems.add(term)
        kept.append(Term(term, stem, weight))
    order = {s[2]: s[0] for s in scored}
    return sorted(kept, key=lambda x: (-order[x.text], x.text))[:MAX_TERMS]


def learn(docs: DataFrame, labels: DataFrame, held_out: Column, flag: str = "toxic", rows: int = TRAIN_ROWS) -> Model:
    """Lexicon and weights from at most ``rows`` labelled texts a class, none of them held out.

    The weights are fitted on features that the lexicon of the other half gave,
    so that terms found by chance do not look sure. Without toxic or without
    clean texts to learn from, the lexicon is empty.
    """
    sample = _distinct_sample(docs, labels, flag, held_out, rows)
    sizes = {(r[0], r[1]): r[2] for r in sample.groupBy("_fold", (F.col("_toxic") > 0).cast("int").alias("t")).count().collect()}
    total = {t: sizes.get((0, t), 0) + sizes.get((1, t), 0) for t in (0, 1)}
    if not total[0] or not total[1]:
        return Model([], [0.0] * N_FEATURES + [-2.0])
    counted = materialise(
        sample.select("text", "_toxic", "_fold")
        .mapInArrow(_count_terms, "term string, stem boolean, grp int, n long")
        .groupBy("term", "stem")
        .agg(*[F.sum(F.when(F.col("grp") == g, F.col("n")).otherwise(0)).alias(f"g{g}") for g in range(4)]),
        "terms",
    )
    vocabulary = counted.count()
    # only terms that could pass for one of the lexicons; the sample bounds their number
    frequent = counted.where(f"g1 + g3 >= {MIN_SUPPORT} AND g1 + g3 >= 3 * (g0 + g2)").collect()

    def lexicon(folds: tuple[int, ...]) -> list[Term]:
        rows_ = [
            (r.term, r.stem, sum(r[f"g{2 * f + 1}"] for f in folds), sum(r[f"g{2 * f}"] for f in folds)) for r in frequent
        ]
        toxic, clean = (sum(sizes.get((f, t), 0) for f in folds) for t in (1, 0))
        return select_terms([r for r in rows_ if r[2] >= MIN_SUPPORT], toxic, clean, vocabulary)

    lexicons = [lexicon((0,)), lexicon((1,)), lexicon((0, 1))]

    def near_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorers = [Scorer(x) for x in lexicons]
        for batch in slices(batches, "text"):
            fold = batch.column("_fold").to_numpy()
            for which, scorer in enumerate(scorers):
                own = np.flatnonzero((fold == which) | (which == 2))
                words = sorted(scorer.misspellings(texts_of(batch.take(pa.array(own)), "text"))) if len(own) else []
                yield pa.RecordBatch.from_pydict(
                    {"which": pa.array([which] * len(words), pa.int32()), "word": pa.array(words, pa.string())}
                )

    clean = sample.where("_toxic <= 0").mapInArrow(near_words, "which int, word string").distinct().collect()
    innocent = [frozenset(r.word for r in clean if r.which == k) for k in range(3)]

    def crossed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorers = [Scorer(lexicons[1 - fold], innocent[1 - fold]) for fold in (0, 1)]
        for batch in slices(batches, "text"):
            texts, fold = texts_of(batch, "text"), batch.column("_fold").to_numpy()
            both = np.stack([s(texts) for s in scorers])
            x = both[fold, np.arange(len(fold))]
            yield pa.RecordBatch.from_pydict(
                {"y": pa.array(batch.column("_toxic").to_numpy() > 0), "x": pa.array(list(x), pa.list_(pa.float64()))}
            )

    got = sample.mapInArrow(crossed, "y boolean, x array<double>").collect()
    x, y = np.array([r.x for r in got]), np.array([float(r.y) for r in got])
    return Model(lexicons[2], fit_logistic(x, y), innocent[2])


def score_texts(docs: DataFrame, model: Model, id_column: str = "doc_id", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: the id) plus ``score`` (0..1) and ``predicted`` (score >= 0.7).

    A null or empty text has no hits and gets the score of such texts. Repeated
    rows get the same score, an empty table gives an empty one. Kept columns
    named like a result are replaced.
    """
    names = [n for n in keep or [id_column] if n.lower() not in ("score", "predicted")]
    kinds = ", ".join(f"`{n}` {docs.schema[n].dataType.simpleString()}" for n in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model.terms, model.innocent)
        for batch in slices(batches, "text"):
            score = model.score(scorer(texts_of(batch, "text")))
            arrays = [batch.column(n) for n in names]
            arrays += [pa.array(score), pa.array((score >= CUTOFF).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, "score", "predicted"])

    return docs.select(*dict.fromkeys([*names, "text"])).mapInArrow(run, kinds + ", score double, predicted int")


def held_out(id_column: str = "doc_id") -> Column:
    """Rows whose label is not learned: crc32 of the id as text is 1 modulo 3. A null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 3 == 1, F.lit(False))
