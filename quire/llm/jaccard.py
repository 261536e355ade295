"""Similarity join of texts on word shingles: which texts are near copies.

Equal shingle sets are one class. Classes are joined on the rarest part of
their sets (prefix filter under a rare-first order), with length, positional
and suffix filters; what is left is verified once a pair on the whole sets.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm.arrow import set_hash, shingle_sets, slices, texts_of
from quire.llm.components import components
from quire.scratch import broadcast_if_small, materialise, release

WIDTH = 5
PERCENT = 75
# Counters of the frequency sketch: a fixed 4 MB whatever the corpus. It only orders shingles, so that
# colliding counts cost time and never a link.
SKETCH_BITS = 20
# A shingle estimated in more sets than this is dealt over several tasks.
HEAVY = 20_000
SALTS = 16
# Bits of the filter that finds texts to verify: a fixed 4 MB; false hits only cost time.
BLOOM_BITS = 25
# Parts of the hash space in the suffix summary of a set: two per element, and beyond these one, but no fewer than LEAST_PARTS.
MANY_PARTS, LEAST_PARTS = 2_048, 64
# Partners a row is given, and shingles of a class that are tried, before the links found so far are merged.
FAN, FAN_TOKENS = 8, 4
# Rows of a shingle in one block: a task compares two blocks at a time, however many classes share the shingle.
BLOCK_ROWS = 4_096


def parities(values: np.ndarray) -> bytes:
    """One bit per part of the hash space: whether the set holds an odd number of its hashes. The parts are a power of two."""
    parts = max(LEAST_PARTS, min(2 * len(values), max(MANY_PARTS, len(values))))
    bits = (parts - 1).bit_length()
    held = np.bincount((values & np.uint64((1 << bits) - 1)).astype(np.int64), minlength=1 << bits)
    return np.packbits((held & 1).astype(np.uint8), bitorder="little").tobytes()


def _fold(rows: np.ndarray, width: int) -> np.ndarray:
    """The same with fewer parts: those with equal low bits become one."""
    return np.bitwise_xor.reduce(rows.reshape(len(rows), -1, width), axis=1)


def _differing(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Parts of unequal parity, row by row: each holds an element of one set alone."""
    width = min(x.shape[1], y.shape[1])
    return np.bitwise_count(_fold(x, width) ^ _fold(y, width)).sum(1, dtype=np.int64)


def least_difference(a: np.ndarray, b: np.ndarray, step: int = 4_096) -> np.ndarray:
    """Suffix filter of pairs: how many elements the sets behind a[k] and b[k] surely do not share."""
    out = np.empty(len(a), np.int64)
    if not len(a):
        return out
    widths = np.stack([np.fromiter(map(len, v), np.int64, len(v)) for v in (a, b)], 1)
    for wide in np.unique(widths, axis=0):
        same = np.flatnonzero((widths == wide).all(1))
        for at in range(0, len(same), step):
            part = same[at : at + step]
            x, y = (np.frombuffer(b"".join(v[part]), np.uint8).reshape(len(part), -1) for v in (a, b))
            out[part] = _differing(x, y)
    return out


def _slot(values: np.ndarray) -> np.ndarray:
    return (values & np.uint64((1 << SKETCH_BITS) - 1)).astype(np.int64)


def _sketch_rows(counters: np.ndarray, pieces: int = 16) -> list[tuple[int, bytes]]:
    return [(k, zlib.compress(part.tobytes(), 1)) for k, part in enumerate(np.split(counters, pieces)) if part.any()]


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def describe_sets(docs: DataFrame, id_column: str, width: int = WIDTH) -> DataFrame:
    """One row per document: id, text hash ``th``, class ``cid``, ``n_shingles``, ``parities``.

    The class is a hash of the set. ``parities`` sums the set up
    for the suffix filter. Rows with ``piece`` set carry, per task, the counters of
    the frequency sketch, to which each class adds once a task at most per
    8,192 classes in a row.
    """
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(1 << SKETCH_BITS, np.uint32)
        seen: set[int] = set()
        type_ = None
        for batch in slices(batches, "text"):
            type_ = batch.schema.field(id_column).type
            sets = shingle_sets(texts_of(batch, "text"), width)
            cids = [set_hash(s) if len(s) else None for s in sets]
            rows = []
            for cid, s in zip(cids, sets):
                if cid is None:
                    rows.append(None)
                    continue
                rows.append(parities(s))
                if cid not in seen:
                    seen.add(cid)
                    np.add.at(counters, _slot(s), np.uint32(1))
            if len(seen) > 8_192:
                seen.clear()
            n = len(sets)
            yield pa.RecordBatch.from_pydict(
                {
                    id_column: batch.column(id_column),
                    "th": batch.column("th"),
                    "cid": pa.array(cids, pa.int64()),
                    "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                    "parities": pa.array(rows, pa.binary()),
                    "piece": pa.nulls(n, pa.int32()),
                    "counters": pa.nulls(n, pa.binary()),
                }
            )
        made = _sketch_rows(counters)
        if made and type_ is not None:
            n = len(made)
            yield pa.RecordBatch.from_pydict(
                {
                    id_column: pa.nulls(n, type_),
                    "th": pa.nulls(n, pa.int64()),
                    "cid": pa.nulls(n, pa.int64()),
                    "n_shingles": pa.nulls(n, pa.int64()),
                    "parities": pa.nulls(n, pa.binary()),
                    "piece": pa.array([p for p, _ in made], pa.int32()),
                    "counters": pa.array([c for _, c in made], pa.binary()),
                }
            )

    schema = f"`{id_column}` {kind}, th long, cid long, n_shingles long, parities binary, piece int, counters binary"
    return _with_hash(docs, id_column).mapInArrow(run, schema)


def _with_hash(docs: DataFrame, id_column: str | None) -> DataFrame:
    ids = [id_column] if id_column else []
    text = F.coalesce("text", F.lit(""))
    return docs.select(*ids, text.alias("text"), F.xxhash64(text).alias("th"))


def collect_sketch(described: DataFrame) -> np.ndarray:
    """The summed counters: a fixed number of them, whatever the corpus."""

    def add(table: pa.Table) -> pa.Table:
        total = None
        for part in table.column("counters").to_pylist():
            own = np.frombuffer(zlib.decompress(part), np.uint32).astype(np.uint64)
            total = own if total is None else total + own
        return pa.table({"piece": table.column("piece")[:1], "counters": pa.array([total.tobytes()], pa.binary())})

    rows = described.where("piece IS NOT NULL").select("piece", "counters")
    out = np.zeros((16, (1 << SKETCH_BITS) // 16), np.uint64)
    for piece, part in rows.groupBy("piece").applyInArrow(add, "piece int, counters binary").collect():
        out[piece] = np.frombuffer(part, np.uint64)
    return out.reshape(-1)


def prefix_rows(docs: DataFrame, sketch, width: int, percent: int) -> DataFrame:
    """``token``, ``cid``, ``meta``: the rarest shingles of every class, rare first.

    ``meta`` packs the place of the token in the set's order, the size of the
    set, and whether the token is heavy, so that rows stay small in the shuffle.

    A class of n shingles needs n - ceil(percent * n / 100) + 1 of them: two
    classes that are similar enough share at least one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = sketch.value
        heavy_from = max(HEAVY, 8 * int(count.mean()))
        seen: set[int] = set()
        for batch in slices(batches, "text"):
            tokens, cids, sizes, places = [], [], [], []
            for s in shingle_sets(texts_of(batch, "text"), width):
                n = len(s)
                if not n or (cid := set_hash(s)) in seen:
                    continue
                seen.add(cid)
                take = n - ceil(percent * n / 100) + 1
                order = np.argsort(count[_slot(s)], kind="stable")[:take]
                tokens.append(s[order])
                cids.append(np.full(take, cid, np.int64))
                sizes.append(np.full(take, n, np.int64))
                places.append(np.arange(take, dtype=np.int64))
            if len(seen) > 65_536:
                seen.clear()
            if not tokens:
                continue
            token, cid = np.concatenate(tokens), np.concatenate(cids)
            heavy = count[_slot(token)] > heavy_from
            yield pa.RecordBatch.from_pydict(
                {
                    "token": pa.array(_signed(token)),
                    "cid": pa.array(cid),
                    "meta": pa.array(np.concatenate(places) << 33 | np.concatenate(sizes) << 1 | heavy),
                }
            )

    return docs.select("text").mapInArrow(run, "token long, cid long, meta long")


SALT = f"IF(meta & 1 = 1, 1 + pmod(cid, {SALTS}), 0)"


def _unpack(meta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Size of the set and place of the token."""
    return (meta >> 1) & 0xFFFFFFFF, meta >> 33


def _could_link(n1, place1, n2, place2, percent: int):
    """Length and positional filter of two classes at a shared token."""
    need = _need(n1, n2, percent)
    room = np.minimum(n1 - place1, n2 - place2) + np.minimum(place1, place2)
    return (np.minimum(n1, n2) * 100 >= np.maximum(n1, n2) * percent) & (room >= need)


def _partnered(run: np.ndarray, n: np.ndarray, place: np.ndarray, percent: int) -> np.ndarray:
    """Rows for which the run could hold a partner: by the nearest sizes, and by the places too in a run of two."""
    order = np.lexsort((n, run))
    ok = np.zeros(len(run), bool)
    near = (run[order][1:] == run[order][:-1]) & (n[order][:-1] * 100 >= n[order][1:] * percent)
    ok[order[1:]] |= near
    ok[order[:-1]] |= near
    begins = np.flatnonzero(np.append(True, run[1:] != run[:-1]))
    first = begins[np.diff(np.append(begins, len(run))) == 2]
    ok[first] = ok[first + 1] = _could_link(n[first], place[first], n[first + 1], place[first + 1], percent)
    return ok


def _shared_runs(percent: int):
    """Of rows sorted by token, salt, place and class: those whose token occurs in several classes.

    A row without a partner of a similar size in its run is left out, where the
    run lies in one batch.

    Each row gets the links to try first, if the filters let them pass: the
    class before it in its run (``prev``) and the first of the run (``hub``).
    The first has the fewest rarer shingles: of edited copies of a text, that is
    the text, to which all of them are closer than to each other. ``head`` marks
    the first. Rows of salted tokens always stay. A class stands in a run once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the row not yet emitted: it goes if it is alone in its run
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(c).to_numpy() for c in ("token", "salt", "cid", "meta")]
            if last is not None:
                cols = [np.concatenate([a, b]) for a, b in zip(last[0], cols)]
            same = np.zeros(len(cols[0]), bool)
            same[1:] = (cols[0][1:] == cols[0][:-1]) & (cols[1][1:] == cols[1][:-1])
            again = same.copy()
            again[1:] &= cols[2][1:] == cols[2][:-1]
            if again.any():
                cols, same = [x[~again] for x in cols], same[~again]
            # the first row of each row's run, which may lie before this batch
            begun = np.maximum.accumulate(np.where(same, 0, np.arange(len(same))))
            hub, hub_meta = cols[2][begun], cols[3][begun]
            if last is not None and last[1]:
                same[0] = True
                earlier = begun == 0
                hub[earlier], hub_meta[earlier] = last[2], last[3]
            n, place = _unpack(cols[3])
            prev, ok = np.zeros(len(same), np.int64), np.zeros(len(same), bool)
            prev[1:] = cols[2][:-1]
            ok[1:] = same[1:] & _could_link(n[:-1], place[:-1], n[1:], place[1:], percent)
            if last is not None:
                prev[0], ok[0] = last[4], last[5]
            near = same & _could_link(*_unpack(hub_meta), n, place, percent)
            keep = same | np.append(same[1:], True) | (cols[1] > 0)
            whole = (begun > begun[0]) & (begun < begun[-1]) & (cols[1] == 0)
            if whole.any():
                inner = np.flatnonzero(whole)
                keep[inner] &= _partnered(begun[inner], n[inner], place[inner], percent)
            keep[-1] = False
            out = (same, prev, ok, hub, near)
            if keep.any():
                yield _run_rows([x[keep] for x in cols], *(x[keep] for x in out))
            last = ([x[-1:] for x in cols], bool(same[-1]), int(hub[-1]), int(hub_meta[-1]), int(prev[-1]), bool(ok[-1]))
            rest = [x[-1:] for x in out]
        if last is not None and (last[1] or last[0][1][0] > 0):
            yield _run_rows(last[0], *rest)

    return run


def _run_rows(cols, same, prev, ok, hub, near) -> pa.RecordBatch:
    out = {k: pa.array(x) for k, x in zip(("token", "salt", "cid", "meta"), cols)}
    out["prev"] = pa.array(prev, mask=~ok)
    out["hub"] = pa.array(hub, mask=~near)
    out["head"] = pa.array(~same)
    return pa.RecordBatch.from_pydict(out)


def _need(n1, n2, percent: int):
    """Overlap that two sets of these sizes need to link."""
    return -(-percent * (n1 + n2) // (100 + percent))


def _apart(n1, n2, percent: int):
    """Elements that two linked sets of these sizes leave unshared, at most."""
    return n1 + n2 - 2 * _need(n1, n2, percent)


def _cross_pairs(percent: int, fan: int):
    """Pairs of one cell in different components that pass the length, positional and suffix filters.

    Rows come sorted by token, cell, place and class. A cell (``lo``, ``hi``)
    of a token pairs its blocks lo and hi, or one block with itself. ``fan``
    bounds the partners a row is given in this round, the first of the run; 0
    gives all of them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        cell = None
        found: list[np.ndarray] = []
        size = 0

        def keep(x: np.ndarray, y: np.ndarray) -> None:
            nonlocal size
            if len(x):
                found.append(np.stack([np.minimum(x, y), np.maximum(x, y)]))
                size += len(x)

        def settle() -> Iterator[pa.RecordBatch]:
            """All pairs of one cell, of at most two blocks."""
            rows = np.concatenate([r for r, _ in held])
            if len(rows) < 2 or (rows[:, 1] == rows[0, 1]).all():
                return
            odd = np.concatenate([b for _, b in held])
            cid, root, n, place, own, lo, hi = rows.T
            within = lo[0] == hi[0]
            width = np.fromiter(map(len, odd), np.int64, len(odd))
            spot = np.empty(len(rows), np.int64)
            tables = {}
            for w in np.unique(width).tolist():
                members = np.flatnonzero(width == w)
                spot[members] = np.arange(len(members))
                tables[w] = np.frombuffer(b"".join(odd[members]), np.uint8).reshape(len(members), w)
            for i in range(1, len(rows)):
                open_ = root[:i] != root[i]
                if not within:
                    open_ &= own[:i] != own[i]
                other = np.flatnonzero(open_)
                other = other[_could_link(n[other], place[other], n[i], place[i], percent)]
                if not len(other):
                    continue
                mine = tables[int(width[i])][spot[i]][None]
                passed = np.zeros(len(other), bool)
                for w, table in tables.items():
                    at = np.flatnonzero(width[other] == w)
                    if len(at):
                        passed[at] = _differing(table[spot[other[at]]], mine) <= _apart(n[other[at]], n[i], percent)
                other = other[passed]
                if fan:
                    other = other[:fan]
                keep(cid[other], np.full(len(other), cid[i]))
                if size > 100_000:
                    yield drain()

        def drain() -> pa.RecordBatch:
            nonlocal size
            a, b = np.concatenate(found, axis=1)
            found.clear()
            size = 0
            return pa.RecordBatch.from_pydict({"a": pa.array(a), "b": pa.array(b)})

        for batch in batches:
            if not batch.num_rows:
                continue
            cols = {c: batch.column(c).to_numpy() for c in ("token", "cid", "root", "meta", "own", "lo", "hi")}
            n, place = _unpack(cols["meta"])
            rows = np.stack([cols["cid"], cols["root"], n, place, cols["own"], cols["lo"], cols["hi"]], 1)
            odd = np.array(batch.column("parities").to_pylist(), object)
            key = np.stack([cols["token"], cols["lo"], cols["hi"]], 1)
            edges = np.concatenate([[0], np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1, [len(key)]])
            # most cells that lie inside the batch have two rows: all of those at once
            inner = np.flatnonzero(np.diff(edges) == 2)
            inner = inner[(inner > 0) & (inner < len(edges) - 2)]
            i, j = edges[inner], edges[inner] + 1
            near = (cols["root"][i] != cols["root"][j]) & _could_link(n[i], place[i], n[j], place[j], percent)
            near &= (cols["lo"][i] == cols["hi"][i]) | (cols["own"][i] != cols["own"][j])
            i, j = i[near], j[near]
            near = least_difference(odd[i], odd[j]) <= _apart(n[i], n[j], percent)
            keep(cols["cid"][i[near]], cols["cid"][j[near]])
            settled = np.zeros(len(edges), bool)
            settled[inner] = True
            for k in np.flatnonzero(~settled[:-1]).tolist():
                a, b = int(edges[k]), int(edges[k + 1])
                if held and tuple(key[a]) != cell:
                    yield from settle()
                    held.clear()
                cell = tuple(key[a])
                held.append((rows[a:b], odd[a:b]))
            if size:
                yield drain()
        if held:
            yield from settle()
        if size:
            yield drain()

    return run


def _bloom(spark: SparkSession, keys: DataFrame):
    """Bits set for the column ``th`` of ``keys``, packed in bytes: of fixed size."""
    bit = F.pmod("th", F.lit(1 << BLOOM_BITS))
    words = keys.groupBy(F.shiftright(bit, 6).alias("w")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(th, {1 << BLOOM_BITS}) % 64 as int))")).alias("m")
    )
    out = np.zeros(1 << (BLOOM_BITS - 6), np.int64)
    got = words.toArrow()
    out[got.column("w").to_numpy()] = got.column("m").to_numpy()
    return spark.sparkContext.broadcast(out)


def _sets_of(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """``cid``, ``shingles`` of the classes in ``wanted`` (cid, th), made again from one text of each."""
    bloom = _bloom(docs.sparkSession, wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = bloom.value
        seen: set[int] = set()
        for batch in batches:
            th = batch.column("th").to_numpy()
            bit = np.mod(th, 1 << BLOOM_BITS)
            hit = np.flatnonzero((bits[bit >> 6] >> (bit & 63)) & 1)
            fresh = [i for i in hit.tolist() if not (int(th[i]) in seen or seen.add(int(th[i])))]
            if len(seen) > 65_536:
                seen.clear()
            for part in slices(iter([batch.take(pa.array(fresh, pa.int64()))]), "text"):
                sets = shingle_sets(texts_of(part, "text"), width)
                yield pa.RecordBatch.from_pydict(
                    {
                        "cid": pa.array([set_hash(s) if len(s) else None for s in sets], pa.int64()),
                        "th": part.column("th"),
                        "shingles": pa.array([_signed(s) for s in sets], pa.list_(pa.int64())),
                    }
                )

    made = _with_hash(docs, None).mapInArrow(run, "cid long, th long, shingles array<long>")
    # by class alone, so that the same shuffle serves the join and what drops repeats
    named = wanted.select(F.col("cid").alias("_c"), F.col("th").alias("_t")).hint("merge")
    return (
        made.join(named, made["cid"] == named["_c"])
        .where(F.col("th") == F.col("_t"))
        .select("cid", "shingles")
        .dropDuplicates(["cid"])
    )


def _verified(docs: DataFrame, classes: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs (a, b) with 100 * overlap >= percent * union; the suffix filter first, then the sets."""
    side = classes.select("cid", "th", "n_shingles", "parities")
    left = side.select(*[F.col(c).alias(f"{c}_a") for c in side.columns])
    right = side.select(*[F.col(c).alias(f"{c}_b") for c in side.columns])
    both = pairs.join(left, F.col("a") == F.col("cid_a")).join(right, F.col("b") == F.col("cid_b"))
    sizes = F.col("n_shingles_a") + F.col("n_shingles_b")
    need = F.ceil(F.lit(percent) * sizes / F.lit(100 + percent)).cast("long")
    apart = sizes - 2 * need

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Suffix filter, before any set is fetched."""
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.array(batch.column(c).to_pylist(), object) for c in ("parities_a", "parities_b"))
            ok = pa.array(least_difference(x, y) <= batch.column("apart").to_numpy())
            yield batch.filter(ok).select(["a", "b", "th_a", "th_b", "need"])

    kept = materialise(
        both.select("a", "b", "th_a", "th_b", "parities_a", "parities_b", need.alias("need"), apart.alias("apart")).mapInArrow(
            bounded, "a long, b long, th_a long, th_b long, need long"
        ),
        "pairs",
    )
    wanted = kept.select(F.col("a").alias("cid"), F.col("th_a").alias("th")).union(kept.select("b", "th_b")).distinct()
    wanted = materialise(wanted, "wanted")
    sets = materialise(_sets_of(docs, wanted, width), "sets")
    one = sets.select(F.col("cid").alias("a"), F.col("shingles").alias("set_a"))
    two = sets.select(F.col("cid").alias("b"), F.col("shingles").alias("set_b"))
    shared = F.size(F.array_intersect("set_a", "set_b"))
    both = kept.join(one.hint("merge"), "a").join(two.hint("merge"), "b").where(shared >= F.col("need")).select("a", "b")
    found = materialise(both, "verified")
    release(kept, wanted, sets)
    return found


def near_copies(
    docs: DataFrame, id_column: str = "doc_id", width: int = WIDTH, percent: int = PERCENT
) -> DataFrame:
    """``id_column``, ``n_shingles``, ``component_id`` of every row of ``docs`` (with a ``text``).

    Two rows link when 100 * overlap >= ``percent`` * union of their distinct
    ``width``-word shingles (ASCII white space, A-Z in lower case). The
    component is the smallest id reachable by links, itself included. A null or
    empty text, or one without words, has no shingles and links with nothing;
    its component is its id. Rows with a null id link like others but never
    name a component; one without any non-null id has a null component. Repeated
    rows are repeated in the result. An empty table gives an empty one. Other
    columns are ignored.

    No link is lost and not every pair is tried: pairs within a component that
    is already known are left out. First each class is tried with its
    predecessor and the first class in every prefix shingle's run, then with a few others, then with
    all that are still in other components and pass the filters. Shingles and
    classes are 64-bit hashes.
    """
    spark = docs.sparkSession
    described = materialise(describe_sets(docs, id_column, width), "described")
    of_docs = described.where("piece IS NULL")
    rows = materialise(of_docs.select(id_column, "cid", "n_shingles"), "described")
    classes = materialise(
        of_docs.where("cid IS NOT NULL")
        .groupBy("cid")
        .agg(
            F.min("th").alias("th"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("parities").alias("parities"),
            F.min(id_column).alias("least"),
        ),
        "classes",
    )
    sketch = spark.sparkContext.broadcast(collect_sketch(described))
    release(described)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    prefixes = prefix_rows(docs, sketch, width, percent)
    runs = materialise(
        prefixes.repartition(parts, "token", F.expr(SALT))
        .select("token", F.expr(SALT).cast("int").alias("salt"), "cid", "meta")
        .sortWithinPartitions("token", "salt", "meta", "cid")
        .mapInArrow(_shared_runs(percent), "token long, salt int, cid long, meta long, prev long, hub long, head boolean"),
        "runs",
    )
    tries = runs.select(F.explode(F.array("prev", "hub")).alias("other"), "cid").where("other <> cid")
    chain = tries.select(F.least("other", "cid").alias("a"), F.greatest("other", "cid").alias("b"))
    # the parts of a salted run are chained by their smallest classes
    heads = runs.where("salt > 0 AND head").groupBy("token").agg(F.sort_array(F.collect_set("cid")).alias("h"))
    steps = F.expr("transform(sequence(1, size(h) - 1), i -> struct(h[i - 1] AS a, h[i] AS b))")
    across = heads.where("size(h) > 1").select(F.explode(steps).alias("p")).select("p.a", "p.b")
    pairs = chain.union(across).distinct()
    tried = materialise(pairs, "tried")
    links = _verified(docs, classes, tried, width, percent)
    found = components(links)
    for fan in (FAN, 0):
        # shingles that still join several components
        roots = found.select(F.col("id").alias("cid"), "root")
        placed = runs.select("token", "cid", "meta").join(broadcast_if_small(roots), "cid", "left").withColumn(
            "root", F.coalesce("root", "cid")
        )
        mixed = (
            placed.groupBy("token")
            .agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("c"))
            .where("lo < hi")
            .select("token", F.ceil(F.col("c") / BLOCK_ROWS).cast("int").alias("blocks"))
        )
        blocked = placed.join(mixed, "token").withColumn("own", F.expr("cast(pmod(xxhash64(cid), blocks) AS int)"))
        if fan:  # the rarest shingles of each class, which near copies are likeliest to share
            rank = F.row_number().over(Window.partitionBy("cid").orderBy("meta", "token"))
            blocked = blocked.withColumn("rank", rank).where(F.col("rank") <= FAN_TOKENS)
        other = F.explode(F.expr("sequence(0, blocks - 1)")).alias("k")
        cells = blocked.select("token", "cid", "meta", "root", "own", other).select(
            "token", "cid", "meta", "root", "own", F.least("own", "k").alias("lo"), F.greatest("own", "k").alias("hi")
        )
        more = (
            cells.join(classes.select("cid", "parities"), "cid")
            .repartition(parts, "token", "lo", "hi")
            .sortWithinPartitions("token", "lo", "hi", "meta", "cid")
            .mapInArrow(_cross_pairs(percent, fan), "a long, b long")
            .distinct()
        )
        more = materialise(more.join(tried, ["a", "b"], "left_anti"), "tried")
        if not _any(more):
            continue  # a capped round without a new pair leaves partners beyond the cap
        tried = tried.union(more)
        links = links.union(_verified(docs, classes, more, width, percent))
        found = components(links)
    release(runs)
    named = classes.join(found.select(F.col("id").alias("cid"), "root"), "cid", "left").select(
        "cid", "least", F.coalesce("root", "cid").alias("root")
    )
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of_class = materialise(named.join(least, "root").select("cid", "component_id"), "components")
    return rows.join(of_class.hint("merge"), "cid", "left").select(
        id_column,
        "n_shingles",
        F.when(F.col("cid").isNull(), F.col(id_column)).otherwise(F.col("component_id")).alias("component_id"),
    )


def _any(df: DataFrame) -> bool:
    return bool(df.limit(1).count())
