"""Periodic runs of words: stretches that repeat with one period, at least twice.

A run with period q over ``length`` words is a maximal pair: the same
``length - q`` words stand at two places q apart, with different words before
and after. The pairs come from the intervals of equal prefixes of the sorted
suffixes (the LCP-interval tree), visited from the deepest up. Each interval
keeps the positions below it by the word on their left, and only pairs at most
as far apart as their common prefix is long are formed, so no pair needs to be
extended or compared.

A run of at least ``least`` words has pairs of at least ``least / 2`` words.
Suffixes whose first words do not come back that soon carry no run and are left
out of the tree.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.arrow import mixed, slices, split_words, texts_of

LEAST_WORDS = 12
# Bytes of text searched together.
SLICE = 3 << 20
OWN = ("n_words", "runs", "collapsed")
_PRIME = np.uint64(0x9E3779B97F4A7C15)


class _Place:
    """Positions below one interval, sorted, and those that begin a block of one left word."""

    __slots__ = ("heads", "all")

    def __init__(self, position: int) -> None:
        self.all = [position]
        self.heads = [position]

    def _back(self, x: int, low: int, own: int, left: list[int]) -> Iterator[int]:
        """Positions from ``x`` down to ``low`` whose left word is not ``own``."""
        k = bisect_left(self.all, x) - 1
        while k >= 0 and self.all[k] >= low:
            at = self.all[k]
            if left[at] == own:  # the whole block has this left word
                k = bisect_left(self.all, self.heads[bisect_right(self.heads, at) - 1]) - 1
            else:
                yield at
                k -= 1

    def _on(self, x: int, high: int, own: int, left: list[int]) -> Iterator[int]:
        k = bisect_right(self.all, x)
        while k < len(self.all) and self.all[k] <= high:
            at = self.all[k]
            if left[at] == own:
                h = bisect_right(self.heads, at)
                if h == len(self.heads):
                    return
                k = bisect_left(self.all, self.heads[h])
            else:
                yield at
                k += 1

    def add(self, x: int, left: list[int]) -> None:
        k = bisect_left(self.all, x)
        after = self.all[k] if k < len(self.all) else None
        alike = k > 0 and left[self.all[k - 1]] == left[x]
        if not alike:
            insort(self.heads, x)
        if after is not None:
            h = bisect_left(self.heads, after)
            was = h < len(self.heads) and self.heads[h] == after
            if was != (left[after] != left[x]):
                if was:
                    self.heads.pop(h)
                else:
                    self.heads.insert(h, after)
        self.all.insert(k, x)

    def merge(self, other: _Place, depth: int, left: list[int], pairs: list[tuple[int, int, int]]) -> _Place:
        """Both places as one; notes the maximal pairs between them that are at most ``depth`` apart."""
        few, many = sorted((self, other), key=lambda p: len(p.all))
        for x in few.all:
            own = left[x]
            pairs.extend((y, x, depth) for y in many._back(x, x - depth, own, left))
            pairs.extend((x, y, depth) for y in many._on(x, x + depth, own, left))
        for x in few.all:
            many.add(x, left)
        return many


def maximal_pairs(suffixes: list[int], common: list[int], left: list[int]) -> list[tuple[int, int, int]]:
    """(i, j, length) of maximal pairs with j - i <= length.

    ``suffixes`` are positions in the order of their suffixes, ``common[k]`` the
    prefix that suffix k shares with the one before (0: none), ``left[i]`` a
    code of the word before position i, below 0 and unlike all others where
    there is none.
    """
    pairs: list[tuple[int, int, int]] = []
    stack: list[tuple[int, _Place]] = []
    for k in range(len(suffixes) + 1):
        depth = common[k] if k < len(suffixes) else 0
        # the suffix before hangs below the deeper of its two neighbours' prefixes
        place = _Place(suffixes[k - 1]) if k else None
        while stack and stack[-1][0] > depth:
            above, held = stack.pop()
            place = held.merge(place, above, left, pairs)
        if depth:
            if stack and stack[-1][0] == depth:
                place = stack.pop()[1].merge(place, depth, left, pairs)
            stack.append((depth, place))
    return pairs


def _order(codes: np.ndarray, owner: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose suffixes share ``width`` words with another of their text, sorted, and common prefix lengths.

    ``codes`` holds the words of all texts, each text followed by a 0, and at
    least ``width`` more zeros at the end.
    """
    n = len(owner)
    gram = owner.astype(np.uint64) * _PRIME
    for k in range(width):
        gram = (gram ^ codes[k : k + n].astype(np.uint64)) * _PRIME
        gram ^= gram >> np.uint64(29)
    gram = mixed(gram)
    inside = np.zeros(n, bool)
    inside[: n - width + 1] = owner[width - 1 :] == owner[: n - width + 1]
    inside[: n - width + 1] &= codes[width - 1 : n] != 0
    where = np.flatnonzero(inside)
    own = gram[where]
    by = np.argsort(own, kind="stable")
    same = own[by][1:] == own[by][:-1]
    again = np.zeros(len(by), bool)
    again[1:] |= same
    again[:-1] |= same
    hits = np.sort(where[by[again]])
    if not len(hits):
        return hits, hits
    # exact ranks by the first `width` words of these positions and of those `width` further on
    seen = np.unique(np.concatenate([hits, hits + width]))
    keys = [codes[seen + k] for k in reversed(range(width))] + [owner[seen]]
    order = np.lexsort(keys)
    new = np.zeros(len(seen), bool)
    new[0] = True
    for key in keys:
        new[1:] |= key[order][1:] != key[order][:-1]
    rank = np.full(n + width, -1, np.int64)
    heads = np.flatnonzero(new)
    rank[seen[order]] = heads[np.cumsum(new) - 1]
    sorted_at = seen[order]
    levels = [(width, rank.copy())]
    step, total = width, np.int64(len(seen) + 1)
    while True:
        group = rank[sorted_at]
        multiple = np.zeros(len(group), bool)
        multiple[1:] |= group[1:] == group[:-1]
        multiple[:-1] |= group[1:] == group[:-1]
        slots = np.flatnonzero(multiple)
        if not len(slots):
            break
        at = sorted_at[slots]
        both = rank[at] * total + rank[at + step]
        move = np.argsort(both, kind="stable")
        at, both = at[move], both[move]
        sorted_at[slots] = at
        fresh = np.ones(len(at), bool)
        fresh[1:] = both[1:] != both[:-1]
        rank[at] = slots[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]]
        step *= 2
        levels.append((step, rank.copy()))
    # common prefix of neighbours: by halving steps, then word by word
    kept = np.isin(sorted_at, hits)
    sorted_at = sorted_at[kept]
    a, b = sorted_at[:-1], sorted_at[1:]
    common = np.zeros(len(sorted_at), np.int64)
    length = np.zeros(len(a), np.int64)
    alike = owner[a] == owner[b]
    for size, ranks in reversed(levels):
        ra = ranks[np.minimum(a + length, len(ranks) - 1)]
        rb = ranks[np.minimum(b + length, len(ranks) - 1)]
        length += size * (alike & (ra == rb) & (ra >= 0))
    alike &= length >= width
    going = alike.copy()
    for _ in range(width):
        ca, cb = codes[np.minimum(a + length, len(codes) - 1)], codes[np.minimum(b + length, len(codes) - 1)]
        going &= (ca == cb) & (ca != 0)
        length += going
    common[1:] = np.where(alike, length, 0)
    return sorted_at, common


def _near(order: np.ndarray, common: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Leaves out suffixes whose first words come back only further on than they share words with any other."""
    if not len(order):
        return order, common
    longest = common.copy()
    longest[:-1] = np.maximum(longest[:-1], common[1:])
    family = np.cumsum(common < width)
    by = np.lexsort((order, family))
    gap = np.full(len(order), np.iinfo(np.int64).max)
    step = np.diff(order[by])
    step[np.diff(family[by]) != 0] = np.iinfo(np.int64).max
    gap[1:] = step
    gap[:-1] = np.minimum(gap[:-1], step)
    nearest = np.empty_like(gap)
    nearest[by] = gap
    stay = np.flatnonzero(nearest <= longest)
    if not len(stay):
        return order[:0], common[:0]
    # what is shared across left-out suffixes is the least on the way
    low = np.minimum.reduceat(common[: stay[-1] + 1], np.concatenate([[0], stay[:-1] + 1]))
    # the first stretch begins before the first suffix kept; nothing precedes it
    low[0] = 0
    return order[stay], low


def find_runs(codes: np.ndarray, offsets: np.ndarray, least: int = LEAST_WORDS) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of all runs of each text, sorted.

    ``codes`` are word codes from 0, ``offsets`` where each text begins. A run
    has at least ``least`` words and twice its smallest period.
    """
    width = max(1, least - least // 2)
    counts = np.diff(offsets)
    out: list[list[tuple[int, int, int]]] = [[] for _ in counts]
    slots = counts + 1
    begins = np.cumsum(slots) - slots
    n = int(slots.sum())
    if n <= width:
        return out
    laid = np.zeros(n + width, np.int64)
    owner = np.repeat(np.arange(len(counts)), slots)
    laid[np.arange(len(codes)) + owner[np.arange(n) != np.repeat(begins + counts, slots)]] = codes + 1
    order, common = _near(*_order(laid, owner, width), width)
    if not len(order):
        return out
    # the word before each position; a text's first word has none, unlike any other's
    before = np.where(order > 0, laid[order - 1], 0)
    left = dict(zip(order.tolist(), np.where(before > 0, before, -1 - order).tolist()))
    smallest: dict[tuple[int, int], int] = {}
    for i, j, depth in maximal_pairs(order.tolist(), common.tolist(), left):
        period = j - i
        length = depth + period
        if length >= least and period < smallest.get((i, length), length):
            smallest[i, length] = period
    for (i, length), period in sorted(smallest.items()):
        text = int(owner[i])
        out[text].append((i - int(begins[text]), length, period))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def repeat_tails(offsets: np.ndarray, ids: list[int | None]) -> np.ndarray:
    """The place each word comes from after the tails of chosen texts were made periodic.

    For a text with ``crc32(id) % 10 = 0`` the words from a on repeat the p
    words at a; a, p and the choice derive from the id and the number of words.
    """
    import zlib

    source = np.arange(int(offsets[-1]), dtype=np.int64)
    for k, key in enumerate(ids):
        n = int(offsets[k + 1] - offsets[k])
        h = zlib.crc32(str(key).encode()) if key is not None else 1
        if h % 10 or not n:
            continue
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        first = int(offsets[k]) + a
        source[first : int(offsets[k + 1])] = first + np.arange(n - a) % p
    return source


def _collapsed(words: list[str], runs: list[tuple[int, int, int]]) -> str:
    if not runs:
        return " ".join(words)
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    return " ".join([w for w, g in zip(words, np.cumsum(gone).tolist()) if not g])


def collapse_runs(
    docs: DataFrame, key: str = "doc_id", least: int = LEAST_WORDS, damage: bool = False, digest: bool = False
) -> DataFrame:
    """Columns of ``docs`` but ``text``, with ``n_words``, ``runs``, ``collapsed``.

    Words are runs without ASCII white space. ``runs`` is an array of (start,
    length, period) by start, then period: each stretch of at least ``least``
    words and two smallest periods that no neighbouring word extends.
    ``collapsed`` holds the words that no run covers after its first period,
    joined by one blank. With ``damage`` tails of some texts are made periodic
    first (``repeat_tails``); a null ``key`` is never chosen. With ``digest``
    ``collapsed`` is its lowercase sha256. A text that is null, empty or blank
    has no words and no runs. Repeated rows each get the same result, an empty
    table gives an empty one, and a column named like a result is replaced. A
    text is held by one task; a batch holds ``SLICE`` bytes of text or one text.
    """
    passed = [f for f in docs.schema if f.name != "text" and f.name.lower() not in OWN]
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in passed]
    names = [f"_c{k}" for k in range(len(passed))]
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            offsets, words = split_words(texts_of(batch, "text"))
            coded = words.dictionary_encode()
            codes, known = coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()
            if damage:
                codes = codes[repeat_tails(offsets, batch.column("_key").to_pylist())]
            found = find_runs(codes, offsets, least)
            spelled = [known[c] for c in codes.tolist()]
            kept = [
                _collapsed(spelled[a:b], r) for a, b, r in zip(offsets[:-1].tolist(), offsets[1:].tolist(), found)
            ]
            if digest:
                kept = [hashlib.sha256(t.encode()).hexdigest() for t in kept]
            runs = [[dict(zip(("start", "length", "period"), r)) for r in rs] for rs in found]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in names],
                    pa.array(np.diff(offsets)),
                    pa.array(runs, run_type),
                    pa.array(kept, pa.string()),
                ],
                names=[*names, *OWN],
            )

    taken = docs.select(
        *[F.col(f"`{f.name}`").alias(c) for f, c in zip(passed, names)], F.col(f"`{key}`").alias("_key"), "text"
    )
    made = ", ".join([k.replace(f"`{f.name}`", c, 1) for k, f, c in zip(kinds, passed, names)])
    made = made + ", " if made else ""
    result = taken.mapInArrow(
        run, made + "n_words long, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
    )
    return result.select(*[F.col(c).alias(f.name) for f, c in zip(passed, names)], *OWN)


def longest_run(collapsed: DataFrame) -> DataFrame:
    """``collapsed`` rows with ``n_runs``, ``longest`` (greatest length, then smallest start, then period) and ``runs_text``.

    ``runs_text`` holds ``start,length,period`` and a line feed for every run.
    """
    first = F.array_sort(
        "runs",
        lambda a, b: F.when(a["length"] != b["length"], F.signum(b["length"] - a["length"]))
        .when(a["start"] != b["start"], F.signum(a["start"] - b["start"]))
        .otherwise(F.signum(a["period"] - b["period"]))
        .cast("int"),
    )
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return collapsed.withColumns(
        {"n_runs": F.size("runs").cast("long"), "longest": F.get(first, F.lit(0)), "runs_text": F.array_join(line, "")}
    )
