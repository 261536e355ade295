"""Repair of conversation structure at least cost, by an auction for shortest paths.

A conversation is right when the initials of its roles spell ``(s?(ua)+)?``. A
lattice has a node for every turn and state of that pattern; arcs keep a turn,
change its role, delete it, or insert an empty one. Every node has a price, a
lower bound of the cost from there. A path grows from the origin along the arc
whose cost and next price equal the price of its end, and shrinks, raising the
price, where no arc does. Prices of nodes from which a path was completed are
exact: they show the arcs that cheapest repairs may take, and the repair whose
edits come first in ASCII order is traced along these.

Turns are ranged by conversation and turn over the tasks, so a conversation with
a third of all rows is cut into blocks. A block is summed up by the cost between
each two states; prices at the borders of blocks follow from these sums.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.arrow import slices
from quire.scratch import materialise

# Edits, their costs, the states and the roles an edit can give.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
ROLES = {"u": "user", "a": "assistant"}
START, SYSTEM, USER, DONE = range(4)
# state after a turn of each initial
NEXT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, DONE: USER}, "a": {USER: DONE}}
# states that each exit can be reached from
FROM = {START: (START,), SYSTEM: (START, SYSTEM), USER: (0, 1, 2, 3), DONE: (0, 1, 2, 3)}
ENDS = [0, None, None, 0]
LEGAL = ("su", "ua", "au")

BLANK = re.compile(r"[^\x20\x09-\x0D]")
# Turns of one block, turns of one auction.
BLOCK_TURNS = 2_048
BLOCK_CHARS = 4 << 20
TILE = 24
INF = float("inf")

DIGEST = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def damage(turns: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """``turns`` with planted faults, as many rows or more, and a column ``gone``.

    crc32 of ``conv:turn`` modulo 20: 0 marks the row as gone, 1 empties its
    text, 2 takes ``.!?`` out of it, 3 repeats the row, 4 makes it the user's.
    Nulls count as one blank.
    """
    spelled = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")) for c in (conv, turn)]
    fault = F.crc32(F.concat(spelled[0], F.lit(":"), spelled[1]).cast("binary")) % 20
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    times = F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return turns.withColumns(
        {
            "gone": fault == 0,
            "text": F.when(fault == 1, F.lit("")).when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text),
            "role": F.when(fault == 4, F.lit("user")).otherwise(role),
            "_copy": F.explode(times),
        }
    ).drop("_copy")


# ---- one lattice ----------------------------------------------------------------------------------------------------


def turn_arcs(symbol: str) -> list[list[tuple[str, int, int]]]:
    """(edit, cost, next state) of a turn from every state, in order of the edits' initials.

    ``symbol`` is ``x`` for a turn that has to go, else the role's initial, in
    upper case if the turn is truncated.
    """
    initial, extra = symbol.lower(), TRUNCATED if symbol.isupper() else 0
    out = []
    for state in range(4):
        arcs = [("D", DELETE, state)]
        if symbol != "x":
            if state in NEXT.get(initial, {}):
                arcs.append(("K", KEEP + extra, NEXT[initial][state]))
            arcs += [("R", REROLE + extra, NEXT[r][state]) for r in ROLES if state in NEXT[r]]
        out.append(arcs)
    return out


ARCS = {s: turn_arcs(s) for s in "xsuaoSUAO"}
INSERTS = [[("I", INSERT, NEXT[r][state]) for r in ROLES if state in NEXT[r]] for state in range(4)]


class Auction:
    """Prices of the nodes of one stretch of turns; ``exits`` are the exact prices behind it, None where none leads on."""

    def __init__(self, symbols: str, exits: list[int | None], states: tuple[int, ...] = (0, 1, 2, 3)) -> None:
        n = len(symbols)
        self.n = n
        self.price: list[float] = [0] * (4 * n + 5)
        self.exact = bytearray(4 * n + 5)
        self.end = 4 * n + 4
        self.exact[self.end] = 1
        self.arcs: list[list[tuple[str, int, int]]] = []
        for t in range(n + 1):
            for g in range(4):
                arcs = []
                if g in states:
                    if t < n:
                        arcs = [(e, c, 4 * (t + 1) + h) for e, c, h in ARCS[symbols[t]][g] if h in states]
                        arcs[1:1] = [(e, c, 4 * t + h) for e, c, h in INSERTS[g] if h in states]
                    else:
                        arcs = [(e, c, 4 * t + h) for e, c, h in INSERTS[g] if h in states]
                        if exits[g] is not None:
                            arcs.append(("", exits[g], self.end))
                self.arcs.append(arcs)

    def converge(self, origin: int) -> float:
        """The exact price of ``origin``: its path grows and shrinks until it meets a node of exact price."""
        price, arcs, exact = self.price, self.arcs, self.exact
        path = [origin]
        while not exact[path[-1]]:
            node = path[-1]
            best, to = INF, -1
            for _, cost, nxt in arcs[node]:
                if cost + price[nxt] < best:
                    best, to = cost + price[nxt], nxt
            if price[node] < best:
                price[node] = best
                if len(path) > 1:
                    path.pop()
                elif best == INF:
                    break
            else:
                path.append(to)
        if price[origin] < INF:
            for node in path:
                exact[node] = 1
        return price[origin]

    def trace(self, state: int) -> tuple[str, int]:
        """The first of the cheapest paths' edits in ASCII order, and the state it leaves in.

        An arc is taken if it is still tight once the price of its end is exact.
        """
        node, out = state, []
        self.converge(node)
        while node < 4 * self.n:
            for edit, cost, nxt in self.arcs[node]:
                if cost + self.price[nxt] == self.price[node] and cost + self.converge(nxt) == self.price[node]:
                    out.append(edit)
                    node = nxt
                    break
        while True:  # behind the last turn: inserts before the exit, whose empty initial comes first
            for edit, cost, nxt in sorted(self.arcs[node]):
                if cost + self.price[nxt] == self.price[node] and (nxt == self.end or cost + self.converge(nxt) == self.price[node]):
                    break
            if nxt == self.end:
                return "".join(out), node - 4 * self.n
            out.append(edit)
            node = nxt


def _tiles(symbols: str) -> list[str]:
    return [symbols[k : k + TILE] for k in range(0, len(symbols), TILE)] or [""]


@functools.lru_cache(maxsize=50_000)
def _solved(tile: str, exits: tuple[int | None, ...], states: tuple[int, ...]) -> tuple[tuple, tuple]:
    """Exact entry prices of a stretch, and per entry state its edits and the state it leaves in."""
    auction = Auction(tile, list(exits), states)
    entry = [auction.converge(g) if g in states else INF for g in range(4)]
    traces = tuple(auction.trace(g) if entry[g] < INF else None for g in range(4))
    return tuple(None if p == INF else p for p in entry), traces


def _lowered(prices: tuple[int | None, ...]) -> tuple[tuple[int | None, ...], int]:
    """Prices less the least of them, and that one."""
    low = min((p for p in prices if p is not None), default=0)
    return tuple(None if p is None else p - low for p in prices), low


def entry_prices(symbols: str, exits: list[int | None], states: tuple[int, ...] = (0, 1, 2, 3)) -> list[int | None]:
    """Cost from each state before the turns to each exit's price behind them."""
    prices, total = _lowered(tuple(exits))
    for tile in reversed(_tiles(symbols)):
        prices, low = _lowered(_solved(tile, prices, states)[0])
        total += low
    return [None if p is None else p + total for p in prices]


def traced(symbols: str, exits: list[int | None]) -> list[tuple[str, int] | None]:
    """Edits and last state from each entry state, at least cost, first in ASCII order."""
    tiles = _tiles(symbols)
    prices, steps = _lowered(tuple(exits))[0], []
    for tile in reversed(tiles):
        entry, traces = _solved(tile, prices, (0, 1, 2, 3))
        steps.append(traces)
        prices = _lowered(entry)[0]
    out: list[tuple[str, int] | None] = []
    for state in range(4):
        edits: list[str] = []
        here: int | None = state
        for traces in reversed(steps):
            if traces[here] is None:
                here = None
                break
            part, here = traces[here]
            edits.append(part)
        out.append(None if here is None else ("".join(edits), here))
    return out


def matrix(symbols: str) -> list[list[int | None]]:
    """Least cost of the turns from each state (rows) to each state (columns)."""
    by_exit = [
        entry_prices(symbols, [0 if g == e else None for g in range(4)], FROM[e]) for e in range(4)
    ]
    return [[by_exit[e][g] if g in FROM[e] else None for e in range(4)] for g in range(4)]


# ---- turns of a conversation ----------------------------------------------------------------------------------------


def turn_key(role: str, text: str) -> bytes:
    return xxhash.xxh3_128_digest(f"{len(role)}:{role}{text}".encode())


def symbols_of(roles: list[str], texts: list[str], seen: set[bytes]) -> tuple[str, int, int, int]:
    """A symbol per turn, and how many are blank, duplicate, truncated. ``seen`` holds turns of earlier blocks."""
    out, counts = [], [0, 0, 0]
    for role, text in zip(roles, texts):
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        if not bare:
            counts[0] += 1
            out.append("x")
            continue
        key = turn_key(role, text)
        if key in seen:
            counts[1] += 1
            out.append("x")
            continue
        seen.add(key)
        initial = role[:1] if role[:1] in NEXT else "o"
        if bare[-1] not in ".!?":
            counts[2] += 1
            initial = initial.upper()
        out.append(initial)
    return "".join(out), *counts


def illegal_pairs(roles: list[str]) -> int:
    return sum(a[:1] + b[:1] not in LEGAL for a, b in zip(roles, roles[1:]))


def apply_edits(audit: str, roles: list[str], texts: list[str], state: int) -> tuple[list[str], list[str]]:
    """Roles and texts after the edits, from a state."""
    new_roles, new_texts, at = [], [], 0
    for edit in audit:
        if edit == "D":
            at += 1
            continue
        if edit == "K":
            role, text = roles[at], texts[at]
            initial = role[:1]
        else:
            initial = "a" if state == USER else "u"
            role, text = ROLES[initial], "" if edit == "I" else texts[at]
        at += edit != "I"
        state = NEXT[initial][state]
        new_roles.append(role)
        new_texts.append(text)
    return new_roles, new_texts


def _edges(turns: list[int | None]) -> tuple[int | None, int | None, int]:
    """First and last turn number and how many there are; ``turns`` are sorted, nulls first."""
    known = [t for t in turns if t is not None]
    return (known[0], known[-1], len(set(known))) if known else (None, None, 0)


# ---- the table ------------------------------------------------------------------------------------------------------

_RESULT = (
    "first_turn long, last_turn long, n_turns long, blank long, duplicate long, truncated long, illegal long, "
    "n_rows long, cost long, first_initial string, last_initial string, audit string, "
    "roles array<string>, texts array<string>"
)
_NAMES = [part.split()[0] for part in _RESULT.split(", ")]
_TYPES = [pa.int64()] * 9 + [pa.string()] * 3 + [pa.list_(pa.string())] * 2


def _blocks(turns: DataFrame, conv: str, turn: str) -> DataFrame:
    """Sorted turns as one row per block: ``conv``, ``part``, ``block``, ``whole``, ``turns``, ``roles``, ``texts``, ``keys``.

    A conversation inside one range and one block is ``whole``. ``keys`` are the
    different turns of other blocks. Rows of one turn are in order of a hash; a
    place of its own lets equal rows spread over several ranges.
    """
    n = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    gone = F.coalesce(F.col("gone"), F.lit(False)) if "gone" in turns.columns else F.lit(False)
    rows = turns.select(
        F.col(f"`{conv}`").alias("conv"),
        F.col(f"`{turn}`").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        gone.alias("gone"),
    ).withColumns({"_hash": F.xxhash64("role", "text"), "_place": F.monotonically_increasing_id()})
    order = ["conv", "turn", "_hash", "_place"]
    kind = turns.schema[conv].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        held = {"conv": None, "turns": [], "roles": [], "texts": [], "chars": 0, "block": 0, "first": True}
        conv_type = None
        out: list[tuple] = []
        size = 0

        def close(whole: bool) -> None:
            nonlocal size
            known: dict[bytes, None] = {}
            if not whole:
                for role, text in zip(held["roles"], held["texts"]):
                    if BLANK.search(text):
                        known.setdefault(turn_key(role, text))
            out.append((held["conv"], part, held["block"], whole, held["turns"], held["roles"], held["texts"], list(known)))
            size += held["chars"] + 1_000
            held.update(turns=[], roles=[], texts=[], chars=0, block=held["block"] + 1)

        def flush() -> pa.RecordBatch:
            nonlocal size
            size = 0
            cols = list(zip(*out))
            out.clear()
            types = [conv_type, pa.int32(), pa.int32(), pa.bool_(), pa.list_(pa.int64()), pa.list_(pa.string())]
            types += [pa.list_(pa.string()), pa.list_(pa.binary())]
            names = ["conv", "part", "block", "whole", "turns", "roles", "texts", "keys"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

        begun = False
        for batch in slices(batches, "text"):
            conv_type = batch.schema.field("conv").type
            names = ("conv", "turn", "role", "text", "gone")
            for c, t, role, text, lost in zip(*(batch.column(x).to_pylist() for x in names)):
                if begun and c != held["conv"]:
                    # the first conversation of a range may have begun in an earlier one
                    close(not held["first"] and held["block"] == 0)
                    held.update(block=0, first=False)
                elif begun and (len(held["roles"]) >= BLOCK_TURNS or held["chars"] >= BLOCK_CHARS):
                    close(False)
                begun = True
                held["conv"] = c
                if not lost:
                    held["turns"].append(t)
                    held["roles"].append(role)
                    held["texts"].append(text)
                    held["chars"] += len(text) + 40
                if size > 8 << 20:
                    yield flush()
        if begun:
            close(False)  # the last one may go on in a later range
            yield flush()

    ranged = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    return ranged.select("conv", "turn", "role", "text", "gone").mapInArrow(
        run,
        f"conv {kind}, part int, block int, whole boolean, turns array<long>, roles array<string>, "
        "texts array<string>, keys array<binary>",
    )


def _repaired(turns: list, roles: list, texts: list, seen: set, exits: list, state: int) -> tuple:
    symbols, blank, duplicate, truncated = symbols_of(roles, texts, seen)
    audit, _ = traced(symbols, exits)[state]
    cost = sum({"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}[e] for e in audit)
    cost += TRUNCATED * sum(s.isupper() and e != "D" for s, e in zip(symbols, audit.replace("I", "")))
    fixed = apply_edits(audit, roles, texts, state)
    found = (blank, duplicate, truncated, illegal_pairs(roles), len(roles), cost)
    ends = (roles[0][:1], roles[-1][:1]) if roles else (None, None)
    return (*_edges(turns), *found, *ends, audit, *fixed)


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repairs whole conversations."""
    for batch in batches:
        for at in range(0, batch.num_rows, 2_000):
            piece = batch.slice(at, 2_000)
            columns = [piece.column(c).to_pylist() for c in ("turns", "roles", "texts")]
            rows = [_repaired(t, r, x, set(), ENDS, START) for t, r, x in zip(*columns)]
            made = [pa.array(c, k) for c, k in zip(zip(*rows), _TYPES)]
            yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in ("conv", "part", "block")), *made], names=["conv", "part", "block", *_NAMES])


def _shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Symbols and cost matrix of each block."""
    for batch in batches:
        for at in range(batch.num_rows):
            piece = batch.slice(at, 1)
            roles, texts, late = (piece.column(c).to_pylist()[0] for c in ("roles", "texts", "late"))
            symbols = symbols_of(roles, texts, set(late or ()))[0]
            costs = [c for row in matrix(symbols) for c in row]
            made = [pa.array([symbols]), pa.array([costs], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in ("conv", "part", "block")), *made], names=["conv", "part", "block", "symbols", "costs"])


def _border_prices(table: pa.Table) -> pa.Table:
    """Exit prices of all blocks of one conversation, from the last to the first."""
    table = table.sort_by([("part", "ascending"), ("block", "ascending")])
    prices, out = list(ENDS), []
    for costs in reversed(table.column("costs").to_pylist()):
        out.append(prices)
        prices = [
            min((c + p for c, p in zip(costs[4 * g : 4 * g + 4], prices) if c is not None and p is not None), default=None)
            for g in range(4)
        ]
    out.reverse()
    return table.select(["conv", "part", "block"]).append_column("exits", pa.array(out, pa.list_(pa.int64())))


def _leaving(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state each block leaves in, for each state it may be entered in."""
    for batch in batches:
        made = []
        for symbols, exits in zip(batch.column("symbols").to_pylist(), batch.column("exits").to_pylist()):
            made.append([None if x is None else x[1] for x in traced(symbols, exits)])
        cols = [batch.column(c) for c in ("conv", "part", "block")]
        yield pa.RecordBatch.from_arrays([*cols, pa.array(made, pa.list_(pa.int32()))], names=["conv", "part", "block", "leaves"])


def _entered(table: pa.Table) -> pa.Table:
    """The state each block of one conversation is entered in."""
    table = table.sort_by([("part", "ascending"), ("block", "ascending")])
    state, out = START, []
    for leaves in table.column("leaves").to_pylist():
        out.append(state)
        state = leaves[state]
    return table.select(["conv", "part", "block"]).append_column("state", pa.array(out, pa.int32()))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repairs blocks of longer conversations."""
    for batch in batches:
        for at in range(batch.num_rows):
            piece = batch.slice(at, 1)
            names = ("turns", "roles", "texts", "late", "exits", "state")
            turns, roles, texts, late, exits, state = (piece.column(c).to_pylist()[0] for c in names)
            row = _repaired(turns, roles, texts, set(late or ()), exits, state)
            made = [pa.array([c], k) for c, k in zip(row, _TYPES)]
            yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in ("conv", "part", "block")), *made], names=["conv", "part", "block", *_NAMES])


def _join(left: DataFrame, right: DataFrame, names: list[str], how: str = "inner") -> DataFrame:
    """Join on columns that may be null; the right side gives its other columns."""
    renamed = right.select(*[F.col(c).alias(f"_r_{c}" if c in names else c) for c in right.columns])
    on = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in names]
    return left.join(renamed, functools.reduce(lambda x, y: x & y, on), how).drop(*[f"_r_{c}" for c in names])


def repair(turns: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Least-cost repair of every conversation of ``turns`` (``conv``, ``turn``, ``role``, ``text``, perhaps ``gone``).

    One row per block of a conversation: ``conv``, ``part``, ``block`` (blocks of
    a conversation in order of both; most conversations have one), ``whole``,
    what was found in it (``first_turn``, ``last_turn``, ``n_turns`` without
    nulls, ``blank``, ``duplicate``, ``truncated``, ``illegal`` neighbours,
    ``n_rows``, the initials of its first and last turn), ``cost``, ``audit``
    (initials of the edits), and the repaired ``roles`` and ``texts``.

    Turns are taken by turn number, nulls first, then by a hash of role and text.
    A null role or text counts as one blank; a role that begins with none of s, u
    and a, an empty one included, is never kept as it is. A null conversation is
    one of its own. Rows marked ``gone`` are left out, but their conversation is
    answered, with empty arrays if no turn is left. Repeated rows are duplicates
    of the first. An empty table gives an empty one; other columns of ``turns``
    are not read, whatever their names. The audit of a conversation is one string.
    """
    blocks = materialise(_blocks(turns, conv, turn), "blocks")
    kind = blocks.schema["conv"].dataType.simpleString()
    key = ["conv", "part", "block"]
    head = f"conv {kind}, part int, block int, "
    whole = blocks.where("whole")
    done = whole.mapInArrow(_whole, head + _RESULT).withColumn("whole", F.lit(True))

    cut = blocks.where("NOT whole")
    # turns that an earlier block of the same conversation holds too
    known = cut.select(*key, F.explode("keys").alias("key"))
    first = known.groupBy("conv", "key").agg(F.min(F.struct("part", "block")).alias("first"), F.count("key").alias("n"))
    again = _join(known, first.where("n > 1").drop("n"), ["conv", "key"]).where(F.struct("part", "block") > F.col("first"))
    late = again.groupBy(*key).agg(F.collect_list("key").alias("late"))
    marked = materialise(_join(cut.drop("keys", "whole"), late, key, "left"), "blocks")
    shapes = materialise(marked.mapInArrow(_shapes, head + "symbols string, costs array<long>"), "blocks")
    prices = shapes.select(*key, "costs").groupBy("conv").applyInArrow(_border_prices, head + "exits array<long>")
    priced = materialise(_join(shapes.drop("costs"), prices, key), "blocks")
    leaves = priced.mapInArrow(_leaving, head + "leaves array<int>")
    states = leaves.groupBy("conv").applyInArrow(_entered, head + "state int")
    ready = _join(marked, _join(priced.drop("symbols"), states, key), key)
    pieces = ready.mapInArrow(_pieces, head + _RESULT).withColumn("whole", F.lit(False))
    return done.unionByName(pieces)


def _sum_up(conv_type: pa.DataType):
    """Streams sorted blocks and closes a row per conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict | None = None
        out: list[tuple] = []

        def close() -> tuple:
            gaps = 0 if state["first"] is None else state["last"] - state["first"] + 1 - state["n"]
            return (state["conv"], gaps, *state["counts"], "".join(state["audit"]), state["sha"].hexdigest())

        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                if state is None or state["conv"] != row["conv"]:
                    if state is not None:
                        out.append(close())
                    state = dict(conv=row["conv"], first=None, last=None, n=0, counts=[0] * 5, audit=[])
                    state.update(sha=hashlib.sha256(), begun=False, initial=None)
                if row["first_turn"] is not None:
                    state["n"] += row["n_turns"] - (state["last"] == row["first_turn"])
                    state["first"] = row["first_turn"] if state["first"] is None else state["first"]
                    state["last"] = row["last_turn"]
                for k, name in enumerate(("blank", "duplicate", "truncated", "illegal", "cost")):
                    state["counts"][k] += row[name]
                if row["n_rows"]:
                    border = (state["initial"], row["first_initial"])
                    state["counts"][3] += state["initial"] is not None and "".join(border) not in LEGAL
                    state["initial"] = row["last_initial"]
                state["audit"].append(row["audit"])
                if row["repaired"] is not None:
                    state["sha"].update((("\n" if state["begun"] else "") + row["repaired"]).encode())
                    state["begun"] = True
            if len(out) > 5_000:
                yield _digest_rows(out, conv_type)
                out = []
        if state is not None:
            out.append(close())
        if out:
            yield _digest_rows(out, conv_type)

    return run


def _digest_rows(out: list[tuple], conv_type: pa.DataType) -> pa.RecordBatch:
    kinds = [conv_type] + [pa.int64()] * 6 + [pa.string()] * 2
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["conv", *DIGEST])


def digest(repaired: DataFrame) -> DataFrame:
    """One row per conversation of ``repair``: ``conv`` and the columns of ``DIGEST``.

    Whole conversations are summed up where they are, in columns; blocks of
    others are read in order, one at a time, as one checksum needs them.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    lines = F.array_join(F.zip_with("roles", "texts", lambda r, t: F.concat(r, F.lit(":"), t)), "\n")
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("n_turns"), F.lit(0)).cast("long")
    counts = ["blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    whole = repaired.where("whole").select("conv", gaps.alias("gaps"), *counts, F.sha2(lines, 256).alias("repaired_sha256"))
    parts = repaired.where("NOT whole").select(
        "conv", "part", "block", "first_turn", "last_turn", "n_turns", *counts,
        "first_initial", "last_initial", "n_rows",
        F.when(F.size("roles") > 0, lines).alias("repaired"),
    )
    kind = repaired.schema["conv"].dataType
    ordered = parts.repartition("conv").sortWithinPartitions("conv", "part", "block")
    schema = f"conv {kind.simpleString()}, " + ", ".join(f"{c} long" for c in DIGEST[:6]) + ", audit string, repaired_sha256 string"
    return whole.unionByName(ordered.mapInArrow(_sum_up(to_arrow_type(kind)), schema))
