"""Best-fit packing of tokenized documents by bin completion.

Tokens: a text is cut into chunks that tokenize independently, every distinct
chunk of a slice is encoded once, and the ids of the texts are gathered by
index. Packing: pieces are dealt at random into cells of bounded size; a task
packs one cell.
"""

from __future__ import annotations

import base64
import bisect
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.arrow import slices, spread, texts_of
from quire.llm.clashes import without
from quire.scratch import materialise

LIMIT = 2048
END_ID = 0
CELL_PIECES = 20_000
# Bytes of text encoded together; more of them share more chunks.
TOKEN_SLICE = 16 << 20
# Search steps a cell may take beyond its first best-fit packing.
SEARCH_STEPS = 20_000
# Bins whose untried fillings are held; those of earlier bins are made again when the search comes back.
OPEN_LEVELS = 64


def load_encoder(path: str, pattern: str):
    """Byte-level BPE encoder of a rank file: base64 bytes, a blank, the id."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def chunk_starts(data: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Byte places where independent chunks begin, text starts included.

    The pattern of byte-level BPE never joins a non-space character with white
    space after it. A chunk therefore begins at ASCII white space that follows
    a character that is surely no white space: an ASCII one, or a two-byte one
    from U+00C0 on. Longer characters give no boundary, which only makes a
    chunk longer.
    """
    space = (data == 32) | ((data >= 9) & (data <= 13))
    before = np.zeros(len(data), bool)
    plain = (data < 128) & (data > 32) & (data != 127)
    before[1:] = plain[:-1]
    before[2:] |= (data[1:-1] >= 128) & (data[1:-1] < 192) & (data[:-2] >= 0xC3) & (data[:-2] <= 0xDF)
    space &= before
    space[begins] = True
    return np.flatnonzero(space)


class BatchEncoder:
    """Token ids of many texts; each distinct chunk is encoded once a call."""

    def __init__(self, path: str, pattern: str) -> None:
        self.encoder = load_encoder(path, pattern)
        sizes = [0] * (self.encoder.max_token_value + 1)
        for i in range(len(sizes)):
            try:
                sizes[i] = len(self.encoder.decode_single_token_bytes(i))
            except KeyError:
                pass
        self.sizes = np.array(sizes, np.int64)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Offsets per text and all ids."""
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[: len(texts) + 1]
        base, end = int(offsets[0]), int(offsets[-1])
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[base:end] if raw is not None and end > base else np.zeros(0, np.uint8)
        begins = offsets - base
        full = begins[:-1][begins[:-1] < begins[1:]]
        if not len(full):
            return np.zeros(len(texts) + 1, np.int64), np.zeros(0, np.uint32)
        starts = chunk_starts(data, full)
        marks = np.append(starts, len(data)).astype(np.int64)
        chunks = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(marks), pa.py_buffer(np.ascontiguousarray(data))]
        ).dictionary_encode()
        which = chunks.indices.to_numpy().astype(np.int64)
        ids_of, first, size = self._distinct(chunks.dictionary)
        ends, ids = spread(which, first, size, ids_of)
        owner = np.searchsorted(starts, begins)
        return np.concatenate([[0], ends])[owner], ids

    def _distinct(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all distinct chunks, where each chunk's ids begin and how many they are.

        Chunks that begin, but do not end, in white space are encoded in one
        call, as one text; each of the few others by itself.
        """
        alone = _stands_alone(words)
        joined = words.filter(pa.array(~alone))
        parts = [np.array(self.encoder.encode_ordinary(b"".join(joined.to_pylist()).decode("utf-8")), np.uint32)]
        done = np.concatenate([[0], np.cumsum(self.sizes[parts[0]])])
        width = pc.binary_length(joined).to_numpy(zero_copy_only=False).astype(np.int64)
        cut = np.searchsorted(done, np.concatenate([[0], np.cumsum(width)]))
        first, size = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        first[~alone], size[~alone] = cut[:-1], np.diff(cut)
        at = len(parts[0])
        for k, word in zip(np.flatnonzero(alone).tolist(), words.filter(pa.array(alone)).to_pylist()):
            parts.append(np.array(self.encoder.encode_ordinary(word.decode("utf-8")), np.uint32))
            first[k], size[k] = at, len(parts[-1])
            at += len(parts[-1])
        return np.concatenate(parts), first, size


def _stands_alone(chunks: pa.Array) -> np.ndarray:
    """Chunks that could run into a neighbour: no ASCII white space first, or perhaps white space last."""
    offsets = np.frombuffer(chunks.buffers()[1], np.int64)[: len(chunks) + 1]
    data = np.frombuffer(chunks.buffers()[2], np.uint8)
    head, tail = data[offsets[:-1]], data[offsets[1:] - 1]
    spaced = (head == 32) | ((head >= 9) & (head <= 13))
    wide = tail >= 128
    second = np.where(wide, data[np.maximum(offsets[1:] - 2, 0)], 0)
    latin = wide & (second >= 0xC3) & (second <= 0xDF)
    return ~spaced | (tail < 33) | (wide & ~latin)


def cut_pieces(n: int, limit: int) -> list[tuple[int, int]]:
    """(start, length) of a document of ``n`` tokens; only the first piece may be short."""
    first = n % limit or min(n, limit)
    return [(0, first)] + [(s, limit) for s in range(first, n, limit)]


def tokenize(
    docs: DataFrame, path: str, pattern: str, limit: int = LIMIT, end_id: int = END_ID, ids: bool = False
) -> DataFrame:
    """One row per piece: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32`` and, if asked, ``ids``.

    A null text is an empty one; every document ends in ``end_id`` and so has
    at least one piece. Rows repeat if documents do.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = BatchEncoder(path, pattern)
        for batch in slices(batches, "text", TOKEN_SLICE):
            offsets, flat = encode(texts_of(batch, "text"))
            flat = flat.astype("<u4")
            rows: list[tuple] = []
            for doc, a, b in zip(batch.column("doc_id").to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist()):
                own = np.append(flat[a:b], np.uint32(end_id)).astype("<u4")
                for k, (s, n) in enumerate(cut_pieces(len(own), limit)):
                    part = own[s : s + n].tobytes()
                    rows.append((doc, k, s, n, zlib.crc32(part)) + ((part,) if ids else ()))
            cols = list(zip(*rows))
            out = {"doc_id": pa.array(cols[0], batch.schema.field("doc_id").type), "piece": pa.array(cols[1], pa.int32())}
            out |= {k: pa.array(c, pa.int64()) for k, c in zip(("start", "length", "ids_crc32"), cols[2:])}
            if ids:
                out["ids"] = pa.array([np.frombuffer(p, "<u4").astype(np.int32) for p in cols[5]], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(out)

    kind = docs.schema["doc_id"].dataType.simpleString()
    more = ", ids array<int>" if ids else ""
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long{more}"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def best_fit(counts: dict[int, int], limit: int) -> list[list[int]]:
    """Best-fit decreasing: each length goes to the fullest bin that takes it."""
    free: dict[int, list[int]] = {}
    rooms: list[int] = []
    bins: list[list[int]] = []
    for size in sorted(counts, reverse=True):
        for _ in range(counts[size]):
            at = bisect.bisect_left(rooms, size)
            if at < len(rooms):
                room = rooms[at]
                k = free[room].pop()
                if not free[room]:
                    rooms.pop(at)
            else:
                room, k = limit, len(bins)
                bins.append([])
            bins[k].append(size)
            if left := room - size:
                if not free.setdefault(left, []):
                    bisect.insort(rooms, left)
                free[left].append(k)
    return bins


def _sums(counts: dict[int, int], sizes: list[int], room: int) -> list[int]:
    """Bits of the sums up to ``room`` that the first 0, 1, 2, ... of ``sizes`` (ascending) can make."""
    mask, out = (1 << (room + 1)) - 1, [1]
    for size in sizes:
        if size > room:
            break
        bits, n, step = out[-1], min(counts[size], room // size), 1
        while n:
            step = min(step, n)
            bits |= bits << (size * step) & mask
            n -= step
            step *= 2
        out.append(bits)
    return out


def _below(bits: int, width: int) -> int:
    """Bits t for which a set bit lies in t .. t + width."""
    done = 0
    while done < width:
        step = min(done + 1, width - done)
        bits |= bits >> step
        done += step
    return bits


def fillings(
    counts: dict[int, int], sizes: list[int], room: int, most_waste: int, steps: list[int]
) -> Iterator[tuple[int, ...]]:
    """Every undominated filling of ``room`` that wastes at most ``most_waste``, least waste first.

    ``sizes``: the lengths left, ascending. A filling is dominated if a piece
    left out fits into its waste, or into the place of some of its pieces and
    its waste, unless it is as long as a single one. Pieces are chosen longest
    first, so what was chosen longer than the last one stays as it is, and a
    part that is dominated ends its branch. Every such end takes one of ``steps``.
    """
    if counts.get(room):
        yield (room,)
        return
    if not sizes or sizes[0] > room:
        if room <= most_waste:
            yield ()
        return
    reach = _sums(counts, sizes, room)
    whole = sum(1 << s for s in sizes[: len(reach) - 1])

    def extend(top: int, rest: int, others: int, sums: int, waste: int) -> Iterator[tuple[int, ...]]:
        if not rest:
            if not others & ((1 << (waste + 1)) - 1):
                yield ()
            return
        for k in range(min(top, bisect.bisect_right(sizes, rest, 0, top)) - 1, -1, -1):
            if not reach[k + 1] >> rest & 1:
                return
            size = sizes[k]
            for n in range(min(counts[size], rest // size), 0, -1):
                if not reach[k] >> (rest - n * size) & 1:
                    continue
                if steps[0] <= 0:
                    return
                spare = others & ~(1 << size) if n == counts[size] else others
                near = _below(spare, waste)
                dominated = waste and _below(spare >> 1, waste - 1) >> size & 1
                made = sums
                for _ in range(n):
                    more = made << size
                    if dominated or more & near:
                        dominated = True
                        break
                    made |= more | 1 << size
                if dominated:
                    steps[0] -= 1
                    continue
                for tail in extend(k, rest - n * size, spare, made, waste):
                    yield (size,) * n + tail

    for waste in range(min(room, most_waste) + 1):
        if reach[-1] >> (room - waste) & 1:
            yield from extend(len(reach) - 1, room - waste, whole, 0, waste)


def search_bins(lengths: list[int], limit: int, steps: int = SEARCH_STEPS) -> tuple[list[list[int]], str]:
    """Bins of ``bin_completion`` and what ended the search: ``bound``, ``searched`` (all of it) or ``steps``."""
    counts: dict[int, int] = {}
    for n in lengths:
        counts[n] = counts.get(n, 0) + 1
    empty = [0] * counts.pop(0, 0)
    total = sum(lengths)
    bound = -(-total // limit)
    best = best_fit(counts, limit)
    left, sizes, left_steps = dict(counts), sorted(counts), [steps]
    spare, waste = (len(best) - 1) * limit - total, 0
    # Largest piece, fillings taken so far, those to come, the filling that stands
    levels: list[list] = []

    def take(n: int) -> None:
        left[n] -= 1
        if not left[n]:
            sizes.pop(bisect.bisect_left(sizes, n))

    def put(n: int) -> None:
        if not left[n]:
            bisect.insort(sizes, n)
        left[n] += 1

    down, ended = True, "bound"
    while len(best) > bound:
        if down and not sizes:
            best = [[level[0], *level[3]] for level in levels]
            spare, down = (len(best) - 1) * limit - total, False
            continue
        if left_steps[0] <= 0:
            ended = "steps"
            break
        left_steps[0] -= 1
        if down:
            levels.append([sizes[-1], 0, None, None])
            take(sizes[-1])
            if len(levels) > OPEN_LEVELS:
                levels[-OPEN_LEVELS - 1][2] = None
        elif not levels:
            ended = "searched"
            break
        level = levels[-1]
        first, taken, options, pick = level
        if pick is not None:
            waste -= limit - first - sum(pick)
            for n in pick:
                put(n)
        if options is None:
            # closed above to bound memory: the same fillings come again in the same order
            options = islice(fillings(left, sizes, limit - first, spare - waste, left_steps), taken, None)
        pick = next(options, None)
        down = pick is not None and waste + limit - first - sum(pick) <= spare
        if down:
            waste += limit - first - sum(pick)
            for n in pick:
                take(n)
            level[1:] = [taken + 1, options, pick]
        else:
            put(first)
            levels.pop()
    if empty:
        best = [best[0] + empty, *best[1:]] if best else [empty]
    return best, ended


def bin_completion(lengths: list[int], limit: int, steps: int = SEARCH_STEPS) -> list[list[int]]:
    """Bins of at most ``limit``, as few as the search finds.

    Depth-first branch and bound on whole bins: a bin is the longest piece left
    with one of the undominated fillings around it, each of which is tried in
    turn. A branch ends where the waste summed so far passes what a packing of
    one bin fewer than the incumbent may waste; the search then goes back to
    the last bin with a filling left. The best-fit packing is the first
    incumbent, and one that meets the bound ceil(total / limit) ends the
    search. After ``steps`` bins and dominated fillings the incumbent stands.
    """
    return search_bins(lengths, limit, steps)[0]


def pack(pieces: DataFrame, limit: int = LIMIT, cell_pieces: int = CELL_PIECES, steps: int = SEARCH_STEPS) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces with a ``length`` of at most ``limit``.

    Full pieces are sequences of their own. The others are numbered, written to
    the scratch folder, dealt into cells of about ``cell_pieces`` by a hash of
    that number, and each cell is packed by one task; a cell leaves at most a
    few partly filled sequences, so more cells cost next to nothing. Rows of
    any value, repeated ones too, stay separate pieces. An empty table gives an
    empty one. Columns named like the two that are added are replaced.
    """
    pieces = without(pieces, "sequence_id", "offset")
    names = pieces.columns
    frozen = materialise(pieces.withColumn("_uid", F.monotonically_increasing_id()), "pieces")
    # The size of a cell is bounded, not the number of cells
    small = frozen.where(F.col("length") < limit)
    cells = max(1, -(-small.count() // cell_pieces))
    whole = frozen.where(F.col("length") >= limit).select(
        *names, (-1 - F.col("_uid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )

    def run(table: pa.Table) -> pa.Table:
        cell = table.column("_cell")[0].as_py()
        size = table.column("length").to_numpy()
        order = np.argsort(-size, kind="stable")
        queue: dict[int, list[int]] = {}
        for row in order[::-1].tolist():
            queue.setdefault(int(size[row]), []).append(row)
        sequence, offset = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
        for k, made in enumerate(bin_completion(size.tolist(), limit, steps)):
            at = 0
            for n in made:
                row = queue[n].pop()
                sequence[row], offset[row], at = (cell << 32) + k, at, at + n
        out = table.select(names)
        return out.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    dealt = small.withColumn("_cell", F.pmod(F.xxhash64("_uid"), F.lit(cells)))
    packed = dealt.groupBy("_cell").applyInArrow(run, schema + ", sequence_id long, offset long")
    return whole.unionByName(packed)
