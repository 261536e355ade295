"""Lines that many documents share, and what each document keeps without them.

Line hashes are range-partitioned and sorted by document and position, so one
pass over a sorted run knows its first occurrences and its number of documents.
The results that travel are positions and compressed bitmaps, not texts.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.arrow import slices, texts_of
from quire.llm.clashes import without
from quire.scratch import broadcast_if_small, materialise

SPACE = " \t\n\x0b\x0c\r"
_LINE = "h1 long, h2 long, doc long, pos int"


def line_keys(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Offsets per text and the keys of all its lines: stripped, A-Z in lower case."""
    lists = pc.split_pattern(texts, "\n")
    return lists.offsets.to_numpy().astype(np.int64), pc.ascii_lower(pc.utf8_trim(lists.values, SPACE))


def document_hash(key: list[str]) -> Column:
    """What rows with equal results share: key columns and text."""
    return F.xxhash64(*key, F.coalesce("text", F.lit("")))


def line_rows(docs: DataFrame, key: list[str], min_chars: int) -> DataFrame:
    """One row per line with a key of ``min_chars`` code points: 128-bit hash, document, position."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = texts_of(batch, "text")
            offsets, keys = line_keys(texts)
            owner = np.repeat(np.arange(len(texts)), np.diff(offsets))
            pos = np.arange(len(keys)) - offsets[owner]
            long = pc.greater_equal(pc.utf8_length(keys), min_chars).to_numpy(zero_copy_only=False)
            wide = [xxhash.xxh3_128_digest(k) for k in keys.filter(pa.array(long)).to_pylist()]
            pair = np.frombuffer(b"".join(wide), np.int64).reshape(-1, 2)
            ids = batch.column("doc").to_numpy()
            yield pa.RecordBatch.from_pydict(
                {
                    "h1": pa.array(pair[:, 0]),
                    "h2": pa.array(pair[:, 1]),
                    "doc": pa.array(ids[owner[long]]),
                    "pos": pa.array(pos[long].astype(np.int32)),
                }
            )

    return docs.select(document_hash(key).alias("doc"), "text").mapInArrow(run, _LINE)


def _stream(min_docs: int, keep_first: bool):
    """Streams the sorted rows of one partition; emits the positions to drop.

    A run (rows of one hash) inside the partition is decided here: rows are
    held back only until ``min_docs`` documents are seen. The first and the last
    run may go on in the next partition. Their rows are all emitted, undecided,
    with the run's number of documents here.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = {"hash": None, "docs": 0, "doc": None, "at": None, "began": None, "held": [], "first": True}
        out: list[tuple] = []

        def close(last: bool) -> None:
            if state["hash"] is None:
                return
            if state["first"] or last:
                passed = int(keep_first and not state["first"] and state["docs"] >= min_docs)
                out.append((*state["hash"], None, state["docs"], passed))
                out.extend((*state["hash"], d, None, p) for d, p in state["held"])
            state["first"] = False

        for batch in batches:
            cols = [batch.column(c).to_numpy() for c in ("h1", "h2", "doc", "pos")]
            n = batch.num_rows
            if not n:
                continue
            new = np.ones(n, bool)
            new[1:] = (cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1])
            edges = np.append(np.flatnonzero(new), n)
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                at = (int(cols[0][a]), int(cols[1][a]))
                if at != state["hash"]:
                    close(False)
                    state.update(hash=at, docs=0, doc=None, held=[], began=(int(cols[2][a]), int(cols[3][a])))
                docs, pos = cols[2][a:b], cols[3][a:b]
                # a document's rows with its first position here: one per row of the table with that id and text
                begins = np.append(True, docs[1:] != docs[:-1])
                first = pos[np.maximum.accumulate(np.where(begins, np.arange(len(docs)), 0))]
                if state["doc"] == int(docs[0]):
                    first[: int(np.argmin(docs == docs[0])) or len(docs)] = state["at"]
                state["docs"] += int(np.count_nonzero(pos == first))
                state.update(doc=int(docs[-1]), at=int(first[-1]))
                state["held"].extend(zip(docs.tolist(), pos.tolist()))
                if not state["first"] and state["docs"] >= min_docs:
                    out.extend((*at, d, -1, p) for d, p in state["held"] if not (keep_first and (d, p) == state["began"]))
                    state.update(held=[])
                elif state["first"] and len(state["held"]) > 20_000:
                    out.extend((*at, d, None, p) for d, p in state["held"])
                    state["held"] = []
                if len(out) > 20_000:
                    yield _rows(out)
                    out = []
        close(True)
        if out:
            yield _rows(out)

    return run


def _rows(out: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*out))
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32())
    return pa.RecordBatch.from_pydict(
        {n: pa.array(c, k) for n, c, k in zip(("h1", "h2", "doc", "docs", "pos"), cols, kinds)}
    )


def shared_lines(lines: DataFrame, min_docs: int, keep_first: bool = False) -> DataFrame:
    """``doc``, ``pos`` of every line whose hash occurs in at least ``min_docs`` documents.

    With ``keep_first`` a hash's first occurrence, by document and position, is left out.
    """
    n = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # by hash and document: a line that a third of all rows hold is spread over many partitions
    spread = lines.repartitionByRange(n, "h1", "h2", "doc").sortWithinPartitions("h1", "h2", "doc", "pos")
    seen = materialise(
        spread.mapInArrow(_stream(min_docs, keep_first), "h1 long, h2 long, doc long, docs long, pos int"), "lines"
    )
    sure = seen.where(F.col("docs") == -1).select("doc", "pos")
    # runs at the edges of partitions: at most two hashes a partition, so a small table
    open_rows = seen.where("doc IS NOT NULL AND docs IS NULL")
    wide = (
        seen.where("doc IS NULL")
        .groupBy("h1", "h2")
        .agg(F.sum("docs").alias("n"), F.max("pos").alias("passed"))
        .where(F.col("n") >= min_docs)
        .select("h1", "h2", "passed")
    )
    edge = open_rows.join(broadcast_if_small(wide), ["h1", "h2"])
    if keep_first:
        firsts = edge.groupBy("h1", "h2").agg(F.min(F.struct("doc", "pos")).alias("first"))
        edge = edge.join(broadcast_if_small(firsts), ["h1", "h2"]).where("passed = 1 OR struct(doc, pos) <> first")
    return sure.union(edge.select("doc", "pos"))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One bitmap per document of rows sorted by document and position."""
    doc, held, out = None, [], []

    def close() -> tuple[int, bytes]:
        pos = np.unique(np.concatenate(held))
        bits = np.zeros(int(pos[-1]) + 1, bool)
        bits[pos] = True
        return doc, zlib.compress(np.packbits(bits).tobytes(), 1)

    def rows() -> pa.RecordBatch:
        docs, maps = zip(*out)
        return pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(maps, pa.binary())], ["doc", "drop_bitmap"])

    for batch in batches:
        docs, pos = batch.column("doc").to_numpy(), batch.column("pos").to_numpy()
        edges = np.concatenate([[0], np.flatnonzero(docs[1:] != docs[:-1]) + 1, [len(docs)]]) if len(docs) else [0]
        for a, b in zip(edges[:-1], edges[1:]):
            if held and doc != int(docs[a]):
                out.append(close())
                held = []
            doc = int(docs[a])
            held.append(pos[a:b])
        if len(out) > 4_000:
            yield rows()
            out = []
    if held:
        out.append(close())
    if out:
        yield rows()


def bitmaps(dropped: DataFrame) -> DataFrame:
    """``doc``, ``drop_bitmap``: deflated bit per line, up to the last dropped one.

    Positions are dealt by document and sorted; a task streams them.
    """
    n = int(dropped.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = dropped.select("doc", "pos").repartition(n, "doc").sortWithinPartitions("doc", "pos")
    return dealt.mapInArrow(_packed, "doc long, drop_bitmap binary")


def drop_shared_lines(
    docs: DataFrame,
    min_docs: int = 10,
    min_chars: int = 1,
    key: tuple[str, ...] = ("doc_id",),
    keep_first: bool = False,
) -> DataFrame:
    """All columns of ``docs`` plus ``kept_text``, ``n_lines``, ``n_dropped``, ``drop_bitmap``.

    A line's key is the line without ASCII white space at its ends, with A-Z in
    lower case. Keys of at least ``min_chars`` code points that occur in
    ``min_docs`` documents lose all their lines everywhere (``keep_first``: all
    but the first); the other lines are joined by a newline. Every row counts as a document,
    repeated ones and those without an id too; rows with the same ``key`` and
    text get the same result (``keep_first``: all of them keep a line that they
    hold first). A null text
    counts as one empty line, a null id is a value like any other, an empty
    table gives an empty one. Other columns pass through, but for those named
    like a result, which it replaces.
    """
    docs = without(docs, "kept_text", "n_lines", "n_dropped", "drop_bitmap")
    names = list(key)
    wanted = bitmaps(shared_lines(line_rows(docs, names, min_chars), min_docs, keep_first))
    columns = docs.columns
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            kept, total, gone = [], [], []
            maps = batch.column("drop_bitmap")
            for text, bitmap in zip(texts_of(batch, "text").to_pylist(), maps.to_pylist()):
                lines = text.split("\n")
                total.append(len(lines))
                if bitmap is None:
                    gone.append(0)
                    kept.append(text)
                    continue
                bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8))
                drop = set(np.flatnonzero(bits).tolist())
                left = [line for i, line in enumerate(lines) if i not in drop]
                gone.append(len(lines) - len(left))
                kept.append("\n".join(left))
            arrays = [batch.column(c) for c in columns]
            arrays += [pa.array(kept, pa.string()), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), maps]
            yield pa.RecordBatch.from_arrays(arrays, names=[*columns, "kept_text", "n_lines", "n_dropped", "drop_bitmap"])

    named = docs.withColumn("_line_doc", document_hash(names))
    joined = named.join(wanted.hint("merge"), named["_line_doc"] == wanted["doc"], "left").select(
        *[named[f"`{c}`"] for c in columns], "drop_bitmap"
    )
    return joined.mapInArrow(apply, kinds + ", kept_text string, n_lines long, n_dropped long, drop_bitmap binary")


def sha256_hex(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
