"""SentencePiece encoding and decoding with a unigram lattice.

An Aho-Corasick automaton over the pieces gives, at each character, all pieces
that end there, longest first along its output links; one pass relaxes the best
score of every position. Texts are cut at blanks, where no piece can cross, and
each distinct chunk of a slice is searched once.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from quire.llm.arrow import slices, spread, texts_of
from quire.llm.clashes import without

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
CACHED_CHUNKS = 400_000
DECODED_ROWS = 512
DECODED_IDS = 1 << 20
# Piece types of the model format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        b = data[at]
        value |= (b & 127) << shift
        at += 1
        if b < 128:
            return value, at
        shift += 7


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protocol buffer message; 4- and 8-byte values stay bytes."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        number, kind = key >> 3, key & 7
        if kind == 0:
            value, at = _varint(data, at)
        else:
            size = {1: 8, 5: 4}.get(kind)
            if size is None:
                size, at = _varint(data, at)
            value, at = data[at : at + size], at + size
        yield number, value


@dataclass(frozen=True)
class Vocabulary:
    pieces: list[str]
    scores: list[float]
    types: list[int]
    dummy_prefix: bool
    trim_spaces: bool
    byte_fallback: bool

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, "rb") as f:
            return cls.parse(f.read())

    @classmethod
    def parse(cls, data: bytes) -> Vocabulary:
        pieces, scores, types = [], [], []
        normalizer: dict = {}
        trainer: dict = {}
        for number, value in fields(data):
            if number == 1:
                own = dict(fields(value))
                pieces.append(own.get(1, b"").decode())
                scores.append(float(np.frombuffer(own.get(2, bytes(4)), "<f4")[0]))
                types.append(own.get(3, NORMAL))
            elif number == 2:
                trainer = dict(fields(value))
            elif number == 3:
                normalizer = dict(fields(value))
        if normalizer.get(2):
            raise ValueError("models with a character map are not supported")
        return cls(
            pieces, scores, types, bool(normalizer.get(3, 1)), bool(normalizer.get(4, 1)), bool(trainer.get(35, 0))
        )


class Lattice:
    """Best segmentation of one chunk."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        v = vocabulary
        self.vocabulary = v
        plain = [k for k, t in enumerate(v.types) if t in (NORMAL, USER_DEFINED) and v.pieces[k]]
        normal = [v.scores[k] for k in plain if v.types[k] == NORMAL]
        self.unknown_score = min(normal, default=0.0) - UNKNOWN_PENALTY
        top = max(normal, default=0.0)
        self.unknown = next((k for k, t in enumerate(v.types) if t == UNKNOWN), 0)
        self.bytes = {v.pieces[k]: k for k, t in enumerate(v.types) if t == BYTE}
        self.automaton = ahocorasick.Automaton()
        for k in plain:
            n = len(v.pieces[k])
            score = v.scores[k] if v.types[k] == NORMAL else n * top - 0.1
            self.automaton.add_word(v.pieces[k], (k, n, score))
        self.automaton.make_automaton()
        # a chunk may end before a blank only if no piece has a blank behind another character
        known = {v.pieces[k] for k in plain}
        self.singles = frozenset(p for p in known if len(p) == 1)
        crossing = any(SPACE in p.lstrip(SPACE) for p in known)
        self.splits = not crossing and (SPACE in known or v.byte_fallback)

    def best(self, chunk: str) -> tuple[list[int], float]:
        """Ids and score of the best path; of equal ones that with the longer last pieces."""
        if self.singles.issuperset(chunk):
            return self._covered(chunk)
        n = len(chunk)
        score: list[float | None] = [0.0] + [None] * n
        piece, start = [-1] * (n + 1), [0] * (n + 1)
        done, single = 0, False
        unknown = self.unknown_score

        def skip(upto: int) -> None:
            """Closes the positions up to ``upto``: a character of no piece is unknown."""
            nonlocal done, single
            while done < upto:
                if not single:
                    value = score[done] + unknown
                    if score[done + 1] is None or value > score[done + 1]:
                        score[done + 1], piece[done + 1], start[done + 1] = value, -1, done
                done, single = done + 1, False

        for end, (k, size, own) in self.automaton.iter(chunk):
            skip(end)
            begin = end + 1 - size
            if size == 1:
                single = True
            value = score[begin] + own
            if score[end + 1] is None or value > score[end + 1]:
                score[end + 1], piece[end + 1], start[end + 1] = value, k, begin
        skip(n)
        path, at = [], n
        while at:
            path.append((piece[at], start[at], at))
            at = start[at]
        return self._ids(chunk, path[::-1]), float(score[n])

    def _covered(self, chunk: str) -> tuple[list[int], float]:
        """The same where every character is a piece, so that every position is reached."""
        n = len(chunk)
        score = [0.0] + [-np.inf] * n
        piece, start = [0] * (n + 1), [0] * (n + 1)
        for end, (k, size, own) in self.automaton.iter(chunk):
            end += 1
            value = score[end - size] + own
            if value > score[end]:
                score[end], piece[end], start[end] = value, k, end - size
        ids, at = [], n
        while at:
            ids.append(piece[at])
            at = start[at]
        return ids[::-1], score[n]

    def _ids(self, chunk: str, path: list[tuple[int, int, int]]) -> list[int]:
        ids: list[int] = []
        after_unknown = False
        for k, a, b in path:
            if k >= 0:
                ids.append(k)
            elif self.vocabulary.byte_fallback:
                ids += [self.bytes[f"<0x{x:02X}>"] for x in chunk[a:b].encode()]
            elif not after_unknown:
                ids.append(self.unknown)
            after_unknown = k < 0
        return ids


class PieceEncoder:
    """Ids of many texts, and texts of ids."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self._forget()
        space = SPACE.encode()
        self.table = []
        for piece, kind in zip(vocabulary.pieces, vocabulary.types):
            if kind == BYTE:
                self.table.append(bytes([int(piece[3:5], 16)]))
            elif kind == CONTROL:
                self.table.append(b"")
            elif kind == UNKNOWN:
                self.table.append(" ⁇ ".encode())
            else:
                self.table.append(piece.encode().replace(space, b" "))

        self.sizes = np.fromiter(map(len, self.table), np.int64, len(self.table))
        self.firsts = np.cumsum(self.sizes) - self.sizes
        self.raw = np.frombuffer(b"".join(self.table), np.uint8)

    @cached_property
    def lattice(self) -> Lattice:
        """Made when first asked for: decoding needs none."""
        return Lattice(self.vocabulary)

    def _forget(self) -> None:
        """Chunks met so far by number; their ids lie one after another, so that a chunk costs few bytes."""
        self.known: dict[bytes, int] = {}
        self.ids, self.ends, self.scores = array("i"), array("q", [0]), array("d")

    def _numbers(self, chunks: list[bytes]) -> np.ndarray:
        """Numbers of distinct chunks; new ones are searched."""
        if len(self.known) > CACHED_CHUNKS:
            self._forget()
        known, out = self.known, []
        for chunk in chunks:
            number = known.get(chunk)
            if number is None:
                number = known[chunk] = len(known)
                ids, score = self.lattice.best(chunk.decode().replace(" ", SPACE))
                self.ids.extend(ids)
                self.ends.append(len(self.ids))
                self.scores.append(score)
            out.append(number)
        return np.array(out, np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Offsets per text, all ids, and the score of each text."""
        if self.vocabulary.trim_spaces:
            texts = pc.utf8_trim(pc.replace_substring_regex(texts, " +", " "), " ")
        empty = pc.equal(pc.binary_length(texts), 0)
        if self.vocabulary.dummy_prefix:
            texts = pc.if_else(empty, texts, pc.binary_join_element_wise(pa.scalar("", texts.type), texts, pa.scalar(" ", texts.type)))
        texts = pa.concat_arrays([texts.cast(pa.large_string())])
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[: len(texts) + 1]
        if offsets[-1] == offsets[0]:
            return np.zeros(len(texts) + 1, np.int64), np.zeros(0, np.int32), np.zeros(len(texts))
        data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
        begins = offsets - offsets[0]
        cut = np.zeros(len(data), bool)
        if self.lattice.splits:
            cut[1:] = (data[1:] == 32) & (data[:-1] != 32)
            # the mark for a blank may itself stand in a text
            cut[3:] &= ~((data[2:-1] == 0x81) & (data[1:-2] == 0x96) & (data[:-3] == 0xE2))
        cut[begins[:-1][begins[:-1] < begins[1:]]] = True
        starts = np.flatnonzero(cut)
        marks = np.append(starts, len(data)).astype(np.int64)
        chunks = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(marks), pa.py_buffer(np.ascontiguousarray(data))]
        ).dictionary_encode()
        which = self._numbers(chunks.dictionary.to_pylist())[chunks.indices.to_numpy()]
        bounds = np.array(self.ends, np.int64)
        ends, ids = spread(which, bounds[:-1], np.diff(bounds), np.array(self.ids, np.int32))
        scores = np.concatenate([[0.0], np.cumsum(np.array(self.scores)[which])])
        owner = np.searchsorted(starts, begins)
        return np.concatenate([[0], ends])[owner], ids, np.diff(scores[owner])

    def decode(self, ids: list[int]) -> str:
        """The text of ids; bytes that are no UTF-8 become U+FFFD, unknown pieces a mark."""
        raw = b"".join(map(self.table.__getitem__, ids))
        if self.vocabulary.dummy_prefix and raw[:1] == b" ":
            raw = raw[1:]
        return raw.decode("utf-8", "replace")

    def decode_all(self, lists: pa.Array) -> pa.Array:
        """``decode`` of every list of ids; a null list gives a null."""
        ids = lists.flatten().to_numpy()
        marks = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy())])
        cuts = [ids[k : k + DECODED_IDS] for k in range(0, len(ids), DECODED_IDS)]
        parts = [spread(cut, self.firsts, self.sizes, self.raw)[1] for cut in cuts]
        data = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
        bounds = np.concatenate([[0], np.cumsum(self.sizes[ids])])[marks]
        if self.vocabulary.dummy_prefix:
            filled = np.flatnonzero(bounds[1:] > bounds[:-1])
            blank = filled[data[bounds[filled]] == 32]
            data = np.delete(data, bounds[blank])
            cut = np.zeros(len(bounds), np.int64)
            cut[blank + 1] = 1
            bounds = bounds - np.cumsum(cut)
        offsets, raw = pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))
        texts = pa.LargeStringArray.from_buffers(len(lists), offsets, raw)
        try:
            texts.validate(full=True)
        except pa.ArrowInvalid:
            rows = texts.cast(pa.large_binary()).to_pylist()
            texts = pa.array([r.decode("utf-8", "replace") for r in rows], pa.large_string())
        return pc.if_else(lists.is_null(), pa.scalar(None, texts.type), texts).cast(pa.string())


@lru_cache(maxsize=1)
def encoder_of(model: str) -> PieceEncoder:
    """The encoder of a model file, which a worker process keeps from task to task with the chunks it has met."""
    return PieceEncoder(Vocabulary.load(model))


def encode_documents(docs: DataFrame, model: str, id_column: str = "doc_id", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: the id) plus ``ids`` and ``score`` of every text.

    The best path of the unigram lattice over the pieces of ``model`` (a path
    all executors can read). Characters of no piece become bytes, or one unknown
    id a run. Of equal paths the one with longer last pieces wins. A null or empty text has no ids and
    score 0; repeated rows repeat; an empty table gives an empty one. Kept
    columns named like a result are replaced.
    """
    names = [n for n in keep or [id_column] if n.lower() not in ("ids", "score")]
    kinds = ", ".join(f"`{n}` {docs.schema[n].dataType.simpleString()}" for n in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(model)
        for batch in slices(batches, "text"):
            offsets, ids, scores = encoder.encode(texts_of(batch, "text"))
            lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))
            arrays = [batch.column(n) for n in names] + [lists, pa.array(scores)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, "ids", "score"])

    return docs.select(*dict.fromkeys([*names, "text"])).mapInArrow(run, kinds + ", ids array<int>, score double")


def decode_documents(encoded: DataFrame, model: str) -> DataFrame:
    """``encoded`` plus ``decoded``, the text of its ``ids``; null ids give a null text. A column ``decoded`` is replaced."""
    encoded = without(encoded, "decoded")
    names = encoded.columns
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(model)
        parts = (b.slice(k, DECODED_ROWS) for b in batches for k in range(0, b.num_rows, DECODED_ROWS))
        for batch in parts:
            texts = encoder.decode_all(batch.column("ids"))
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=[*names, "decoded"])

    return encoded.mapInArrow(run, kinds + ", decoded string")
