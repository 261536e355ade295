"""Token ids of documents in ORC files, and reads that use the files' metadata.

Documents are ranged by id over the files and sorted inside, so ids are in
ascending order from file to file. A row holds one document: its id and its
token ids, which ORC stores with integer run-length encoding. Stripes bound what
one task reads, row indexes hold the least and greatest id of every few rows,
and Bloom filters on the id answer lookups inside of them.
"""

from __future__ import annotations

import functools
import itertools
import os
import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm.arrow import slices, spread, texts_of
from quire.scratch import broadcast_if_small

END_ID = 1
STRIPE_BYTES = 16 << 20
# Rows of one entry of the row index and of one Bloom filter.
INDEX_ROWS = 1_000
FALSE_POSITIVES = 0.01
# Bytes of text encoded together; more of them share more words.
TOKEN_SLICE = 6 << 20
# Encoded runs a worker keeps; beyond, it begins anew.
CACHE_BYTES = 128 << 20
# Latin letters; normal forms and lower case make no combining marks of them.
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f"
# Marks at the end of a run, after a Latin letter or digit.
MARKS = rf"([0-9{LETTERS}])([.,;:!?]+(?:[\x20\x09-\x0D]|$))"
PLAIN = re.compile(f"[{LETTERS}]+")
# Plain runs encoded as one text.
TOGETHER = 500
OWN = ("file_no", "ids_before", "n_tokens", "ids")


@functools.lru_cache(maxsize=2)
def _tokenizer(path: str):
    """The tokenizer, and which of its ids end a word."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.encode_special_tokens = True  # their strings in a text are ordinary text
    suffix = getattr(found.model, "end_of_word_suffix", None)
    ends = np.zeros(found.get_vocab_size(), bool)
    if suffix:
        ends[[i for token, i in found.get_vocab().items() if token.endswith(suffix)]] = True
    return found, ends


class WordEncoder:
    """Ids of texts under a ``tokenizers`` file that drops white space and case.

    Such a tokenizer treats each run without ASCII white space by itself, and
    apart from it the marks that end a run after a Latin letter or digit. Every
    distinct run is encoded once and kept, up to ``CACHE_BYTES`` of runs; the ids
    of the texts are gathered by index. Runs of nothing but letters are one word
    each: many are encoded as one text and told apart by the ids that end words.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer, self.ends = _tokenizer(path)
        self._forget()

    def _forget(self) -> None:
        self.slots: dict[str, int] = {}
        self.held = 0
        self.ids, self.size = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def _encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and how many each text has."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        size = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(itertools.chain.from_iterable(found), np.uint32, int(size.sum())), size

    def _keep(self, runs: list[str], ids: np.ndarray, size: np.ndarray) -> None:
        self.slots.update(zip(runs, range(len(self.size), len(self.size) + len(runs))))
        self.size, self.ids = np.concatenate([self.size, size]), np.concatenate([self.ids, ids])
        self.held += sum(map(len, runs)) + 200 * len(runs)

    def _slots_of(self, runs: list[str]) -> np.ndarray:
        """The place of each run in ``ids`` and ``size``, after encoding the new ones."""
        new = [r for r in runs if r not in self.slots]
        plain = [r for r in new if PLAIN.fullmatch(r)] if self.ends.any() else []
        ids, _ = self._encoded([" ".join(plain[k : k + TOGETHER]) for k in range(0, len(plain), TOGETHER)])
        size = np.diff(np.flatnonzero(self.ends[ids]), prepend=-1)
        if len(size) == len(plain) and not (len(ids) and not self.ends[ids[-1]]):
            self._keep(plain, ids, size)
        rest = [r for r in new if r not in self.slots]
        self._keep(rest, *self._encoded(rest))
        return np.fromiter(map(self.slots.__getitem__, runs), np.int64, len(runs))

    def __call__(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Offsets per text and all ids, ``end_id`` after each text's own."""
        if self.held > CACHE_BYTES:
            self._forget()
        marked = pc.replace_substring_regex(pc.ascii_lower(texts), MARKS, r"\1 \2")
        lists = pc.ascii_split_whitespace(marked)
        coded = lists.values.dictionary_encode()
        slots = self._slots_of(coded.dictionary.to_pylist())
        first, size = np.cumsum(self.size) - self.size, self.size
        bounds = lists.offsets.to_numpy().astype(np.int64)
        # the end id is one more run after the last run of each text
        which = np.insert(slots[coded.indices.to_numpy()], bounds[1:], len(size))
        first, size = np.append(first, len(self.ids)), np.append(size, 1)
        ends, ids = spread(which, first, size, np.append(self.ids, np.uint32(end_id)))
        return np.concatenate([[0], ends])[bounds + np.arange(len(bounds))], ids


@functools.lru_cache(maxsize=1)
def encoder_of(path: str) -> WordEncoder:
    """The encoder of a Python worker, kept with its runs from task to task."""
    return WordEncoder(path)


def encode_sorted(docs: DataFrame, path: str, key: str, end_id: int = END_ID) -> DataFrame:
    """``key``, ``file_no``, ``ids_before``, ``n_tokens``, ``ids`` of documents, ranged and sorted by ``key``.

    ``ids_before`` counts the ids of earlier documents of the same range. Equal
    keys are in order of a hash of their text; a place of its own lets equal rows
    spread over several ranges too.
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("key"), F.col("_hash"), F.col("_place")]
    rows = docs.select(
        F.col(f"`{key}`").alias("key"),
        "text",
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("_hash"),
        F.monotonically_increasing_id().alias("_place"),
    )
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, number, before = encoder_of(path), TaskContext.get().partitionId(), 0
        for batch in slices(batches, "text", TOKEN_SLICE):
            offsets, ids = encoder(texts_of(batch, "text"), end_id)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    pa.array(np.full(batch.num_rows, number, np.int32)),
                    pa.array(before + offsets[:-1]),
                    pa.array(np.diff(offsets)),
                    pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids.astype(np.int32))),
                ],
                names=["key", *OWN],
            )
            before += int(offsets[-1])

    ranged = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).select("key", "text")
    return ranged.mapInArrow(run, f"key {kind}, file_no int, ids_before long, n_tokens long, ids array<int>")


def write_tokens(
    docs: DataFrame,
    out: str,
    path: str,
    key: str = "doc_id",
    end_id: int = END_ID,
    stripe_bytes: int = STRIPE_BYTES,
    index_rows: int = INDEX_ROWS,
) -> None:
    """Writes the token ids of ``docs`` (``key``, ``text``) as ORC files below ``out``.

    Columns: ``key`` plus ``file_no``, ``ids_before`` (ids of earlier documents
    of that file), ``n_tokens`` (with the end id) and ``ids``; other columns of
    ``docs``, whatever their names, are not written. A null or empty text is its
    end id alone. Rows are in ascending order of ``key``, nulls first; repeated
    rows are rows of their own. An empty table gives files without rows. The
    tokenizer file must lie at ``path`` on every executor.
    """
    encode_sorted(docs, path, key, end_id).withColumnRenamed("key", key).write.options(
        **{
            "compression": "zstd",
            "orc.create.index": "true",
            "orc.row.index.stride": index_rows,
            "orc.stripe.size": stripe_bytes,
            "orc.rows.between.memory.checks": index_rows,
            "orc.bloom.filter.columns": key,
            "orc.bloom.filter.fpp": FALSE_POSITIVES,
        }
    ).orc(out)


def read_tokens(spark: SparkSession, out: str, keys: Sequence | None = None, key: str = "doc_id") -> DataFrame:
    """Documents of a written folder, or those of ``keys``.

    Tasks take whole stripes. ``keys`` reach the reader as a predicate: files
    and stripes are left out by their statistics, row groups by the row index
    and its Bloom filters.
    """
    rows = spark.read.orc(out)
    return rows if keys is None else rows.where(F.col(key).isin(list(keys)))


def starts(rows: DataFrame) -> DataFrame:
    """``rows`` of a written folder with ``start``: ids of all documents before each, over all files.

    The ids of the files before come from two columns of the files, added up to
    one row per file; only that table is summed in order, and it goes to the
    rows, which stay where they are, unless it has more rows than
    ``broadcast_if_small`` allows.
    """
    totals = rows.groupBy("file_no").agg(F.sum("n_tokens").alias("_n"))
    before = totals.select(
        F.col("file_no").alias("_file"), (F.sum("_n").over(Window.orderBy("file_no")) - F.col("_n")).alias("_before")
    )
    return (
        rows.join(broadcast_if_small(before), rows["file_no"] == before["_file"])
        .withColumn("start", F.col("_before") + F.col("ids_before"))
        .drop("_file", "_before")
    )


def ids_crc32(ids: Column) -> Column:
    """Unsigned crc32 of an array of ids as little-endian unsigned 32-bit integers."""

    @F.pandas_udf("long")
    def checksum(lists):  # noqa: ANN001, ANN202
        return lists.map(lambda x: zlib.crc32(np.asarray(x, "<u4").tobytes()))

    return checksum(ids)
