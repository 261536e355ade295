"""Arrow and numpy helpers shared by the tasks of this subpackage.

They work on one bounded slice of a record batch at a time, so a task's memory
depends on the slice and on the longest single text, not on the partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SLICE_BYTES = 6 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)
_ODD = np.uint64(0xD6E8FEB86659FD93)


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts batches so that a string column holds about ``limit`` bytes a piece; one longer text stands alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype(np.int64) + 64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def texts_of(batch: pa.RecordBatch, column: str) -> pa.Array:
    """The column as strings with nulls as empty texts, in an array of its own."""
    filled = pc.fill_null(batch.column(column).cast(pa.large_string()), "")
    return pa.concat_arrays([filled])


def split_words(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, pa.Array]:
    """Offsets per text, and all words: runs without ASCII white space."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    bounds = lists.offsets.to_numpy()
    flat = lists.values
    full = pc.greater(pc.binary_length(flat), 0)
    kept = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
    return kept[bounds].astype(np.int64), flat.filter(full)


def hashed(words: pa.Array, seed: int = 0) -> np.ndarray:
    """64-bit hash per string; every distinct string is hashed once."""
    if not len(words):
        return np.zeros(0, np.uint64)
    coded = words.dictionary_encode()
    digest = xxhash.xxh3_64_intdigest
    known = np.fromiter((digest(w, seed) for w in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    return known[coded.indices.to_numpy()]


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(32))) * _ODD
    x = (x ^ (x >> np.uint64(29))) * _MIX
    return x ^ (x >> np.uint64(32))


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the ``width``-word shingles of every text.

    A text with fewer words gives its whole sequence as one shingle, a text
    without words an empty array.
    """
    offsets, words = split_words(texts, lower=True)
    codes = hashed(words)
    rolled = np.zeros(len(codes), np.uint64)
    if len(codes) >= width:
        last = len(codes) - width + 1
        value = np.full(last, width, np.uint64)
        for k in range(width):
            value = value * _MIX + mixed(codes[k : k + last] + np.uint64(k + 1))
        rolled[:last] = mixed(value)
    out = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        if b - a >= width:
            out.append(np.unique(rolled[a : b - width + 1]))
        elif b > a:
            value = np.uint64(b - a)
            with np.errstate(over="ignore"):
                for k in range(a, b):
                    value = value * _MIX + mixed(codes[k : k + 1] + np.uint64(k - a + 1))[0]
                out.append(mixed(np.array([value], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_hash(values: np.ndarray) -> int:
    """Signed 64-bit hash of a sorted set."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(values.tobytes())).astype(np.int64))


def spread(which: np.ndarray, first: np.ndarray, size: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends and values of the runs ``which`` names, one after another; run k is ``size[k]`` values from ``first[k]``."""
    counts = size[which]
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return ends, values[np.arange(total) + np.repeat(first[which] - ends + counts, counts)]
