"""Exact top-k similarity search.

Questions are the small side and the index the large one. A block of questions
whose size has been checked goes to every task; a task scores its index rows
as a matrix product and passes on only its own ``k`` best rows per question.
What is shuffled is then ``k`` rows per question and task, never the product
of the two sides. A search within files or documents scores only the pairs of a
row and a question that may see it. More questions than one block holds are
answered block by block, each block's hits written to the shared scratch folder.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from quire.functions.vectors import with_hashed_counts
from quire.scratch import (
    MAX_BROADCAST_BYTES,
    MAX_BROADCAST_ROWS,
    bounded_rows,
    broadcast_if_small,
    checkpoint,
    scratch_path,
)

# Digits of the score that is returned, and of the one that hits are ranked by: the latter only takes away the
# noise of floating-point sums, so that equal vectors tie.
SCORE_DIGITS = 6
RANK_DIGITS = 12
# Scores computed at once by a task.
CELLS = 1_000_000
# (key, question) pairs that may be sent to the tasks to scope a search.
MAX_SCOPE_ROWS = 200_000
# Keys that a filter may list for the reader.
MAX_LISTED = 1_000
# Folders of an index in key folders, and the column that tells them.
KEY_FOLDERS = 64
KEY_FOLDER = "key_folder"


def embed(df: DataFrame, text: str, out: str = "vector") -> DataFrame:
    """Vector of a text column; rows without words are left out."""
    return with_hashed_counts(df, text, out)


def top_k(
    index: DataFrame,
    questions: DataFrame,
    k: int,
    id_col: str = "id",
    vector: str = "vector",
    question: str = "question_id",
    question_vector: str = "vector",
    scope: list[tuple[DataFrame, str]] | None = None,
    group: str | None = None,
    own: tuple[str, str] | None = None,
    block_rows: int = MAX_BROADCAST_ROWS,
    digits: int = SCORE_DIGITS,
) -> DataFrame:
    """The ``k`` best index rows per question (per question and group) by cosine.

    Returns question, [group,] id, score, rank. Hits are ranked by the full
    score, the column is rounded to ``digits``. Equal scores are ranked by id, null ids first. Each question row is a question of its own, also where its
    id is null or repeated.

    ``scope`` lists pairs of a frame (question, key) and the index column the
    key belongs to: a question then sees only the rows with one of its keys in
    one of these columns. ``own`` names an index column and the question column
    that holds the one key the question may see. An index in key folders
    (``write_keyed_index``) is read only where these keys lie.
    """
    columns = [question, F.col(question_vector).alias("_vector")]
    if own is not None:
        columns.append(F.col(own[1]).alias("_own"))
    asked = questions.select(*columns).filter(F.col("_vector").isNotNull())
    search = (k, id_col, vector, scope, group, own and own[0], digits)
    rows = bounded_rows(asked, block_rows)
    if rows is not None and (not rows or len(rows) * len(rows[0]["_vector"]) * 8 <= MAX_BROADCAST_BYTES):
        return _top_k_block(index, asked.schema[question], rows, *search)

    path = scratch_path(index.sparkSession, "hits")
    blocked, blocks = _blocks(asked, block_rows)
    for b in range(blocks):
        part = blocked.filter(F.col("_block") == b).drop("_block").collect()
        hits = _top_k_block(index, asked.schema[question], part, *search)
        hits.write.parquet(f"{path}/block={b}")
    return index.sparkSession.read.parquet(path).drop("block")


def _blocks(asked: DataFrame, block_rows: int) -> tuple[DataFrame, int]:
    """Questions dealt into blocks, each of which was counted to hold as many rows and bytes as a task may be sent."""
    numbered = checkpoint(asked.withColumn("_uid", F.monotonically_increasing_id()))
    total, width = numbered.agg(F.count("_uid"), F.max(F.size("_vector"))).first()
    most = max(1, min(block_rows, MAX_BROADCAST_BYTES // (8 * max(1, width or 1))))
    blocks = max(1, math.ceil(1.2 * total / most))
    while True:
        block = F.pmod(F.xxhash64("_uid"), F.lit(blocks)).cast("int")
        dealt = numbered.withColumn("_block", block)
        largest = dealt.groupBy("_block").count().agg(F.max("count")).first()[0] or 0
        if largest <= most:
            return dealt.drop("_uid"), blocks
        blocks = math.ceil(1.5 * blocks)


def write_keyed_index(index: DataFrame, key: str, path: str) -> DataFrame:
    """Writes an index in folders by a hash of ``key`` and returns it as read back, with the column ``key_folder``.

    Rows of a folder are sorted by key. A folder of more than one task's share is
    split by adaptive execution, so a key with a third of all rows is written and
    read by many tasks.
    """
    folder = F.pmod(F.hash(key), F.lit(KEY_FOLDERS)).alias(KEY_FOLDER)
    rows = index.select("*", folder).hint("rebalance", KEY_FOLDER).sortWithinPartitions(KEY_FOLDER, key)
    rows.write.partitionBy(KEY_FOLDER).parquet(path)
    return index.sparkSession.read.schema(rows.schema).parquet(path)


def _top_k_block(index, question_field, rows, k, id_col, vector, scope, group, own, digits) -> DataFrame:
    spark = index.sparkSession
    rows = [r for r in rows if any(r["_vector"])]  # an all-zero vector has no direction
    keys = [r[0] for r in rows]
    fields = [question_field]
    if group is not None:
        fields.append(index.schema[group])
    fields += [
        T.StructField("id", index.schema[id_col].dataType),
        T.StructField("score", T.DoubleType()),
    ]
    schema = T.StructType(fields)
    placed = T.StructType([T.StructField("_at", T.LongType()), *fields])
    if not rows:
        empty = spark.createDataFrame([], schema)
        return empty.withColumn("rank", F.lit(None).cast("long"))

    matrix = np.array([r["_vector"] for r in rows], dtype="float64")
    matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)

    columns = [F.col(id_col).alias("_id"), F.col(vector).alias("_vec")]
    if group is not None:
        columns.append(F.col(group).alias("_group"))
    lookup = None
    if own is not None:
        held: dict = {}
        for at, row in enumerate(rows):
            if row["_own"] is not None:
                held.setdefault(row["_own"], []).append(at)
        lookup = [(own, held)]
    elif scope is not None:
        named = _named_keys(spark, question_field, keys, scope)
        lookup = _lookup(named)
        if lookup is None:
            index = _with_scope(index, named)
            columns.append(F.col("_scope"))
    if lookup is not None:
        index = _seen_rows(index, lookup)
        columns += [F.col(column).alias(f"_key_{n}") for n, (column, _) in enumerate(lookup)]

    seen = None if lookup is None else [h for _, h in lookup]
    scoped = lookup is not None or scope is not None
    kernel = _kernel(matrix, keys, k, group is not None, scoped, seen, placed)
    # the kernel leaves out null vectors: a filter on a vector made of a text would make it twice
    local = index.select(*columns).mapInArrow(kernel, placed)
    per = ["_at"] if group is None else ["_at", group]
    order = W.partitionBy(*per).orderBy(F.desc("score"), F.asc("id"))
    ranked = local.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= k).drop("_at")
    return ranked.withColumn("score", F.round("score", digits))


def _named_keys(spark, question_field, keys, scope) -> list[tuple[DataFrame, str]]:
    """Per scope the keys with the place of each question that names them, and the index column."""
    name = question_field.name
    placed = spark.createDataFrame(
        [(key, i) for i, key in enumerate(keys)],
        T.StructType([question_field, T.StructField("_at", T.IntegerType())]),
    )
    out = []
    for pairs, column in scope:
        named = pairs.select(F.col(name), F.col(pairs.columns[1]).alias("_key"))
        out.append((named.join(F.broadcast(placed), name).select("_key", "_at").distinct(), column))
    return out


def _lookup(named: list[tuple[DataFrame, str]]) -> list[tuple[str, dict]] | None:
    """Per scope the index column and the questions of each key, or None if the pairs are too many to be sent."""
    out = []
    for pairs, column in named:
        rows = bounded_rows(pairs, MAX_SCOPE_ROWS)
        if rows is None:
            return None
        held: dict = {}
        for key, at in rows:
            if key is not None:
                held.setdefault(key, []).append(at)
        out.append((column, held))
    return out


def _seen_rows(index: DataFrame, lookup: list[tuple[str, dict]]) -> DataFrame:
    """Rows with one of the keys; of an index in key folders, those folders only."""
    spark = index.sparkSession
    wanted = F.lit(False)
    folders: set[int] = set()
    for column, held in lookup:
        values = list(held)
        if not values:
            continue
        if len(values) > MAX_LISTED:  # the kernel leaves the other rows out
            wanted = wanted | F.col(column).isNotNull()
        else:
            wanted = wanted | F.col(column).isin(values)
        if KEY_FOLDER in index.columns:
            kind = T.StructType([T.StructField("k", index.schema[column].dataType)])
            parts = spark.createDataFrame([(v,) for v in values], kind)
            folders |= {r[0] for r in parts.select(F.pmod(F.hash("k"), F.lit(KEY_FOLDERS))).distinct().collect()}
    index = index.filter(wanted)
    return index.filter(F.col(KEY_FOLDER).isin(sorted(folders))) if folders else index


def _with_scope(index, named) -> DataFrame:
    """Index rows some question may see, with the positions of these questions, for more pairs than can be sent.

    A key maps to one list, so a row stays one row however many questions name
    its key.
    """
    lists = []
    for n, (pairs, column) in enumerate(named):
        seen = pairs.groupBy("_key").agg(F.collect_list("_at").alias(f"_seen_{n}"))
        how = "inner" if len(named) == 1 else "left"
        index = index.join(seen, index[column] == seen["_key"], how).drop("_key")
        lists.append(F.coalesce(F.col(f"_seen_{n}"), F.array().cast("array<int>")))
    every = lists[0] if len(lists) == 1 else F.array_distinct(F.concat(*lists))
    return index.withColumn("_scope", every).filter(F.size("_scope") > 0)


def _kernel(matrix, keys, k, grouped, scoped, seen, schema):
    """Arrow batch function that keeps the k best rows per question (and group).

    A scoped row is scored with the questions that may see it, those of its
    keys in ``seen`` or of its own list, and with no others.

    Scores below the k-th best one seen so far are dropped before any sorting;
    the first rows are taken in a small step so that there is such a bound.
    """
    digits, cells = RANK_DIGITS, CELLS
    slack = 1.1 * 10.0**-digits  # rounding may lift a score up to the bound
    n_questions, width = matrix.shape
    names = schema.fieldNames()
    key_type = to_arrow_type(schema.fields[1].dataType)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def plain(column):
            """Values and which of them are there; whole numbers stay whole numbers."""
            there = column.is_valid().to_numpy(zero_copy_only=False)
            if pa.types.is_integer(column.type):
                return column.fill_null(0).to_numpy(zero_copy_only=False), there
            values = np.empty(len(column), dtype=object)
            values[:] = column.to_pylist()
            if not there.all():
                values[~there] = values[there][0] if there.any() else ""
            return values, there

        def best(slot, ids, there, s):
            """First k entries of every slot, best score first."""
            order = np.lexsort((ids, there, -s, slot))
            slot, ids, there, s = slot[order], ids[order], there[order], s[order]
            starts = np.flatnonzero(np.append(True, slot[1:] != slot[:-1]))
            sizes = np.diff(np.append(starts, len(slot)))
            keep = np.arange(len(slot)) - np.repeat(starts, sizes) < k
            full = sizes >= k
            bounds = slot[starts[full]], s[starts[full] + k - 1]
            return (slot[keep], ids[keep], there[keep], s[keep]), bounds

        def listed(batch):
            """Questions that may see each row: how many, and their places one after another."""
            if seen is None:
                lists = batch.column("_scope")
                return lists.value_lengths().to_numpy(zero_copy_only=False), lists.flatten().to_numpy(zero_copy_only=False)
            rows, places = [], []
            for n, own in enumerate(seen):
                coded = batch.column(f"_key_{n}").dictionary_encode(null_encoding="encode")
                lists = [np.array(own.get(key, ()), dtype="int64") for key in coded.dictionary.to_pylist()]
                code = coded.indices.to_numpy(zero_copy_only=False)
                size = np.array([len(x) for x in lists], dtype="int64")
                first = np.cumsum(size) - size
                counts = size[code]
                ends = np.cumsum(counts)
                row = np.repeat(np.arange(len(code)), counts)
                at = np.arange(len(row)) - np.repeat(ends - counts, counts) + np.repeat(first[code], counts)
                rows.append(row)
                places.append(np.concatenate([*lists, np.empty(0, "int64")])[at])
            row, place = np.concatenate(rows), np.concatenate(places)
            if len(seen) > 1:
                row, place = np.divmod(np.unique(row * n_questions + place), n_questions)
            return np.bincount(row, minlength=batch.num_rows), place

        def pair_scores(block, row, col):
            """Products of the listed pairs alone, a bounded number at a time."""
            value = np.empty(len(row))
            step = max(1, cells // width)
            for lo in range(0, len(row), step):
                part = slice(lo, lo + step)
                value[part] = np.einsum("ij,ij->i", block[row[part]], matrix[col[part]])
            return value

        codes: dict = {}
        held = None
        # Slots (a question, or a question and group) with k hits, and the k-th score.
        full, bound = np.empty(0, dtype="int64"), np.empty(0)
        floor = np.full(n_questions, -np.inf)
        for batch in batches:
            if batch.column("_vec").null_count:
                batch = batch.filter(batch.column("_vec").is_valid())
            if batch.num_rows == 0:
                continue
            flat = batch.column("_vec").flatten().to_numpy(zero_copy_only=False)
            block = flat.astype("float64").reshape(batch.num_rows, width)
            length = np.linalg.norm(block, axis=1, keepdims=True)
            real = length[:, 0] > 0
            block = block / np.where(length > 0, length, 1.0)
            ids, there = plain(batch.column("_id"))
            id_type = batch.schema.field("_id").type
            if grouped:
                coded = batch.column("_group").dictionary_encode(null_encoding="encode")
                group_type = batch.schema.field("_group").type
                here = [codes.setdefault(g, len(codes)) for g in coded.dictionary.to_pylist()]
                group = np.array(here, dtype="int64")[coded.indices.to_numpy()]
            if scoped:
                sizes, wanted = listed(batch)
                ends = np.cumsum(sizes)
            lo = 0
            while lo < len(ids):
                if scoped:
                    # as many rows as list a bounded number of questions
                    before = ends[lo] - sizes[lo]
                    hi = max(lo + 1, int(np.searchsorted(ends, before + cells, side="right")))
                    row = np.repeat(np.arange(hi - lo), sizes[lo:hi])
                    col = wanted[before : ends[hi - 1]]
                    value = np.where(real[lo:hi][row], pair_scores(block[lo:hi], row, col), -np.inf)
                else:
                    step = max(1, cells // n_questions)
                    hi = min(len(ids), lo + (step if held is not None else min(step, 1024)))
                    scores = block[lo:hi] @ matrix.T
                    scores[~real[lo:hi]] = -np.inf
                if scoped:
                    pass
                elif grouped:
                    row, col = np.divmod(np.arange(scores.size), n_questions)
                    value = scores.ravel()
                else:
                    least = floor
                    if held is None and hi - lo > k:
                        least = -np.partition(-scores, k - 1, axis=0)[k - 1]
                    row, col = np.nonzero(scores >= least - slack)
                    value = scores[row, col]
                slot = col.astype("int64")
                good = value > -np.inf
                if grouped:
                    slot = (slot << 32) | group[lo:hi][row]
                    if len(full):
                        at = np.minimum(np.searchsorted(full, slot), len(full) - 1)
                        good &= (full[at] != slot) | (value >= bound[at] - slack)
                else:
                    good &= value >= floor[col] - slack
                score = np.round(value[good], digits) + 0.0
                found = slot[good], ids[lo:hi][row[good]], there[lo:hi][row[good]], score
                if held is not None:
                    found = tuple(np.concatenate(p) for p in zip(held, found))
                lo = hi
                if len(found[0]) == 0:
                    continue
                held, (full, bound) = best(*found)
                if not grouped:
                    floor[full] = bound
        if held is None:
            return
        slot, ids, there, s = held
        at = ((slot >> 32) if grouped else slot).tolist()
        arrays = [pa.array(at, type=pa.int64()), pa.array([keys[i] for i in at], type=key_type)]
        if grouped:
            label = {code: g for g, code in codes.items()}
            arrays.append(pa.array([label[c] for c in (slot & 0xFFFFFFFF).tolist()], type=group_type))
        named = [v if ok else None for v, ok in zip(ids.tolist(), there.tolist())]
        arrays += [pa.array(named, type=id_type), pa.array(s, type=pa.float64())]
        yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


def with_columns(hits: DataFrame, index: DataFrame, id_col: str, columns: list[str]) -> DataFrame:
    """Materialised hits with further index columns.

    Few hits are sent to the index rows; the index is not shuffled for them.
    """
    wanted = index.select(F.col(id_col).alias("id"), *columns)
    return wanted.join(broadcast_if_small(hits), "id").select(*hits.columns, *columns)


def within(
    index: DataFrame,
    questions: DataFrame,
    k: int,
    key: str,
    question_key: str,
    question: str = "question_id",
    **names,
) -> DataFrame:
    """Top-k inside the document (or label) each question names."""
    return top_k(index, questions, k, question=question, own=(key, question_key), **names)


def centroids(vectors: DataFrame, by: str, vector: str, out: str = "vector") -> DataFrame:
    """Mean vector per value, combined within each task before the shuffle."""
    from pyspark.ml.stat import Summarizer

    mean = Summarizer.mean(array_to_vector(F.col(vector)))
    return vectors.groupBy(by).agg(vector_to_array(mean).alias(out))
