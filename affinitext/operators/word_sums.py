"""Sums and maxima of the word vectors of every row, for vocabularies of any size.

The words used most, up to a bounded size, travel to the tasks and are summed where the rows
stand. What is left of a row are its rarer words: rows are dealt to blocks, vectors are cut
into slices of a few components, and a task holds one slice of the distinct rare words of one
block. So a vector moves once per block that has its word, never once per occurrence, and
what is shuffled grows with the rows and their words alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from affinitext.operators.lookup import fits_broadcast, list_counts, lookup_join, most_used
from affinitext.session import cut_lineage, drop_stored

#: Bytes of the words that travel to every task.
TRAVEL_BYTES = 64 * 2**20
#: Bytes of words and vector slices that one task holds for its block.
BLOCK_BYTES = 192 * 2**20
SLICE_DIMS = 25
#: Words in the rows that are dealt to blocks at a time. Rows of more words are told apart by
#: their key and done in turn, so that what lies on disk in between is that of one share.
TURN_WORDS = 64_000_000
CELLS = 4_000_000  # components gathered at a time in a task


def sums_per_row(
    tokens: DataFrame, words: DataFrame, key: str, tokens_col: str, dims: int, size: int,
    pooled: bool, travel_bytes: int = TRAVEL_BYTES, block_bytes: int = BLOCK_BYTES,
    turn_words: int = TURN_WORDS,
) -> DataFrame:
    """(key, vector): the mean over all known words of the rows of a key, followed by the
    maxima if `pooled`; no row for a key without a known word.

    `words` (word, vector) has each word once, with `dims` components and no missing ones,
    and takes up `size` bytes.
    """
    words = words.select("word", F.col("vector").cast("array<double>").alias("vector"))
    rows = tokens.select(F.col(key).alias("key"), F.col(tokens_col).alias("words"))
    whole = size <= travel_bytes
    if whole:
        head = words
    else:
        counts = cut_lineage(list_counts(rows, "words", "word").filter(F.col("word").isNotNull()))
        common = most_used(None, words, "word", travel_bytes, counts)
        head = words.join(F.broadcast(common), "word", "left_semi")
    entries = head.toArrow()
    known = _joined(entries.column("word"))
    matrix = _matrix(_joined(entries.column("vector")), dims)
    schema = [T.StructField("key", rows.schema["key"].dataType), T.StructField("_n", T.LongType()),
              T.StructField("_s", T.ArrayType(T.DoubleType()))]
    if pooled:
        schema.append(T.StructField("_m", T.ArrayType(T.DoubleType())))
    summed = T.StructType([*schema, T.StructField("_slice", T.IntegerType())])
    if whole:
        parts = rows.mapInArrow(_head_sums(known, matrix, pooled, False), summed)
        return _assembled(parts, key, dims, 1, pooled)
    turns = max(1, -(-(counts.agg(F.sum("_n")).first()[0] or 0) // turn_words))
    if turns == 1:
        return _by_blocks(rows, words, known, matrix, schema, key, pooled, block_bytes)[0]
    # Another hash than that of the blocks, which are to be even in each turn.
    turn = F.pmod(F.xxhash64("key", F.lit(1)), F.lit(turns))
    found = []
    for i in range(turns):
        sums, parts = _by_blocks(
            rows.filter(turn == i), words, known, matrix, schema, key, pooled, block_bytes)
        found.append(cut_lineage(sums, compression="zstd"))
        drop_stored(parts)
    return reduce(DataFrame.unionByName, found)


def _by_blocks(
    rows: DataFrame, words: DataFrame, known: pa.Array, matrix: np.ndarray, schema: list[T.StructField],
    key: str, pooled: bool, block_bytes: int,
) -> tuple[DataFrame, DataFrame]:
    """(key, vector) of rows whose words are not all `known`, and the table written for it."""
    dims = matrix.shape[1]
    summed = T.StructType([*schema, T.StructField("_slice", T.IntegerType())])
    slices = -(-dims // SLICE_DIMS)
    width = -(-dims // slices)
    matrix = np.pad(matrix, ((0, 0), (0, slices * width - dims)))
    rest = T.StructField("_rest", T.ArrayType(T.StringType()))
    parts = cut_lineage(rows.mapInArrow(
        _head_sums(known, matrix, pooled, True), T.StructType([*schema, rest])), compression="zstd")
    pieces, n_blocks = _block_vectors(parts, words, dims, slices, width, block_bytes)
    places = [F.struct(F.lit(i).alias("_slice"), *[F.slice(c, i * width + 1, width).alias(c)
              for c in ("_s", "_m")[: 1 + pooled]]) for i in range(slices)]
    docs = parts.select("key", "_n", "_rest", _block(n_blocks), F.explode(F.array(*places)).alias("_part"))
    docs = docs.select("_block", F.lit(1).alias("_kind"), "key", "_n", "_rest", "_part.*")
    # Empty lists and not missing ones: Arrow goes over a run of missing lists again per row.
    empty = {c: F.array().cast(docs.schema[c].dataType) for c in ("_rest", "_m")[: 1 + pooled]}
    spark = rows.sparkSession
    tasks = min(n_blocks * slices, max(spark.sparkContext.defaultParallelism,
                                       int(spark.conf.get("spark.sql.shuffle.partitions"))))
    # Dealt in turn: by hash, some tasks would get several blocks and others none.
    placed = pieces.withColumns(empty).unionByName(docs, allowMissingColumns=True).repartitionById(
        tasks, ((F.col("_block").cast("long") * slices + F.col("_slice")) % tasks).cast("int"))
    done = placed.sortWithinPartitions("_block", "_slice", "_kind").mapInArrow(
        _block_sums(width, pooled, to_arrow_type(rows.schema["key"].dataType)), summed)
    return _assembled(done, key, dims, slices, pooled), parts


def _block(n_blocks: int) -> Column:
    return F.pmod(F.xxhash64("key"), F.lit(n_blocks)).cast("int").alias("_block")


def _block_vectors(
    parts: DataFrame, words: DataFrame, dims: int, slices: int, width: int, block_bytes: int
) -> tuple[DataFrame, int]:
    """(_block, _slice, _kind, word, _s) of the words that the rows of a block still lack, and
    the number of blocks: as many as keep what a task holds within `block_bytes`, as far as
    rows can be told apart by their key."""
    parallel = parts.sparkSession.sparkContext.defaultParallelism
    n_blocks = max(1, -(-parallel // slices))
    names = words.select("word")
    while True:
        lacking = parts.select(_block(n_blocks), F.explode("_rest").alias("word")).distinct()
        needed = cut_lineage(lacking.join(names, "word"))
        held = F.sum(F.octet_length("word") + width * 8 + 16)
        most = needed.groupBy("_block").agg(held.alias("bytes")).agg(F.max("bytes")).first()[0] or 0
        if most <= block_bytes or n_blocks >= 2**20:
            break
        n_blocks *= 1 + -(-most // block_bytes)
    wanted = needed.groupBy("word").agg(F.collect_list("_block").alias("_blocks"))
    if fits_broadcast(wanted):
        found = words.join(F.broadcast(wanted), "word").select(
            F.explode("_blocks").alias("_block"), "word", "vector")
    else:
        found = lookup_join(needed, words, "word", "_block", broadcast=False)
    vector = F.col("vector")
    if slices * width > dims:
        vector = F.concat(vector, F.array_repeat(F.lit(0.0), slices * width - dims))
    places = [F.struct(F.lit(i).alias("_slice"), F.slice(vector, i * width + 1, width).alias("_s"))
              for i in range(slices)]
    cut = found.select("_block", "word", F.explode(F.array(*places)).alias("_part"))
    return cut.select("_block", F.lit(0).alias("_kind"), "word", "_part.*"), n_blocks


def _joined(column: pa.ChunkedArray) -> pa.Array:
    column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    return column


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _lists(matrix: np.ndarray) -> pa.Array:
    offsets = np.arange(0, matrix.size + 1, matrix.shape[1], dtype=np.int32) if matrix.shape[1] else \
        np.zeros(len(matrix) + 1, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.reshape(-1)))


def _look_up(lists: pa.Array, known: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """All words of the lists, the row of each, and its place in `known` (-1: not there)."""
    flat = lists.flatten()
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(lists)), lengths)
    found = pc.index_in(flat, value_set=known.cast(flat.type))
    return flat, rows, pc.fill_null(found, -1).to_numpy(zero_copy_only=False)


def _add(rows: np.ndarray, places: np.ndarray, columns: np.ndarray, sums: np.ndarray, tops: np.ndarray | None):
    """Add the vectors at `places` to the sums (and maxima) of their rows, which ascend. The
    table has one line per component, which is gathered and summed at a stretch."""
    for at in range(0, len(rows), CELLS):
        r, p = rows[at : at + CELLS], places[at : at + CELLS]
        starts = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
        own = r[starts]
        for i, column in enumerate(columns):
            values = column[p]
            sums[own, i] += np.add.reduceat(values, starts)
            if tops is not None:
                tops[own, i] = np.maximum(tops[own, i], np.maximum.reduceat(values, starts))


def _head_sums(known: pa.Array, matrix: np.ndarray, pooled: bool, with_rest: bool):
    """Arrow batches of (key, words) -> per row: number, sum and maxima of its words among
    `known`, and the other ones in `_rest` or, without it, slice 0."""
    step = max(1, CELLS // max(1, 2 * matrix.shape[1]))
    columns = np.ascontiguousarray(matrix.T)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                flat, rows, places = _look_up(batch.column(1), known)
                has = places >= 0
                sums = np.zeros((batch.num_rows, len(columns)))
                tops = np.full(sums.shape, -np.inf) if pooled else None
                _add(rows[has], places[has], columns, sums, tops)
                n = np.bincount(rows[has], minlength=batch.num_rows)
                arrays = [batch.column(0), pa.array(n, pa.int64()), _lists(sums)]
                names = ["key", "_n", "_s"]
                if pooled:
                    arrays.append(_lists(tops))
                    names.append("_m")
                if with_rest:
                    other = ~has & pc.is_valid(flat).to_numpy(zero_copy_only=False)
                    ends = np.cumsum(np.bincount(rows[other], minlength=batch.num_rows))
                    offsets = pa.array(np.r_[0, ends], pa.int32())
                    left = flat.filter(pa.array(other)).cast(pa.string())
                    arrays.append(pa.ListArray.from_arrays(offsets, left))
                    names.append("_rest")
                else:
                    arrays.append(pa.array(np.zeros(batch.num_rows, np.int32)))
                    names.append("_slice")
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


def _block_sums(width: int, pooled: bool, arrow_key: pa.DataType):
    """Rows sorted by block, slice and kind, the words of a block before its rows -> the
    rows with the words of their block added."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, names, vectors, known, columns = None, [], [], None, None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            marks = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("_block", "_slice", "_kind")])
            starts = np.flatnonzero(np.r_[True, (marks[:, 1:] != marks[:, :-1]).any(axis=0)])
            for first, last in zip(starts, np.r_[starts[1:], batch.num_rows], strict=True):
                part = batch.slice(first, last - first)
                block, place, kind = marks[:, first]
                if (block, place) != here:
                    here, names, vectors, known, columns = (block, place), [], [], None, None
                if kind == 0:
                    names.append(part.column("word"))
                    vectors.append(_matrix(part.column("_s"), width))
                    continue
                if known is None:
                    known = pa.concat_arrays(names) if names else pa.array([], pa.string())
                    matrix = np.concatenate(vectors) if vectors else np.zeros((0, width))
                    columns = np.ascontiguousarray(matrix.T)
                    names, vectors = [], []
                _, rows, places = _look_up(part.column("_rest"), known)
                has = places >= 0
                sums = _matrix(part.column("_s"), width).copy()
                tops = _matrix(part.column("_m"), width).copy() if pooled else None
                _add(rows[has], places[has], columns, sums, tops)
                n = part.column("_n").to_numpy(zero_copy_only=False) + np.bincount(
                    rows[has], minlength=part.num_rows)
                arrays = [part.column("key").cast(arrow_key), pa.array(n, pa.int64()), _lists(sums)]
                made = ["key", "_n", "_s"]
                if pooled:
                    arrays.append(_lists(tops))
                    made.append("_m")
                arrays.append(pa.array(np.full(part.num_rows, place, np.int32)))
                yield pa.RecordBatch.from_arrays(arrays, names=[*made, "_slice"])

    return run


def _assembled(parts: DataFrame, key: str, dims: int, slices: int, pooled: bool) -> DataFrame:
    """(key, vector) from the slices of all rows of a key."""
    kind = parts.schema["key"].dataType
    schema = T.StructType([T.StructField("key", kind), T.StructField("vector", T.ArrayType(T.DoubleType()))])
    placed = parts.filter("_n > 0").repartition("key").sortWithinPartitions("key")
    merged = placed.mapInArrow(_merged_slices(to_arrow_type(kind), dims, slices, pooled), schema)
    return merged.select(F.col("key").alias(key), "vector")


def _merged_slices(arrow_key: pa.DataType, dims: int, slices: int, pooled: bool):
    """Rows sorted by key -> one row per key. A key's run may go on in the next batch, so the
    last run of a batch is added up and waits for it."""
    width = -(-dims // slices)

    def add_up(table: pa.Table, codes: np.ndarray):
        place = table.column("_slice").to_numpy()
        n_keys = codes[-1] + 1
        sums = np.zeros((n_keys, slices * width))
        tops = np.full(sums.shape, -np.inf) if pooled else None
        values = _matrix(_joined(table.column("_s")), width)
        highs = _matrix(_joined(table.column("_m")), width) if pooled else None
        counts = np.bincount(codes[place == 0], table.column("_n").to_numpy()[place == 0], n_keys)
        for i in range(slices):
            chosen = np.flatnonzero(place == i)
            if not len(chosen):
                continue
            owner = codes[chosen]
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            columns = slice(i * width, (i + 1) * width)
            sums[owner[starts], columns] = np.add.reduceat(values[chosen], starts, axis=0)
            if pooled:
                tops[owner[starts], columns] = np.maximum.reduceat(highs[chosen], starts, axis=0)
        return counts, sums, tops

    def rows(keys: pa.Array, counts, sums, tops) -> pa.RecordBatch:
        vectors = sums[:, :dims] / counts[:, None]
        if pooled:
            vectors = np.hstack([vectors, tops[:, :dims]])
        return pa.RecordBatch.from_arrays([keys.cast(arrow_key), _lists(np.ascontiguousarray(vectors))],
                                          names=["key", "vector"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # key, count, sums and maxima of the run that may go on
        for batch in batches:
            if batch.num_rows == 0:
                continue
            table = pa.Table.from_batches([batch])
            keys = _joined(table.column("key"))
            codes = keys.dictionary_encode(null_encoding="encode").indices.to_numpy()
            first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
            counts, sums, tops = add_up(table, codes)
            own = keys.take(pa.array(first))
            if held is not None:
                if held[0][0].as_py() == own[0].as_py():
                    counts[0] += held[1][0]
                    sums[0] += held[2][0]
                    if pooled:
                        tops[0] = np.maximum(tops[0], held[3][0])
                else:
                    yield rows(*held)
            if len(own) > 1:
                yield rows(own[:-1], counts[:-1], sums[:-1], tops[:-1] if pooled else None)
            held = (own[-1:], counts[-1:], sums[-1:], tops[-1:] if pooled else None)
        if held is not None:
            yield rows(*held)

    return run
