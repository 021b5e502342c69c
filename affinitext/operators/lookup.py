"""Joins against a table that may or may not be small, and hot keys on the other side."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from affinitext.session import cut_lineage

BROADCAST_BYTES = 256 * 2**20
SALTS = 64
PUSHED_IDS = 200
#: Keys with more rows than HOT_ROWS, or than one HOT_KEYS-th of all rows if that is more,
#: are salted, every one of them, in proportion to their rows. So at most HOT_KEYS keys are
#: salted (a table of bounded size to broadcast), and no unsalted key holds more rows than that.
HOT_ROWS = 100_000
HOT_KEYS = 100_000
CELLS = 1_000_000  # entries of lists counted at a time in a task


def row_bytes(table: DataFrame) -> Column:
    """Size of a row of `table`."""

    def width(field: T.StructField) -> Column:
        column = F.col(field.name)
        if isinstance(field.dataType, T.StringType):
            return F.coalesce(F.octet_length(column), F.lit(0)) + 16
        if isinstance(field.dataType, T.StructType):
            return F.coalesce(F.octet_length(F.to_json(column)), F.lit(0)) + 16
        if isinstance(field.dataType, T.ArrayType):
            item = 32 if isinstance(field.dataType.elementType, T.StringType) else 8
            return F.coalesce(F.size(column), F.lit(0)) * item + 16
        return F.lit(8)

    widths = [width(field) for field in table.schema.fields]
    return (sum(widths[1:], widths[0]) + 16).cast("bigint")


def table_bytes(table: DataFrame) -> int:
    """Size of the rows of `table`, measured in one pass."""
    return table.agg(F.sum(row_bytes(table))).first()[0] or 0


def fits_broadcast(table: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    return table_bytes(table) <= limit


def lookup_join(
    rows: DataFrame,
    table: DataFrame,
    on: str,
    spread: str | Sequence[str],
    how: str = "inner",
    broadcast: bool | None = None,
    salts: int = SALTS,
    hot_rows: int = HOT_ROWS,
    head_bytes: int = 0,
) -> DataFrame:
    """Equi-join of many `rows` with a lookup `table` that is unique on `on`.

    A table measured to be within the broadcast limit is broadcast, so `rows` do not move.
    Of a larger one, inner-joined, the rows used most are broadcast (`head_bytes`, or half of
    the table if that is less), so only rows with rarer keys are joined by shuffle on the key.
    Keys with many rows are found by a count first; they alone get a salt taken from the `spread` columns, so that a hot key is shared
    out over one task per `hot_rows` of its rows (or per HOT_KEYS-th of all rows), and only
    its row of the table is copied as often. Rows without a key are spread over `salts`.
    """
    if broadcast is None:
        broadcast = fits_broadcast(table)
    if broadcast:
        return rows.join(F.broadcast(table), on, how)
    spread = [spread] if isinstance(spread, str) else list(spread)
    counts = None
    if head_bytes and how == "inner":
        counts = cut_lineage(_counted(rows, on))
        common = most_used(None, table, on, min(head_bytes, table_bytes(table) // 2), counts)
        common = F.broadcast(common)
        head = rows.join(F.broadcast(table.join(common, on, "left_semi")), on)
        counts = counts.join(common, on, "left_anti")
        rows, table = rows.join(common, on, "left_anti"), table.join(common, on, "left_anti")
    hot = _hot_keys(rows, on, hot_rows, counts)
    own = F.coalesce("_salts", F.when(F.col(on).isNull(), salts), F.lit(1))
    salted_rows = rows.join(F.broadcast(hot), on, "left").withColumn(
        "_salt", F.pmod(F.xxhash64(*spread), own).cast("int")
    )
    salted_table = table.join(F.broadcast(hot), on, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
    )
    joined = salted_rows.drop("_salts").join(salted_table.drop("_salts"), [on, "_salt"], how)
    joined = joined.drop("_salt")
    return joined if counts is None else head.unionByName(joined)


def list_counts(rows: DataFrame, lists: str, name: str, count: str = "_n") -> DataFrame:
    """(name, count): how often each entry occurs in the lists of a column.

    Arrow batches count their own entries where they stand, so one row per entry and batch is
    grouped, and no row per occurrence is made.
    """
    kind = rows.schema[lists].dataType.elementType
    schema = T.StructType([T.StructField(name, kind), T.StructField(count, T.LongType())])
    entry = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pc.value_counts(batch.column(0).flatten())
            yield pa.RecordBatch.from_arrays(
                [found.field("values").cast(entry), found.field("counts")], names=[name, count])

    partial = rows.select(lists).mapInArrow(run, schema)
    return partial.groupBy(name).agg(F.sum(count).alias(count))


def entries_by_key(
    rows: DataFrame, key: str, lists: str, entry: str = "word", count: str = "tf"
) -> DataFrame:
    """(key, entry, count): how often each entry occurs in all lists of a key.

    Rows count their own lists in Arrow batches where they stand, so no pair is shuffled. Only
    the rows of keys that come more than once, told by the keys alone, are grouped.
    """
    def grouped(some: DataFrame) -> DataFrame:
        return some.select(key, F.explode(lists).alias(entry)).groupBy(key, entry).agg(
            F.count(F.lit(1)).alias(count))

    kinds = rows.schema[key].dataType, rows.schema[lists].dataType.elementType
    if not (_countable(kinds[0]) and _countable(kinds[1])):
        return grouped(rows)
    schema = T.StructType([
        T.StructField(key, kinds[0]), T.StructField(entry, kinds[1]), T.StructField(count, T.LongType())])
    repeated = cut_lineage(rows.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
                           .filter("_n > 1").select("_key", F.lit(True).alias("_again")))
    rows = rows.select(key, lists)
    if repeated.isEmpty():
        return rows.mapInArrow(_own_counts(schema), schema)
    few = F.broadcast(repeated) if fits_broadcast(repeated) else repeated
    same = rows[key].eqNullSafe(few["_key"])
    once, again = (rows.join(few, same, how) for how in ("left_anti", "left_semi"))
    return once.mapInArrow(_own_counts(schema), schema).unionByName(grouped(again))


def _countable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_countable(field.dataType) for field in kind.fields)
    return isinstance(kind, (T.IntegralType, T.DateType)) or kind == T.StringType()


def _codes(values: pa.Array) -> tuple[np.ndarray, int]:
    """A number per value, the same for equal ones only, and how many there are at most."""
    if not pa.types.is_struct(values.type):
        found = values.dictionary_encode(null_encoding="encode")
        return found.indices.to_numpy().astype(np.int64), len(found.dictionary)
    codes, n = pc.is_null(values).to_numpy(zero_copy_only=False).astype(np.int64), 2
    for field in values.flatten():
        own, n_own = _codes(field)
        _, codes = np.unique(codes * n_own + own, return_inverse=True)
        n = int(codes.max(initial=-1)) + 1
    return codes, n


def _own_counts(schema: T.StructType):
    """Arrow batches of (key, list) -> a row per batch row and different entry of its list."""
    kinds = [to_arrow_type(field.dataType) for field in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            lengths = pc.fill_null(pc.list_value_length(whole.column(1)), 0).to_numpy(zero_copy_only=False)
            ends, at = np.cumsum(lengths, dtype=np.int64), 0
            while at < len(ends):
                begun = ends[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(ends, begun + CELLS, "right")))
                batch, own = whole.slice(at, to - at), lengths[at:to]
                at = to
                flat = batch.column(1).flatten()
                codes, n = _codes(flat)
                rows = np.repeat(np.arange(batch.num_rows, dtype=np.int64), own)
                _, first, counts = np.unique(rows * n + codes, return_index=True, return_counts=True)
                arrays = [batch.column(0).take(pa.array(rows[first])), flat.take(pa.array(first)), pa.array(counts)]
                arrays = [a if a.type == kind else a.cast(kind) for a, kind in zip(arrays, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return run


def _counted(rows: DataFrame, on: str) -> DataFrame:
    """(key, `_n`): how many rows have each key."""
    return rows.filter(F.col(on).isNotNull()).groupBy(on).agg(F.count(F.lit(1)).alias("_n"))


def _hot_keys(rows: DataFrame, on: str, least: int, counts: DataFrame | None = None) -> DataFrame:
    """(key, `_salts`) of every key with more than `least` rows, or than a HOT_KEYS-th of all
    rows if that is more; salts in proportion to the rows. Written once for both sides."""
    counts = _counted(rows, on) if counts is None else counts
    total = counts.agg(F.sum("_n")).first()[0] or 0
    least = max(least, -(-total // HOT_KEYS), 1)
    hot = counts.filter(F.col("_n") > least).select(on, F.ceil(F.col("_n") / least).cast("int").alias("_salts"))
    return cut_lineage(hot)


def most_used(
    uses: DataFrame | None, table: DataFrame, on: str, limit: int, counts: DataFrame | None = None
) -> DataFrame:
    """The keys of `table` that `uses` (one row per use of a key; or their `counts`) names
    most, as many as have rows of up to `limit` bytes. Bounded, and written once; only keys
    and sizes are moved."""
    counts = _counted(uses, on) if counts is None else counts
    sized = table.select(on, row_bytes(table).alias("_bytes")).join(counts, on)
    # Classes of about equal use, so that few numbers tell where the limit is reached.
    sized = cut_lineage(sized.select(on, "_bytes", F.floor(F.log2("_n") * 16).cast("int").alias("_class")))
    left, least = limit, None
    for row in sized.groupBy("_class").agg(F.sum("_bytes").alias("bytes")).orderBy(F.desc("_class")).collect():
        left -= row["bytes"]
        if left < 0:
            break
        least = row["_class"]
    return sized.filter(F.col("_class") >= least if least is not None else F.lit(False)).select(on)


def rows_by_id(
    table: DataFrame, wanted: DataFrame, on: str = "id", max_pushed: int = PUSHED_IDS
) -> DataFrame:
    """Inner join of `wanted` (few rows) with the rows of a large `table` that have its ids.

    Up to `max_pushed` rows, their ids are also handed to the scan as an IN list, so that
    row groups without them are never read. `wanted` is broadcast when it is that short or
    measured to be small enough, so that the large table does not move, else joined by
    shuffle. `wanted` is evaluated more than once, so it should be cheap or already written.
    """
    head = [row[0] for row in wanted.select(on).limit(max_pushed + 1).collect()]
    short = len(head) <= max_pushed
    if short:
        ids = sorted({i for i in head if i is not None})
        table = table.filter(F.col(on).isin(ids) if ids else F.lit(False))
    if short or fits_broadcast(wanted):
        wanted = F.broadcast(wanted)
    return wanted.join(table, on)
