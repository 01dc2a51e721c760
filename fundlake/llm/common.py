"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundlake.session import remove_path, work_path

#: Text bytes handled at once inside a task; bounds the temporary arrays.
SLICE_BYTES = 4 << 20

WHITESPACE = bytes([0x20, *range(0x09, 0x0E)])


def _table(separators: bytes) -> bytes:
    table = bytearray(range(256))
    for c in range(ord("A"), ord("Z") + 1):
        table[c] = c + 32
    for c in separators:
        table[c] = 0x20
    return bytes(table)


#: Byte tables that lower-case A-Z and turn separators into spaces. Bytes of
#: non-ASCII characters stay as they are, so whole UTF-8 texts can be mapped.
BY_SPACE = _table(WHITESPACE)
BY_ALNUM = _table(bytes(c for c in range(128)
                        if not (0x30 <= c <= 0x39 or 0x41 <= c <= 0x5A or 0x61 <= c <= 0x7A)))


def write_once(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` to the shared work folder and read it back: later readers
    do not recompute it, and a lost executor cannot take it away. ``codec`` is
    Parquet's (None: the session's); whole texts take less disk under zstd."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Names that Hadoop gives to stores, and Arrow's.
STORES = {"s3a": "s3", "s3n": "s3", "abfss": "abfs", "gs": "gs", "hdfs": "hdfs"}


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a shared-folder URI, as seen from any executor."""
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    scheme, _, rest = uri.partition("://")
    uri = f"{STORES.get(scheme, scheme)}://{rest}"
    return pafs.FileSystem.from_uri(uri)


def text_slices(column: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, bytes]]:
    """Cut a text column into runs of rows of about ``limit`` bytes: (first row,
    byte offsets, bytes). Null texts are empty; one longer text is a run of its own."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = pc.fill_null(column, "")
    n = len(column)
    if not n:
        return
    _, offsets_buf, data_buf = column.buffers()
    offsets = np.frombuffer(offsets_buf, np.int64)[column.offset:column.offset + n + 1]
    data = memoryview(data_buf) if data_buf is not None else memoryview(b"")
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield at, offsets[at:to + 1] - offsets[at], bytes(data[offsets[at]:offsets[to]])
        at = to


class Words:
    """The words of some texts, found by byte tests on the whole run at once.

    ``starts``/``ends`` are byte positions in ``data`` (lower-cased, separators
    as spaces); ``doc_first[i]:doc_first[i+1]`` are the words of text ``i``."""

    def __init__(self, offsets: np.ndarray, data: bytes, table: bytes):
        self.data = data.translate(table)
        b = np.frombuffer(self.data, np.uint8)
        inside = b != 0x20
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        bounds = offsets[1:-1]
        bounds = bounds[bounds < len(b)]
        first[bounds] = inside[bounds]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        inner = bounds[bounds > 0]
        last[inner - 1] = inside[inner - 1]
        self.inside = inside
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        self.doc_first = np.searchsorted(self.starts, offsets, "left")

    def strings(self) -> pa.LargeStringArray | pa.LargeBinaryArray:
        """The words as an Arrow array (separators squeezed out)."""
        kept = np.frombuffer(self.data, np.uint8)[self.inside]
        ends = np.cumsum(self.ends - self.starts)
        offsets = np.concatenate([[0], ends]).astype(np.int64)
        return pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(self.starts), [None, pa.py_buffer(offsets), pa.py_buffer(kept)])

    def coded(self) -> tuple[np.ndarray, pa.Array]:
        """Word numbers and the distinct words they stand for."""
        d = self.strings().dictionary_encode()
        return d.indices.to_numpy(zero_copy_only=False).astype(np.int64), d.dictionary


def ranges(firsts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """firsts[0], firsts[0]+1, ... (counts[0] numbers), firsts[1], ..."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(counts)
    return np.arange(total) + np.repeat(firsts - (ends - counts), counts)


def range_prefix(df: DataFrame, order: list[Column], partitions: int, size: str, out: str,
                 name: str, by: str | None = None) -> DataFrame:
    """Running sum of ``size`` before each row in a global order, without one
    task seeing all rows: range partition and sort, sum inside each partition,
    then add the totals of the partitions before (one row each).

    With ``by`` (the leading order column), the sum starts anew for each of its
    values. Null sizes count as zero. The sorted rows are written once."""
    schema = T.StructType([*df.schema.fields, T.StructField("_pid", T.IntegerType()), T.StructField("_local", T.LongType())])
    arranged = df.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    at_size, at_by = df.columns.index(size), df.columns.index(by) if by else None

    def running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        pid, total, key, begun = TaskContext.get().partitionId(), 0, None, False
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            sizes = pc.fill_null(batch.column(at_size), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            before = np.cumsum(sizes) - sizes
            if at_by is None:
                local = before + total
                total += int(sizes.sum())
            else:
                keys = batch.column(at_by)
                codes = pc.fill_null(keys.dictionary_encode().indices, -1).to_numpy(zero_copy_only=False)
                cut = np.concatenate([[True], codes[1:] != codes[:-1]])
                head = np.maximum.accumulate(np.where(cut, np.arange(n), 0))
                local = before - before[head]
                if begun and keys[0].as_py() == key:
                    local[head == 0] += total
                key, begun = keys[n - 1].as_py(), True
                total = int(local[-1] + sizes[-1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(n, pid), pa.int32()), pa.array(local, pa.int64())],
                names=[*batch.schema.names, "_pid", "_local"])

    placed = write_once(arranged.mapInArrow(running, schema), name)
    keys = [by] if by else []
    totals = placed.groupBy("_pid", *keys).agg(F.sum(F.coalesce(F.col(size), F.lit(0))).alias("_sum"))
    # At most one row per partition and key that it holds: partitions plus keys.
    earlier = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(F.col("_pid").alias("_p"), *[F.col(k).alias("_k") for k in keys],
                           F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    on = placed["_pid"] == before["_p"]
    if by:
        on = on & placed[by].eqNullSafe(before["_k"])
    else:
        before = F.broadcast(before)  # one row per partition
    return placed.join(before, on).withColumn(out, F.col("_local") + F.col("_before")) \
        .drop("_pid", "_local", "_p", "_k", "_before")


#: Array items folded before what they gave is joined to the rest.
FOLD_BLOCK = 1024


def fold_rows(items: Column, first: Column, kind: str, step: Callable[[Column, Column], tuple[Column, Column]]) -> Column:
    """The rows (array type ``kind``) that a walk over an array gives: ``step(state,
    item)`` returns the next state and the item's rows. Items go in blocks, so a
    long result is not copied for every item."""
    none = F.array().cast(kind)

    def add(a: Column, x: Column) -> Column:
        state, rows = step(a["state"], x)
        return F.struct(state.alias("state"), F.concat(a["out"], rows).alias("out"))

    def block(a: Column, xs: Column) -> Column:
        done = F.aggregate(xs, F.struct(a["state"].alias("state"), none.alias("out")), add)
        return F.transform(F.array(done), lambda d: F.struct(d["state"].alias("state"), F.concat(a["out"], d["out"]).alias("out")))[0]

    blocks = F.transform(F.array(items), lambda xs: F.transform(
        F.sequence(F.lit(0), F.floor(F.size(xs) / FOLD_BLOCK).cast("int")), lambda b: F.slice(xs, b * FOLD_BLOCK + 1, F.lit(FOLD_BLOCK))))[0]
    return F.aggregate(blocks, F.struct(first.alias("state"), none.alias("out")), block, lambda a: a["out"])


def partitions_for(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def map_texts(docs: DataFrame, text_col: str, carry: list[str], fields: str, work) -> DataFrame:
    """Row-wise Arrow work on a text column. ``work(offsets, data)`` gets a run
    of texts and returns the Arrow columns of ``fields``; each output row is
    ``row`` (the carried columns as a struct, so no name can clash) and these."""
    given = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.col(text_col).cast("string").alias("text"))
    extra = T.StructType.fromDDL(fields)
    schema = T.StructType([given.schema["row"], *extra.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, offsets, data in text_slices(batch.column(1)):
                n = len(offsets) - 1
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, n), *work(offsets, data)],
                                                 names=["row", *extra.names])

    return given.mapInArrow(run, schema)
