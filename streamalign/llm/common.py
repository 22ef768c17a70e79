"""Shared helpers of the corpus operators: staging, text buffers and vectorised word handling."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from ..functions.shipped import ship as ship

#: A word is a longest run of characters outside this class.
WORD = r"[^\x20\x09-\x0D]+"

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_MASK = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)
_K1, _K2, _K3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F))
_S32, _S29 = np.uint64(32), np.uint64(29)
_PAD = 64


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share; a temporary one only in local mode without such a setting."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if path:
        return path
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="spark-")
    spark.sparkContext.setCheckpointDir(path)
    return spark.sparkContext.getCheckpointDir()


def stage(df: DataFrame, name: str) -> DataFrame:
    """Writes df as a table in the shared folder and reads it back, which cuts its lineage."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    staged.staged_path = path
    return staged


def discard(*staged: DataFrame) -> None:
    """Removes the files of staged tables that nothing will read again."""
    for df in staged:
        jvm = df.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(df.staged_path)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Lets Spark's cleaner drop the shuffle files of steps that are written and done with."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def numbered(df: DataFrame) -> DataFrame:
    """df, written and read back, with a number of its own for each row in a last column of an unused name."""
    return stage(df.withColumn(unused(df.columns, "__row"), F.monotonically_increasing_id()), "rows")


def stage_by(df: DataFrame, name: str, column: str, n: int) -> DataFrame:
    """As stage, in n buckets of column, so that grouping by it needs no shuffle of these rows.

    The table's entry in the catalog goes at once; its files stay in the shared folder.
    """
    spark = df.sparkSession
    entry = f"{name}_{uuid.uuid4().hex}"
    df.write.bucketBy(n, column).option("path", f"{shared_dir(spark)}/{entry}").saveAsTable(entry)
    staged = spark.table(entry)
    staged.schema  # noqa: B018  resolves the table before its entry goes
    spark.sql(f"DROP TABLE {entry}")
    return staged


#: Rows of a few numbers that are broadcast at most.
BROADCAST_ROWS = 1_000_000


def if_small(df: DataFrame) -> DataFrame:
    """df, marked for broadcast if a count finds that it has at most BROADCAST_ROWS rows; joins shuffle it otherwise."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def unused(names: list[str], base: str) -> str:
    """base, lengthened until no name begins with it in any case."""
    while any(n.lower().startswith(base) for n in names):
        base += "_"
    return base


def quoted(name: str) -> str:
    return "`{}`".format(name.replace("`", "``"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def give_back() -> None:
    """Returns to the machine what this Python worker has freed, since Spark keeps workers for later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


@contextmanager
def batches_up_to(spark: SparkSession, size: str) -> Iterator[None]:
    """Jobs that run meanwhile hand rows to Python in Arrow batches of about this size at most."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, size)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def map_arrow(df: DataFrame, run: Callable, schema: str | StructType) -> DataFrame:
    """mapInArrow by a function of this package; names that Spark would parse are plain ones meanwhile."""

    def lean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    ship(df.sparkSession)
    if isinstance(schema, str) or not any(map(_is_odd, df.columns)):
        return plain_names(df).mapInArrow(lean, schema)
    fields = [StructField(_plain(f.name), f.dataType) for f in schema]
    return plain_names(df).mapInArrow(lean, StructType(fields)).toDF(*schema.names)


def _is_odd(name: str) -> bool:
    return "." in name or "`" in name


def _plain(name: str) -> str:
    return f"__odd_{name.encode().hex()}" if _is_odd(name) else name


def plain_names(df: DataFrame) -> DataFrame:
    """df with names that have dots or backticks replaced by plain ones."""
    return df.toDF(*map(_plain, df.columns)) if any(map(_is_odd, df.columns)) else df


def to_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of each value; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def groups(values: list, most: int, size: Callable = len) -> Iterator[tuple[int, int]]:
    """Index ranges of consecutive values with about `most` bytes together; a longer value stands alone."""
    lo = total = 0
    for i, x in enumerate(values):
        n = size(x)
        if total and total + n > most:
            yield lo, i
            lo, total = i, 0
        total += n
    if lo < len(values):
        yield lo, len(values)


class Texts:
    """Texts in one byte buffer, a space before and after each; `start` and `end` bound each text."""

    def __init__(self, values: list[bytes], lower: bool = False):
        self.n = len(values)
        self.buf = np.frombuffer(b" " + b" ".join(values) + b" " * (_PAD + 1), dtype=np.uint8)
        if lower:
            self.buf = LOWER[self.buf]
        self.len = np.fromiter(map(len, values), dtype=np.int64, count=self.n)
        self.end = np.cumsum(self.len + 1)
        self.start = self.end - self.len

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end of each word, and the index of the first word of each text (and one more at the end)."""
        space = IS_SPACE[self.buf]
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        start, end = edge[0::2], edge[1::2]
        return start, end, np.append(np.searchsorted(start, self.start), len(start))


def at8(buf: np.ndarray) -> np.ndarray:
    """A view that has the 8 bytes from each position on as one little-endian number."""
    return np.ndarray((max(0, len(buf) - 7),), dtype="<u8", buffer=buf, strides=(1,))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers; x is overwritten."""
    x ^= x >> _S32
    x *= _K2
    x ^= x >> _S29
    x *= _K3
    x ^= x >> _S32
    return x


def span_hash(buf: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes; buf needs 8 bytes after the last span."""
    view = at8(buf)
    h = mix(size.astype(np.uint64) * _K1 + _K3)
    live, at = None, 0
    todo = size
    pos = start
    while len(pos):
        h_now = h if live is None else h[live]
        word = view[pos + at] & _MASK[np.minimum(todo - at, 8)]
        h_now = mix((h_now + word) * _K1)
        if live is None:
            h = h_now
        else:
            h[live] = h_now
        at += 8
        more = np.flatnonzero(todo > at)
        live = more if live is None else live[more]
        pos, todo = pos[more], todo[more]
    return h


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of ordered pairs of hashes."""
    return mix(a * _K1 + (b ^ (b >> _S29)) * _K3 + _K2)


def per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of values between consecutive bounds in `first`, 0 for empty ranges."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[first[1:]] - total[first[:-1]]


def _others(names: list[str], new: list[str]) -> list[str]:
    taken = {n.lower() for n in new}
    return [n for n in names if n.lower() not in taken]


def with_columns(batch: pa.RecordBatch, names: list[str], columns: list[pa.Array]) -> pa.RecordBatch:
    """batch with these columns at its end; they take the place of columns of the same name in any case."""
    kept = _others(batch.schema.names, names)
    return pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), *columns], names=[*kept, *names])


def schema_with(df: DataFrame, added: str) -> StructType:
    """The schema of what with_columns makes of df's rows."""
    new = StructType.fromDDL(added).fields
    kept = set(_others(df.columns, [f.name for f in new]))
    return StructType([StructField(f.name, f.dataType) for f in df.schema if f.name in kept] + new)


def gathered(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """The rows of small batches in larger ones, with up to `most` bytes of `text`; a larger batch stands alone."""
    held, total = [], 0
    for batch in batches:
        n = batch.column("text").nbytes
        if held and total + n > most:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, total = [], 0
        held.append(batch)
        total += n
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def pack_chunks(df: DataFrame, chunk_bytes: int, gather: bool = False) -> DataFrame:
    """Whole rows of df, with about chunk_bytes of `text` together, as compressed Arrow data: chunk_id, payload.

    The ids follow from the partition and the order in it; write the result before using it twice. gather: a chunk's
    rows may come in several Arrow batches.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        chunk = TaskContext.get().partitionId() << 32
        for batch in gathered(batches, chunk_bytes) if gather else batches:
            for lo, hi in groups(to_bytes(batch.column("text")), chunk_bytes):
                out = pa.BufferOutputStream()
                with pa.ipc.new_stream(out, batch.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=6))) as stream:
                    stream.write_batch(batch.slice(lo, hi - lo))
                yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([out.getvalue().to_pybytes()], pa.binary())], names=["chunk_id", "payload"])
                chunk += 1

    return map_arrow(df, run, "chunk_id bigint, payload binary")


def unpack_chunk(payload: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(payload).read_next_batch()


def text_bytes(df: DataFrame) -> int:
    """UTF-8 bytes of all texts together."""
    return df.selectExpr("coalesce(sum(octet_length(text)), 0L) AS n").first().n


def join_frequent(df: DataFrame, counted: DataFrame, key: str, n: str) -> DataFrame:
    """df with the columns of counted (one row for each value of key in df, which has n rows there), but n.

    All of counted is broadcast if it is small. Else the values that are frequent are, and only the rest is shuffled:
    none of these has many rows, so no task gets a hot one.
    """
    counted = stage(counted, "counted")
    if counted.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        sides = [F.broadcast(counted)]
    else:
        powers = counted.groupBy(F.floor(F.log2(n)).alias("power")).agg(F.count("*").alias("values")).collect()  # up to 64 rows
        frequent, found = 64, 0
        for r in sorted(powers, key=lambda r: -r.power):
            found += r["values"]
            if found > BROADCAST_ROWS:
                break
            frequent = r.power
        often = F.floor(F.log2(n)) >= frequent
        sides = [F.broadcast(counted.filter(often)), counted.filter(~often)]
    other = unused([*df.columns, *counted.columns], "__other")
    joined = None
    for side in sides:
        part = df.join(side.withColumnRenamed(key, other), F.col(quoted(key)).eqNullSafe(F.col(other))).drop(other, n)
        joined = part if joined is None else joined.unionByName(part)
    return joined
