"""Compression of vectors to codes: product codebooks of integers, fitted and looked up by dictionaries of values."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import discard, join_frequent, map_arrow, quoted, schema_with, stage, unused, with_columns

#: Components become integers at this scale.
SCALE = 4096
#: A block has at most so many rows and about so many components.
BLOCK_ROWS, BLOCK_COMPONENTS = 1 << 16, 1 << 20
NEW = "code string, error bigint, label_error bigint, codebooks_sha256 string"

#: A codebook: the entries of each part, each a list of integers of any size.
Codebooks = list[list[list[int]]]


def whole_vectors(vectors: DataFrame, vector: str) -> DataFrame:
    """The rows whose vector is there and has only finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.filter(F.coalesce(finite, F.lit(False)))


class Block:
    """Vectors of one length as dictionaries: for each dimension its distinct integers, and each row's place among them."""

    def __init__(self, codes: np.ndarray, first: np.ndarray, values: np.ndarray):
        self.codes, self.first, self.values = codes, first, values
        self.dimensions, self.n = codes.shape
        self.most = int(max(abs(values).max(), 0)) if len(values) else 0

    @classmethod
    def of(cls, x: np.ndarray) -> Block:
        """x: rows of integers as doubles, which hold all integers that a scaled component can be."""
        found = [np.unique(column, return_inverse=True) for column in x.T]
        codes = np.array([places for _, places in found], dtype=np.uint16).reshape(x.shape[1], len(x))
        first = np.concatenate([[0], np.cumsum([len(v) for v, _ in found])]).astype(np.int64)
        return cls(codes, first, np.concatenate([v for v, _ in found]) if found else np.zeros(0))

    def dictionary(self, d: int, kind: type) -> np.ndarray:
        own = self.values[self.first[d] : self.first[d + 1]]
        return np.array([int(v) for v in own], dtype=object) if kind is object else own.astype(np.int64)

    def nearest(self, books: Codebooks) -> tuple[np.ndarray, np.ndarray]:
        """Each row's entry in each part (parts x rows), and its squared distances together.

        Squared differences of a dimension's distinct integers to all entries are tabulated; a part's distances are
        sums of what the rows' codes pick there. Numbers that may not fit in 64 bits are Python's.
        """
        width = self.dimensions // len(books)
        most = max([self.most, *(abs(v) for book in books for entry in book for v in entry)])
        kind = np.int64 if (2 * most) ** 2 * max(1, self.dimensions) < 2**63 else object
        picked, total = np.zeros((len(books), self.n), dtype=np.int64), np.zeros(self.n, dtype=kind)
        for part, book in enumerate(books):
            far = np.zeros((self.n, len(book)), dtype=kind)
            for d in range(width):
                entries = np.array([entry[d] for entry in book], dtype=kind)
                table = (self.dictionary(part * width + d, kind)[:, None] - entries[None, :]) ** 2
                far += table[self.codes[part * width + d]]
            picked[part] = far.argmin(axis=1)
            total += far[np.arange(self.n), picked[part]]
        return picked, total

    def sums(self, picked: np.ndarray, entries: int) -> tuple[np.ndarray, np.ndarray]:
        """How many rows pick each entry (parts x entries), and their sums (dimensions x entries), as Python's integers."""
        parts = len(picked)
        count = np.array([np.bincount(p, minlength=entries) for p in picked])
        width = self.dimensions // parts
        out = np.zeros((self.dimensions, entries), dtype=object)
        for d in range(self.dimensions):
            own = self.dictionary(d, object)
            # how often each integer is with each entry, so that sums run over the dictionary
            met = np.bincount(self.codes[d].astype(np.int64) * entries + picked[d // width], minlength=len(own) * entries)
            at = np.flatnonzero(met)
            np.add.at(out[d], at % entries, own[at // entries] * met[at].astype(object))
        return count, out


def _blocks(vectors: DataFrame, vector: str, length: int) -> DataFrame:
    """Blocks of rows: the rows themselves without the vector as Arrow data, and the dictionaries of those of this length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = max(1, min(BLOCK_ROWS, BLOCK_COMPONENTS // max(1, length)))
        for batch in batches:
            for lo in range(0, batch.num_rows, most):
                part = batch.slice(lo, most)
                rows, column = part.drop_columns([vector]), part.column(vector)
                fits = np.array([len(v) == length for v in column], dtype=bool)
                flat = column.filter(pa.array(fits)).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                block = Block.of(np.floor(SCALE * flat).reshape(int(fits.sum()), length))
                out = pa.BufferOutputStream()
                with pa.ipc.new_stream(out, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
                    stream.write_batch(rows)
                cells = [out.getvalue().to_pybytes(), np.packbits(fits).tobytes(), block.codes.tobytes(), block.first.tobytes(), block.values.tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in cells], names=names)

    names = ["rows", "fits", "codes", "first", "values"]
    return map_arrow(vectors, run, ", ".join(f"{n} binary" for n in names))


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Block]]:
    for batch in batches:
        for row in batch.to_pylist():
            first = np.frombuffer(row["first"], np.int64)
            codes = np.frombuffer(row["codes"], np.uint16)
            yield row, Block(codes.reshape(len(first) - 1, -1) if len(first) > 1 else np.zeros((0, 0), np.uint16), first, np.frombuffer(row["values"]))


def _round(blocks: DataFrame, books: Codebooks) -> Codebooks:
    """The entries after one more round: means of the parts that are nearest to each, rounded down; unused ones stay."""
    parts, entries, width = len(books), len(books[0]), len(books[0][0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros((parts, entries), dtype=object), np.zeros((parts * width, entries), dtype=object)
        for _, block in _unpacked(batches):
            if block.dimensions:
                more = block.sums(block.nearest(books)[0], entries)
                count, total = count + more[0], total + more[1]
        part, entry = np.nonzero(count)
        sums = [[Decimal(int(total[p * width + d, e])) for d in range(width)] for p, e in zip(part, entry, strict=True)]
        at = pa.array(np.repeat(part, width), pa.int32()), pa.array(np.repeat(entry, width), pa.int32()), pa.array(np.tile(np.arange(width), len(part)), pa.int32())
        counts = [int(count[p, e]) for p, e in zip(part, entry, strict=True) for _ in range(width)]
        yield pa.RecordBatch.from_arrays([*at, pa.array(counts, pa.int64()), pa.array([v for x in sums for v in x], pa.decimal128(38, 0))], names=["part", "entry", "position", "n", "total"])

    found = map_arrow(blocks.drop("rows", "fits"), run, "part int, entry int, position int, n bigint, total decimal(38,0)")
    # a number for each component of the codebooks comes to the driver, however many vectors there are
    new = [[list(e) for e in book] for book in books]
    for r in found.groupBy("part", "entry", "position").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
        new[r.part][r.entry][r.position] = int(r.total) // r.n
    return new


def _assigned(blocks: DataFrame, books: Codebooks, rest: DataFrame) -> DataFrame:
    """The columns of rest with code and error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, block in _unpacked(batches):
            rows = pa.ipc.open_stream(row["rows"]).read_next_batch()
            fits = np.unpackbits(np.frombuffer(row["fits"], np.uint8), count=rows.num_rows).astype(bool)
            code, error = np.full(rows.num_rows, None, dtype=object), np.full(rows.num_rows, None, dtype=object)
            if block.dimensions:
                picked, total = block.nearest(books)
                code[fits] = [bytes(p).hex() for p in picked.T.astype(np.uint8)]
                error[fits] = [int(e) if e < 2**63 else None for e in total]
            elif fits.any():  # vectors without components
                code[fits], error[fits] = "00" * len(books), 0
            yield with_columns(rows, ["code", "error"], [pa.array(code.tolist(), pa.string()), pa.array(error.tolist(), pa.int64())])

    return map_arrow(blocks, run, schema_with(rest, "code string, error bigint"))


def compress_vectors(vectors: DataFrame, ident: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = 8, entries: int = 16, rounds: int = 6) -> DataFrame:
    """vectors, without the vector, with a code of two hexadecimal digits for each part, and the squared error.

    Components become integers, floor(SCALE x). Each part's codebook starts with the parts of the vectors of the
    smallest idents (ties by the vector itself, NULL idents last), and is fitted in `rounds` rounds over all vectors; ties
    in distance go to the lower entry. label_error is the error of all vectors of a label, codebooks_sha256 a digest
    of all final entries.

    Rows with a NULL vector, or with NULL, NaN or infinite components, go. A vector of another length than the one of
    the smallest ident stays with NULL for code and error; its length must be a multiple of parts. Repeated rows are
    rows of their own. Fewer vectors than entries give fewer entries; an empty table gives no rows. An error of 2^63
    or more, and a sum with one, is NULL. Other columns pass through; the new names replace columns of these names.
    """
    if not 0 < entries <= 256:
        raise ValueError("entries have two hexadecimal digits")
    kept = whole_vectors(vectors, vector)
    first = [r[0] for r in kept.select(F.col(quoted(vector)).alias("v")).orderBy(F.col(quoted(ident)).asc_nulls_last(), "v").limit(entries).collect()]
    length = len(first[0]) if first else 0
    if length % parts:
        raise ValueError(f"vectors of {length} components have no {parts} equal parts")
    start = [[int(np.floor(SCALE * np.float64(x))) for x in v] for v in first if len(v) == length]
    width = length // parts
    books: Codebooks = [[v[p * width : (p + 1) * width] for v in start] for p in range(parts)]
    group, own = unused(vectors.columns, "__label"), unused(vectors.columns, "__vector")
    given = kept.withColumns({group: F.col(quoted(label)), own: F.col(quoted(vector))}).drop(vector)
    rest = given.drop(own)
    blocks = stage(_blocks(given, own, length), "vector-blocks")
    for _ in range(rounds if length and start else 0):
        books = _round(blocks, books)
    digest = hashlib.sha256(",".join(str(v) for book in books for entry in book for v in entry).encode()).hexdigest()
    coded = stage(_assigned(blocks, books, rest), "vector-codes")
    discard(blocks)
    whole = F.when(F.count("error") == F.count("*"), F.expr("try_cast(sum(cast(error as decimal(38,0))) as bigint)"))
    sums = coded.groupBy(group).agg(whole.alias("label_error"), F.count("*").alias("n"))
    out = join_frequent(coded.drop("label_error", "codebooks_sha256"), sums, group, "n").withColumn("codebooks_sha256", F.lit(digest))
    return out.select(*map(quoted, schema_with(vectors.drop(vector), NEW).names))
