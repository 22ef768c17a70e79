"""Removal of passages that occur in an earlier document, by sorted suffixes built column by column.

The method inserts one symbol of every string per round, first the last ones; a round sorts the strings stably by the
symbol it inserts, which is where the new suffixes stand in the Burrows-Wheeler order, and common prefixes of
neighbours follow. Over whole documents it needs as many rounds as the longest document has bytes, each a pass over
the transform of all text. Only common prefixes of `length` bytes matter here, so the strings are not documents but
the stretches around an anchor that cover all windows of `length` bytes belonging to it. The anchor of a window is
the least of the hashes of its GRAM-byte strings, the leftmost of equals: equal windows have it at the same place, so
all copies of a window meet in the bucket of the anchor's hash. A bucket is one sequential file of the method.

The windows of a frequent anchor are dealt out further, to buckets that follow from where they have the anchor and
from the bytes around it, so that an anchor that stands in very many different places is no single task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import IntegralType, StructType

from .common import Texts, at8, batches_up_to, give_back, map_arrow, mix, pack_chunks, pair_hash, plain_names, ship, span_hash, stage, stage_by, text_bytes, to_bytes, unpack_chunk, unused

GRAM = 16
#: Text in one chunk, whose repeats are joined before anything is sent, and per bucket on average.
CHUNK_BYTES, BUCKET_BYTES = 8 << 20, 4 << 20
#: Rows and chunks come to Python in Arrow batches of this size; a chunk is made of several.
BATCH = "2m"
#: An anchor is frequent from HOT on, a chunk that has it counting 1, or MANY if it has it that often.
HOT, MANY = 1024, 64
#: Ranges of places in a window that a frequent anchor is split by.
PARTS = 4
_SLICE = 1 << 17
_POS = np.uint64((1 << 28) - 1)
_SEVERAL, _MANY, _FLAGS = np.uint64(1), np.uint64(2), np.uint64(3)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_NULL_ID = np.iinfo(np.int64).max


def _anchors(t: Texts, length: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: first window, number of windows, anchor, its hash, and the text's index."""
    span = length - GRAM + 1
    ok = np.zeros(len(t.buf) + 1, dtype=np.int8)
    long = t.len >= length
    ok[t.start[long]] += 1
    np.add.at(ok, t.end[long] - length + 1, -1)
    ok = np.cumsum(ok, dtype=np.int8, out=ok).view(bool)
    view = at8(t.buf)
    out: list[list[np.ndarray]] = [[], [], [], []]
    for a in range(0, len(t.buf), _SLICE):
        b = min(a + _SLICE, len(t.buf) - length)
        inside = np.flatnonzero(ok[a:b]) if b > a else ()
        if not len(inside):
            continue
        n = b - a + span - 1
        h = mix(view[a : a + n] * _ODD ^ mix(view[a + 8 : a + 8 + n] + np.uint64(1)))
        least = (h & ~_POS) | np.arange(n, dtype=np.uint64)
        width = 1
        while width * 2 <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < span:
            least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
        at = (least[inside] & _POS).astype(np.int64)
        new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (inside[1:] != inside[:-1] + 1)]))
        for column, x in zip(out, (inside[new] + a, np.diff(np.append(new, len(inside))), at[new] + a, h[at[new]]), strict=True):
            column.append(x)
    first, count, anchor, key = (np.concatenate(x) if x else np.zeros(0, kind) for x, kind in zip(out, (np.int64, np.int64, np.int64, np.uint64), strict=True))
    key = mix(key * _ODD)  # least hashes are small; their buckets shouldn't be
    return first, count, anchor, key, np.searchsorted(t.start, first, side="right") - 1


def _by_bucket(key: np.ndarray, text: np.ndarray, n_buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys ordered by bucket and key, flags (several texts have it, it is there MANY times), and where buckets begin."""
    order = np.argsort(key)
    k, x = key[order], text[order]
    new = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
    several = np.minimum.reduceat(x, new) != np.maximum.reduceat(x, new) if len(k) else np.zeros(0, bool)
    flags = np.where(several, _SEVERAL, np.uint64(0)) | np.where(np.diff(np.append(new, len(k))) >= MANY, _MANY, np.uint64(0))
    distinct = k[new]
    bucket = _bucket(distinct, n_buckets)
    order = np.argsort(bucket, kind="stable")
    return distinct[order], flags[order], np.searchsorted(bucket[order], np.arange(n_buckets + 1))


def _bucket(key: np.ndarray, n_buckets: int) -> np.ndarray:
    return ((key >> np.uint64(32)) * np.uint64(n_buckets) >> np.uint64(32)).astype(np.int64)


def _blobs(bounds: np.ndarray, chunk: int, columns: list[np.ndarray], name: str) -> pa.RecordBatch:
    some = np.flatnonzero(np.diff(bounds))
    blobs = [b"".join(c[bounds[k] : bounds[k + 1]].tobytes() for c in columns) for k in some]
    return pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(np.full(len(some), chunk)), pa.array(blobs, pa.binary())], names=["bucket", "chunk_id", name])


def shared_keys(table: pa.Table, hot_from: int = HOT) -> pa.Table:
    """For one bucket, which keys of each chunk occur in several texts and which are frequent, two bits for each key that it sent.

    A key is sent as 30 bits and two flags of the chunk's own; keys that agree by chance are only looked at in vain.
    """
    sent = [np.frombuffer(x.as_buffer(), dtype="<u4").astype(np.uint64) for x in table.column("blob")]
    every = np.concatenate(sent)
    order = np.argsort(every)
    k = every[order]
    new = np.flatnonzero(np.concatenate([[True], (k[1:] | _FLAGS) != (k[:-1] | _FLAGS)]))
    count = np.diff(np.append(new, len(k)))
    shared = (count > 1) | (np.bitwise_or.reduceat(k & _SEVERAL, new) != 0)
    hot = shared & (np.add.reduceat(np.where(k & _MANY, MANY, 1), new) >= hot_from)
    flag = np.zeros((len(k), 2), dtype=bool)
    flag[order] = np.repeat(np.column_stack([shared, hot]), count, axis=0)
    end = np.cumsum([len(x) for x in sent])
    masks = [np.packbits(flag[e - len(x) : e]).tobytes() if flag[e - len(x) : e].any() else None for x, e in zip(sent, end, strict=True)]
    keep = pa.array([m is not None for m in masks])
    return pa.table({"bucket": table.column("bucket"), "chunk_id": table.column("chunk_id"), "blob": pa.array(masks, pa.binary())}).filter(keep)


def _sort_columns(columns: np.ndarray, k0: np.ndarray, k1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the strings by (k0, k1, columns), one column inserted per round, and neighbours' common prefixes.

    Prefixes are counted in columns; -1 where k0 or k1 differ.
    """
    order = np.arange(len(k0))
    for c in range(columns.shape[1] - 1, -1, -1):
        order = order[np.argsort(columns[order, c], kind="stable")]
    order = order[np.lexsort((k1[order], k0[order]))]
    x = columns[order]
    differ = np.column_stack([x[1:] != x[:-1], np.ones(max(0, len(x) - 1), bool)])
    common = differ.argmax(axis=1)
    common[(k0[order][1:] != k0[order][:-1]) | (k1[order][1:] != k1[order][:-1])] = -1
    return order, common


def _classes(order: np.ndarray, common: np.ndarray, depth: int) -> np.ndarray:
    """A number for each string that equal prefixes of `depth` columns share."""
    out = np.empty(len(order), dtype=np.int64)
    out[order] = np.concatenate([[0], np.cumsum(common < depth)])
    return out


_SEGMENT = np.dtype([("first_id", "<i8"), ("size", "u1"), ("anchor", "u1"), ("several", "u1"), ("pad", "u1")])


def first_documents(table: pa.Table, length: int) -> pa.Table:
    """For one bucket, the smallest id that has each window of each chunk's stretches: runs (stretch, from, upto, id)."""
    span = length - GRAM
    heads, bodies, counts = [], [], []
    for x in table.column("blob"):
        raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(x.as_buffer()), dtype=np.uint8)
        n = int(raw[:4].view("<u4")[0])
        heads.append(raw[4 : 4 + n * _SEGMENT.itemsize].view(_SEGMENT))
        bodies.append(raw[4 + n * _SEGMENT.itemsize :])
        counts.append(n)
    head = np.concatenate(heads)
    body = np.concatenate([np.zeros(span, np.uint8), *bodies, np.zeros(length + span, np.uint8)])
    del bodies
    m, size, anchor = len(head), head["size"].astype(np.int64), head["anchor"].astype(np.int64)
    at = span + np.cumsum(size) - size + anchor
    view = at8(body)
    k0, k1 = view[at], view[at + 8]
    around = np.lib.stride_tricks.sliding_window_view(body, span)
    orders = _sort_columns(around[at - span][:, ::-1], k0, k1), _sort_columns(around[at + GRAM], k0, k1)
    windows = size - length + 1
    least = np.zeros((m, int(windows.max())), dtype=np.int64)
    for o in range(span + 1):  # windows that have their anchor after o bytes
        rows = np.flatnonzero((o <= anchor) & (anchor - o < windows))
        if not len(rows):
            continue
        same = _classes(*orders[0], o)[rows] * (m + 1) + _classes(*orders[1], span - o)[rows]
        order = np.argsort(same)
        new = np.flatnonzero(np.concatenate([[True], same[order][1:] != same[order][:-1]]))
        value = np.minimum.reduceat(head["first_id"][rows][order], new)
        least[rows[order], (anchor[rows] - o)[order]] = np.repeat(value, np.diff(np.append(new, len(rows))))
    stretch = np.repeat(np.arange(m), windows)
    window = np.arange(len(stretch)) - np.repeat(np.cumsum(windows) - windows, windows)
    value = least[stretch, window]
    useful = (value < head["first_id"][stretch]) | (head["several"][stretch] > 0)
    stretch, window, value = stretch[useful], window[useful], value[useful]
    new = np.flatnonzero(np.concatenate([[True], (stretch[1:] != stretch[:-1]) | (value[1:] != value[:-1]) | (window[1:] != window[:-1] + 1)])) if len(stretch) else np.zeros(0, np.int64)
    run = np.zeros(len(new), dtype=_RUN)
    ends = np.append(new[1:], len(stretch)) - 1
    if len(new):
        run["from"], run["upto"], run["id"] = window[new], window[ends] + 1, value[new]
    chunk_end = np.cumsum(counts)
    chunk_begin = chunk_end - counts
    bound = np.searchsorted(stretch[new], [*chunk_begin, m])
    blobs = []
    for k in range(len(counts)):
        part = run[bound[k] : bound[k + 1]].copy()
        part["stretch"] = stretch[new][bound[k] : bound[k + 1]] - chunk_begin[k]
        blobs.append(part.tobytes() or None)
    out = pa.table({"bucket": table.column("bucket"), "chunk_id": table.column("chunk_id"), "kind": pa.array(np.full(len(blobs), 2, np.int32)), "blob": pa.array(blobs, pa.binary())})
    return out.filter(pa.array([b is not None for b in blobs]))


_RUN = np.dtype([("stretch", "<u4"), ("from", "u1"), ("upto", "u1"), ("pad", "<u2"), ("id", "<i8")])
_USE = np.dtype([("stretch", "<u4"), ("first", "<u4")])


def _ids(batch: pa.RecordBatch, order_by: str) -> np.ndarray:
    return batch.column(order_by).cast(pa.int64()).fill_null(_NULL_ID).to_numpy(zero_copy_only=False)


def _cut_out(buf: np.ndarray, first: np.ndarray, size: np.ndarray) -> bytes:
    """The bytes of these stretches of buf, one after another; positions are held for some stretches at a time."""
    parts = []
    for k in range(0, len(first), 1 << 14):
        begin, n = first[k : k + (1 << 14)], size[k : k + (1 << 14)]
        parts.append(buf[np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))].tobytes())
    return b"".join(parts)


def _split(t: Texts, first: np.ndarray, count: np.ndarray, anchor: np.ndarray, text: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """The runs of windows cut in PARTS by how many bytes they have before the anchor, as _anchors returns runs.

    The key is a hash of all bytes that every window of the part has around the anchor, so equal windows have equal keys.
    """
    span = length - GRAM + 1
    cut = np.arange(PARTS + 1) * span // PARTS
    out = []
    for p, (lo, hi) in enumerate(zip(cut[:-1], cut[1:] - 1, strict=True)):
        most, least = np.minimum(anchor - first, hi), np.maximum(anchor - first - count + 1, lo)
        on = np.flatnonzero(most >= least)
        at = anchor[on]
        key = span_hash(t.buf, at - lo, np.full(len(on), GRAM + lo + span - 1 - hi))
        out.append((at - most[on], (most - least)[on] + 1, at, pair_hash(key, np.full(len(on), p, np.uint64)), text[on]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _stretches(payload: bytes, chunk: int, masks: pa.Table, length: int, n_buckets: int, order_by: str) -> Iterator[pa.RecordBatch]:
    """The chunk's distinct stretches around shared anchors (kind 0, to their buckets), and where each is (kind 1)."""
    batch = unpack_chunk(payload)
    t, ids = Texts(to_bytes(batch.column("text"))), _ids(batch, order_by)
    first, count, anchor, key, text = _anchors(t, length)
    keys, _, bounds = _by_bucket(key | _FLAGS, text, n_buckets)
    told = np.zeros((len(keys), 2), dtype=bool)
    for b, mask in zip(masks.column("bucket").to_pylist(), masks.column("blob"), strict=True):
        n = bounds[b + 1] - bounds[b]
        told[bounds[b] : bounds[b + 1]] = np.unpackbits(np.frombuffer(mask.as_buffer(), np.uint8), count=2 * n).reshape(n, 2)
    shared, hot = (np.isin(key | _FLAGS, keys[x]) for x in told.T)
    split = _split(t, first[hot], count[hot], anchor[hot], text[hot], length)
    first, count, anchor, key, text = (np.concatenate([x[shared & ~hot], y]) for x, y in zip((first, count, anchor, key | _FLAGS, text), split, strict=True))
    size = count + length - 1
    bucket = _bucket(key, n_buckets)
    print_ = span_hash(t.buf, first, size)
    order = np.lexsort((print_, bucket))
    same = (bucket[order][1:] == bucket[order][:-1]) & (print_[order][1:] == print_[order][:-1]) & (size[order][1:] == size[order][:-1]) & ((anchor - first)[order][1:] == (anchor - first)[order][:-1])
    for k in range(0, 2 * length, 8):  # equal bytes too
        word = at8(t.buf)[np.minimum(first + k, len(t.buf) - 8)]
        shift = np.uint64(8) * (8 - np.clip(size - k, 0, 8)).astype(np.uint64)
        word = np.where(size > k, (word << np.minimum(shift, np.uint64(63))), np.uint64(0))
        same &= word[order][1:] == word[order][:-1]
    new = np.flatnonzero(np.concatenate([[True], ~same])) if len(order) else np.zeros(0, np.int64)
    if not len(new):
        return
    head = np.zeros(len(new), dtype=_SEGMENT)
    lead = order[new]
    head["first_id"] = np.minimum.reduceat(ids[text[order]], new)
    head["several"] = head["first_id"] != np.maximum.reduceat(ids[text[order]], new)
    head["size"], head["anchor"] = size[lead], (anchor - first)[lead]
    bound = np.searchsorted(bucket[lead], np.arange(n_buckets + 1))
    body, upto = _cut_out(t.buf, first[lead], size[lead]), np.concatenate([[0], np.cumsum(size[lead])])
    number = np.cumsum(np.concatenate([[True], ~same])) - 1
    use = np.zeros(len(order), dtype=_USE)
    use["stretch"], use["first"] = number - bound[bucket[order]], first[order]
    uses = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
    some = np.flatnonzero(np.diff(bound))
    pack = zstandard.ZstdCompressor(level=3).compress
    sent = [pack(np.uint32(bound[b + 1] - bound[b]).tobytes() + head[bound[b] : bound[b + 1]].tobytes() + body[upto[bound[b]] : upto[bound[b + 1]]]) for b in some]
    kept = [use[uses[b] : uses[b + 1]].tobytes() for b in some]
    for kind, blobs in ((0, sent), (1, kept)):
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(np.full(len(some), chunk)), pa.array(np.full(len(some), kind, np.int32)), pa.array(blobs, pa.binary())], names=["bucket", "chunk_id", "kind", "blob"])


def _removed(t: Texts, ids: np.ndarray, rows: pa.Table, length: int) -> np.ndarray:
    """Which bytes of the chunk's buffer go, from its uses (kind 1) and the runs that came back (kind 2)."""
    step = np.zeros(len(t.buf) + 1, dtype=np.int32)
    by_bucket: dict[int, dict[int, np.ndarray]] = {}
    for b, kind, blob in zip(rows.column("bucket").to_pylist(), rows.column("kind").to_pylist(), rows.column("blob"), strict=True):
        by_bucket.setdefault(b, {})[kind] = np.frombuffer(blob.as_buffer(), _USE if kind == 1 else _RUN)
    for found in by_bucket.values():
        if len(found) < 2:
            continue
        use, run = found[1], found[2]
        lo, hi = (np.searchsorted(run["stretch"], use["stretch"], side=s) for s in ("left", "right"))
        n = hi - lo
        u = np.repeat(np.arange(len(use)), n)
        r = np.arange(len(u)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
        at = use["first"][u].astype(np.int64)
        later = ids[np.searchsorted(t.start, at, side="right") - 1] > run["id"][r]
        np.add.at(step, at[later] + run["from"][r][later], 1)
        np.add.at(step, at[later] + run["upto"][r][later] + length - 1, -1)
    return np.cumsum(step, out=step)[:-1] > 0


def _with_order(docs: DataFrame, name: str) -> DataFrame:
    """docs with a number in the order of doc_id, NULL for NULL; a range-partitioned sort numbers the distinct ids."""
    ids = docs.select("doc_id").filter("doc_id IS NOT NULL").distinct().sort("doc_id").withColumn(name, F.monotonically_increasing_id())
    return docs.join(stage(ids, "repeat-order"), "doc_id", "left").select(*docs.columns, name)


def map_without_repeats(docs: DataFrame, finish: Callable[[pa.RecordBatch, Texts, np.ndarray], pa.RecordBatch], schema: str | StructType, length: int = 50, hot_from: int = HOT) -> DataFrame:
    """finish(rows, their texts, which bytes of the buffer are removed) for chunks of docs (doc_id, text, any more).

    A byte goes if a string of `length` bytes that covers it also starts in a document with a smaller doc_id. Rows
    with one doc_id don't remove from each other; a null doc_id counts as the largest. Shorter texts keep all. Ids that
    aren't integers are compared in Spark's order of their type. A text has to fit in a task's memory dozens of times over.
    """
    if not 2 * GRAM <= length <= 128:
        raise ValueError("length must be from 32 to 128")
    names = docs.columns
    order_by = "doc_id"
    if not isinstance(docs.schema["doc_id"].dataType, IntegralType):
        order_by = unused(names, "__order")
        docs = _with_order(docs, order_by)
    total = text_bytes(docs)
    n_buckets = 1 + total // BUCKET_BYTES
    with batches_up_to(docs.sparkSession, BATCH):
        chunks = stage_by(pack_chunks(docs, CHUNK_BYTES, gather=True), "repeat_chunks", "chunk_id", 1 + total // (2 * CHUNK_BYTES))
    ship(docs.sparkSession)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, payload in zip(batch.column("chunk_id").to_pylist(), batch.column("payload"), strict=True):
                *_, key, text = _anchors(Texts(to_bytes(unpack_chunk(payload.as_buffer()).column("text"))), length)
                keys, flags, bounds = _by_bucket(key | _FLAGS, text, n_buckets)
                keys = ((keys & ~_FLAGS) | flags).astype("<u4")
                del key, text, flags
                give_back()
                yield _blobs(bounds, chunk, [keys], "blob")

    def look_up(table: pa.Table) -> pa.Table:
        return shared_keys(table, hot_from)

    def stretches(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return empty
        made = list(_stretches(left.column("payload")[0].as_buffer(), key[0].as_py(), right, length, n_buckets, order_by))
        give_back()
        return pa.Table.from_batches(made) if made else empty

    def minima(table: pa.Table) -> pa.Table:
        found = first_documents(table, length)
        give_back()
        return found

    def end(left: pa.Table, right: pa.Table) -> pa.Table:
        batch = unpack_chunk(left.column("payload")[0].as_buffer())
        t = Texts(to_bytes(batch.column("text")))
        made = pa.Table.from_batches([finish(batch.select(names), t, _removed(t, _ids(batch, order_by), right, length))])
        give_back()
        return made

    four = "bucket int, chunk_id bigint, kind int, blob binary"
    empty = pa.table({"bucket": pa.array([], pa.int32()), "chunk_id": pa.array([], pa.int64()), "kind": pa.array([], pa.int32()), "blob": pa.array([], pa.binary())})
    keys = map_arrow(chunks, send, "bucket int, chunk_id bigint, blob binary")
    masks = keys.groupBy("bucket").applyInArrow(look_up, "bucket int, chunk_id bigint, blob binary")
    with batches_up_to(docs.sparkSession, BATCH):
        made = stage(chunks.groupBy("chunk_id").cogroup(masks.groupBy("chunk_id")).applyInArrow(stretches, four), "repeat-stretches")
    runs = made.filter("kind = 0").groupBy("bucket").applyInArrow(minima, four)
    back = made.filter("kind = 1").unionByName(runs)
    return chunks.groupBy("chunk_id").cogroup(back.groupBy("chunk_id")).applyInArrow(end, schema)


def _spans(t: Texts, gone: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Per text: removed bytes, removed runs, and the bytes that stay."""
    removed, runs = (np.zeros(t.n, dtype=np.int64) for _ in range(2))
    kept = []
    for i, (a, b) in enumerate(zip(t.start.tolist(), t.end.tolist(), strict=True)):
        text, off = t.buf[a:b], gone[a:b]
        removed[i] = np.count_nonzero(off)
        if removed[i]:
            runs[i] = np.count_nonzero(off[1:] & ~off[:-1]) + off[0]
            text = text[~off]
        kept.append(text.tobytes())
    return removed, runs, kept


def repeat_report(docs: DataFrame, length: int = 50, hot_from: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of each document; null text is empty.

    Repeated rows are reported each; rows with one id (ties) don't remove from each other. See map_without_repeats for
    null ids, very long texts and the limit of an anchor that is split.
    """

    def finish(batch: pa.RecordBatch, t: Texts, gone: np.ndarray) -> pa.RecordBatch:
        removed, runs, kept = _spans(t, gone)
        sha = pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string())
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(t.len), pa.array(removed), pa.array(runs), sha], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_without_repeats(docs.select("doc_id", "text"), finish, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string", length, hot_from)


def remove_repeats(docs: DataFrame, length: int = 50) -> DataFrame:
    """docs with the repeated bytes cut from `text`; other columns stay as they are.

    A character that is cut in part goes as a whole. Null texts stay null. Documents of which nothing is left go.
    """

    def finish(batch: pa.RecordBatch, t: Texts, gone: np.ndarray) -> pa.RecordBatch:
        removed, _, kept = _spans(t, gone)
        null = batch.column("text").is_null().to_pylist()
        texts = [None if x else b.decode("utf-8", "ignore") for x, b in zip(null, kept, strict=True)]
        columns = [pa.array(texts, pa.string()) if name == "text" else c for name, c in zip(batch.schema.names, batch.columns, strict=True)]
        whole = pa.array(~((removed == t.len) & (t.len > 0)))
        return pa.RecordBatch.from_arrays(columns, names=batch.schema.names).filter(whole)

    plain = plain_names(docs)
    return map_without_repeats(plain, finish, plain.schema, length).toDF(*docs.columns)
