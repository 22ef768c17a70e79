"""Byte-level BPE: a minimal perfect hash for whole pre-tokens, and merges by a heap over linked bytes for the rest."""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from .common import Texts, at8, groups, map_arrow, mix, schema_with, to_bytes, with_columns

#: Classes of characters in the pre-token pattern.
SPACE, LETTER, NUMBER, OTHER = range(4)
#: Code points of Unicode's White_Space property; fixed values.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: Pre-tokens up to this many bytes are looked up in the hash; longer ones in a dictionary.
SHORT = 16
_MASK = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)
_K = np.uint64(0x9E3779B97F4A7C15)


def character_classes() -> np.ndarray:
    """The class of every code point."""
    out = np.full(0x110000, OTHER, dtype=np.uint8)
    for first in range(0, 0x110000, 0x1000):  # a part at a time, since all characters together take much memory
        if 0xD800 <= first < 0xE000:
            continue
        part = "".join(map(chr, range(first, min(first + 0x1000, 0xD800) if first < 0xD800 else first + 0x1000)))
        for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
            for m in regex.finditer(pattern, part):
                out[first + m.start() : first + m.end()] = kind
    out[WHITE_SPACE] = SPACE
    return out


class PerfectHash:
    """Token ids of up to SHORT bytes by a minimal perfect hash: a slot for each key, found by its bucket's shift."""

    def __init__(self, ranks: dict[bytes, int]):
        keys = [k for k in ranks if len(k) <= SHORT]
        self.n = len(keys)
        buf = np.frombuffer(b"".join(k.ljust(SHORT, b"\0") for k in keys) + b"\0" * 8, dtype=np.uint8)
        size = np.array([len(k) for k in keys], dtype=np.int64)
        w0, w1 = self.load(buf, np.arange(self.n) * SHORT, size)
        self.buckets = max(1, self.n // 3)
        h = self._hash(w0, w1, size)
        bucket = (h % np.uint64(self.buckets)).astype(np.int64)
        self.shift = np.zeros(self.buckets, dtype=np.uint32)
        taken = np.zeros(self.n, dtype=bool)
        slot_of = np.zeros(self.n, dtype=np.int64)
        order = np.argsort(bucket, kind="stable")
        bounds = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        for b in np.argsort(-np.diff(bounds), kind="stable").tolist():  # full buckets first
            rows = order[bounds[b] : bounds[b + 1]]
            if not len(rows):
                break
            first, step = 0, 64
            while True:
                tried = self._slot(h[rows][None, :], np.arange(first, first + step, dtype=np.uint64)[:, None])
                fits = ~taken[tried].any(axis=1)
                if len(rows) > 1:
                    ordered = np.sort(tried, axis=1)
                    fits &= (ordered[:, 1:] != ordered[:, :-1]).all(axis=1)
                if fits.any():
                    k = int(np.argmax(fits))
                    self.shift[b] = first + k
                    slot_of[rows] = tried[k]
                    taken[tried[k]] = True
                    break
                first += step
                step = min(step * 4, 1 << 16)
        self.w0, self.w1, self.size = np.zeros_like(w0), np.zeros_like(w1), np.zeros(self.n, dtype=np.uint8)
        self.id = np.zeros(self.n, dtype=np.uint32)
        self.w0[slot_of], self.w1[slot_of], self.size[slot_of] = w0, w1, size
        self.id[slot_of] = [ranks[k] for k in keys]

    @staticmethod
    def load(buf: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first 16 bytes of each span as two numbers, with zeros after its end."""
        view = at8(buf)
        return view[start] & _MASK[np.minimum(size, 8)], view[np.minimum(start + 8, len(view) - 1)] & _MASK[np.clip(size - 8, 0, 8)]

    @staticmethod
    def _hash(w0: np.ndarray, w1: np.ndarray, size: np.ndarray) -> np.ndarray:
        return mix(mix(w0 + size.astype(np.uint64) * _K) + w1)

    def _slot(self, h: np.ndarray, shift: np.ndarray) -> np.ndarray:
        return (mix(h ^ (shift + np.uint64(1)) * _K) % np.uint64(max(1, self.n))).astype(np.int64)

    def find(self, w0: np.ndarray, w1: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each key of up to SHORT bytes is a token, and its id if so; the stored bytes are compared."""
        if not self.n:
            return np.zeros(len(w0), bool), np.zeros(len(w0), np.uint32)
        h = self._hash(w0, w1, size)
        slot = self._slot(h, self.shift[(h % np.uint64(self.buckets)).astype(np.int64)].astype(np.uint64))
        return (self.w0[slot] == w0) & (self.w1[slot] == w1) & (self.size[slot] == size) & (size <= SHORT), self.id[slot]


def merge_bytes(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of a pre-token: the lowest-ranked adjacent pair is merged, the first one of equals, until none is left.

    Pieces are linked by their neighbours' starts; the heap holds (rank, start, end of the pair) and entries whose
    pieces have changed since are passed over.
    """
    n = len(word)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    get = ranks.get
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    pop, push = heapq.heappop, heapq.heappush
    while heap:
        _, i, end = pop(heap)
        mid = after[i]
        if mid < 0 or mid >= n or after[mid] != end:
            continue
        after[i], after[mid] = end, -1
        if end < n:
            before[end] = i
            far = after[end]
            if (r := get(word[i:far])) is not None:
                push(heap, (r, i, far))
        if (left := before[i]) >= 0 and (r := get(word[left:end])) is not None:
            push(heap, (r, left, end))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : after[i]]])
        i = after[i]
    return out


class ByteBpe:
    """Encodes and decodes with the ranks of a vocabulary that has all 256 bytes; no special tokens."""

    def __init__(self, ranks: dict[bytes, int], most_cached: int = 250_000):
        if missing := [b for b in range(256) if bytes([b]) not in ranks]:
            raise ValueError(f"the vocabulary lacks {len(missing)} bytes")
        self.ranks, self.most_cached = ranks, most_cached
        self.hash = PerfectHash(ranks)
        self.classes = character_classes()
        self.merged: dict[bytes, bytes] = {}
        top = max(ranks.values()) + 1
        token = [b""] * top
        for k, v in ranks.items():
            token[v] = k
        self.blob = np.frombuffer(b"".join(token), dtype=np.uint8)
        self.size = np.fromiter(map(len, token), dtype=np.int64, count=top)
        self.start = np.cumsum(self.size) - self.size

    def pre_tokens(self, t: Texts) -> np.ndarray:
        """First byte of each pre-token of the texts; each ends where the next begins, or its text ends.

        The pattern is a cut at every change of class, except: a run of white space before another character leaves
        its last character to stand alone, or, if that is a blank, to lead the next run; and an apostrophe that
        starts a pre-token takes a contraction's letters along.
        """
        b = t.buf
        kind = self.classes[b]
        lead = np.flatnonzero(b >= 0xC0)
        if len(lead):
            first = b[lead].astype(np.int64)
            k = 1 + (first >= 0xE0) + (first >= 0xF0)
            nxt = [b[lead + j].astype(np.int64) & 0x3F for j in (1, 2, 3)]
            point = np.where(k == 1, (first & 0x1F) << 6 | nxt[0], np.where(k == 2, (first & 0x0F) << 12 | nxt[0] << 6 | nxt[1], (first & 0x07) << 18 | nxt[0] << 12 | nxt[1] << 6 | nxt[2]))
            its = self.classes[np.minimum(point, 0x10FFFF)]
            kind[lead] = its
            for j in (1, 2, 3):
                kind[(lead + j)[k >= j]] = its[k >= j]
        full = np.flatnonzero(t.len)
        starts, ends = t.start[full], t.end[full]
        cut = np.zeros(len(b) + 1, dtype=bool)
        cut[1:-1] = kind[1:] != kind[:-1]
        cut[starts] = True
        cut[ends] = True
        inside = np.zeros(len(b) + 1, dtype=np.int8)
        inside[starts] += 1
        np.add.at(inside, ends, -1)
        inside = np.cumsum(inside, dtype=np.int8).astype(bool)
        # the ends of runs of white space that another character follows
        end = np.flatnonzero(cut[: len(b)] & inside[: len(b)])
        end = end[end > 0]
        end = end[inside[end - 1] & (kind[end - 1] == SPACE) & (kind[end] != SPACE)]
        last = end - 1
        for _ in range(3):
            last = np.where((b[last] & 0xC0) == 0x80, last - 1, last)
        cut[last] = True
        cut[end[b[last] == 0x20]] = False
        # contractions: an apostrophe alone in its run, at the start of a pre-token, before letters
        quote = np.flatnonzero((b[:-3] == 0x27) & cut[: len(b) - 3] & cut[1 : len(b) - 2])
        quote = quote[inside[quote + 1] & (kind[quote + 1] == LETTER)]
        if len(quote):
            one, two = b[quote + 1], b[quote + 2]
            pair = inside[quote + 2] & (((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l")))
            size = np.where(np.isin(one, np.frombuffer(b"stmd", np.uint8)), 1, np.where(pair, 2, 0))
            cut[quote[size > 0] + 1] = False
            cut[quote[size > 0] + 1 + size[size > 0]] = True
        return np.flatnonzero(cut[: len(b)] & inside[: len(b)])

    def encode(self, values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in order, and the index of each text's first id (and one more at the end)."""
        t = Texts(values)
        start = self.pre_tokens(t)
        text = np.searchsorted(t.start, start, side="right") - 1
        end = np.minimum(np.append(start[1:], t.end[-1] if t.n else 0), t.end[text] if len(start) else 0)
        size = end - start
        w0, w1 = self.hash.load(t.buf, start, size)
        whole, found = self.hash.find(w0, w1, size)
        miss = np.flatnonzero(~whole)
        data, merged, ranks = t.buf.tobytes(), self.merged, self.ranks
        codes = []
        for a, b in zip(start[miss].tolist(), end[miss].tolist(), strict=True):
            word = data[a:b]
            code = merged.get(word)
            if code is None:
                whole_id = ranks.get(word) if len(word) > SHORT else None
                code = np.array([whole_id] if whole_id is not None else merge_bytes(word, ranks), dtype="<u4").tobytes()
                if len(word) <= 64:
                    if len(merged) >= self.most_cached:
                        merged.clear()
                    merged[word] = code
            codes.append(code)
        count = np.ones(len(start), dtype=np.int64)
        count[miss] = np.fromiter(map(len, codes), dtype=np.int64, count=len(codes)) // 4
        at = np.concatenate([[0], np.cumsum(count)])
        ids = np.empty(at[-1], dtype="<u4")
        ids[at[:-1][whole]] = found[whole]
        ids[np.repeat(~whole, count)] = np.frombuffer(b"".join(codes), dtype="<u4")
        return ids, at[np.append(np.searchsorted(start, t.start), len(start))]

    def decode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bytes of all ids together, and how many each has."""
        size = self.size[ids]
        total = np.cumsum(size)
        at = np.repeat(self.start[ids] - (total - size), size) + np.arange(total[-1] if len(total) else 0)
        return self.blob[at].tobytes(), size


_made: dict[str, ByteBpe] = {}


def vocabulary(lines: bytes) -> dict[bytes, int]:
    """Ranks from lines of a base64 token and its rank."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines.splitlines())}


def bpe_from(lines: bytes) -> ByteBpe:
    """One encoder per worker and vocabulary."""
    key = hashlib.sha256(lines).hexdigest()
    if key not in _made:
        _made[key] = ByteBpe(vocabulary(lines))
    return _made[key]


def tokenize(docs: DataFrame, vocabulary_file: str, with_ids: bool = True, group_bytes: int = 1 << 19) -> DataFrame:
    """docs with n_tokens, ids_sha256, decoded_sha256 and (with_ids) the ids of each text added, or replaced.

    vocabulary_file, of base64 tokens and ranks, is read on the driver and sent along (under 1 MB for 50,000
    tokens). decoded_sha256 is of the bytes that the ids stand for. Null text is empty: no ids.
    """
    new = ["n_tokens", "ids_sha256", "decoded_sha256", *["ids"][:with_ids]]
    with open(vocabulary_file, "rb") as f:
        lines = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = bpe_from(lines.value)
        for batch in batches:
            done = 0
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()
            for lo, hi in groups(sizes, group_bytes, int):
                ids, first = bpe.encode(to_bytes(batch.column("text").slice(lo, hi - lo)))
                raw = ids.tobytes()
                decoded, size = bpe.decode(ids)
                upto = np.concatenate([[0], np.cumsum(size)])[first]
                sha = [hashlib.sha256(raw[4 * a : 4 * b]).hexdigest() for a, b in zip(first[:-1], first[1:], strict=True)]
                back = [hashlib.sha256(decoded[a:b]).hexdigest() for a, b in zip(upto[:-1], upto[1:], strict=True)]
                columns = [pa.array(np.diff(first)), pa.array(sha, pa.string()), pa.array(back, pa.string())]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(ids.astype(np.int32))))
                yield with_columns(batch.slice(lo, hi - lo), new, columns)
                done = hi
            assert done == batch.num_rows

    return map_arrow(docs, run, schema_with(docs, "n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids))
