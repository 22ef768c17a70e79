"""A trigram language model in bucketed Elias-Fano tries, counted and queried by exchanging packed n-grams.

Chunks of documents send their distinct words, word pairs and triples, with their training counts, to buckets by their
first word. A bucket makes them a trie of three levels in one memory mapping, whose levels stay packed while they are
queried, and answers every chunk's n-grams in the order they were sent. A frequent word is many contexts, one for each
stretch of its successors' hashes, and so is a frequent pair, so that no bucket holds all that follows it.
"""

from __future__ import annotations

import mmap
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from .common import Texts, at8, map_arrow, mix, pack_chunks, pair_hash, release, ship, span_hash, stage, text_bytes, to_bytes, unpack_chunk

CHUNK_BYTES, BUCKET_BYTES = 5 << 20, 4 << 20
#: Tokens of a word or pair per context that it is split into.
FAN_TOKENS = 1 << 17
#: Weight of the unigram probability against a word's successors, and of the pair's against a pair's, in tokens.
PRIORS = (1000.0, 20.0)
#: Codes per decade of a quantised probability.
STEPS = 4096
#: N-grams that are looked up together.
BLOCK = 1 << 15
#: Of zstd, for what is exchanged: the disk that the two exchanges take is scarcer than time.
LEVEL = 6

_SENTENCE = np.uint64(0x5EED0000000000E5)
_K = np.uint64(0x9E3779B97F4A7C15)
#: Bits of a successor's hash in a word's and in a pair's context. Only successors of one context are told apart by them.
SUCCESSOR_BITS = {2: 40, 3: 32}
#: Marks the count of a context that is a part of a frequent word or pair.
_PART = np.uint32(1 << 31)

_ONES, _TOPS = np.uint64(0x0101010101010101), np.uint64(0x8080808080808080)
_BIT_IN_BYTE = np.array([([k for k in range(8) if byte >> k & 1] + [0] * 8)[:8] for byte in range(256)], np.uint64).ravel()


def _select(word: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Position of the set bit number k (from 0) of each 64-bit word, by sums of its bytes' bits."""
    u = np.uint64
    s = word - (word >> u(1) & u(0x5555555555555555))
    s = (s & u(0x3333333333333333)) + (s >> u(2) & u(0x3333333333333333))
    s = (s + (s >> u(4)) & u(0x0F0F0F0F0F0F0F0F)) * _ONES
    at = (((k * _ONES | _TOPS) - s & _TOPS) >> u(7)) * _ONES >> u(56) << u(3)
    return at + _BIT_IN_BYTE[((word >> at & u(255)) << u(3)) + k - ((s << u(8)) >> at & u(255))]


class EliasFano:
    """A non-decreasing sequence in one byte string: low bits packed as they are, high bits as gaps in unary.

    Only a directory of bit counts, one for each 64 bits of the unary part, is made when it is opened; values are
    read and found where they stand.
    """

    @staticmethod
    def encode(values: np.ndarray) -> bytes:
        n, top = len(values), int(values[-1]) if len(values) else 0
        low = min(56, max(0, (top // max(1, n)).bit_length() - 1))
        packed = bytearray()
        for at in range(0, n if low else 0, BLOCK):
            octets = np.ascontiguousarray(values[at : at + BLOCK], "<u8").view(np.uint8).reshape(-1, 8)
            packed += np.packbits(np.unpackbits(octets, axis=1, count=low, bitorder="little").ravel(), bitorder="little").tobytes()
        packed += bytes(-len(packed) % 8 + 8)
        unary = np.zeros(-(-(n + (top >> low) + 1) // 64) * 64, dtype=np.uint8)
        unary[(values >> np.uint64(low)).astype(np.int64) + np.arange(n)] = 1
        return np.array([n, low, len(packed)], "<u8").tobytes() + bytes(packed) + np.packbits(unary, bitorder="little").tobytes()

    def __init__(self, data: np.ndarray):
        """data: a view of the encoded bytes, aligned to 8."""
        self.n, self.low, size = (int(x) for x in data[:24].view("<u8"))
        self.bits, self.high = at8(data[24 : 24 + size]), data[24 + size :].view("<u8")
        self.ones = np.concatenate([[0], np.cumsum(np.bitwise_count(self.high), dtype=np.int64)])
        self.zeros = np.arange(len(self.ones)) * 64 - self.ones
        self.most = int(self.zeros[-1]) - 1

    def low_bits(self, i: np.ndarray) -> np.ndarray:
        at = i * self.low
        return self.bits[at >> 3] >> (at & 7).astype(np.uint64) & np.uint64((1 << self.low) - 1)

    def access(self, i: np.ndarray) -> np.ndarray:
        """The values at these places."""
        word = np.searchsorted(self.ones, i, "right") - 1
        at = word * 64 + _select(self.high[word], (i - self.ones[word]).astype(np.uint64)).astype(np.int64)
        return (at - i).astype(np.uint64) << np.uint64(self.low) | self.low_bits(i)

    def _upto(self, high: np.ndarray) -> np.ndarray:
        """How many values have high bits of at most these."""
        word = np.searchsorted(self.zeros, high, "right") - 1
        return word * 64 + _select(~self.high[word], (high - self.zeros[word]).astype(np.uint64)).astype(np.int64) - high

    def find(self, begin: np.ndarray, end: np.ndarray, value: np.ndarray) -> np.ndarray:
        """The first place from begin to end, exclusive, of each value, -1 where it isn't there.

        The next value that isn't smaller is sought among those with the same high bits.
        """
        high = value >> np.uint64(self.low)
        inside = high <= np.uint64(self.most)
        high = np.where(inside, high, np.uint64(0)).astype(np.int64)
        lo = np.maximum(begin, np.where(high > 0, self._upto(np.maximum(high - 1, 0)), 0))
        hi = np.minimum(end, self._upto(high))
        upto, low = hi.copy(), value & np.uint64((1 << self.low) - 1)
        live = np.flatnonzero(lo < hi)
        while len(live):
            mid = (lo[live] + hi[live]) >> 1
            less = self.low_bits(mid) < low[live]
            lo[live] = np.where(less, mid + 1, lo[live])
            hi[live] = np.where(less, hi[live], mid)
            live = live[lo[live] < hi[live]]
        found = np.flatnonzero((lo < upto) & inside)
        out = np.full(len(value), -1, np.int64)
        found = found[self.low_bits(lo[found]) == low[found]]
        out[found] = lo[found]
        return out


def quantise(p: np.ndarray) -> np.ndarray:
    """16-bit codes of probabilities: 0 for 0, else 1 + STEPS x -log10, so down to 1e-15."""
    return np.where(p > 0, np.minimum(65535, 1 + np.rint(-STEPS * np.log10(np.where(p > 0, p, 1)))), 0).astype(np.uint16)


def restore(code: np.ndarray) -> np.ndarray:
    return np.where(code > 0, 10.0 ** ((1 - code.astype(np.float64)) / STEPS), 0.0)


def _level(owner: np.ndarray, successor: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Pointers to each of n contexts' successors (sorted), and these, each on top of the last one of the context before."""
    pointers = np.searchsorted(owner, np.arange(n + 1))
    last, full = np.zeros(n, np.uint64), pointers[1:] > pointers[:-1]
    last[full] = successor[pointers[1:][full] - 1] + np.uint64(1)
    return pointers.astype(np.uint64), (np.cumsum(last, dtype=np.uint64) - last)[owner] + successor + np.uint64(1)


class Trie:
    """Words, pairs and triples that training has, in one memory mapping that holds them packed.

    Level 1 has the contexts' hashes and exact counts, levels 2 and 3 the successors. A pointer for each n-gram tells
    where its successors begin. Hashes, pointers and successors are Elias-Fano sequences. A successor is stored
    relative to its context: above the last successor of the context before. An n-gram of level 2 or 3 has the code of
    its smoothed share c(context, w) / (c(context) + prior), one of level 2 also that of the weight
    prior / (c + prior) which the shorter context's probability has after it.
    """

    def __init__(self, data: mmap.mmap):
        raw = np.frombuffer(data, dtype=np.uint8)
        at = 72 + np.concatenate([[0], np.cumsum(raw[:72].view("<u8").astype(np.int64))])
        part = [raw[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
        self.contexts, self.pointers, self.levels = EliasFano(part[0]), {2: EliasFano(part[1]), 3: EliasFano(part[2])}, {2: EliasFano(part[3]), 3: EliasFano(part[4])}
        self.counts, self.shares, self.backoff = part[5].view("<u8"), {2: part[6].view("<u2"), 3: part[7].view("<u2")}, part[8].view("<u2")

    @staticmethod
    def build(context: np.ndarray, count: np.ndarray, pair: tuple[np.ndarray, np.ndarray, np.ndarray], triple: tuple[np.ndarray, np.ndarray, np.ndarray]) -> Trie:
        """context: sorted hashes with their counts; pair, triple: index of the context or pair, successor (both in order), count.

        What has count 0 is left out.
        """
        seen1, seen2, seen3 = count > 0, pair[2] > 0, triple[2] > 0
        rank1, rank2 = np.cumsum(seen1) - 1, np.cumsum(seen2) - 1
        c1, c2, c3 = count[seen1], pair[2][seen2], triple[2][seen3]
        owner2, owner3 = rank1[pair[0][seen2]], rank2[triple[0][seen3]]
        parts = [EliasFano.encode(context[seen1])]
        pointers2, level2 = _level(owner2, pair[1][seen2], len(c1))
        pointers3, level3 = _level(owner3, triple[1][seen3], len(c2))
        parts += [EliasFano.encode(x) for x in (pointers2, pointers3, level2, level3)]
        shares = [quantise(c / (above + prior)) for c, above, prior in ((c2, c1[owner2], PRIORS[0]), (c3, c2[owner3], PRIORS[1]))]
        parts += [x.tobytes() for x in (c1.astype("<u8"), *(x.astype("<u2") for x in (*shares, quantise(PRIORS[1] / (c2 + PRIORS[1])))))]
        parts = [x + bytes(-len(x) % 8) for x in parts]
        data = mmap.mmap(-1, 72 + sum(map(len, parts)))
        data.write(np.array([len(x) for x in parts], "<u8").tobytes())
        for x in parts:
            data.write(x)
        return Trie(data)

    def find_contexts(self, context: np.ndarray) -> np.ndarray:
        """Rank of each context, -1 if training doesn't have it."""
        found = [self.contexts.find(np.zeros(len(x), np.int64), np.full(len(x), self.contexts.n), x) for x in _blocks(context)]
        return np.concatenate(found) if found else np.zeros(0, np.int64)

    def find_successors(self, level: int, context: np.ndarray, of: np.ndarray, successor: np.ndarray) -> np.ndarray:
        """Place in this level of each successor of context[of], -1 if there is none; context: ranks a level above, or -1."""
        pointers, values = self.pointers[level], self.levels[level]
        begin, end, base = np.zeros(len(context), np.int64), np.zeros(len(context), np.int64), np.zeros(len(context), np.uint64)
        for at in _blocks(np.flatnonzero(context >= 0)):
            begin[at], end[at] = pointers.access(context[at]).astype(np.int64), pointers.access(context[at] + 1).astype(np.int64)
            at = at[(begin[at] > 0) & (end[at] > begin[at])]
            base[at] = values.access(begin[at] - 1)
        out = np.full(len(of), -1, np.int64)
        for at in _blocks(np.flatnonzero((end > begin)[of])):
            o = of[at]
            out[at] = values.find(begin[o], end[o], base[o] + successor[at] + np.uint64(1))
        return out


def _blocks(x: np.ndarray) -> Iterator[np.ndarray]:
    for at in range(0, len(x), BLOCK):
        yield x[at : at + BLOCK]


def _at(codes: np.ndarray, place: np.ndarray) -> np.ndarray:
    return np.where(place >= 0, codes[np.maximum(place, 0)], 0).astype(codes.dtype) if len(codes) else np.zeros(len(place), codes.dtype)


def _distinct(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, the index among them of each key, and the sums of n."""
    order = np.argsort(key)
    k = key[order]
    first = np.ones(len(k), bool)
    first[1:] = k[1:] != k[:-1]
    place = np.empty(len(k), np.int64)
    place[order] = np.cumsum(first) - 1
    at = np.flatnonzero(first)
    return k[at], place, np.add.reduceat(n[order], at) if len(at) else np.zeros(0, n.dtype)


class _Grams:
    """The tokens of a chunk, its distinct contexts, pairs and triples ordered by bucket, and where each token's are."""

    def __init__(self, values: list[bytes], train: np.ndarray, hot: np.ndarray, fan: np.ndarray, n_buckets: int):
        h, text, self.n_tokens = tokens(values)
        learns = train[text].astype(np.int64)
        self.begins = np.ones(len(text), bool)
        self.begins[1:] = text[1:] != text[:-1]
        before = _before(h, self.begins)
        pair_name = pair_hash(before, h)

        def parts(name: np.ndarray) -> np.ndarray:
            """Into how many contexts each word or pair is split, 0 if it isn't."""
            if not len(hot):
                return np.zeros(len(name), np.uint64)
            at = np.minimum(np.searchsorted(hot, name), len(hot) - 1)
            return np.where(hot[at] == name, fan[at], np.uint64(0))

        def part_of(name: np.ndarray, n: np.ndarray) -> np.ndarray:
            return mix(name + ((h >> np.uint64(47)) % np.maximum(n, np.uint64(1)) + np.uint64(1)) * _K)

        def all_parts(name: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """All parts of these, and the index of what each is a part of."""
            n = parts(name).astype(np.int64)
            of = np.repeat(np.arange(len(name)), n)
            k = (np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n) + 1).astype(np.uint64)
            return mix(name[of] + k * _K), of

        n_word, n_pair = parts(before), parts(pair_name)
        hot_words = np.unique(before[n_word > 0])
        hot_pairs, first, hot_pair = np.unique(pair_name[n_pair > 0], return_index=True, return_inverse=True)
        at_pair = np.flatnonzero(n_pair > 0)
        hot_count = np.bincount(hot_pair, learns[at_pair], len(hot_pairs)).astype(np.int64)
        word_parts, of_word = all_parts(hot_words)
        pair_parts, of_pair = all_parts(hot_pairs)
        key = np.where(n_word > 0, part_of(before, n_word), before)
        # names: words, contexts of pairs, and all parts of what is split
        names, place = np.unique(np.concatenate([h, key, word_parts, pair_parts]), return_inverse=True)
        mixed = mix(names.copy())
        bucket = (mixed >> np.uint64(32)) * np.uint64(n_buckets) >> np.uint64(32)
        order = np.argsort(bucket, kind="stable")
        mixed = mixed[order]
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.word, owner, word_part, pair_part = np.split(rank[place], np.cumsum([len(h), len(key), len(word_parts)]))
        self.names = names[order]
        self.bounds = np.searchsorted(bucket[order], np.arange(n_buckets + 1, dtype=np.uint64))
        self.counts = np.bincount(self.word, learns, len(names)).astype(np.int64)
        self.is_part = np.zeros(len(names), bool)
        self.is_part[word_part] = self.is_part[pair_part] = True
        self.counts[word_part] = self.counts[rank[np.searchsorted(names, hot_words)]][of_word]
        self.counts[pair_part] = hot_count[of_pair]
        # pairs, by context's rank, then by the word's; a part of a frequent pair is a context that has its second word alone
        second = self.word[at_pair[first]][of_pair]
        p, pair, self.pair_counts = _distinct(np.concatenate([owner << 32 | self.word, pair_part << 32 | second]), np.concatenate([learns, hot_count[of_pair]]))
        self.pair = pair[: len(h)]
        self.successor = mixed[p & 0xFFFFFFFF] >> np.uint64(64 - SUCCESSOR_BITS[2])
        self.each = np.bincount(p >> 32, minlength=len(names))
        self.upto = np.concatenate([[0], np.cumsum(self.each)])
        # triples, by pair, then by the word's rank
        self.third = np.flatnonzero(~self.begins)
        under = self.pair[self.third - 1]
        split = np.flatnonzero(n_pair[self.third - 1] > 0)
        i = self.third[split]
        name = mix(pair_name[i - 1] + ((h[i] >> np.uint64(47)) % n_pair[i - 1] + np.uint64(1)) * _K)
        under[split] = np.searchsorted(p, rank[np.searchsorted(names, name)] << 32 | self.word[i - 1])
        t, self.triple, self.triple_counts = _distinct(under << 32 | self.word[self.third], learns[self.third])
        self.successor3 = mixed[t & 0xFFFFFFFF] >> np.uint64(64 - SUCCESSOR_BITS[3])
        self.each3 = np.bincount(t >> 32, minlength=len(p))
        self.upto3 = np.concatenate([[0], np.cumsum(self.each3)])
        self.context_word = np.where(self.begins, -1, np.concatenate([self.word[:1], self.word[:-1]]))
        found = np.flatnonzero(self.names == _SENTENCE)
        self.sentence = int(found[0]) if len(found) else 0

    def blobs(self) -> Iterator[tuple[int, bytes]]:
        pack = zstandard.ZstdCompressor(level=LEVEL).compress
        marked = self.counts.astype("<u4") | np.where(self.is_part, _PART, np.uint32(0))
        for b in np.flatnonzero(np.diff(self.bounds)):
            lo, hi = self.bounds[b], self.bounds[b + 1]
            a, z = self.upto[lo], self.upto[hi]
            y, x = self.upto3[a], self.upto3[z]
            w = self.successor[a:z]
            small = pack(b"".join(_planes(v.astype("<u4")) for v in (marked[lo:hi], self.each[lo:hi], self.pair_counts[a:z], self.each3[a:z], self.triple_counts[y:x])))
            names = self.names[lo:hi]
            tops = pack(_steps(names >> np.uint64(56)) + _steps(w >> np.uint64(32)))
            seven = names.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :7]
            yield int(b), np.array([hi - lo, z - a, x - y, len(small)], "<u8").tobytes() + b"".join(v.tobytes() for v in (w.astype("<u4"), self.successor3[y:x].astype("<u4"), seven)) + small + tops


def _steps(top: np.ndarray) -> bytes:
    """Differences of consecutive bytes, which are mostly small: names of a bucket are in order, and successors nearly."""
    return np.diff(top.astype(np.uint8), prepend=np.uint8(0)).tobytes()


def _planes(values: np.ndarray) -> bytes:
    """The first bytes of all values, then the second ones, and so on, which compresses better."""
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def _from_planes(data: bytes, sizes: list[int], kinds: list[str]) -> list[np.ndarray]:
    """Arrays of these sizes and kinds, written by _planes one after the other."""
    out, at = [], 0
    for n, kind in zip(sizes, kinds, strict=True):
        width = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(np.frombuffer(data, np.uint8, n * width, at).reshape(width, n).T).view(kind).ravel())
        at += n * width
    return out


def _before(h: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """The token before each, or the start of the text."""
    return np.where(begins, _SENTENCE, np.concatenate([h[:1], h[:-1]]))


def tokens(values: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and text of each token (the words in lower case, then an end), and the number of tokens of each text."""
    t = Texts(values, lower=True)
    start, end, first = t.words()
    words = span_hash(t.buf, start, end - start)
    n = np.diff(first)
    at = np.arange(len(words)) + np.repeat(np.arange(t.n), n)
    h = np.full(len(words) + t.n, _SENTENCE, dtype=np.uint64)
    h[at] = words
    return h, np.repeat(np.arange(t.n), n + 1), n + 1


def _open_blob(data: bytes) -> tuple[np.ndarray, ...]:
    """What a chunk sent to a bucket: names, counts, pairs of each, successors, counts; triples of each pair, successors, counts."""
    n, m, t, size = (int(x) for x in np.frombuffer(data, "<u8", 4))
    at = 32 + np.cumsum([0, 4 * m, 4 * t, 7 * n, size])
    unpack = zstandard.ZstdDecompressor().decompress
    low, third = np.frombuffer(data, "<u4", m, at[0]).astype(np.uint64), np.frombuffer(data, "<u4", t, at[1]).astype(np.uint64)
    counts, each, pairs, each3, triples = _from_planes(unpack(memoryview(data)[at[3] : at[4]]), [n, n, m, m, t], ["<u4"] * 5)
    name_tops, tops = (np.cumsum(x, dtype=np.uint8) for x in np.split(np.frombuffer(unpack(memoryview(data)[at[4] :]), np.uint8), [n]))
    octets = np.column_stack([np.frombuffer(data, np.uint8, 7 * n, at[2]).reshape(n, 7), name_tops])
    names = np.ascontiguousarray(octets).view("<u8").ravel()
    return names, counts, each, low | tops.astype(np.uint64) << np.uint64(32), pairs, each3, third, triples


def _under(level: int, owner: np.ndarray, n: int, successor: np.ndarray) -> tuple[np.ndarray, int]:
    """Owner (one of n) and successor in one number each, and how many bits the successor has in it."""
    bits = min(SUCCESSOR_BITS[level], 63 - n.bit_length())
    return owner.astype(np.uint64) << np.uint64(bits) | successor >> np.uint64(SUCCESSOR_BITS[level] - bits), bits


def answer(table: pa.Table) -> pa.Table:
    """For one bucket: its trie from what all chunks sent, and for each chunk the counts and codes it asked for.

    Row kinds: 0 with the bucket's training tokens and distinct ones, 1 with a chunk's answers. Each distinct n-gram
    is looked up once, in order.
    """
    sent = [_open_blob(x) for x in table.column("blob").to_pylist()]
    names, counts, each, successor, pairs, each3, successor3, triples = (np.concatenate(x) for x in zip(*sent))
    contexts, place = np.unique(names, return_inverse=True)
    is_part = np.zeros(len(contexts), bool)
    is_part[place[counts & _PART > 0]] = True
    total = np.bincount(place, counts & ~_PART, len(contexts)).astype(np.int64)
    key, bits = _under(2, np.repeat(place, each), len(contexts), successor)
    key, pair, pairs = _distinct(key, pairs.astype(np.int64))
    key3, bits3 = _under(3, np.repeat(pair, each3), len(key), successor3)
    key3, triple, triples = _distinct(key3, triples.astype(np.int64))
    owner, successor = (key >> np.uint64(bits)).astype(np.int64), key & np.uint64((1 << bits) - 1)
    owner3, successor3 = (key3 >> np.uint64(bits3)).astype(np.int64), key3 & np.uint64((1 << bits3) - 1)
    trie = Trie.build(contexts, total, (owner, successor, pairs), (owner3, successor3, triples))
    rank = trie.find_contexts(contexts)
    rank2 = trie.find_successors(2, rank, owner, successor)
    rank3 = trie.find_successors(3, rank2, owner3, successor3)
    found = [_at(trie.counts, rank)[place], _at(trie.shares[2], rank2)[pair], _at(trie.backoff, rank2)[pair], _at(trie.shares[3], rank3)[triple]]
    cuts = [np.cumsum([len(s[k]) for s in sent])[:-1] for k in (0, 3, 3, 6)]
    pack = zstandard.ZstdCompressor(level=LEVEL).compress
    blobs = [f"{total[~is_part].sum()} {(total[~is_part] > 0).sum()}".encode()]
    blobs += [pack(b"".join(map(_planes, one))) for one in zip(*(np.split(x, cut) for x, cut in zip(found, cuts)))]
    buckets, chunks = table.column("bucket").to_pylist(), table.column("chunk_id").to_pylist()
    return pa.table({"bucket": pa.array([buckets[0], *buckets], pa.int32()), "chunk_id": pa.array([-1, *chunks], pa.int64()), "kind": pa.array([0] + [1] * len(sent), pa.int32()), "blob": pa.array(blobs, pa.binary())})


def score_documents(docs: DataFrame, train: str) -> DataFrame:
    """doc_id, trained, n_tokens, n_known, train_tokens, base_score and score of each document.

    train: SQL for whether the model learns from a row of docs (doc_id, text). Tokens are the words in lower case
    (A to Z only) and an end. base_score sums log10 p(w) = (c(w)+1)/(N+V+1) over the tokens w. score sums log10 of
    p(w | u v) = (c(u v w) + PRIORS[1] p(w | v)) / (c(u v) + PRIORS[1]), where p(w | v) is
    (c(v w) + PRIORS[0] p(w)) / (c(v) + PRIORS[0]), u and v are the tokens before w, the start of the text is the
    token before its first one, and that first one has p(w | v). The shares and weights in these are the trie's,
    quantised to 1/STEPS of a decade. Null text is empty: an end alone. Repeated rows, also with one doc_id, are scored
    and counted one by one; a null doc_id stays null; other columns are not used. No rows give no rows. A text is whole
    in a task, with dozens of bytes for each of its bytes.
    """
    rows = docs.select("doc_id", "text", F.expr(f"coalesce({train}, false)").alias("trained"))
    total = text_bytes(rows)
    n_buckets = 1 + total // BUCKET_BYTES
    chunks = stage(pack_chunks(rows, CHUNK_BYTES), "lm-chunks")
    ship(docs.sparkSession)
    hot, fan = _frequent(chunks, total)

    def grams(payload: bytes) -> tuple[pa.RecordBatch, _Grams]:
        batch = unpack_chunk(payload)
        return batch, _Grams(to_bytes(batch.column("text")), batch.column("trained").to_numpy(zero_copy_only=False).astype(bool), hot, fan, n_buckets)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, payload in zip(batch.column("chunk_id").to_pylist(), batch.column("payload"), strict=True):
                found = list(grams(payload.as_buffer())[1].blobs())
                yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in found], pa.int32()), pa.array([chunk] * len(found), pa.int64()), pa.array([x for _, x in found], pa.binary())], names=["bucket", "chunk_id", "blob"])

    sent = map_arrow(chunks, send, "bucket int, chunk_id bigint, blob binary")
    answers = stage(sent.groupBy("bucket").applyInArrow(answer, "bucket int, chunk_id bigint, kind int, blob binary"), "lm-answers")
    del sent
    both = F.split(F.col("blob").cast("string"), " ")
    totals = answers.filter("kind = 0").select(both[0].cast("long").alias("n"), both[1].cast("long").alias("v"))
    n_all, v_all = totals.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()
    release(docs.sparkSession)  # after another job, since Spark holds on to the last one

    def end(left: pa.Table, right: pa.Table) -> pa.Table:
        batch, g = grams(left.column("payload")[0].as_buffer())
        count, share, weight, share3 = np.zeros(len(g.names), np.int64), *(np.zeros(n, np.uint16) for n in (g.upto[-1], g.upto[-1], g.upto3[-1]))
        for b, blob in zip(right.column("bucket").to_pylist(), right.column("blob").to_pylist(), strict=True):
            lo, hi = g.bounds[b], g.bounds[b + 1]
            a, z = g.upto[lo], g.upto[hi]
            raw = zstandard.ZstdDecompressor().decompress(blob)
            n3 = g.upto3[z] - g.upto3[a]
            count[lo:hi], share[a:z], weight[a:z], share3[g.upto3[a] : g.upto3[z]] = _from_planes(raw, [hi - lo, z - a, z - a, n3], ["<u8", "<u2", "<u2", "<u2"])
        c = count[g.word]
        base = (c + 1) / (n_all + v_all + 1)
        before = count[np.where(g.begins, g.sentence, g.context_word)]
        p = restore(share[g.pair]) + PRIORS[0] / (before + PRIORS[0]) * base
        under = weight[g.pair[g.third - 1]]
        p[g.third] = restore(share3[g.triple]) + np.where(under > 0, restore(under), 1.0) * p[g.third]
        first = np.concatenate([[0], np.cumsum(g.n_tokens)])[:-1]
        sums = [np.add.reduceat(x, first) for x in (np.log10(base), np.log10(p), (c > 0).astype(np.int64))]
        return pa.table({"doc_id": batch.column("doc_id"), "trained": batch.column("trained"), "n_tokens": pa.array(g.n_tokens), "n_known": pa.array(sums[2]), "train_tokens": pa.array(np.full(batch.num_rows, n_all, np.int64)), "base_score": pa.array(sums[0]), "score": pa.array(sums[1])})

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, trained boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    asked = answers.filter("kind = 1").drop("kind")
    return chunks.groupBy("chunk_id").cogroup(asked.groupBy("chunk_id")).applyInArrow(end, schema)


def _frequent(chunks: DataFrame, total: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of words and pairs to split into several contexts, sorted, and into how many, from those of all chunks.

    A chunk names the words and pairs that are more frequent in it, by its bytes, than `limit` would be in all text. The chunks
    that don't name one have less than `limit` of it together, so that one of twice as many tokens is split
    wherever it stands. At most one word and one pair in `limit` tokens are split. Only the layout of the exchange follows from
    this; any choice gives the same scores.
    """
    limit = max(FAN_TOKENS, total >> 20)

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload in batch.column("payload"):
                values = to_bytes(unpack_chunk(payload.as_buffer()).column("text"))
                h, text, _ = tokens(values)
                begins = np.ones(len(text), bool)
                begins[1:] = text[1:] != text[:-1]
                word, n = np.unique(np.concatenate([h, pair_hash(_before(h, begins), h)]), return_counts=True)
                keep = n * max(1, total) >= limit * sum(map(len, values))
                yield pa.RecordBatch.from_arrays([pa.array(word[keep].view(np.int64)), pa.array(n[keep])], names=["word", "n"])

    rows = map_arrow(chunks.select("payload"), named, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") > limit).collect()
    found = sorted((r.word % (1 << 64), -(-r.n // limit)) for r in rows)
    return np.array([w for w, _ in found], np.uint64), np.array([k for _, k in found], np.uint64)
