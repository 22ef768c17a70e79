"""Alignment of two tokenizers' ids of the same text: windows between verified anchors, aligned once for each id tuple."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import groups, if_small, join_frequent, map_arrow, quoted, schema_with, stage, unused, with_columns
from .piece_bpe import MARK, PieceBpe, read_vocabulary, text_parts

#: How byte-level vocabularies cut a text; a fixed value.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NEW = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256"]


def byte_alphabet() -> dict[str, int]:
    """The bytes that the characters of byte-level entries stand for: printable ones themselves, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(0x100 + i): b for i, b in enumerate(other)}}


def byte_level_tokens(vocabulary: bytes) -> list[bytes]:
    """What the ids of a byte-level vocabulary in JSON stand for; special entries have no bytes.

    Ids must follow the order of merges, so that they are ranks of merges too.
    """
    given = json.loads(vocabulary)
    rules = given.get("pre_tokenizer") or {}
    if given["model"]["type"] != "BPE" or given.get("normalizer") or rules.get("type") != "ByteLevel" or rules.get("add_prefix_space") or not rules.get("use_regex", True):
        raise ValueError("not a byte-level vocabulary over texts as they are")
    ids = given["model"]["vocab"]
    merged = [ids["".join(m.split(" ") if isinstance(m, str) else m)] for m in given["model"]["merges"]]
    if merged != sorted(merged):
        raise ValueError("the ids of this vocabulary don't follow the order of its merges")
    of, special = byte_alphabet(), {t["content"] for t in given.get("added_tokens", [])}
    out = [b""] * (max(ids.values()) + 1)
    for token, i in ids.items():
        if token not in special:
            out[i] = bytes(of[c] for c in token)
    return out


class Growing:
    """Lists of numbers one after another, which are gathered by their places."""

    def __init__(self) -> None:
        self.flat, self.first, self.size = np.zeros(1 << 16, np.int64), np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        self.n = self.used = 0

    def add(self, values: np.ndarray, sizes: np.ndarray) -> None:
        while self.used + len(values) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.n + len(sizes) > len(self.first):
            self.first, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.first, self.size))
        self.flat[self.used : self.used + len(values)] = values
        self.size[self.n : self.n + len(sizes)] = sizes
        self.first[self.n : self.n + len(sizes)] = self.used + np.cumsum(sizes) - sizes
        self.n, self.used = self.n + len(sizes), self.used + len(values)

    def gather(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of these lists in order, and the size of each list."""
        size = self.size[at]
        total = np.cumsum(size)
        return self.flat[np.repeat(self.first[at] - (total - size), size) + np.arange(total[-1] if len(total) else 0)], size


class Aligner:
    """Encodes texts, with a blank before each, by two vocabularies and aligns the ids.

    What is remembered, segments' ids and windows' alignments, is bounded: when it is too much, all is forgotten.
    """

    def __init__(self, vocabulary_a: bytes, vocabulary_b: bytes, most_segments: int = 500_000, most_windows: int = 500_000):
        import tiktoken

        self.b = PieceBpe(vocabulary_b, 1)
        tokens_a = byte_level_tokens(vocabulary_a)
        # no special tokens: their strings in a text are ordinary text
        self.a = tiktoken.Encoding("a", pat_str=BYTE_LEVEL, mergeable_ranks={t: i for i, t in enumerate(tokens_a) if t}, special_tokens={})
        self.size_a, self.size_b = (np.array([len(t) for t in tokens], dtype=np.int64) for tokens in (tokens_a, self.b.token))
        self.marked_a = np.array([t[:1] == b" " for t in tokens_a])
        self.marked_b = np.array([p[0] == MARK for p in self.b.pieces])
        # each id as text with what follows it: a comma, or what ends its side of a group
        self.text_a = [f"{i}{after}" for i in range(len(self.size_a)) for after in ",|"]
        self.text_b = [f"{i}{after}" for i in range(len(self.size_b)) for after in (",", ";", "")]
        self.most_segments, self.most_windows = most_segments, most_windows
        self._forget_segments()
        self._forget_windows()

    def _forget_segments(self) -> None:
        self.segments: dict[str, int] = {}
        self.ids_a, self.ids_b = Growing(), Growing()

    def _forget_windows(self) -> None:
        self.windows: dict[bytes, int] = {}
        self.written: list[str] = []
        self.counts, self.links = Growing(), Growing()

    def _learn(self, segments: list[str]) -> None:
        for i in range(0, len(segments), 10_000):
            new = segments[i : i + 10_000]
            ids_a = [self.a.encode_ordinary(s) for s in new]
            # B's library puts a blank before each
            ids_b = self.b.library.encode([s.removeprefix(" ") for s in new], num_threads=1)
            for k, s in enumerate(new):
                if s[0] != " ":
                    ids_b[k] = ids_b[k][1:] if self.b.pieces[ids_b[k][0]] == MARK else self.b.merged(s)
                elif len(s) == 1:
                    ids_b[k] = [self.b.ids[MARK]]
            for table, ids in ((self.ids_a, ids_a), (self.ids_b, ids_b)):
                table.add(np.array([x for own in ids for x in own], dtype=np.int64), np.array([len(own) for own in ids], dtype=np.int64))
            self.segments.update(zip(new, range(len(self.segments), len(self.segments) + len(new)), strict=True))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All ids of A and of B over the texts, and how many each text has; a blank is put before each text.

        Neither vocabulary has a token over the edge of a segment, so that each segment is encoded once. A text that
        is empty, or has the character that B writes for blanks (its pieces then are of other bytes), has no ids.
        """
        cut = [[s for part in text_parts(" " + t, self.b.edge) for s in self.b.segment.findall(part)] if t and MARK not in t else [] for t in texts]
        every = [s for segments in cut for s in segments]
        if len(self.segments) > self.most_segments:
            self._forget_segments()
        known = self.segments.get
        at = [known(s) for s in every]
        if None in at:
            new = [k for k, i in enumerate(at) if i is None]
            self._learn(list(dict.fromkeys([every[k] for k in new])))
            for k in new:
                at[k] = self.segments[every[k]]
        at = np.array(at, dtype=np.int64)
        bound = np.concatenate([[0], np.cumsum([len(s) for s in cut])])
        a, size_a = self.ids_a.gather(at)
        b, size_b = self.ids_b.gather(at)
        upto_a, upto_b = (np.concatenate([[0], np.cumsum(x)])[bound] for x in (size_a, size_b))
        return a, np.diff(upto_a), b, np.diff(upto_b)

    def anchors(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many tokens of A and of B come before the end of each window of texts that follow each other.

        A window ends where tokens of both end at the same byte and the next ones of both begin with a blank.
        """
        end_a, end_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        if len(a) and end_a[-1] != end_b[-1]:
            raise ArithmeticError("the tokens of a text don't have the same bytes")
        _, i, j = np.intersect1d(end_a, end_b, assume_unique=True, return_indices=True)
        i, j = i + 1, j + 1
        anchor = np.append(self.marked_a[a[i[:-1]]] & self.marked_b[b[j[:-1]]], True)
        return i[anchor], j[anchor]

    def _align(self, a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray) -> None:
        """Remembers alignments of windows that follow each other, of n_a and n_b tokens each: the groups as text, the
        counts of groups and links, and the linked pairs.
        """
        end_a, end_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        stop = end_a[np.cumsum(n_a) - 1]  # where windows end
        # between neighbouring ends of either lies one overlap of a token of A and one of B
        ends = np.union1d(end_a, end_b)
        linked = a[np.searchsorted(end_a, ends)] * len(self.size_b) + b[np.searchsorted(end_b, ends)]
        n_links = np.diff(np.searchsorted(ends, stop, side="right"), prepend=0)
        shared, i, j = np.intersect1d(end_a, end_b, assume_unique=True, return_indices=True)
        n_groups = np.diff(np.searchsorted(shared, stop, side="right"), prepend=0)
        # tokens group by group, those of A first, as text
        own_a, own_b = np.diff(i + 1, prepend=0), np.diff(j + 1, prepend=0)
        place_a = np.arange(len(a)) + np.repeat(np.cumsum(own_b) - own_b, own_a)
        place_b = np.arange(len(b)) + np.repeat(np.cumsum(own_a), own_b)
        after_a, after_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        after_a[i], after_b[j] = 1, 1
        after_b[np.cumsum(n_b) - 1] = 2
        text = np.empty(len(a) + len(b), dtype=object)
        text[place_a] = [self.text_a[k] for k in (a * 2 + after_a).tolist()]
        text[place_b] = [self.text_b[k] for k in (b * 3 + after_b).tolist()]
        text, bounds = text.tolist(), [0, *np.cumsum(n_a + n_b).tolist()]
        self.written += ["".join(text[x:y]) for x, y in zip(bounds[:-1], bounds[1:], strict=True)]
        self.counts.add(np.stack([n_groups, n_links], axis=1).ravel(), np.full(len(n_a), 2))
        self.links.add(linked, n_links)

    def aligned(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of each window's alignment among those remembered, and how many tokens of A come before its end."""
        if len(self.windows) > self.most_windows:
            self._forget_windows()
        if not len(a):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        end_a, end_b = self.anchors(a, b)
        # each window's tuple: its ids of A, then those of B with a bit that tells them apart
        n_a, n_b = np.diff(end_a, prepend=0), np.diff(end_b, prepend=0)
        end = end_a + end_b
        tuples = np.empty(len(a) + len(b), dtype="<u4")
        tuples[np.arange(len(a)) + np.repeat(end_b - n_b, n_a)] = a
        tuples[np.arange(len(b)) + np.repeat(end_a, n_b)] = b + (1 << 31)
        raw, stops = tuples.tobytes(), (4 * end).tolist()
        keys = [raw[x:y] for x, y in zip([0, *stops], stops)]  # noqa: B905  one start more
        known = self.windows.get
        at = [known(k) for k in keys]
        lacking = [i for i, x in enumerate(at) if x is None]
        if lacking:
            new = {keys[i]: i for i in lacking}
            i = np.fromiter(new.values(), np.int64, len(new))
            of_a, of_b = (np.repeat(start[i] - np.cumsum(n[i]) + n[i], n[i]) + np.arange(n[i].sum()) for start, n in ((end_a - n_a, n_a), (end_b - n_b, n_b)))
            self._align(a[of_a], n_a[i], b[of_b], n_b[i])
            self.windows.update(zip(new, range(len(self.windows), len(self.windows) + len(new)), strict=True))
            for i in lacking:
                at[i] = self.windows[keys[i]]
        return np.array(at, dtype=np.int64), end_a

    def report(self, texts: list[str]) -> dict[str, list | np.ndarray]:
        """n_a, n_b, n_groups, n_links, groups_sha256 of each text, its distinct linked pairs, and how often each occurs."""
        a, n_a, b, n_b = self.encode(texts)
        at, end = self.aligned(a, b)
        bound = np.concatenate([[0], np.searchsorted(end, np.cumsum(n_a), side="right")])  # windows of each text
        counts = self.counts.gather(at)[0].reshape(-1, 2)
        total = np.concatenate([np.zeros((1, 2), np.int64), np.cumsum(counts, axis=0)])
        sums = total[bound[1:]] - total[bound[:-1]]
        written = [self.written[i] for i in at.tolist()]
        sha = [hashlib.sha256(";".join(written[x:y]).encode()).hexdigest() if y > x else "" for x, y in zip(bound[:-1].tolist(), bound[1:].tolist(), strict=True)]
        links, _ = self.links.gather(at)
        links_upto = np.concatenate([[0], np.cumsum(sums[:, 1])])
        pairs, times = [], []
        for x, y in zip(links_upto[:-1].tolist(), links_upto[1:].tolist(), strict=True):
            own, n = np.unique(links[x:y], return_counts=True)
            pairs.append(own)
            times.append(n)
        return {"n_a": n_a, "n_b": n_b, "n_groups": sums[:, 0], "n_links": sums[:, 1], "groups_sha256": sha, "pairs": pairs, "times": times}


_made: dict[str, Aligner] = {}


def aligner_from(vocabulary_a: bytes, vocabulary_b: bytes) -> Aligner:
    """One aligner per worker and pair of vocabularies."""
    key = hashlib.sha256(vocabulary_a).hexdigest() + hashlib.sha256(vocabulary_b).hexdigest()
    if key not in _made:
        _made[key] = Aligner(vocabulary_a, vocabulary_b)
    return _made[key]


def _listed(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    first = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(first), pa.array(np.concatenate([*values, np.zeros(0, np.int64)])).cast(kind))


def _reports(docs: DataFrame, a: str, b: str, group_bytes: int) -> DataFrame:
    context = docs.sparkSession.sparkContext
    given = [context.broadcast(read_vocabulary(f)) for f in (a, b)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = aligner_from(given[0].value, given[1].value)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for lo, hi in groups(texts, group_bytes):
                got = aligner.report(texts[lo:hi])
                columns = [*(pa.array(got[c], pa.int64()) for c in NEW[:4]), pa.array(got["groups_sha256"], pa.string()), _listed(got["pairs"], pa.int64()), _listed(got["times"], pa.int32())]
                rows = batch.slice(lo, hi - lo)
                yield with_columns(rows.drop_columns(["text"]), [*NEW, "pairs", "times"], columns)

    return map_arrow(docs, run, schema_with(docs.drop("text"), "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, pairs array<bigint>, times array<int>"))


def pair_counts(reports: DataFrame) -> DataFrame:
    """pair, n (how many documents hold it) and best (whether no pair of the same id of A has more), of what _reports gives.

    Counts are added up within tasks before anything is shuffled. There is a row for each pair that occurs.
    """
    width = F.col("b_size")
    counts = stage(reports.select(F.explode("pairs").alias("pair"), "b_size").groupBy("pair", "b_size").agg(F.count("*").alias("n")), "pair-counts")
    of_a = F.floor(F.col("pair") / width).cast("int")
    most = stage(counts.groupBy(of_a.alias("a")).agg(F.max("n").alias("most")), "pair-best")  # a row for each id of A
    joined = counts.withColumn("a", of_a).join(if_small(most), "a")
    return joined.select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def align_tokens(docs: DataFrame, vocabulary_a: str, vocabulary_b: str, group_bytes: int = 1 << 20) -> DataFrame:
    """docs without text, with n_a, n_b, n_groups, n_links, groups_sha256, n_best and count_sum added, or replaced.

    Each text, with a blank before it, is encoded by a byte-level vocabulary in JSON (A) and by a vocabulary of scored
    merges (B), both without special tokens. Byte offsets where tokens of both end cut them into groups; tokens whose
    bytes overlap are linked. A pair's count is the number of documents (rows) that hold it linked; n_best is how many links
    have the highest count of their id of A, count_sum the sum of counts over the links.

    Null and empty texts, and those that B writes with other bytes, have zeros and '' for a digest. Repeated rows count as
    documents of their own, ties are all best. A text of any length is cut into segments part by part, its ids are in
    memory together. Columns of docs stay, but for text and those of the new names in any case. Its jobs run when it is
    called. Pairs and their counts are a row each, at most one for each two ids; the frequent ones are broadcast up to
    BROADCAST_ROWS, the rest joined by a shuffle.
    """
    row = unused(docs.columns, "__row")
    n_b = len(PieceBpe(read_vocabulary(vocabulary_b), 1).pieces)
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    reports = stage(_reports(numbered, vocabulary_a, vocabulary_b, group_bytes), "token-reports")
    counts = pair_counts(reports.select("pairs", F.lit(n_b).alias("b_size")))
    links = reports.select(F.col(quoted(row)).alias("row"), F.inline(F.arrays_zip("pairs", "times")).alias("pair", "times"))
    met = join_frequent(links, counts.withColumn("docs", F.col("n")), "pair", "n")
    sums = met.groupBy("row").agg(F.sum(F.col("times") * F.col("docs")).alias("count_sum"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"))
    kept = [c for c in reports.columns if c.lower() not in ("pairs", "times", "n_best", "count_sum", row)]
    other = unused(reports.columns, "__found")
    joined = reports.drop("pairs", "times", "n_best", "count_sum").join(sums.withColumnRenamed("row", other), F.col(quoted(row)) == F.col(other), "left")
    return joined.select(*map(quoted, kept), F.coalesce(sums["n_best"], F.lit(0)).cast("bigint").alias("n_best"), F.coalesce(sums["count_sum"], F.lit(0)).cast("bigint").alias("count_sum"))
