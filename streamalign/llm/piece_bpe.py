"""SentencePiece encoding and decoding for vocabularies of merges: an agenda of adjacent pairs in the order of scores."""

from __future__ import annotations

import codecs
import hashlib
import heapq
import re
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import groups, map_arrow, schema_with, with_columns

#: How vocabularies write a blank.
MARK = "▁"
#: Kinds of pieces and the model type in a vocabulary file; fixed values of its format.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
MERGES = 2
#: All white space of one character.
BLANKS = [c for c in map(chr, range(0x3001)) if c.isspace()]
#: A long text is encoded in parts of about so many characters, cut between segments.
PART = 1 << 20
#: The agenda of a segment up to this length is a list.
SHORT = 24
NEVER = float("inf")
#: Segments up to this length are remembered.
REMEMBERED = 48


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of a message's fields."""
    i = 0

    def number() -> int:
        nonlocal i
        out = shift = 0
        while True:
            byte = raw[i]
            i += 1
            out |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return out

    while i < len(raw):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(key & 7) or number()
        yield key >> 3, raw[i : i + size]
        i += size


def text_parts(text: str, edge: re.Pattern) -> Iterator[str]:
    """The text in parts of about PART characters, cut at edges; a part without an edge is longer."""
    at = 0
    while len(text) - at > PART and (found := edge.search(text, at + PART)):
        yield text[at : found.start()]
        at = found.start()
    yield text[at:]


def edges(pieces: Iterable[str]) -> tuple[re.Pattern, re.Pattern]:
    """Patterns of a segment, and of the empty string between segments, which no piece goes over.

    A segment is a run of white space, if any, and what follows it up to the next white space; but where a piece has
    this white space after another character (as a carriage return), the segment goes on.
    """
    inside: set[str] = set()
    while True:
        edge = {*BLANKS, MARK} - inside
        more = {b for p in pieces for a, b in zip(p, p[1:], strict=False) if a not in edge and b in edge}
        if not more:
            break
        inside |= more
    if " " in inside or MARK in inside:
        return re.compile(r"(?s:.+)"), re.compile(r"(?!)")
    on = re.escape("".join(sorted(inside)))
    return re.compile(rf"\s*\S+(?:[{on}]\s*\S*)*|\s+" if on else r"\s*\S+|\s+"), re.compile(rf"(?<=\S)(?=[^\S{on}])")


class PieceBpe:
    """Encodes as the sentencepiece library does with a vocabulary of merges, without sampling, and decodes.

    Only what such vocabularies commonly have is accepted: text isn't normalised, a blank is put before it, and
    characters that no piece has are written as bytes.
    """

    def __init__(self, model: bytes, most_remembered: int = 500_000):
        import sentencepiece

        message = list(_fields(model))
        trained, rules = (dict(_fields(next((v for f, v in message if f == part), b""))) for part in (2, 3))
        pieces = [dict(_fields(v)) for f, v in message if f == 1]
        kind = np.array([p.get(3, NORMAL) for p in pieces])
        self.pieces = [p[1].decode() for p in pieces]
        score = [float(np.frombuffer(p.get(2, b"\0" * 4), "<f4")[0]) for p in pieces]
        if trained.get(3) != MERGES or rules.get(2) or not rules.get(3, 1) or rules.get(4, 1) or not rules.get(5, 1) or trained.get(24):
            raise ValueError("not a vocabulary of merges over texts as they are, with a blank put before them")
        if (kind == BYTE).sum() != 256 or not set(kind.tolist()) <= {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("the vocabulary must write unknown characters as bytes, and have no pieces defined by users")
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.begin, self.end = self.library.bos_id(), self.library.eos_id()
        self.ids = {p: i for i, p in enumerate(self.pieces) if kind[i] == NORMAL}
        self.byte_id = [0] * 256
        for i in np.flatnonzero(kind == BYTE).tolist():
            self.byte_id[int(self.pieces[i][3:5], 16)] = i
        self.rank = {p: -score[i] for p, i in self.ids.items()}  # the smallest is the best
        #: What each id stands for, in bytes
        self.token = [b"" if k == CONTROL else bytes([int(p[3:5], 16)]) if k == BYTE else p.replace(MARK, " ").encode() for p, k in zip(self.pieces, kind.tolist(), strict=True)]
        self.segment, self.edge = edges(list(self.ids))
        self.most_remembered = most_remembered
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def merged(self, text: str) -> list[int]:
        """The ids of a text with marks for blanks.

        The agenda holds adjacent pairs that make a piece, the best score first and the first of equals; symbols are
        linked by their neighbours' starts, and entries whose symbols have changed since are passed over.
        """
        n = len(text)
        if n <= SHORT:
            return self._short(text)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        get = self.rank.get
        agenda = [(r, i, i + 2) for i in range(n - 1) if (r := get(text[i : i + 2])) is not None]
        heapq.heapify(agenda)
        pop, push = heapq.heappop, heapq.heappush
        while agenda:
            _, i, end = pop(agenda)
            mid = after[i]
            if mid < 0 or mid >= n or after[mid] != end:
                continue
            after[i], after[mid] = end, -1
            if end < n:
                before[end] = i
                far = after[end]
                if (r := get(text[i:far])) is not None:
                    push(agenda, (r, i, far))
            if (left := before[i]) >= 0 and (r := get(text[left:end])) is not None:
                push(agenda, (r, left, end))
        symbols, i = [], 0
        while i < n:
            symbols.append(text[i : after[i]])
            i = after[i]
        return self._ids_of(symbols)

    def _short(self, text: str) -> list[int]:
        """As merged, with an agenda that is short enough to be searched for its best entry: ranks[i] is that of symbols i and i + 1."""
        symbols, get = list(text), self.rank.get
        ranks = [get(a + b, NEVER) for a, b in zip(symbols, symbols[1:])]  # noqa: B905
        while ranks and (best := min(ranks)) < NEVER:
            i = ranks.index(best)
            pair = symbols[i] + symbols.pop(i + 1)
            symbols[i] = pair
            del ranks[i]
            if i < len(ranks):
                ranks[i] = get(pair + symbols[i + 1], NEVER)
            if i:
                ranks[i - 1] = get(symbols[i - 1] + pair, NEVER)
        return self._ids_of(symbols)

    def _ids_of(self, symbols: list[str]) -> list[int]:
        out, ids = [], self.ids.get
        for symbol in symbols:
            found = ids(symbol)
            if found is not None:
                out.append(found)
            else:  # one character
                out.extend([self.byte_id[b] for b in symbol.encode()])
        return out

    def codes(self, segments: list[str]) -> list[bytes]:
        """The ids of each segment as little-endian 32-bit numbers; new segments are checked against the library."""
        known = self.recent.get
        out = [known(s) for s in segments]
        if None in out:
            new = [s for s in dict.fromkeys(s for s, code in zip(segments, out, strict=True) if code is None)]
            found = {s: self.older.get(s) for s in new}
            lacking = [s for s, code in found.items() if code is None]
            learned = [self.merged(s.replace(" ", MARK)) for s in lacking]
            self.check(lacking, learned)
            found.update(zip(lacking, (struct.pack(f"<{len(x)}I", *x) for x in learned), strict=True))
            if len(self.recent) + len(found) > self.most_remembered:
                self.recent, self.older = {}, self.recent
            self.recent.update((s, code) for s, code in found.items() if len(s) <= REMEMBERED)
            out = [code if code is not None else found[s] for s, code in zip(segments, out, strict=True)]
        return out

    def check(self, segments: list[str], found: list[list[int]]) -> None:
        """Raises if the library encodes a segment otherwise. It puts a blank before each, which is taken off again."""
        asked = [i for i, s in enumerate(segments) if s != " "]
        given = self.library.encode([segments[i].removeprefix(" ") for i in asked], num_threads=1) if asked else []
        for i, ids in zip(asked, given, strict=True):
            if segments[i][0] != " ":
                if self.pieces[ids[0]] != MARK:  # the blank is part of a piece here, so there is nothing to compare
                    continue
                ids = ids[1:]
            if ids != found[i]:
                raise ArithmeticError(f"the sentencepiece library encodes {segments[i][:100]!r} otherwise")

    def encode(self, text: str) -> list[bytes]:
        """The ids of a text, in parts of little-endian 32-bit numbers, without begin and end."""
        if not text:
            return []
        spaced = " " + text.replace(MARK, " ")
        return [b"".join(self.codes(self.segment.findall(part))) for part in text_parts(spaced, self.edge)]

    def decode(self, ids: list[int]) -> str:
        """As the library: marks are blanks, the first of which goes; bytes that are no UTF-8 become U+FFFD each."""
        data = b"".join([self.token[i] for i in ids])
        first = next((i for i in ids if self.token[i]), None)
        if first is not None and self.pieces[first][0] == MARK:
            data = data[1:]
        try:
            return data.decode()
        except UnicodeDecodeError:
            return data.decode(errors="one_by_one")


def _one_by_one(error: UnicodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


codecs.register_error("one_by_one", _one_by_one)

_made: dict[str, PieceBpe] = {}


def piece_bpe_from(model: bytes) -> PieceBpe:
    """One encoder per worker and vocabulary."""
    key = hashlib.sha256(model).hexdigest()
    if key not in _made:
        _made[key] = PieceBpe(model)
    return _made[key]


def read_vocabulary(file: str, most: int = 64 << 20) -> bytes:
    """A vocabulary file, read on the driver to be sent along; over `most` bytes is refused."""
    with open(file, "rb") as f:
        out = f.read(most + 1)
    if len(out) > most:
        raise ValueError(f"a vocabulary of over {most} bytes isn't sent to all tasks")
    return out


def tokenize_pieces(docs: DataFrame, vocabulary_file: str, with_ids: bool = True, group_bytes: int = 1 << 20) -> DataFrame:
    """docs with n_tokens, ids_sha256, decoded_sha256 and (with_ids) the ids of each text added, or replaced.

    All ids are counted, with begin and end ones; a null or empty text has just these. decoded_sha256 is of the text
    that the ids decode to. What the agenda gives is compared with the sentencepiece library: each new segment when it
    is first met in a worker, and the decoded text of each row; a difference ends the job. Repeated rows give repeated
    results. A text of any length is encoded in parts, but its ids and its decoded text are in memory together. Columns
    of docs stay, but for those of the new names in any case. vocabulary_file is read on the driver and sent along.
    """
    new = ["n_tokens", "ids_sha256", "decoded_sha256", *["ids"][:with_ids]]
    model = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_file))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = piece_bpe_from(model.value)
        begin, end = (np.array([x], dtype="<u4").tobytes() for x in (bpe.begin, bpe.end))
        for batch in batches:
            values = [x or "" for x in batch.column("text").to_pylist()]
            for lo, hi in groups(values, group_bytes):
                codes = [b"".join([begin, *bpe.encode(text), end]) for text in values[lo:hi]]
                ids = [np.frombuffer(x, dtype="<u4") for x in codes]
                listed = [x.tolist() for x in ids]
                decoded = [bpe.decode(x) for x in listed]
                if decoded != bpe.library.decode(listed, num_threads=1):
                    raise ArithmeticError("the sentencepiece library decodes a text otherwise")
                columns = [pa.array([len(x) for x in ids], pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in codes], pa.string()), pa.array([hashlib.sha256(x.encode()).hexdigest() for x in decoded], pa.string())]
                if with_ids:
                    columns.append(pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())))
                yield with_columns(batch.slice(lo, hi - lo), new, columns)

    return map_arrow(docs, run, schema_with(docs, "n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids))
