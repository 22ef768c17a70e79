"""Media columns: AVI files of motion JPEG, written and read with NumPy, and the shots in them.

Written frames are grey, 8 bits, in the lossless process of JPEG (SOF3, predictor 1, a restart at each line), so that every
sample comes back as stored. Lines decode independently, which lets one step decode a sample of each line at once. Baseline
frames (SOF0), as cameras write them, are read too.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import groups, map_arrow, schema_with, to_bytes, with_columns

WIDTH, HEIGHT, RATE = 64, 16, 25
#: Code lengths of the difference categories 0 to 8 in our files; readers take the table from each file.
LENGTHS = (5, 4, 3, 3, 2, 3, 6, 2, 7)
BINS, NEAR = 16, 6


def _canonical(lengths: dict[int, int]) -> dict[int, tuple[int, int]]:
    """Category -> (code, length), in order of length and then as listed."""
    out, code, last = {}, 0, 0
    for cat, n in sorted(lengths.items(), key=lambda x: x[1]):
        code <<= n - last
        out[cat], last = (code, n), n
        code += 1
    return out


def _code_table(codes: dict[int, tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Bits and length for the differences -255 .. 255, at difference + 255."""
    bits, size = np.zeros(511, np.int64), np.zeros(511, np.int64)
    for d in range(-255, 256):
        cat = abs(d).bit_length()
        code, n = codes[cat]
        bits[d + 255] = code << cat | (d if d >= 0 else d + (1 << cat) - 1)
        size[d + 255] = n + cat
    return bits, size


def _reader_table(codes: dict[int, tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Difference and bits used for every 16 bits; 0 used where no code or a longer one begins."""
    diff, used = np.zeros(1 << 16, np.int16), np.zeros(1 << 16, np.uint8)
    for cat, (code, n) in codes.items():
        if n + cat > 16:
            continue
        extra = np.arange(1 << cat)
        value = np.where(extra >= (1 << cat) >> 1, extra, extra - (1 << cat) + 1) if cat else extra
        step = 1 << (16 - n - cat)
        lo = code << (16 - n)
        diff[lo : lo + (1 << (16 - n))] = np.repeat(value, step)
        used[lo : lo + (1 << (16 - n))] = n + cat
    return diff, used


_CODES = _canonical(dict(enumerate(LENGTHS)))
_BITS, _SIZE = _code_table(_CODES)


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def frame_header(width: int, height: int) -> bytes:
    by_length = sorted(_CODES, key=lambda c: (_CODES[c][1], _CODES[c][0]))
    counts = [sum(n == k for _, n in _CODES.values()) for k in range(1, 17)]
    return b"".join([
        b"\xff\xd8",
        _segment(0xC4, bytes([0x00, *counts, *by_length])),
        _segment(0xC3, struct.pack(">BHHB3B", 8, height, width, 1, 1, 0x11, 0)),
        _segment(0xDD, struct.pack(">H", width)),
        _segment(0xDA, bytes([1, 1, 0x00, 1, 0, 0])),
    ])


def encode_lines(samples: np.ndarray, height: int) -> tuple[bytes, np.ndarray]:
    """Scans of the frames whose lines are the rows of samples, one after the other, and where each ends."""
    rows, width = samples.shape
    x = samples.astype(np.int16)
    diff = np.empty_like(x)
    diff[:, 0] = x[:, 0] - 128
    np.subtract(x[:, 1:], x[:, :-1], out=diff[:, 1:])
    diff += 255
    bits, size = _BITS[diff], _SIZE[diff]
    upto = np.cumsum(size, axis=1)
    n_bytes = (upto[:, -1] + 7) >> 3
    base = np.cumsum(n_bytes) - n_bytes
    at = ((base << 3)[:, None] + upto - size).ravel()
    window = bits.ravel() << (24 - (at & 7) - size.ravel())
    first, total = at >> 3, int(n_bytes.sum())
    out = np.zeros(total + 3, dtype=np.int64)
    for k in range(3):
        out[: total + 3] += np.bincount(first + k, weights=(window >> (16 - 8 * k)) & 0xFF, minlength=total + 3).astype(np.int64)
    fill = (n_bytes << 3) - upto[:, -1]
    out[base + n_bytes - 1] += (1 << fill) - 1
    data = out[:total].astype(np.uint8)
    # a zero after each 0xFF; after each line a restart marker, after a frame's last line the end of the image
    stuffed = data == 0xFF
    before = np.concatenate([[0], np.cumsum(stuffed)])
    line = np.repeat(np.arange(rows), n_bytes)
    place = np.arange(total) + before[:-1] + 2 * line
    scan = np.zeros(total + int(before[-1]) + 2 * rows, dtype=np.uint8)
    scan[place] = data
    mark = base + n_bytes + before[base + n_bytes] + 2 * np.arange(rows)
    in_frame = np.arange(rows) % height
    scan[mark] = 0xFF
    scan[mark + 1] = np.where(in_frame == height - 1, 0xD9, 0xD0 + in_frame % 8)
    return scan.tobytes(), mark[height - 1 :: height] + 2


def _chunk(name: bytes, body: bytes) -> bytes:
    return name + struct.pack("<I", len(body)) + body + b"\0" * (len(body) & 1)


def write_avi(frames: list[bytes], width: int, height: int, rate: int, note: bytes) -> bytes:
    """A RIFF AVI of motion-JPEG frames with an index; note goes to the stream's `strd` chunk."""
    largest = max(map(len, frames))
    main = struct.pack("<14I", 1_000_000 // rate, largest * rate, 0, 0x10, len(frames), 0, 1, largest, width, height, 0, 0, 0, 0)
    stream = b"vidsMJPG" + struct.pack("<IHHIIIIIIII4H", 0, 0, 0, 0, 1, rate, 0, len(frames), largest, 0xFFFFFFFF, 0, 0, 0, width, height)
    image = struct.pack("<IiiHH4sIiiII", 40, width, height, 1, 8, b"MJPG", width * height, 0, 0, 0, 0)
    lists = _chunk(b"LIST", b"hdrl" + _chunk(b"avih", main) + _chunk(b"LIST", b"strl" + _chunk(b"strh", stream) + _chunk(b"strf", image) + _chunk(b"strd", note)))
    movie, index, at = [], [], 4
    for f in frames:
        movie.append(_chunk(b"00dc", f))
        index.append(struct.pack("<4sIII", b"00dc", 0x10, at, len(f)))
        at += len(movie[-1])
    return _chunk(b"RIFF", b"AVI " + lists + _chunk(b"LIST", b"movi" + b"".join(movie)) + _chunk(b"idx1", b"".join(index)))


def _chunks(data: bytes, lo: int, hi: int) -> Iterator[tuple[bytes, int, int]]:
    """Name, first and last byte of each chunk between lo and hi."""
    while lo + 8 <= hi:
        name, size = data[lo : lo + 4], int.from_bytes(data[lo + 4 : lo + 8], "little")
        if lo + 8 + size > hi:
            raise ValueError("a chunk goes beyond the file or its list")
        yield name, lo + 8, lo + 8 + size
        lo += 8 + size + (size & 1)


def _movie_frames(data: bytes, lo: int, hi: int, names: tuple[bytes, ...]) -> Iterator[bytes]:
    """The chunks of these names in a movie list, in order, those of its record lists included."""
    for name, a, b in _chunks(data, lo, hi):
        if name in names:
            yield data[a:b]
        elif name == b"LIST" and data[a : a + 4] == b"rec ":
            yield from _movie_frames(data, a + 4, b, names)


def _indexed_frames(data: bytes, movie: int, index: tuple[int, int], names: tuple[bytes, ...]) -> list[bytes]:
    entries = [x for x in struct.iter_unpack("<4sIII", data[index[0] : index[0] + (index[1] - index[0]) // 16 * 16]) if x[0] in names]
    # offsets count from the movie list or, in some files, from the file's start
    base = movie if not entries or data[movie + entries[0][2] :][:4] in names else 0
    frames = []
    for name, _, at, size in entries:
        if data[base + at : base + at + 4] != name or base + at + 8 + size > len(data):
            raise ValueError("the index doesn't lead to a frame")
        frames.append(data[base + at + 8 : base + at + 8 + size])
    return frames


def read_avi(data: bytes) -> tuple[list[bytes], float, bytes]:
    """All frames of a file's video stream, frames a second, and the `strd` note.

    The stream may have any number, its chunks be compressed (dc) or not (db). The index tells the frames of the first RIFF
    list; without one, and in the lists of large files that follow (AVIX), they are the stream's chunks in order. A file with
    several video streams, or that ends within a chunk, is an error.
    """
    if data[:4] != b"RIFF" or data[8:12] != b"AVI ":
        raise ValueError("not an AVI file")
    rate, note, streams, videos = 0.0, b"", 0, []
    movies: list[tuple[int, int, bool]] = []  # and whether it is in the first list
    index = None

    def visit(lo: int, hi: int, first: bool) -> None:
        nonlocal rate, note, index, streams
        for name, a, b in _chunks(data, lo, hi):
            kind = data[a : a + 4]
            if name == b"LIST" and kind == b"movi":
                movies.append((a, b, first))
            elif name == b"LIST":
                visit(a + 4, b, first)
            elif name == b"strh":
                if kind == b"vids":
                    videos.append(streams)
                    scale, per = struct.unpack_from("<II", data, a + 20)
                    rate = per / max(1, scale)
                streams += 1
            elif name == b"strd" and videos and videos[-1] == streams - 1:
                note = data[a:b]
            elif name == b"idx1" and first:
                index = (a, b)

    for i, (name, a, b) in enumerate(_chunks(data, 0, len(data))):
        if name == b"RIFF" and data[a : a + 4] in (b"AVI ", b"AVIX"):
            visit(a + 4, b, i == 0)
    if not movies:
        raise ValueError("no movi list")
    if len(videos) != 1:
        raise ValueError(f"{len(videos)} video streams")
    names = tuple(b"%02d" % videos[0] + kind for kind in (b"dc", b"db"))
    frames = []
    for a, b, first in movies:
        frames += _indexed_frames(data, a, index, names) if first and index else _movie_frames(data, a + 4, b, names)
    return frames, rate, note


#: Headers whose tables a worker keeps at once.
MOST_HEADERS = 64
_headers: dict[bytes, tuple[int, int, tuple[np.ndarray, np.ndarray]]] = {}


def _header_end(frame: bytes) -> int:
    at = 2
    while frame[at + 1] != 0xDA:
        at += 2 + int.from_bytes(frame[at + 2 : at + 4], "big")
    return at + 2 + int.from_bytes(frame[at + 2 : at + 4], "big")


def _parse_header(head: bytes) -> tuple[int, int, tuple[np.ndarray, np.ndarray]]:
    """Width, height and reader table of a lossless grey frame with a restart at each line."""
    if head in _headers:
        return _headers[head]
    at, width, height, every, codes = 2, 0, 0, 0, {}
    while at < len(head):
        marker, size = head[at + 1], int.from_bytes(head[at + 2 : at + 4], "big")
        body = head[at + 4 : at + 2 + size]
        if marker == 0xC4:
            symbols = iter(body[17:])
            codes = _canonical({next(symbols): n for n in range(1, 17) for _ in range(body[n])})
        elif marker == 0xC3:
            bits, height, width, parts = struct.unpack(">BHHB", body[:6])
            if bits != 8 or parts != 1:
                raise ValueError("only grey frames of 8 bits are read")
        elif 0xC0 <= marker <= 0xCF:
            raise ValueError("only baseline and lossless frames are read")
        elif marker == 0xDD:
            every = int.from_bytes(body[:2], "big")
        elif marker == 0xDA and (body[-3] != 1 or body[-1] != 0):
            raise ValueError("only predictor 1 without point transform is read")
        at += 2 + size
    if every != width:
        raise ValueError("only frames with a restart at each line are read")
    if len(_headers) >= MOST_HEADERS:
        _headers.clear()
    _headers[head] = width, height, _reader_table(codes)
    return _headers[head]


#: Row-major positions of a block's coefficients in the order they are coded.
_ZIGZAG = sorted(range(64), key=lambda k: (k // 8 + k % 8, k // 8 if (k // 8 + k % 8) % 2 else k % 8))
_COS = np.array([[np.sqrt((1 if u == 0 else 2) / 8) * np.cos((2 * x + 1) * u * np.pi / 16) for x in range(8)] for u in range(8)])


def _symbols(body: bytes) -> tuple[int, tuple[bytes, bytes], bytes]:
    """One Huffman table: its id, symbol and length for every 16 bits, and what follows it in the segment."""
    n = sum(body[1:17])
    values = iter(body[17 : 17 + n])
    symbol, size = bytearray(1 << 16), bytearray(1 << 16)
    for value, (code, k) in _canonical_list([(next(values), k) for k in range(1, 17) for _ in range(body[k])]):
        lo, hi = code << (16 - k), (code + 1) << (16 - k)
        symbol[lo:hi] = bytes([value]) * (hi - lo)
        size[lo:hi] = bytes([k]) * (hi - lo)
    return body[0], (bytes(symbol), bytes(size)), body[17 + n :]


def _canonical_list(values: list[tuple[int, int]]) -> Iterator[tuple[int, tuple[int, int]]]:
    code, last = 0, 0
    for value, k in values:
        code <<= k - last
        yield value, (code, k)
        code, last = code + 1, k


def decode_baseline(frame: bytes) -> np.ndarray:
    """Luminance of a baseline frame (SOF0, one interleaved scan), as motion-JPEG cameras write it."""
    at, every, quant, codes, parts, width, height = 2, 0, {}, {}, {}, 0, 0
    while True:
        marker, size = frame[at + 1], int.from_bytes(frame[at + 2 : at + 4], "big")
        body = frame[at + 4 : at + 2 + size]
        at += 2 + size
        if marker == 0xDB:
            while body:
                wide = body[0] >> 4
                q = np.frombuffer(body[1 : 65 + 64 * wide], ">u2" if wide else "u1").astype(float)
                quant[body[0] & 15], body = q, body[65 + 64 * wide :]
        elif marker == 0xC4:
            while body:
                ident, table, body = _symbols(body)
                codes[ident] = table
        elif marker == 0xC0:
            _, height, width, n = struct.unpack(">BHHB", body[:6])
            parts = {body[6 + 3 * k]: (body[7 + 3 * k] >> 4, body[7 + 3 * k] & 15, body[8 + 3 * k]) for k in range(n)}
        elif marker == 0xDD:
            every = int.from_bytes(body[:2], "big")
        elif marker == 0xDA:
            chosen = [(body[1 + 2 * k], body[2 + 2 * k]) for k in range(body[0])]
            break
        elif 0xC1 <= marker <= 0xCF:
            raise ValueError("only baseline and lossless frames are read")
    if len(chosen) == 1:  # blocks of a single part stand one by one
        parts = {chosen[0][0]: (1, 1, parts[chosen[0][0]][2])}
    across, down = max(p[0] for p in parts.values()), max(p[1] for p in parts.values())
    n_x, n_y = -(-width // (8 * across)), -(-height // (8 * down))
    first = chosen[0][0]
    h0, v0, q0 = parts[first]
    plane = np.zeros((n_y * v0 * 8, n_x * h0 * 8))
    data = frame[at : frame.rindex(b"\xff\xd9")]
    begin = 0
    for piece in re.split(rb"\xff[\xd0-\xd7]", data):
        bits = piece.replace(b"\xff\x00", b"\xff") + b"\xff" * 8
        pos, dc = 0, dict.fromkeys(parts, 0)

        def take(n: int) -> int:
            nonlocal pos
            word = int.from_bytes(bits[pos >> 3 : (pos >> 3) + 5], "big") >> (40 - n - (pos & 7)) & ((1 << n) - 1)
            pos += n
            return word

        def coded(table: tuple[bytes, bytes]) -> int:
            nonlocal pos
            peek = int.from_bytes(bits[pos >> 3 : (pos >> 3) + 3], "big") >> (8 - (pos & 7)) & 0xFFFF
            if not table[1][peek]:
                raise ValueError("a code that isn't in the table")
            pos += table[1][peek]
            return table[0][peek]

        def signed(n: int) -> int:
            x = take(n) if n else 0
            return x if not n or x >> (n - 1) else x - (1 << n) + 1

        for unit in range(begin, min(begin + every, n_x * n_y) if every else n_x * n_y):
            for part, table in chosen:
                h, v, _ = parts[part]
                for k in range(h * v):
                    block = np.zeros(64)
                    dc[part] += signed(coded(codes[table >> 4]))
                    block[0] = dc[part]
                    i = 1
                    while i < 64:
                        run, n = divmod(coded(codes[0x10 | table & 15]), 16)
                        if not n and run < 15:
                            break
                        i += run
                        if n:
                            block[i] = signed(n)
                        i += 1
                    if part == first:
                        square = np.zeros(64)
                        square[_ZIGZAG] = block * quant[q0]
                        y, x = (unit // n_x * v0 + k // h) * 8, (unit % n_x * h0 + k % h) * 8
                        plane[y : y + 8, x : x + 8] = _COS.T @ square.reshape(8, 8) @ _COS
        begin += every
    return np.clip(np.rint(plane[:height, :width] + 128), 0, 255).astype(np.uint8)


def decode_frames(frames: list[bytes]) -> np.ndarray:
    """Luminance samples of frames of one size, frames x height x width: lossless ones at once, baseline ones singly."""
    if frames and b"\xff\xc0" in frames[0][: _header_end(frames[0])]:
        return np.stack([decode_baseline(f) for f in frames])
    heads: set[bytes] = set()
    scans, known = [], b""
    for f in frames:
        if not (known and f.startswith(known)):
            known = f[: _header_end(f)]
            heads.add(known)
        scans.append(f[len(known) :])
    if len(heads) != 1:
        raise ValueError("frames of one file differ in size or table")
    width, height, (table, used) = _parse_header(known)
    s = np.frombuffer(b"".join(scans), dtype=np.uint8)
    full = np.flatnonzero(s[:-1] == 0xFF)
    follows = s[full + 1]
    mark = full[(follows >= 0xD0) & (follows <= 0xD9)]
    drop = np.zeros(len(s), dtype=bool)
    drop[full[follows == 0] + 1] = True
    drop[mark] = True
    drop[mark + 1] = True
    gone = np.cumsum(drop)
    if len(mark) != len(frames) * height:
        raise ValueError("a frame lacks lines")
    data = np.concatenate([s[~drop], np.zeros(8, np.uint8)])
    start = np.concatenate([[0], mark[:-1] + 2 - gone[mark[:-1] + 1]])
    view = np.ndarray((len(data) - 3,), dtype=">u4", buffer=data, strides=(1,))
    bit = start.astype(np.int64) << 3
    out = np.empty((width, len(mark)), dtype=np.int16)
    for k in range(width):
        code = ((view[bit >> 3].astype(np.int64) << (bit & 7)) >> 16) & 0xFFFF
        out[k] = table[code]
        bit += used[code]
    if ((bit + 7) >> 3 != np.append(start[1:], len(data) - 8)).any():
        raise ValueError("a line doesn't end at its marker")
    x = np.cumsum(out, axis=0, dtype=np.int16) + np.int16(128)
    return np.ascontiguousarray(x.T.astype(np.uint8)).reshape(len(frames), height, width)


def payload_of(text: bytes) -> bytes:
    """The text and zeros up to a positive multiple of 64."""
    return text + b"\0" * (-len(text) % 64 or 64 * (not text))


def encode_payloads(values: list[bytes]) -> list[bytes]:
    """An AVI for each payload of whole lines; the last frame is filled with zero lines, the note has the sizes."""
    per = WIDTH * HEIGHT
    payloads = [payload_of(x) for x in values]
    counts = [-(-len(p) // per) for p in payloads]
    lines = np.frombuffer(b"".join(p.ljust(n * per, b"\0") for p, n in zip(payloads, counts, strict=True)), dtype=np.uint8).reshape(-1, WIDTH)
    scan, ends = encode_lines(lines, HEIGHT)
    head = frame_header(WIDTH, HEIGHT)
    bounds = [0, *ends.tolist()]
    frames = [head + scan[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]
    out, at = [], 0
    for x, p, n in zip(values, payloads, counts, strict=True):
        out.append(write_avi(frames[at : at + n], WIDTH, HEIGHT, RATE, struct.pack("<QQ", len(x), len(p))))
        at += n
    return out


def find_shots(histograms: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where shots begin, given frame histograms (as shares) of files whose frames begin at `first` (and the end).

    A cut lies between two frames if the distance of their histograms (half the sum of differences) is over the mean
    plus 3 standard deviations of the NEAR distances before and after it in the same file, plus 0.05.
    """
    n = len(histograms)
    distance = np.zeros(n)
    distance[1:] = np.abs(histograms[1:] - histograms[:-1]).sum(axis=1) / 2
    file = np.repeat(np.arange(len(first) - 1), np.diff(first))
    distance[first[:-1]] = 0
    lo = np.maximum(np.arange(n) - NEAR, first[file] + 1)
    hi = np.minimum(np.arange(n) + NEAR + 1, first[file + 1])
    others = np.maximum(hi - lo - 1, 1)
    one, two = np.zeros(n), np.zeros(n)
    for step in range(-NEAR, NEAR + 1):  # the same few additions for a frame, whatever else is in the batch
        at = np.arange(n) + step
        near = np.where((at >= lo) & (at < hi) & (step != 0), distance[np.clip(at, 0, n - 1)], 0.0) if n else distance
        one, two = one + near, two + near**2
    mean = one / others
    spread = np.sqrt(np.maximum(0, two / others - mean**2))
    begins = distance > mean + 3 * spread + 0.05
    begins[first[:-1]] = True
    return np.flatnonzero(begins), distance


def store_media(docs: DataFrame, name: str = "media", group_bytes: int = 1 << 20) -> DataFrame:
    """docs (with `text`) and, in a new or replaced column, the AVI that holds each text's bytes.

    Null text is empty, and empty text gives 64 zeros.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = to_bytes(batch.column("text"))
            for lo, hi in groups(values, group_bytes):
                yield with_columns(batch.slice(lo, hi - lo), [name], [pa.array(encode_payloads(values[lo:hi]), pa.binary())])

    return map_arrow(docs, run, schema_with(docs, f"`{name}` binary"))


CLIP = "array<struct<first_frame: int, frames: int, start_s: double, end_s: double, change: double>>"


def read_media(stored: DataFrame, group_bytes: int = 1 << 20) -> DataFrame:
    """What the AVI in `media` says, beside doc_id: sizes and digests of its payload, and its timed clips.

    `clips` has a row for each shot: its first frame, number of frames, start and end in seconds, and the histogram
    distance at its start. `feature` has the numbers of frames and shots and a digest of all their bounds. The
    payload is what our files' note says, and all samples of another file. A file that can't be read has its size and
    digest and, in `error`, the reason; a null one has nulls. Each file is judged by itself. Files larger than a task's
    memory aren't meant: a file's samples lie in it at once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            media = batch.column("media").to_pylist()
            for lo, hi in groups([m or b"" for m in media], group_bytes):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), *_inspect(media[lo:hi])], names=names)

    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "clips", "error"]
    kind = stored.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string, clips {CLIP}, error string"
    return map_arrow(stored.select("doc_id", "media"), run, schema)


_OWN_NOTE = struct.Struct("<QQ")


def _decoded(files: list[tuple[list[bytes], float, bytes]]) -> list[np.ndarray | Exception]:
    """The samples of each file, frames x height x width, or why they can't be had; files of one header are decoded together."""
    out: list = [ValueError("no frames")] * len(files)
    alike: dict[bytes, list[int]] = {}
    for k, (frames, _, _) in enumerate(files):
        if frames:
            try:
                head = frames[0][: _header_end(frames[0])]
            except IndexError:
                out[k] = ValueError("a frame without a header")
                continue
            alike.setdefault(head if b"\xff\xc3" in head else b"%d" % k, []).append(k)
    for members in alike.values():
        try:
            samples = decode_frames([x for k in members for x in files[k][0]])
            bounds = np.cumsum([0, *(len(files[k][0]) for k in members)])
            for k, a, b in zip(members, bounds, bounds[1:], strict=False):
                out[k] = samples[a:b]
        except (ValueError, IndexError, KeyError, struct.error) as e:
            if len(members) == 1:
                out[members[0]] = e
            else:  # one of them is broken
                for k in members:
                    out[k] = _decoded([files[k]])[0]
    return out


def _inspect(media: list[bytes | None]) -> list[pa.Array]:
    rows: list[list] = [[None] * len(media) for _ in range(9)]
    good, files = [], []
    for k, m in enumerate(media):
        if m is None:
            continue
        rows[4][k], rows[5][k] = len(m), hashlib.sha256(m).hexdigest()
        try:
            files.append(read_avi(m))
            good.append(k)
        except (ValueError, IndexError, struct.error) as e:
            rows[8][k] = str(e) or type(e).__name__
    for k, (_, rate, note), samples in zip(good, files, _decoded(files), strict=True):
        if isinstance(samples, Exception):
            rows[8][k] = str(samples) or type(samples).__name__
            continue
        n = len(samples)
        flat = samples.reshape(n, -1)
        counts = np.bincount((np.repeat(np.arange(n) * BINS, flat.shape[1]) + (flat.ravel() >> 4)), minlength=n * BINS)
        begins, distance = find_shots(counts.reshape(n, BINS) / flat.shape[1], np.array([0, n]))
        own = len(note) == _OWN_NOTE.size
        n_bytes, n_payload = _OWN_NOTE.unpack(note) if own else (samples.size, samples.size)
        if n_payload > samples.size or n_bytes > n_payload:
            own, n_bytes, n_payload = False, samples.size, samples.size
        payload = samples.tobytes()[:n_payload]
        second = 1 / rate if rate else 0.0
        cuts = [*begins.tolist(), n]
        clips = [{"first_frame": a, "frames": b - a, "start_s": a * second, "end_s": b * second, "change": float(distance[a])} for a, b in zip(cuts, cuts[1:], strict=False)]
        bounds = hashlib.sha256(",".join(f"{c['start_s']:.4f}-{c['end_s']:.4f}" for c in clips).encode()).hexdigest()
        for column, value in enumerate((n_bytes, n_payload, hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), rows[4][k], rows[5][k], f"{n} frames {len(clips)} shots {bounds}", clips)):
            rows[column][k] = value
    clip = pa.list_(pa.struct([("first_frame", pa.int32()), ("frames", pa.int32()), ("start_s", pa.float64()), ("end_s", pa.float64()), ("change", pa.float64())]))
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), clip, pa.string()]
    return [pa.array(c, kind) for c, kind in zip(rows, kinds, strict=True)]


def clip_rows(read: DataFrame) -> DataFrame:
    """One row for each clip: doc_id, clip number and its times."""
    return read.select("doc_id", F.posexplode("clips").alias("clip", "c")).select("doc_id", "clip", "c.*")
