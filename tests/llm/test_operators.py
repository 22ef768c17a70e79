"""Each operator on odd cases (null, empty, long, tied and repeated rows, clashing columns, no rows) against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from streamalign.llm import bpe, chat, common, langid, media, mixing, ngram_lm, quality, queries, sharding, simhash, suffix_dedup

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def utf8(text):
    return (text or "").encode()


def lower(data):
    return bytes(c + 32 if 65 <= c <= 90 else c for c in data)


def collected(df):
    return df.collect()


# media


def test_media_round_trip(docs, empty):
    read = media.read_media(media.store_media(docs.withColumn("media", F.lit(1)).select("doc_id", "text", "media")))
    expected = Counter()
    for r in docs.collect():
        data = utf8(r.text)
        p = media.payload_of(data)
        assert len(p) % 64 == 0 and p and p.startswith(data)
        expected[(r.doc_id, len(data), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]))] += 1
    got = read.collect()
    assert Counter((r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in got) == expected
    assert all(r.clips[0].first_frame == 0 and sum(c.frames for c in r.clips) == -(-r.payload_bytes // 1024) for r in got)
    assert media.clip_rows(read).count() == sum(len(r.clips) for r in got)
    assert media.read_media(media.store_media(empty)).count() == 0


def test_media_finds_a_cut_and_follows_the_index():
    dark, bright = np.full((20, 16, 64), 30, np.uint8), np.full((20, 16, 64), 220, np.uint8)
    rng = np.random.default_rng(1)
    frames = np.concatenate([dark, bright]) + rng.integers(0, 3, (40, 16, 64)).astype(np.uint8)
    scan, ends = media.encode_lines(frames.reshape(-1, 64), 16)
    head, bounds = media.frame_header(64, 16), [0, *ends.tolist()]
    parts = [head + scan[a:b] for a, b in zip(bounds, bounds[1:])]
    avi = media.write_avi(parts, 64, 16, 25, b"note")
    back, rate, note = media.read_avi(avi)
    assert rate == 25 and note == b"note" and (media.decode_frames(back) == frames).all()
    h = np.stack([np.bincount(f.ravel() >> 4, minlength=16) / f.size for f in frames])
    assert media.find_shots(h, np.array([0, 40]))[0].tolist() == [0, 20]
    with pytest.raises(ValueError):
        media.read_avi(b"RIFFxxxxWAVE")


def baseline_jpeg(parts, width, height, restart=0):
    """A baseline encoder with 8-bit codes for all symbols: parts are (plane, h, v), all quantised by 1."""
    ac = [(r << 4) | n for r in range(16) for n in range(1, 11)] + [0x00, 0xF0]
    dc = list(range(12))
    code = lambda symbols, x: format(symbols.index(x), "08b")
    extra = lambda v: format(v if v > 0 else v + (1 << abs(v).bit_length()) - 1, f"0{abs(v).bit_length()}b") if v else ""
    table = lambda ident, symbols: media._segment(0xC4, bytes([ident] + [0] * 7 + [len(symbols)] + [0] * 8 + symbols))
    across, down = max(p[1] for p in parts), max(p[2] for p in parts)
    n_x, n_y = -(-width // (8 * across)), -(-height // (8 * down))
    out, bits, last = [], "", [0] * len(parts)

    def close(text):
        text += "1" * (-len(text) % 8)
        return int(text, 2).to_bytes(len(text) // 8, "big").replace(b"\xff", b"\xff\x00") if text else b""

    for unit in range(n_x * n_y):
        if restart and unit and unit % restart == 0:
            out += [close(bits), bytes([0xFF, 0xD0 + (unit // restart - 1) % 8])]
            bits, last = "", [0] * len(parts)
        for k, (plane, h, v) in enumerate(parts):
            for b in range(h * v):
                y, x = (unit // n_x * v + b // h) * 8, (unit % n_x * h + b % h) * 8
                block = np.zeros((8, 8))
                cut = plane[y : y + 8, x : x + 8]
                block[: cut.shape[0], : cut.shape[1]] = cut - 128.0
                z = np.rint(media._COS @ block @ media._COS.T).astype(int).ravel()[media._ZIGZAG].tolist()
                d, last[k] = z[0] - last[k], z[0]
                bits += code(dc, abs(d).bit_length()) + extra(d)
                run = 0
                for c in z[1:]:
                    if not c:
                        run += 1
                        continue
                    while run > 15:
                        bits, run = bits + code(ac, 0xF0), run - 16
                    bits += code(ac, run << 4 | abs(c).bit_length()) + extra(c)
                    run = 0
                if run:
                    bits += code(ac, 0)
    out.append(close(bits))
    frame = bytes([8]) + height.to_bytes(2, "big") + width.to_bytes(2, "big") + bytes([len(parts)]) + b"".join(bytes([k + 1, h << 4 | v, 0]) for k, (_, h, v) in enumerate(parts))
    head = [b"\xff\xd8", media._segment(0xDB, bytes([0]) + b"\1" * 64), media._segment(0xC0, frame), table(0x00, dc), table(0x10, ac)]
    if restart:
        head.append(media._segment(0xDD, restart.to_bytes(2, "big")))
    scan = bytes([len(parts)]) + b"".join(bytes([k + 1, 0]) for k in range(len(parts))) + bytes([0, 63, 0])
    return b"".join([*head, media._segment(0xDA, scan), *out, b"\xff\xd9"])


@pytest.mark.parametrize("restart", [0, 2])
@pytest.mark.parametrize("sampling", [(1, 1), (2, 2), (2, 1)])
def test_baseline_frames_decode(restart, sampling):
    rng = np.random.default_rng(4)
    h, v = sampling
    y = np.clip(np.add.outer(np.arange(29) * 4, np.arange(37) * 3) + rng.integers(0, 20, (29, 37)), 0, 255)
    grey = [(y, h, v)] + [(np.full((29, 37), 100), 1, 1)] * (2 if h > 1 else 0)
    frame = baseline_jpeg(grey, 37, 29, restart)
    assert np.abs(media.decode_frames([frame, frame])[1].astype(int) - y).max() <= 2
    avi = media.write_avi([frame] * 3, 37, 29, 10, b"")
    back, rate, _ = media.read_avi(avi)
    assert len(back) == 3 and rate == 10 and media.decode_frames(back).shape == (3, 29, 37)


def test_read_media_of_other_files(spark):
    rng = np.random.default_rng(6)
    y = np.clip(np.add.outer(np.arange(24) * 4, np.arange(32) * 3) + rng.integers(0, 20, (24, 32)), 0, 255)
    camera = media.write_avi([baseline_jpeg([(y, 1, 1)], 32, 24)] * 3, 32, 24, 10, b"")
    small = media.write_avi([baseline_jpeg([(y[:8, :8], 1, 1)], 8, 8)], 8, 8, 10, b"camera 7")
    own = media.encode_payloads([b"some text of ours" * 200])[0]
    data = bytearray(camera)  # an index that counts from the file's start
    movi, idx = data.index(b"movi"), data.index(b"idx1") + 8
    for k in range(idx, len(data) - 15, 16):
        data[k + 8 : k + 12] = (int.from_bytes(data[k + 8 : k + 12], "little") + movi).to_bytes(4, "little")
    files = [camera, None, own, b"", b"RIFFxxxx", small, bytes(data), own[: len(own) // 2], own]
    rows = [(k, m) for k, m in enumerate(files)]
    got = {r.doc_id: r for r in media.read_media(spark.createDataFrame(rows, "doc_id long, media binary").coalesce(1)).collect()}
    assert [got[k].error is None for k in range(9)] == [True, True, True, False, False, True, True, False, True]
    assert got[1].media_bytes is None and got[1].clips is None and got[4].media_bytes == 8 and got[4].payload_sha256 is None
    assert got[0].n_bytes == 3 * 24 * 32 and got[0].clips[0].frames == 3 and got[5].payload_bytes == 64
    assert got[6].payload_sha256 == got[0].payload_sha256
    assert got[2].payload_sha256 == hashlib.sha256(media.payload_of(b"some text of ours" * 200)).hexdigest() == got[8].payload_sha256
    alone = media.read_media(spark.createDataFrame(rows[2:3], "doc_id long, media binary")).first()
    assert alone == got[2]


def test_all_lists_and_streams_of_a_file_are_read(spark):
    """Further RIFF lists of large files, frames named db or of another stream number; what can't be read is an error."""
    rng = np.random.default_rng(8)
    parts = [baseline_jpeg([(rng.integers(0, 255, (8, 8)), 1, 1)], 8, 8) for _ in range(5)]
    plain = media.write_avi(parts[:2], 8, 8, 10, b"")
    chunk = lambda name, body: name + len(body).to_bytes(4, "little") + body + b"\0" * (len(body) % 2)
    more = chunk(b"RIFF", b"AVIX" + chunk(b"LIST", b"movi" + chunk(b"00dc", parts[2]) + chunk(b"LIST", b"rec " + chunk(b"00dc", parts[3]) + chunk(b"01wb", b"sound")) + chunk(b"00dc", parts[4])))
    assert media.read_avi(plain + more)[0] == parts
    assert media.read_avi(plain.replace(b"00dc", b"00db"))[0] == parts[:2]
    sound = chunk(b"LIST", b"strl" + chunk(b"strh", b"auds" + b"\0" * 52))
    at = plain.index(b"LIST", plain.index(b"hdrl"))
    grown = lambda file, offset, n: file[:offset] + (int.from_bytes(file[offset : offset + 4], "little") + n).to_bytes(4, "little") + file[offset + 4 :]
    add = lambda file, extra: grown(grown(file[:at] + extra + file[at:], 4, len(extra)), 16, len(extra))
    assert media.read_avi(add(plain, sound).replace(b"00dc", b"01dc"))[0] == parts[:2]
    stream = plain[at : at + 8 + int.from_bytes(plain[at + 4 : at + 8], "little")]
    for broken in (add(plain, stream), (plain + more)[:-20], plain[:-5]):
        with pytest.raises(ValueError):
            media.read_avi(broken)
    rows = [(1, plain + more), (2, add(plain, stream)), (3, (plain + more)[:-20])]
    got = {r.doc_id: r for r in media.read_media(spark.createDataFrame(rows, "doc_id long, media binary")).collect()}
    assert got[1].error is None and got[1].n_bytes == 5 * 64 and sum(c.frames for c in got[1].clips) == 5
    assert "2 video streams" in got[2].error and got[3].error


def test_headers_that_a_worker_keeps_are_bounded(monkeypatch):
    monkeypatch.setattr(media, "MOST_HEADERS", 3)
    media._headers.clear()
    for height in range(1, 9):
        head = media.frame_header(64, height)
        assert media._parse_header(head)[:2] == (64, height)
        assert len(media._headers) <= 3


# near duplicates


def brute_fingerprint(data):
    w = WORD.findall(lower(data))
    shingles = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def brute_components(prints):
    keys = sorted(set(prints))
    root = {k: k for k in keys}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if (a ^ b).bit_count() <= 2:
                root[find(max(a, b))] = find(min(a, b))
    return {k: find(k) for k in keys}


@pytest.mark.parametrize("unit", [4096, 4])
def test_near_duplicates(docs, empty, monkeypatch, unit):
    monkeypatch.setattr(simhash, "UNIT_ROWS", unit)
    rows = docs.collect()
    prints = [brute_fingerprint(utf8(r.text)) for r in rows]
    roots = brute_components(prints)
    smallest = {}
    for r, p in zip(rows, prints):
        if r.doc_id is not None:
            smallest[roots[p]] = min(smallest.get(roots[p], r.doc_id), r.doc_id)
    expected = Counter((r.doc_id, p, smallest.get(roots[p])) for r, p in zip(rows, prints))
    got = simhash.near_duplicates(docs).collect()
    assert Counter((r.doc_id, r.fingerprint & (2**64 - 1), r.component_id) for r in got) == expected
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(roots.values()))
    assert simhash.near_duplicates(empty).count() == 0 and simhash.deduplicate(empty).count() == 0


def test_trie_finds_all_pairs_in_a_ball(spark, monkeypatch):
    monkeypatch.setattr(simhash, "UNIT_ROWS", 16)
    rng = np.random.default_rng(3)
    base = int(rng.integers(0, 2**63))
    keys = {base, base ^ 1, base ^ (1 << 63), 0, 1, 2**64 - 1}
    for _ in range(400):
        k = base
        for b in rng.choice(64, int(rng.integers(1, 7)), replace=False):
            k ^= 1 << int(b)
        keys.add(k)
    keys = sorted(keys)
    expected = brute_components(keys)
    df = spark.createDataFrame([(k - 2**64 if k >> 63 else k,) for k in keys], "fingerprint long")
    found = {r.node & (2**64 - 1): r.root & (2**64 - 1) for r in simhash.components(simhash.links(df)).collect()}
    groups = lambda m: Counter(frozenset(k for k in keys if m.get(k, k) == v) for v in {m.get(k, k) for k in keys})
    assert groups(found) == groups(expected)


# mixing


def test_mixing(docs, empty):
    got = mixing.mix_sources(docs).collect()
    again = Counter((r.doc_id, r.text, r.taken) for r in mixing.mix_sources(docs.repartition(5)).collect())
    assert Counter((r.doc_id, r.text, r.taken) for r in got) == again
    sizes = Counter()
    for r in got:
        n = len(WORD.findall(utf8(r.text)))
        assert r["size"] == n and r.taken == n * r.copies and 0 <= r.copies <= 2 and r.kept == 7
        sizes[r.source] += n
    targets = {r.source: r.target for r in got}
    assert all(r.source_size == sizes[r.source] for r in got)
    assert sum(targets.values()) == pytest.approx(1.5 * sum(sizes.values()))
    assert all(t <= 2 * sizes[s] + 1e-9 for s, t in targets.items())
    taken = Counter()
    for r in got:
        taken[r.source] += r.taken
    for s, t in targets.items():
        assert taken[s] <= t + 1e-9
    mixed = mixing.repeat_mixed(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in got)
    assert mixing.mix_sources(empty).count() == 0


@pytest.mark.parametrize("bucket, share, most", [(4096, 0.7, 2.0), (20, 1.3, 2.0), (4096, 1.6, 2.0)])
def test_mixing_includes_by_expected_copies(spark, monkeypatch, bucket, share, most):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", bucket)
    n, sizes = 16_000, (1, 3, 10, 40)
    rows = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("a").alias("source"), F.lit("x").alias("__mix_rank"), F.element_at(F.array(*[F.lit(k) for k in sizes]), (F.col("id") % 4 + 1).cast("int")).cast("long").alias("size"))
    got = mixing.mix_sizes(rows, (1,), share, most)
    assert got.columns == ["doc_id", "source", "__mix_rank", "size", "source_size", "target", "copies", "taken"]
    counts = {r["size"]: (r.mean, r.low, r.high) for r in got.groupBy("size").agg(F.avg("copies").alias("mean"), F.min("copies").alias("low"), F.max("copies").alias("high")).collect()}
    words = {k: n // 4 * k for k in sizes}
    target, full = share * sum(words.values()), set()
    while True:  # expected copies in proportion to binary digits, full ones at most
        level = (target - most * sum(words[k] for k in full)) / sum(words[k] * k.bit_length() for k in sizes if k not in full)
        over = {k for k in sizes if k not in full and level * k.bit_length() > most}
        if not over:
            break
        full |= over
    for k in sizes:
        expected = most if k in full else level * k.bit_length()
        mean, low, high = counts[k]
        assert mean == pytest.approx(expected, abs=0.02) and low >= math.floor(expected) and high <= math.ceil(expected)
    taken = got.agg(F.sum("taken")).first()[0]
    assert target - 1 <= taken <= target + 1e-6


def test_mixing_fills_the_gap_after_long_documents(spark):
    sizes = [20_000, 15_000, 12_000, 9_000] * 3 + [*range(1, 200)]
    rows = spark.createDataFrame(list(enumerate(sizes)), "doc_id long, size long").withColumn("source", F.lit(None).cast("string"))
    r = mixing.mix_sizes(rows, (1,), 1.5).agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).first()
    assert r.target - 200 <= r.taken <= r.target


def test_targets_by_reshare(spark):
    sizes = {"a": 10, "b": 1000, "c": 100, None: 50, "d": 0}
    df = spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(df, (5, 2, 1), 1.5, 2.0).collect()}
    order = [*sorted(k for k in sizes if k is not None), None]
    weight = {k: (5, 2, 1)[i % 3] for i, k in enumerate(order)}
    total, target, free = 1.5 * sum(sizes.values()), {}, set(order)
    while free:
        level = (total - sum(target.values())) / sum(weight[k] for k in free)
        over = {k for k in free if level * weight[k] > 2 * sizes[k]}
        if not over:
            target |= {k: level * weight[k] for k in free}
            break
        target |= {k: 2.0 * sizes[k] for k in over}
        free -= over
    assert got == pytest.approx(target)


# repeats


def brute_repeats(rows, length):
    first = {}
    key = lambda d: (d is None, d or 0)
    for d, data in rows:
        for i in range(len(data) - length + 1):
            s = data[i : i + length]
            if s not in first or key(d) < key(first[s]):
                first[s] = d
    out = []
    for d, data in rows:
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            if key(first[data[i : i + length]]) < key(d):
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(data, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((d, len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("chunk", [8 << 20, 20_000])
def test_repeats(docs, empty, monkeypatch, chunk):
    monkeypatch.setattr(suffix_dedup, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", chunk)
    rows = [(r.doc_id, utf8(r.text)) for r in docs.collect()]
    got = suffix_dedup.repeat_report(docs).collect()
    assert Counter(tuple(r) for r in got) == brute_repeats(rows, 50)
    cut = suffix_dedup.remove_repeats(docs)
    assert cut.columns == docs.columns and cut.filter("doc_id = 0").first().text == docs.filter("doc_id = 0").first().text
    assert cut.filter("doc_id = 4").first().text is None
    assert suffix_dedup.repeat_report(empty).count() == 0


def test_repeats_around_frequent_anchors(spark, docs):
    rng = np.random.default_rng(8)
    letters = lambda n: "".join(map(chr, rng.integers(97, 123, n)))
    common, tails = letters(30), [letters(40) for _ in range(9)]
    texts = [letters(25) + common + tails[k % 9] + letters(20) for k in range(400)]  # one anchor in 400 places
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(1000 + k, x) for k, x in enumerate(texts)]
    many = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = brute_repeats([(d, utf8(x)) for d, x in rows], 50)
    for hot_from in (1, 64, 1 << 40):  # all shared anchors are split, those of the planted texts, none
        got = suffix_dedup.repeat_report(many, hot_from=hot_from).collect()
        assert Counter(tuple(r) for r in got) == want


def test_windows_of_frequent_anchors_are_split_whole():
    rng = np.random.default_rng(9)
    t = common.Texts([bytes(rng.integers(97, 99, n).astype(np.uint8)) for n in (49, 50, 51, 300, 4000)])
    first, count, anchor, key, text = suffix_dedup._anchors(t, 50)
    split = suffix_dedup._split(t, first, count, anchor, text, 50)
    windows = lambda f, c, a, x: sorted((w, at, k) for lo, n, at, k in zip(f, c, a, x) for w in range(lo, lo + n))
    assert windows(first, count, anchor, text) == windows(*split[:3], split[4])
    keys = {}
    for lo, n, at, k in zip(*split[:4]):
        for w in range(lo, lo + n):  # equal windows have their anchor in one place and one key
            assert keys.setdefault(t.buf[w : w + 50].tobytes(), (at - w, k)) == (at - w, k)


def test_repeats_with_text_ids(spark, docs):
    rows = [(None if r.doc_id is None else f"id {r.doc_id:03}", r.text) for r in docs.collect()]
    got = suffix_dedup.repeat_report(spark.createDataFrame(rows, "doc_id string, text string").repartition(3)).collect()
    rank = {d: i for i, d in enumerate(sorted({d for d, _ in rows if d is not None}))}
    want = brute_repeats([(None if d is None else rank[d], utf8(x)) for d, x in rows], 50)
    assert Counter((None if r[0] is None else rank[r[0]], *r[1:]) for r in got) == want


def test_column_sort_is_a_suffix_order():
    rng = np.random.default_rng(2)
    x = rng.integers(97, 99, (200, 6)).astype(np.uint8)
    k = rng.integers(0, 3, 200).astype(np.uint64)
    order, common = suffix_dedup._sort_columns(x, k, np.zeros(200, np.uint64))
    rows = [(int(k[i]), bytes(x[i])) for i in order]
    assert rows == sorted(rows)
    for (ka, a), (kb, b), c in zip(rows, rows[1:], common):
        assert c == (-1 if ka != kb else next((i for i in range(6) if a[i] != b[i]), 6))


# shards


def test_shards(docs, empty):
    got = sharding.shard_documents(docs, 16).collect()
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter((r.doc_id, len(utf8(r.text)) + 1, zlib.crc32(utf8(r.text))) for r in docs.collect())
    counts = Counter(r.shard for r in got)
    assert max(counts.values()) - min(counts[s] for s in range(16)) <= 1
    for s in range(16):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(counts[s]))
    assert sharding.shard_documents(empty, 16).count() == 0


def test_hypergeometric_draw_has_its_law(spark):
    n = 40_000
    u = "((xxhash64(9L, id) & 9007199254740991L) + 0.5D) / 9007199254740992D"
    df = spark.range(n).select(F.expr(sharding._hypergeometric("30L", "100L", "20L", u)).alias("k")).groupBy("k").count()
    got = {r.k: r["count"] / n for r in df.collect()}
    for k in range(21):
        p = math.comb(30, k) * math.comb(70, 20 - k) / math.comb(100, 20)
        assert got.get(k, 0) == pytest.approx(p, abs=0.012)


def test_matrix_has_its_margins(spark, monkeypatch):
    monkeypatch.setattr(sharding, "PART_ROWS", 20)
    df = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit(1).alias("row_key"), F.lit("x").alias("__upper"))
    got = sharding.shuffle_into_shards(df, 7).collect()
    counts = Counter(r.shard for r in got)
    assert sorted(counts.values()) == [142, 143, 143, 143, 143, 143, 143] and len({(r.shard, r.slot) for r in got}) == 1000


def test_arrangement_is_uniform(spark, monkeypatch):
    monkeypatch.setattr(sharding, "PART_ROWS", 40)
    monkeypatch.setattr(sharding, "FAN", 4)
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit(1).alias("row_key"), F.lit("x").alias("__part"))
    places = []
    for seed in (1, 2):
        got = sharding.shuffle_into_shards(df, 8, seed)
        assert got.columns == ["doc_id", "row_key", "__part", "shard", "slot"]
        rows = sorted((r.doc_id, r.shard, r.slot) for r in got.collect())
        assert sorted({(s, k) for _, s, k in rows}) == [(s, k) for s in range(8) for k in range(500)]
        shard, slot = np.array([s for _, s, _ in rows]), np.array([k for _, _, k in rows])
        for group in (np.arange(4000) % 4, np.arange(4000) // 1000, slot // 125):  # 4 x 8 cells of 125 each
            cells = np.bincount(group * 8 + shard, minlength=32)
            assert ((cells - 125) ** 2 / 125).sum() < 60  # chi-square of 21 degrees: 60 has odds of 1e-5
        assert abs(np.corrcoef(np.arange(4000), slot)[0, 1]) < 0.08
        places.append(shard)
    assert 350 < (places[0] == places[1]).sum() < 650


# quality


def brute_counts(text):
    s = utf8(text).decode()
    pattern = re.compile(r"[^\x20\x09-\x0D]+")
    w = pattern.findall(s)
    seen = {}
    for i in range(len(w) - 7):
        seen.setdefault(tuple(w[i : i + 8]), []).append(i)
    covered = {j for at in seen.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    lines = [x for x in s.split("\n") if pattern.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in s), len(lines) - len(set(lines)), len(covered)


def test_quality(docs, empty, spark):
    labels = docs.filter("doc_id is not null").select("doc_id", F.when(F.col("doc_id") % 3 == 0, 0).otherwise(1).alias("quality")).unionByName(spark.createDataFrame([(None, 1), (5, None)], "doc_id long, quality int"))
    model = quality.train_quality(docs, labels)
    got = quality.score_quality(docs, model).collect()
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == Counter((r.doc_id, *brute_counts(r.text)) for r in docs.collect())
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) and not (r.kept and r.base_failed)
        assert r.kept == (not r.base_failed and r.quality_p >= 0.5)
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in got)
    nothing = quality.train_quality(empty, labels)
    assert nothing.weights is None and quality.score_quality(empty, nothing).count() == 0


def brute_features(text):
    """Hashes' slots by single words, pairs and character strings of one text."""
    w = WORD.findall(utf8(text))
    one = lambda x: quality.span_hash(np.frombuffer(x + bytes(8), np.uint8), np.array([0]), np.array([len(x)]))
    slots = [int(one(x)[0] & quality._HALF) + quality.SLOTS // 2 for x in w]
    slots += [int(quality.pair_hash(one(a), one(b))[0] & quality._HALF) + quality.SLOTS // 2 for a, b in zip(w, w[1:])]
    s, chars = text or "", []
    for i in range(len(s) - quality.CHAR_N + 1):
        h = 0
        for c in s[i : i + quality.CHAR_N]:
            h = (h * 0x9E3779B97F4A7C15 + ord(c)) % 2**64
        chars.append((h * 0x9E3779B97F4A7C15 % 2**64) >> 50)
    return slots, chars


def test_quality_score_is_of_the_text_alone(docs):
    texts = [r.text for r in docs.collect() if len(r.text or "") < 3000] + ["é", "日本語の文", "abc"]
    values = [utf8(t) for t in texts]
    weights = np.rint(np.random.default_rng(8).normal(size=quality.SLOTS) * quality.SCALE).astype(np.int64)
    model = quality.QualityModel(weights, 0.3, 2.0, -0.1)
    alone = [model.probability([x])[0] for x in values]
    order = np.random.default_rng(9).permutation(len(values))
    for batch in (np.arange(len(values)), order, order[:7]):
        assert model.probability([values[k] for k in batch]).tolist() == [alone[k] for k in batch]
    for text, p in zip(texts, alone):
        word, char = brute_features(text)
        mean = lambda x: sum(int(weights[k]) for k in x) / quality.SCALE / max(1, len(x))
        assert p == pytest.approx(1 / (1 + math.exp(-2.0 * (0.3 + mean(word) + mean(char)) + 0.1)), abs=1e-12)


def test_quality_learns_from_long_texts_and_says_when_it_cannot(spark):
    rows = [(f"id{k}", ("good words of a long text " if k % 2 else "*** $$$ ### ") * 30_000, k % 2) for k in range(12)]
    df = spark.createDataFrame(rows, "doc_id string, text string, quality int")
    model = quality.train_quality(df, df.select("doc_id", "quality"))
    assert model.weights is not None
    assert [r.quality_p >= 0.5 for r in quality.score_quality(df, model).orderBy("doc_id").collect()] == [r[2] == 1 for r in sorted(rows)]
    with pytest.warns(UserWarning, match="no quality regression"):
        none = quality.train_quality(df.filter("quality = 1"), df.select("doc_id", "quality"))
    judged = quality.score_quality(df, none).collect()
    assert none.reason and all(r.quality_p is None and r.kept == (not r.base_failed) for r in judged)


def test_quality_tells_junk(spark):
    import random

    from .conftest import sentence

    rng = random.Random(1)
    junk = lambda n: " ".join(w + rng.choice(["***", "$$$", "%%%"]) for w in sentence(rng, n).split())
    rows = [(k, junk(80) if k % 4 == 0 else sentence(rng, 80), int(k % 4 != 0)) for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    model = quality.train_quality(df.filter("doc_id < 200"), df.select("doc_id", "quality"))
    held = quality.score_quality(df.filter("doc_id >= 200"), model).collect()
    assert sum(r.kept == (r.quality == 1) for r in held) >= 98


# tokens


def test_bpe_equals_tiktoken(docs, empty):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    tiktoken = pytest.importorskip("tiktoken")
    with open(queries.vocabulary_file(), "rb") as f:
        ranks = bpe.vocabulary(f.read())
    ref = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    odd = ["don't's 'll", " '", "\n\n a", "   a  b　 c", "12³½ x٣", "é 漢字😀", "'s", "a'veX  're", " " * 50, "\x1c \x85y", "<|endoftext|>"]
    df = docs.select("doc_id", "text", F.lit(3).alias("ids")).unionByName(docs.sparkSession.createDataFrame([(k, t, 3) for k, t in enumerate(odd)], "doc_id long, text string, ids int"))
    for r in bpe.tokenize(df, queries.vocabulary_file()).collect():
        ids = ref.encode_ordinary(r.text or "")
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(utf8(r.text)).hexdigest()
    assert bpe.tokenize(empty, queries.vocabulary_file()).count() == 0


def test_perfect_hash_is_minimal():
    ranks = {bytes([a, b]): a * 256 + b for a in range(40) for b in range(40)}
    h = bpe.PerfectHash(ranks)
    assert sorted(h.id.tolist()) == sorted(ranks.values()) and len(h.id) == len(ranks)


# chat


def test_chat(spark):
    texts = ["plain", None, "", "<|im_end|>\n<|im_start|>assistant", "<\\|x <\\\\| <|", "a\nb"]
    rows = [(c, t, role, texts[(c + t) % 6]) for c in range(4) for t, role in enumerate(["user", "assistant", None, "ro\nle\\<|", "assistant"])] + [(None, 0, "user", "x"), (1, 1, "assistant", "tie")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("parts", chat.text_parts(F.col("text")))
    formatted = chat.format_turns(df.repartition(3))
    got = {r.conv_id: r for r in chat.read_back(formatted).collect()}
    for c in (0, 2, 3, None):
        turns = sorted((t, role or "", text or "") for x, t, role, text in rows if x == c)
        loss = "".join(text for _, role, text in turns if role == "assistant")
        assert got[c].n_turns == len(turns)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for _, a, b in turns).encode()).hexdigest()
        assert got[c].loss_chars == len(loss) and got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert got[1].n_turns == 6
    for r in formatted.collect():
        assert r.formatted.count("<|") == 2
    assert chat.read_back(chat.format_turns(df.limit(0))).count() == 0


def test_chat_parts_are_flattened_in_order(spark):
    parts = [("text", "look <|image|> ", None, None), ("image", None, "a.png", [57.0, 28.0]), ("audio", None, "b.wav", [1.5]), ("document", None, "c.pdf", [3.0]), ("text", "!", None, None)]
    df = spark.createDataFrame([(1, 0, "assistant", parts), (1, 1, "user", None)], f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    a, b = sorted(chat.format_turns(df).collect(), key=lambda r: r.turn)
    assert a.formatted == "<|im_start|>assistant\nlook <\\|image|> <|image|><|audio|><|document|>!<|im_end|>\n"
    assert [(x.kind, x.ref, x.position, x.tokens) for x in a.attachments] == [("image", "a.png", 0, 3), ("audio", "b.wav", 1, 38), ("document", "c.pdf", 2, 768)]
    assert a.attachment_tokens == 809 and b.formatted == "<|im_start|>user\n<|im_end|>\n" and b.loss_from == b.loss_upto


# language model


@pytest.mark.parametrize("sizes", [(5 << 20, 4 << 20, 1 << 17), (20_000, 5_000, 50)])
def test_language_model(docs, empty, monkeypatch, sizes):
    for name, x in zip(("CHUNK_BYTES", "BUCKET_BYTES", "FAN_TOKENS"), sizes):
        monkeypatch.setattr(ngram_lm, name, x)
    check_language_model(docs)
    assert ngram_lm.score_documents(empty, "doc_id % 7 <> 2").count() == 0


def test_language_model_of_a_frequent_pair(spark, monkeypatch):
    for name, x in zip(("CHUNK_BYTES", "BUCKET_BYTES", "FAN_TOKENS"), (3_000, 2_000, 60)):
        monkeypatch.setattr(ngram_lm, name, x)
    rng = random.Random(3)
    texts = [" ".join(f"New york w{rng.randrange(300)}" for _ in range(rng.randrange(1, 80))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate([*texts, *texts[:5], "york", "new", ""])), "doc_id long, text string").repartition(5)
    check_language_model(df)


def check_language_model(df):
    rule = "doc_id % 7 <> 2"
    rows = [(r.doc_id, [*WORD.findall(lower(utf8(r.text))), None], r.doc_id is not None and r.doc_id % 7 != 2) for r in df.collect()]
    c = Counter(w for _, ws, t in rows if t for w in ws)
    pairs = Counter(p for _, ws, t in rows if t for p in zip([None, *ws], ws))
    triples = Counter(p for _, ws, t in rows if t for p in zip([None, *ws], ws, ws[1:]))
    n, v = sum(c.values()), len(c)
    got = ngram_lm.score_documents(df, rule).collect()
    key = lambda d, t, k: (-1 if d is None else d, t, k)
    expected = []
    one, two = ngram_lm.PRIORS
    for d, ws, t in rows:
        base = [(c[w] + 1) / (n + v + 1) for w in ws]
        full = [(pairs[a, w] + one * p) / (c[a] + one) for a, w, p in zip([None, *ws], ws, base)]
        full[1:] = [(triples[a, b, w] + two * p) / (pairs[a, b] + two) for a, b, w, p in zip([None, *ws], ws, ws[1:], full[1:])]
        expected.append((key(d, t, len(ws)), sum(c[w] > 0 for w in ws), sum(map(math.log10, base)), sum(map(math.log10, full))))
    found = [(key(r.doc_id, r.trained, r.n_tokens), r.n_known, r.base_score, r.score) for r in got]
    for a, b in zip(sorted(expected), sorted(found), strict=True):
        assert a[:2] == b[:2] and b[2] == pytest.approx(a[2], rel=1e-9) and b[3] == pytest.approx(a[3], rel=1e-9, abs=a[0][2] / ngram_lm.STEPS)  # half a step each for a share and a weight
    assert all(r.train_tokens == n for r in got)


@pytest.mark.parametrize("top", [1, 50, 2**45, 2**64 - 1])
def test_elias_fano(top):
    for n in (0, 1, 7, 500, 40_000):
        rng = np.random.default_rng(n)
        x = np.sort(rng.integers(0, top, n, np.uint64, endpoint=True))
        packed = ngram_lm.EliasFano(np.frombuffer(ngram_lm.EliasFano.encode(x), np.uint8))
        assert (packed.access(np.arange(n)) == x).all()
        asked = np.concatenate([x, rng.integers(0, top, 500, np.uint64, endpoint=True), np.array([0, top], np.uint64)])
        begin, end = np.sort(rng.integers(0, n + 1, (2, len(asked))), axis=0)
        want = [next((i for i in (np.searchsorted(x[b:e], v) + b,) if i < e and x[i] == v), -1) for b, e, v in zip(begin, end, asked)]
        assert packed.find(begin, end, asked).tolist() == want


def test_trie_is_queried_as_it_is_packed(monkeypatch):
    rng = np.random.default_rng(1)
    context = np.unique(rng.integers(0, 2**64, 20_000, np.uint64))
    successors = lambda n, m: np.divmod(np.unique(rng.integers(0, n << 40, m)), 1 << 40)
    owner, pair = successors(len(context), 60_000)
    owner3, triple = successors(len(pair), 90_000)
    count, pairs, triples = (rng.integers(0, 9, len(x)) for x in (context, pair, triple))
    count[owner[pairs > 0]] += 1
    pairs[owner3[triples > 0]] += 1
    count[owner[pairs > 0]] += 1
    trie = ngram_lm.Trie.build(context, count, (owner, pair.astype(np.uint64), pairs), (owner3, triple.astype(np.uint64), triples))
    sequences = [trie.contexts, *trie.pointers.values(), *trie.levels.values()]
    assert sum(s.ones.nbytes + s.zeros.nbytes for s in sequences) < 12 * sum(s.n for s in sequences) / 8
    assert all(not x.flags.owndata for s in sequences for x in (s.bits, s.high)) and not trie.counts.flags.owndata
    rank = trie.find_contexts(context)
    assert ((rank >= 0) == (count > 0)).all() and (trie.counts[rank[rank >= 0]] == count[count > 0]).all()
    rank2 = trie.find_successors(2, rank, owner, pair.astype(np.uint64))
    assert ((rank2 >= 0) == (pairs > 0)).all()
    rank3 = trie.find_successors(3, rank2, owner3, triple.astype(np.uint64))
    assert ((rank3 >= 0) == (triples > 0)).all()
    share = ngram_lm.restore(trie.shares[3][rank3[triples > 0]])
    assert share == pytest.approx(triples[triples > 0] / (pairs[owner3[triples > 0]] + ngram_lm.PRIORS[1]), rel=3e-4)
    read = []
    whole = ngram_lm.EliasFano.low_bits
    monkeypatch.setattr(ngram_lm.EliasFano, "low_bits", lambda self, i: read.append(len(i)) or whole(self, i))
    at = int(np.flatnonzero(triples > 0)[0])
    trie.find_successors(3, trie.find_successors(2, trie.find_contexts(context[owner[owner3[at]]][None]), np.zeros(1, int), pair[owner3[at]][None].astype(np.uint64)), np.zeros(1, int), triple[at][None].astype(np.uint64))
    assert 0 < sum(read) < 60  # of 170,000 values


# language identification


def brute_bits(samples, text):
    """PPM code length by walking contexts symbol by symbol."""
    seen = set().union(*samples.values())
    out = {}
    for lang, sample in samples.items():
        tables = []
        for order in range(langid.ORDER + 1):
            t = {}
            for i in range(len(sample) - order):
                t.setdefault(sample[i : i + order], Counter())[sample[i + order]] += 1
            tables.append(t)
        total, data = 0.0, b" " * langid.ORDER + text
        for i in range(langid.ORDER, len(data)):
            for order in range(langid.ORDER, -1, -1):
                t = tables[order].get(data[i - order : i])
                if t is None:
                    continue
                s, d = sum(t.values()), len(t)
                if t[data[i]] and data[i] in seen:
                    total += math.log2((s + d) / t[data[i]])
                    break
                total += math.log2((s + d) / d)
            else:
                total += 8
        out[lang] = total
    return out


def test_ppm_code_lengths():
    samples = {"a": b"abracadabra abracadabra cab", "b": b"the cat sat on the mat. the end"}
    model = langid.PpmModel.train(samples)
    for text in (b"abra", b"the cab", b"zzz\xff", b""):
        expected = brute_bits(samples, text)
        got = model.bits([text])[0]
        for k, lang in enumerate(model.langs):
            assert got[k] == pytest.approx(expected[lang], abs=0.01 * (len(text) + 1))


def test_language(docs, empty):
    model = langid.train_language_model(docs)
    assert model.langs == ["de", "en", "fr"]
    got = langid.identify_languages(docs.withColumn("score", F.lit(1)), model).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    und = {r.doc_id for r in got if r.lang_pred == "und"}
    assert und == {4, 5, 6}
    nothing = langid.train_language_model(empty)
    assert {r.lang_pred for r in langid.identify_languages(docs, nothing).collect()} == {"und"}
    assert langid.identify_languages(empty, model).count() == 0


def test_languages_in_several_passes(spark, docs, monkeypatch):
    whole = {(r.doc_id, r.lang_pred, round(r.score, 9)) for r in langid.identify_languages(docs, langid.train_language_model(docs)).collect()}
    monkeypatch.setattr(langid, "MODEL_BYTES", 1 << 17)
    model = langid.train_language_model(docs)
    assert len({tuple(g) for g, _, _ in model.ranges}) == 3
    got = langid.identify_languages(docs, model).collect()
    assert len(got) == docs.count() and {(r.doc_id, r.lang_pred, round(r.score, 9)) for r in got} == whole


def test_contexts_of_a_language_in_several_passes(spark, monkeypatch):
    """A language whose contexts don't fit together loses none of them: its code lengths are added up over ranges."""
    rows = [(k, w, lang) for k, (w, lang) in enumerate([("the long words of a text", "en"), ("les mots longs d'un texte", "fr"), ("the \x00 other", "en"), ("", "fr"), (None, "en"), ("é longs", None)] * 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = lambda: {(r.doc_id, r.lang_pred, round(r.score, 9)) for r in langid.identify_languages(df, langid.train_language_model(df)).collect()}
    whole = got()
    monkeypatch.setattr(langid, "MODEL_BYTES", 4000)
    ranges = langid.train_language_model(df).ranges
    per = {x: [(lo, hi) for g, lo, hi in ranges if x in g] for x in ("en", "fr")}
    assert all(len(own) > 1 and own[0][0] == 0 and own[-1][1] == 1 << 24 and all(a[1] == b[0] for a, b in zip(own, own[1:])) for own in per.values())
    assert got() == whole and len(whole) == 12


def test_language_of_long_texts_only(spark):
    rows = [(k, w * 60_000, lang) for k, (w, lang) in enumerate([("the long words ", "en"), ("les mots longs ", "fr")] * 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train_language_model(df)
    assert model.langs == ["en", "fr"]
    assert all(r.lang_pred == rows[r.doc_id][2] for r in langid.identify_languages(df, model).collect())


# queries and their SQL


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    df = queries.QUERIES[name](spark, sf)
    cur = con.execute(queries.ORACLE_SQL[name])
    at = [[x[0] for x in cur.description].index(c) for c in df.columns]
    assert Counter(map(tuple, df.collect())) == Counter(tuple(r[k] for k in at) for r in cur.fetchall())


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    lang = queries.op10_language(spark, sf).filter("held_out").join(truth, "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in lang) >= 0.98 * len(lang)
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    judged = queries.op6_quality(spark, sf).join(labels, "doc_id").filter("not base_failed").collect()
    assert sum(r.kept == (r.quality == 1) for r in judged) >= 0.98 * len(judged)
    scored = queries.op9_ngram_lm(spark, sf).filter("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert scored.s > scored.b


def test_exchanged_ngrams_are_packed_tightly(monkeypatch):
    from streamalign.llm import ngram_lm

    rng, none = random.Random(3), np.zeros(0, np.uint64)
    values = [" ".join(f"w{int(rng.paretovariate(0.7))}" for _ in range(2000)).encode() for _ in range(40)]
    sent = [len(x) for _, x in ngram_lm._Grams(values, np.ones(40, bool), none, none, 3).blobs()]
    monkeypatch.setattr(ngram_lm, "LEVEL", 1)
    assert sum(sent) < sum(len(x) for _, x in ngram_lm._Grams(values, np.ones(40, bool), none, none, 3).blobs())
