"""Operators 11 to 13 against brute force and the libraries, on odd cases and on given tables."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
import public_tokenizers
from pyspark.sql import types as T

from streamalign.llm import align, common, piece_bpe, queries, vector_codes

SF = "/root/testdata/sf0.001"
ODD = [" ", "  ", "\n", "\t", "\r", "a;\r", "▁", "a", "the", "é", "日本", "　", " ", "\x1c", "\x85", "😀", "\x00", "<s>", "<0x41>", "<|endoftext|>", "ing", "'ll", " t", "0", "!!", "​", "﻿", "é"]


def path(name):
    return public_tokenizers.path(name)


@pytest.fixture(scope="module")
def pieces():
    with open(path("piece_bpe_32k.model"), "rb") as f:
        return piece_bpe.PieceBpe(f.read())


@pytest.fixture(scope="module")
def aligner():
    with open(path("byte_bpe_50k.json"), "rb") as a, open(path("piece_bpe_32k.model"), "rb") as b:
        return align.Aligner(a.read(), b.read())


def odd_texts(n, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def ids_of(bpe, text):
    return np.frombuffer(b"".join(bpe.encode(text)), "<u4").tolist()


# sentencepiece


def test_pieces_equal_the_library(pieces, monkeypatch):
    texts = [*odd_texts(2000), "x" * 70_000, "word " * 50_000, " " * 3000, "\n" * 3000, "日" * 5000]
    expected = pieces.library.encode(texts)
    assert [ids_of(pieces, t) for t in texts] == expected
    monkeypatch.setattr(piece_bpe, "PART", 20)  # cuts change nothing
    assert [ids_of(pieces, t) for t in texts[:2000]] == expected[:2000]
    assert [pieces.merged(t.replace(" ", "▁")) for t in ["▁" + "ab c" * 20]] == [pieces.library.encode("ab c" * 20)]


def test_agenda_as_list_or_heap(pieces, monkeypatch):
    texts = ["▁" + t.replace(" ", "▁")[:24] for t in odd_texts(500, 4)]
    short = [pieces.merged(t) for t in texts]
    monkeypatch.setattr(piece_bpe, "SHORT", 0)
    assert [pieces.merged(t) for t in texts] == short


def test_decoding_any_ids(pieces):
    rng = random.Random(1)
    for _ in range(2000):
        ids = [rng.randrange(3, 259) if rng.random() < 0.7 else rng.randrange(len(pieces.pieces)) for _ in range(15)]
        assert pieces.decode(ids) == pieces.library.decode(ids)


def test_edges_of_segments():
    segment, edge = piece_bpe.edges(["a", "▁a", "b\n", "▁▁"])
    assert segment.findall(" a b\nc\td  ") == [" a", " b\nc", "\td", "  "]
    segment, edge = piece_bpe.edges(["a▁b"])
    assert segment.findall(" a b") == [" a b"] and not edge.search(" a b")


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        piece_bpe.PieceBpe(b"")
    with pytest.raises(ValueError):
        align.byte_level_tokens(b'{"model": {"type": "WordPiece"}}')


def test_memory_of_segments_is_bounded(pieces):
    small = piece_bpe.PieceBpe(open(path("piece_bpe_32k.model"), "rb").read(), most_remembered=10)
    text = " ".join(map(str, range(500)))
    assert ids_of(small, text) == pieces.library.encode(text)
    assert len(small.recent) <= 500


def test_tokenize_pieces(docs, empty, pieces):
    out = piece_bpe.tokenize_pieces(docs, path("piece_bpe_32k.model"))
    assert out.columns == [*docs.columns, "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    got = Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256, tuple(r.ids)) for r in out.collect())
    expected = Counter()
    for r in docs.collect():
        ids = pieces.library.encode(r.text or "", add_bos=True, add_eos=True)
        expected[r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(pieces.library.decode(ids).encode()).hexdigest(), tuple(ids)] += 1
    assert got == expected
    assert piece_bpe.tokenize_pieces(empty, path("piece_bpe_32k.model")).count() == 0


def test_query_12_whole_table(spark, pieces):
    got = {r.doc_id: r for r in queries.op12_piece_bpe(spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = pieces.library.encode(r.text or "", add_bos=True, add_eos=True)
        assert got[r.doc_id].n_tokens == len(ids)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256(pieces.library.decode(ids).encode()).hexdigest()


# alignment


def brute(texts):
    """The contract, text by text and byte by byte, with the two libraries."""
    import sentencepiece
    import tokenizers

    a = tokenizers.Tokenizer.from_file(path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=path("piece_bpe_32k.model"))
    of = align.byte_alphabet()
    rows, held = [], Counter()
    for text in texts:
        whole = (" " + text).encode() if text else b""
        ids_a, ids_b = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        bytes_a = [bytes(of[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if not text or b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            rows.append((0, 0, 0, "", Counter()))
            continue
        ends = [np.cumsum([len(t) for t in x]).tolist() for x in (bytes_a, bytes_b)]
        cuts = sorted(set(ends[0]) & set(ends[1]))
        written, x, y = [], 0, 0
        for cut in cuts:
            u, v = ends[0].index(cut) + 1, ends[1].index(cut) + 1
            written.append(",".join(map(str, ids_a[x:u])) + "|" + ",".join(map(str, ids_b[y:v])))
            x, y = u, v
        owner_a = np.repeat(np.arange(len(ids_a)), [len(t) for t in bytes_a]).tolist()
        owner_b = np.repeat(np.arange(len(ids_b)), [len(t) for t in bytes_b]).tolist()
        links = Counter((ids_a[i], ids_b[j]) for i, j in {*zip(owner_a, owner_b, strict=True)})
        held.update(links.keys())
        rows.append((len(ids_a), len(ids_b), len(cuts), hashlib.sha256(";".join(written).encode()).hexdigest(), links))
    best = {}
    for (i, _), n in held.items():
        best[i] = max(best.get(i, 0), n)
    return [(n_a, n_b, g, sum(links.values()), sum(k for (i, j), k in links.items() if held[i, j] == best[i]), sum(k * held[p] for p, k in links.items()), sha) for n_a, n_b, g, sha, links in rows]


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_aligner_on_odd_texts(spark):
    texts = [*odd_texts(300), *odd_texts(20), None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in align.align_tokens(docs, path("byte_bpe_50k.json"), path("piece_bpe_32k.model"), group_bytes=500).collect()}
    assert [got[i] for i in range(len(texts))] == brute([t or "" for t in texts])


def test_align_tokens(docs, empty, monkeypatch):
    files = path("byte_bpe_50k.json"), path("piece_bpe_32k.model")
    out = align.align_tokens(docs, *files)
    assert out.columns == [*(c for c in docs.columns if c != "text"), "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
    got = Counter((r.doc_id, *(r[c] for c in COLUMNS)) for r in out.collect())
    given = docs.collect()
    assert got == Counter((r.doc_id, *x) for r, x in zip(given, brute([r.text or "" for r in given]), strict=True))
    monkeypatch.setattr(common, "BROADCAST_ROWS", 200)  # the rare pairs are joined by a shuffle
    assert Counter((r.doc_id, *(r[c] for c in COLUMNS)) for r in align.align_tokens(docs, *files).collect()) == got
    assert align.align_tokens(empty, *files).count() == 0


def test_what_is_remembered_changes_nothing(aligner):
    with open(path("byte_bpe_50k.json"), "rb") as a, open(path("piece_bpe_32k.model"), "rb") as b:
        small = align.Aligner(a.read(), b.read(), 50, 50)
    texts = odd_texts(200, 6)
    parts = [small.report(texts[i : i + 10]) for i in range(0, 200, 10)]
    assert [x for p in parts for x in p["groups_sha256"]] == aligner.report(texts)["groups_sha256"]


def test_windows_end_at_shared_ends_before_blanks(aligner):
    a, _, b, _ = aligner.encode(["one two  three", "four"])
    end_a, end_b = aligner.anchors(a, b)
    stops_a, stops_b = np.cumsum(aligner.size_a[a])[end_a - 1], np.cumsum(aligner.size_b[b])[end_b - 1]
    assert stops_a.tolist() == stops_b.tolist()
    assert all((" one two  three" + " four")[s : s + 1] in (" ", "") for s in stops_a.tolist())


def test_query_11_whole_table(spark):
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in queries.op11_alignment(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert [got[r.doc_id] for r in docs] == brute([r.text or "" for r in docs])


# vector codes


def fit(rows, parts=8, entries=16, rounds=6):
    """(code, error, digest) of rows (ident, vector, label), in Python's integers."""
    fine = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    fine.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    cut = [[[math.floor(4096 * x) for x in r[1]][p * len(r[1]) // parts : (p + 1) * len(r[1]) // parts] for p in range(parts)] for r in fine]
    books = [[list(v[p]) for v in cut[:entries]] for p in range(parts)]
    far = lambda x, e: sum((a - b) ** 2 for a, b in zip(x, e, strict=True))
    near = lambda v: [min(range(len(books[p])), key=lambda e: (far(v[p], books[p][e]), e)) for p in range(parts)]
    for _ in range(rounds):
        picked = [near(v) for v in cut]
        for p in range(parts):
            for e in range(len(books[p])):
                own = [v[p] for v, k in zip(cut, picked, strict=True) if k[p] == e]
                if own:
                    books[p][e] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    picked = [near(v) for v in cut]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return Counter((r[0], r[2], "".join(f"{e:02x}" for e in k), sum(far(v[p], books[p][e]) for p, e in enumerate(k)), digest) for r, v, k in zip(fine, cut, picked, strict=True))


VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType()), T.StructField("Code", T.IntegerType()), T.StructField("a.b", T.StringType())])


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, label, 5, "z") for i, v, label in rows], VECTORS).repartition(3)


def given(n, scale=1.0, seed=2):
    rng = random.Random(seed)
    exact = lambda x: float(np.float32(x))
    out = [(i, [exact(rng.gauss(0, scale)) for _ in range(16)], rng.choice([1, 1, 2, None])) for i in range(n)]
    return out + out[3:6] + [(n, None, 1), (n + 1, [None] * 16, 1), (n + 2, [math.nan] * 16, 1), (n + 3, [math.inf] * 16, 2), (None, out[0][1], 3)]


def coded(df):
    return Counter((r.vec_id, r.label, r.code, r.error, r.codebooks_sha256) for r in df.collect())


@pytest.mark.parametrize("scale", [0.2, 1e8, 1e17])
def test_vector_codes(spark, scale, monkeypatch):
    rows = given(150, scale)
    out = vector_codes.compress_vectors(vectors(spark, rows))
    assert out.columns == ["vec_id", "label", "a.b", "code", "error", "label_error", "codebooks_sha256"]
    expected = fit(rows)
    fits = Counter({(i, label, code, error if error < 2**63 else None, digest): n for (i, label, code, error, digest), n in expected.items()})
    assert coded(out) == fits
    sums = {}
    for (_, label, _, error, _), n in expected.items():
        sums.setdefault(label, []).extend([error] * n)
    for r in out.collect():
        own = sums[r.label]
        assert r.label_error == (sum(own) if max(own) < 2**63 and sum(own) < 2**63 else None)
    monkeypatch.setattr(vector_codes, "BLOCK_ROWS", 7)  # smaller dictionaries give the same
    assert coded(vector_codes.compress_vectors(vectors(spark, rows))) == fits


def test_few_ties_and_no_vectors(spark):
    same = [(i, [0.5] * 8, 1) for i in range(40)]
    assert coded(vector_codes.compress_vectors(vectors(spark, same))) == fit(same)
    few = given(3)
    assert coded(vector_codes.compress_vectors(vectors(spark, few))) == fit(few)
    assert vector_codes.compress_vectors(vectors(spark, [])).count() == 0
    assert vector_codes.compress_vectors(vectors(spark, [(1, None, 1)])).count() == 0


def test_other_lengths(spark):
    rows = [*given(20)[:20], (50, [1.0] * 8, 9), (51, [], 9)]
    out = {r.vec_id: r for r in vector_codes.compress_vectors(vectors(spark, rows)).collect()}
    assert out[50].code is None and out[51].error is None and out[50].label_error is None and out[3].code
    with pytest.raises(ValueError):
        vector_codes.compress_vectors(vectors(spark, [(1, [1.0] * 7, 1)]))


def test_join_frequent_beyond_a_broadcast(spark, monkeypatch):
    df = spark.createDataFrame([(k % 7 if k % 3 else None, k) for k in range(300)], "k int, v int")
    counted = df.groupBy("k").count()
    whole = sorted(map(tuple, common.join_frequent(df, counted.withColumn("c", counted["count"]), "k", "count").collect()), key=str)
    monkeypatch.setattr(common, "BROADCAST_ROWS", 2)
    assert sorted(map(tuple, common.join_frequent(df, counted.withColumn("c", counted["count"]), "k", "count").collect()), key=str) == whole
    assert len(whole) == 300
