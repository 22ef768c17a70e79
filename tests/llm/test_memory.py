"""What steps of the repeated-passages operator hold at once, and that chunks are made of several small Arrow batches."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from streamalign.llm import common, suffix_dedup

from .conftest import sentence


def peak(run):
    """Bytes allocated at once, and the result."""
    tracemalloc.start()
    try:
        result = run()
        return tracemalloc.get_traced_memory()[1], result
    finally:
        tracemalloc.stop()


def test_steps_of_a_chunk_are_lean():
    rng = random.Random(3)
    t = common.Texts([sentence(rng, 400).encode() for _ in range(400)])
    n = len(t.buf)
    used, _ = peak(lambda: suffix_dedup._anchors(t, 50))
    assert used < 16 * n
    gone = np.zeros(n, dtype=bool)
    for a, b in zip(t.start.tolist(), t.end.tolist(), strict=True):
        gone[a : a + 60] = gone[b - 55 : b] = True
    used, (removed, runs, kept) = peak(lambda: suffix_dedup._spans(t, gone))
    assert used < 4 * n
    assert set(removed) == {115} and set(runs) == {2}
    assert kept[7] == t.buf[t.start[7] + 60 : t.end[7] - 55].tobytes()


def test_chunks_are_made_of_several_batches(spark):
    rng = random.Random(4)
    rows = [(k, None if k % 50 == 3 else sentence(rng, 100)) for k in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    with common.batches_up_to(spark, "16k"):
        chunks = common.pack_chunks(docs, 100_000, gather=True).collect()
    batches = [common.unpack_chunk(c.payload) for c in chunks]
    assert [(i, x) for b in batches for i, x in zip(*(c.to_pylist() for c in b.columns), strict=True)] == rows
    sizes = [sum(map(len, common.to_bytes(b.column("text")))) for b in batches]
    assert max(sizes) <= 100_000 and min(sizes[:-1]) > 70_000


@pytest.mark.parametrize("step", [corpus_pipeline.quality, corpus_pipeline.token_ids])
def test_stages_hand_small_batches_to_python(spark, monkeypatch, step):
    monkeypatch.setattr(corpus_pipeline, "train_quality", lambda docs, labels: None)
    monkeypatch.setattr(corpus_pipeline, "keep_good", lambda docs, model: docs)
    docs = spark.createDataFrame([(k, "s", "word " * 2000) for k in range(800)], "doc_id long, source string, text string").coalesce(1)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"])

    with common.batches_up_to(spark, "256m"):  # what a session has by default; it is put back afterwards
        step(spark, docs, "/root/testdata/sf0.001")
        found = [r.n for r in docs.mapInArrow(sizes, "n long").collect()]
    assert sum(found) > 8_000_000 and max(found) < 3_000_000
