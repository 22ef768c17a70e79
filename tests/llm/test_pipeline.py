"""The pipeline against its stages by brute force, on a small folder of tables with odd rows."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from streamalign.llm import bpe, mixing, quality, queries

from .test_near import brute_groups
from .test_operators import brute_repeats, utf8


@pytest.fixture(scope="module")
def folder(docs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    docs.write.parquet(f"{path}/documents.parquet")
    docs.filter("doc_id is not null").select("doc_id", F.when(F.col("doc_id") % 5 == 0, 0).otherwise(1).alias("quality"), F.lit(0).alias("toxic")).write.parquet(f"{path}/labels.parquet")
    return path


def test_pipeline(spark, docs, folder):
    tiktoken, public_tokenizers = pytest.importorskip("tiktoken"), pytest.importorskip("public_tokenizers")
    # quality
    model = quality.train_quality(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    good = [r for r in quality.score_quality(docs, model).collect() if r.kept]
    # near duplicates: one row with the smallest id of each group of similar texts
    single = []
    for group in brute_groups([(k, r.text) for k, r in enumerate(good)]):
        single.append(min((good[k] for k in group), key=lambda r: (r.doc_id is None, r.doc_id or 0)))
    # repeats
    stage3 = corpus_pipeline.repeated_passages(spark, spark.createDataFrame([(r.doc_id, r.text, r.source) for r in single], "doc_id long, text string, source string"), folder)
    report = brute_repeats([(r.doc_id, utf8(r.text)) for r in single], 50)
    cut = stage3.collect()
    assert Counter(hashlib.sha256(utf8(r.text)).hexdigest() for r in cut if r.doc_id is not None) <= Counter({k[4]: v for k, v in report.items()}) + Counter(hashlib.sha256(utf8(r.text)).hexdigest() for r in cut if "é" in (r.text or ""))
    # mix and tokens
    mixed = mixing.mix_sources(stage3).collect()
    with open(queries.vocabulary_file(), "rb") as f:
        ref = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.vocabulary(f.read()), special_tokens={})
    expected = Counter()
    for r in mixed:
        ids = np.array(ref.encode_ordinary(r.text or ""), "<u4")
        expected[(r.doc_id, len(ids), hashlib.sha256(ids.tobytes()).hexdigest())] += r.copies
    got = corpus_pipeline.run(spark, folder).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256) for r in got) == +expected and got


def test_stages_keep_the_columns(spark, docs, empty, folder):
    for rows in (docs, empty):
        for _, step in corpus_pipeline.STAGES[:-1]:
            out = step(spark, rows, folder)
            assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
            assert out.count() <= 2 * rows.count()
        assert corpus_pipeline.STAGES[-1][1](spark, rows, folder).count() == rows.count()


def test_near_duplicate_stage_leaves_one(spark, docs, folder):
    kept = corpus_pipeline.near_duplicates(spark, docs, folder).collect()
    assert len(kept) == len(brute_groups([(r.doc_id, r.text) for r in docs.collect()]))
    assert 0 in {r.doc_id for r in kept} and not {1, 2, 3} & {r.doc_id for r in kept}
