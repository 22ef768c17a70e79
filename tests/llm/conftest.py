import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("size", T.StringType()), T.StructField("kept", T.IntegerType()), T.StructField("a.b c", T.StringType())])


def sentence(rng, n):
    return " ".join("".join(rng.choice("aeiou" if k % 2 else "bcdfgst") for k in range(rng.randint(2, 7))) for _ in range(n))


def rows():
    """Texts with every odd case: null, empty, blank, long, copies, near copies, shared passages, repeated rows, null ids."""
    rng = random.Random(5)
    passage = sentence(rng, 60)
    base = sentence(rng, 200)
    words = base.split()
    out = [(0, base, "en", "s0"), (1, base, "en", "s1"), (2, base.upper(), "en", None), (3, " ".join([*words[:-1], "changed"]), "fr", "s0")]
    out += [(4, None, None, None), (5, "", "en", "s1"), (6, " \n\t ", "en", ""), (7, "é" * 40 + " ünï " + passage, "fr", "s0"), (8, passage + " tail\n" + passage, "de", "s1")]
    out += [(k, sentence(rng, rng.choice([1, 3, 19, 20, 60, 300])), rng.choice(["en", "fr"]), rng.choice(["s0", "s1", "s2"])) for k in range(9, 60)]
    out += [(60, "same words here again and again\n" * 40, "en", "s2"), (61, sentence(rng, 20_000), "en", "s2"), (62, "x" * 70_000, "en", "s0")]
    out += [out[9], out[9], (9, "one id, another text", "en", "s0"), (None, base, "en", "s0"), (None, passage, None, "s1")]
    return [(d, t, lang, src, len(t or ""), "old", 7, "z") for d, t, lang, src in out]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
