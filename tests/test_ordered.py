"""Percentiles, carries, stretches of equal depth, bounded ends and islands, on a session of a third of all rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from streamalign.operators import interp, ordered, quantiles, response


def streams(n=6000, seed=1):
    """(session, ord, x): one session has a third of the rows, one key is NULL; values with ties, gaps and NULLs."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        s = "hot" if i % 3 == 0 else rng.choice(["a", "b", "c", None])
        out.append((s, i, rng.choice([None, 0.0, rng.gauss(0, 1), rng.gauss(0, 1e6), 7.5])))
    return out + [("none", n, None), ("one", n + 1, 2.0)]


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(streams(), "session string, ord bigint, x double").repartition(5).cache()


@pytest.mark.parametrize("accuracy", [10, 50, 2000])
def test_percentiles_are_exact(frame, accuracy):
    shares = [0.0, 0.01, 0.1, 0.5, 0.9, 0.999, 1.0]
    got = {r.session: r for r in quantiles.percentiles(frame, ["session"], "x", shares, accuracy, more=[F.count("*").alias("rows")]).collect()}
    own = {}
    for s, _, x in streams():
        own.setdefault(s, []).append(x)
    assert got.keys() == own.keys()
    for s, values in own.items():
        fine = [x for x in values if x is not None]
        assert (got[s].n, got[s].rows) == (len(fine), len(values))
        if fine:
            assert np.allclose(got[s].q, np.quantile(fine, shares), rtol=1e-12, atol=1e-12)
        else:
            assert got[s].q is None


def test_percentiles_without_keys(frame):
    (r,) = quantiles.percentiles(frame, [], "x", [0.5], 50).collect()
    assert r.q[0] == np.median([x for _, _, x in streams() if x is not None])
    assert quantiles.median(frame.limit(0), ["session"], "x", "m").count() == 0


def test_bracket_is_a_small_part_of_a_session(spark):
    """What the second pass shuffles is what lies in the brackets, not the session."""
    big = spark.range(200_000).select(F.lit(1).alias("session"), (F.col("id") * 7919 % 200_003).cast("double").alias("x"))
    found = quantiles.median(big, ["session"], "x", "m", accuracy=1000)
    assert found.first().m == np.median(np.arange(200_000) * 7919 % 200_003)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile(" not in plan and "median(" not in plan


@pytest.mark.parametrize("width", [1, 64, 1 << 16, None])
def test_carries_in_one_step(frame, width):
    out = ordered.with_carries(frame, ["session"], "ord", previous=["x", "ord"], following=["ord"], sums={"n": F.lit(1), "high": (F.col("x") > 1).cast("int")}, width=width)
    own = {}
    for s, o, x in streams():
        own.setdefault(s, []).append((o, x))
    expected = set()
    for s, rows in own.items():
        high = 0
        for i, (o, x) in enumerate(rows):
            high += x is not None and x > 1
            expected.add((s, o, x, *(rows[i - 1][::-1] if i else (None, None)), i > 0, rows[i + 1][0] if i + 1 < len(rows) else None, i + 1 < len(rows), i + 1, high))
    assert {tuple(r) for r in out.select("session", "ord", "x", "prev_x", "prev_ord", "has_prev", "next_ord", "has_next", "n", "high").collect()} == expected


def test_columns_of_internal_names_are_kept(spark):
    df = spark.createDataFrame([("a", 1, 5, 6, 7), ("a", 2, 8, 9, 10)], "k string, ord int, __stretch int, __row int, __s int")
    out = ordered.with_ordinal(ordered.with_previous(df, ["k"], "ord", ["__row"]), ["k"], "ord").orderBy("ord").collect()
    assert [(r["__stretch"], r["__row"], r["__s"], r["prev___row"], r.ordinal) for r in out] == [(5, 6, 7, None, 0), (8, 9, 10, 6, 1)]


def test_a_fast_hour_is_many_stretches(spark, monkeypatch):
    """A stream of 1 kHz in seconds, without a width; its results are those of one stretch."""
    hour = spark.range(3600 * 20).select(F.lit(1).alias("session"), (F.col("id") / 20.0).alias("t"), (F.col("id") % 97).cast("double").alias("v"))
    asked = spark.range(1000).select(F.lit(1).alias("session"), (F.col("id") * 3.6017 + 0.003).alias("t"))
    monkeypatch.setattr(ordered, "DEPTH", 2000)
    parts = ordered._cut_evenly(hour, ["session"], "t", "part").groupBy("part").count().collect()
    assert len(parts) >= 36 and max(r["count"] for r in parts) <= 4_000
    rows = lambda df: sorted(map(tuple, df.select("t", "value_at").collect()))
    even = rows(interp.interpolate(asked, hour, ["session"], "t", "v"))
    assert even == rows(interp.interpolate(asked, hour, ["session"], "t", "v", width=1e9)) and len(even) == 1000


def test_ties_stay_in_one_stretch(spark, monkeypatch):
    monkeypatch.setattr(ordered, "DEPTH", 10)
    df = spark.createDataFrame([(1, float(i // 40)) for i in range(400)], "k int, t double")
    parts = ordered._cut_evenly(df, ["k"], "t", "part").groupBy("t").agg(F.count_distinct("part").alias("n")).collect()
    assert all(r.n == 1 for r in parts)


@pytest.mark.parametrize("n", [1, 2, 20])
def test_first_rows(frame, n):
    for last in (False, True):
        got = {r.session: [(x.ord, x.x) for x in r["rows"]] for r in ordered.first_rows(frame, ["session"], "ord", ["x"], n, last, slices=3).collect()}
        own = {}
        for s, o, x in streams():
            own.setdefault(s, []).append((o, x))
        assert got == {s: rows[-n:] if last else rows[:n] for s, rows in own.items()}


def test_end_lines_equal_least_squares(spark):
    rng = random.Random(4)
    rows = [("a", i * 1.5, rng.gauss(i, 3)) for i in range(300)] + [("b", float(i), None if i % 2 else 2.0 * i) for i in range(30)] + [("c", 1.0, 1.0)]
    got = {r.k: r for r in interp.end_lines(spark.createDataFrame(rows, "k string, x double, y double"), ["k"], "x", "y").collect()}
    a = [r for r in rows if r[0] == "a"]
    for part, name in ((a[:20], "first_slope"), (a[-20:], "last_slope")):
        assert np.isclose(got["a"][name], np.polyfit([p[1] for p in part], [p[2] for p in part], 1)[0])
    assert np.isclose(got["b"].first_slope, 2.0) and got["c"].first_slope is None
    assert (got["a"].first.x, got["a"].last.x) == (0.0, 448.5)


def test_paired_by_order(spark):
    a = spark.createDataFrame([("s", i, i * 1.0) for i in range(5)] + [(None, 1, 0.5)], "k string, ord int, t double")
    b = spark.createDataFrame([("s", i * 10, i * 2.0) for i in range(3)] + [("z", 1, 9.0)], "k string, ord int, t double")
    got = {(r.k, r.pair): (r.l.t if r.l else None, r.r.t if r.r else None) for r in ordered.paired(a, b, ["k"], "ord").collect()}
    assert got == {("s", 0): (0.0, 0.0), ("s", 1): (1.0, 2.0), ("s", 2): (2.0, 4.0), ("s", 3): (3.0, None), ("s", 4): (4.0, None), (None, 0): (0.5, None), ("z", 0): (None, 9.0)}


def test_islands_over_stretches(spark, monkeypatch):
    monkeypatch.setattr(ordered, "DEPTH", 8)
    rng = random.Random(2)
    rows = [(s, float(rng.randrange(60)), 100.0 + i, rng.choice("ab")) for i in range(400) for s in ("hot" if i % 3 == 0 else rng.choice("xyz"),)]
    got = sorted(tuple(r) for r in response.epochs(spark.createDataFrame(rows, "session string, start double, stop double, name string")).select("session", "epoch", "name", "start", "stop", "n", "label").collect())
    expected = []
    for s in {r[0] for r in rows}:
        own = sorted(r[1:] for r in rows if r[0] == s)
        runs = []
        for start, stop, name in own:
            if runs and runs[-1][0] == name:
                runs[-1][1].append((start, stop))
            else:
                runs.append((name, [(start, stop)]))
        seen = {}
        for e, (name, spans) in enumerate(runs, 1):
            seen[name] = seen.get(name, 0) + 1
            several = sum(r[0] == name for r in runs) > 1
            expected.append((s, e, name, min(x[0] for x in spans), max(x[1] for x in spans), len(spans), f"{name} {seen[name]}" if several else name))
    assert got == sorted(expected)


@pytest.mark.parametrize("width", [None, 2.0])
def test_tied_samples_give_the_last_recorded(spark, width):
    # five samples at each of four times; the one recorded last counts, and it has no value at time 2
    tied = [(1, 5 * int(t) + n, t, None if (t, n) == (2.0, 4) else 10 * t + n) for t in (0.0, 1.0, 2.0, 5.0) for n in (3, 0, 4, 1, 2)]
    series = spark.createDataFrame(tied, "s long, ord long, t double, y double").repartition(5)
    asked = spark.createDataFrame([(1, float(t)) for t in (0, 0.5, 1, 1.5, 2, 3, 5)], "s long, t double")
    found = interp.interpolate_supported(asked, series, ["s"], "t", "y", 9.0, width, "ord")
    assert [r.value_at for r in sorted(found.collect(), key=lambda r: r.t)] == [4.0, 9.0, 14.0, None, None, None, 54.0]
