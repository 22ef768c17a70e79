"""Statistics of samples in windows against plain pairs, on ties, missing values, edges of bins and repeated windows."""

import math
import random
from collections import defaultdict
from statistics import fmean, median, pstdev

import pytest

from streamalign.operators import bins, response, windows
from streamalign.plans import QUERIES

SF = "/root/testdata/sf0.001"


def data(seed=3):
    rng = random.Random(seed)
    at = lambda: rng.choice([round(rng.uniform(-50, 150), 1), float(rng.randrange(-50, 150, 5))])
    w = [(k, rng.choice(["p", "q", "r", None]), k % 3, s, s + rng.choice([10.0, 10.0, 10.0, 4.0, 37.0])) for k in range(60) for s in [at()]]
    w += [w[0], w[1], (90, "p", 0, 5.0, 5.0), (91, "p", 1, None, 9.0), (92, "none", 2, 0.0, 10.0)]
    s = [(rng.choice(["p", "q", None]), rng.choice([1, 2, None]), at(), rng.choice([None, 0.5, rng.gauss(0, 1), rng.gauss(0, 1)])) for _ in range(900)]
    return w, s + [x for x in s[:100] for _ in range(3)] + [("p", 1, None, 1.0)]


@pytest.fixture(scope="module")
def given(spark):
    w, s = data()
    return w, s, spark.createDataFrame(w, "ord_w long, plane string, g long, start double, stop double").repartition(3), spark.createDataFrame(s, "plane string, roi long, t double, dff double").repartition(4)


def pairs(w, s, lo=None, hi=None):
    """(window, sample) of distinct windows with start <= t < stop, or from start + lo to start + hi."""
    for x in sorted(set(w), key=str):
        if x[3] is None or x[4] <= x[3]:
            continue
        a, b = (x[3], x[4]) if lo is None else (x[3] + lo, x[3] + hi)
        yield from ((x, y) for y in s if y[0] is not None and y[0] == x[1] and y[2] is not None and a <= y[2] < b)


def grouped(items):
    out = defaultdict(list)
    for k, v in items:
        out[k].append(v)
    return {k: [x for x in v if x is not None] for k, v in out.items()}


def same(df, keys, value, expected):
    got = [(tuple(r[k] for k in keys), r[value]) for r in df.collect()]
    assert len(got) == len(expected) and dict(got).keys() == expected.keys()
    for k, v in got:
        assert v == (None if expected[k] is None else pytest.approx(expected[k], abs=1e-9)), k


def test_medians_of_ranges():
    import numpy as np

    v = np.array([3.0, 1.0, 2.0, 7.0, 5.0])
    lo, hi = np.array([[0, 0, 1], [2, 4, 3]]), np.array([[0, 5, 3], [5, 5, 5]])
    assert windows.medians(v, lo, hi).tolist() == [[0.0, 3.0, 1.5], [5.0, 5.0, 6.0]]
    assert windows.medians(v[:0], lo[:0], hi[:0]).shape == (0, 3)


def test_window_medians(given):
    w, s, windows_, samples = given
    expected = {k: median(v) if v else None for k, v in grouped(((x[0], y[1]), y[3]) for x, y in pairs(w, s)).items()}
    same(windows.window_medians(windows_, samples, ["plane"], ["roi"], ["ord_w"], "dff"), ["ord_w", "roi"], "median", expected)


def test_bin_means(given):
    w, s, windows_, samples = given
    found = grouped(((x[0], y[1], math.floor((y[2] - x[3]) / 2.5)), y[3]) for x, y in pairs(w, s))
    same(bins.bin_repeat(samples, windows_, ["plane"], ["roi"], ["ord_w"], "dff", 2.5), ["ord_w", "roi", "bin"], "mean", {k: 100 * fmean(v) if v else None for k, v in found.items()})


def test_coverage_and_windows_with_samples(given):
    w, s, windows_, samples = given
    seen = defaultdict(set)
    for x, y in pairs(w, s):
        if y[3] is not None:
            seen[x[0]].add(math.floor((y[2] - x[3]) / 2.5))
    got = bins.time_coverage(windows_, samples, ["plane"], ["ord_w"], "dff", 2.5).collect()
    assert sorted(r.ord_w for r in got) == sorted(x[0] for x in w)
    length = {x[0]: max(1, math.ceil((x[4] - x[3]) / 2.5)) if x[3] is not None else 1 for x in w}
    assert {r.ord_w: r.coverage for r in got} == {k: len(seen[k]) / n for k, n in length.items()}
    hit = {x[0] for x, _ in pairs(w, s)}
    assert sorted(r.ord_w for r in windows.with_samples(windows_, samples, ["plane"], ["ord_w"]).collect()) == sorted(x[0] for x in w if x[0] in hit)


@pytest.mark.parametrize("delay", [-3.0, 0.0])
def test_means_by_position(given, delay):
    w, s, windows_, samples = given
    moved = [(*x[:3], x[3] + delay, x[4] + delay) for x in w if x[3] is not None]
    means = {k: fmean(v) if v else 0.0 for k, v in grouped(((x[0], x[2], y[0], y[1]), y[3]) for x, y in pairs(moved, s)).items()}
    by = grouped(((g, p, c), m) for (_, g, p, c), m in means.items())
    field = response.receptive_field(windows_, samples.filter("plane is not null"), ["plane"], ["plane", "roi"], ["g"], delay).filter("n > 0")
    same(field, ["g", "plane", "roi"], "raw", {k: fmean(v) for k, v in by.items()})
    sweep = response.onset_sweep(windows_, samples, ["plane"], ["plane", "roi"], ["g"], [7.0, delay]).filter(f"delay = {delay}")
    same(sweep, ["g", "plane", "roi"], "raw", {k: fmean(v) for k, v in by.items()})


def test_event_medians(given):
    w, s, windows_, samples = given
    events = [(*x[:4], x[3] + 1) for x in w if x[3] is not None]
    m = {k: median(v) if v else None for k, v in grouped(((x[0], y[1], math.floor((y[2] - x[3]) / 5)), y[3]) for x, y in pairs(events, s, -20.0, 20.0)).items()}
    early = grouped(((k[0], k[1]), v) for k, v in m.items() if k[2] < 0)
    deviation = lambda k: pstdev(early[k]) if early.get(k) else 0.0
    z = {k: None if v is None or not deviation(k[:2]) else (v - fmean(early[k[:2]])) / deviation(k[:2]) for k, v in m.items()}
    got = response.peri_event_z(windows_, samples, ["plane"], ["roi"], 20.0, 20.0, 5.0)
    same(got, ["ord_w", "roi", "bin"], "median", m)
    same(got, ["ord_w", "roi", "bin"], "z", z)


def test_responses(given):
    w, s, windows_, samples = given
    events = [(*x[:4], x[3] + 1) for x in w if x[3] is not None]
    of = lambda lo, hi: {k: median(v) if v else None for k, v in grouped(((x[0], x[2], y[0], y[1]), y[3]) for x, y in pairs(events, s, lo, hi)).items()}
    base, answer = of(-5.0, 0.0), of(0.0, 10.0)
    less = lambda a, b: None if a is None or b is None else a - b
    got = response.tuning_responses(windows_.distinct(), samples, ["plane"], ["plane", "roi"], 10.0, (0.0, 10.0), (-5.0, 0.0))
    same(got, ["ord_w", "plane", "roi"], "response", {(k[0], *k[2:]): less(answer[k], base[k]) for k in answer.keys() & base.keys()})
    m = {k: median(v) if v else None for k, v in grouped(((x[0], x[2], y[0], y[1], math.floor((y[2] - x[3] + 10) / 2.5)), y[3]) for x, y in pairs(events, s, -10.0, 10.0)).items()}
    by = grouped((k[1:], less(v, base.get(k[:4]))) for k, v in m.items())
    got = response.peri_event_tuning(windows_, samples, ["plane"], ["plane", "roi"], ["g"], (-10.0, 10.0), 2.5, (-5.0, 0.0))
    same(got, ["g", "plane", "roi", "bin"], "mean", {k: fmean(v) if v else None for k, v in by.items()})
    same(got, ["g", "plane", "roi", "bin"], "n", {k: len(v) for k, v in by.items()})


NO_PAIRS = "a2_bin_repeat a4_window_median a5_receptive_field a6_time_coverage a7_peri_event_z a7_peri_event_z_planes a8_orientation_tuning a8_peri_event a8_peri_event_blocks a9_normalize_tuning a9_preferred a9_rank_rois j18_onset_sweep j19_windows_with_samples"


@pytest.mark.parametrize("name", NO_PAIRS.split())
def test_no_pair_of_window_and_sample_is_a_row(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().toString()
    assert "CoGroupsInArrow" in plan and "__bucket" not in plan
