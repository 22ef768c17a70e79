"""Operators on small inputs with known results."""

import math

import pytest
from pyspark.sql import functions as F

from streamalign.functions import columns as C
from streamalign.operators import bins, clean, edges, interp, lines, ordered, report, response, signals, stimlog
from streamalign.sources import files, tables

K = ["s"]


def rows(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


def make(spark, data, schema):
    return spark.createDataFrame(data, schema)


def stream(spark, times, start=0, session=1):
    return make(spark, [(session, start + k, float(t)) for k, t in enumerate(times)], "s long, ord long, t double")


# ordered streams


@pytest.mark.parametrize("width", [1, 3, 1000])
def test_stretches_change_nothing(spark, width):
    data = [(s, k, (k * 7 + (s or 9)) % 5) for s in (1, 2, None) for k in range(20) if (k + (s or 0)) % 4]
    df = make(spark, data, "s long, ord long, v long")
    out = ordered.with_running_sum(ordered.with_next(ordered.with_previous(df, K, "ord", ["v"], width), K, "ord", ["v"], width), K, "ord", F.col("v"), "total", width)
    for s in (1, 2, None):
        mine = sorted((r for r in out.collect() if r.s == s), key=lambda r: r.ord)
        v = [x[2] for x in data if x[0] == s]
        assert [r.prev_v for r in mine] == [None, *v[:-1]] and [r.next_v for r in mine] == [*v[1:], None]
        assert [r.total for r in mine] == [sum(v[: k + 1]) for k in range(len(v))]


@pytest.mark.parametrize("width", [0.7, 5, 1000])
def test_range_join_lists_each_pair_once(spark, width):
    w = make(spark, [(1, 0, 0.0, 2.0), (1, 1, 1.5, 9.0), (1, 2, 3.0, 3.0), (2, 3, -4.0, 0.0)], "s long, w long, start double, stop double")
    x = make(spark, [(1, float(t)) for t in (0, 1.5, 2, 3, 9)] + [(2, -4.0), (2, 0.0)], "s long, t double")
    got = sorted(rows(ordered.window_samples(w, x, K, "start", "stop", "t", width), "w", "t"))
    assert got == [(0, 0.0), (0, 1.5), (1, 1.5), (1, 2.0), (1, 3.0), (3, -4.0)]


# edges and groups


def test_rising_edges_and_initial_high(spark):
    df = make(spark, [(1, k, float(k), x) for k, x in enumerate([True, True, False, True, False, True])], "s long, ord long, t double, state boolean")
    assert sorted(rows(edges.rising_edges(df, K), "t", "initial", "period")) == [(0.0, True, None), (3.0, False, 3.0), (5.0, False, 2.0)]
    assert sorted(rows(edges.transitions(df, K), "t", "state")) == [(2.0, False), (3.0, True), (4.0, False), (5.0, True)]


def grouped_edges(spark, sizes):
    t, out = 0.0, []
    for n in sizes:
        out += [t + 0.02 * k for k in range(n)]
        t = out[-1] + 1.0
    return stream(spark, out)


@pytest.mark.parametrize("sizes, highest, left", [([2, 4, 5, 6], 3, 15), ([2, 4, 5, 6], 2, 17), ([2, 3, 4, 5, 6], 3, 20)])
def test_drop_leading_group(spark, sizes, highest, left):
    expected = make(spark, [(1, 3, highest)], "s long, n_trials long, highest_trial long")
    groups = edges.split_by_gaps(grouped_edges(spark, sizes), K)
    assert edges.drop_leading_group(groups, expected, K).count() == left


def test_edges_before_the_first_start_go(spark):
    kept = edges.drop_before_first_start(stream(spark, [-10, -9.9, 0.1, 0.2, 0.3]), stream(spark, [0]), K)
    assert sorted(rows(kept, "t")) == [(0.1,), (0.2,), (0.3,)]


@pytest.mark.parametrize("cycles, policy, knots", [(2, "measured_end", [(1, 2.0), (11, 3.0), (21, 6.0)]), (3, "estimated_end", [(1, 2.0), (11, 3.0), (21, 6.0), (31, 8.0)]), (1, "invalid", [])])
def test_continuous_clock(spark, cycles, policy, knots):
    c = make(spark, [(1, cycles)], "s long, n_cycles long")
    k, rep = edges.continuous_clock(stream(spark, [2, 3, 6]), K, 10, c)
    assert rep.first().policy == policy and sorted(rows(k, "line", "t")) == knots


def test_continuous_lines(spark):
    c = make(spark, [(1, 2)], "s long, n_cycles long")
    k, _ = edges.continuous_clock(stream(spark, [2, 3, 6]), K, 10, c)
    x = make(spark, [(1, n) for n in (1, 2, 8, 10, 11, 12, 18, 31)], "s long, line long")
    got = sorted(rows(interp.uniform_knots(x, k, K, 10), "line", "mapped_t"))
    assert [g[1] for g in got[:-1]] == pytest.approx([2, 2.1, 2.7, 2.9, 3, 3.3, 5.1]) and got[-1][1] is None


# interpolation


def anchors(spark, xs, ys):
    return make(spark, [(1, float(x), None if y is None else float(y)) for x, y in zip(xs, ys)], "s long, x double, y double")


def queries(spark, xs):
    return make(spark, [(1, k, None if x is None else float(x)) for k, x in enumerate(xs)], "s long, k long, x double")


@pytest.mark.parametrize("width", [3, 1000])
def test_frames_with_status(spark, width):
    a = anchors(spark, [10, 20, 30, 40], [0.1, 0.2, 0.5, 0.6])
    got = sorted(rows(interp.map_with_status(queries(spark, range(10, 41, 5)), a, K, "x", "y", 10, 2, width=width), "k", "value_at", "status"))
    assert [g[1] for g in got] == pytest.approx([0.1, 0.15, 0.2, 0.35, 0.5, 0.55, 0.6]) and [g[2] for g in got] == [0, 1, 0, 1, 0, 1, 0]
    wide = anchors(spark, [0, 10, 100, 110], [0, 1, 10, 11])
    got = sorted(rows(interp.map_with_status(queries(spark, [10, 50, 100, 105, 111, 130]), wide, K, "x", "y", 10, 2, width=width), "k", "value_at", "status"))
    assert [g[2] for g in got] == [0, 3, 0, 1, 2, 3] and got[1][1] is None and got[5][1] is None and got[4][1] == pytest.approx(11.1)


@pytest.mark.parametrize("width", [2, 1000])
def test_supported_interpolation(spark, width):
    series = anchors(spark, [0, 1, 2, 3, 8], [0, 1, None, 3, 8])
    asked = queries(spark, [-1, 0, 0.5, 1, 1.5, 2, 2.5, 3, 8, None, 5])
    got = [r[1] for r in sorted(rows(interp.interpolate_supported(asked, series, K, "x", "y", 2, width), "k", "value_at"))]
    assert got == [None, 0, 0.5, 1, None, None, None, 3, 8, None, None]


@pytest.mark.parametrize("most, last", [(2, None), (20, 1.02)])
def test_endpoint_limit_is_a_parameter(spark, most, last):
    a = anchors(spark, range(0, 100, 10), [k / 10 for k in range(10)])
    value, beyond = rows(interp.map_boundaries(queries(spark, [102]), a, K, "x", "y", most), "value_at", "beyond")[0]
    assert beyond == 12 and value == (None if last is None else pytest.approx(last))


def test_assign_trial(spark):
    starts, ends = stream(spark, [0, 60]), stream(spark, [50])
    events = make(spark, [(1, k, float(t)) for k, t in enumerate([-1, 0, 50, 55, 60, 500])], "s long, ord long, t double")
    assert [r[1] for r in sorted(rows(interp.assign_trial(events, starts, ends, K), "ord", "trial"))] == [None, 0, 0, -1, 1, 1]


def test_pairing_report(spark):
    side = lambda states: make(spark, [(1, k, float(k), x) for k, x in enumerate(states)], "s long, ord long, t double, state boolean")
    fine = interp.pairing_report(interp.pair_by_order(side([True, False, True]), side([True, False, True]), K), K).first()
    assert fine.matched and fine.n_left == 3
    bad = interp.pairing_report(interp.pair_by_order(side([True, False, False]), side([True, False]), K), K).first()
    assert not bad.matched and bad.n_right == 2 and bad.first_bad == 2


def test_terminal_blip(spark):
    left = make(spark, [(1, k, f, x) for k, (f, x) in enumerate([(1, True), (5, False), (9, True), (10, False)])], "s long, ord long, frame long, state boolean")
    assert sorted(rows(interp.drop_terminal_blip(left, stream(spark, [1, 2]), K), "ord")) == [(0,), (1,)]
    assert interp.drop_terminal_blip(left, stream(spark, [1, 2, 3]), K).count() == 4


def test_nearest(spark):
    a = make(spark, [(1, 0, 5.0), (1, 1, 6.0), (1, 2, 100.0)], "s long, k long, t double")
    b = make(spark, [(1, 7, 4.0), (1, 3, 8.0), (1, 9, 4.0)], "s long, id long, t double")
    assert sorted(rows(interp.nearest_session(a, b, K, "t", "id"), "k", "nearest", "distance")) == [(0, 7, 1.0), (1, 3, 2.0), (2, 3, 92.0)]
    got = sorted(rows(interp.nearest_grid(a, "t", [0.0, 10.0, 100.0]), "k", "grid_index"))
    assert got == [(0, 0), (1, 1), (2, 2)]


# cleaning


def test_startup_pulse(spark):
    starts, ends, stim = stream(spark, [0, 16.5, 46.5, 76.5]), stream(spark, [0.001984, 46, 76]), stream(spark, [0.004, 19.5, 20.2])
    s, e, d = clean.trim_startup_pulse(starts, ends, stim, K)
    assert sorted(rows(s, "t")) == [(16.5,), (46.5,), (76.5,)] and sorted(rows(e, "t")) == [(46.0,), (76.0,)] and sorted(rows(d, "t")) == [(19.5,), (20.2,)]
    alone = clean.trim_startup_pulse(stream(spark, [0]), stream(spark, [0.05]), stim, K, continuous=True)
    assert alone[0].count() == 0


def test_unterminated_trial(spark):
    s, c = clean.trim_unterminated_trial(stream(spark, [0, 30, 60]), stream(spark, [29, 59]), stream(spark, [1, 59, 61]), K)
    assert sorted(rows(s, "t")) == [(0.0,), (30.0,)] and sorted(rows(c, "t")) == [(1.0,), (59.0,)]
    open_ = clean.unterminated_report(stream(spark, [0]), stream(spark, [1]).limit(0), K).first()
    assert open_.verdict == "open"


def test_settings_and_names(spark):
    df = make(spark, [("path3",), ("DMD_12",), ("x",)], "n string")
    assert rows(df.select(C.plane_name(F.col("n")).alias("p")), "p") == [("DMD3",), ("DMD12",), (None,)]
    assert clean.column_alias(df, ["m", "n"]) == "n"
    with pytest.raises(ValueError):
        clean.column_alias(df, ["m"])
    bad = clean.violations(make(spark, [(1, None), (1, 2)], "s long, v long"), K, {"null": F.col("v").isNull(), "large": F.col("v") > 5})
    assert sorted(rows(bad, "rule", "n_bad")) == [("large", 0), ("null", 1)]


def test_finite(spark):
    df = make(spark, [(float("nan"),), (float("inf"),), (1.0,), (None,)], "v double")
    assert rows(df.select(C.finite(F.col("v")).alias("v")), "v") == [(None,), (None,), (1.0,), (None,)]


# signals


def test_counter_and_speed(spark):
    df = make(spark, [(1, k, 0.5 * k, v) for k, v in enumerate([32766, 32767, -32768, -32767])], "s long, ord long, t double, c int")
    assert [r[1] for r in sorted(rows(signals.unwrap_counter(df, K, "c", width=2), "ord", "unwrapped"))] == [32766, 32767, 32768, 32769]
    turn = make(spark, [(1, 0, 0.0, 0), (1, 1, 0.5, 2048), (1, 2, 0.5, 2050), (1, 3, 1.0, 4096)], "s long, ord long, t double, unwrapped long")
    got = sorted(rows(signals.interval_speed(turn, K), "ord", "rotation", "speed"))
    assert [g[0] for g in got] == [0, 2] and got[0][1] == pytest.approx(math.pi / 2) and got[0][2] == pytest.approx(10 * math.pi)


@pytest.mark.parametrize("stretch", [2, 100])
def test_dilate(spark, stretch):
    df = make(spark, [(1, k, x) for k, x in enumerate([False, False, True, False, False, False])], "s long, frame long, f boolean")
    assert [r[1] for r in sorted(rows(signals.dilate(df, K, "f", 2, stretch=stretch), "frame", "dilated"))] == [True] * 5 + [False]


def test_blinks(spark):
    data = [(1, k, 2.0, 2.0, 1.0, None if k == 2 else 1.5) for k in range(4)]
    df = make(spark, data, "s long, frame long, eye_width double, eye_height double, pupil_width double, pupil_height double")
    got = sorted(rows(signals.tracking_metrics(df, K, 1), "frame", "likely_blink", "pupil_area_raw", "eye_area"))
    assert [g[1] for g in got] == [False, True, True, True] and got[2][2] is None and got[1][3] == -1 and got[0][2] == pytest.approx(math.pi * 2.25)


def test_baseline_of_a_constant(spark):
    df = make(spark, [(t, k, 3.0) for t in (0, 1) for k in range(20)], "trial long, ord long, v double")
    assert {(r.f0, r.dff) for r in signals.baseline(df, ["trial"], "v", 3, 6).collect()} == {(3.0, 0.0)}
    zero = make(spark, [(0, k, 0.0) for k in range(5)], "trial long, ord long, v double")
    assert {r.dff for r in signals.baseline(zero, ["trial"], "v", 3, 6).collect()} == {None}


def test_population_ratio(spark):
    df = make(spark, [("p", 0, 0.5, 1.0), ("p", 0, 0.1, 3.0), ("p", 0, None, 9.0), ("p", 1, None, 1.0)], "plane string, ord long, dff double, f0 double")
    got = sorted(rows(signals.population_ratio(df, ["plane", "ord"]), "ord", "ratio", "n_cells"))
    assert got[0][1] == pytest.approx((0.5 + 0.3) / 4, abs=1e-6) and got[1][1:] == (None, 0)


# bins and responses


def test_bin_mean(spark):
    t = [5, 5.04, 5.11, 5.19, None, 5.45]
    data = [("p", r, k, None if x is None else float(x), float(v)) for r, vs in ((1, [1, 3, 5, 7, 9, 11]), (2, [10, 14, 18, 22, 0, 30])) for k, (x, v) in enumerate(zip(t, vs))]
    got = bins.bin_mean(make(spark, data, "plane string, roi long, ord long, t double, dff double"), ["plane"], ["roi"], "dff", 0.1)
    first = sorted(r for r in rows(got, "roi", "bin", "mean") if r[1] < 2)
    assert first == [(1, 0, 2.0), (1, 1, 6.0), (2, 0, 12.0), (2, 1, 20.0)]
    assert {r[1] for r in rows(got, "bin", "mean") if r[0] in (2, 3)} == {None}
    assert sorted({round(r[0], 6) for r in rows(got, "centre")})[:2] == [5.05, 5.15]


def test_last_histogram_bin_is_closed(spark):
    df = make(spark, [(1, x) for x in (-1.0, 0.0, 1.0, 1.1)], "s long, v double")
    assert sorted(rows(bins.histogram(df, K, "v", [-1.0, 0.0, 1.0]), "bin", "n")) == [(0, 1), (1, 2)]


def test_correlation(spark):
    df = make(spark, [("a", 1.0, 3.0), ("a", 2.0, 5.0), ("a", None, 99.0), ("a", 4.0, 9.0), ("b", 1.0, 1.0), ("b", 1.0, 2.0), ("c", 1.0, 2.0)], "g string, a double, b double")
    got = {r.g: r.r for r in response.pairwise_correlation(df, ["g"], "a", "b", 2).collect()}
    assert got["a"] == pytest.approx(1.0) and got["b"] is None and got["c"] is None


def test_repeat_windows(spark):
    df = make(spark, [("one", 10.0, 610.0), ("two", 0.0, 100.0), ("two", 500.0, 600.5), ("odd", 0.0, 1.0), ("odd", 5.0, 9.0)], "g string, start double, stop double")
    got = sorted(rows(bins.repeat_windows(df, ["g"]), "g", "repeat", "start", "duration"))
    assert got[:2] == [("one", 0, 10.0, 300.0), ("one", 1, 310.0, 300.0)] and got[2][3] == pytest.approx(100.25) and len(got) == 4


def test_orientation_tuning(spark):
    onsets, blocks, angles = [100, 250, 400, 700, 850, 1000], [1, 1, 1, 3, 3, 3], [0, 90, 0, 0, 90, 0]
    stim = make(spark, [(k, "p", float(o), float(o + 10), b, a) for k, (o, b, a) in enumerate(zip(onsets, blocks, angles))], "ord_w long, plane string, start double, stop double, block long, direction long")
    trace = make(spark, [("p", 1, float(t), next((2.0 if a == 0 else 1.0 for o, a in zip(onsets, angles) if o <= t < o + 60), 0.0)) for t in range(0, 1200, 5)], "plane string, roi long, t double, dff double")
    found = response.tuning_responses(stim, trace, ["plane"], ["plane", "roi"], 100.0, (10.0, 60.0), (-30.0, 0.0))
    curve = response.tuning_curve(stim, found, trace, ["plane", "roi"], ["block", "direction"])
    assert sorted(rows(curve, "block", "direction", "mean", "n")) == [(1, 0, 2.0, 2), (1, 90, 1.0, 1), (3, 0, 2.0, 2), (3, 90, 1.0, 1)]
    assert {r.preferred for r in response.preferred(curve, ["block", "plane", "roi"], "direction").collect()} == {0}


def test_masks(spark):
    df = make(spark, [(1, 0, 0, 0, 0.5), (1, 2, 0, 0, 0.7), (1, 5, 1, 1, 0.0), (1, 9, 1, 1, None)], "roi long, z long, row long, col long, w double")
    pixels, depth = response.mask_projection(df, ["roi"], "row", "col", "z", "w")
    assert rows(pixels, "row", "col", "weight") == [(0, 0, 0.7)] and rows(depth, "z_min", "z_max") == [(0, 2)]


# lines and files


def test_rebase(spark):
    data = [(1, tr, 4 * tr + k, x) for tr, xs in enumerate([[1, 30, 60, 100], [101, 130, 160, 200], [1, 30, 60, 100]]) for k, x in enumerate(xs)]
    out, shifted = lines.rebase_counters(make(spark, data, "s long, trial long, ord long, line long"), K, "trial")
    assert [r[1] for r in sorted(rows(out, "ord", "line"))] == [1, 30, 60, 100] * 3 and rows(shifted, "trial", "shift") == [(1, 100)]


def test_line_knots(spark):
    starts = make(spark, [(1, 0, k, t) for k, t in enumerate([1.0, 2.2, 3.1])], "s long, trial long, ord long, t double")
    x = make(spark, [(1, 0, k, n) for k, n in enumerate([1, 150, 300])], "s long, trial long, ord long, line long")
    knots = lines.line_time_map(x, lines.cycle_bounds(starts, ["s", "trial"]), ["s", "trial"])
    got = sorted(rows(knots, "k", "line", "t"))
    assert [g[1] for g in got] == [1, 101, 201, 301] and [g[2] for g in got] == pytest.approx([1, 2.2, 3.1, 4.15])


def test_chunks_and_names(spark):
    df = make(spark, [("acquisition_20260917_153810_DMD2-TRIAL000003-CYCLE-006000.dat",), ("a_DMD1.dat",), ("junk",)], "name string")
    got = rows(files.parse_names(df), "prefix", "plane", "trial", "offset")
    assert got == [("acquisition_20260917_153810", 2, 3, 6000), ("a", 1, 1, None), (None, None, 1, None)]
    c = lambda offsets: lines.chunk_continuity(make(spark, [(1, o, 3000) for o in offsets], "s long, offset long, cycles long"), K).first().verdict
    assert [c([0, 3000, 6000]), c([0, 6000]), c([0, 2000]), c([0, None]), c([3000]), c([0, 0])] == ["ok", "gap", "overlap", "mixed", "not from 0", "duplicate"]


def test_inventory_reads_no_content(spark, tmp_path):
    (tmp_path / "x_DMD1-TRIAL000002.dat").write_bytes(b"12345")
    (tmp_path / "other.txt").write_bytes(b"1")
    got = files.parse_names(files.file_inventory(spark, str(tmp_path)))
    assert rows(got, "name", "size", "trial") == [("x_DMD1-TRIAL000002.dat", 5, 2)]


# logs


def log(spark, lines_):
    return stimlog.parse_log(make(spark, [(1, k, f, v) for k, (f, v) in enumerate(lines_)], "s long, ord long, frame long, value string"))


def test_log_transitions(spark):
    rows_ = [(9, "Start"), (10, "Photodiode-0"), (12, "Photodiode-1"), (13, "Photodiode-0"), (14, "Photodiode-1"), (20, "EndFrame")]
    assert [r[1:] for r in sorted(rows(stimlog.log_transitions(log(spark, rows_), K), "ord", "frame", "state"))] == [(12, True), (13, False), (14, True)]
    ended = stimlog.log_transitions(log(spark, rows_), K, terminal_low=True)
    assert sorted(rows(ended, "frame", "state"))[-1] == (21, False)


def test_shared_frames(spark):
    df = make(spark, [(1, k, f) for k, f in enumerate([1, 2, 2, 3])], "s long, ord long, frame long")
    assert [r[1] for r in sorted(rows(stimlog.shared_frame_flags(df, K), "ord", "shared"))] == [0, 1, 1, 0]


def test_gratings(spark):
    angles = (315, 359, 225, 90, 135, 270, 0, 45, 180)
    text = [x for k, a in enumerate(angles) for x in ((10 * k, f"GratingStart-{a}"), (10 * k + 5, f"GratingEnd-{a}"))]
    got = stimlog.grating_blocks(log(spark, [*text, (100, "GratingStart-315"), (110, "Frame")]), K)
    assert got.filter("matched").count() == 9 and rows(got.filter("block = 1"), "stop_frame", "matched") == [(110, False)]
    assert sorted(rows(stimlog.grating_set_report(got, K), "block", "full")) == [(0, True), (1, False)]


def test_ragged(spark):
    df = make(spark, [(1, 2, "b"), (1, 1, "a"), (2, 5, "c")], "s long, k long, v string")
    back = stimlog.explode_ragged(stimlog.pack_ragged(df, K, "k", ["v"], "x"), K, "x")
    assert sorted(rows(back, "s", "pos", "k", "v")) == [(1, 0, 1, "a"), (1, 1, 2, "b"), (2, 0, 5, "c")]


def test_clip(spark):
    df = make(spark, [(1, 0.0, 10.0), (1, 5.0, 30.0), (1, 25.0, 26.0), (2, 99.0, 100.0)], "s long, start double, stop double")
    got = sorted(rows(stimlog.clip_interrupted(df, make(spark, [(1, 22.0)], "s long, last_anchor double"), K, 2.0), "s", "start", "stop", "partial"))
    assert got == [(1, 0.0, 10.0, False), (1, 5.0, 22.0, True), (2, 99.0, 100.0, False)]


# tables and reports


def test_stimulus_tables(spark, tmp_path):
    plain, headed = tmp_path / "a.csv", tmp_path / "b.csv"
    plain.write_text("".join(",".join(str(k + c) for c in range(10)) + "\n" for k in range(3)))
    headed.write_text("Start,diameter,old\n1,5,x\n2,6,y\n")
    a = tables.read_stimulus_table(spark, str(plain))
    assert a.columns == [*tables.DEFAULT_NAMES, "row_idx"] and sorted(rows(a, "row_idx", "Id")) == [(0, 0), (1, 1), (2, 2)]
    b = tables.read_stimulus_table(spark, str(headed), {"old": "New"})
    assert sorted(rows(b, "New", "DiameterX", "DiameterY")) == [("x", 5, 5), ("y", 6, 6)]
    with pytest.raises(ValueError):
        tables.rename_stimulus_columns(b.withColumn("old", F.lit(1)), {"old": "New"})


def test_logs_and_writers(spark, tmp_path):
    source = tmp_path / "log.csv"
    source.write_text("Frame,Timestamp,Value\n1,0.5,END\n2,0.6,\n")
    got = tables.read_event_log(spark, str(source))
    assert sorted(rows(got, "event_ord", "frame", "value")) == [(0, 1, "END"), (1, 2, "")]
    out = make(spark, [("a", "m", 1.0, 2.0), ("b", "m", 3.0, None)], "session_id string, table_name string, start_time double, stop_time double")
    tables.write_intervals(out, str(tmp_path / "i"))
    assert spark.read.parquet(str(tmp_path / "i")).count() == 2
    tables.write_series(make(spark, [("a", 1.0, 2.0), ("a", None, 3.0)], "session_id string, t double, v double"), str(tmp_path / "s"), {"v": "m/s"})
    assert rows(spark.read.parquet(str(tmp_path / "s")), "t", "v") == [(1.0, 2.0)]
    tables.write_summary(out, str(tmp_path / "c"))
    tables.write_provenance(report.provenance(out, ["session_id"]), str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2


def test_series_of_many_sessions(spark, tmp_path):
    given = [(f"{k:04}", float(t), 1.0 * k + t) for k in range(400) for t in (2, 0, 1)]
    tables.write_series(make(spark, given, "session_id string, t double, v double"), str(tmp_path / "s"))
    assert len([x for x in (tmp_path / "s").iterdir() if x.is_dir()]) <= tables.SERIES_GROUPS
    got = spark.read.parquet(str(tmp_path / "s"))
    assert sorted(rows(got, "session_id", "t", "v")) == sorted(given)
    assert got.filter(got.series_group != tables.series_group(got.session_id)).isEmpty()
    for file in (tmp_path / "s").rglob("*.parquet"):
        at = rows(spark.read.parquet(str(file)), "session_id", "t")
        assert at == sorted(at)


def test_fits_and_soma(spark):
    cr, eye = make(spark, [(0, 1.0), (1, 2.0)], "frame long, w double"), make(spark, [(0, 3.0)], "frame long, w double")
    wide, missing = tables.read_ellipse_fits({"cr": cr, "eye": eye}, ["frame"])
    assert rows(wide, "frame", "cr_w", "eye_w") == [(0, 1.0, 3.0)] and rows(missing, "frame") == [(1,)]
    labels = make(spark, [(1, " Soma "), (2, "dendrite")], "roi long, label string")
    assert rows(tables.soma_traces(make(spark, [(1, 0.1), (2, 0.2)], "roi long, v double"), labels, ["roi"]), "roi") == [(1,)]
    kinds = make(spark, [("p", "f0"), ("p", "df"), ("q", "f0"), ("q", "df"), ("q", "df")], "plane string, kind string")
    assert sorted(rows(tables.trace_shapes(kinds, ["plane"]), "plane", "same_shape")) == [("p", True), ("q", False)]


def test_streamed_bins_equal_batch(spark, tmp_path):
    from streamalign.streaming.bins import stream_bin_mean

    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    df.write.parquet(str(tmp_path / "in"))
    live = stream_bin_mean(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), ["event_type"], "value", "1 day", "60 days")
    q = live.writeStream.format("memory").queryName("live_bins").outputMode("complete").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    batch = df.groupBy("event_type", F.window("ts", "1 day")).agg(F.avg("value").alias("mean"), F.count("value").alias("n"))
    assert sorted(rows(spark.table("live_bins"), "event_type", "n")) == sorted(rows(batch, "event_type", "n"))
