"""Interpolation between knots and anchors, and pairing by order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .ordered import as_of, between, bracket, first_rows, join_on, paired, with_next, with_previous
from .quantiles import median


def assign_trial(events: DataFrame, starts: DataFrame, ends: DataFrame, keys: list[str], at: str = "t", order: str = "ord", width: float | None = None) -> DataFrame:
    """events with `trial`: the last trial that starts at or before; -1 after its end, NULL before the first start.

    The n-th start and the n-th end belong together; an end's own time is still inside, a trial without one is open.
    """
    both = paired(starts.select(*keys, order, at), ends.select(*keys, order, at), keys, order).filter("l is not null")
    trials = both.select(*keys, F.col("pair").alias("trial"), F.col("l")[at].alias(at), F.col("r")[at].alias("__end"))
    placed = as_of(events, trials, keys, at, "trial", width).withColumn("trial", F.col("as_of").cast("long"))
    found = join_on(placed, trials.select(*keys, "trial", "__end"), [*keys, "trial"], "left")
    return found.withColumn("trial", F.when(F.col(at) > F.col("__end"), F.lit(-1)).otherwise(F.col("trial"))).drop("as_of", "__end")


def pair_by_order(left: DataFrame, right: DataFrame, keys: list[str], order: str = "ord") -> DataFrame:
    """The n-th rows of both, side by side (columns l_*, r_*), with `pair`; rows without a partner have NULLs."""
    names = lambda df, side: [F.col(side)[c].alias(f"{side}_{c}") for c in df.columns if c not in keys]
    return paired(left, right, keys, order).select(*keys, "pair", *names(left, "l"), *names(right, "r"))


def pairing_report(pairs: DataFrame, keys: list[str], at: str = "t", state: str = "state") -> DataFrame:
    """Per key of pair_by_order: counts, and the first pair whose states differ or whose coordinates don't increase."""
    seen = with_previous(pairs, keys, "pair", [f"l_{at}", f"r_{at}", f"l_{state}"])
    bad = (F.col(f"l_{state}") != F.col(f"r_{state}")) | (F.col("has_prev") & ((F.col(f"l_{at}") <= F.col(f"prev_l_{at}")) | (F.col(f"r_{at}") <= F.col(f"prev_r_{at}")) | (F.col(f"l_{state}") == F.col(f"prev_l_{state}"))))
    n = lambda c: F.count(F.col(c))
    out = seen.groupBy(*keys).agg(n(f"l_{at}").alias("n_left"), n(f"r_{at}").alias("n_right"), F.min(F.when(bad, F.col("pair"))).alias("first_bad"))
    return out.withColumn("matched", (F.col("n_left") == F.col("n_right")) & F.col("first_bad").isNull())


def drop_terminal_blip(left: DataFrame, right: DataFrame, keys: list[str], order: str = "ord", frame: str = "frame", state: str = "state") -> DataFrame:
    """left without its last two edges where it has exactly two more than right and they are high, then low one frame on."""
    last = first_rows(left, keys, order, [frame, state], 2, last=True)
    counts = join_on(left.groupBy(*keys).agg(F.count("*").alias("nl")), right.groupBy(*keys).agg(F.count("*").alias("nr")), keys, "left")
    both = join_on(last, counts, keys)
    a, b = F.get("rows", F.size("rows") - 1), F.get("rows", F.size("rows") - 2)  # the last edge and the one before
    blip = (F.col("nl") == F.coalesce("nr", F.lit(0)) + 2) & ~a[state] & b[state] & (a[frame] - b[frame] == 1)
    cut = both.select(*keys, F.when(F.coalesce(blip, F.lit(False)), b[order]).alias("__from"))
    return join_on(left, cut, keys).filter(F.col("__from").isNull() | (F.col(order) < F.col("__from"))).drop("__from")


def uniform_knots(samples: DataFrame, knots: DataFrame, keys: list[str], lines_per_cycle: float, line: str = "line", limit: str | None = None) -> DataFrame:
    """samples with mapped_t: linear between knots at line 1 + k x lines_per_cycle, by an equi-join on k.

    Beyond the knots, and above the session's line limit, there is no time. A measured last knot is inside, an
    estimated one is not.
    """
    ahead = with_next(knots.select(*keys, "k", "t", "estimated"), keys, "k", ["t", "estimated"])
    at = F.col(line) - 1
    placed = samples.withColumn("k", F.floor(at / F.lit(lines_per_cycle)).cast("long"))
    joined = join_on(placed, ahead, [*keys, "k"], "left") if "t" not in samples.columns else join_on(placed, ahead.withColumnRenamed("t", "__t"), [*keys, "k"], "left")
    t = F.col("__t") if "t" in samples.columns else F.col("t")
    share = at / F.lit(lines_per_cycle) - F.col("k")
    on_knot = F.when((share == 0) & ~F.col("estimated"), t)
    mapped = F.coalesce(t + share * (F.col("next_t") - t), on_knot)
    if limit:
        mapped = F.when(F.col(line) <= F.col(limit), mapped)
    return joined.withColumn("mapped_t", mapped).drop("k", "__t", "estimated", "next_t", "next_estimated", "has_next")


def trial_knots(samples: DataFrame, knots: DataFrame, keys: list[str], line: str = "line") -> DataFrame:
    """samples with mapped_t by their trial's knots 1 + k x spacing (spacing may be fractional), held at both ends.

    knots has keys, k, knot_t, spacing. A trial without knots has no times.
    """
    ahead = with_next(knots.select(*keys, "k", "knot_t", "spacing"), keys, "k", ["knot_t"])
    last = knots.groupBy(*keys).agg(F.max("k").alias("__last"), F.max("spacing").alias("__step"))
    placed = join_on(samples, last, keys, "left")
    at = F.greatest(F.lit(0.0), F.least((F.col(line) - 1) / F.col("__step"), F.col("__last").cast("double")))
    placed = placed.withColumn("__at", at).withColumn("k", F.least(F.floor("__at"), F.col("__last")).cast("long"))
    joined = join_on(placed, ahead, [*keys, "k"], "left")
    mapped = F.coalesce(F.col("knot_t") + (F.col("__at") - F.col("k")) * (F.col("next_knot_t") - F.col("knot_t")), F.col("knot_t"))
    return joined.withColumn("mapped_t", mapped).drop("k", "__at", "__last", "__step", "knot_t", "spacing", "next_knot_t", "has_next")


def interpolate(queries: DataFrame, anchors: DataFrame, keys: list[str], at: str, value: str, width: float | None = None) -> DataFrame:
    """queries with `value_at`, linear between the anchors around; NULL outside them."""
    return bracket(queries, anchors, keys, at, value, width).withColumn("value_at", between(F.col(at))).drop("lo", "hi")


def end_lines(anchors: DataFrame, keys: list[str], at: str, value: str, n: int = 20) -> DataFrame:
    """Per key, the end points and the slopes of least-squares lines through the first and the last n anchors."""
    ends = join_on(*[first_rows(anchors.filter(F.col(at).isNotNull()), keys, at, [value], n, last).withColumnRenamed("rows", name) for last, name in ((False, "a"), (True, "z"))], keys)
    point = lambda r: F.struct(r[at].cast("double").alias("x"), r[value].alias("y"))
    return ends.select(*keys, point(F.get("a", F.lit(0))).alias("first"), point(F.get("z", F.size("z") - 1)).alias("last"), _slope("a", at, value).alias("first_slope"), _slope("z", at, value).alias("last_slope"))


def _slope(rows: str, x: str, y: str) -> Column:
    """The slope of the least-squares line through the rows of an array that have a value; NULL if it has none."""
    both = F.filter(rows, lambda r: r[y].isNotNull())
    total = lambda of: F.aggregate(both, F.lit(0.0), lambda a, r: a + of(r))
    n = F.size(both)
    mean_x, mean_y = F.try_divide(total(lambda r: r[x].cast("double")), n), F.try_divide(total(lambda r: r[y].cast("double")), n)
    dx = lambda r: r[x].cast("double") - mean_x
    return F.try_divide(total(lambda r: dx(r) * (r[y].cast("double") - mean_y)), F.nullif(total(lambda r: dx(r) * dx(r)), F.lit(0.0)))


def map_boundaries(queries: DataFrame, anchors: DataFrame, keys: list[str], at: str, value: str, most: float = 20.0, n: int = 20, width: float | None = None) -> DataFrame:
    """queries with value_at, and outside the anchors the end point plus the end's slope, up to `most` away.

    extrapolated and beyond (the distance) tell which; further away, or with a slope that isn't positive, it is NULL.
    """
    inside = join_on(interpolate(queries, anchors, keys, at, value, width), end_lines(anchors, keys, at, value, n), keys, "left")
    x = F.col(at)
    beyond = F.greatest(F.col("first")["x"] - x, x - F.col("last")["x"], F.lit(0.0))
    front = F.when(F.col("first_slope") > 0, F.col("first")["y"] + F.col("first_slope") * (x - F.col("first")["x"]))
    back = F.when(F.col("last_slope") > 0, F.col("last")["y"] + F.col("last_slope") * (x - F.col("last")["x"]))
    outside = F.when(F.col("beyond") <= most, F.when(x < F.col("first")["x"], front).otherwise(back))
    out = inside.withColumn("beyond", beyond).withColumn("extrapolated", F.col("beyond") > 0)
    return out.withColumn("value_at", F.when(F.col("extrapolated"), outside).otherwise(F.col("value_at"))).drop("first", "last", "first_slope", "last_slope")


def map_with_status(queries: DataFrame, anchors: DataFrame, keys: list[str], at: str, value: str, max_gap: float, end_limit: float = 20.0, n: int = 20, width: float | None = None) -> DataFrame:
    """queries with value_at and status: 0 on an anchor, 1 inside a gap of up to max_gap, 2 beyond an end by up to
    end_limit, else 3 and no value.
    """
    found = bracket(queries, anchors, keys, at, value, width)
    marked = found.withColumns({"__exact": F.col("lo")["x"] == F.col(at), "__gap": F.col("hi")["x"] - F.col("lo")["x"]}).drop("lo", "hi")
    names = [c for c in queries.columns if c not in keys]
    mapped = map_boundaries(marked.select(*keys, *names, "__exact", "__gap"), anchors, keys, at, value, end_limit, n, width)
    status = F.when(F.col("__exact"), 0).when(F.col("__gap") <= max_gap, 1).when(F.col("extrapolated") & F.col("value_at").isNotNull(), 2).otherwise(3)
    out = mapped.withColumn("status", status)
    return out.withColumn("value_at", F.when(F.col("status") < 3, F.col("value_at"))).drop("__exact", "__gap", "extrapolated", "beyond")


def interpolate_supported(queries: DataFrame, series: DataFrame, keys: list[str], at: str, value: str, max_gap: float | str, width: float | None = None, tie: str | None = None) -> DataFrame:
    """queries with value_at: an exact sample's value, or between two samples that both have values, at most max_gap apart.

    max_gap is a number, or the name of a column of queries that has it. Of samples at one time the one with the largest
    `tie` counts, a number; without it times are distinct.

    A sample without a value is a neighbour all the same and is never bridged; nothing lies beyond the ends.
    """
    found = bracket(queries, series, keys, at, value, width, tie)
    lo, hi = F.col("lo"), F.col("hi")
    fine = lo["y"].isNotNull() & hi["y"].isNotNull() & (hi["x"] - lo["x"] <= (F.col(max_gap) if isinstance(max_gap, str) else F.lit(max_gap)))
    return found.withColumn("value_at", F.when(lo["x"] == F.col(at), lo["y"]).when(fine, between(F.col(at)))).drop("lo", "hi")


def default_gap(anchors: DataFrame, keys: list[str], at: str) -> DataFrame:
    """Per key, 3 times the median step between neighbouring anchors."""
    seen = with_previous(anchors.select(*keys, at), keys, at, [at])
    return median(seen, keys, F.col(at) - F.col(f"prev_{at}"), "max_gap").withColumn("max_gap", 3 * F.col("max_gap"))


def align_trace(grid: DataFrame, series: DataFrame, keys: list[str], at: str, value: str, hz: float, width: float | None = None, tie: str | None = None) -> DataFrame:
    """grid with value_at, resampled from the series of its keys without crossing missing values or long gaps.

    A gap is too long over 3 times the larger of the expected period, 1/hz, and the median step between the key's
    samples.
    """
    steps = default_gap(series, keys, at).withColumn("__gap", F.greatest(F.lit(3.0 / hz), F.coalesce("max_gap", F.lit(0.0)))).drop("max_gap")
    asked = join_on(grid, steps, keys, "left").withColumn("__gap", F.coalesce("__gap", F.lit(3.0 / hz)))
    return interpolate_supported(asked, series, keys, at, value, "__gap", width, tie).drop("__gap")


def zip_truncate(left: DataFrame, right: DataFrame, keys: list[str], order: str = "ord", most: int = 3) -> tuple[DataFrame, DataFrame]:
    """Rows side by side by position, as long as both last, and per key the counts and whether they differ by `most` at most."""
    pairs = pair_by_order(left, right, keys, order)
    report = pairs.groupBy(*keys).agg(F.count(f"l_{order}").alias("n_left"), F.count(f"r_{order}").alias("n_right"))
    return pairs.filter(F.col(f"l_{order}").isNotNull() & F.col(f"r_{order}").isNotNull()), report.withColumn("close", F.abs(F.col("n_left") - F.col("n_right")) <= most)


def join_frames(fits: DataFrame, times: DataFrame, keys: list[str], most: int = 3) -> tuple[DataFrame, DataFrame]:
    """Fits with times by frame, and a report: rows only on one side, and whether that is acceptable."""
    both = fits.join(times, keys, "inner")
    only_fit = fits.join(times, keys, "left_anti").agg(F.count("*").alias("fit_only"))
    only_time = times.join(fits, keys, "left_anti").agg(F.count("*").alias("time_only"))
    report = only_fit.crossJoin(only_time)  # one row each
    return both, report.withColumn("valid", (F.abs(F.col("fit_only") - F.col("time_only")) <= most) & (F.least("fit_only", "time_only") == 0))


def nearest_session(left: DataFrame, right: DataFrame, keys: list[str], at: str, ident: str) -> DataFrame:
    """For each row of left, the row of right with its keys whose time is nearest, the smaller id in a tie.

    The nearest is one of the two neighbours in time, so that each key's rows are ordered, not paired.
    """
    x = right.groupBy(*keys, at).agg(F.min(ident).alias("__id"))
    low = bracket(left, x, keys, at, "__id")
    d_lo, d_hi = F.col(at) - F.col("lo")["x"], F.col("hi")["x"] - F.col(at)
    pick = F.when(F.col("hi").isNull() | (d_lo < d_hi), F.col("lo")["y"]).when(F.col("lo").isNull() | (d_hi < d_lo), F.col("hi")["y"]).otherwise(F.least(F.col("lo")["y"], F.col("hi")["y"]))
    return low.withColumn("nearest", pick.cast("long")).withColumn("distance", F.least(d_lo, d_hi)).drop("lo", "hi")


def nearest_grid(rows: DataFrame, value: str, grid: list[float]) -> DataFrame:
    """rows with the index of the nearest position of a small sorted grid, the first in a tie."""
    distances = [F.struct(F.abs(F.col(value) - F.lit(g)).alias("d"), F.lit(i).alias("i")) for i, g in enumerate(grid)]
    return rows.withColumn("grid_index", F.when(F.col(value).isNotNull(), F.array_min(F.array(*distances))["i"]))
