"""Line counters, cycles, trials and raw files."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from .ordered import join_on, with_carries, with_next, with_ordinal, with_previous
from .quantiles import percentile


def expected_cycles(samples: DataFrame, trial: list[str], lines_per_cycle: float, line: str = "line") -> DataFrame:
    """Per trial, ceil(largest line / lines per cycle), 0 if none has a line."""
    return samples.groupBy(*trial).agg(F.coalesce(F.ceil(F.max(line) / lines_per_cycle), F.lit(0)).alias("expected"))


def effective_lines(samples: DataFrame, cycles: DataFrame, trial: list[str], line: str = "line") -> DataFrame:
    """Per trial, largest line over detected cycles (n_cycles), NULL without cycles."""
    largest = samples.groupBy(*trial).agg(F.max(line).alias("max_line"), F.min(line).alias("min_line"))
    return join_on(largest, cycles, trial, "left").withColumn("n_cycles", F.coalesce("n_cycles", F.lit(0))).withColumn("lines_per_cycle", F.try_divide("max_line", "n_cycles"))


def cycle_bounds(starts: DataFrame, trial: list[str], at: str = "t", order: str = "ord") -> DataFrame:
    """Cycles numbered from 1 with start and end; the last ends a mean period after its start (at once if it is alone)."""
    # the number, and the next start, in one step
    ranked = with_carries(starts.select(*trial, order, at), trial, order, following=[at], sums={"__n": F.lit(1)}).withColumn("__n", F.col("__n").cast("long"))
    per = ranked.groupBy(*trial).agg(F.count("*").alias("n_cycles"), F.min(at).alias("__a"), F.max(at).alias("__z"))
    period = F.coalesce(F.try_divide(F.col("__z") - F.col("__a"), F.col("n_cycles") - 1), F.lit(0.0))
    ahead = join_on(ranked, per, trial)
    return ahead.select(*trial, F.col("__n").alias("cycle"), F.col(at).alias("start"), F.coalesce(f"next_{at}", F.col(at) + period).alias("end"), "n_cycles")


def primary_timestamps(samples: DataFrame, bounds: DataFrame, trial: list[str], line: str = "line", order: str = "ord") -> DataFrame:
    """samples with `mapped_t` spread over the cycles of their trial (cycle_bounds).

    A sample's cycle is ceil(line / (largest line / cycles)). The k-th of m samples of a cycle gets
    start + (k - 1)(end - start) / m, in the last cycle over m - 1. If rounding gives other than n cycles, the
    trial's samples lie evenly from its first start to its last end. Trials without cycles have no times.
    """
    per = bounds.groupBy(*trial).agg(F.max("n_cycles").alias("__n"), F.min("start").alias("__from"), F.max("end").alias("__to"))
    largest = samples.groupBy(*trial).agg(F.max(line).alias("__max"), F.count("*").alias("__total"))
    step = F.col("__max").cast("double") / F.col("__n")
    known = join_on(join_on(samples, largest, trial), per, trial, "left").withColumn("cycle", F.ceil(F.col(line) / step)).withColumn("__even", F.ceil(F.col("__max") / step) != F.col("__n"))
    inside = Window.partitionBy(*trial, "cycle")
    ranked = known.withColumns({"__k": F.row_number().over(inside.orderBy(order)) - 1, "__m": F.count("*").over(inside)})
    ranked = with_ordinal(ranked, trial, order, "__rank")
    timed = join_on(ranked, bounds.select(*trial, "cycle", "start", "end"), [*trial, "cycle"], "left")
    parts = F.when(F.col("cycle") == F.col("__n"), F.greatest(F.col("__m") - 1, F.lit(1))).otherwise(F.col("__m"))
    by_cycle = F.col("start") + F.col("__k") * (F.col("end") - F.col("start")) / parts
    even = F.col("__from") + F.col("__rank") * (F.col("__to") - F.col("__from")) / F.greatest(F.col("__total") - 1, F.lit(1))
    return timed.withColumn("mapped_t", F.when(F.col("__even"), even).otherwise(by_cycle)).select(*samples.columns, "mapped_t")


def line_time_map(samples: DataFrame, bounds: DataFrame, trial: list[str], line: str = "line") -> DataFrame:
    """Knots of each trial: line 1 + k x (largest line / cycles) at the cycle starts and at the last end."""
    per = effective_lines(samples, bounds.groupBy(*trial).agg(F.max("n_cycles").alias("n_cycles")), trial, line).filter("n_cycles > 0")
    knots = bounds.select(*trial, (F.col("cycle") - 1).alias("k"), F.col("start").alias("t")).unionByName(bounds.filter("cycle = n_cycles").select(*trial, F.col("cycle").alias("k"), F.col("end").alias("t")))
    return join_on(knots, per, trial).select(*trial, F.col("k").cast("long").alias("k"), (1 + F.col("k") * F.col("lines_per_cycle")).alias("line"), "t")


def cycles_per_trial(files: DataFrame, spine: DataFrame, keys: list[str]) -> DataFrame:
    """Per trial of the spine, the sum of its files' cycles, 0 without files; files of other trials don't count."""
    sums = files.groupBy(*keys, "trial").agg(F.sum("cycles").alias("n_cycles"))
    return join_on(spine, sums, [*keys, "trial"], "left").withColumn("n_cycles", F.coalesce("n_cycles", F.lit(0)))


def path_dimensions(files: DataFrame, keys: list[str]) -> DataFrame:
    """Per key: files, cycles and lines in total, and whether lines per cycle agree and only the last chunk is empty."""
    last = files.groupBy(*keys).agg(F.max("offset").alias("__last"))
    return join_on(files, last, keys).groupBy(*keys).agg(
        F.count("*").alias("n_files"),
        F.sum("cycles").alias("n_cycles"),
        F.sum(F.col("cycles") * F.col("lines_per_cycle")).alias("n_lines"),
        (F.count_distinct("lines_per_cycle") == 1).alias("one_size"),
        (F.count_if((F.col("cycles") == 0) & (F.col("offset") < F.col("__last"))) == 0).alias("only_last_empty"),
    )


def rate_per_trial(samples: DataFrame, trial: list[str], at: str = "t") -> DataFrame:
    """(n - 1) / (last - first) per trial, NULL for fewer than two samples or no duration."""
    return samples.groupBy(*trial).agg(F.when(F.count(at) > 1, F.try_divide(F.count(at) - 1, F.max(at) - F.min(at))).alias("rate"))


def rebase_counters(samples: DataFrame, plane: list[str], trial: str, line: str = "line", order: str = "ord", factor: float = 1.5) -> tuple[DataFrame, DataFrame]:
    """samples whose trials that go on counting from the one before start at 1 again, and the trials shifted.

    A trial is shifted if it doesn't start at 1, its first line lies above the raw last line of the non-empty trial
    before by up to factor x the plane's 99 % step, and its lines never fall.
    """
    seen = with_previous(samples.filter(F.col(line).isNotNull()), [*plane, trial], order, [line])
    step = F.col(line) - F.col(f"prev_{line}")
    p99 = percentile(seen, plane, F.when(step > 0, step), 0.99, "__p99")
    per = seen.groupBy(*plane, trial).agg(F.min_by(line, order).alias("first"), F.max_by(line, order).alias("last"), F.count_if(step < 0).alias("falls"))
    before = join_on(with_previous(per, plane, trial, ["last"]), p99, plane)
    jump = F.col("first") - F.col("prev_last")
    shift = before.filter((F.col("first") != 1) & (jump > 0) & (jump <= factor * F.col("__p99")) & (F.col("falls") == 0)).select(*plane, trial, (F.col("first") - 1).alias("shift"))
    return join_on(samples, shift, [*plane, trial], "left").withColumn(line, F.col(line) - F.coalesce("shift", F.lit(0))).drop("shift"), shift


def infer_continuous(pulses: DataFrame, chunks: DataFrame, samples: DataFrame, keys: list[str], factor: float = 1.5) -> DataFrame:
    """Per session, whether it is one continuous recording.

    One start and at most one end (pulses: n_starts, n_ends); only trial 1 in one prefix, all chunked (chunks: prefix,
    trial, offset); and each plane has over one trial chunk, two or more with lines, that go on counting with gaps of
    up to factor x the plane's 99 % step.
    """
    files = chunks.groupBy(*keys).agg((F.count_distinct("prefix") == 1).alias("a"), (F.count_if((F.col("trial") != 1) | F.col("offset").isNull()) == 0).alias("b"))
    seen = with_previous(samples, [*keys, "plane", "trial"], "ord", ["line"])
    step = F.col("line") - F.col("prev_line")
    p99 = percentile(seen, [*keys, "plane"], F.when(step > 0, step), 0.99, "p99")
    per = seen.groupBy(*keys, "plane", "trial").agg(F.min_by("line", "ord").alias("first"), F.max_by("line", "ord").alias("last"))
    gaps = join_on(with_previous(per, [*keys, "plane"], "trial", ["last"]), p99, [*keys, "plane"]).withColumn("gap", F.col("first") - F.col("prev_last"))
    planes = gaps.groupBy(*keys, "plane").agg((F.count("*") > 1).alias("c"), (F.count_if(F.col("has_prev") & ~((F.col("gap") > 0) & (F.col("gap") <= factor * F.col("p99")))) == 0).alias("d"))
    both = planes.groupBy(*keys).agg(F.min("c").alias("c"), F.min("d").alias("d"))
    one = pulses.select(*keys, ((F.col("n_starts") == 1) & (F.col("n_ends") <= 1)).alias("p"))
    out = join_on(join_on(one, files, keys, "left"), both, keys, "left")
    return out.select(*keys, F.coalesce(F.col("p") & F.col("a") & F.col("b") & F.col("c") & F.col("d"), F.lit(False)).alias("continuous"))


def chunk_continuity(files: DataFrame, keys: list[str]) -> DataFrame:
    """Per key, what is wrong with its chunks: mixed, duplicate offset, not from 0, gap, overlap, else ok."""
    ordered = with_next(files.filter(F.col("offset").isNotNull()).groupBy(*keys, "offset").agg(F.max("cycles").alias("cycles"), F.count("*").alias("copies")), keys, "offset", ["offset"])
    found = ordered.groupBy(*keys).agg(F.max("copies").alias("copies"), F.min("offset").alias("first"), F.count_if(F.col("next_offset") > F.col("offset") + F.col("cycles")).alias("gaps"), F.count_if(F.col("next_offset") < F.col("offset") + F.col("cycles")).alias("overlaps"))
    mixed = files.groupBy(*keys).agg(F.count("offset").alias("chunked"), F.count("*").alias("n"))
    both = join_on(mixed, found, keys, "left")
    verdict = (
        F.when((F.col("chunked") > 0) & (F.col("chunked") < F.col("n")), "mixed").when(F.col("copies") > 1, "duplicate").when(F.col("first") > 0, "not from 0")
        .when(F.col("gaps") > 0, "gap").when(F.col("overlaps") > 0, "overlap").otherwise("ok")
    )
    return both.select(*keys, verdict.alias("verdict"))


def resolve_acquisition(files: DataFrame, keys: list[str]) -> DataFrame:
    """Per session: the prefix with the latest time stamp, how many trials precede it, and whether that is acceptable.

    At most two prefixes; the earlier one's largest trial number counts as its trials, which must be fewer than those
    retained.
    """
    per = files.groupBy(*keys, "prefix").agg(F.max("stamp").alias("stamp"), F.max("trial").alias("n_trials"))
    ranked = per.withColumn("__r", F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("stamp").desc(), F.col("prefix").desc())))
    out = ranked.groupBy(*keys).agg(F.count("*").alias("n_prefixes"), F.max(F.when(F.col("__r") == 1, F.col("prefix"))).alias("retained"), F.max(F.when(F.col("__r") == 1, F.col("n_trials"))).alias("n_retained"), F.coalesce(F.max(F.when(F.col("__r") > 1, F.col("n_trials"))), F.lit(0)).alias("n_excluded"))
    return out.withColumn("valid", (F.col("n_prefixes") <= 2) & (F.col("n_excluded") < F.col("n_retained")))


def exclude_trials(samples: DataFrame, keys: list[str], head: int, tail: int, trial: str = "trial") -> DataFrame:
    """samples without each key's first `head` and last `tail` trials, the rest numbered from 0."""
    last = samples.groupBy(*keys).agg(F.max(trial).alias("__last"))
    kept = join_on(samples, last, keys).filter((F.col(trial) >= head) & (F.col(trial) <= F.col("__last") - tail))
    return kept.withColumn(trial, F.col(trial) - head).drop("__last")


def linspace_trials(samples: DataFrame, bounds: DataFrame, trial: list[str], order: str = "ord") -> DataFrame:
    """samples with mapped_t, evenly from their trial's start to its end, both included."""
    ranked = with_ordinal(samples, trial, order, "__n")
    total = samples.groupBy(*trial).agg(F.count("*").alias("__m"))
    both = join_on(join_on(ranked, total, trial), bounds, trial)
    share = F.col("__n") / F.greatest(F.col("__m") - 1, F.lit(1))
    return both.withColumn("mapped_t", F.col("start") + share * (F.col("stop") - F.col("start"))).drop("__n", "__m", "start", "stop")


def compare_cycle_counts(pulses: DataFrame, lines: DataFrame, files: DataFrame, keys: list[str]) -> DataFrame:
    """Three counts of cycles per session (n_pulses, n_lines, n_files), side by side, and whether they agree."""
    out = join_on(join_on(pulses, lines, keys), files, keys)
    return out.withColumn("agree", (F.col("n_pulses") == F.col("n_lines")) & (F.col("n_lines") == F.col("n_files")))


def curve_shape(knots: DataFrame, trial: list[str], line: str = "line", at: str = "t") -> DataFrame:
    """Knots rescaled to 0..1 in line and time; trials without extent in either are left out."""
    span = knots.groupBy(*trial).agg(F.min(line).alias("__l0"), (F.max(line) - F.min(line)).alias("__dl"), F.min(at).alias("__t0"), (F.max(at) - F.min(at)).alias("__dt"))
    both = join_on(knots, span.filter("__dl > 0 and __dt > 0"), trial)
    return both.select(*trial, line, ((F.col(line) - F.col("__l0")) / F.col("__dl")).alias("line_share"), ((F.col(at) - F.col("__t0")) / F.col("__dt")).alias("t_share"))
