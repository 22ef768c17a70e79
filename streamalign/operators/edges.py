"""Edges of square waves, gap segmentation, assignment of edges to trials, and the continuous clock."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .ordered import WIDTH, join_on, with_carries, with_next, with_ordinal, with_previous, with_running_sum
from .quantiles import median


def rising_edges(samples: DataFrame, keys: list[str], state: str = "state", at: str = "t", order: str = "ord", width: float = WIDTH) -> DataFrame:
    """keys, order, t, period: 0 to 1 changes at the later sample, and one at the first sample if it is high."""
    seen = with_carries(samples.select(*keys, order, at, state), keys, order, previous=[state], width=width)
    edges = seen.filter(F.col(state) & (~F.col("has_prev") | ~F.col(f"prev_{state}"))).select(*keys, order, at, (~F.col("has_prev")).alias("initial"))
    before = with_previous(edges, keys, order, [at], width)
    return before.select(*keys, order, at, "initial", (F.col(at) - F.col(f"prev_{at}")).alias("period"))


def transitions(samples: DataFrame, keys: list[str], state: str = "state", at: str = "t", order: str = "ord", width: float = WIDTH) -> DataFrame:
    """Every change of state, with the new state."""
    seen = with_previous(samples.select(*keys, order, at, state), keys, order, [state], width)
    return seen.filter(F.col("has_prev") & (F.col(state) != F.col(f"prev_{state}"))).select(*keys, order, at, state)


def onset_flags(edges: DataFrame, onset: DataFrame, keys: list[str], at: str = "t", order: str = "ord", near: float = 1e-3) -> DataFrame:
    """Per key, whether its first edge lies within `near` of the recording's onset, and whether it was high from the start."""
    first = edges.groupBy(*keys).agg(F.min_by(F.struct(at, "initial"), order).alias("e"))
    return join_on(first, onset, keys).select(*keys, (F.col("e")[at] - F.col("recording_start") <= near).alias("at_onset"), F.col("e")["initial"].alias("initially_high"))


def split_by_gaps(edges: DataFrame, keys: list[str], at: str = "t", order: str = "ord", factor: float = 5.0, width: float = WIDTH) -> DataFrame:
    """edges with `group`, from 0: a gap of over `factor` medians of all gaps begins a new one."""
    seen = with_previous(edges, keys, order, [at], width).withColumn("gap", F.col(at) - F.col(f"prev_{at}")).drop(f"prev_{at}", "has_prev")
    limit = median(seen, keys, "gap", "__limit").withColumn("__limit", F.col("__limit") * factor)
    marked = join_on(seen, limit, keys)
    begins = F.when(F.col("gap") > F.col("__limit"), 1).otherwise(0)
    return with_running_sum(marked, keys, order, begins, "group", width).drop("__limit")


def gap_verdict(groups: DataFrame, expected: DataFrame, keys: list[str]) -> DataFrame:
    """Per key, n_groups against n_trials: not_applicable for one trial, ok, or failed."""
    found = groups.groupBy(*keys).agg((F.max("group") + 1).alias("n_groups"))
    verdict = F.when(F.col("n_trials") == 1, "not_applicable").when(F.col("n_groups") == F.col("n_trials"), "ok").otherwise("failed")
    return join_on(found, expected, keys).withColumn("verdict", verdict)


def drop_leading_group(groups: DataFrame, expected: DataFrame, keys: list[str]) -> DataFrame:
    """groups without the first, numbered anew, where there is one group more than n_trials and highest_trial equals n_trials."""
    found = join_on(groups.groupBy(*keys).agg((F.max("group") + 1).alias("__n")), expected, keys, "left")
    drop = found.select(*keys, F.coalesce((F.col("__n") == F.col("n_trials") + 1) & (F.col("highest_trial") == F.col("n_trials")), F.lit(False)).cast("int").alias("__drop"))
    return join_on(groups, drop, keys).filter("group >= __drop").withColumn("group", F.col("group") - F.col("__drop")).drop("__drop")


def drop_before_first_start(edges: DataFrame, starts: DataFrame, keys: list[str], at: str = "t", order: str = "ord") -> DataFrame:
    """Edges from each session's first recorded start on."""
    first = starts.groupBy(*keys).agg(F.min_by(at, order).alias("__from"))
    return join_on(edges, first, keys).filter(F.col(at) >= F.col("__from")).drop("__from")


def assign_by_gap(groups: DataFrame, expected: DataFrame, keys: list[str]) -> DataFrame:
    """Per group, which is the trial of the same number: its edges, the count expected, and whether they agree."""
    found = groups.groupBy(*keys, F.col("group").alias("trial")).agg(F.count("*").alias("n_edges"))
    return join_on(found, expected.select(*keys, "trial", "expected"), [*keys, "trial"], "left").withColumn("agrees", F.col("n_edges") == F.col("expected"))


def assign_by_count(edges: DataFrame, expected: DataFrame, keys: list[str], order: str = "ord", at: str = "t", width: float = WIDTH) -> DataFrame:
    """Per trial, the next `expected` edges in order: first and last time, how many there were, short if under 90 %.

    Trials come in order of `trial`; what is left over is unused, and trials beyond the last edge have no times.
    """
    upto = with_running_sum(expected.select(*keys, "trial", "expected"), keys, "trial", F.col("expected"), "__upto")
    ranked = with_ordinal(edges, keys, order, "__n", width)
    # each edge goes to the first trial whose running count lies beyond its ordinal
    total = with_previous(upto, keys, "trial", ["__upto"]).withColumn("__lo", F.coalesce("prev___upto", F.lit(0)))
    slots = total.filter("__upto > __lo").withColumn("__s", F.explode(F.sequence(F.floor(F.col("__lo") / 1024), F.floor((F.col("__upto") - 1) / 1024))))
    placed = join_on(ranked.withColumn("__s", F.floor(F.col("__n") / 1024)), slots.drop("prev___upto", "has_prev"), [*keys, "__s"]).filter("__n >= __lo and __n < __upto")
    times = placed.groupBy(*keys, "trial").agg(F.min(at).alias("first_t"), F.max(at).alias("last_t"), F.count("*").alias("n_edges"))
    out = join_on(upto.drop("__upto"), times, [*keys, "trial"], "left").withColumn("n_edges", F.coalesce("n_edges", F.lit(0)))
    return out.withColumn("short", F.col("n_edges") < 0.9 * F.col("expected"))


def continuous_clock(edges: DataFrame, keys: list[str], lines_per_cycle: int, cycles: DataFrame, at: str = "t", order: str = "ord", width: float = WIDTH) -> tuple[DataFrame, DataFrame]:
    """Knots (keys, k, line, t, estimated) at line 1 + k x lines_per_cycle, and a report per session.

    cycles has keys and `n_cycles`. With P pulses: P over n_cycles + 1 is invalid; P = n_cycles + 1 measures the end;
    from 2 up, one end is estimated a mean period after the last; a single pulse is a start without an end.
    """
    ranked = with_ordinal(edges.select(*keys, order, at), keys, order, "k", width)
    per = ranked.groupBy(*keys).agg(F.count("*").alias("n_pulses"), F.min_by(at, order).alias("first_t"), F.max_by(at, order).alias("last_t"))
    policy = F.when(F.col("n_pulses") > F.col("n_cycles") + 1, "invalid").when(F.col("n_pulses") == F.col("n_cycles") + 1, "measured_end").when(F.col("n_pulses") >= 2, "estimated_end").otherwise("start_only")
    report = join_on(per, cycles, keys).withColumn("policy", policy).withColumn("mean_period", F.try_divide(F.col("last_t") - F.col("first_t"), F.col("n_pulses") - 1))
    report = report.withColumn("n_unsupported", F.greatest(F.col("n_cycles") - F.col("n_pulses"), F.lit(0)))
    valid = report.filter("policy <> 'invalid'")
    line = lambda k: (1 + F.col(k) * lines_per_cycle).cast("double").alias("line")
    measured = join_on(ranked, valid.select(*keys), keys).select(*keys, "k", line("k"), F.col(at).alias("t"), F.lit(False).alias("estimated"))
    estimated = valid.filter("policy = 'estimated_end'").withColumn("k", F.col("n_pulses").cast("long")).select(*keys, "k", line("k"), (F.col("last_t") + F.col("mean_period")).alias("t"), F.lit(True).alias("estimated"))
    return measured.unionByName(estimated), report


def monotonicity(samples: DataFrame, keys: list[str], at: str = "t", order: str = "ord", width: float = WIDTH) -> DataFrame:
    """Per key, the numbers of equal and of decreasing steps."""
    seen = with_previous(samples.select(*keys, order, at), keys, order, [at], width)
    step = F.col(at) - F.col(f"prev_{at}")
    return seen.groupBy(*keys).agg(F.count_if(step == 0).alias("n_equal"), F.count_if(step < 0).alias("n_decreasing"))


def adjacent_intervals(rows: DataFrame, keys: list[str], at: str, order: str, valid: str, width: float = WIDTH) -> DataFrame:
    """keys, order, interval: differences between neighbouring rows that are both valid."""
    seen = with_next(rows.select(*keys, order, at, valid), keys, order, [at, valid], width)
    return seen.filter(F.col(valid) & F.col(f"next_{valid}")).select(*keys, order, (F.col(f"next_{at}") - F.col(at)).alias("interval"))
