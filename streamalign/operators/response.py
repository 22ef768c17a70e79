"""Event-aligned responses: receptive fields, tuning, peri-event values, correlations and grids."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from .ordered import join_on, small, with_carries, with_next, with_ordinal
from .windows import bin_responses, event_medians, interval_responses, longest, mean_sums


def receptive_field(stimuli: DataFrame, traces: DataFrame, keys: list[str], cell: list[str], position: list[str], delay: float = 0.0, value: str = "dff") -> DataFrame:
    """Mean response of each cell at each position, scaled to 0..1 per cell over the full grid of positions.

    A window's mean is 0 where the cell has samples but no value; windows without samples are skipped. A position
    without windows counts as 0 and takes part in the scaling; a flat map is divided by 1.
    """
    moved = stimuli.withColumns({"start": F.col("start") + delay, "stop": F.col("stop") + delay})
    sums = mean_sums(moved, traces, keys, cell, "ord_w", position, value)
    grid = stimuli.select(*position).distinct()
    full = traces.select(*cell).distinct().join(small(grid))
    map_ = join_on(full, sums, [*cell, *position], "left").withColumns({"n": F.coalesce("n", F.lit(0)), "raw": F.coalesce(F.col("total") / F.col("n"), F.lit(0.0))})
    w = Window.partitionBy(*cell)
    low, high = F.min("raw").over(w), F.max("raw").over(w)
    return map_.withColumn("scaled", (F.col("raw") - low) / F.when(high > low, high - low).otherwise(1.0)).drop("total")


def onset_sweep(stimuli: DataFrame, traces: DataFrame, keys: list[str], cell: list[str], position: list[str], delays: list[float], value: str = "dff") -> DataFrame:
    """Mean response of each cell at each position for every delay of the windows, from one reading of the traces."""
    moved = stimuli.withColumn("delay", F.explode(F.array(*[F.lit(float(d)) for d in delays])))
    moved = moved.withColumns({"start": F.col("start") + F.col("delay"), "stop": F.col("stop") + F.col("delay")})
    sums = mean_sums(moved, traces, keys, cell, "ord_w", ["delay", *position], value, longest(stimuli))
    return sums.select("delay", *cell, *position, (F.col("total") / F.col("n")).alias("raw"), "n")


def peri_event_z(events: DataFrame, traces: DataFrame, keys: list[str], cell: list[str], before: float, after: float, width: float, value: str = "dff") -> DataFrame:
    """Median of each event x bin x cell, and its z score by the mean and population deviation of the bins before 0."""
    return event_medians(events, traces, keys, cell, ["ord_w"], before, after, width, value)


def tuning_responses(stimuli: DataFrame, traces: DataFrame, keys: list[str], cell: list[str], bucket: float, response: tuple[float, float], base: tuple[float, float], value: str = "dff", condition: list[str] = ()) -> DataFrame:
    """Per presentation and cell with samples in both windows, the median in the response window less that in the baseline; NULL if either lacks values.

    condition: columns of the presentations to keep. bucket is no longer used: stretches are as long as both windows need.
    """
    return interval_responses(stimuli, traces, keys, cell, ["ord_w", *condition], response, base, value)


def peri_event_tuning(stimuli: DataFrame, traces: DataFrame, keys: list[str], cell: list[str], group: list[str], peri: tuple[float, float] = (-0.5, 1.5), width: float = 0.05, base: tuple[float, float] = (-0.3, 0.0), value: str = "dff", every_bin: bool = False) -> DataFrame:
    """Per group of presentations (a block, a direction), bin around the onset and cell, the mean of the presentations' responses.

    A response is the median of a bin less that of the presentation's baseline window; those without values don't
    count in the mean or in n. Bins in which no presentation of the group has a sample are absent, or, with every_bin, NULL
    with n = 0 for each cell of the group's keys. Only sums of the responses leave the tasks that find the medians.
    """
    sums = bin_responses(stimuli, traces, keys, cell, "ord_w", group, peri, width, base, value)
    found = sums.select(*group, *cell, "bin", F.try_divide("total", F.nullif(F.col("n"), F.lit(0))).alias("mean"), "n")
    if every_bin:
        n_bins = math.ceil(round((peri[1] - peri[0]) / width, 9))
        shown = stimuli.select(*dict.fromkeys([*keys, *group])).distinct()
        axis = join_on(shown, traces.select(*dict.fromkeys([*keys, *cell])).distinct(), keys).select(*group, *cell).distinct()
        axis = axis.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(n_bins - 1))))
        found = join_on(axis, found, [*group, *cell, "bin"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return found.withColumn("rel_t", peri[0] + F.col("bin") * width)


def tuning_curve(stimuli: DataFrame, responses: DataFrame, cells: DataFrame, cell: list[str], condition: list[str]) -> DataFrame:
    """Mean, SEM and presentations by condition and cell; the SEM's count is all presentations, missing ones included.

    responses without the condition's columns get them by the presentation's number.
    """
    shown = stimuli.groupBy(*condition).agg(F.count("*").alias("n"))
    has = set(condition) <= set(responses.columns)
    answered = responses if has else join_on(responses, stimuli.select("ord_w", *condition), ["ord_w"])
    stats = answered.groupBy(*condition, *cell).agg(F.avg("response").alias("mean"), F.stddev("response").alias("sd"), F.count("response").alias("n_finite"))
    full = cells.select(*cell).distinct().join(small(shown))
    out = join_on(full, stats, [*condition, *cell], "left")
    return out.select(*condition, *cell, "n", F.coalesce("n_finite", F.lit(0)).alias("n_finite"), "mean", (F.col("sd") / F.sqrt("n")).alias("sem"))


def normalize_tuning(curve: DataFrame, group: list[str], value: str = "mean") -> DataFrame:
    """curve with z across the conditions of each group; NULL where all are alike."""
    w = Window.partitionBy(*group)
    return curve.withColumn("z", F.try_divide(F.col(value) - F.avg(value).over(w), F.nullif(F.stddev_pop(value).over(w), F.lit(0.0))))


def preferred(curve: DataFrame, group: list[str], condition: str, value: str = "mean") -> DataFrame:
    """Per group, the condition of the largest value, the first in a tie, NULL counting as least."""
    best = curve.groupBy(*group).agg(F.min_by(condition, F.struct(-F.coalesce(F.col(value), F.lit(float("-inf"))), F.col(condition))).alias("preferred"))
    return best


def rank_rois(preferred_of: DataFrame, group: list[str], cell: str, by: str = "preferred") -> DataFrame:
    """preferred_of with `rank`: the cells of each group (a plane) in order of their preferred condition, then by cell, from 0."""
    return preferred_of.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(by, cell)) - 1)


def pairwise_correlation(pairs: DataFrame, keys: list[str], a: str, b: str, least: int) -> DataFrame:
    """Pearson correlation over the rows that have both; NULL for fewer than `least` or a constant side."""
    both = pairs.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    found = both.groupBy(*keys).agg(F.count("*").alias("n"), F.covar_pop(a, b).alias("c"), (F.stddev_pop(a) * F.stddev_pop(b)).alias("s"))
    axis = pairs.select(*keys).distinct()
    return join_on(axis, found, keys, "left").select(*keys, F.coalesce("n", F.lit(0)).alias("n"), F.when(F.col("n") >= least, F.try_divide("c", F.nullif(F.col("s"), F.lit(0.0)))).alias("r"))


def epochs(intervals: DataFrame, name: str = "name") -> DataFrame:
    """Neighbouring intervals of one name joined: first start, last stop and count, in order of time.

    Order is by start, stop and name within a session, which is cut at quantiles of the starts: an island's number is a
    running sum over stretches, and what a stretch has of it is merged by number.
    """
    order = ["start", "stop", name]
    marked = with_carries(intervals, ["session"], order, previous=[name], width=None)
    begins = F.when(F.col(f"prev_{name}") == F.col(name), 0).otherwise(1)
    grouped = with_carries(marked, ["session"], order, sums={"epoch": begins}, width=None)
    out = grouped.groupBy("session", "epoch", name).agg(F.min("start").alias("start"), F.max("stop").alias("stop"), F.count("*").alias("n"))
    numbered = with_ordinal(out, ["session", name], "epoch", "__number")
    same = out.groupBy("session", name).agg(F.count("*").alias("__same"))
    label = F.when(F.col("__same") > 1, F.concat(F.col(name), F.lit(" "), (F.col("__number") + 1).cast("string"))).otherwise(F.col(name))
    return join_on(numbered, same, ["session", name]).withColumn("label", label).drop("__number", "__same")


def upsample(rows: DataFrame, keys: list[str], value: str, factor: int, order: str = "bin") -> DataFrame:
    """`factor` points from each bin on towards the next, where both have values; else the bin's own point."""
    ahead = with_next(rows.select(*keys, order, value), keys, order, [order, value])
    filled = ahead.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(factor - 1))))
    near = (F.col(f"next_{order}") == F.col(order) + 1) & F.col(f"next_{value}").isNotNull() & F.col(value).isNotNull()
    line = F.col(value) + F.col("step") * (F.col(f"next_{value}") - F.col(value)) / factor
    return filled.select(*keys, order, "step", F.when(F.col("step") == 0, F.col(value)).when(near, line).alias(value))


def onset_grid(windows: DataFrame, keys: list[str], hz: float, lead: float = 0.5, partial: Column | None = None) -> DataFrame:
    """Times from `lead` before each onset to its stop, `lead` longer if complete, every 1/hz."""
    partial = F.lit(False) if partial is None else partial
    length = F.col("stop") - F.col("start") + F.when(partial, 0.0).otherwise(lead)
    n = F.floor((length + lead) * hz + 1e-9).cast("long")
    return windows.withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), n))).withColumn("rel_t", F.col("i") / hz - lead).withColumn("grid_t", F.col("start") + F.col("rel_t"))


def repeat_mean(trials: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Mean and number of the repeats that have a value, per grid sample."""
    return trials.groupBy(*keys).agg(F.avg(value).alias("mean"), F.count(value).alias("n"))


def mask_projection(mask: DataFrame, roi: list[str], row: str, col: str, z: str, weight: str) -> tuple[DataFrame, DataFrame]:
    """Largest weight over z of each pixel that has one, and per ROI the lowest and highest active z."""
    active = mask.filter(F.col(weight).isNotNull() & (F.col(weight) != 0))
    return active.groupBy(*roi, row, col).agg(F.max(weight).alias("weight")), active.groupBy(*roi).agg(F.min(z).alias("z_min"), F.max(z).alias("z_max"))


def image_projection(images: DataFrame, pixel: list[str], value: str) -> DataFrame:
    """The largest value over depth of each pixel (its channel, row and column)."""
    return images.groupBy(*pixel).agg(F.max(value).alias("value"))
