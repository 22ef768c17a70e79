"""Binning, histograms, quantiles, thresholds and down-sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .ordered import join_on, window_samples, with_ordinal
from .quantiles import percentile, percentiles
from .windows import window_bin_means, with_bins_seen


def bin_mean(series: DataFrame, clock: list[str], cell: list[str], value: str, width: float, at: str = "t", order: str = "ord") -> DataFrame:
    """Mean of each cell in bins of `width` from the first recorded time of its clock; bins without values are NULL.

    clock: columns that share a time axis (a plane), cell: what is averaged apart (an ROI). Bins run from 0 to the
    clock's last one for every cell.
    """
    timed = series.filter(F.col(at).isNotNull())
    start = timed.groupBy(*clock).agg(F.min_by(at, order).alias("__t0"), F.max(at).alias("__t1"))
    placed = join_on(timed, start, clock).withColumn("bin", F.floor((F.col(at) - F.col("__t0")) / width).cast("long")).filter("bin >= 0")
    means = placed.groupBy(*clock, *cell, "bin").agg(F.avg(value).alias("mean"), F.count(value).alias("n"))
    axis = join_on(timed.select(*clock, *cell).distinct(), start, clock)
    axis = axis.withColumn("bin", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("__t1") - F.col("__t0")) / width).cast("long"))))
    out = join_on(axis, means, [*clock, *cell, "bin"], "left")
    return out.select(*clock, *cell, "bin", (F.col("__t0") + (F.col("bin") + 0.5) * width).alias("centre"), "mean", F.coalesce("n", F.lit(0)).alias("n"))


def window_stat(samples: DataFrame, windows: DataFrame, keys: list[str], cell: list[str], window: list[str], stat: Column, bucket: float, start: str = "start", stop: str = "stop", at: str = "t") -> DataFrame:
    """An aggregate of the samples of each cell in each window; pairs without samples are absent."""
    return window_samples(windows, samples, keys, start, stop, at, bucket).groupBy(*window, *cell).agg(stat)


def bin_repeat(samples: DataFrame, windows: DataFrame, keys: list[str], cell: list[str], window: list[str], value: str, width: float) -> DataFrame:
    """Mean of 100 x value by bins of `width` from each window's start."""
    return window_bin_means(windows, samples.withColumn(value, F.col(value) * 100), keys, cell, window, value, width)


def repeat_windows(intervals: DataFrame, keys: list[str], tolerance: float = 0.01) -> DataFrame:
    """The two repeats of each key: halves of its one interval, or its two intervals cut to their mean length.

    Two intervals must be alike in length within the tolerance; other keys have no rows.
    """
    n = intervals.groupBy(*keys).agg(F.count("*").alias("n"), F.min("start").alias("s1"), F.max("start").alias("s2"), F.min_by("stop", "start").alias("e1"), F.max_by("stop", "start").alias("e2"))
    d1, d2 = F.col("e1") - F.col("s1"), F.col("e2") - F.col("s2")
    duration = F.when(F.col("n") == 1, d1 / 2).when((F.col("n") == 2) & (F.abs(d1 - d2) <= tolerance * F.abs(d2)), (d1 + d2) / 2)
    begins = F.when(F.col("n") == 1, F.array(F.col("s1"), F.col("s1") + d1 / 2)).otherwise(F.array("s1", "s2"))
    return n.withColumn("duration", duration).filter("duration is not null").select(*keys, F.posexplode(begins).alias("repeat", "start"), "duration")


def time_coverage(epochs: DataFrame, samples: DataFrame, keys: list[str], window: list[str], value: str, width: float = 1.0) -> DataFrame:
    """Per epoch, the share of its bins of `width` in which any cell has a value."""
    seen = with_bins_seen(epochs, samples.filter(F.col(value).isNotNull()), keys, window, width, "__n")
    return seen.select(*window, (F.col("__n") / F.greatest(F.lit(1), F.ceil((F.col("stop") - F.col("start")) / width))).alias("coverage"))


def level_threshold(samples: DataFrame, keys: list[str], level: str, low: float = 0.1, high: float = 0.9) -> DataFrame:
    """Per key, the middle between two percentiles of the whole recording; NULL unless the upper is larger."""
    q = percentiles(samples, keys, level, [low, high])
    return q.select(*keys, F.when(F.col("q")[1] > F.col("q")[0], (F.col("q")[0] + F.col("q")[1]) / 2).alias("threshold"))


def _finite(x: Column) -> Column:
    return F.when(F.abs(x) < float("inf"), x)


def quantile_limits(rows: DataFrame, keys: list[str], value: str, low: float = 0.01, high: float = 0.99, accuracy: int | None = None, if_equal: str = "around") -> DataFrame:
    """Display limits per key: two percentiles of the finite values, approximate with an accuracy; 0 and 1 for a key without any.

    Equal limits are moved apart: `around` by 1 % of their size, 1e-6 at least, either way; `above` by 1 upwards.
    """
    if if_equal not in ("around", "above"):
        raise ValueError("if_equal must be around or above")
    x = _finite(F.col(value))
    found = percentiles(rows, keys, x, [low, high]) if accuracy is None else rows.groupBy(*keys).agg(F.percentile_approx(x, [low, high], accuracy).alias("q"))
    lo, hi = F.col("q")[0], F.col("q")[1]
    more = F.greatest(F.lit(1e-6), F.abs(lo) * 0.01)
    down, up = (more, more) if if_equal == "around" else (F.lit(0.0), F.lit(1.0))
    apart = lambda x, moved, none: F.when(lo.isNull(), F.lit(none)).when(lo == hi, moved).otherwise(x)
    return found.select(*keys, apart(lo, lo - down, 0.0).alias("low"), apart(hi, hi + up, 1.0).alias("high"))


def magnitude_limit(rows: DataFrame, keys: list[str], value: str, share: float = 0.99, accuracy: int | None = None) -> DataFrame:
    """Per key, the percentile of the finite absolute values that limits a display around 0; 1 if that is 0 or there are none."""
    size = _finite(F.abs(F.col(value)))
    found = percentile(rows, keys, size, share, "limit") if accuracy is None else rows.groupBy(*keys).agg(F.percentile_approx(size, share, accuracy).cast("double").alias("limit"))
    return found.select(*keys, F.coalesce(F.nullif(F.col("limit"), F.lit(0.0)), F.lit(1.0)).alias("limit"))


def histogram(rows: DataFrame, keys: list[str], value: str, edges: list[float]) -> DataFrame:
    """Counts of values per bin of the increasing edges; the last bin includes its upper edge. All bins are listed."""
    n = len(edges) - 1
    x = F.col(value)
    place = F.aggregate(F.array(*[F.lit(float(e)) for e in edges]), F.lit(-1), lambda a, e: a + (x >= e).cast("int"))
    placed = rows.filter((x >= edges[0]) & (x <= edges[-1])).withColumn("bin", F.least(place, F.lit(n - 1)))
    counts = placed.groupBy(*keys, "bin").agg(F.count("*").alias("n"))
    axis = rows.select(*keys).distinct().withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return join_on(axis, counts, [*keys, "bin"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def downsample_max(rows: DataFrame, keys: list[str], value: str, step: int, order: str = "ord") -> DataFrame:
    """The maximum of each full group of `step` rows in order."""
    grouped = with_ordinal(rows, keys, order, "__n").groupBy(*keys, F.floor(F.col("__n") / step).alias("group"))
    return grouped.agg(F.max(value).alias("value"), F.count("*").alias("__c")).filter(F.col("__c") == step).drop("__c")


def every(rows: DataFrame, keys: list[str], step: int, order: str = "ord") -> DataFrame:
    """Each step-th row in order, the first included."""
    return with_ordinal(rows, keys, order, "__n").filter(F.col("__n") % step == 0).drop("__n")


def code_counts(rows: DataFrame, keys: list[str], code: str, codes: list[int]) -> DataFrame:
    """How many rows have each code, those that none has included."""
    axis = rows.select(*keys).distinct().withColumn(code, F.explode(F.array(*[F.lit(c) for c in codes])))
    return join_on(axis, rows.groupBy(*keys, code).agg(F.count("*").alias("n")), [*keys, code], "left").withColumn("n", F.coalesce("n", F.lit(0)))
