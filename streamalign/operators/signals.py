"""Derived signals: counters, speed, eye tracking, population ratios and baselines."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from ..functions.columns import wrapped_difference
from .ordered import WIDTH, join_on, with_next, with_previous, with_running_sum
from .quantiles import percentile


def unwrap_counter(samples: DataFrame, keys: list[str], counter: str, order: str = "ord", bits: int = 16, width: float = WIDTH) -> DataFrame:
    """samples with `unwrapped`: the first value plus the sum of the wrapped differences."""
    seen = with_previous(samples, keys, order, [counter], width)
    value = F.col(counter).cast("long")
    step = F.when(F.col("has_prev"), wrapped_difference(value - F.col(f"prev_{counter}").cast("long"), bits)).otherwise(value)
    return with_running_sum(seen.withColumn("__step", step), keys, order, F.col("__step"), "unwrapped", width).drop("__step", "has_prev", f"prev_{counter}")


def interval_speed(samples: DataFrame, keys: list[str], counter: str = "unwrapped", at: str = "t", order: str = "ord", counts: int = 8192, radius: float = 10.0, position: float = 1.0, direction: int = 1, width: float = WIDTH) -> DataFrame:
    """keys, order, rotation and speed of each step between samples; steps without positive duration are left out."""
    if counts <= 0 or radius <= 0 or position <= 0 or direction not in (-1, 1):
        raise ValueError("counts, radius and position must be positive, direction 1 or -1")
    seen = with_next(samples.select(*keys, order, at, counter), keys, order, [at, counter], width)
    rotation = direction * (F.col(f"next_{counter}") - F.col(counter)) * 2 * math.pi / counts
    dt = F.col(f"next_{at}") - F.col(at)
    return seen.filter(dt > 0).select(*keys, order, rotation.alias("rotation"), (rotation * radius * position / dt).alias("speed"))


def dilate(rows: DataFrame, keys: list[str], flag: str, k: int, order: str = "frame", stretch: int = 1 << 16) -> DataFrame:
    """rows with `dilated`: true if the flag is true in any of the k rows before or after.

    Rows near a stretch's edge are copied to the next one, which keeps a long recording in many tasks. order must be
    a gapless count.
    """
    part = lambda c: F.floor(c / stretch)
    copies = F.array_distinct(F.array(part(F.col(order) - k), part(F.col(order)), part(F.col(order) + k)))
    spread = rows.withColumn("__part", F.explode(copies))
    w = Window.partitionBy(*keys, "__part").orderBy(order).rowsBetween(-k, k)
    return spread.withColumn("dilated", F.max(flag).over(w)).filter(F.col("__part") == part(F.col(order))).drop("__part")


def outliers(rows: DataFrame, keys: list[str], columns: list[str], limit: float = 3.0) -> DataFrame:
    """rows with is_outlier: any column over `limit` population standard deviations from its mean; NULLs don't count."""
    stats = rows.groupBy(*keys).agg(*[f(c).alias(f"__{n}_{c}") for c in columns for n, f in (("m", F.avg), ("s", F.stddev_pop))])
    joined = join_on(rows, stats, keys) if keys else rows.crossJoin(F.broadcast(stats))
    over = [F.coalesce(F.abs(F.try_divide(F.col(c) - F.col(f"__m_{c}"), F.nullif(F.col(f"__s_{c}"), F.lit(0.0)))) > limit, F.lit(False)) for c in columns]
    any_over = over[0]
    for x in over[1:]:
        any_over = any_over | x
    return joined.withColumn("is_outlier", any_over).drop(*[f"__{n}_{c}" for c in columns for n in "ms"])


def tracking_metrics(fits: DataFrame, keys: list[str], k: int = 2, order: str = "frame", eye: tuple[str, str] = ("eye_width", "eye_height"), pupil: tuple[str, str] = ("pupil_width", "pupil_height"), needed: tuple[str, ...] = ()) -> DataFrame:
    """fits with raw areas, blink flags and areas that are -1 while blinking.

    A blink is an outlier of either area or a missing fit column, and k rows around. The pupil's area is that of a
    circle of its larger half axis, NULL if either is missing.
    """
    larger = F.when(F.col(pupil[0]).isNotNull() & F.col(pupil[1]).isNotNull(), F.greatest(*pupil))
    areas = fits.withColumns({"eye_area_raw": math.pi * F.col(eye[0]) * F.col(eye[1]), "pupil_area_raw": math.pi * larger * larger})
    marked = outliers(areas, keys, ["eye_area_raw", "pupil_area_raw"])
    missing = F.lit(False)
    for c in needed or (*eye, *pupil):
        missing = missing | F.col(c).isNull()
    flags = dilate(marked.withColumn("__blink", F.col("is_outlier") | missing), keys, "__blink", k, order).withColumnRenamed("dilated", "likely_blink")
    shown = {n: F.when(F.col("likely_blink"), F.lit(-1.0)).otherwise(F.col(f"{n}_raw")) for n in ("eye_area", "pupil_area")}
    return flags.withColumns(shown).drop("__blink")


def population_ratio(traces: DataFrame, keys: list[str], dff: str = "dff", f0: str = "f0", eps: float = 1e-6) -> DataFrame:
    """Per key (plane and sample), sum(dff x (f0 + eps)) over sum(f0) of the cells that have both; NULL for none."""
    both = traces.filter(F.col(dff).isNotNull() & F.col(f0).isNotNull())
    found = both.groupBy(*keys).agg(F.try_divide(F.sum(F.col(dff) * (F.col(f0) + eps)), F.sum(f0)).alias("ratio"), F.count("*").alias("n_cells"))
    return join_on(traces.select(*keys).distinct(), found, keys, "left").withColumn("n_cells", F.coalesce("n_cells", F.lit(0)))


def median_period(samples: DataFrame, keys: list[str], within: list[str], at: str = "t", order: str = "ord", width: float = WIDTH, share: float = 0.5) -> DataFrame:
    """Per key, the median (or another percentile) of the positive steps between neighbours of one `within` group (a trial)."""
    seen = with_previous(samples.select(*dict.fromkeys([*keys, *within, order, at])), [*keys, *within], order, [at], width)
    step = F.col(at) - F.col(f"prev_{at}")
    return percentile(seen, keys, F.when(step > 0, step), share, "period")


def baseline(trace: DataFrame, keys: list[str], value: str, smooth: int, span: int, order: str = "ord") -> DataFrame:
    """trace with f0 and dff per trial (keys): a lower hull, our own estimator.

    A running median over `smooth` samples, then a running minimum and a running maximum of it over `span` samples,
    all centred. dff is (value - f0) / f0, NULL where f0 is 0 or missing. Trials are independent; keys must include
    the trial, which bounds what one window holds.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    around = lambda n: w.rowsBetween(-(n // 2), (n - 1) // 2)
    values = F.array_sort(F.array_compact(F.collect_list(value).over(around(smooth))))
    smoothed = trace.withColumn("__list", values).withColumn("__m", F.when(F.size("__list") > 0, F.expr("(__list[cast((size(__list) - 1) / 2 as int)] + __list[cast(size(__list) / 2 as int)]) / 2"))).drop("__list")
    low = smoothed.withColumn("__low", F.min("__m").over(around(span)))
    hull = low.withColumn("f0", F.max("__low").over(around(span)))
    return hull.withColumn("dff", F.try_divide(F.col(value) - F.col("f0"), F.nullif(F.col("f0"), F.lit(0.0)))).drop("__m", "__low")
