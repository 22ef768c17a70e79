"""Residuals, provenance and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .ordered import join_on
from .quantiles import percentiles


def secant_residuals(pairs: DataFrame, keys: list[str], x: str, y: str, order: str) -> DataFrame:
    """Per key, the line through its first and last pair, and median, 95 % and largest distance from it in ms."""
    ends = pairs.groupBy(*keys).agg(F.min_by(F.struct(x, y), order).alias("a"), F.max_by(F.struct(x, y), order).alias("b"))
    rate = F.try_divide(F.col("b")[y] - F.col("a")[y], F.col("b")[x] - F.col("a")[x])
    both = join_on(pairs, ends.withColumn("rate", rate), keys)
    off = F.abs(F.col(y) - (F.col("a")[y] + F.col("rate") * (F.col(x) - F.col("a")[x]))) * 1000
    largest = [F.max("rate").alias("rate"), F.max("__off").alias("max_ms")]
    found = percentiles(both.withColumn("__off", off), keys, "__off", [0.5, 0.95], more=largest)
    return found.select(*keys, "rate", F.col("q")[0].alias("median_ms"), F.col("q")[1].alias("p95_ms"), "max_ms")


def affine_residuals(anchors: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    """anchors with their distance from their key's least-squares line."""
    fit = anchors.groupBy(*keys).agg(F.regr_slope(y, x).alias("__s"), F.avg(x).alias("__x"), F.avg(y).alias("__y"))
    return join_on(anchors, fit, keys).withColumn("residual", F.col(y) - F.col("__y") - F.col("__s") * (F.col(x) - F.col("__x"))).drop("__s", "__x", "__y")


def spans_overlap(a: DataFrame, b: DataFrame, keys: list[str], start: str, stop: str, at: str) -> DataFrame:
    """Per key, whether the span of intervals a and that of times b meet."""
    x = a.groupBy(*keys).agg(F.min(start).alias("__a"), F.max(stop).alias("__z"))
    y = b.groupBy(*keys).agg(F.min(at).alias("__b"), F.max(at).alias("__y"))
    return join_on(x, y, keys).select(*keys, ((F.col("__a") <= F.col("__y")) & (F.col("__b") <= F.col("__z"))).alias("overlap"))


def endpoint_view(anchors: DataFrame, keys: list[str], at: str, near: float) -> DataFrame:
    """Anchors within `near` of their key's first or last time, by end."""
    ends = anchors.groupBy(*keys).agg(F.min(at).alias("__a"), F.max(at).alias("__z"))
    both = join_on(anchors, ends, keys)
    side = F.array_compact(F.array(F.when(F.col(at) - F.col("__a") <= near, F.lit("first")), F.when(F.col("__z") - F.col(at) <= near, F.lit("last"))))
    return both.withColumn("end", F.explode(side)).drop("__a", "__z")


def provenance(rows: DataFrame, keys: list[str]) -> DataFrame:
    """keys and a JSON object of the other columns in order of name, for a report file."""
    rest = sorted(c for c in rows.columns if c not in keys)
    return rows.select(*keys, F.to_json(F.struct(*rest)).alias("report"))
