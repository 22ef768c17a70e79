"""Binned means of a stream: event-time windows with a watermark, so that state is bounded and late rows are dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def stream_bin_mean(stream: DataFrame, keys: list[str], value: str, width: str, late: str, ts: str = "ts") -> DataFrame:
    """Mean and count per key and window of `width`; rows over `late` behind the latest are dropped."""
    binned = stream.withWatermark(ts, late).groupBy(*keys, F.window(ts, width))
    return binned.agg(F.avg(value).alias("mean"), F.count(value).alias("n")).select(*keys, F.col("window.start").alias("bin_start"), "mean", "n")
