"""Queries that write streams to files and read them back, and queries of limits, agreement, ranks and peri-event bins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import bins, clean, interp, report, response, signals
from ..operators.ordered import small
from ..sources import tables
from . import views as V
from .responses import _TU, HOUR, _curve, _stim
from .views import K, with_views

QUERIES, ORACLES = {}, {}


def query(views: str, sql: str):
    """Registers a query and SQL with the same result."""

    def add(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = with_views(views, sql) if views else sql
        return f

    return add


def r(x, n: int = 6):
    return F.round(x if not isinstance(x, str) else F.col(x), n)


@query("ev", " SELECT ord AS frame, round(t - 1000, 6) AS t FROM ev WHERE event_type = 'view'")
def s3_read_camera_frames(spark: SparkSession, sf: str) -> DataFrame:
    path = V.scratch(spark, "camera")
    V.pulses(spark, sf, "view").select(F.col("ord").alias("frame"), F.col("t").cast("decimal(20,6)").alias("t")).write.csv(path, header=True)
    return tables.read_camera_frames(spark, path, 1000.0).withColumn("t", r("t"))


@query("v1", " SELECT 's' || session AS session_id, ord AS sample_idx, round(t, 6) AS t, CASE WHEN ord % 11 > 0 AND ord % 13 > 0 THEN round(level, 6) END AS photodiode, counter::SMALLINT AS wheel FROM v1")
def s5_read_streams(spark: SparkSession, sf: str) -> DataFrame:
    level = F.when(F.col("ord") % 11 == 0, F.lit(float("nan"))).when(F.col("ord") % 13 == 0, F.lit(float("-inf"))).otherwise(F.col("level"))
    path = V.scratch(spark, "analog")
    written = V.samples(spark, sf).select(F.concat(F.lit("s"), "session").alias("session_id"), F.col("ord").alias("sample_idx"), "t", level.alias("photodiode"), F.col("counter").cast("smallint").alias("wheel"))
    written.write.parquet(path)
    return tables.read_streams(spark, path, "analog").withColumns({"t": r("t"), "photodiode": r("photodiode")})


@query("v2", """, p AS (SELECT CASE WHEN plane = 'error' THEN 'none' ELSE plane END AS plane, roi, dff FROM (SELECT plane, roi, dff FROM v2)), k AS (SELECT plane, roi, 'dff' AS kind FROM p WHERE plane <> 'none' AND dff IS NOT NULL UNION ALL SELECT plane, roi, 'f0' FROM p WHERE plane <> 'none'),
c AS (SELECT plane, kind, count(*) AS n FROM k GROUP BY ALL), s AS (SELECT plane, count(DISTINCT n) = 1 AS same_shape, count(*) AS n_kinds FROM c GROUP BY ALL), d AS (SELECT plane, count(DISTINCT roi) AS n_cells FROM k GROUP BY ALL)
SELECT plane, count(*) AS n_lines, coalesce(any_value(n_cells), 0) AS n_cells, coalesce(any_value(n_kinds), 0) AS n_kinds, coalesce(any_value(same_shape), true) AS same_shape FROM p LEFT JOIN d USING (plane) LEFT JOIN s USING (plane) GROUP BY 1""")
def s6_read_traces(spark: SparkSession, sf: str) -> DataFrame:
    """One event type has no cells: a plane of which only line indices are recorded."""
    t = V.traces(spark, sf).withColumn("plane", F.when(F.col("plane") == "error", "none").otherwise(F.col("plane")))
    path = V.scratch(spark, "traces")
    found = t.filter("plane <> 'none'")
    kinds = found.filter("dff is not null").select("plane", "roi", F.lit("dff").alias("kind"), F.col("dff").alias("value"), "ord").unionByName(found.select("plane", "roi", F.lit("f0").alias("kind"), F.col("f0").alias("value"), "ord"))
    kinds.write.parquet(path)
    return tables.read_traces(spark, path, t.select("plane", "ord"), ["plane"])[1]


@query("ev", " SELECT session, k, count(*) AS n FROM ev GROUP BY ALL")
def s8_read_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """One JSON document, with nested objects, in a file for each session."""
    path = V.scratch(spark, "metadata")
    counted = V.events(spark, sf).groupBy("session", "k").agg(F.count("*").alias("n"))
    stimuli = F.sort_array(F.collect_list(F.struct("k", F.struct("n").alias("counts")))).alias("stimuli")  # as many as there are values of k
    documents = counted.groupBy("session").agg(stimuli).select(F.col("session").alias("folder"), F.to_json(F.struct("session", "stimuli")).alias("value"))
    documents.repartition("folder").write.partitionBy("folder").text(path)
    read = tables.read_metadata(spark, path, "session bigint, stimuli array<struct<k: int, counts: struct<n: bigint>>>")
    return read.select("session", F.explode_outer("stimuli").alias("s")).select("session", "s.k", "s.counts.n")


@query("v3", " SELECT 's' || x AS session_id, CASE WHEN block = 1 THEN 'one' ELSE 'two' END AS table_name, ord AS row_idx, round(start, 6) AS start_time, round(stop, 6) AS stop_time FROM v3")
def s12_write_intervals(spark: SparkSession, sf: str) -> DataFrame:
    path = V.scratch(spark, "intervals")
    rows = V.stimuli(spark, sf).select(F.concat(F.lit("s"), "x").alias("session_id"), F.when(F.col("block") == 1, "one").otherwise("two").alias("table_name"), F.col("ord").alias("row_idx"), F.col("start").alias("start_time"), F.col("stop").alias("stop_time"))
    tables.write_intervals(rows, path)
    return spark.read.parquet(path).select("session_id", "table_name", "row_idx", r("start_time").alias("start_time"), r("stop_time").alias("stop_time"))


@query("v1", " SELECT session AS session_id, ord, round(t, 6) AS t, round(level, 6) AS level FROM v1 WHERE ord % 5 > 0")
def s13_write_series(spark: SparkSession, sf: str) -> DataFrame:
    """Series without a time are left out."""
    path = V.scratch(spark, "series")
    s = V.samples(spark, sf).select(F.col("session").alias("session_id"), "ord", F.when(F.col("ord") % 5 > 0, F.col("t")).alias("t"), "level")
    tables.write_series(s, path, {"level": "V"})
    return spark.read.parquet(path).select(F.col("session_id").cast("long").alias("session_id"), "ord", r("t").alias("t"), r("level").alias("level"))


@query("v1", " SELECT session, count(*) AS n_samples, count(*) FILTER (state) AS n_high FROM v1 GROUP BY 1")
def s14_write_provenance(spark: SparkSession, sf: str) -> DataFrame:
    path = V.scratch(spark, "provenance")
    counts = V.samples(spark, sf).groupBy("session").agg(F.count("*").alias("n_samples"), F.count_if("state").alias("n_high"))
    tables.write_provenance(report.provenance(counts, K), path)
    back = spark.read.json(path, schema="session bigint, report string")
    return back.select("session", F.from_json("report", "n_samples bigint, n_high bigint").alias("r")).select("session", "r.*")


@query("v1", " SELECT session, count(*) AS n_samples, round(sum(level), 3) AS total FROM v1 GROUP BY 1")
def s15_write_summary(spark: SparkSession, sf: str) -> DataFrame:
    path = V.scratch(spark, "summary")
    totals = V.samples(spark, sf).groupBy("session").agg(F.count("*").alias("n_samples"), r(F.sum("level"), 3).alias("total"))
    tables.write_summary(totals, path)
    return spark.read.csv(path, header=True, schema="session bigint, n_samples bigint, total double")


@query("v3", " SELECT ord, x AS at_x, direction AS angle FROM v3")
def p16_column_alias(spark: SparkSession, sf: str) -> DataFrame:
    s = V.stimuli(spark, sf)
    x, angle = clean.column_alias(s, ["X", "x_position", "x"]), clean.column_alias(s, ["Orientation", "direction"])
    return s.select("ord", F.col(x).alias("at_x"), F.col(angle).alias("angle"))


_FLAT = """, p AS (SELECT plane, dff FROM v2 UNION ALL SELECT 'flat', 250.0 FROM v2 WHERE plane = 'click' UNION ALL SELECT 'zero', 0.0 FROM v2 WHERE plane = 'click' UNION ALL SELECT 'none', NULL FROM v2 WHERE plane = 'click'),
q AS (SELECT plane, quantile_cont(dff, 0.01) AS lo, quantile_cont(dff, 0.99) AS hi, quantile_cont(abs(dff), 0.99) AS size FROM p GROUP BY 1)"""


def _flat(spark: SparkSession, sf: str) -> DataFrame:
    """All planes, one with equal values, one with zeros and one without values."""
    t = V.traces(spark, sf).select("plane", "dff")
    click = t.filter("plane = 'click'")
    for name, x in (("flat", 250.0), ("zero", 0.0), ("none", None)):
        t = t.unionByName(click.select(F.lit(name).alias("plane"), F.lit(x).cast("double").alias("dff")))
    return t


@query("v2", _FLAT + " SELECT plane, round(CASE WHEN lo IS NULL THEN 0 WHEN lo = hi THEN lo - greatest(1e-6, abs(lo) * 0.01) ELSE lo END, 8) AS low, round(CASE WHEN lo IS NULL THEN 1 WHEN lo = hi THEN hi + greatest(1e-6, abs(lo) * 0.01) ELSE hi END, 8) AS high FROM q")
def a14_limits_around(spark: SparkSession, sf: str) -> DataFrame:
    return bins.quantile_limits(_flat(spark, sf), ["plane"], "dff").select("plane", r("low", 8).alias("low"), r("high", 8).alias("high"))


@query("v2", _FLAT + " SELECT plane, round(coalesce(lo, 0), 8) AS low, round(CASE WHEN lo IS NULL THEN 1 WHEN lo = hi THEN lo + 1 ELSE hi END, 8) AS high FROM q")
def a14_limits_above(spark: SparkSession, sf: str) -> DataFrame:
    return bins.quantile_limits(_flat(spark, sf), ["plane"], "dff", if_equal="above").select("plane", r("low", 8).alias("low"), r("high", 8).alias("high"))


@query("v2", _FLAT + ' SELECT plane, round(coalesce(nullif(size, 0), 1), 8) AS "limit" FROM q')
def a14_magnitude_limit(spark: SparkSession, sf: str) -> DataFrame:
    return bins.magnitude_limit(_flat(spark, sf), ["plane"], "dff").select("plane", r("limit", 8).alias("limit"))


@query("v5", ", d AS (SELECT session, t - lag(t) OVER (PARTITION BY session, trial ORDER BY ord) AS d FROM v5) SELECT session, round(quantile_cont(d, 0.1) FILTER (d > 0), 5) AS period FROM d GROUP BY 1")
def a18_percentile_period(spark: SparkSession, sf: str) -> DataFrame:
    return signals.median_period(V.lines(spark, sf), K, ["trial"], share=0.1).select("session", r("period", 5).alias("period"))


@query("v3", """, v AS (SELECT y, x, CASE WHEN y = 0 THEN x WHEN y = 1 THEN NULLIF(direction, 0) ELSE NULL END::DOUBLE AS setting FROM v3)
SELECT y, x, CASE WHEN count(DISTINCT setting) = 1 THEN max(setting) END AS setting, count(DISTINCT setting) = 1 AS agrees FROM v GROUP BY ALL""")
def a30_consensus_settings(spark: SparkSession, sf: str) -> DataFrame:
    """Settings that agree, that differ, and that are missing or infinite."""
    setting = F.when(F.col("y") == 0, F.col("x").cast("double")).when(F.col("y") == 1, F.when(F.col("direction") == 0, float("inf")).otherwise(F.col("direction").cast("double")))
    return clean.consensus(V.stimuli(spark, sf).select("y", "x", setting.alias("setting")), ["y", "x"], "setting")


@query("", "SELECT event_id, coalesce(a, b) AS hz, coalesce(a = b, a IS NOT NULL OR b IS NOT NULL) AND coalesce(coalesce(a, b) > 0, false) AS valid FROM (SELECT event_id, CASE WHEN event_id % 4 > 1 THEN value END AS a, CASE WHEN event_id % 4 IN (1, 2) THEN value - (event_id % 8 = 2)::INT WHEN event_id % 4 = 3 AND event_id % 8 = 3 THEN -value END AS b FROM events)")
def g4_explicit_rate(spark: SparkSession, sf: str) -> DataFrame:
    """Rates given by one name, by both alike, by both unlike, and by none."""
    i, v = F.col("event_id"), F.col("value")
    b = F.when((i % 4).isin(1, 2), v - (i % 8 == 2).cast("int")).when((i % 4 == 3) & (i % 8 == 3), -v)
    e = V.table(spark, sf, "events").select("event_id", F.when(i % 4 > 1, v).alias("a"), b.alias("b"))
    return clean.sampling_rate(e, ["a", "b"]).select("event_id", "hz", "valid")


@query("v2 v3", _TU + ", rk AS (SELECT *, row_number() OVER (PARTITION BY block, plane, roi ORDER BY round(mean, 9) DESC NULLS LAST, direction) AS n_ FROM cu WHERE block = 1) SELECT plane, roi, direction AS preferred, (row_number() OVER (PARTITION BY plane ORDER BY direction, roi) - 1)::INT AS rank FROM rk WHERE n_ = 1")
def a9_rank_rois(spark: SparkSession, sf: str) -> DataFrame:
    best = response.preferred(_curve(spark, sf).filter("block = 1").withColumn("mean", r("mean", 9)), ["plane", "roi"], "direction")
    return response.rank_rois(best, ["plane"], "roi")


@query("v2 v3", """, s AS (SELECT v3.ord AS ord_w, v3.start, block, direction, p.plane FROM v3, (VALUES ('click'), ('view')) p(plane)),
j AS (SELECT ord_w, block, direction, s.plane, roi, t - start AS rel, dff FROM s JOIN v2 ON v2.plane = s.plane AND t >= start - 3600 AND t < start + 7200),
b AS (SELECT ord_w, plane, roi, median(dff) AS base FROM j WHERE rel >= -1800 AND rel < 0 GROUP BY ALL),
m AS (SELECT ord_w, block, direction, plane, roi, floor((rel + 3600) / 900)::INT AS bin, median(dff) AS m FROM j GROUP BY ALL)
SELECT block, direction, plane, roi, bin, round(avg(m - base), 8) AS mean, count(m - base) AS n FROM m LEFT JOIN b USING (ord_w, plane, roi) GROUP BY ALL""")
def a8_peri_event(spark: SparkSession, sf: str) -> DataFrame:
    found = response.peri_event_tuning(_stim(spark, sf), V.traces(spark, sf), ["plane"], ["plane", "roi"], ["block", "direction"], (-HOUR, 2 * HOUR), 900.0, (-1800.0, 0.0))
    return found.select("block", "direction", "plane", "roi", "bin", r("mean", 8).alias("mean"), "n")


@query("v2 v3", """, d AS (SELECT plane, t - lag(t) OVER (PARTITION BY plane ORDER BY t) AS d FROM v2), g AS (SELECT plane, greatest(3 * 600.0, 3 * median(d)) AS gap FROM d GROUP BY 1),
q AS (SELECT plane, ord AS w, start + g.i * 900 AS gt, g.i FROM v3, range(5) g(i), (SELECT DISTINCT plane FROM v2)), b AS (SELECT q.plane, q.w, q.i, q.gt, lo.t AS lt, lo.dff AS ly, hi.t AS ht, hi.dff AS hy FROM q ASOF LEFT JOIN v2 lo ON q.plane = lo.plane AND q.gt >= lo.t ASOF LEFT JOIN v2 hi ON q.plane = hi.plane AND q.gt <= hi.t)
SELECT plane, w, i, round(CASE WHEN lt = gt THEN ly WHEN ht - lt <= gap THEN ly + (gt - lt) * (hy - ly) / (ht - lt) END, 6) AS value_at FROM b JOIN g USING (plane)""")
def g3_align_by_period(spark: SparkSession, sf: str) -> DataFrame:
    """Gaps over 3 times the larger of the expected and the median period stay open."""
    a = V.traces(spark, sf).select("plane", "ord", "t", "dff")
    q = V.stimuli(spark, sf).select(F.col("ord").alias("w"), "start", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(4).cast("long"))).alias("i"))
    q = q.withColumn("t", F.col("start") + F.col("i") * 900).drop("start").crossJoin(small(a.select("plane").distinct(), 1000))
    return interp.align_trace(q, a, ["plane"], "t", "dff", 1 / 600.0, 86400.0, "ord").select("plane", "w", "i", r("value_at").alias("value_at"))
