"""Queries of the binning, response, stimulus-log and report operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from ..operators import bins, interp, report, response, stimlog
from ..operators.ordered import small
from ..operators.windows import window_medians, with_samples
from . import views as V
from .views import K, with_views

QUERIES, ORACLES = {}, {}
HOUR = 3600.0


def query(views: str = "", sql: str | None = None):
    """Registers a query and, if given, SQL with the same result."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = with_views(views, sql) if views else sql
        return f

    return add


def r(x, n: int = 6):
    return F.round(x if not isinstance(x, str) else F.col(x), n)


def _stim(spark, sf):
    """Presentations beside every plane of the traces, with their own ordinal as ord_w."""
    planes = F.explode(F.array(*[F.lit(p) for p in ("click", "view")])).alias("plane")
    return V.stimuli(spark, sf).withColumnRenamed("ord", "ord_w").select("*", planes)


_W = ", s AS (SELECT v3.ord AS ord_w, v3.* EXCLUDE (ord), p.plane FROM v3, (VALUES ('click'), ('view')) p(plane)), pr AS (SELECT s.*, v2.roi, v2.t, v2.dff FROM s JOIN v2 ON v2.plane = s.plane AND v2.t >= s.start AND v2.t < s.stop)"


@query("v2", """, b AS (SELECT plane, arg_min(t, ord) AS t0, max(t) AS t1 FROM v2 GROUP BY 1), ax AS (SELECT c.plane, c.roi, t0, unnest(range(0, floor((t1 - t0) / 86400)::BIGINT + 1)) AS bin FROM (SELECT DISTINCT plane, roi FROM v2) c JOIN b USING (plane)),
m AS (SELECT plane, roi, floor((t - t0) / 86400)::BIGINT AS bin, avg(dff) AS mean, count(dff) AS n FROM v2 JOIN b USING (plane) GROUP BY 1, 2, 3)
SELECT plane, roi, bin, round(t0 + (bin + 0.5) * 86400, 6) AS centre, round(mean, 8) AS mean, coalesce(n, 0) AS n FROM ax LEFT JOIN m USING (plane, roi, bin)""")
def a1_bin_mean(spark: SparkSession, sf: str) -> DataFrame:
    b = bins.bin_mean(V.traces(spark, sf), ["plane"], ["roi"], "dff", 86400.0)
    return b.select("plane", "roi", "bin", r("centre").alias("centre"), r("mean", 8).alias("mean"), "n")


@query("v2 v3", _W + " SELECT ord_w, plane, roi, floor((t - start) / 600)::BIGINT AS bin, round(avg(dff * 100), 6) AS mean FROM pr GROUP BY 1, 2, 3, 4")
def a2_bin_repeat(spark: SparkSession, sf: str) -> DataFrame:
    return bins.bin_repeat(V.traces(spark, sf), _stim(spark, sf), ["plane"], ["roi"], ["ord_w", "plane"], "dff", 600.0).withColumn("mean", r("mean"))


@query("v3", """, i AS (SELECT x, y, block, min(start) AS s FROM v3 WHERE k % 2 = 0 OR y = 1 GROUP BY 1, 2, 3), g AS (SELECT x, y, count(*) AS n, min(s) AS s1, max(s) AS s2 FROM i GROUP BY 1, 2)
SELECT x, y, q.r AS repeat, round(CASE WHEN n = 1 THEN s1 + q.r * 1800.0::DOUBLE ELSE CASE WHEN q.r = 0 THEN s1 ELSE s2 END END, 6) AS start, round(CASE WHEN n = 1 THEN 1800.0::DOUBLE ELSE 3600.0::DOUBLE END, 4) AS duration FROM g, (VALUES (0), (1)) q(r)""")
def a3_repeat_windows(spark: SparkSession, sf: str) -> DataFrame:
    i = V.stimuli(spark, sf).filter("k % 2 = 0 or y = 1").groupBy("x", "y", "block").agg(F.min("start").alias("start")).withColumn("stop", F.col("start") + 3600)
    return bins.repeat_windows(i, ["x", "y"]).select("x", "y", "repeat", r("start").alias("start"), r("duration", 4).alias("duration"))


@query("v2 v3", _W + " SELECT ord_w, plane, roi, round(median(dff), 8) AS median FROM pr GROUP BY 1, 2, 3")
def a4_window_median(spark: SparkSession, sf: str) -> DataFrame:
    return window_medians(_stim(spark, sf), V.traces(spark, sf), ["plane"], ["roi"], ["ord_w", "plane"], "dff").withColumn("median", r("median", 8))


_RF = """, m AS (SELECT ord_w, x, y, plane, roi, coalesce(avg(dff), 0) AS m FROM pr GROUP BY ALL), su AS (SELECT plane, roi, x, y, sum(m) AS total, count(*) AS n FROM m GROUP BY ALL),
gr AS (SELECT * FROM (SELECT DISTINCT plane, roi FROM v2 WHERE plane IN ('click', 'view')), (SELECT DISTINCT x, y FROM v3)), raw AS (SELECT gr.*, coalesce(n, 0) AS n, coalesce(total / n, 0) AS raw FROM gr LEFT JOIN su USING (plane, roi, x, y)),
mm AS (SELECT *, min(raw) OVER (PARTITION BY plane, roi) AS lo, max(raw) OVER (PARTITION BY plane, roi) AS hi FROM raw)"""


@query("v2 v3", _W + _RF + " SELECT plane, roi, x, y, n, round(raw + 3e-10, 8) AS raw, round((raw - lo) / CASE WHEN hi > lo THEN hi - lo ELSE 1 END, 8) AS scaled FROM mm")
def a5_receptive_field(spark: SparkSession, sf: str) -> DataFrame:
    t = V.traces(spark, sf).filter("plane in ('click', 'view')")
    f = response.receptive_field(_stim(spark, sf), t, ["plane"], ["plane", "roi"], ["x", "y"])
    return f.select("plane", "roi", "x", "y", "n", r(F.col("raw") + 3e-10, 8).alias("raw"), r("scaled", 8).alias("scaled"))


@query("v2 v3", """, s AS (SELECT v3.ord AS ord_w, v3.* EXCLUDE (ord), p.plane, d.d AS delay FROM v3, (VALUES ('click'), ('view')) p(plane), (VALUES (-1800.0::DOUBLE), (0.0), (1800.0)) d(d)),
m AS (SELECT delay, ord_w, x, y, s.plane, roi, coalesce(avg(dff), 0) AS m FROM s JOIN v2 ON v2.plane = s.plane AND v2.t >= s.start + delay AND v2.t < s.stop + delay GROUP BY ALL)
SELECT delay, plane, roi, x, y, round(avg(m) + 3e-10, 8) AS raw, count(*) AS n FROM m GROUP BY ALL""")
def j18_onset_sweep(spark: SparkSession, sf: str) -> DataFrame:
    return response.onset_sweep(_stim(spark, sf), V.traces(spark, sf), ["plane"], ["plane", "roi"], ["x", "y"], [-1800.0, 0.0, 1800.0]).withColumn("raw", r(F.col("raw") + 3e-10, 8))


@query("v2 v3", _W + " , sn AS (SELECT ord_w, plane, count(DISTINCT floor((t - start) / 300)) AS n FROM pr WHERE dff IS NOT NULL GROUP BY 1, 2) SELECT s.ord_w, s.plane, round(coalesce(n, 0) / greatest(1, ceil((s.stop - s.start) / 300)), 8) AS coverage FROM s LEFT JOIN sn USING (ord_w, plane)")
def a6_time_coverage(spark: SparkSession, sf: str) -> DataFrame:
    c = bins.time_coverage(_stim(spark, sf), V.traces(spark, sf), ["plane"], ["ord_w", "plane"], "dff", 300.0)
    return c.withColumn("coverage", r("coverage", 8))


@query("v2 v3", """, p AS (SELECT v3.ord AS ord_w, roi, floor((t - start) / 1800)::BIGINT AS bin, median(dff) AS md FROM v3 JOIN v2 ON v2.plane = 'click' AND t >= start - 7200 AND t < start + 7200 GROUP BY ALL)
SELECT ord_w, roi, bin, round(md, 8) AS median, round((md - avg(md) FILTER (bin < 0) OVER w) / nullif(stddev_pop(md) FILTER (bin < 0) OVER w, 0), 6) AS z FROM p WINDOW w AS (PARTITION BY ord_w, roi)""")
def a7_peri_event_z(spark: SparkSession, sf: str) -> DataFrame:
    z = response.peri_event_z(_stim(spark, sf).filter("plane = 'click'"), V.traces(spark, sf), ["plane"], ["roi"], 7200.0, 7200.0, 1800.0)
    return z.select("ord_w", "roi", "bin", r("median", 8).alias("median"), r("z").alias("z"))


@query("v2 v3", """, p AS (SELECT v3.ord AS ord_w, plane, roi, floor((t - start) / 1800)::BIGINT AS bin, median(dff) AS md FROM v3 JOIN v2 ON t >= start - 7200 AND t < start + 7200 GROUP BY ALL)
SELECT ord_w, plane, roi, bin, round(md, 8) AS median, round((md - avg(md) FILTER (bin < 0) OVER w) / nullif(stddev_pop(md) FILTER (bin < 0) OVER w, 0) + 3e-10, 6) AS z FROM p WINDOW w AS (PARTITION BY ord_w, plane, roi)""")
def a7_peri_event_z_planes(spark: SparkSession, sf: str) -> DataFrame:
    s, t = V.stimuli(spark, sf).withColumnRenamed("ord", "ord_w"), V.traces(spark, sf)
    z = response.peri_event_z(s.join(small(t.select("plane").distinct())), t, ["plane"], ["plane", "roi"], 7200.0, 7200.0, 1800.0)
    return z.select("ord_w", "plane", "roi", "bin", r("median", 8).alias("median"), r(F.col("z") + 3e-10).alias("z"))


_TU = """, s AS (SELECT v3.ord AS ord_w, v3.* EXCLUDE (ord), p.plane FROM v3, (VALUES ('click'), ('view')) p(plane)),
a AS (SELECT ord_w, s.plane, roi, median(dff) AS r FROM s JOIN v2 ON v2.plane = s.plane AND t >= start AND t < start + 3600 GROUP BY ALL), b AS (SELECT ord_w, s.plane, roi, median(dff) AS b FROM s JOIN v2 ON v2.plane = s.plane AND t >= start - 3600 AND t < start GROUP BY ALL),
rs AS (SELECT ord_w, plane, roi, r - b AS response FROM a JOIN b USING (ord_w, plane, roi)), sh AS (SELECT block, direction, count(*) AS n FROM v3 GROUP BY ALL),
st AS (SELECT block, direction, rs.plane, roi, avg(response) AS mean, stddev(response) AS sd, count(response) AS nf FROM rs JOIN v3 ON v3.ord = rs.ord_w GROUP BY ALL),
cu AS (SELECT sh.block, sh.direction, c.plane, c.roi, sh.n, coalesce(nf, 0) AS n_finite, mean, sd / sqrt(n) AS sem FROM sh CROSS JOIN (SELECT DISTINCT plane, roi FROM v2 WHERE plane IN ('click', 'view')) c LEFT JOIN st USING (block, direction, plane, roi))"""


def _curve(spark, sf):
    s, t = _stim(spark, sf), V.traces(spark, sf).filter("plane in ('click', 'view')")
    found = response.tuning_responses(s, t, ["plane"], ["plane", "roi"], HOUR, (0.0, HOUR), (-HOUR, 0.0), condition=["block", "direction"])
    one = V.stimuli(spark, sf).withColumnRenamed("ord", "ord_w")
    return response.tuning_curve(one, found, t, ["plane", "roi"], ["block", "direction"])


@query("v2 v3", _TU + " SELECT block, direction, plane, roi, n, n_finite, round(mean, 8) AS mean, round(sem, 8) AS sem FROM cu")
def a8_orientation_tuning(spark: SparkSession, sf: str) -> DataFrame:
    return _curve(spark, sf).withColumns({"mean": r("mean", 8), "sem": r("sem", 8)})


@query("v2 v3", _TU + " SELECT block, direction, plane, roi, round((mean - avg(mean) OVER w) / nullif(stddev_pop(mean) OVER w, 0), 6) AS z FROM cu WINDOW w AS (PARTITION BY block, plane, roi)")
def a9_normalize_tuning(spark: SparkSession, sf: str) -> DataFrame:
    return response.normalize_tuning(_curve(spark, sf), ["block", "plane", "roi"]).select("block", "direction", "plane", "roi", r("z").alias("z"))


@query("v2 v3", _TU + ", rk AS (SELECT *, row_number() OVER (PARTITION BY block, plane, roi ORDER BY round(mean, 9) DESC NULLS LAST, direction) AS n_ FROM cu) SELECT block, plane, roi, direction AS preferred FROM rk WHERE n_ = 1")
def a9_preferred(spark: SparkSession, sf: str) -> DataFrame:
    return response.preferred(_curve(spark, sf).withColumn("mean", r("mean", 9)), ["block", "plane", "roi"], "direction")


_CORR = ", h AS (SELECT plane, roi, floor(t / 7200)::BIGINT AS bin, avg(dff) AS m FROM v2 GROUP BY ALL), j AS (SELECT a.roi, a.m AS a, b.m AS b FROM h a JOIN h b ON a.roi = b.roi AND a.bin = b.bin AND a.plane = 'click' AND b.plane = 'view')"


@query("v2", _CORR + " SELECT roi, count(*) FILTER (a IS NOT NULL AND b IS NOT NULL) AS n, round(CASE WHEN count(*) FILTER (a IS NOT NULL AND b IS NOT NULL) >= 3 THEN covar_pop(a, b) / nullif((stddev_pop(a) FILTER (b IS NOT NULL)) * (stddev_pop(b) FILTER (a IS NOT NULL)), 0) END, 6) AS r FROM j GROUP BY 1")
def a10_pairwise_corr(spark: SparkSession, sf: str) -> DataFrame:
    h = V.traces(spark, sf).groupBy("plane", "roi", F.floor(F.col("t") / 7200).alias("bin")).agg(F.avg("dff").alias("m"))
    side = lambda p, n: h.filter(F.col("plane") == p).select("roi", "bin", F.col("m").alias(n))
    return response.pairwise_correlation(side("click", "a").join(side("view", "b"), ["roi", "bin"]), ["roi"], "a", "b", 3).withColumn("r", r("r"))


@query("v2", " SELECT plane, roi, (ord // 100) % 12 AS slot, round(avg(dff), 8) AS mean, count(dff) AS n FROM v2 GROUP BY ALL")
def a11_repeat_statistics(spark: SparkSession, sf: str) -> DataFrame:
    t = V.traces(spark, sf).withColumn("slot", F.floor(F.col("ord") / 100) % 12)
    return response.repeat_mean(t, ["plane", "roi", "slot"], "dff").withColumn("mean", r("mean", 8))


@query("v1", " SELECT session, round((quantile_cont(level, 0.1) + quantile_cont(level, 0.9)) / 2, 6) AS threshold FROM v1 GROUP BY 1")
def a13_level_threshold(spark: SparkSession, sf: str) -> DataFrame:
    return bins.level_threshold(V.samples(spark, sf), K, "level").withColumn("threshold", r("threshold"))


@query("v2", " SELECT plane, round(quantile_cont(dff, 0.01), 8) AS low, round(quantile_cont(dff, 0.99), 8) AS high FROM v2 GROUP BY 1")
def a14_quantile_limits(spark: SparkSession, sf: str) -> DataFrame:
    return bins.quantile_limits(V.traces(spark, sf), ["plane"], "dff").select("plane", r("low", 8).alias("low"), r("high", 8).alias("high"))


@query("v1", ", h AS (SELECT session, least(floor(level / 20), 9)::INT AS bin, count(*) AS n FROM v1 WHERE level <= 200 GROUP BY ALL) SELECT a.session, a.bin, coalesce(n, 0) AS n FROM (SELECT DISTINCT session, b.bin::INT AS bin FROM v1, range(10) b(bin)) a LEFT JOIN h USING (session, bin)")
def a15_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return bins.histogram(V.samples(spark, sf), K, "level", [20.0 * k for k in range(11)])


@query("clicks", """, e AS (SELECT session, min(ord) AS x0, arg_min(t, ord) AS y0, max(ord) AS x1, arg_max(t, ord) AS y1 FROM clicks GROUP BY 1), o AS (SELECT c.session, (y1 - y0) / (x1 - x0)::DOUBLE AS rate, abs(t - (y0 + (y1 - y0) / (x1 - x0)::DOUBLE * (ord - x0))) * 1000 AS off FROM clicks c JOIN e USING (session))
SELECT session, round(any_value(rate), 6) AS rate, round(median(off), 2) AS median_ms, round(quantile_cont(off, 0.95), 2) AS p95_ms, round(max(off), 2) AS max_ms FROM o GROUP BY 1""")
def a16_secant_residuals(spark: SparkSession, sf: str) -> DataFrame:
    s = report.secant_residuals(V.pulses(spark, sf, "click"), K, "ord", "t", "ord")
    return s.select("session", r("rate").alias("rate"), *[r(c, 2).alias(c) for c in ("median_ms", "p95_ms", "max_ms")])


@query("clicks", ", f AS (SELECT session, regr_slope(t, ord) AS s, avg(ord) AS mx, avg(t) AS my FROM clicks GROUP BY 1) SELECT session, ord, round(t - my - s * (ord - mx), 4) AS residual FROM clicks JOIN f USING (session)")
def a17_affine_residuals(spark: SparkSession, sf: str) -> DataFrame:
    return report.affine_residuals(V.pulses(spark, sf, "click"), K, "ord", "t").select("session", "ord", r("residual", 4).alias("residual"))


@query("v1", ", n AS (SELECT *, row_number() OVER (PARTITION BY session ORDER BY ord) - 1 AS n FROM v1) SELECT session, n // 7 AS \"group\", max(level) AS value FROM n GROUP BY ALL HAVING count(*) = 7")
def a24_downsample_max(spark: SparkSession, sf: str) -> DataFrame:
    return bins.downsample_max(V.samples(spark, sf), K, "level", 7)


@query("v1", ", n AS (SELECT *, row_number() OVER (PARTITION BY session ORDER BY ord) - 1 AS n FROM v1) SELECT session, ord FROM n WHERE n % 5 = 0")
def a24_every_nth(spark: SparkSession, sf: str) -> DataFrame:
    return bins.every(V.samples(spark, sf), K, 5).select("session", "ord")


@query("v3", ", c AS (SELECT block, x * 2 AS code, count(*) AS n FROM v3 GROUP BY ALL) SELECT a.block, a.code, coalesce(n, 0) AS n FROM (SELECT DISTINCT block, q.code FROM v3, (VALUES (0), (1), (2), (3), (4)) q(code)) a LEFT JOIN c USING (block, code)")
def a25_status_counts(spark: SparkSession, sf: str) -> DataFrame:
    return bins.code_counts(V.stimuli(spark, sf).withColumn("code", F.col("x") * 2), ["block"], "code", [0, 1, 2, 3, 4])


def _mask(spark, sf):
    item = V.table(spark, sf, "lineitem")
    return item.select(F.col("l_suppkey").alias("roi"), F.col("l_linenumber").alias("z"), (F.col("l_partkey") % 32).alias("row"), (F.col("l_orderkey") % 32).alias("col"), F.col("l_discount").alias("weight"))


@query("", "SELECT l_suppkey AS roi, l_partkey % 32 AS \"row\", l_orderkey % 32 AS col, max(l_discount) AS weight FROM lineitem WHERE l_discount <> 0 GROUP BY ALL")
def a27_mask_projection(spark: SparkSession, sf: str) -> DataFrame:
    return response.mask_projection(_mask(spark, sf), ["roi"], "row", "col", "z", "weight")[0]


@query("", "SELECT l_suppkey AS roi, min(l_linenumber) AS z_min, max(l_linenumber) AS z_max FROM lineitem WHERE l_discount <> 0 GROUP BY ALL")
def a27_mask_depth(spark: SparkSession, sf: str) -> DataFrame:
    return response.mask_projection(_mask(spark, sf), ["roi"], "row", "col", "z", "weight")[1]


@query("", "SELECT l_returnflag AS channel, l_partkey % 32 AS \"row\", l_orderkey % 32 AS col, max(l_quantity) AS value FROM lineitem GROUP BY ALL")
def a28_image_projection(spark: SparkSession, sf: str) -> DataFrame:
    item = V.table(spark, sf, "lineitem")
    pixels = item.select(F.col("l_returnflag").alias("channel"), (F.col("l_partkey") % 32).alias("row"), (F.col("l_orderkey") % 32).alias("col"), "l_quantity")
    return response.image_projection(pixels, ["channel", "row", "col"], "l_quantity")


@query("v3", " SELECT block, x, count(DISTINCT CASE WHEN block = 1 THEN x ELSE direction END) = 1 AS agrees, max(CASE WHEN block = 1 THEN x ELSE direction END) AS value FROM v3 GROUP BY ALL")
def a30_consensus(spark: SparkSession, sf: str) -> DataFrame:
    v = V.stimuli(spark, sf).withColumn("v", F.when(F.col("block") == 1, F.col("x")).otherwise(F.col("direction")))
    return v.groupBy("block", "x").agg((F.count_distinct("v") == 1).alias("agrees"), F.max("v").alias("value"))


_EP = """, i AS (SELECT 1 AS session, 'b' || x AS name, start, stop FROM v3), m AS (SELECT *, CASE WHEN lag(name) OVER (ORDER BY start, stop, name) = name THEN 0 ELSE 1 END AS nw FROM i), g AS (SELECT *, sum(nw) OVER (ORDER BY start, stop, name ROWS UNBOUNDED PRECEDING) AS ep FROM m),
o AS (SELECT ep, name, min(start) AS start, max(stop) AS stop, count(*) AS n FROM g GROUP BY ALL)"""


@query("v3", _EP + " SELECT ep::BIGINT AS epoch, round(start, 6) AS start, n, CASE WHEN count(*) OVER (PARTITION BY name) > 1 THEN name || ' ' || row_number() OVER (PARTITION BY name ORDER BY ep) ELSE name END AS label FROM o")
def w28_epochs(spark: SparkSession, sf: str) -> DataFrame:
    i = V.stimuli(spark, sf).select(F.lit(1).alias("session"), F.concat(F.lit("b"), F.col("x").cast("string")).alias("name"), "start", "stop")
    return response.epochs(i).select(F.col("epoch").cast("long").alias("epoch"), r("start").alias("start"), "n", "label")


@query("v2", """, b AS (SELECT plane, floor(t / 43200)::BIGINT AS bin, avg(dff) AS m FROM v2 WHERE roi = 3 GROUP BY ALL), n AS (SELECT *, lead(bin) OVER w AS nb, lead(m) OVER w AS nm FROM b WINDOW w AS (PARTITION BY plane ORDER BY bin))
SELECT plane, bin, s.s AS step, round(CASE WHEN s.s = 0 THEN m WHEN nb = bin + 1 AND nm IS NOT NULL THEN m + s.s * (nm - m) / 8 END + 3e-10, 8) AS m FROM n, (SELECT unnest(range(8))::INT AS s) s""")
def g5_upsample(spark: SparkSession, sf: str) -> DataFrame:
    b = V.traces(spark, sf).filter("roi = 3").groupBy("plane", F.floor(F.col("t") / 43200).alias("bin")).agg(F.avg("dff").alias("m"))
    return response.upsample(b, ["plane"], "m", 8).withColumn("m", r(F.col("m") + 3e-10, 8))


@query("v2", """, b AS (SELECT plane, roi, floor(t / 43200)::BIGINT AS bin, avg(dff) AS m FROM v2 GROUP BY ALL), n AS (SELECT *, lead(bin) OVER w AS nb, lead(m) OVER w AS nm FROM b WINDOW w AS (PARTITION BY plane, roi ORDER BY bin))
SELECT plane, roi, bin, s.s AS step, round(CASE WHEN s.s = 0 THEN m WHEN nb = bin + 1 AND nm IS NOT NULL THEN m + s.s * (nm - m) / 8 END + 3e-10, 8) AS m FROM n, (SELECT unnest(range(8))::INT AS s) s""")
def g5_upsample_cells(spark: SparkSession, sf: str) -> DataFrame:
    b = V.traces(spark, sf).groupBy("plane", "roi", F.floor(F.col("t") / 43200).alias("bin")).agg(F.avg("dff").alias("m"))
    return response.upsample(b, ["plane", "roi"], "m", 8).withColumn("m", r(F.col("m") + 3e-10, 8))


@query("v3", ", g AS (SELECT ord, start, k % 5 = 0 AS p, unnest(range(0, floor((3600 + 600 + CASE WHEN k % 5 = 0 THEN 0 ELSE 600 END) / 300.0 + 1e-9)::BIGINT + 1)) AS i FROM v3) SELECT ord, i, round(start + (i / (1 / 300.0::DOUBLE) - 600), 4) AS grid_t FROM g")
def g2_onset_grid(spark: SparkSession, sf: str) -> DataFrame:
    g = response.onset_grid(V.stimuli(spark, sf), [], 1 / 300.0, 600.0, F.col("k") % 5 == 0)
    return g.select("ord", "i", r("grid_t", 4).alias("grid_t"))


@query("v2 v3", """, q AS (SELECT ord AS w, start + g.i * 900 AS gt, g.i FROM v3, range(5) g(i)), a AS (SELECT t, dff FROM v2 WHERE plane = 'click'), b AS (SELECT q.w, q.i, q.gt, lo.t AS lt, lo.dff AS ly, hi.t AS ht, hi.dff AS hy FROM q ASOF LEFT JOIN a lo ON q.gt >= lo.t ASOF LEFT JOIN a hi ON q.gt <= hi.t)
SELECT w, i, round(CASE WHEN lt = gt THEN ly WHEN ht - lt <= 7200 THEN ly + (gt - lt) * (hy - ly) / (ht - lt) END, 6) AS value_at FROM b""")
def g3_align_trace(spark: SparkSession, sf: str) -> DataFrame:
    q = V.stimuli(spark, sf).select(F.lit("click").alias("plane"), F.col("ord").alias("w"), "start", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(4).cast("long"))).alias("i"))
    q = q.withColumn("t", F.col("start") + F.col("i") * 900).drop("start")
    a = V.traces(spark, sf).filter("plane = 'click'").select("plane", "ord", "t", "dff")
    return interp.interpolate_supported(q, a, ["plane"], "t", "dff", 7200.0, 86400.0, "ord").select("w", "i", r("value_at").alias("value_at"))


@query("v2 v3", """, q AS (SELECT plane, ord AS w, start + g.i * 900 AS gt, g.i FROM v3, range(5) g(i), (SELECT DISTINCT plane FROM v2)), b AS (SELECT q.plane, q.w, q.i, q.gt, lo.t AS lt, lo.dff AS ly, hi.t AS ht, hi.dff AS hy FROM q ASOF LEFT JOIN v2 lo ON q.plane = lo.plane AND q.gt >= lo.t ASOF LEFT JOIN v2 hi ON q.plane = hi.plane AND q.gt <= hi.t)
SELECT plane, w, i, round(CASE WHEN lt = gt THEN ly WHEN ht - lt <= 7200 THEN ly + (gt - lt) * (hy - ly) / (ht - lt) END, 6) AS value_at FROM b""")
def g3_align_trace_planes(spark: SparkSession, sf: str) -> DataFrame:
    a = V.traces(spark, sf).select("plane", "ord", "t", "dff")
    q = V.stimuli(spark, sf).select(F.col("ord").alias("w"), "start", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(4).cast("long"))).alias("i"))
    q = q.withColumn("t", F.col("start") + F.col("i") * 900).drop("start").join(small(a.select("plane").distinct()))
    return interp.interpolate_supported(q, a, ["plane"], "t", "dff", 7200.0, 86400.0, "ord").select("plane", "w", "i", r("value_at").alias("value_at"))


@query("", "SELECT event_id, least(100, coalesce(a, b)) AS hz, coalesce(a = b, true) AND coalesce(a, b) > 0 AS valid FROM (SELECT event_id, CASE WHEN event_id % 3 > 0 THEN value END AS a, CASE WHEN event_id % 3 < 2 THEN value END AS b FROM events)")
def g4_sampling_rate(spark: SparkSession, sf: str) -> DataFrame:
    e = V.table(spark, sf, "events").select("event_id", F.when(F.col("event_id") % 3 > 0, F.col("value")).alias("a"), F.when(F.col("event_id") % 3 < 2, F.col("value")).alias("b"))
    one = F.coalesce("a", "b")
    return e.select("event_id", F.least(F.lit(100.0), one).alias("hz"), (F.coalesce(F.col("a") == F.col("b"), F.lit(True)) & (one > 0)).alias("valid"))


@query("clicks", ", e AS (SELECT session, min(t) AS a, max(t) AS z FROM clicks GROUP BY 1) SELECT session, ord, 'first' AS \"end\" FROM clicks JOIN e USING (session) WHERE t - a <= 200000 UNION ALL SELECT session, ord, 'last' FROM clicks JOIN e USING (session) WHERE z - t <= 200000")
def g6_endpoint_view(spark: SparkSession, sf: str) -> DataFrame:
    return report.endpoint_view(V.pulses(spark, sf, "click"), K, "t", 200000.0).select("session", "ord", "end")


@query("v3 v2", " SELECT p.plane, (SELECT min(start) FROM v3) <= z AND a <= (SELECT max(stop) FROM v3) AS overlap FROM (SELECT plane, min(t) AS a, max(t) AS z FROM v2 WHERE plane IN ('click', 'view') GROUP BY 1) p")
def j20_spans_overlap(spark: SparkSession, sf: str) -> DataFrame:
    return report.spans_overlap(_stim(spark, sf), V.traces(spark, sf), ["plane"], "start", "stop", "t")


@query("", "SELECT p_partkey, r_regionkey FROM part JOIN region ON contains(replace(lower(p_type || ' ' || p_name), ' ', ''), replace(lower(substr(r_name, 1, 1)), ' ', '')) OR contains(replace(lower(p_type || ' ' || p_name), ' ', ''), lower(r_regionkey || 'x'))")
def j17_plane_channels(spark: SparkSession, sf: str) -> DataFrame:
    p = V.table(spark, sf, "part").withColumn("label", F.concat_ws(" ", "p_type", "p_name"))
    g = V.table(spark, sf, "region")
    return stimlog.plane_channels(p, g, "label", [F.substring("r_name", 1, 1), F.concat(F.col("r_regionkey").cast("string"), F.lit("x"))]).select("p_partkey", "r_regionkey")


# stimulus logs

_ANGLES = (315, 359, 225, 90, 135, 270, 0, 45, 180)  # fixed values
_LOG = """, rk AS (SELECT *, row_number() OVER (PARTITION BY session, event_type ORDER BY ord) - 1 AS n, count(*) OVER (PARTITION BY session, event_type) AS c FROM ev),
lg AS (SELECT session, ord, ord AS frame, n, CASE event_type WHEN 'click' THEN 'MovieFrame' WHEN 'view' THEN 'Photodiode' WHEN 'purchase' THEN CASE WHEN n % 2 = 0 THEN 'GratingStart' ELSE 'GratingEnd' END WHEN 'error' THEN CASE WHEN n = c - 1 AND session % 2 = 0 THEN 'END' ELSE '' END ELSE 'Frame' END AS kind,
  CASE event_type WHEN 'click' THEN n % 4 + 1 WHEN 'view' THEN (value > 30)::INT WHEN 'purchase' THEN ([315, 359, 225, 90, 135, 270, 0, 45, 180])[(n // 2) % 9 + 1] END::DOUBLE AS number FROM rk)"""


def log_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Log lines (session, ord, frame, value) made from the events."""
    w = Window.partitionBy("session", "event_type")
    e = V.events(spark, sf).withColumns({"n": F.row_number().over(w.orderBy("ord")) - 1, "c": F.count("*").over(w)})
    angle = F.element_at(F.array(*[F.lit(a) for a in _ANGLES]), (F.floor(F.col("n") / 2) % 9 + 1).cast("int")).cast("string")
    text = (
        F.when(F.col("event_type") == "click", F.concat(F.lit("MovieFrame-"), (F.col("n") % 4 + 1).cast("string")))
        .when(F.col("event_type") == "view", F.concat(F.lit("Photodiode-"), (F.col("value") > 30).cast("int").cast("string")))
        .when(F.col("event_type") == "purchase", F.concat(F.when(F.col("n") % 2 == 0, "GratingStart-").otherwise("GratingEnd-"), angle))
        .when(F.col("event_type") == "error", F.when((F.col("n") == F.col("c") - 1) & (F.col("session") % 2 == 0), "END").otherwise(""))
        .otherwise("Frame")
    )
    return e.select("session", "ord", F.col("ord").alias("frame"), text.alias("value"))


def _log(spark, sf):
    return stimlog.parse_log(log_rows(spark, sf))


@query("ev", _LOG + " SELECT session, ord, kind, number FROM lg")
def s2_event_log(spark: SparkSession, sf: str) -> DataFrame:
    return _log(spark, sf).select("session", "ord", "kind", "number")


@query("ev", _LOG + " SELECT session, max(frame) FILTER (kind = 'END') AS end_frame, true AS agrees, max(frame) AS last_frame FROM lg GROUP BY 1")
def w17_session_end(spark: SparkSession, sf: str) -> DataFrame:
    return stimlog.session_end(_log(spark, sf), K)


_RUNS = _LOG + """, mf AS (SELECT session, ord, frame, number::INT AS counter, sum((number = 1)::INT) OVER (PARTITION BY session ORDER BY ord) AS run FROM lg WHERE kind = 'MovieFrame'),
ru AS (SELECT session, run, count(*) AS n_frames, min(frame) AS first_frame, max(frame) AS last_frame FROM mf GROUP BY 1, 2)"""


@query("ev", _RUNS + " SELECT session, run::BIGINT AS run, n_frames, first_frame, last_frame, false AS broken FROM ru")
def w13_movie_runs(spark: SparkSession, sf: str) -> DataFrame:
    return stimlog.movie_runs(_log(spark, sf), K)[1].withColumn("run", F.col("run").cast("long"))


@query("ev", _RUNS + """, fr AS (SELECT *, counter // 2 AS f FROM mf) SELECT session, ord, coalesce(f = lag(f) OVER w, false)::INT | coalesce(f = lead(f) OVER w, false)::INT AS shared FROM fr WINDOW w AS (PARTITION BY session, run ORDER BY ord)""")
def w16_shared_frames(spark: SparkSession, sf: str) -> DataFrame:
    frames = stimlog.movie_runs(_log(spark, sf), K)[0].withColumn("frame", F.floor(F.col("counter") / 2))
    return stimlog.shared_frame_flags(frames, ["session", "run"]).select("session", "ord", "shared")


_GR = _LOG + """, ge AS (SELECT *, lead(kind) OVER w AS nk, lead(number) OVER w AS na, lead(frame) OVER w AS nf FROM lg WHERE kind IN ('GratingStart', 'GratingEnd') WINDOW w AS (PARTITION BY session ORDER BY ord)),
gs AS (SELECT ge.session, ord, number AS angle, frame AS start_frame, coalesce(nf, l.last) AS stop_frame, coalesce(nk = 'GratingEnd' AND na = number, false) AS matched, row_number() OVER (PARTITION BY ge.session ORDER BY ord) - 1 AS n FROM ge JOIN (SELECT session, max(frame) AS last FROM lg GROUP BY 1) l ON l.session = ge.session WHERE kind = 'GratingStart')"""


@query("ev", _GR + " SELECT session, ord, angle, start_frame, stop_frame, matched, n // 9 AS block, n % 9 AS position FROM gs")
def w14_grating_blocks(spark: SparkSession, sf: str) -> DataFrame:
    return stimlog.grating_blocks(_log(spark, sf), K)


@query("ev", _GR + " SELECT session, n // 9 AS block, count(*) AS n, count(DISTINCT angle) AS n_angles, count(*) = 9 AND count(DISTINCT angle) = 9 AS \"full\" FROM gs GROUP BY ALL")
def w14_grating_sets(spark: SparkSession, sf: str) -> DataFrame:
    return stimlog.grating_set_report(stimlog.grating_blocks(_log(spark, sf), K), K)


@query("ev", _RUNS + """, st AS (SELECT session, frame - lag(frame) OVER (PARTITION BY session ORDER BY ord) AS d FROM mf), ca AS (SELECT session, median(d) FILTER (d > 0) AS c FROM st GROUP BY 1), en AS (SELECT session, max(frame) FILTER (kind = 'END') AS e, max(frame) AS l FROM lg GROUP BY 1),
nx AS (SELECT *, lead(first_frame) OVER (PARTITION BY session ORDER BY run) AS nf FROM ru)
SELECT session, run::BIGINT AS run, CASE WHEN nf IS NOT NULL THEN 'next_run' WHEN e IS NOT NULL THEN 'session_end' ELSE 'cadence' END AS source, coalesce(nf, e, least(last_frame + coalesce(c, 0), l))::DOUBLE AS stop_frame, nf IS NULL AND e IS NULL AS partial FROM nx JOIN ca USING (session) JOIN en USING (session)""")
def w15_stop_frames(spark: SparkSession, sf: str) -> DataFrame:
    log = _log(spark, sf)
    frames, runs = stimlog.movie_runs(log, K)
    ends = stimlog.session_end(log, K).select("session", "end_frame", F.col("last_frame").alias("session_last"))
    return stimlog.stop_frames(runs, frames, ends, K).select("session", F.col("run").cast("long").alias("run"), "source", "stop_frame", "partial")


@query("ev", _LOG + """, ph AS (SELECT *, number = 1 AS state, lag(number) OVER (PARTITION BY session ORDER BY ord) AS p FROM lg WHERE kind = 'Photodiode'), la AS (SELECT session, arg_max(state, ord) AS h, max(ord) AS o FROM ph GROUP BY 1), en AS (SELECT session, max(frame) FILTER (kind = 'END') AS e FROM lg GROUP BY 1)
SELECT session, ord, frame, state FROM ph WHERE (p IS NULL AND state) OR p <> number UNION ALL SELECT session, o + 1, e + 1, false FROM la JOIN en USING (session) WHERE h AND e IS NOT NULL""")
def w3_log_transitions(spark: SparkSession, sf: str) -> DataFrame:
    return stimlog.log_transitions(_log(spark, sf), K, initial_low=True, terminal_low=True)


@query("ev", _LOG + """, o AS (SELECT session, kind, row_number() OVER (PARTITION BY session ORDER BY ord) - 1 AS n FROM lg WHERE kind IN ('GratingStart', 'MovieFrame')), t AS (SELECT session, CASE WHEN ord % 3 = 0 THEN 'GratingStart' ELSE 'MovieFrame' END AS kind, row_number() OVER (PARTITION BY session ORDER BY ord) - 1 AS n FROM ev WHERE event_type = 'signup')
SELECT coalesce(o.session, t.session) AS session, coalesce(o.n, t.n) AS n, o.kind AS observed_kind, t.kind AS table_kind, o.kind = t.kind AS agrees FROM o FULL JOIN t ON o.session = t.session AND o.n = t.n""")
def j13_match_presentations(spark: SparkSession, sf: str) -> DataFrame:
    observed = _log(spark, sf).filter("kind in ('GratingStart', 'MovieFrame')")
    t = V.events(spark, sf).filter("event_type = 'signup'").select("session", F.col("ord").alias("row_idx"), F.when(F.col("ord") % 3 == 0, "GratingStart").otherwise("MovieFrame").alias("kind"))
    return stimlog.match_presentations(observed, t, K)


@query("ev", """, b AS (SELECT session, max(t) AS a FROM ev WHERE event_type = 'view' AND session % 2 = 0 GROUP BY 1) SELECT e.session, e.ord, round(CASE WHEN t + 90000 > a + 50000 THEN a ELSE t + 90000 END, 6) AS stop, coalesce(t + 90000 > a + 50000, false) AS partial FROM ev e LEFT JOIN b USING (session) WHERE event_type = 'click' AND (a IS NULL OR t <= a)""")
def w18_clip_interrupted(spark: SparkSession, sf: str) -> DataFrame:
    i = V.pulses(spark, sf, "click").select("session", "ord", F.col("t").alias("start"), (F.col("t") + 90000).alias("stop"))
    b = V.pulses(spark, sf, "view").filter("session % 2 = 0").groupBy("session").agg(F.max("t").alias("last_anchor"))
    return stimlog.clip_interrupted(i, b, K, 50000.0).select("session", "ord", r("stop").alias("stop"), "partial")


_G7 = """, m AS (SELECT session, t, row_number() OVER (PARTITION BY session ORDER BY ord) - 1 AS n FROM clicks), p AS (SELECT session, t, row_number() OVER (PARTITION BY session ORDER BY ord) - 1 AS n FROM looks),
c AS (SELECT x.session, 11 + x.session % 4 AS e, (SELECT count(*) FROM m WHERE m.session = x.session) AS cm, (SELECT count(*) FROM p WHERE p.session = x.session) AS cp FROM (SELECT DISTINCT session FROM ev) x),
ch AS (SELECT session, CASE WHEN cm = e THEN 'log' WHEN cp = e THEN 'pulses' ELSE 'none' END AS source FROM c),
sr AS (SELECT m.session, m.n, m.t, source FROM m JOIN ch USING (session) WHERE source = 'log' UNION ALL SELECT p.session, p.n, p.t, source FROM p JOIN ch USING (session) WHERE source = 'pulses')"""


def _starts(spark, sf):
    from ..operators.ordered import with_ordinal

    number = lambda kind: with_ordinal(V.pulses(spark, sf, kind), K, "ord", "n")
    expected = V.events(spark, sf).select("session").distinct().withColumn("n_expected", 11 + F.col("session") % 4)
    return stimlog.stimulus_starts(number("click"), number("view"), expected, K)


@query("clicks looks", _G7 + " SELECT session, source FROM ch")
def g7_start_source(spark: SparkSession, sf: str) -> DataFrame:
    return _starts(spark, sf)[1]


@query("clicks looks", _G7 + ", tb AS (SELECT session, row_number() OVER (PARTITION BY session ORDER BY ord) - 1 AS n, k + 1.5::DOUBLE AS d, CASE WHEN k % 3 > 0 THEN 'type' || k % 3 END AS bt FROM ev WHERE event_type = 'signup') SELECT sr.session, sr.n, round(sr.t, 6) AS start, round(sr.t + d, 6) AS stop, coalesce(bt, 'gratings') AS table_name FROM sr JOIN tb USING (session, n)")
def g8_presentation_intervals(spark: SparkSession, sf: str) -> DataFrame:
    t = V.events(spark, sf).filter("event_type = 'signup'").select("session", F.col("ord").alias("row_idx"), (F.col("k") + 1.5).alias("duration"), F.when(F.col("k") % 3 > 0, F.concat(F.lit("type"), (F.col("k") % 3).cast("string"))).alias("block_type"))
    out = stimlog.presentation_intervals(_starts(spark, sf)[0], t, K)
    return out.select("session", "n", r("start").alias("start"), r("stop").alias("stop"), "table_name")


@query("ev", _RUNS + ", mx AS (SELECT session, run, max(counter) AS l FROM mf GROUP BY 1, 2) SELECT session, run::BIGINT AS run, i, round(1 + i / 60.0::DOUBLE * 30.0, 6) AS grid_frame FROM (SELECT *, unnest(range(0, greatest(ceil(l / 30.0::DOUBLE * 60) - 1, 0)::BIGINT + 1)) AS i FROM mx)")
def g1_movie_grid(spark: SparkSession, sf: str) -> DataFrame:
    frames = stimlog.movie_runs(_log(spark, sf), K)[0]
    return stimlog.movie_grid(frames, ["session", "run"], 60.0).select("session", F.col("run").cast("long").alias("run"), "i", r("grid_frame").alias("grid_frame"))


@query("ev", _RUNS + " SELECT session, run::BIGINT AS run, row_number() OVER (PARTITION BY session, run ORDER BY ord) - 1 AS pos, ord, counter FROM mf")
def s16_ragged_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    frames = stimlog.movie_runs(_log(spark, sf), K)[0].withColumn("run", F.col("run").cast("long"))
    packed = stimlog.pack_ragged(frames, ["session", "run"], "ord", ["counter"], "frames")
    return stimlog.explode_ragged(packed, ["session", "run"], "frames").select("session", "run", F.col("pos").cast("long").alias("pos"), "ord", "counter")


@query("v3", " SELECT dense_rank() OVER (ORDER BY direction) AS position, direction FROM (SELECT DISTINCT direction FROM v3)")
def t5_sorted_positions(spark: SparkSession, sf: str) -> DataFrame:
    d = V.stimuli(spark, sf).select("direction").distinct()  # a few distinct values
    return d.select(F.dense_rank().over(Window.orderBy("direction")).cast("long").alias("position"), "direction")


@query("v3 ev", " SELECT 'stim' AS table_name, ord, start, direction, NULL::BIGINT AS session FROM v3 UNION ALL SELECT 'click', ord, t, NULL, session FROM ev WHERE event_type = 'click'")
def t7_union_intervals(spark: SparkSession, sf: str) -> DataFrame:
    a = V.stimuli(spark, sf).select(F.lit("stim").alias("table_name"), "ord", "start", "direction")
    b = V.pulses(spark, sf, "click").select(F.lit("click").alias("table_name"), "ord", F.col("t").alias("start"), "session")
    return a.unionByName(b, allowMissingColumns=True)


@query("clicks", " SELECT vec_id AS frame, 'fit' AS side FROM embeddings WHERE vec_id NOT IN (SELECT ord FROM clicks) UNION ALL SELECT ord, 'time' FROM clicks WHERE ord NOT IN (SELECT vec_id FROM embeddings)")
def t8_frame_differences(spark: SparkSession, sf: str) -> DataFrame:
    f = V.table(spark, sf, "embeddings").select(F.col("vec_id").alias("frame"))
    c = V.pulses(spark, sf, "click").select(F.col("ord").alias("frame"))
    return f.join(c, "frame", "left_anti").withColumn("side", F.lit("fit")).unionByName(c.join(f, "frame", "left_anti").withColumn("side", F.lit("time")))


@query("v2", " SELECT plane, roi, row_number() OVER (ORDER BY plane, roi) AS column_idx FROM (SELECT DISTINCT plane, roi FROM v2)")
def t10_roi_columns(spark: SparkSession, sf: str) -> DataFrame:
    cells = V.traces(spark, sf).select("plane", "roi").distinct()  # one row per cell, not per sample
    return cells.withColumn("column_idx", F.row_number().over(Window.orderBy("plane", "roi")).cast("long"))


@query("v2 v3", " SELECT v3.ord FROM v3 WHERE EXISTS (SELECT 1 FROM v2 WHERE v2.plane = 'error' AND v2.t >= v3.start AND v2.t < v3.stop)")
def j19_windows_with_samples(spark: SparkSession, sf: str) -> DataFrame:
    s = V.stimuli(spark, sf).withColumn("plane", F.lit("error"))
    return with_samples(s, V.traces(spark, sf), ["plane"], ["ord"])


