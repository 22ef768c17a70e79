"""Queries of the interpolation, pairing, signal and line operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import interp, lines, signals
from ..operators.ordered import join_on, window_samples, with_ordinal
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


def _named(spark, sf, kind, *cols):
    return V.pulses(spark, sf, kind).select(*cols)


_TRIALS = """, s AS (SELECT session, t AS a, row_number() OVER (PARTITION BY session ORDER BY ord) - 1 AS trial FROM starts), e AS (SELECT session, t AS b, row_number() OVER (PARTITION BY session ORDER BY ord) - 1 AS trial FROM ends), tr AS (SELECT s.*, b FROM s LEFT JOIN e USING (session, trial)) """


@query("starts ends looks", _TRIALS + "SELECT l.session, l.ord, CASE WHEN l.t > b THEN -1 ELSE trial END AS trial FROM looks l ASOF LEFT JOIN tr ON l.session = tr.session AND l.t >= tr.a")
def j3_assign_trial(spark: SparkSession, sf: str) -> DataFrame:
    return interp.assign_trial(V.pulses(spark, sf, "view"), *V.trial_marks(spark, sf), K).select("session", "ord", "trial")


_PAIR = """, l AS (SELECT *, value > 30 AS state, row_number() OVER (PARTITION BY session ORDER BY ord) - 1 AS pair FROM ev WHERE event_type = 'click'),
rr AS (SELECT *, value > 30 AS state, row_number() OVER (PARTITION BY session ORDER BY ord) - 1 AS pair FROM ev WHERE event_type = 'view'),
p AS (SELECT coalesce(l.session, rr.session) AS session, coalesce(l.pair, rr.pair) AS pair, l.ord AS lo, rr.ord AS ro, l.t AS lt, rr.t AS rt, l.state AS ls, rr.state AS rs FROM l FULL JOIN rr ON l.session = rr.session AND l.pair = rr.pair)"""


def _two(spark, sf):
    e = V.events(spark, sf).withColumn("state", F.col("value") > 30).select("session", "ord", "t", "state", "event_type")
    return [e.filter(F.col("event_type") == x).drop("event_type") for x in ("click", "view")]


@query("ev", _PAIR + " SELECT session, pair, lo AS l_ord, ro AS r_ord FROM p")
def j1_pair_by_order(spark: SparkSession, sf: str) -> DataFrame:
    return interp.pair_by_order(*_two(spark, sf), K).select("session", "pair", "l_ord", "r_ord")


@query("ev", _PAIR + """, q AS (SELECT *, ls <> rs OR lt <= lag(lt) OVER w OR rt <= lag(rt) OVER w OR ls = lag(ls) OVER w AS bad FROM p WINDOW w AS (PARTITION BY session ORDER BY pair))
SELECT session, count(lt) AS n_left, count(rt) AS n_right, min(pair) FILTER (bad) AS first_bad, count(lt) = count(rt) AND min(pair) FILTER (bad) IS NULL AS matched FROM q GROUP BY 1""")
def j1_pairing_report(spark: SparkSession, sf: str) -> DataFrame:
    return interp.pairing_report(interp.pair_by_order(*_two(spark, sf), K), K)


@query("ev", """, l AS (SELECT session, ord, value > 30 AS state, row_number() OVER (PARTITION BY session ORDER BY ord DESC) AS d, count(*) OVER (PARTITION BY session) AS n FROM ev WHERE event_type = 'click'),
f AS (SELECT *, row_number() OVER (PARTITION BY session ORDER BY ord) AS frame FROM l),
b AS (SELECT session FROM f GROUP BY 1 HAVING max(n) = session % 3 + max(n) AND NOT bool_or(state) FILTER (d = 1) AND bool_or(state) FILTER (d = 2))
SELECT session, ord FROM f WHERE NOT (d <= 2 AND session IN (FROM b))""")
def j2_drop_terminal_blip(spark: SparkSession, sf: str) -> DataFrame:
    left = with_ordinal(_two(spark, sf)[0], K, "ord", "frame")
    n = left.groupBy("session").agg(F.count("*").alias("n"))
    right = join_on(left, n, K).filter((F.col("session") % 3 != 0) | (F.col("frame") < F.col("n") - 2))
    return interp.drop_terminal_blip(left, right, K).select("session", "ord")


@query("v2 v3", " SELECT v3.ord AS w, v2.ord FROM v3 JOIN v2 ON v2.t >= v3.start AND v2.t < v3.stop AND v2.plane = 'click'")
def j4_window_samples(spark: SparkSession, sf: str) -> DataFrame:
    w = V.stimuli(spark, sf).select(F.col("ord").alias("w"), "start", "stop", F.lit("click").alias("plane"))
    return window_samples(w, V.traces(spark, sf), ["plane"], "start", "stop", "t", HOUR).select("w", "ord")


_KN = """, kn AS (SELECT session, row_number() OVER (PARTITION BY session ORDER BY ord) - 1 AS k, t FROM clicks)"""


@query("clicks v5", _KN + """, n AS (SELECT *, lead(t) OVER (PARTITION BY session ORDER BY k) AS nt FROM kn)
SELECT v.session, v.ord, round(CASE WHEN v.line > 300 THEN NULL WHEN nt IS NOT NULL THEN n.t + ((v.line - 1) / 20.0::DOUBLE - n.k) * (nt - n.t) WHEN (v.line - 1) % 20 = 0 THEN n.t END + 3e-8, 6) AS mapped_t
FROM v5 v LEFT JOIN n ON v.session = n.session AND n.k = (v.line - 1) // 20""")
def j5_uniform_knots(spark: SparkSession, sf: str) -> DataFrame:
    k = with_ordinal(V.pulses(spark, sf, "click"), K, "ord", "k").select("session", "k", "t", F.lit(False).alias("estimated"))
    s = V.lines(spark, sf).select("session", "ord", "line", F.lit(300).alias("most"))
    return interp.uniform_knots(s, k, K, 20, limit="most").select("session", "ord", r(F.col("mapped_t") + 3e-8).alias("mapped_t"))


@query("clicks v5", _KN + """, lim AS (SELECT session, max(k) AS m FROM kn GROUP BY 1), n AS (SELECT *, lead(t) OVER (PARTITION BY session ORDER BY k) AS nt FROM kn),
q AS (SELECT v.*, m, greatest(0.0, least((v.line - 1) / 12.5::DOUBLE, m)) AS a FROM v5 v LEFT JOIN lim USING (session))
SELECT q.session, q.ord, round(coalesce(n.t + (a - n.k) * (nt - n.t), n.t) + 3e-8, 6) AS mapped_t FROM q LEFT JOIN n ON q.session = n.session AND n.k = least(floor(a), m)""")
def j6_trial_knots(spark: SparkSession, sf: str) -> DataFrame:
    k = with_ordinal(V.pulses(spark, sf, "click"), K, "ord", "k").select("session", "k", F.col("t").alias("knot_t"), F.lit(12.5).alias("spacing"))
    return interp.trial_knots(V.lines(spark, sf).select("session", "ord", "line"), k, K).select("session", "ord", r(F.col("mapped_t") + 3e-8).alias("mapped_t"))


_BR = """, br AS (SELECT q.session, q.ord, lo.ord AS lx, lo.y AS ly, hi.ord AS hx, hi.y AS hy
FROM q ASOF LEFT JOIN a lo ON q.session = lo.session AND q.ord >= lo.ord ASOF LEFT JOIN a hi ON q.session = hi.session AND q.ord <= hi.ord)"""
_CL = ", a AS (SELECT session, ord, t AS y FROM clicks), q AS (SELECT session, ord FROM looks UNION ALL SELECT session, ord FROM clicks WHERE ord % 2 = 0)" + _BR
_LIN = "CASE WHEN lx = ord THEN ly ELSE ly + (ord - lx) * (hy - ly) / (hx - lx)::DOUBLE END"


def _queries(spark, sf):
    even = V.pulses(spark, sf, "click").filter("ord % 2 = 0")
    return V.pulses(spark, sf, "view").unionByName(even).select("session", "ord")


def _anchors(spark, sf):
    return V.pulses(spark, sf, "click").select("session", "ord", F.col("t").alias("y"))


@query("clicks looks", _CL + f" SELECT session, ord, round({_LIN} + 3e-8, 6) AS value_at FROM br")
def j7_interpolate(spark: SparkSession, sf: str) -> DataFrame:
    return interp.interpolate(_queries(spark, sf), _anchors(spark, sf), K, "ord", "y", 1000).select("session", "ord", r(F.col("value_at") + 3e-8).alias("value_at"))


_END = """, rk AS (SELECT *, row_number() OVER (PARTITION BY session ORDER BY ord) AS n1, row_number() OVER (PARTITION BY session ORDER BY ord DESC) AS n2 FROM a),
en AS (SELECT session, min(ord) AS fx, arg_min(y, ord) AS fy, max(ord) AS zx, arg_max(y, ord) AS zy, regr_slope(y, ord) FILTER (n1 <= 20) AS fs, regr_slope(y, ord) FILTER (n2 <= 20) AS zs FROM rk GROUP BY 1),
ex AS (SELECT br.*, greatest(fx - ord, ord - zx, 0) AS beyond, CASE WHEN ord < fx THEN CASE WHEN fs > 0 THEN fy + fs * (ord - fx) END ELSE CASE WHEN zs > 0 THEN zy + zs * (ord - zx) END END AS outside FROM br LEFT JOIN en USING (session))"""


@query("clicks looks", _CL + _END + f" SELECT session, ord, beyond::DOUBLE AS beyond, beyond > 0 AS extrapolated, round(CASE WHEN beyond > 0 THEN CASE WHEN beyond <= 200 THEN outside END ELSE {_LIN} END + 3e-8, 6) AS value_at FROM ex")
def j8_boundaries(spark: SparkSession, sf: str) -> DataFrame:
    return interp.map_boundaries(_queries(spark, sf), _anchors(spark, sf), K, "ord", "y", 200, width=1000).select("session", "ord", "beyond", "extrapolated", r(F.col("value_at") + 3e-8).alias("value_at"))


@query("clicks looks", _CL + _END + f""", st AS (SELECT *, CASE WHEN lx = ord THEN 0 WHEN hx - lx <= 700 THEN 1 WHEN beyond > 0 AND beyond <= 200 AND outside IS NOT NULL THEN 2 ELSE 3 END AS status FROM ex)
SELECT session, ord, status, round(CASE WHEN status = 2 THEN outside WHEN status < 2 THEN {_LIN} END + 3e-8, 6) AS value_at FROM st""")
def j9_frames_status(spark: SparkSession, sf: str) -> DataFrame:
    return interp.map_with_status(_queries(spark, sf), _anchors(spark, sf), K, "ord", "y", 700, 200, width=1000).select("session", "ord", "status", r(F.col("value_at") + 3e-8).alias("value_at"))


@query("ev", ", a AS (SELECT session, ord, CASE WHEN ord % 5 <> 0 THEN value END AS y FROM ev WHERE event_type = 'click'), q AS (SELECT session, ord FROM ev WHERE event_type IN ('view', 'click'))" + _BR + f" SELECT session, ord, round(CASE WHEN lx = ord THEN ly WHEN hx - lx <= 800 THEN {_LIN} END, 6) AS value_at FROM br")
def j10_supported(spark: SparkSession, sf: str) -> DataFrame:
    e = V.events(spark, sf)
    a = e.filter("event_type = 'click'").select("session", "ord", F.when(F.col("ord") % 5 != 0, F.col("value")).alias("y"))
    q = e.filter("event_type in ('view', 'click')").select("session", "ord")
    return interp.interpolate_supported(q, a, K, "ord", "y", 800, 1000).select("session", "ord", r("value_at").alias("value_at"))


@query("clicks", ", d AS (SELECT session, ord - lag(ord) OVER (PARTITION BY session ORDER BY ord) AS g FROM clicks) SELECT session, 3 * median(g) AS max_gap FROM d GROUP BY 1")
def j9_default_gap(spark: SparkSession, sf: str) -> DataFrame:
    return interp.default_gap(V.pulses(spark, sf, "click"), K, "ord")


@query("ev", " SELECT vec_id AS frame, label, round(t, 6) AS t FROM embeddings JOIN ev ON ord = vec_id WHERE ord % 11 <> 0")
def j11_join_frames(spark: SparkSession, sf: str) -> DataFrame:
    fits = V.table(spark, sf, "embeddings").select(F.col("vec_id").alias("frame"), "label")
    times = V.events(spark, sf).filter("ord % 11 <> 0").select(F.col("ord").alias("frame"), r("t").alias("t"))
    return interp.join_frames(fits, times, ["frame"])[0]


@query("ev", """ SELECT (SELECT count(*) FROM embeddings WHERE vec_id NOT IN (SELECT ord FROM ev WHERE ord % 11 <> 0)) AS fit_only,
(SELECT count(*) FROM ev WHERE ord % 11 <> 0 AND ord NOT IN (SELECT vec_id FROM embeddings)) AS time_only, false AS valid""")
def j11_frames_report(spark: SparkSession, sf: str) -> DataFrame:
    fits = V.table(spark, sf, "embeddings").select(F.col("vec_id").alias("frame"), "label")
    times = V.events(spark, sf).filter("ord % 11 <> 0").select(F.col("ord").alias("frame"), "t")
    return interp.join_frames(fits, times, ["frame"])[1]


@query("ev", _PAIR + " SELECT session, pair, lo AS l_ord, ro AS r_ord FROM p WHERE lo IS NOT NULL AND ro IS NOT NULL")
def j12_zip_truncate(spark: SparkSession, sf: str) -> DataFrame:
    return interp.zip_truncate(*_two(spark, sf), K)[0].select("session", "pair", "l_ord", "r_ord")


@query("", """WITH o AS (SELECT o_orderkey, c_mktsegment AS seg, epoch(o_orderdate) + o_orderkey % 97 AS tm FROM orders JOIN customer ON o_custkey = c_custkey),
l AS (SELECT * FROM o WHERE o_orderkey % 2 = 0), q AS (SELECT seg, tm, min(o_orderkey) AS id FROM o WHERE o_orderkey % 2 = 1 GROUP BY 1, 2),
b AS (SELECT l.*, lo.tm AS la, lo.id AS li, hi.tm AS ha, hi.id AS hi_ FROM l ASOF LEFT JOIN q lo ON l.seg = lo.seg AND l.tm >= lo.tm ASOF LEFT JOIN q hi ON l.seg = hi.seg AND l.tm <= hi.tm)
SELECT o_orderkey, CASE WHEN ha IS NULL OR tm - la < ha - tm THEN li WHEN la IS NULL OR ha - tm < tm - la THEN hi_ ELSE least(li, hi_) END AS nearest, least(tm - la, ha - tm)::DOUBLE AS distance FROM b""")
def j14_nearest_session(spark: SparkSession, sf: str) -> DataFrame:
    c = V.table(spark, sf, "customer").select("c_custkey", F.col("c_mktsegment").alias("seg"))
    o = V.table(spark, sf, "orders").join(c, F.col("o_custkey") == F.col("c_custkey"))
    o = o.select("o_orderkey", "seg", (F.unix_timestamp(F.col("o_orderdate").cast("timestamp")) + F.col("o_orderkey") % 97).cast("double").alias("at"))
    right = o.filter("o_orderkey % 2 = 1").withColumnRenamed("o_orderkey", "id")
    return interp.nearest_session(o.filter("o_orderkey % 2 = 0"), right, ["seg"], "at", "id").select("o_orderkey", "nearest", "distance")


@query("v1", """ SELECT session, ord, (SELECT arg_min(i, abs(level - g) + i * 1e-9) FROM (VALUES (0, 0.0), (1, 25.0), (2, 60.0), (3, 200.0)) x(i, g)) AS grid_index FROM v1""")
def j15_nearest_grid(spark: SparkSession, sf: str) -> DataFrame:
    return interp.nearest_grid(V.samples(spark, sf), "level", [0.0, 25.0, 60.0, 200.0]).select("session", "ord", "grid_index")


_UN = """, d AS (SELECT *, counter - lag(counter) OVER (PARTITION BY session ORDER BY ord) AS df FROM v1),
u AS (SELECT *, sum(CASE WHEN df IS NULL THEN counter ELSE ((df + 32768) % 65536 + 65536) % 65536 - 32768 END) OVER (PARTITION BY session ORDER BY ord) AS un FROM d)"""


@query("v1", _UN + " SELECT session, ord, un::BIGINT AS unwrapped FROM u")
def w19_unwrap_counter(spark: SparkSession, sf: str) -> DataFrame:
    return signals.unwrap_counter(V.samples(spark, sf), K, "counter", width=500).select("session", "ord", F.col("unwrapped").cast("long").alias("unwrapped"))


@query("v1", _UN + ", n AS (SELECT *, lead(un) OVER w - un AS du, lead(t) OVER w - t AS dt FROM u WINDOW w AS (PARTITION BY session ORDER BY ord)) SELECT session, ord, round(du * 2 * pi() / 8192, 6) AS rotation, round(du * 2 * pi() / 8192 * 10 / dt, 6) AS speed FROM n WHERE dt > 0")
def w20_interval_speed(spark: SparkSession, sf: str) -> DataFrame:
    u = signals.unwrap_counter(V.samples(spark, sf), K, "counter")
    return signals.interval_speed(u, K).select("session", "ord", r("rotation").alias("rotation"), r("speed").alias("speed"))


_EYE = """WITH e AS (SELECT vec_id AS frame, CASE WHEN vec_id % 37 <> 0 THEN abs(embedding[8])::DOUBLE END AS ew, abs(embedding[9])::DOUBLE AS eh, abs(embedding[13])::DOUBLE AS pw, abs(embedding[14])::DOUBLE AS ph FROM embeddings),
a AS (SELECT *, pi() * ew * eh AS ea, CASE WHEN pw IS NOT NULL AND ph IS NOT NULL THEN pi() * greatest(pw, ph) * greatest(pw, ph) END AS pa FROM e),
s AS (SELECT *, coalesce(abs(ea - avg(ea) OVER ()) / nullif(stddev_pop(ea) OVER (), 0) > 3, false) OR coalesce(abs(pa - avg(pa) OVER ()) / nullif(stddev_pop(pa) OVER (), 0) > 3, false) AS o FROM a),
b AS (SELECT *, bool_or(o OR ew IS NULL) OVER (ORDER BY frame ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS blink FROM s)
"""


def _fits(spark, sf):
    at = lambda k: F.abs(F.element_at("embedding", k)).cast("double")
    return V.table(spark, sf, "embeddings").select(F.lit(1).alias("session"), F.col("vec_id").alias("frame"), F.when(F.col("vec_id") % 37 != 0, at(8)).alias("eye_width"), at(9).alias("eye_height"), at(13).alias("pupil_width"), at(14).alias("pupil_height"))


@query("", _EYE + "SELECT frame, o AS is_outlier FROM s")
def a29_outliers(spark: SparkSession, sf: str) -> DataFrame:
    return signals.tracking_metrics(_fits(spark, sf), K).select("frame", "is_outlier")


@query("", _EYE + "SELECT frame, blink AS likely_blink, round(ea, 8) AS eye_area_raw, round(CASE WHEN blink THEN -1.0 ELSE pa END, 8) AS pupil_area FROM b")
def w21_tracking_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return signals.tracking_metrics(_fits(spark, sf), K).select("frame", "likely_blink", r("eye_area_raw", 8).alias("eye_area_raw"), r("pupil_area", 8).alias("pupil_area"))


@query("", "SELECT vec_id AS frame, bool_or(label = 0) OVER (ORDER BY vec_id ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS dilated FROM embeddings")
def w22_dilate(spark: SparkSession, sf: str) -> DataFrame:
    e = V.table(spark, sf, "embeddings").select(F.lit(1).alias("session"), F.col("vec_id").alias("frame"), (F.col("label") == 0).alias("flag"))
    return signals.dilate(e, K, "flag", 3, stretch=64).select("frame", "dilated")


@query("v2", """ SELECT plane, s AS slot, count(dff) AS n_cells, round(sum(dff * (f0 + 1e-6)) / sum(f0) FILTER (dff IS NOT NULL) + 3e-10, 8) AS ratio FROM (SELECT *, ord // 20 AS s FROM v2) GROUP BY 1, 2""")
def a12_population_ratio(spark: SparkSession, sf: str) -> DataFrame:
    t = V.traces(spark, sf).withColumn("slot", F.floor(F.col("ord") / 20))
    return signals.population_ratio(t, ["plane", "slot"]).select("plane", "slot", "n_cells", r(F.col("ratio") + 3e-10, 8).alias("ratio"))


@query("v5", ", d AS (SELECT session, t - lag(t) OVER (PARTITION BY session, trial ORDER BY ord) AS d FROM v5) SELECT session, round(median(d) FILTER (d > 0), 6) AS period FROM d GROUP BY 1")
def a18_median_period(spark: SparkSession, sf: str) -> DataFrame:
    return signals.median_period(V.lines(spark, sf), K, ["trial"]).select("session", r("period").alias("period"))


@query("v5 ev", """, b AS (SELECT v5.session, v5.trial, v5.ord, e.value FROM v5 JOIN ev e USING (session, ord)),
m AS (SELECT *, median(value) OVER (PARTITION BY session, trial ORDER BY ord ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS md FROM b),
lo AS (SELECT *, min(md) OVER (PARTITION BY session, trial ORDER BY ord ROWS BETWEEN 3 PRECEDING AND 2 FOLLOWING) AS l FROM m),
h AS (SELECT *, max(l) OVER (PARTITION BY session, trial ORDER BY ord ROWS BETWEEN 3 PRECEDING AND 2 FOLLOWING) AS f0 FROM lo)
SELECT session, ord, round(f0, 6) AS f0, round((value - f0) / nullif(f0, 0), 6) AS dff FROM h""")
def a31_baseline(spark: SparkSession, sf: str) -> DataFrame:
    t = join_on(V.lines(spark, sf).select("session", "trial", "ord"), V.events(spark, sf).select("session", "ord", "value"), ["session", "ord"])
    return signals.baseline(t, ["session", "trial"], "value", 3, 6).select("session", "ord", r("f0").alias("f0"), r("dff").alias("dff"))


# lines, cycles and files


@query("v5", " SELECT session, trial, ceil(max(line) / 30.0::DOUBLE)::BIGINT AS expected FROM v5 GROUP BY 1, 2")
def a19_expected_cycles(spark: SparkSession, sf: str) -> DataFrame:
    return lines.expected_cycles(V.lines(spark, sf), ["session", "trial"], 30.0)


_CYC = """, pp AS (SELECT s.session, s.trial, s.ord, s.t, s.line FROM v5 s), cs AS (SELECT c.session, v.trial, c.ord, c.t FROM clicks c JOIN v5 v USING (session, ord)),
rk AS (SELECT *, row_number() OVER (PARTITION BY session, trial ORDER BY ord) AS cycle, count(*) OVER (PARTITION BY session, trial) AS n, lead(t) OVER (PARTITION BY session, trial ORDER BY ord) AS nx, min(t) OVER (PARTITION BY session, trial) AS f, max(t) OVER (PARTITION BY session, trial) AS z FROM cs),
bd AS (SELECT session, trial, cycle, t AS a, coalesce(nx, t + CASE WHEN n > 1 THEN (z - f) / (n - 1) ELSE 0 END) AS b, n FROM rk),
ln AS (SELECT session, trial, ord, line - trial * 140 AS line FROM pp),
mx AS (SELECT session, trial, max(line) AS m, min(line) AS lo, count(*) AS tot FROM ln GROUP BY 1, 2),
pt AS (SELECT session, trial, max(n) AS n, min(a) AS fa, max(b) AS zb FROM bd GROUP BY 1, 2)"""


def _trial_lines(spark, sf):
    return V.lines(spark, sf).withColumn("line", F.col("line") - F.col("trial") * 140).drop("t")


def _bounds(spark, sf):
    starts = join_on(V.pulses(spark, sf, "click"), V.lines(spark, sf).select("session", "ord", "trial"), ["session", "ord"])
    return lines.cycle_bounds(starts, ["session", "trial"])


@query("v5 clicks", _CYC + " SELECT session, trial, m AS max_line, coalesce(n, 0) AS n_cycles, round(m / n, 6) AS lines_per_cycle FROM mx LEFT JOIN pt USING (session, trial)")
def a19_effective_lines(spark: SparkSession, sf: str) -> DataFrame:
    c = _bounds(spark, sf).groupBy("session", "trial").agg(F.max("n_cycles").alias("n_cycles"))
    return lines.effective_lines(_trial_lines(spark, sf), c, ["session", "trial"]).select("session", "trial", "max_line", "n_cycles", r("lines_per_cycle").alias("lines_per_cycle"))


@query("v5 clicks", _CYC + """, q AS (SELECT ln.*, m, tot, n, fa, zb, ceil(line / (m::DOUBLE / n)) AS cycle, ceil(m / (m::DOUBLE / n)) <> n AS even FROM ln JOIN mx USING (session, trial) LEFT JOIN pt USING (session, trial)),
w AS (SELECT *, row_number() OVER (PARTITION BY session, trial, cycle ORDER BY ord) - 1 AS k, count(*) OVER (PARTITION BY session, trial, cycle) AS mm, row_number() OVER (PARTITION BY session, trial ORDER BY ord) - 1 AS rn FROM q)
SELECT w.session, w.ord, round(CASE WHEN even THEN fa + rn * (zb - fa) / greatest(tot - 1, 1) ELSE a + k * (b - a) / CASE WHEN w.cycle = w.n THEN greatest(mm - 1, 1) ELSE mm END END + 3e-8, 6) AS mapped_t
FROM w LEFT JOIN bd ON w.session = bd.session AND w.trial = bd.trial AND w.cycle = bd.cycle""")
def w10_primary_timestamps(spark: SparkSession, sf: str) -> DataFrame:
    return lines.primary_timestamps(_trial_lines(spark, sf), _bounds(spark, sf), ["session", "trial"]).select("session", "ord", r(F.col("mapped_t") + 3e-8).alias("mapped_t"))


@query("v5 clicks", _CYC + ", kn AS (SELECT session, trial, cycle - 1 AS k, a AS t FROM bd UNION ALL SELECT session, trial, cycle, b FROM bd WHERE cycle = n) SELECT session, trial, k, round(1 + k * (m::DOUBLE / n), 6) AS line, round(t + 3e-8, 6) AS t FROM kn JOIN mx USING (session, trial) JOIN pt USING (session, trial)")
def w11_line_time_map(spark: SparkSession, sf: str) -> DataFrame:
    return lines.line_time_map(_trial_lines(spark, sf), _bounds(spark, sf), ["session", "trial"]).select("session", "trial", "k", r("line").alias("line"), r(F.col("t") + 3e-8).alias("t"))


_FILES = ", f AS (SELECT file_id, regexp_extract(name, '^(.*)_DMD', 1) AS prefix, regexp_extract(name, 'DMD(\\d+)', 1)::INT AS plane, coalesce(try_cast(nullif(regexp_extract(name, 'TRIAL(\\d+)', 1), '') AS INT), 1) AS trial, try_cast(nullif(regexp_extract(name, 'CYCLE-(\\d+)', 1), '') AS BIGINT) AS \"offset\", cycles, 30 + file_id % 3 // 2 * 10 AS lines_per_cycle FROM v9)"


def _inventory(spark, sf):
    from ..sources.files import parse_names

    return parse_names(V.raw_files(spark, sf)).withColumn("lines_per_cycle", 30 + F.floor(F.col("file_id") % 3 / 2) * 10)


@query("v9", _FILES + " SELECT file_id, prefix, plane, trial, \"offset\" FROM f")
def s9_file_inventory(spark: SparkSession, sf: str) -> DataFrame:
    return _inventory(spark, sf).select("file_id", "prefix", "plane", "trial", "offset")


@query("", "SELECT p_partkey AS file_id, greatest((1000000 + p_partkey * 7919 - 512 * p_size) // (p_size * 640), 0) AS n_cycles FROM part")
def s10_cycle_counts(spark: SparkSession, sf: str) -> DataFrame:
    from ..sources.files import cycle_counts

    p = V.table(spark, sf, "part")
    inventory = p.select(F.col("p_partkey").alias("file_id"), (1000000 + F.col("p_partkey") * 7919).alias("size"))
    headers = p.select(F.col("p_partkey").alias("file_id"), (512 * F.col("p_size")).alias("first_offset"), (F.col("p_size") * 640).alias("bytes_per_cycle"))
    return cycle_counts(inventory, headers, ["file_id"]).select("file_id", "n_cycles")


@query("v9", _FILES + ", c AS (SELECT *, row_number() OVER (PARTITION BY prefix ORDER BY CASE WHEN prefix LIKE '%13%' AND trial = 3 THEN 0 ELSE 1 END, file_id) AS n FROM f) SELECT prefix, file_id, (SELECT count(*) FROM f x WHERE x.prefix = c.prefix) AS n_candidates FROM c WHERE n = 1")
def s11_pick_file(spark: SparkSession, sf: str) -> DataFrame:
    from ..sources.files import pick_file

    c = _inventory(spark, sf).withColumn("preferred", F.col("prefix").contains("13") & (F.col("trial") == 3))
    return pick_file(c, ["prefix"], [F.col("preferred").desc(), F.col("file_id")]).select("prefix", "file_id", "n_candidates")


@query("v9", _FILES + ", s AS (SELECT DISTINCT prefix, t.trial FROM f, (VALUES (1), (2), (3)) t(trial)) SELECT s.prefix, s.trial, coalesce(sum(cycles), 0)::BIGINT AS n_cycles FROM s LEFT JOIN f ON s.prefix = f.prefix AND s.trial = f.trial GROUP BY 1, 2")
def a20_cycles_per_trial(spark: SparkSession, sf: str) -> DataFrame:
    f = _inventory(spark, sf)
    spine = f.select("prefix").distinct().withColumn("trial", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))))
    return lines.cycles_per_trial(f, spine, ["prefix"])


@query("v9", _FILES + ", g AS (SELECT *, max(coalesce(\"offset\", 0)) OVER (PARTITION BY plane, trial) AS last, cycles % 11 AS c FROM f) SELECT plane, trial, count(*) AS n_files, sum(c)::BIGINT AS n_cycles, sum(c * lines_per_cycle)::BIGINT AS n_lines, count(DISTINCT lines_per_cycle) = 1 AS one_size, count(*) FILTER (c = 0 AND coalesce(\"offset\", 0) < last) = 0 AS only_last_empty FROM g GROUP BY 1, 2")
def a21_path_dimensions(spark: SparkSession, sf: str) -> DataFrame:
    f = _inventory(spark, sf).withColumns({"offset": F.coalesce("offset", F.lit(0)), "cycles": F.col("cycles") % 11})
    return lines.path_dimensions(f, ["plane", "trial"])


@query("v5", " SELECT session, trial, round(CASE WHEN count(*) > 1 THEN (count(*) - 1) / (max(t) - min(t)) END, 9) AS rate FROM v5 GROUP BY 1, 2")
def a22_rate_per_trial(spark: SparkSession, sf: str) -> DataFrame:
    return lines.rate_per_trial(V.lines(spark, sf), ["session", "trial"]).select("session", "trial", r("rate", 9).alias("rate"))


_REB = """, s AS (SELECT session, trial, ord, line - CASE WHEN trial % 3 = 0 THEN trial * 140 ELSE 0 END AS line FROM v5),
d AS (SELECT *, line - lag(line) OVER (PARTITION BY session, trial ORDER BY ord) AS d FROM s), p AS (SELECT session, quantile_cont(d, 0.99) FILTER (d > 0) AS p FROM d GROUP BY 1),
t AS (SELECT session, trial, arg_min(line, ord) AS f, arg_max(line, ord) AS l, count(*) FILTER (d < 0) AS falls FROM d GROUP BY 1, 2),
b AS (SELECT *, lag(l) OVER (PARTITION BY session ORDER BY trial) AS pl FROM t), sh AS (SELECT session, trial, f - 1 AS shift FROM b JOIN p USING (session) WHERE f <> 1 AND f - pl > 0 AND f - pl <= 1.5 * p AND falls = 0)"""


@query("v5", _REB + " SELECT s.session, s.ord, s.line - coalesce(shift, 0) AS line FROM s LEFT JOIN sh USING (session, trial)")
def w23_rebase_counters(spark: SparkSession, sf: str) -> DataFrame:
    s = V.lines(spark, sf).withColumn("line", F.col("line") - F.when(F.col("trial") % 3 == 0, F.col("trial") * 140).otherwise(0))
    return lines.rebase_counters(s, K, "trial")[0].select("session", "ord", "line")


@query("v9", _FILES + """, o AS (SELECT plane, trial, "offset", max(cycles) AS cycles, count(*) AS copies FROM f WHERE "offset" IS NOT NULL GROUP BY 1, 2, 3), n AS (SELECT *, lead("offset") OVER (PARTITION BY plane, trial ORDER BY "offset") AS nx FROM o),
g AS (SELECT plane, trial, max(copies) AS copies, min("offset") AS first, count(*) FILTER (nx > "offset" + cycles) AS gaps, count(*) FILTER (nx < "offset" + cycles) AS ov FROM n GROUP BY 1, 2), m AS (SELECT plane, trial, count("offset") AS ch, count(*) AS n FROM f WHERE file_id % 4 > 0 OR "offset" IS NOT NULL GROUP BY 1, 2)
SELECT plane, trial, CASE WHEN ch > 0 AND ch < n THEN 'mixed' WHEN copies > 1 THEN 'duplicate' WHEN first > 0 THEN 'not from 0' WHEN gaps > 0 THEN 'gap' WHEN ov > 0 THEN 'overlap' ELSE 'ok' END AS verdict FROM m LEFT JOIN g USING (plane, trial)""")
def w25_chunk_continuity(spark: SparkSession, sf: str) -> DataFrame:
    f = _inventory(spark, sf).filter("file_id % 4 > 0 or offset is not null")
    return lines.chunk_continuity(f, ["plane", "trial"])


@query("v9", _FILES + """, g AS (SELECT plane, file_id % 40 AS s, prefix, max(trial) AS n, max(prefix) AS stamp FROM f GROUP BY 1, 2, 3), k AS (SELECT *, row_number() OVER (PARTITION BY plane, s ORDER BY stamp DESC) AS rk FROM g)
SELECT plane, s, count(*) AS n_prefixes, max(prefix) FILTER (rk = 1) AS retained, max(n) FILTER (rk = 1) AS n_retained, coalesce(max(n) FILTER (rk > 1), 0) AS n_excluded, count(*) <= 2 AND coalesce(max(n) FILTER (rk > 1), 0) < max(n) FILTER (rk = 1) AS valid FROM k GROUP BY 1, 2""")
def w26_resolve_acquisition(spark: SparkSession, sf: str) -> DataFrame:
    f = _inventory(spark, sf).withColumn("s", F.col("file_id") % 40).withColumn("stamp", F.col("prefix"))
    return lines.resolve_acquisition(f, ["plane", "s"])


@query("v5", ", l AS (SELECT session, max(trial) AS m FROM v5 GROUP BY 1) SELECT session, ord, trial - 1 AS trial FROM v5 JOIN l USING (session) WHERE trial >= 1 AND trial <= m - 1")
def w27_exclude_trials(spark: SparkSession, sf: str) -> DataFrame:
    return lines.exclude_trials(V.lines(spark, sf), K, 1, 1).select("session", "ord", "trial")


@query("v5", ", b AS (SELECT session, trial, min(t) AS a, max(t) + 10 AS z, count(*) AS m FROM v5 GROUP BY 1, 2), n AS (SELECT *, row_number() OVER (PARTITION BY session, trial ORDER BY ord) - 1 AS n FROM v5) SELECT session, ord, round(a + n::DOUBLE / greatest(m - 1, 1) * (z - a) + 3e-8, 6) AS mapped_t FROM n JOIN b USING (session, trial)")
def w29_linspace_trials(spark: SparkSession, sf: str) -> DataFrame:
    s = V.lines(spark, sf)
    b = s.groupBy("session", "trial").agg(F.min("t").alias("start"), (F.max("t") + 10).alias("stop"))
    return lines.linspace_trials(s, b, ["session", "trial"]).select("session", "ord", r(F.col("mapped_t") + 3e-8).alias("mapped_t"))


@query("v5 clicks", ", a AS (SELECT session, count(*) AS n_pulses FROM clicks GROUP BY 1), l AS (SELECT session, ceil(max(line) / 35.0::DOUBLE)::BIGINT AS n_lines FROM v5 GROUP BY 1), f AS (SELECT session, 12 + session % 5 AS n_files FROM v5 GROUP BY 1) SELECT session, n_pulses, n_lines, n_files, n_pulses = n_lines AND n_lines = n_files AS agree FROM a JOIN l USING (session) JOIN f USING (session)")
def a26_compare_cycle_counts(spark: SparkSession, sf: str) -> DataFrame:
    p = V.pulses(spark, sf, "click").groupBy("session").agg(F.count("*").alias("n_pulses"))
    ln = lines.expected_cycles(V.lines(spark, sf), K, 35.0).withColumnRenamed("expected", "n_lines")
    f = V.lines(spark, sf).select("session").distinct().withColumn("n_files", 12 + F.col("session") % 5)
    return lines.compare_cycle_counts(p, ln, f, K)


@query("v5", ", b AS (SELECT session, trial, min(line) AS l0, max(line) - min(line) AS dl, min(t) AS t0, max(t) - min(t) AS dt FROM v5 GROUP BY 1, 2) SELECT session, trial, line, round((line - l0) / dl, 6) AS line_share, round((t - t0) / dt, 6) AS t_share FROM v5 JOIN b USING (session, trial) WHERE dl > 0 AND dt > 0")
def a32_curve_shape(spark: SparkSession, sf: str) -> DataFrame:
    return lines.curve_shape(V.lines(spark, sf), ["session", "trial"]).select("session", "trial", "line", r("line_share").alias("line_share"), r("t_share").alias("t_share"))


@query("v5 starts ends v9", _FILES + """, s AS (SELECT session, trial, ord, session % 2 AS plane, line FROM v5 WHERE session % 2 = 0 OR trial > 0),
d AS (SELECT *, line - lag(line) OVER (PARTITION BY session, plane, trial ORDER BY ord) AS d FROM s), p AS (SELECT session, plane, quantile_cont(d, 0.99) FILTER (d > 0) AS p FROM d GROUP BY 1, 2),
t AS (SELECT session, plane, trial, arg_min(line, ord) AS fi, arg_max(line, ord) AS la FROM d GROUP BY 1, 2, 3), g AS (SELECT *, fi - lag(la) OVER (PARTITION BY session, plane ORDER BY trial) AS gap, lag(la) OVER (PARTITION BY session, plane ORDER BY trial) IS NOT NULL AS hp FROM t),
pl AS (SELECT session, count(*) > 1 AS c, count(*) FILTER (hp AND NOT (gap > 0 AND gap <= 1.5 * p)) = 0 AS d FROM g JOIN p USING (session, plane) GROUP BY session, plane), bo AS (SELECT session, bool_and(c) AS c, bool_and(d) AS d FROM pl GROUP BY 1)
SELECT x.session, coalesce(x.session % 3 = 0 AND c AND d, false) AS continuous FROM (SELECT DISTINCT session FROM v5) x LEFT JOIN bo USING (session)""")
def w24_infer_continuous(spark: SparkSession, sf: str) -> DataFrame:
    s = V.lines(spark, sf).withColumn("plane", F.col("session") % 2).filter("session % 2 = 0 or trial > 0")
    sessions = V.lines(spark, sf).select("session").distinct()
    p = sessions.select("session", F.lit(1).alias("n_starts"), F.when(F.col("session") % 3 == 0, 1).otherwise(2).alias("n_ends"))
    chunks = sessions.select("session", F.lit("a").alias("prefix"), F.lit(1).alias("trial"), F.lit(0).alias("offset"))
    return lines.infer_continuous(p, chunks, s, K)


@query("v9", _FILES + ", w AS (SELECT DISTINCT prefix, plane FROM f) SELECT w.prefix, w.plane, count(m.n) AS n_matches FROM w LEFT JOIN (SELECT prefix || '_dmd' || plane AS n FROM f WHERE file_id % 3 = 0) m ON lower(m.n) = lower(w.prefix || '_DMD' || w.plane) GROUP BY 1, 2")
def j16_match_meta(spark: SparkSession, sf: str) -> DataFrame:
    from ..sources.files import match_meta

    f = _inventory(spark, sf)
    meta = f.filter("file_id % 3 = 0").select(F.concat(F.col("prefix"), F.lit("_dmd"), F.col("plane").cast("string"), F.lit(".META")).alias("name"))
    return match_meta(f.select("prefix", "plane").distinct(), meta)


@query("v9", _FILES + " SELECT file_id, row_number() OVER (PARTITION BY prefix, plane ORDER BY trial, coalesce(\"offset\", 0), file_id) AS position FROM f")
def t1_file_order(spark: SparkSession, sf: str) -> DataFrame:
    from pyspark.sql.window import Window

    w = Window.partitionBy("prefix", "plane").orderBy("trial", F.coalesce("offset", F.lit(0)), "file_id")
    return _inventory(spark, sf).select("file_id", F.row_number().over(w).cast("long").alias("position"))


