"""Queries of the cleaning and edge operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import columns as C
from ..operators import clean, edges
from ..operators.ordered import join_on, with_ordinal, with_previous
from . import views as V
from .views import K, with_views

QUERIES, ORACLES = {}, {}


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


@query("v1 starts", " SELECT v.session, v.ord, round(v.t - o.t0, 6) AS t FROM v1 v JOIN (SELECT session, arg_min(t, ord) AS t0 FROM starts GROUP BY 1) o USING (session)")
def p1_normalize_clock(spark: SparkSession, sf: str) -> DataFrame:
    origin = clean.clock_origin(V.trial_marks(spark, sf)[0], K)
    return clean.normalize_clock(V.samples(spark, sf), origin, K).select("session", "ord", r("t").alias("t"))


@query("clicks looks", " SELECT session, round(least(a, d), 6) AS recording_start FROM (SELECT session, arg_min(t, ord) AS a FROM clicks GROUP BY 1) JOIN (SELECT session, arg_min(t, ord) AS d FROM looks GROUP BY 1) USING (session)")
def p2_recording_onset(spark: SparkSession, sf: str) -> DataFrame:
    return clean.recording_onset(V.pulses(spark, sf, "click"), V.pulses(spark, sf, "view"), K).select("session", r("recording_start").alias("recording_start"))


_P3 = """, p AS (SELECT s.session, s.n, e.t - s.t AS d FROM (SELECT *, row_number() OVER (PARTITION BY session ORDER BY ord) AS n FROM starts) s
  JOIN (SELECT *, row_number() OVER (PARTITION BY session ORDER BY ord) AS n FROM ends) e USING (session, n)),
g AS (SELECT session, count(*) AS c, max(d) FILTER (n = 1) AS f, median(d) FILTER (n > 1) AS m FROM p GROUP BY 1),
dropped AS (SELECT session FROM g WHERE f > 0 AND f < 50000 AND c >= 2 AND f < 0.5 * m),
ks AS (SELECT s.* FROM (SELECT *, row_number() OVER (PARTITION BY session ORDER BY ord) AS n FROM starts) s WHERE NOT (n = 1 AND session IN (FROM dropped))),
ke AS (SELECT s.* FROM (SELECT *, row_number() OVER (PARTITION BY session ORDER BY ord) AS n FROM ends) s WHERE NOT (n = 1 AND session IN (FROM dropped))),
fs AS (SELECT session, arg_min(t, ord) AS f FROM ks WHERE session IN (FROM dropped) GROUP BY 1),
kd AS (SELECT l.* FROM looks l LEFT JOIN fs USING (session) WHERE f IS NULL OR l.t >= f)
SELECT 'start' AS line, session, ord FROM ks UNION ALL SELECT 'end', session, ord FROM ke UNION ALL SELECT 'stimulus', session, ord FROM kd"""


@query("starts ends looks", _P3)
def p3_trim_startup_pulse(spark: SparkSession, sf: str) -> DataFrame:
    starts, ends = V.trial_marks(spark, sf)
    kept = clean.trim_startup_pulse(starts, ends, V.pulses(spark, sf, "view"), K, longest=50000.0, share=0.5)
    named = [df.select(F.lit(n).alias("line"), "session", "ord") for n, df in zip(("start", "end", "stimulus"), kept, strict=True)]
    return named[0].unionByName(named[1]).unionByName(named[2])


_P4 = """, s AS (SELECT session, count(*) AS ns, arg_max(t, ord) AS ls, max(ord) AS lo FROM starts GROUP BY 1),
e AS (SELECT session, count(*) AS ne, arg_max(t, ord) AS le FROM ends GROUP BY 1),
cut AS (SELECT session, lo, le FROM s JOIN e USING (session) WHERE ns = ne + 1 AND ls > le)
SELECT 'start' AS line, session, ord FROM starts LEFT JOIN cut USING (session) WHERE lo IS NULL OR ord <> lo
UNION ALL SELECT 'clock', session, ord FROM clicks c LEFT JOIN cut USING (session) WHERE le IS NULL OR c.t <= le"""


@query("starts ends clicks", _P4)
def p4_trim_unterminated(spark: SparkSession, sf: str) -> DataFrame:
    starts, ends = V.trial_marks(spark, sf)
    s, c = clean.trim_unterminated_trial(starts, ends, V.pulses(spark, sf, "click"), K)
    return s.select(F.lit("start").alias("line"), "session", "ord").unionByName(c.select(F.lit("clock").alias("line"), "session", "ord"))


@query("starts", " SELECT session, ord FROM (SELECT *, row_number() OVER (PARTITION BY session ORDER BY ord DESC) AS d FROM starts) WHERE d <= 3")
def p5_keep_last_trials(spark: SparkSession, sf: str) -> DataFrame:
    return clean.keep_last_n(V.trial_marks(spark, sf)[0], 3, K).select("session", "ord")


@query("starts ends", """, s AS (SELECT session, count(t) AS n_starts, min(t) AS a FROM starts GROUP BY 1), e AS (SELECT session, count(t) AS n, min(t) AS b FROM ends GROUP BY 1)
SELECT session, n_starts, coalesce(n, 0) AS n_stops, n_starts = 1 AND coalesce(n, 0) <= 1 AND (b IS NULL OR b > a) AS valid FROM s LEFT JOIN e USING (session)""")
def p6_continuous_markers(spark: SparkSession, sf: str) -> DataFrame:
    return clean.continuous_markers(*V.trial_marks(spark, sf), K).select("session", "n_starts", "n_stops", "valid")


@query("v2", " SELECT plane, roi, count(*) FILTER (dff IS NOT NULL) AS n_kept, count(*) FILTER (dff IS NULL) AS n_dropped FROM v2 GROUP BY 1, 2")
def p7_drop_untimed(spark: SparkSession, sf: str) -> DataFrame:
    kept, dropped = clean.drop_untimed(V.traces(spark, sf), ["plane", "roi"], "dff")
    return join_on(dropped, kept.groupBy("plane", "roi").agg(F.count("*").alias("n_kept")), ["plane", "roi"])


@query("v2", " SELECT plane, roi, ord, round(dff / (f0 + 1e-6), 9) AS ratio FROM v2")
def p8_dff(spark: SparkSession, sf: str) -> DataFrame:
    return V.traces(spark, sf).select("plane", "roi", "ord", r(C.dff(F.col("dff"), F.col("f0")), 9).alias("ratio"))


@query("ev", """ SELECT event_type, list_filter([CASE WHEN count(a) > 0 THEN 'a' END, CASE WHEN count(b) > 0 THEN 'b' END, CASE WHEN count(c) > 0 THEN 'c' END], lambda x: x IS NOT NULL)::VARCHAR AS columns
FROM (SELECT event_type, CASE WHEN event_type <> 'view' THEN k END AS a, CASE WHEN event_type = 'click' THEN value END AS b, ord AS c FROM ev) GROUP BY 1""")
def p9_filled_columns(spark: SparkSession, sf: str) -> DataFrame:
    e = V.events(spark, sf).select("event_type", F.when(F.col("event_type") != "view", F.col("k")).alias("a"), F.when(F.col("event_type") == "click", F.col("value")).alias("b"), F.col("ord").alias("c"))
    return clean.filled_columns(e, ["event_type"]).select("event_type", F.concat(F.lit("["), F.array_join("columns", ", "), F.lit("]")).alias("columns"))


@query("", "SELECT p_partkey, p_name LIKE '%widget%' AND p_partkey % 2 = 0 AS is_dff, p_partkey % 3 = 0 AS is_f0 FROM part")
def p10_series_kind(spark: SparkSession, sf: str) -> DataFrame:
    p = V.table(spark, sf, "part")
    name = F.concat("p_name", F.when(F.col("p_name").contains("widget") & (F.col("p_partkey") % 2 == 0), " dF over F").otherwise(" raw"), F.when(F.col("p_partkey") % 3 == 0, "_F0").otherwise("_f00"))
    return p.select("p_partkey", C.is_dff_series(F.regexp_replace(name, "dF over F", "dF_over_F")).alias("is_dff"), C.is_f0_series(name).alias("is_f0"))


@query("v3", " SELECT ord FROM v3 WHERE k % 9 - 1 >= 0")
def p11_assigned_presentations(spark: SparkSession, sf: str) -> DataFrame:
    return clean.assigned_presentations(V.stimuli(spark, sf).withColumn("trial", F.col("k") % 9 - 1)).select("ord")


@query("ev v2", " SELECT p.plane, p.roi, t.roi IS NOT NULL AS has_sources FROM (SELECT DISTINCT event_type AS plane, k % 12 AS roi FROM ev) p LEFT JOIN (SELECT DISTINCT plane, roi FROM v2 WHERE dff > 3) t USING (plane, roi)")
def p12_planes_with_sources(spark: SparkSession, sf: str) -> DataFrame:
    planes = V.events(spark, sf).select(F.col("event_type").alias("plane"), (F.col("k") % 12).alias("roi")).distinct()
    return clean.planes_with_sources(planes, V.traces(spark, sf).filter("dff > 3"), ["plane", "roi"])


@query("v9", " SELECT file_id, 'DMD' || regexp_extract(name, 'DMD(\\d+)', 1) AS plane, regexp_extract(name, 'DMD(\\d+)', 1)::INT AS number FROM v9")
def p13_plane_name(spark: SparkSession, sf: str) -> DataFrame:
    f = V.raw_files(spark, sf)
    return f.select("file_id", C.plane_name(F.col("name")).alias("plane"), C.plane_number(F.col("name")).alias("number"))


@query("v3", """, e AS (SELECT *, CASE WHEN block = 1 THEN direction ELSE x END AS a, CASE WHEN k % 5 <> 0 THEN 2 END AS b, CASE WHEN k % 5 = 0 THEN 0.0 ELSE 0.8 END AS contrast, k % 5 = 0 AS is_blank FROM v3)
SELECT direction, block, x, max(a) AS a, count(DISTINCT a) = 1 AND count(a) = count(*) AS a_agrees, count(DISTINCT b) = 1 AND count(b) = count(*) AS b_agrees, sum(CASE WHEN is_blank THEN 0.0 ELSE 0.8 END)::DOUBLE AS contrast FROM e GROUP BY 1, 2, 3""")
def p14_constant_settings(spark: SparkSession, sf: str) -> DataFrame:
    keys = ["direction", "block", "x"]
    e = V.stimuli(spark, sf).withColumns({"a": F.when(F.col("block") == 1, F.col("direction")).otherwise(F.col("x")), "b": F.when(F.col("k") % 5 != 0, F.lit(2)), "contrast": F.when(F.col("k") % 5 == 0, 0.0).otherwise(0.8), "is_blank": F.col("k") % 5 == 0})
    c = clean.attach_contrast(e, ["block"]).groupBy(*keys).agg(F.sum("attached_contrast").alias("contrast"))
    return join_on(clean.constant_settings(e, keys, ["a", "b"]).drop("b"), c, keys).withColumn("contrast", r("contrast", 9))


ORACLES["p14_constant_settings"] = ORACLES["p14_constant_settings"].replace("sum(CASE WHEN is_blank THEN 0.0 ELSE 0.8 END)::DOUBLE", "round(sum(CASE WHEN is_blank THEN 0.0 ELSE 0.8 END)::DOUBLE, 9)")


@query("", "SELECT p_partkey, CASE WHEN p_size % 2 = 0 AND r.r_name IS NOT NULL THEN 'u' || r.r_regionkey ELSE '' END AS url FROM part LEFT JOIN (SELECT r_regionkey, r_name FROM region) r ON lower(r.r_name) = CASE p_partkey % 3 WHEN 0 THEN 'asia' WHEN 1 THEN 'europe' ELSE 'none' END")
def p15_lookup_url(spark: SparkSession, sf: str) -> DataFrame:
    urls = V.table(spark, sf, "region").select(F.col("r_name").alias("name"), F.concat(F.lit("u"), F.col("r_regionkey").cast("string")).alias("url"))
    rows = V.table(spark, sf, "part").withColumn("movie", F.when(F.col("p_partkey") % 3 == 0, "Asia").when(F.col("p_partkey") % 3 == 1, "euroPE").otherwise("none"))
    return clean.lookup_url(rows, urls, "movie", F.col("p_size") % 2 == 0).select("p_partkey", "url")


@query("v1", """, x AS (SELECT *, lag(t) OVER (PARTITION BY session ORDER BY ord) AS pt, lag(counter) OVER (PARTITION BY session ORDER BY ord) AS pc FROM v1),
c AS (SELECT session, count(*) FILTER (level > 400) AS high_level, count(*) FILTER (t <= pt) AS time_not_increasing, count(*) FILTER (counter < pc) AS counter_falls FROM x GROUP BY 1)
SELECT session, rule, n_bad FROM c UNPIVOT (n_bad FOR rule IN (high_level, time_not_increasing, counter_falls))""")
def ov1_violations(spark: SparkSession, sf: str) -> DataFrame:
    s = with_previous(V.samples(spark, sf), K, "ord", ["t", "counter"])
    return clean.violations(s, K, {"high_level": F.col("level") > 400, "time_not_increasing": F.col("t") <= F.col("prev_t"), "counter_falls": F.col("counter") < F.col("prev_counter")})


@query("v5", " SELECT session, trial, arg_min(line, ord) AS first_line FROM v5 GROUP BY 1, 2 HAVING arg_min(line, ord) <> 1")
def ov2_nonunit_starts(spark: SparkSession, sf: str) -> DataFrame:
    return clean.nonunit_starts(V.lines(spark, sf), ["session", "trial"])


_EDGE = ", x AS (SELECT *, lag(state) OVER (PARTITION BY session ORDER BY ord) AS p FROM v1), e AS (SELECT session, ord, t, p IS NULL AS initial FROM x WHERE state AND (p IS NULL OR NOT p)), g AS (SELECT *, t - lag(t) OVER (PARTITION BY session ORDER BY ord) AS gap FROM e), m AS (SELECT session, 5 * median(gap) AS lim FROM g GROUP BY 1), gr AS (SELECT g.*, sum(CASE WHEN gap > lim THEN 1 ELSE 0 END) OVER (PARTITION BY session ORDER BY ord) AS grp FROM g JOIN m USING (session)) "


@query("v1", _EDGE + "SELECT session, ord, round(t, 6) AS t, initial, round(gap, 6) AS period FROM g")
def w1_rising_edges(spark: SparkSession, sf: str) -> DataFrame:
    return edges.rising_edges(V.samples(spark, sf), K).select("session", "ord", r("t").alias("t"), "initial", r("period").alias("period"))


@query("v1", _EDGE + "SELECT session, ord, state FROM x WHERE p IS NOT NULL AND state <> p")
def w2_transitions(spark: SparkSession, sf: str) -> DataFrame:
    return edges.transitions(V.samples(spark, sf), K).select("session", "ord", "state")


@query("v1 clicks looks", _EDGE + ", o AS (SELECT session, least(a, d) AS s FROM (SELECT session, arg_min(t, ord) AS a FROM clicks GROUP BY 1) JOIN (SELECT session, arg_min(t, ord) AS d FROM looks GROUP BY 1) USING (session)) SELECT session, arg_min(t, ord) - any_value(s) <= 0.001 AS at_onset, arg_min(initial, ord) AS initially_high FROM e JOIN o USING (session) GROUP BY 1")
def w4_onset_flags(spark: SparkSession, sf: str) -> DataFrame:
    onset = clean.recording_onset(V.pulses(spark, sf, "click"), V.pulses(spark, sf, "view"), K)
    return edges.onset_flags(edges.rising_edges(V.samples(spark, sf), K), onset, K)


def _groups(spark: SparkSession, sf: str) -> DataFrame:
    return edges.split_by_gaps(edges.rising_edges(V.samples(spark, sf), K).select("session", "ord", "t"), K)


@query("v1", _EDGE + "SELECT session, ord, grp::BIGINT AS \"group\" FROM gr")
def w5_split_by_gaps(spark: SparkSession, sf: str) -> DataFrame:
    return _groups(spark, sf).select("session", "ord", F.col("group").cast("long").alias("group"))


def _expected(spark: SparkSession, sf: str) -> DataFrame:
    return V.events(spark, sf).select("session").distinct().select("session", (F.col("session") % 4 + 1).alias("n_trials"), F.when(F.col("session") % 3 > 0, F.col("session") % 4 + 1).otherwise(9).alias("highest_trial"))


@query("v1", _EDGE + "SELECT session, (max(grp) + 1)::BIGINT AS n_groups, CASE WHEN session % 4 = 0 THEN 'not_applicable' WHEN max(grp) + 1 = session % 4 + 1 THEN 'ok' ELSE 'failed' END AS verdict FROM gr GROUP BY 1")
def w5_gap_verdict(spark: SparkSession, sf: str) -> DataFrame:
    return edges.gap_verdict(_groups(spark, sf), _expected(spark, sf), K).select("session", F.col("n_groups").cast("long").alias("n_groups"), "verdict")


@query("v1", _EDGE + ", d AS (SELECT session, (max(grp) + 1 = session % 4 + 2 AND session % 3 > 0)::INT AS dr FROM gr GROUP BY 1) SELECT session, ord, (grp - dr)::BIGINT AS \"group\" FROM gr JOIN d USING (session) WHERE grp >= dr")
def w6_drop_leading_group(spark: SparkSession, sf: str) -> DataFrame:
    return edges.drop_leading_group(_groups(spark, sf), _expected(spark, sf), K).select("session", "ord", F.col("group").cast("long").alias("group"))


@query("v1 starts", _EDGE + "SELECT session, ord FROM e JOIN (SELECT session, arg_min(t, ord) AS f FROM starts GROUP BY 1) USING (session) WHERE t >= f")
def w7_drop_before_first_start(spark: SparkSession, sf: str) -> DataFrame:
    return edges.drop_before_first_start(edges.rising_edges(V.samples(spark, sf), K), V.trial_marks(spark, sf)[0], K).select("session", "ord")


@query("v1", _EDGE + "SELECT session, grp::BIGINT AS trial, count(*) AS n_edges, CASE WHEN grp < 4 THEN count(*) = session % 5 + grp END AS agrees FROM gr GROUP BY session, grp")
def w8_assign_by_gap(spark: SparkSession, sf: str) -> DataFrame:
    e = _expected(spark, sf).select("session", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("trial")).withColumn("expected", F.col("session") % 5 + F.col("trial"))
    return edges.assign_by_gap(_groups(spark, sf), e, K).select("session", F.col("trial").cast("long").alias("trial"), "n_edges", "agrees")


@query("v1", _EDGE + """, rk AS (SELECT *, row_number() OVER (PARTITION BY session ORDER BY ord) - 1 AS n FROM e),
ex AS (SELECT session, trial, session % 3 + trial AS expected FROM (SELECT DISTINCT session FROM v1), range(6) q(trial)),
up AS (SELECT *, sum(expected) OVER (PARTITION BY session ORDER BY trial) AS hi FROM ex)
SELECT u.session, u.trial, u.expected, count(rk.n) AS n_edges, round(min(rk.t), 6) AS first_t, round(max(rk.t), 6) AS last_t, count(rk.n) < 0.9 * u.expected AS short
FROM up u LEFT JOIN rk ON rk.session = u.session AND rk.n >= hi - expected AND rk.n < hi GROUP BY 1, 2, 3""")
def w9_assign_by_count(spark: SparkSession, sf: str) -> DataFrame:
    e = _expected(spark, sf).select("session", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(5).cast("long"))).alias("trial")).withColumn("expected", F.col("session") % 3 + F.col("trial"))
    out = edges.assign_by_count(edges.rising_edges(V.samples(spark, sf), K), e, K)
    return out.select("session", "trial", "expected", "n_edges", r("first_t").alias("first_t"), r("last_t").alias("last_t"), "short")


_W12 = """, rk AS (SELECT *, row_number() OVER (PARTITION BY session ORDER BY ord) - 1 AS k FROM clicks),
p AS (SELECT session, count(*) AS n, min(t) AS a, max(t) AS b, session % 25 AS c FROM clicks GROUP BY 1),
pol AS (SELECT *, CASE WHEN n > c + 1 THEN 'invalid' WHEN n = c + 1 THEN 'measured_end' WHEN n >= 2 THEN 'estimated_end' ELSE 'start_only' END AS policy FROM p)"""


@query("clicks", _W12 + """ SELECT session, k, 1.0 + k * 100 AS line, round(t, 6) AS t, false AS estimated FROM rk JOIN pol USING (session) WHERE policy <> 'invalid'
UNION ALL SELECT session, n, 1.0 + n * 100, round(b + (b - a) / (n - 1), 6), true FROM pol WHERE policy = 'estimated_end'""")
def w12_continuous_knots(spark: SparkSession, sf: str) -> DataFrame:
    cycles = V.events(spark, sf).select("session").distinct().withColumn("n_cycles", F.col("session") % 25)
    return edges.continuous_clock(V.pulses(spark, sf, "click"), K, 100, cycles)[0].select("session", "k", "line", r("t").alias("t"), "estimated")


ORACLES["w12_continuous_knots"] = ORACLES["w12_continuous_knots"].replace("1.0 + k * 100 AS line", "(1 + k * 100)::DOUBLE AS line").replace("1.0 + n * 100", "(1 + n * 100)::DOUBLE")


@query("clicks", _W12 + " SELECT session, n AS n_pulses, policy, round(CASE WHEN n > 1 THEN (b - a) / (n - 1) END, 6) AS mean_period, greatest(c - n, 0) AS n_unsupported FROM pol")
def w12_continuous_report(spark: SparkSession, sf: str) -> DataFrame:
    cycles = V.events(spark, sf).select("session").distinct().withColumn("n_cycles", F.col("session") % 25)
    return edges.continuous_clock(V.pulses(spark, sf, "click"), K, 100, cycles)[1].select("session", "n_pulses", "policy", r("mean_period").alias("mean_period"), "n_unsupported")


@query("v1", ", x AS (SELECT session, level - lag(level) OVER (PARTITION BY session ORDER BY ord) AS d FROM v1) SELECT session, count(*) FILTER (d = 0) AS n_equal, count(*) FILTER (d < 0) AS n_decreasing FROM x GROUP BY 1")
def a23_monotonicity(spark: SparkSession, sf: str) -> DataFrame:
    return edges.monotonicity(V.samples(spark, sf), K, "level")


@query("v1", ", x AS (SELECT *, lead(t) OVER w AS nt, lead(state) OVER w AS ns FROM v1 WINDOW w AS (PARTITION BY session ORDER BY ord)) SELECT session, ord, round(nt - t, 6) AS interval FROM x WHERE state AND ns")
def w30_adjacent_intervals(spark: SparkSession, sf: str) -> DataFrame:
    return edges.adjacent_intervals(V.samples(spark, sf), K, "t", "ord", "state").select("session", "ord", r("interval").alias("interval"))


@query("v1", " SELECT session, ord, row_number() OVER (PARTITION BY session ORDER BY ord) - 1 AS n, sum(counter) OVER (PARTITION BY session ORDER BY ord)::BIGINT AS total FROM v1")
def ordered_running_sum(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators.ordered import with_running_sum

    s = with_ordinal(V.samples(spark, sf), K, "ord", "n", width=500)
    return with_running_sum(s, K, "ord", F.col("counter"), "total", width=700).select("session", "ord", "n", F.col("total").cast("long").alias("total"))
