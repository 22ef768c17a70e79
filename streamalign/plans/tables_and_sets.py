"""Queries of the readers' relational parts, and of limits, top rows and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from ..operators import clean, edges
from ..operators.ordered import with_ordinal
from ..sources import files, tables
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


@query("v1", ' SELECT session, ord, level AS "DiameterX", level AS "DiameterY", counter AS "Counter" FROM v1')
def s1_stimulus_columns(spark: SparkSession, sf: str) -> DataFrame:
    s = V.samples(spark, sf).select("session", "ord", F.col("level").alias("diameter"), F.col("counter").alias("count_old"))
    return tables.rename_stimulus_columns(s, {"count_old": "Counter"}).select("session", "ord", "DiameterX", "DiameterY", "Counter")


@query("ev", " SELECT ord AS frame, round(t - (SELECT arg_min(t, ord) FROM ev), 6) AS t FROM ev WHERE event_type = 'view'")
def s3_camera_frames(spark: SparkSession, sf: str) -> DataFrame:
    e = V.events(spark, sf).withColumn("all", F.lit(1))
    origin = clean.clock_origin(e, ["all"])
    frames = clean.normalize_clock(e.filter("event_type = 'view'"), origin, ["all"])
    return frames.select(F.col("ord").alias("frame"), F.round("t", 6).alias("t"))


@query("", "SELECT vec_id AS frame, embedding[1]::DOUBLE AS cr_x, embedding[6]::DOUBLE AS eye_x, embedding[11]::DOUBLE AS pupil_x FROM embeddings WHERE vec_id % 13 > 0 AND vec_id % 7 > 0")
def s4_ellipse_fits(spark: SparkSession, sf: str) -> DataFrame:
    e = V.table(spark, sf, "embeddings")
    part = lambda k: e.select(F.col("vec_id").alias("frame"), F.element_at("embedding", k).cast("double").alias("x"))
    return tables.read_ellipse_fits({"cr": part(1), "eye": part(6).filter("frame % 13 > 0"), "pupil": part(11).filter("frame % 7 > 0")}, ["frame"])[0]


@query("v2", ", k AS (SELECT plane, roi, 'dff' AS kind FROM v2 WHERE dff IS NOT NULL UNION ALL SELECT plane, roi, 'f0' FROM v2), c AS (SELECT plane, roi, kind, count(*) AS n FROM k GROUP BY ALL) SELECT plane, roi, count(DISTINCT n) = 1 AS same_shape, count(*) AS n_kinds FROM c GROUP BY ALL")
def s6_trace_shapes(spark: SparkSession, sf: str) -> DataFrame:
    t = V.traces(spark, sf)
    kinds = t.filter("dff is not null").select("plane", "roi", F.lit("dff").alias("kind")).unionByName(t.select("plane", "roi", F.lit("f0").alias("kind")))
    return tables.trace_shapes(kinds, ["plane", "roi"])


@query("v2", " SELECT plane, roi, ord FROM v2 WHERE roi IN (SELECT p_partkey FROM part WHERE p_size % 3 = 0)")
def s7_soma_traces(spark: SparkSession, sf: str) -> DataFrame:
    labels = V.table(spark, sf, "part").select(F.col("p_partkey").alias("roi"), F.when(F.col("p_size") % 3 == 0, " SOMA ").otherwise("dendrite").alias("label"))
    return tables.soma_traces(V.traces(spark, sf), labels, ["roi"]).select("plane", "roi", "ord")


@query("", "SELECT event_id, (props->>'$.k')::INT AS k FROM events")
def s8_metadata(spark: SparkSession, sf: str) -> DataFrame:
    e = V.table(spark, sf, "events").withColumn("m", F.from_json("props", "k int"))
    return e.select("event_id", F.col("m.k").alias("k"))


@query("v1", " SELECT session, count(*) AS n, min(ord) AS first_ord, max(ord) AS last_ord FROM v1 GROUP BY 1")
def s15_session_totals(spark: SparkSession, sf: str) -> DataFrame:
    return V.samples(spark, sf).groupBy("session").agg(F.count("*").alias("n"), F.min("ord").alias("first_ord"), F.max("ord").alias("last_ord"))


@query("v9", ", f AS (SELECT file_id, regexp_extract(name, 'DMD(\\d+)', 1)::INT AS plane, regexp_extract(name, '(\\d{8}_\\d{6})', 1) AS stamp FROM v9), r AS (SELECT *, row_number() OVER (PARTITION BY plane ORDER BY stamp DESC, file_id) AS n FROM f) SELECT plane, file_id, strptime(stamp, '%Y%m%d_%H%M%S')::VARCHAR AS stamp FROM r WHERE n = 1")
def t2_latest_acquisition(spark: SparkSession, sf: str) -> DataFrame:
    f = files.parse_names(V.raw_files(spark, sf)).withColumn("stamp", files.acquisition_time(F.col("prefix")))
    return clean.latest_per_key(f, ["plane"], [F.col("stamp").desc(), F.col("file_id")]).select("plane", "file_id", F.date_format("stamp", "yyyy-MM-dd HH:mm:ss").alias("stamp"))


@query("v5", " SELECT session, trial, ord FROM v5 WHERE trial < 2")
def t3_first_trials(spark: SparkSession, sf: str) -> DataFrame:
    return V.lines(spark, sf).filter("trial < 2").select("session", "trial", "ord")


@query("v1", ", r AS (SELECT *, row_number() OVER (PARTITION BY session ORDER BY level DESC, ord) AS n FROM v1) SELECT session, ord AS peak, level FROM r WHERE n = 1")
def t4_first_maximum(spark: SparkSession, sf: str) -> DataFrame:
    best = V.samples(spark, sf).groupBy("session").agg(F.max(F.struct("level", (-F.col("ord")).alias("o"))).alias("b"))
    return best.select("session", (-F.col("b.o")).alias("peak"), F.col("b.level").alias("level"))


@query("clicks", " SELECT session, row_number() OVER (PARTITION BY session ORDER BY ord) - 1 AS k, round(t, 6) AS t, false AS added FROM clicks UNION ALL SELECT session, count(*), round(max(t) + 1, 6), true FROM clicks GROUP BY 1")
def t6_union_knots(spark: SparkSession, sf: str) -> DataFrame:
    c = V.pulses(spark, sf, "click")
    given = with_ordinal(c, K, "ord", "k").select("session", "k", F.round("t", 6).alias("t"), F.lit(False).alias("added"))
    end = c.groupBy("session").agg(F.count("*").alias("k"), F.round(F.max("t") + 1, 6).alias("t"), F.lit(True).alias("added"))
    return given.unionByName(end)


@query("", "WITH known AS (SELECT * FROM (VALUES (0, 'red widget'), (1, 'blue bolt'), (2, 'absent')) k(pos, name)), have AS (SELECT DISTINCT p_name AS name FROM part), extra AS (SELECT name, 3 + row_number() OVER (ORDER BY name) - 1 AS pos FROM have WHERE name NOT IN (SELECT name FROM known)) SELECT name, pos FROM known WHERE name IN (SELECT name FROM have) UNION ALL SELECT name, pos FROM extra")
def t9_texture_order(spark: SparkSession, sf: str) -> DataFrame:
    known = spark.createDataFrame([(0, "red widget"), (1, "blue bolt"), (2, "absent")], "pos long, name string")
    have = V.table(spark, sf, "part").select(F.col("p_name").alias("name")).distinct()
    extra = have.join(known, "name", "left_anti")
    placed = extra.withColumn("pos", (F.row_number().over(Window.orderBy("name")) + 2).cast("long"))  # distinct names
    return known.join(have, "name", "left_semi").select("name", "pos").unionByName(placed)


@query("v1", ", x AS (SELECT session, state, lag(state) OVER (PARTITION BY session ORDER BY ord) AS p FROM v1) SELECT session, count(*) FILTER (p IS NOT NULL AND state <> p) AS n, count(*) FILTER (p IS NOT NULL AND state <> p) >= 3 AS enough FROM x GROUP BY 1")
def w2_enough_transitions(spark: SparkSession, sf: str) -> DataFrame:
    s = V.samples(spark, sf)
    found = edges.transitions(s, K).groupBy("session").agg(F.count("*").alias("c"))
    return s.select("session").distinct().join(found, "session", "left").select("session", F.coalesce("c", F.lit(0)).alias("n"), (F.coalesce("c", F.lit(0)) >= 3).alias("enough"))
