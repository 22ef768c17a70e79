"""Views on the given tables that stand for recorded streams, in Spark and as common table expressions for DuckDB."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

K = ["session"]
_T0 = 1704067200000000  # 2024-01-01 in microseconds


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share; a temporary one only in local mode without that setting."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="spark-")
    return f"{root}/{name}-{uuid.uuid4().hex}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event rows with session, ord, t in seconds, and k from the properties."""
    e = table(spark, sf_dir, "events")
    micros = F.unix_micros(F.col("ts").cast("timestamp")) - F.lit(_T0)
    return e.select(F.col("user_id").alias("session"), F.col("event_id").alias("ord"), (micros / F.lit(1e6)).alias("t"), "event_type", "value", F.get_json_object("props", "$.k").cast("int").alias("k"))


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a sample of an analog level, a digital state and a wrapping counter."""
    counter = ((F.col("ord") * 977) % 65536 - 32768).alias("counter")
    return events(spark, sf_dir).select("session", "ord", "t", F.col("value").alias("level"), (F.col("value") > 20).alias("state"), counter, "event_type")


def traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir)
    return e.select(F.col("event_type").alias("plane"), (F.col("session") % 10).alias("roi"), "ord", "t", F.when(F.col("ord") % 17 != 0, F.col("value") / 100).alias("dff"), (1 + F.col("session") % 7).cast("double").alias("f0"))


def stimuli(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).filter("event_type = 'signup'")
    return e.select("ord", F.col("t").alias("start"), (F.col("t") + 3600).alias("stop"), "k", (F.col("k") % 4).alias("x"), (F.col("k") % 3).alias("y"), (F.col("k") % 8 * 45).alias("direction"), (F.floor(F.col("k") / 8) % 2 + 1).cast("int").alias("block"))


def pulses(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    return events(spark, sf_dir).filter(F.col("event_type") == kind).select("session", "ord", "t")


def trial_marks(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Odd purchases of a session start trials, even ones end them."""
    from ..operators.ordered import with_ordinal

    ranked = with_ordinal(pulses(spark, sf_dir, "purchase"), K, "ord", "n")
    return ranked.filter("n % 2 = 0").drop("n"), ranked.filter("n % 2 = 1").drop("n")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.ordered import with_ordinal

    ranked = with_ordinal(events(spark, sf_dir).select("session", "ord", "t"), K, "ord", "n")
    return ranked.select("session", "ord", "t", (F.col("n") * 7 + 1).alias("line"), F.floor(F.col("n") / 20).alias("trial"))


def raw_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of raw files made from parts: prefix, plane, trial and, for some, a cycle offset."""
    p = table(spark, sf_dir, "part")
    name = F.concat(F.lit("acq_20260917_13"), F.lpad((F.col("p_partkey") % 60).cast("string"), 2, "0"), F.lit("00_DMD"), (F.col("p_partkey") % 2 + 1).cast("string"), F.when(F.col("p_partkey") % 5 != 0, F.concat(F.lit("-TRIAL"), F.lpad((F.col("p_partkey") % 7 + 1).cast("string"), 6, "0"))).otherwise(""), F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("-CYCLE-"), F.lpad((F.col("p_size") * 10).cast("string"), 6, "0"))).otherwise(""), F.lit(".dat"))
    return p.select(F.col("p_partkey").alias("file_id"), name.alias("name"), F.col("p_size").alias("cycles"))


SQL = {
    "ev": f"SELECT user_id AS session, event_id AS ord, (epoch_us(ts) - {_T0}) / 1e6 AS t, event_type, value, (props->>'$.k')::INT AS k FROM events",
    "v1": "SELECT session, ord, t, value AS level, value > 20 AS state, (ord * 977) % 65536 - 32768 AS counter, event_type FROM ev",
    "v2": "SELECT event_type AS plane, session % 10 AS roi, ord, t, CASE WHEN ord % 17 <> 0 THEN value / 100 END AS dff, (1 + session % 7)::DOUBLE AS f0 FROM ev",
    "v3": "SELECT ord, t AS start, t + 3600 AS stop, k, k % 4 AS x, k % 3 AS y, k % 8 * 45 AS direction, ((k // 8) % 2 + 1)::INT AS block FROM ev WHERE event_type = 'signup'",
    "clicks": "SELECT session, ord, t FROM ev WHERE event_type = 'click'",
    "looks": "SELECT session, ord, t FROM ev WHERE event_type = 'view'",
    "marks": "SELECT session, ord, t, row_number() OVER (PARTITION BY session ORDER BY ord) - 1 AS n FROM ev WHERE event_type = 'purchase'",
    "starts": "SELECT session, ord, t FROM marks WHERE n % 2 = 0",
    "ends": "SELECT session, ord, t FROM marks WHERE n % 2 = 1",
    "v5": "SELECT session, ord, t, n * 7 + 1 AS line, n // 20 AS trial FROM (SELECT *, row_number() OVER (PARTITION BY session ORDER BY ord) - 1 AS n FROM ev)",
    "v9": "SELECT p_partkey AS file_id, 'acq_20260917_13' || lpad((p_partkey % 60)::VARCHAR, 2, '0') || '00_DMD' || (p_partkey % 2 + 1) || CASE WHEN p_partkey % 5 <> 0 THEN '-TRIAL' || lpad((p_partkey % 7 + 1)::VARCHAR, 6, '0') ELSE '' END || CASE WHEN p_partkey % 3 = 0 THEN '-CYCLE-' || lpad((p_size * 10)::VARCHAR, 6, '0') ELSE '' END || '.dat' AS name, p_size AS cycles FROM part",
}
_NEEDS = {"v1": ["ev"], "v2": ["ev"], "v3": ["ev"], "clicks": ["ev"], "looks": ["ev"], "marks": ["ev"], "starts": ["marks"], "ends": ["marks"], "v5": ["ev"]}


def with_views(names: str, query: str) -> str:
    """query after the definitions of the views it names; query may begin with more definitions, after a comma."""
    order: list[str] = []

    def add(name: str) -> None:
        for x in _NEEDS.get(name, []):
            add(x)
        if name not in order:
            order.append(name)

    for name in names.split():
        add(name)
    return "WITH " + ", ".join(f"{x} AS ({SQL[x]})" for x in order) + query
