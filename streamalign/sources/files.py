"""Inventories of raw files: names, sizes, choice and matching."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window


def file_inventory(spark: SparkSession, root: str, pattern: str = "*.dat") -> DataFrame:
    """path, name and size of the files below root; their content isn't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    return files.select("path", F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), F.col("length").alias("size"))


def parse_names(files: DataFrame, name: str = "name") -> DataFrame:
    """files with prefix, plane, trial (1 if not named) and offset (NULL if not chunked); NULL prefix: not supported."""
    part = lambda pattern: F.nullif(F.regexp_extract(name, pattern, 1), F.lit(""))
    return files.withColumns({
        "prefix": part(r"^(.*)_DMD\d"),
        "plane": part(r"_DMD(\d+)").cast("int"),
        "trial": F.coalesce(part(r"-TRIAL(\d+)").cast("int"), F.lit(1)),
        "offset": part(r"-CYCLE-(\d+)").cast("long"),
    })


def acquisition_time(prefix: Column) -> Column:
    """The time stamp YYYYMMDD_HHMMSS in a file's prefix; NULL if there is none."""
    return F.try_to_timestamp(F.regexp_extract(prefix, r"(\d{8}_\d{6})", 1), F.lit("yyyyMMdd_HHmmss"))


def cycle_counts(inventory: DataFrame, headers: DataFrame, keys: list[str]) -> DataFrame:
    """Whole cycles of each file: what lies after the first offset over the bytes of a cycle."""
    n = F.floor((F.col("size") - F.col("first_offset")) / F.col("bytes_per_cycle"))
    return inventory.join(headers, keys).withColumn("n_cycles", F.greatest(n, F.lit(0)))


def pick_file(candidates: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first candidate of each key in the given order, and how many there were."""
    w = Window.partitionBy(*keys)
    ranked = candidates.withColumns({"__n": F.row_number().over(w.orderBy(*order)), "n_candidates": F.count("*").over(w)})
    return ranked.filter("__n = 1").drop("__n")


def match_meta(planes: DataFrame, files: DataFrame) -> DataFrame:
    """How many files are named <prefix>_DMD<plane>.meta, in any case, for each plane; one is right."""
    named = files.groupBy(F.lower("name").alias("__name")).agg(F.count("*").alias("n"))
    wanted = planes.withColumn("__name", F.lower(F.concat(F.col("prefix"), F.lit("_DMD"), F.col("plane").cast("string"), F.lit(".meta"))))
    return wanted.join(named, "__name", "left").withColumn("n_matches", F.coalesce("n", F.lit(0))).drop("__name", "n")
