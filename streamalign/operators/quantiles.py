"""Exact percentiles of whole sessions, selected in two passes, so that no task has to hold a session's values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from .ordered import join_on, unused

#: The sketch of the first pass is off by up to n / ACCURACY ranks; keys with no more values than this are taken whole.
ACCURACY = 2000


def percentiles(rows: DataFrame, keys: list[str], value: Column | str, shares: list[float], accuracy: int = ACCURACY, more: list[Column] = ()) -> DataFrame:
    """Per key, n (its values) and q: the exact percentiles at these shares, linear between the two values around.

    The first pass makes a bounded sketch of each key, which brackets each percentile by two values a few ranks in
    `accuracy` apart. The second counts, within tasks, the values below each bracket and each distinct value inside it;
    only what is inside is shuffled and ordered. Counts tell whether the bracket holds the ranks, so the result
    is exact or an error. NULLs are left out; a key without values has NULL percentiles. keys may be empty. more: other aggregates
    of rows that the first pass is to add, with names.
    """
    names = [unused([*rows.columns, *keys], f"__p{i}") for i in range(len(keys))]
    x = F.col(value) if isinstance(value, str) else value
    named = {**{n: F.col(k) for k, n in zip(keys, names, strict=True)}, "__all": F.lit(0), "__x": x.cast("double")}
    full, group = rows.withColumns(named), [*names, "__all"]
    given = full.select(*named)
    span = 3 / accuracy
    ends = F.percentile_approx("__x", [min(1.0, max(0.0, s + d)) for s in shares for d in (-span, span)], accuracy)
    sketch = (full if more else given).groupBy(*group).agg(*more, F.count("__x").alias("n"), F.min("__x").alias("__min"), F.max("__x").alias("__max"), ends.alias("__ends"))
    whole = F.col("n") <= accuracy
    wanted = F.array(*[
        F.struct(F.when(whole, F.col("__min")).otherwise(F.col("__ends")[2 * i]).alias("lo"), F.when(whole, F.col("__max")).otherwise(F.col("__ends")[2 * i + 1]).alias("hi"), (F.lit(float(s)) * (F.col("n") - 1)).alias("rank"))
        for i, s in enumerate(shares)
    ])
    others = [c for c in sketch.columns if c not in (*group, "n", "__min", "__max", "__ends")]
    brackets = sketch.select(*group, *others, "n", wanted.alias("__wanted"))
    placed = join_on(given.filter(F.col("__x").isNotNull()), brackets.select(*group, "__wanted"), group).select(*group, "__x", F.posexplode("__wanted").alias("__i", "__w"))
    inside = placed.filter(F.col("__x") <= F.col("__w.hi")).groupBy(*group, "__i", F.when(F.col("__x") >= F.col("__w.lo"), F.col("__x")).alias("__x")).agg(F.count("*").alias("__c"), F.first("__w.rank").alias("__rank"))
    upto = F.sum("__c").over(Window.partitionBy(*group, "__i").orderBy(F.col("__x").asc_nulls_first()))  # NULL: all below the bracket
    low, high = F.floor("__rank"), F.ceil("__rank")
    first_over = lambda r: F.min(F.when(F.col("__upto") > r, F.struct("__upto", "__x")))
    found = inside.withColumn("__upto", upto).groupBy(*group, "__i").agg(first_over(low)["__x"].alias("__a"), first_over(high)["__x"].alias("__b"), F.first("__rank").alias("__rank"))
    a, b, rank = F.col("__a"), F.col("__b"), F.col("__rank")
    between = F.when(a == b, a).otherwise((high - rank) * a + (rank - low) * b)
    exact = F.when(a.isNotNull() & b.isNotNull(), between).otherwise(F.raise_error(F.lit("the sketch doesn't bracket a percentile")).cast("double"))
    listed = found.groupBy(*group).agg(F.transform(F.array_sort(F.collect_list(F.struct("__i", exact.alias("v")))), lambda s: s["v"]).alias("q"))
    out = join_on(brackets.drop("__wanted"), listed, group, "left")
    return out.select(*[F.col(n).alias(k) for k, n in zip(keys, names, strict=True)], *others, "n", "q")


def percentile(rows: DataFrame, keys: list[str], value: Column | str, share: float, name: str, accuracy: int = ACCURACY) -> DataFrame:
    """Per key, one exact percentile, in a column of this name."""
    return percentiles(rows, keys, value, [share], accuracy).select(*keys, F.col("q")[0].alias(name))


def median(rows: DataFrame, keys: list[str], value: Column | str, name: str, accuracy: int = ACCURACY) -> DataFrame:
    """Per key, the exact median, in a column of this name."""
    return percentile(rows, keys, value, 0.5, name, accuracy)
