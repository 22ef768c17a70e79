"""Previous rows, running sums, ordinals, carried values and brackets along a stream that no single task has to hold.

Streams are cut into stretches of their order column. Windows run within (keys, stretch); what crosses a stretch's
edge comes from one summary row for each stretch, which is added to the stretch's own rows. So one long session is
spread over many tasks, and a step shuffles its rows once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

#: Width of a stretch in the units of the order column.
WIDTH = 1 << 16
#: Rows of a stretch that is cut by quantiles, and how many of these a key has at most.
DEPTH, SPLITS = 1 << 16, 256


def join_on(left: DataFrame, right: DataFrame, columns: list[str], how: str = "inner") -> DataFrame:
    """An equi-join in which NULL keys match; the result has the columns once."""
    renamed = right.withColumnsRenamed({c: f"__r_{c}" for c in columns})
    same = reduce(lambda a, b: a & b, [left[c].eqNullSafe(renamed[f"__r_{c}"]) for c in columns])
    return left.join(renamed, same, how).drop(*[f"__r_{c}" for c in columns])


def unused(names: list[str], base: str) -> str:
    """base, lengthened until no name begins with it in any case."""
    while any(n.lower().startswith(base.lower()) for n in names):
        base += "_"
    return base


def small(df: DataFrame, most: int = 100_000) -> DataFrame:
    """df marked for broadcast after a check that it has at most `most` rows."""
    if df.limit(most + 1).count() > most:
        raise ValueError(f"over {most} rows are not broadcast")
    return F.broadcast(df)


def _cut(df: DataFrame, order: str, width: float, name: str) -> DataFrame:
    return df.withColumn(name, F.floor(F.col(order) / F.lit(width)).cast("long"))


def _cut_evenly(df: DataFrame, keys: list[str], at: str, name: str) -> DataFrame:
    """df with stretches of about DEPTH rows, whatever the unit of `at`: a bounded sketch of each key splits it at quantiles.

    Rows at one position stay together. A key has up to SPLITS stretches, and keys of up to DEPTH rows have one.
    """
    splits = unused(df.columns, "__splits")
    shares = [i / SPLITS for i in range(1, SPLITS)]
    per = df.groupBy(*keys).agg(F.count("*").alias("__n"), F.percentile_approx(at, shares, 4 * SPLITS).alias("__q"))
    # every so many quantiles, so that there are about as many stretches as the key has multiples of DEPTH
    every = F.greatest(F.lit(1), F.floor(SPLITS / F.ceil(F.col("__n") / DEPTH)))
    per = per.select(*keys, F.when(F.col("__n") > DEPTH, F.array_distinct(F.filter("__q", lambda _, i: (i + 1) % every == 0))).otherwise(F.array().cast("array<double>")).alias(splits))
    return join_on(df, per, keys).withColumn(name, F.size(F.filter(splits, lambda s: s <= F.col(at))).cast("long")).drop(splits)


def with_carries(df: DataFrame, keys: list[str], order: str | list[str], previous: list[str] = (), following: list[str] = (), sums: dict[str, Column] | None = None, width: float | None = WIDTH) -> DataFrame:
    """df with what its rows need of others, from one cut into stretches, one summary row for each, and one shuffle of the rows.

    previous: prev_<column> of the row before and has_prev; following: next_<column> of the row after and has_next, all
    NULL or false where there is none. sums: running sums up to each row, NULL counting as 0, by name. Of several order
    columns the first, a number, is cut; without a width it is cut at quantiles.
    """
    order = [order] if isinstance(order, str) else order
    by = F.struct(*order)
    sums = sums or {}
    own = unused([*df.columns, *sums, *(f"{p}_{c}" for p, cs in (("prev", previous), ("next", following)) for c in cs)], "__s")
    at, is_row, carry, before, after = (f"{own}_{x}" for x in ("stretch", "row", "carry", "before", "after"))
    added = {f"{own}_v{i}": F.coalesce(v, F.lit(0)) for i, v in enumerate(sums.values())}
    cut = (_cut_evenly(df, keys, order[0], at) if width is None else _cut(df, order[0], width, at)).withColumns(added)
    rows = {before: F.struct(*previous) if previous else None, after: F.struct(*following) if following else None}
    ends = [f(rows[n], by).alias(n) for n, f in ((before, F.max_by), (after, F.min_by)) if rows[n] is not None]
    per = cut.groupBy(*keys, at).agg(*ends, *[F.sum(v).alias(v) for v in added])
    w = Window.partitionBy(*keys).orderBy(at)
    earlier = w.rowsBetween(Window.unboundedPreceding, -1)
    carried = [f(n).over(w).alias(n) for n, f in ((before, F.lag), (after, F.lead)) if rows[n] is not None]
    carries = per.select(*keys, at, F.struct(F.lit(1).alias("one"), *carried).alias(carry), *[F.coalesce(F.sum(v).over(earlier), F.lit(0)).alias(v) for v in added])
    both = cut.withColumn(is_row, F.lit(True)).unionByName(carries.withColumn(is_row, F.lit(False)), allowMissingColumns=True)
    stretch = Window.partitionBy(*keys, at).orderBy(is_row, *order)  # the carry comes first
    upto = stretch.rowsBetween(Window.unboundedPreceding, 0)
    found = {}
    if previous:
        found[before] = F.lag(F.when(F.col(is_row), rows[before]).otherwise(F.col(carry)[before])).over(stretch)
    if following:
        found[after] = F.coalesce(F.lead(rows[after]).over(stretch), F.first(carry, True).over(upto)[after])
    both = both.withColumns(found | {n: F.sum(v).over(upto) for n, v in zip(sums, added, strict=True)}).filter(is_row)
    out = {}
    for n, prefix, columns in ((before, "prev", previous), (after, "next", following)):
        if columns:
            out |= {**{f"{prefix}_{c}": F.col(n)[c] for c in columns}, f"has_{prefix}": F.col(n).isNotNull()}
    return both.withColumns(out).drop(at, is_row, carry, before, after, *added)


def with_previous(df: DataFrame, keys: list[str], order: str, columns: list[str], width: float = WIDTH) -> DataFrame:
    """df with prev_<column> of the row before, NULL for the first row of each key, and has_prev if there is one."""
    return with_carries(df, keys, order, previous=columns, width=width)


def with_next(df: DataFrame, keys: list[str], order: str, columns: list[str], width: float = WIDTH) -> DataFrame:
    """df with next_<column> of the row after; has_next says if there is one."""
    return with_carries(df, keys, order, following=columns, width=width)


def with_running_sum(df: DataFrame, keys: list[str], order: str, value: Column, name: str, width: float = WIDTH) -> DataFrame:
    """df with the sum of value over the rows up to each, NULL counting as 0."""
    return with_carries(df, keys, order, sums={name: value}, width=width)


def with_ordinal(df: DataFrame, keys: list[str], order: str, name: str = "ordinal", width: float = WIDTH) -> DataFrame:
    """df with the position of each row within its key, from 0."""
    return with_running_sum(df, keys, order, F.lit(1), name, width).withColumn(name, (F.col(name) - 1).cast("long"))


def paired(left: DataFrame, right: DataFrame, keys: list[str], order: str, width: float = WIDTH) -> DataFrame:
    """keys, pair (from 0), and as structs l and r the rows of both in that position of their order; NULL where one has none.

    Both streams are numbered in one step and meet in one grouping. NULL keys are keys.
    """
    own = unused([*keys, order, *left.columns, *right.columns], "__o")
    none = lambda df: F.lit(None).cast(df.select(F.struct(*df.columns)).schema[0].dataType)
    a = left.select(*keys, F.col(order).alias(own), F.lit(0).alias(f"{own}_side"), F.struct(*left.columns).alias("l"), none(right).alias("r"))
    b = right.select(*keys, F.col(order).alias(own), F.lit(1).alias(f"{own}_side"), none(left).alias("l"), F.struct(*right.columns).alias("r"))
    ranked = with_ordinal(a.unionByName(b), [*keys, f"{own}_side"], own, "pair", width)
    return ranked.groupBy(*keys, "pair").agg(F.first("l", True).alias("l"), F.first("r", True).alias("r"))


def first_rows(df: DataFrame, keys: list[str], order: str, columns: list[str], n: int, last: bool = False, slices: int = 64) -> DataFrame:
    """Per key, `rows`: an array of the first (or last) n rows as structs (order first), in order; n is small.

    No task orders a session: each of `slices` parts of a key keeps its own n in order, and only these are merged.
    """
    row = F.struct(order, *[c for c in columns if c != order])
    part = unused(df.columns, "__part")
    ranked = df.withColumn(part, F.pmod(F.xxhash64(order, *columns), F.lit(slices)))
    by = F.col(order).desc() if last else F.col(order).asc()
    kept = ranked.withColumn(f"{part}_n", F.row_number().over(Window.partitionBy(*keys, part).orderBy(by))).filter(F.col(f"{part}_n") <= n)
    listed = kept.groupBy(*keys).agg(F.array_sort(F.collect_list(row)).alias("rows"))
    return listed.withColumn("rows", F.slice("rows", F.greatest(F.lit(1), F.size("rows") - n + 1), F.lit(n)) if last else F.slice("rows", 1, n))


def bracket(queries: DataFrame, anchors: DataFrame, keys: list[str], at: str, value: str, width: float | None = None, tie: str | None = None) -> DataFrame:
    """queries with lo and hi: the anchors (struct x, y) at or before, and at or after, each query's position.

    queries and anchors both have keys and `at`; anchors have `value` too, which may be NULL: such an anchor still
    is the neighbour. A query with a NULL position has no neighbours. Anchors have distinct positions, or a number
    `tie`, by which the largest of those at one position is taken on both sides. Without a width, stretches are cut at
    quantiles of the positions of both.
    """
    names = [c for c in queries.columns if c not in keys]
    own = unused([*queries.columns, *keys], "__b")
    stretch, x, anchor, row, carry, rank = (f"{own}_{c}" for c in ("stretch", "x", "anchor", "row", "carry", "rank"))
    point = "struct<x: double, y: double>"
    asked = queries.select(*keys, F.col(at).cast("double").alias(x), F.lit(None).cast(point).alias(anchor), F.struct(*names).alias(row), F.lit(None).cast("double").alias(rank))
    given = anchors.filter(F.col(at).isNotNull()).select(*keys, F.col(at).cast("double").alias(x), F.struct(F.col(at).cast("double").alias("x"), F.col(value).cast("double").alias("y")).alias(anchor), F.lit(None).cast(asked.schema[row].dataType).alias(row), (F.lit(0.0) if tie is None else F.col(tie).cast("double")).alias(rank))
    both = asked.filter(F.col(x).isNotNull()).unionByName(given)
    both = _cut_evenly(both, keys, x, stretch) if width is None else _cut(both, x, width, stretch)
    place = lambda r: F.when(F.col(anchor).isNotNull(), F.struct(x, r))
    ends = both.groupBy(*keys, stretch).agg(F.min_by(anchor, place(-F.col(rank))).alias("first"), F.max_by(anchor, place(F.col(rank))).alias("last"))
    w = Window.partitionBy(*keys).orderBy(stretch)
    before, after = F.last("last", True).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.last("first", True).over(Window.partitionBy(*keys).orderBy(F.col(stretch).desc()).rowsBetween(Window.unboundedPreceding, -1))
    carries = ends.select(*keys, stretch, F.struct(before.alias("before"), after.alias("after")).alias(carry))
    after_all = F.col(rank).asc_nulls_last()  # a query comes after all anchors at its position, whichever way
    inside = Window.partitionBy(*keys, stretch).orderBy(x, after_all)
    back = Window.partitionBy(*keys, stretch).orderBy(F.col(x).desc(), after_all)  # a frame up to the end would be gone through for every row
    carried = F.first(carry, True).over(Window.partitionBy(*keys, stretch))
    lo = F.coalesce(F.last(anchor, True).over(inside.rangeBetween(Window.unboundedPreceding, 0)), carried["before"])
    hi = F.coalesce(F.last(anchor, True).over(back.rangeBetween(Window.unboundedPreceding, 0)), carried["after"])
    found = both.unionByName(carries, allowMissingColumns=True).withColumns({"lo": lo, "hi": hi}).filter(F.col(row).isNotNull())
    found = found.select(*keys, *[F.col(row)[c].alias(c) for c in names], "lo", "hi")
    none = F.lit(None).cast(point)
    return found.unionByName(queries.filter(F.col(at).isNull()).select(*keys, *names, none.alias("lo"), none.alias("hi")))


def between(at: Column) -> Column:
    """The line between lo and hi at this position; lo's value where it lies on lo."""
    lo, hi = F.col("lo"), F.col("hi")
    inside = lo["y"] + (at - lo["x"]) * F.try_divide(hi["y"] - lo["y"], hi["x"] - lo["x"])
    return F.when(lo["x"] == at, lo["y"]).otherwise(inside)


def window_samples(windows: DataFrame, samples: DataFrame, keys: list[str], start: str, stop: str, at: str, width: float) -> DataFrame:
    """Pairs of a window and a sample of the same keys with start <= at < stop, both with all their columns.

    Windows are listed in each bucket of `width` that they touch; a sample lies in one bucket, so no pair comes twice.
    """
    listed = windows.filter(F.col(start) < F.col(stop)).withColumn("__bucket", F.explode(F.sequence(F.floor(F.col(start) / width), F.floor(F.col(stop) / width))))
    placed = samples.withColumn("__bucket", F.floor(F.col(at) / width))
    return listed.join(placed, [*keys, "__bucket"]).filter((F.col(at) >= F.col(start)) & (F.col(at) < F.col(stop))).drop("__bucket")


def as_of(events: DataFrame, starts: DataFrame, keys: list[str], at: str, value: str, width: float | None = None) -> DataFrame:
    """events with the value of the last start at or before each, as `as_of` (double)."""
    return bracket(events, starts, keys, at, value, width).withColumn("as_of", F.col("lo")["y"]).drop("lo", "hi")
