"""Clock origin, pulse cleaning, filters and checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from .ordered import first_rows, join_on, paired, with_ordinal
from .quantiles import percentiles


def clock_origin(starts: DataFrame, keys: list[str], at: str = "t", order: str = "ord") -> DataFrame:
    """The time of each session's first recorded start; recorded order counts, not time."""
    return starts.groupBy(*keys).agg(F.min_by(at, order).alias("time_reference"))


def normalize_clock(stream: DataFrame, origin: DataFrame, keys: list[str], at: str = "t") -> DataFrame:
    """stream with times relative to the origin; sessions without one are left out."""
    return join_on(stream, origin, keys).withColumn(at, F.col(at) - F.col("time_reference")).drop("time_reference")


def recording_onset(analog: DataFrame, digital: DataFrame, keys: list[str], at: str = "t", order: str = "ord") -> DataFrame:
    """The lesser of the first recorded analog and digital times."""
    first = lambda df, name: df.groupBy(*keys).agg(F.min_by(at, order).alias(name))
    both = join_on(first(analog, "__a"), first(digital, "__d"), keys)
    return both.select(*keys, F.least("__a", "__d").alias("recording_start"))


def startup_pulses(starts: DataFrame, ends: DataFrame, keys: list[str], at: str = "t", order: str = "ord", longest: float = 0.1, share: float = 0.1, continuous: bool = False) -> DataFrame:
    """Per session, whether its first start/end pair is a startup artifact: shorter than `longest`, and unless
    continuous also shorter than `share` of the median of the later pairs, of which there must be one.
    """
    both = paired(starts.select(*keys, order, at), ends.select(*keys, order, at), keys, order).filter("l is not null and r is not null")
    pairs = both.select(*keys, "pair", (F.col("r")[at] - F.col("l")[at]).alias("__d"))
    counts = [F.count("*").alias("n_pairs"), F.max(F.when(F.col("pair") == 0, F.col("__d"))).alias("first_duration")]
    found = percentiles(pairs, keys, F.when(F.col("pair") > 0, F.col("__d")), [0.5], more=counts)
    found = found.select(*keys, "n_pairs", "first_duration", F.col("q")[0].alias("later_median"))
    short = (F.col("first_duration") > 0) & (F.col("first_duration") < longest)
    if not continuous:
        short = short & (F.col("n_pairs") >= 2) & (F.col("first_duration") < share * F.col("later_median"))
    return found.withColumn("drop_first", F.coalesce(short, F.lit(False)))


def trim_startup_pulse(starts: DataFrame, ends: DataFrame, stimulus: DataFrame, keys: list[str], at: str = "t", order: str = "ord", **options) -> tuple[DataFrame, DataFrame, DataFrame]:
    """starts, ends and stimulus pulses without a startup pair and the stimulus pulses before the next start."""
    drop = startup_pulses(starts, ends, keys, at, order, **options).filter("drop_first").select(*keys)
    # what goes is told by the first rows in order, without numbering all rows
    s = first_rows(starts, keys, order, [at], 2).select(*keys, F.get("rows", F.lit(0))[order].alias("__start"), F.get("rows", F.lit(1))[at].alias("__from"))
    e = ends.groupBy(*keys).agg(F.min(order).alias("__end"))
    cut = join_on(join_on(drop, s, keys), e, keys, "left")
    marked = lambda df, c: join_on(df, cut.select(*keys, c), keys, "left")
    kept = [marked(df, c).filter(F.col(c).isNull() | (F.col(order) != F.col(c))).drop(c) for df, c in ((starts, "__start"), (ends, "__end"))]
    stim = marked(stimulus, "__from").filter(F.col("__from").isNull() | (F.col(at) >= F.col("__from"))).drop("__from")
    return *kept, stim


def trim_unterminated_trial(starts: DataFrame, ends: DataFrame, clock: DataFrame, keys: list[str], at: str = "t", order: str = "ord") -> tuple[DataFrame, DataFrame]:
    """starts and clock samples without a last trial that has no end: the last start goes, and samples after the last end.

    Only sessions with one start more than ends, the last start after the last end, are cut; a single start without
    an end is kept. unterminated_report tells which sessions have other mismatches.
    """
    report = unterminated_report(starts, ends, keys, at, order).filter("verdict = 'cut'").select(*keys, F.col("last_end").alias("__last_end"), F.col("last_start_order").alias("__last"))
    s = join_on(starts, report, keys, "left").filter(F.col("__last").isNull() | (F.col(order) != F.col("__last"))).drop("__last", "__last_end")
    c = join_on(clock, report, keys, "left").filter(F.col("__last_end").isNull() | (F.col(at) <= F.col("__last_end"))).drop("__last", "__last_end")
    return s, c


def unterminated_report(starts: DataFrame, ends: DataFrame, keys: list[str], at: str = "t", order: str = "ord") -> DataFrame:
    """Per session the counts and what follows: matched, open (one start, no end), cut, or mismatch."""
    s = starts.groupBy(*keys).agg(F.count("*").alias("n_starts"), F.max_by(at, order).alias("last_start"), F.max(order).alias("last_start_order"))
    e = ends.groupBy(*keys).agg(F.count("*").alias("n_ends"), F.max_by(at, order).alias("last_end"))
    both = join_on(s, e, keys, "left").withColumn("n_ends", F.coalesce("n_ends", F.lit(0)))
    verdict = (
        F.when((F.col("n_starts") == 1) & (F.col("n_ends") == 0), "open")
        .when(F.col("n_starts") == F.col("n_ends"), "matched")
        .when((F.col("n_starts") == F.col("n_ends") + 1) & (F.col("last_start") > F.col("last_end")), "cut")
        .otherwise("mismatch")
    )
    return both.withColumn("verdict", verdict)


def keep_last_n(pulses: DataFrame, n: int, keys: list[str], order: str = "ord") -> DataFrame:
    """The last n pulses of each session; a session with fewer keeps all (count them with violations)."""
    total = pulses.groupBy(*keys).agg(F.count("*").alias("__total"))
    return join_on(with_ordinal(pulses, keys, order, "__n"), total, keys).filter(F.col("__n") >= F.col("__total") - n).drop("__n", "__total")


def continuous_markers(starts: DataFrame, stops: DataFrame, keys: list[str], at: str = "t") -> DataFrame:
    """Per session, whether there is exactly one finite start and at most one finite stop, which comes after it."""
    s = starts.groupBy(*keys).agg(F.count(at).alias("n_starts"), F.min(at).alias("start"))
    e = stops.groupBy(*keys).agg(F.count(at).alias("n_stops"), F.min(at).alias("stop"))
    both = join_on(s, e, keys, "left").withColumn("n_stops", F.coalesce("n_stops", F.lit(0)))
    fine = (F.col("n_starts") == 1) & (F.col("n_stops") <= 1) & (F.col("stop").isNull() | (F.col("stop") > F.col("start")))
    return both.withColumn("valid", fine)


def drop_untimed(samples: DataFrame, keys: list[str], at: str = "t") -> tuple[DataFrame, DataFrame]:
    """Samples that have a time, and per key how many were dropped."""
    return samples.filter(F.col(at).isNotNull()), samples.groupBy(*keys).agg(F.count_if(F.col(at).isNull()).alias("n_dropped"))


def filled_columns(df: DataFrame, group: list[str]) -> DataFrame:
    """Per group, which columns have a value: what a writer of one table per group keeps."""
    rest = [c for c in df.columns if c not in group]
    counts = df.groupBy(*group).agg(*[F.count(c).alias(c) for c in rest])
    return counts.select(*group, F.array_compact(F.array(*[F.when(F.col(c) > 0, F.lit(c)) for c in rest])).alias("columns"))


def assigned_presentations(df: DataFrame, trial: str = "trial") -> DataFrame:
    """Rows with a trial index that isn't negative; all rows if there is no such column."""
    return df.filter(F.col(trial) >= 0) if trial in df.columns else df


def planes_with_sources(planes: DataFrame, traces: DataFrame, keys: list[str]) -> DataFrame:
    """planes and whether each has traces."""
    have = traces.select(*keys).distinct().withColumn("__has", F.lit(True))
    return join_on(planes, have, keys, "left").withColumn("has_sources", F.coalesce("__has", F.lit(False))).drop("__has")


def constant_settings(epochs: DataFrame, keys: list[str], settings: list[str]) -> DataFrame:
    """Per key, each setting's one value, and whether it is the same, and present, in all epochs."""
    one = [F.max(c).alias(c) for c in settings]
    agrees = [((F.count_distinct(c) == 1) & (F.count(c) == F.count("*"))).alias(f"{c}_agrees") for c in settings]
    return epochs.groupBy(*keys).agg(*one, *agrees)


def consensus(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Per key, the one finite value that all its rows have, NULL if they differ, and whether there is one.

    Missing values and infinities are left out; a key without any finite value agrees on nothing.
    """
    finite = F.when(F.abs(F.col(value)) < float("inf"), F.col(value))
    one = constant_settings(rows.select(*keys, finite.alias(value)).filter(F.col(value).isNotNull()), keys, [value])
    agreed = join_on(rows.select(*keys).distinct(), one, keys, "left").withColumn("agrees", F.coalesce(F.col(f"{value}_agrees"), F.lit(False)))
    return agreed.select(*keys, F.when(F.col("agrees"), F.col(value)).alias(value), "agrees")


def sampling_rate(rows: DataFrame, names: list[str], most: float = float("inf")) -> DataFrame:
    """rows with hz, the rate that the named columns give, up to `most`, and valid: there is one, all agree, and it is positive and finite.

    Nothing is assumed for a missing rate.
    """
    given = F.array_distinct(F.array_compact(F.array(*names)))
    return rows.withColumn("hz", F.when(F.size(given) > 0, F.least(F.lit(most), F.coalesce(*names)))).withColumn("valid", (F.size(given) == 1) & F.coalesce((F.get(given, 0) > 0) & (F.get(given, 0) < float("inf")), F.lit(False)))


def attach_contrast(rows: DataFrame, keys: list[str], contrast: str = "contrast", blank: str = "is_blank") -> DataFrame:
    """rows with contrast 0 on blanks and else the one contrast that isn't 0; NULL if there are several."""
    one = rows.groupBy(*keys).agg(F.when(F.count_distinct(F.when(F.col(contrast) != 0, F.col(contrast))) == 1, F.max(F.when(F.col(contrast) != 0, F.col(contrast)))).alias("__c"))
    return join_on(rows, one, keys).withColumn("attached_contrast", F.when(F.col(blank), F.lit(0.0)).otherwise(F.col("__c"))).drop("__c")


def lookup_url(rows: DataFrame, urls: DataFrame, name: str, is_movie: Column) -> DataFrame:
    """rows with the url whose name matches without regard to case; '' for other names and for rows that aren't movies."""
    known = urls.select(F.lower("name").alias("__name"), "url").dropDuplicates(["__name"])
    return rows.join(known, F.lower(name) == F.col("__name"), "left").withColumn("url", F.when(is_movie, F.coalesce("url", F.lit(""))).otherwise("")).drop("__name")


def column_alias(df: DataFrame, candidates: list[str]) -> str:
    """The first of the candidates that df has."""
    for c in candidates:
        if c in df.columns:
            return c
    raise ValueError(f"none of the columns {candidates}")


def violations(df: DataFrame, keys: list[str], rules: dict[str, Column]) -> DataFrame:
    """keys, rule, n_bad: how many rows break each rule, for every key and rule, so that callers decide what fails."""
    counted = df.groupBy(*keys).agg(*[F.count_if(bad).alias(name) for name, bad in rules.items()])
    return counted.unpivot(keys, list(rules), "rule", "n_bad")


def nonunit_starts(lines: DataFrame, keys: list[str], line: str = "line", order: str = "ord") -> DataFrame:
    """Trials (keys) whose first recorded line isn't 1, with that line."""
    return lines.groupBy(*keys).agg(F.min_by(line, order).alias("first_line")).filter("first_line <> 1")


def latest_per_key(df: DataFrame, keys: list[str], by: list[Column]) -> DataFrame:
    """The first row of each key in the given order."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*by))).filter("__n = 1").drop("__n")
