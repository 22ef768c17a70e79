"""Stimulus logs: events, movie runs, grating blocks, stops, photodiode transitions and presentations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .ordered import join_on, small, with_next, with_ordinal, with_previous, with_running_sum
from .quantiles import median


def parse_log(log: DataFrame, value: str = "value") -> DataFrame:
    """log with kind (the text before the first hyphen) and number (the text after it as a double, NULL if none)."""
    text = F.coalesce(F.col(value), F.lit(""))
    return log.withColumns({"kind": F.regexp_extract(text, r"^([^-]*)", 1), "number": F.nullif(F.regexp_extract(text, r"^[^-]*-(.*)$", 1), F.lit("")).try_cast("double")})


def session_end(log: DataFrame, keys: list[str], frame: str = "frame") -> DataFrame:
    """Per session, the frame of END or EndFrame, whether both agree if both are there, and the last frame of all."""
    of = lambda kind: F.max(F.when(F.col("kind") == kind, F.col(frame)))
    both = log.groupBy(*keys).agg(of("END").alias("__a"), of("EndFrame").alias("__b"), F.max(frame).alias("last_frame"))
    return both.select(*keys, F.coalesce("__b", "__a").alias("end_frame"), F.coalesce(F.col("__a") == F.col("__b"), F.lit(True)).alias("agrees"), "last_frame")


def movie_runs(log: DataFrame, keys: list[str], order: str = "ord", frame: str = "frame") -> tuple[DataFrame, DataFrame]:
    """Movie frames with their run, and the runs: a run begins at counter 1 and goes on by ones.

    Runs carry n_frames, first and last frame, and whether the counter ever skips or repeats.
    """
    frames = log.filter("kind = 'MovieFrame'").select(*keys, order, frame, F.col("number").cast("int").alias("counter"))
    marked = with_running_sum(frames, keys, order, F.when(F.col("counter") == 1, 1).otherwise(0), "run")
    seen = with_previous(marked, keys, order, ["counter"]).withColumn("__bad", (F.col("counter") != 1) & (~F.col("has_prev") | (F.col("counter") != F.col("prev_counter") + 1)))
    runs = seen.groupBy(*keys, "run").agg(F.count("*").alias("n_frames"), F.min(frame).alias("first_frame"), F.max(frame).alias("last_frame"), F.max("__bad").alias("broken"))
    return marked, runs


def shared_frame_flags(frames: DataFrame, keys: list[str], order: str = "ord", frame: str = "frame") -> DataFrame:
    """frames with `shared`: 1 where the row before or after has the same display frame."""
    both = with_next(with_previous(frames, keys, order, [frame]).drop("has_prev"), keys, order, [frame]).drop("has_next")
    same = F.coalesce(F.col(frame) == F.col(f"prev_{frame}"), F.lit(False)) | F.coalesce(F.col(frame) == F.col(f"next_{frame}"), F.lit(False))
    return both.withColumn("shared", same.cast("int")).drop(f"prev_{frame}", f"next_{frame}")


def grating_blocks(log: DataFrame, keys: list[str], per_block: int = 9, order: str = "ord", frame: str = "frame") -> DataFrame:
    """Gratings with start and end frame, block and position; a last start without an end stops at the last frame.

    matched says whether the next grating event is the end of the same angle.
    """
    events = log.filter("kind in ('GratingStart', 'GratingEnd')").select(*keys, order, frame, "kind", F.col("number").alias("angle"))
    ahead = with_next(events, keys, order, ["kind", "angle", frame]).filter("kind = 'GratingStart'")
    last = log.groupBy(*keys).agg(F.max(frame).alias("__last"))
    ranked = join_on(with_ordinal(ahead, keys, order, "__n"), last, keys)
    matched = F.coalesce((F.col("next_kind") == "GratingEnd") & (F.col("next_angle") == F.col("angle")), F.lit(False))
    stop = F.when(F.col("has_next"), F.col(f"next_{frame}")).otherwise(F.col("__last"))
    return ranked.select(*keys, order, "angle", F.col(frame).alias("start_frame"), stop.alias("stop_frame"), matched.alias("matched"), F.floor(F.col("__n") / per_block).alias("block"), (F.col("__n") % per_block).alias("position"))


def grating_set_report(gratings: DataFrame, keys: list[str], per_block: int = 9) -> DataFrame:
    """Per block, how many gratings and distinct angles, and whether it is a full set."""
    found = gratings.groupBy(*keys, "block").agg(F.count("*").alias("n"), F.count_distinct("angle").alias("n_angles"))
    return found.withColumn("full", (F.col("n") == per_block) & (F.col("n_angles") == per_block))


def stop_frames(runs: DataFrame, frames: DataFrame, ends: DataFrame, keys: list[str], frame: str = "frame") -> DataFrame:
    """runs with stop_frame, its source and whether the run is partial.

    The next run's first frame ends a run; the session's end the last one; without it the last frame plus the
    session's median step between movie frames, held at the last logged frame.
    """
    steps = with_previous(frames.select(*keys, "ord", frame), keys, "ord", [frame])
    step = F.col(frame) - F.col(f"prev_{frame}")
    cadence = median(steps, keys, F.when(step > 0, step), "__cadence")
    ahead = join_on(join_on(with_next(runs, keys, "run", ["first_frame"]), cadence, keys, "left"), ends, keys, "left")
    tail = F.least(F.col("last_frame") + F.coalesce(F.col("__cadence"), F.lit(0.0)), F.col("session_last").cast("double"))
    source = F.when(F.col("has_next"), "next_run").when(F.col("end_frame").isNotNull(), "session_end").otherwise("cadence")
    stop = F.when(F.col("has_next"), F.col("next_first_frame").cast("double")).when(F.col("end_frame").isNotNull(), F.col("end_frame").cast("double")).otherwise(tail)
    return ahead.select(*keys, "run", "n_frames", "first_frame", "last_frame", stop.alias("stop_frame"), source.alias("source"), (source == "cadence").alias("partial"))


def log_transitions(log: DataFrame, keys: list[str], initial_low: bool = False, terminal_low: bool = False, order: str = "ord", frame: str = "frame") -> DataFrame:
    """Photodiode changes: keys, order, frame, state.

    With initial_low, a first state that is high counts as a change. With terminal_low, a final high state falls a
    frame after EndFrame (or END).
    """
    rows = log.filter("kind = 'Photodiode'").select(*keys, order, frame, (F.col("number") == 1).alias("state"))
    seen = with_previous(rows, keys, order, ["state"])
    changed = F.col("has_prev") & (F.col("state") != F.col("prev_state"))
    if initial_low:
        changed = changed | (~F.col("has_prev") & F.col("state"))
    out = seen.filter(changed).select(*keys, order, frame, "state")
    if terminal_low:
        last = rows.groupBy(*keys).agg(F.max_by("state", order).alias("__high"), F.max(order).alias("__o"))
        fall = join_on(last, session_end(log, keys, frame), keys).filter("__high and end_frame is not null")
        out = out.unionByName(fall.select(*keys, (F.col("__o") + 1).alias(order), (F.col("end_frame") + 1).alias(frame), F.lit(False).alias("state")))
    return out


def match_presentations(observed: DataFrame, table: DataFrame, keys: list[str], order: str = "ord", row: str = "row_idx") -> DataFrame:
    """The n-th observed presentation beside the n-th table row; agrees is NULL where one side lacks it."""
    o = with_ordinal(observed, keys, order, "n").select(*keys, "n", F.col("kind").alias("observed_kind"))
    t = with_ordinal(table, keys, row, "n").select(*keys, "n", F.col("kind").alias("table_kind"))
    return o.join(t, [*keys, "n"], "full").withColumn("agrees", F.col("observed_kind") == F.col("table_kind"))


def clip_interrupted(intervals: DataFrame, bounds: DataFrame, keys: list[str], limit: float) -> DataFrame:
    """intervals of interrupted sessions (bounds: keys, last_anchor) cut at the last anchor.

    A stop beyond anchor + limit becomes the anchor, marked partial; what starts after the anchor goes. Sessions
    without bounds stay as they are.
    """
    both = join_on(intervals, bounds, keys, "left")
    kept = both.filter(F.col("last_anchor").isNull() | (F.col("start") <= F.col("last_anchor")))
    cut = F.coalesce(F.col("stop") > F.col("last_anchor") + limit, F.lit(False))
    return kept.withColumns({"stop": F.when(cut, F.col("last_anchor")).otherwise(F.col("stop")), "partial": cut}).drop("last_anchor")


def stimulus_starts(mapped: DataFrame, pulses: DataFrame, expected: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Start times by the log's mapping where it has as many as expected, else by the pulses if those have, and why.

    mapped and pulses: keys, n, t. expected: keys, n_expected. Sessions with neither have no rows, verdict 'none'.
    """
    count = lambda df, name: df.groupBy(*keys).agg(F.count("t").alias(name))
    both = join_on(join_on(expected, count(mapped, "__m"), keys, "left"), count(pulses, "__p"), keys, "left")
    verdict = F.when(F.col("__m") == F.col("n_expected"), "log").when(F.col("__p") == F.col("n_expected"), "pulses").otherwise("none")
    chosen = both.select(*keys, verdict.alias("source"))
    rows = [join_on(df.select(*keys, "n", "t"), chosen.filter(F.col("source") == s), keys) for df, s in ((mapped, "log"), (pulses, "pulses"))]
    return rows[0].unionByName(rows[1]), chosen


def presentation_intervals(starts: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """The n-th start with the n-th table row: start, stop = start + duration, and table_name by block type."""
    rows = with_ordinal(table, keys, "row_idx", "n")
    both = join_on(starts, rows, [*keys, "n"])
    return both.withColumns({"start": F.col("t"), "stop": F.col("t") + F.col("duration"), "table_name": F.coalesce("block_type", F.lit("gratings"))}).drop("t")


def movie_grid(frames: DataFrame, series_keys: list[str], hz: float, content_hz: float = 30.0, frame: str = "counter") -> DataFrame:
    """Content positions of each repeat at hz: frame numbers from 1 to its last, as grid_frame (double)."""
    last = frames.groupBy(*series_keys).agg(F.max(frame).alias("__last"))
    n = F.greatest(F.ceil(F.col("__last") / content_hz * hz) - 1, F.lit(0)).cast("long")
    return last.withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), n))).withColumn("grid_frame", 1 + F.col("i") / hz * content_hz).drop("__last")


def pack_ragged(rows: DataFrame, keys: list[str], order: str, columns: list[str], name: str) -> DataFrame:
    """One row per key with an array of structs in order."""
    return rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(order, *columns))).alias(name))


def explode_ragged(packed: DataFrame, keys: list[str], name: str) -> DataFrame:
    """The rows of the arrays; a key with an empty array gives one row of NULLs."""
    return packed.select(*keys, F.posexplode_outer(name).alias("pos", "__x")).select(*keys, "pos", "__x.*")


def plane_channels(channels: DataFrame, planes: DataFrame, name: str, aliases: list[Column]) -> DataFrame:
    """Channels with the planes whose alias their name contains, without regard to case and blanks."""
    clean = lambda c: F.regexp_replace(F.lower(c), " ", "")
    hit = F.lit(False)
    for a in aliases:
        hit = hit | F.contains(clean(F.col(name)), clean(a))
    return channels.join(small(planes, 10_000), hit)
