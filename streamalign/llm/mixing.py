"""Mixing sources to target weights by Pareto order sampling; DataFrame operations only.

How many copies of a document are expected grows with the number of binary digits of its size, and all of a source
add up to its target. Whole copies are certain; the rest of the expectation, p, is a document's inclusion probability.
Documents go by the random odds u/(1-u) over p/(1-p), and the first ones whose words fit into what is left of the
target are taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from .common import WORD, quoted, stage, unused

#: Rows that are ordered singly, about, where a source's sample ends.
BUCKET_ROWS = 4096
#: Each step of the search for that place divides it into 2 ** STEP_BITS parts, the first into parts of 4 octaves.
STEP_BITS, FIRST_OCTAVES = 6, 2
#: Documents of each number of digits that may fill the gap at the end of a source's sample.
FILLERS = 3
#: A table of one row per source is broadcast up to this number of sources.
BROADCAST_SOURCES = 100_000


def uniform(*cols: Column) -> Column:
    """A number in (0, 1) that depends on the columns alone."""
    digest = F.md5(F.concat_ws(":", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols]))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """One row per source with its target: water-filling of share x all sizes, at most `most` x the source's size.

    Sources are in code-point order (null last) and take the weights in turn. The level is the one of the first
    source, by size over weight, that it doesn't fill; those before it are full.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    full = F.col("source_size") * F.lit(float(most))
    by_fill = Window.orderBy(F.col("full") / F.col("weight"), F.col("rank"))
    everything = Window.partitionBy()
    filled = (
        by_source.withColumns({"rank": rank, "weight": weight, "full": full})
        .withColumn("total", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("full_before", F.coalesce(F.sum("full").over(by_fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("weight_left", F.sum("weight").over(by_fill.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.col("total") - F.col("full_before")) / F.col("weight_left"))
        .withColumn("level", F.min_by(F.when(F.col("full") / F.col("weight") >= F.col("level"), F.col("level")), F.when(F.col("full") / F.col("weight") >= F.col("level"), F.struct(F.col("full") / F.col("weight"), F.col("rank")))).over(everything))
    )
    target = F.least(F.col("full"), F.coalesce(F.col("level") * F.col("weight"), F.col("full")))
    return filled.select("source", F.col("source_size").cast("long").alias("source_size"), "n_docs", target.alias("target"))


def digits(size: Column) -> Column:
    """Binary digits of a positive number."""
    return F.length(F.bin(size)).cast("int")


def expected_copies(level: Column, size: Column, most: float) -> Column:
    """How often a document of this size is expected in the mix; a level of NULL stands for as often as allowed."""
    return F.least(F.lit(float(most)), F.coalesce(level * digits(size), F.lit(float(most))))


def source_levels(sizes: DataFrame, targets: DataFrame, most: float) -> DataFrame:
    """targets with `level`, the copies per binary digit that reach the target, and `rest`, its part that isn't whole copies.

    Documents that reach `most` copies are full, those with the most digits first; the level is the one of the first
    number of digits that isn't. Only sums by source and number of digits are ordered.
    """
    full = F.lit(float(most))
    of_source = Window.partitionBy("source").orderBy(F.col("digits").desc())
    by_digits = sizes.filter("size > 0").groupBy("source", digits(F.col("size")).alias("digits")).agg(F.sum("size").alias("words"))
    joined = _by_source(by_digits, targets, "its_source")
    level = (F.col("target") - full * F.coalesce(F.sum("words").over(of_source.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))) / F.sum(F.col("words") * F.col("digits")).over(of_source.rowsBetween(0, Window.unboundedFollowing))
    with_level = joined.withColumn("level", level)
    fits = F.when(F.col("level") * F.col("digits") <= full, F.col("digits"))
    levels = with_level.groupBy("source").agg(F.max_by(F.when(fits.isNotNull(), F.col("level")), fits).alias("level"), F.collect_list(F.struct("digits", "words")).alias("classes"))
    whole = F.aggregate("classes", F.lit(0).cast("long"), lambda s, c: s + c["words"] * F.floor(F.least(full, F.coalesce(F.col("level") * c["digits"], full))).cast("long"))
    levels = levels.select(F.col("source").alias("level_source"), "level", whole.alias("whole"))
    return _by_source(targets, levels, "level_source", "left").withColumn("rest", F.coalesce(F.col("target") - F.col("whole"), F.lit(0.0))).drop("whole")


def _by_source(rows: DataFrame, per_source: DataFrame, name: str, how: str = "inner", hint: bool = False, source: str = "source") -> DataFrame:
    """rows and the columns of per_source, whose source has another name or gets `name`; NULL is a source like any other."""
    other = per_source if name in per_source.columns else per_source.withColumnRenamed("source", name)
    return rows.join(F.broadcast(other) if hint else other, F.col(source).eqNullSafe(F.col(name)), how).drop(name)


def _rank(u: Column, p: Column) -> Column:
    return u / (1 - u) * ((1 - p) / F.nullif(p, F.lit(0.0)))


def _place(rank: Column, steps: int) -> Column:
    """The rank's place on a logarithmic scale, as a whole number; equal or larger for larger ranks."""
    return F.floor(F.log2(rank) * F.lit(float(2 ** (STEP_BITS * steps - FIRST_OCTAVES)))).cast("long")


def _ends(ranked: DataFrame, steps: int, hint: bool) -> DataFrame:
    """Per source, the place and rank up to which documents fit into its `rest`, and the words that these have.

    Sums by place, over ever finer parts of the scale, find where the rest is used up; only rows of that finest part
    are ordered singly.
    """
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    beyond = F.lit(1 << 62)
    found: DataFrame | None = None
    for k in range(1, steps + 1):
        part = F.shiftright("place", STEP_BITS * (steps - k))
        rows = ranked.withColumn("part", part)
        if found is not None:
            rows = _by_source(rows, found, "end_source", hint=hint).filter(F.shiftright("part", STEP_BITS) == F.col("end_part"))
        else:
            rows = rows.withColumn("end_used", F.lit(0).cast("long"))
        sums = rows.groupBy("source", "part").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"), F.first("end_used").alias("end_used"))
        upto = sums.withColumn("used", F.col("end_used") + F.coalesce(F.sum("words").over(before), F.lit(0)))
        crossing = upto.withColumn("over", F.col("used") + F.col("words") > F.col("rest")).groupBy(F.col("source").alias("end_source"))
        now = crossing.agg(
            F.coalesce(F.min(F.when(F.col("over"), F.col("part"))), beyond).alias("end_part"),
            F.coalesce(F.min_by("used", F.when(F.col("over"), F.col("part"))), F.max(F.col("used") + F.col("words"))).alias("end_used"),
        )
        found = stage(now if found is None else now.unionByName(found.filter(F.col("end_part") == beyond)), "mix-ends")
    last = _by_source(ranked, found, "end_source", hint=hint).filter(F.col("place") == F.col("end_part"))
    peers = Window.partitionBy("source").orderBy("rank").rangeBetween(Window.unboundedPreceding, 0)
    inside = last.withColumn("used", F.col("end_used") + F.sum("size").over(peers)).filter("used <= rest").groupBy(F.col("source").alias("in_source")).agg(F.max("rank").alias("end_rank"), F.max("used").alias("used"))
    both = found.join(inside, F.col("end_source").eqNullSafe(F.col("in_source")), "left")
    return both.select("end_source", F.col("end_part").alias("end_place"), F.coalesce("end_rank", F.lit(-1.0)).alias("end_rank"), F.coalesce("used", "end_used").alias("used"))


def _upto(place: Column, rank: Column, end_place: Column, end_rank: Column) -> Column:
    return (place < end_place) | ((place == end_place) & (rank <= end_rank))


def _left(ranked: DataFrame, ends: DataFrame, hint: bool) -> DataFrame:
    """The documents that a walk to these ends didn't take and that fit into what it left, with that as their rest."""
    taken = _upto(F.col("place"), F.col("rank"), F.col("end_place"), F.col("end_rank"))
    left = _by_source(ranked, ends, "end_source", hint=hint).withColumn("rest", F.col("rest") - F.col("used"))
    return left.filter(~taken & (F.col("size") <= F.col("rest"))).select(*ranked.columns)


def _fillers(left: DataFrame) -> DataFrame:
    """Per source, which of these fill the rest: from the most digits down, the first FILLERS ones by rank if they fit."""
    order = F.rank().over(Window.partitionBy("source", "digits").orderBy("rank"))
    near = left.withColumn("digits", digits(F.col("size"))).withColumn("nth", order).filter(F.col("nth") <= FILLERS).groupBy("source", "digits", "rank").agg(F.sum("size").alias("words"), F.first("rest").alias("gap"))
    listed = near.groupBy(F.col("source").alias("fill_source")).agg(F.first("gap").alias("gap"), F.array_sort(F.collect_list(F.struct((-F.col("digits")).alias("digits"), "rank", "words"))).alias("near"))
    nothing = F.expr("cast(array() as array<struct<digits: int, rank: double>>)")
    step = lambda s, x: F.when(x["words"] <= s["gap"], F.struct((s["gap"] - x["words"]).alias("gap"), F.array_append(s["picked"], F.struct((-x["digits"]).alias("digits"), x["rank"].alias("rank"))).alias("picked"))).otherwise(s)
    return listed.select("fill_source", F.aggregate("near", F.struct(F.col("gap").alias("gap"), nothing.alias("picked")), step, lambda s: s["picked"]).alias("picked"))


NEW = ("size", "source_size", "target", "copies", "taken")


def add_size(docs: DataFrame) -> DataFrame:
    """docs with `size`, the number of words of `text`, in a new or replaced column; 0 for null."""
    return docs.withColumn("size", F.coalesce(F.expr(f"regexp_count(text, r'{WORD}')"), F.lit(0)).cast("long"))


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: str = "mix") -> DataFrame:
    """docs with `size`, `source_size`, `target`, `copies` and `taken` added (or replaced): how often the mix takes each.

    Expected copies of a document are in proportion to the number of binary digits of its size, up to `most`, and
    scaled so that a source's expected words are its target. Their whole part is certain. The rest, p, is sampled in
    Pareto order: documents go by the random odds u/(1-u) over p/(1-p), and are taken while their words fit into
    what the certain copies leave of the target. So that a very long document at the end doesn't leave the source
    short, a second walk takes later ones that fit the gap, and a few of each number of digits fill what is left.

    Null text has size 0; null is a source of its own, the last one. Documents of size 0 get the whole copies that
    all of their source could have. Rows with one doc_id share their random number, and those of one size are taken
    or left together. No document is split. Runs jobs when called.
    """
    return mix_sizes(add_size(docs), weights, share, most, seed)


def mix_sizes(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: str = "mix") -> DataFrame:
    """As mix_sources, for documents that already have their `size`; docs are read several times."""
    pre = unused(docs.columns, "__mix")
    u = uniform(F.lit(seed), F.col("doc_id"))
    small = stage(docs.select("source", "size", u.alias("u")), "mix-sizes")
    targets = stage(source_targets(small, weights, share, most), "mix-targets")
    levels = stage(source_levels(small, targets, most), "mix-levels")
    hint = levels.count() <= BROADCAST_SOURCES
    steps = 1
    while BUCKET_ROWS << (STEP_BITS * steps) < small.count():
        steps += 1

    joined = _by_source(small.filter("size > 0"), levels.select("source", "level", "rest"), "its_source", hint=hint)
    expected = expected_copies(F.col("level"), F.col("size"), most)
    ranked = joined.withColumn("p", expected - F.floor(expected)).filter("p > 0").withColumn("rank", _rank(F.col("u"), F.col("p"))).withColumn("place", _place(F.col("rank"), steps))
    ends = stage(_ends(ranked, steps, hint), "mix-ends")
    left = stage(_left(ranked, ends, hint), "mix-left")
    again = stage(_ends(left, steps, hint), "mix-ends")
    fillers = _fillers(_left(left, again, hint))
    again = again.select(F.col("end_source").alias("again_source"), F.col("end_place").alias("again_place"), F.col("end_rank").alias("again_rank"))
    cuts = _by_source(_by_source(_by_source(levels, ends, "end_source", "left"), again, "again_source", "left"), fillers, "fill_source", "left")
    cuts = stage(cuts.select(*[F.col(c).alias(f"{pre}_{c}") for c in cuts.columns]), "mix-cuts")

    m = lambda c: F.col(f"{pre}_{c}")
    size = F.col("size")
    copies = expected_copies(m("level"), size, most)
    whole = F.floor(copies)
    p = copies - whole
    rank = _rank(u, p)
    place = _place(rank, steps)
    first = _upto(place, rank, m("end_place"), m("end_rank"))
    second = _upto(place, rank, m("again_place"), m("again_rank")) & (size <= m("rest") - m("used"))
    filler = F.exists(m("picked"), lambda x: (x["digits"] == digits(size)) & (x["rank"] == rank))
    sampled = (p > 0) & (F.coalesce(first, F.lit(False)) | F.coalesce(second, F.lit(False)) | F.coalesce(filler, F.lit(False)))
    none = F.floor(F.coalesce(F.try_divide(m("target"), m("source_size")), F.lit(0.0)))
    taken = F.when(size > 0, whole + sampled.cast("long")).otherwise(none).cast("long")
    rows = _by_source(docs, cuts, f"{pre}_source", hint=hint).withColumn(f"{pre}_copies", taken)
    kept = [F.col(quoted(c)) for c in docs.columns if c.lower() not in NEW]
    return rows.select(*kept, "size", m("source_size").alias("source_size"), m("target").alias("target"), m("copies").alias("copies"), (size * m("copies")).alias("taken"))


def repeat_mixed(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: str = "mix") -> DataFrame:
    """The mix itself: each document as often as mix_sources takes it, with the columns of docs."""
    pre = unused(docs.columns, "__kept")
    own = [c for c in docs.columns if c.lower() in NEW]
    sized = stage(add_size(docs.withColumnsRenamed({c: f"{pre}_{c}" for c in own})), "mix-documents")
    times = F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))
    mixed = mix_sizes(sized, weights, share, most, seed)
    repeated = mixed.select(*[F.col(quoted(f"{pre}_{c}" if c in own else c)).alias(c) for c in docs.columns], times.alias(f"{pre}_copy"))
    return repeated.drop(f"{pre}_copy")
