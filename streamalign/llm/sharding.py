"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix; DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from .common import quoted, stage, unused

#: Rows that a virtual partition, and a stretch of a shard, hold on average.
PART_ROWS = 4096
#: Virtual partitions, or groups of them, whose rows of the matrix one row of work draws.
FAN = 32


def _let(name: str, value: str, body: str) -> str:
    """SQL for body with name bound to value, which is computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _hypergeometric(good: str, total: str, sample: str, u: str) -> str:
    """SQL for the number of good items in a sample without replacement, by inversion of u from the mode outwards.

    Weights relative to the mode follow from the ratio of neighbours. Those further from it than 12 r + 30 are left
    out, r being the root of sample x good / total, which is a standard deviation or more. By Bernstein's inequality
    their probability is at most 2 exp(-45), 6e-20 (the worst case, a mean near 0; exp(-71) from a mean of 10 on),
    while u has steps of 1.1e-16: the total variation from the exact law is below that of any 53-bit draw.
    """
    bounds = f"""named_struct(
        'good', {good}, 'sample', {sample}, 'other', {total} - {good} - {sample},
        'lo', greatest(0L, {good} + {sample} - {total}), 'hi', least({good}, {sample}),
        'mode', cast(floor(({sample} + 1D) * ({good} + 1D) / ({total} + 2D)) as bigint),
        'reach', cast(ceil(12 * sqrt({sample} * 1D * {good} / greatest({total}, 1L))) as bigint) + 30L, 'u', {u})"""
    up = "if(g.mode < least(g.hi, g.mode + g.reach), sequence(g.mode + 1L, least(g.hi, g.mode + g.reach)), cast(array() as array<bigint>))"
    down = "if(g.mode > greatest(g.lo, g.mode - g.reach), sequence(g.mode - 1L, greatest(g.lo, g.mode - g.reach)), cast(array() as array<bigint>))"
    rise = "(a.w * (g.good - k + 1D) * (g.sample - k + 1D) / (k * (g.other + k * 1D)))"
    fall = "(a.w * (k + 1D) * (g.other + k + 1D) / ((g.good - k) * 1D * (g.sample - k)))"
    mass = lambda ks, w, start: f"aggregate({ks}, named_struct('w', 1D, 's', {start}), (a, k) -> named_struct('w', {w}, 's', a.s + {w}), a -> a.s)"
    pick = lambda ks, w, start, found: f"aggregate({ks}, named_struct('w', 1D, 's', {start}, 'x', {found}), (a, k) -> named_struct('w', {w}, 's', a.s + {w}, 'x', coalesce(a.x, if(v < a.s + {w}, k, cast(null as bigint)))), a -> named_struct('s', a.s, 'x', a.x))"
    first = pick(up, rise, "1D", "if(v < 1D, g.mode, cast(null as bigint))")
    then = _let("p", first, f"coalesce(p.x, {pick(down, fall, 'p.s', 'cast(null as bigint)')}.x, g.mode)")
    return _let("g", bounds, _let("v", f"g.u * {mass(down, fall, mass(up, rise, '1D'))}", then))


def _drawn(groups: DataFrame, shards: int, tier: int, seed: int) -> DataFrame:
    """Of each row (group, parts array<struct<part, n>>, room array), the rows per shard of each part: part, room.

    The parts are halved again and again; each half's share of every shard is a multivariate hypergeometric draw, one
    shard after the other. All steps are narrow.
    """
    node = groups.select("group", F.lit(1).cast("long").alias("node"), "parts", "room")
    total = "aggregate({}, 0L, (s, x) -> s + x.n)"
    u = f"((xxhash64({seed}L, {tier}, `group`, node, i) & 9007199254740991L) + 0.5D) / 9007199254740992D"
    draw = _hypergeometric("room[i]", "st.t", "st.m", u)
    step = _let("d", draw, "named_struct('m', st.m - d, 't', st.t - room[i], 'out', array_append(st.out, d))")
    split = f"aggregate(sequence(0, {shards - 1}), named_struct('m', {total.format('half')}, 't', {total.format('parts')}, 'out', cast(array() as array<bigint>)), (st, i) -> {step}, st -> st.out)"
    for _ in range((FAN - 1).bit_length()):
        node = (
            node.withColumn("half", F.expr("slice(parts, 1, cast(size(parts) / 2 as int))"))
            .withColumn("got", F.expr(f"if(size(half) = 0, cast(null as array<bigint>), {split})"))
            .withColumn("child", F.expr("""explode(if(size(half) = 0, array(named_struct('group', `group`, 'node', node, 'parts', parts, 'room', room)), array(
                named_struct('group', `group`, 'node', node * 2L, 'parts', half, 'room', got),
                named_struct('group', `group`, 'node', node * 2L + 1L, 'parts', slice(parts, size(half) + 1, size(parts)), 'room', zip_with(room, got, (a, b) -> a - b)))))"""))
            .select("child.*")
        )
    return node.filter("size(parts) = 1").select(F.col("parts")[0]["part"].alias("part"), "room")


def _matrix(counts: DataFrame, n_parts: int, capacities: list[int], seed: int) -> DataFrame:
    """Rows per (part, shard), drawn exactly: __in_part, and `__upto`, the running counts over the shards.

    counts: part, from 0, and n. FAN parts make a group, FAN groups one of the next tier, and so on up to a single
    one. From there down, each tier's groups are drawn apart from each other, so that a task draws some of them; no
    row holds more than FAN parts.
    """
    shards = len(capacities)
    tiers = [counts.select(F.col("part").cast("long").alias("part"), "n")]
    while n_parts > 1:
        n_parts = -(-n_parts // FAN)
        up = tiers[-1].groupBy(F.floor(F.col("part") / FAN).cast("long").alias("group"))
        tiers[-1] = stage(up.agg(F.sort_array(F.collect_list(F.struct("part", "n"))).alias("parts")), "shard-groups")
        tiers.append(tiers[-1].select(F.col("group").alias("part"), F.expr("aggregate(parts, 0L, (s, x) -> s + x.n)").alias("n")))
    room = tiers[-1].select("part", F.array(*[F.lit(c).cast("long") for c in capacities]).alias("room"))
    for k in range(len(tiers) - 2, -1, -1):
        groups = tiers[k].join(room.withColumnRenamed("part", "group"), "group")
        room = _drawn(groups, shards, k, seed)
        if k:
            room = stage(room, "shard-rooms")
    return room.select(F.col("part").alias("__in_part"), F.expr(f"transform(sequence(1, {shards}), k -> aggregate(slice(room, 1, k), 0L, (s, x) -> s + x))").alias("__upto"))


def shuffle_into_shards(docs: DataFrame, shards: int = 16, seed: int = 20240607) -> DataFrame:
    """docs with `shard` and `slot` added (or replaced): a uniform random arrangement, shard sizes at most one apart.

    Rows lie in virtual partitions by a hash of doc_id. The counts that each sends to each shard are drawn as in a
    uniform permutation; rows are ordered at random within their partition, cut by these counts, and ordered at
    random again within their shard, whose stretches get gapless slots from the counts before them.

    Expects columns doc_id and row_key; row_key tells rows with one doc_id apart, and rows equal in both are
    interchangeable. Null ids are one more id. An empty table gives an empty result.
    """
    docs = docs.drop("shard", "slot")
    pre = unused(docs.columns, "__")
    names = [F.col(quoted(c)) for c in docs.columns]
    n = docs.count()
    n_parts, stretches = n // PART_ROWS + 1, n // shards // PART_ROWS + 1
    capacities = [n // shards + (k < n % shards) for k in range(shards)]
    key = lambda k: F.xxhash64(F.lit(seed + k), F.col("doc_id"), F.col("row_key"))
    part, first, second, stretch = (f"{pre}{x}" for x in ("part", "first", "second", "stretch"))

    placed = docs.withColumns({part: F.pmod(key(1), F.lit(n_parts)), first: key(2), second: key(3), stretch: F.pmod(key(4), F.lit(stretches)).cast("int")})
    counts = placed.groupBy(F.col(part).alias("part")).agg(F.count("*").alias("n"))
    matrix = stage(_matrix(counts, n_parts, capacities, seed), "shard-matrix").toDF(f"{pre}in_part", f"{pre}upto")
    local = Window.partitionBy(part).orderBy(first, "doc_id", "row_key")
    sent = (
        placed.join(matrix, F.col(part) == F.col(f"{pre}in_part"))
        .withColumn(f"{pre}rank", F.row_number().over(local) - 1)
        .withColumn("shard", F.size(F.filter(f"{pre}upto", lambda c: c <= F.col(f"{pre}rank"))).cast("int"))
        .select(*names, second, stretch, "shard")
    )
    sent = stage(sent, "shard-sent")
    before = Window.partitionBy(f"{pre}in_shard").orderBy(f"{pre}in_stretch").rowsBetween(Window.unboundedPreceding, -1)
    starts = sent.groupBy(F.col("shard").alias(f"{pre}in_shard"), F.col(stretch).alias(f"{pre}in_stretch")).agg(F.count("*").alias("n_here")).withColumn(f"{pre}start", F.coalesce(F.sum("n_here").over(before), F.lit(0))).drop("n_here")
    again = Window.partitionBy("shard", stretch).orderBy(second, "doc_id", "row_key")
    return (
        sent.join(starts, (F.col("shard") == F.col(f"{pre}in_shard")) & (F.col(stretch) == F.col(f"{pre}in_stretch")))
        .withColumn("slot", (F.col(f"{pre}start") + F.row_number().over(again) - 1).cast("long"))
        .select(*names, "shard", "slot")
    )


def shard_documents(docs: DataFrame, shards: int = 16) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of each document; size is the text's UTF-8 bytes plus 1, null 1."""
    text = F.coalesce(F.col("text"), F.lit(""))
    small = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    small = stage(small.withColumn("row_key", F.xxhash64("size", "text_crc32")), "shard-rows")
    return shuffle_into_shards(small, shards).drop("row_key")
