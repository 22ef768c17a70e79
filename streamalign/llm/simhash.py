"""Near-duplicate documents by SimHash: a binary trie self-join of fingerprints, and connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import Texts, groups, if_small, map_arrow, numbered, quoted, schema_with, ship, stage, to_bytes, with_columns

SEED = 42
#: Bits of a trie that must agree before its node pairs are walked; with three rotations, one of them has no
#: differing bit in front if at most two bits differ.
LEAD = 21
#: A pair of nodes with more fingerprints than this is split further by Spark before a task walks it.
UNIT_ROWS = 4096
#: Fingerprints link at this many differing bits or fewer; LEAD holds for 2.
BUDGET = 2
SPLIT_BITS = 6


def shingle_hashes(values: list[bytes], shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 (seed 42) of the word shingles of all texts in turn, and where each text's begin (and one more bound)."""
    t = Texts(values, lower=True)
    start, end, first = t.words()
    n = np.diff(first)
    if not len(start):
        return np.zeros(0, dtype=np.uint64), np.zeros(t.n + 1, dtype=np.int64)
    # the words again, one space after each
    size = end - start
    at = np.cumsum(size + 1) - size - 1
    keep = np.repeat(start - at, size + 1) + np.arange(int((size + 1).sum()))
    flat = t.buf[keep]
    flat[at + size] = 0x20
    data, stop = flat.tobytes(), at + size
    # shingle k of a text covers words k .. k + shingle - 1, or all words of a shorter text
    last = np.repeat(first[1:] - 1, n)
    word = np.arange(len(start))
    begins = (word + shingle - 1 <= last) | (word == np.repeat(first[:-1], n))
    lo = at[begins].tolist()
    hi = stop[np.minimum(word + shingle - 1, last)[begins]].tolist()
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(data[a:b], SEED) for a, b in zip(lo, hi, strict=True)], dtype=np.uint64)
    return h, np.concatenate([[0], np.cumsum(begins)])[first]


def fingerprints(values: list[bytes], shingle: int = 3) -> np.ndarray:
    """SimHash of each text's word shingles (XXH64, seed 42): a bit is 1 if set in over half of the hashes."""
    h, count = shingle_hashes(values, shingle)
    out = np.zeros(len(values), dtype=np.uint64)
    some = np.flatnonzero(np.diff(count))
    step = 1 << 16
    for k in some:
        a, b = count[k], count[k + 1]
        ones = np.zeros(64, dtype=np.int64)
        for x in range(a, b, step):
            part = h[x : min(b, x + step)]
            ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        out[k] = np.packbits(2 * ones > b - a, bitorder="little").view(np.uint64)[0]
    return out


def add_fingerprint(docs: DataFrame, name: str = "fingerprint", group_bytes: int = 1 << 20) -> DataFrame:
    """docs with the 64-bit fingerprint of `text` as a long, in a new or replaced column; texts without a word (or null) have 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = to_bytes(batch.column("text"))
            found = [fingerprints(values[lo:hi]) for lo, hi in groups(values, group_bytes)]
            yield with_columns(batch, [name], [pa.array(np.concatenate(found).view(np.int64) if found else np.zeros(0, np.int64))])

    return map_arrow(docs, run, schema_with(docs, f"`{name}` bigint"))


def trie_pairs(low: np.ndarray, high: np.ndarray, key: np.ndarray, depth: int, used: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of positions in key whose bits below `depth` differ in at most budget - used bits.

    Node pair k joins key[low[k, 0]:high[k, 0]] with key[low[k, 1]:high[k, 1]], both sorted; a node may be paired with
    itself. All pairs are walked together, level by level: each level follows the next
    bit, keeps what is used of the budget, and prunes pairs beyond it. Two single leaves are compared at once.
    """
    a_lo, a_hi, b_lo, b_hi = low[:, 0], high[:, 0], low[:, 1], high[:, 1]
    left, right = [], []
    while len(a_lo):
        one = (a_hi - a_lo == 1) & (b_hi - b_lo == 1)
        if one.any():
            x, y = a_lo[one], b_lo[one]
            rest = np.uint64((1 << (64 - depth)) - 1) if depth else np.uint64(0xFFFFFFFFFFFFFFFF)
            near = (np.bitwise_count((key[x] ^ key[y]) & rest) + used[one] <= budget) & (x != y)
            left.append(x[near])
            right.append(y[near])
            a_lo, a_hi, b_lo, b_hi, used = (v[~one] for v in (a_lo, a_hi, b_lo, b_hi, used))
        if not len(a_lo) or depth == 64:
            break
        bit = np.uint64(1 << (63 - depth))
        a_mid, b_mid = _first_with(key, a_lo, a_hi, bit), _first_with(key, b_lo, b_hi, bit)
        same = (a_lo == b_lo) & (a_hi == b_hi)
        more = used < budget
        kids = []
        for on, x, y, plus in (
            (np.ones(len(a_lo), bool), (a_lo, a_mid), (b_lo, b_mid), 0),
            (np.ones(len(a_lo), bool), (a_mid, a_hi), (b_mid, b_hi), 0),
            (more, (a_lo, a_mid), (b_mid, b_hi), 1),
            (more & ~same, (a_mid, a_hi), (b_lo, b_mid), 1),
        ):
            alone = (x[0] == y[0]) & (x[1] == y[1]) & (x[1] - x[0] < 2)
            on = on & (x[1] > x[0]) & (y[1] > y[0]) & ~alone
            kids.append((x[0][on], x[1][on], y[0][on], y[1][on], used[on] + plus))
        a_lo, a_hi, b_lo, b_hi, used = (np.concatenate(v) for v in zip(*kids, strict=True))
        depth += 1
    return (np.concatenate(left), np.concatenate(right)) if left else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _first_with(key: np.ndarray, lo: np.ndarray, hi: np.ndarray, bit: np.uint64) -> np.ndarray:
    """For sorted ranges that agree above `bit`, the first position whose key has it: binary search in all at once."""
    lo, hi = lo.copy(), hi.copy()
    while True:
        open_ = lo < hi
        if not open_.any():
            return lo
        mid = (lo + hi) // 2
        has = (key[np.minimum(mid, len(key) - 1)] & bit) != 0
        hi = np.where(open_ & has, mid, hi)
        lo = np.where(open_ & ~has, mid + 1, lo)


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest position that each of n positions is connected with."""
    root = np.arange(n)
    while len(a):
        x, y = root[a], root[b]
        live = x != y
        if not live.any():
            break
        a, b, x, y = a[live], b[live], x[live], y[live]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    return root


def _walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Walks the node pairs of sorted rows (turn, depth, node_a, node_b, key) and gives links to a representative."""
    names = ["turn", "depth", "node_a", "node_b"]
    held = None
    for part in _with_end(batches):
        if part is not None:
            held = part if held is None else pd.concat([held, part], ignore_index=True)
            if not len(held):
                continue
            tail = (held[names] == held[names].iloc[-1]).all(axis=1).to_numpy()
            begins = int(len(tail) - np.argmin(tail[::-1])) if not tail.all() else 0
            ready, held = held.iloc[:begins], held.iloc[begins:]
        else:
            ready, held = held, None
        if ready is None or not len(ready):
            continue
        for depth, rows in ready.groupby("depth", sort=False):
            yield _links(rows, int(depth))


def _with_end(batches: Iterator) -> Iterator:
    yield from batches
    yield None


def _links(rows: pd.DataFrame, depth: int) -> pd.DataFrame:
    key = rows["key"].to_numpy().view(np.uint64)
    a, b = (rows[c].to_numpy().view(np.uint64) for c in ("node_a", "node_b"))
    turn = rows["turn"].to_numpy()
    new = np.flatnonzero(np.concatenate([[True], (turn[1:] != turn[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
    end = np.append(new[1:], len(rows))
    shift = np.uint64(64 - depth)
    in_a = (key >> shift) == a
    split = new + np.add.reduceat(in_a.astype(np.int64), new)
    same = a[new] == b[new]
    low = np.column_stack([new, np.where(same, new, split)])
    high = np.column_stack([np.where(same, end, split), end])
    used = np.bitwise_count(a[new] ^ b[new]).astype(np.int64)
    x, y = trie_pairs(low, high, key, depth, used, BUDGET)
    # positions of one unit only link within it, so that one pass serves all units
    root = local_roots(len(rows), x, y)
    linked = np.flatnonzero(root != np.arange(len(rows)))
    out = key.copy()
    for t in np.unique(turn):
        on = turn == t
        k = np.uint64(LEAD * int(t))
        out[on] = (key[on] >> k) | (key[on] << np.uint64((64 - int(k)) % 64)) if int(k) else key[on]
    return pd.DataFrame({"a": out[linked].view(np.int64), "b": out[root[linked]].view(np.int64)})


def links(distinct: DataFrame) -> DataFrame:
    """Links (a, b) between fingerprints (column `fingerprint`, distinct) that connect all within BUDGET bits.

    Three rotations of the binary trie are walked. In a rotation, a unit of work is a pair of nodes at one depth;
    units begin as the nodes at depth LEAD paired with themselves. A unit of over UNIT_ROWS rows is split, by Spark,
    into the pairs of its descendants SPLIT_BITS further down that are within the budget, until all are small.
    Each unit gives a link from each fingerprint to the representative of those it is connected with there, never
    all pairs.
    """
    spark = distinct.sparkSession
    ship(spark)
    fp = F.col("fingerprint")
    rotated = [fp] + [F.shiftleft(fp, LEAD * t).bitwiseOR(F.shiftrightunsigned(fp, 64 - LEAD * t)) for t in (1, 2)]
    units = distinct.select(F.explode(F.array(*[F.struct(F.lit(t).alias("turn"), r.alias("key")) for t, r in enumerate(rotated)])).alias("x")).select("x.*")
    node = F.shiftrightunsigned("key", 64 - LEAD)
    units = units.select("turn", F.lit(LEAD).alias("depth"), node.alias("node_a"), node.alias("node_b"), "key")
    unit = ["turn", "depth", "node_a", "node_b"]
    small: DataFrame | None = None
    depth = LEAD
    while True:
        prefix = F.shiftrightunsigned("key", 64 - depth)
        sizes = units.groupBy(*unit).agg(F.count("*").alias("n"), F.max(prefix).alias("most"), F.min(prefix).alias("least")).filter("n > 1")
        sizes = stage(sizes.filter("node_a = node_b or most <> least").select(*unit, "n"), "simhash-units")
        ready = units.join(sizes.filter(F.col("n") <= UNIT_ROWS).drop("n"), unit, "left_semi")
        small = ready if small is None else small.unionByName(ready)
        large = sizes.filter(F.col("n") > UNIT_ROWS)
        if depth + SPLIT_BITS > 64 or large.isEmpty():
            if depth + SPLIT_BITS > 64:
                small = small.unionByName(units.join(large.drop("n"), unit, "left_semi"))
            break
        units = stage(_split(units.join(large.drop("n"), unit, "left_semi"), depth), "simhash-split")
        depth += SPLIT_BITS
    walked = small.repartition(*unit).sortWithinPartitions(*unit, F.col("key") < 0, "key")  # as unsigned numbers
    return walked.mapInPandas(_walk, "a bigint, b bigint")


def _split(units: DataFrame, depth: int) -> DataFrame:
    """Each row goes to the pairs of children, SPLIT_BITS down, that hold it and stay within the budget."""
    masks = [m for m in range(1 << SPLIT_BITS) if m.bit_count() <= BUDGET]
    child = F.shiftrightunsigned("key", 64 - depth - SPLIT_BITS)
    allowed = F.filter(F.array(*[F.lit(m).cast("long") for m in masks]), lambda m: F.bit_count(m) + F.bit_count(F.col("node_a").bitwiseXOR(F.col("node_b"))) <= BUDGET)
    in_a = F.shiftrightunsigned("key", 64 - depth) == F.col("node_a")
    both = F.col("node_a") == F.col("node_b")
    rows = units.withColumn("child", child).withColumn("mask", F.explode(allowed))
    # the other child lies under the other node of the pair
    other = F.col("child").bitwiseXOR(F.col("mask")).bitwiseXOR(F.shiftleft(F.col("node_a").bitwiseXOR(F.col("node_b")), SPLIT_BITS))
    first = F.when(both, F.least("child", other)).when(in_a, F.col("child")).otherwise(other)
    second = F.when(both, F.greatest("child", other)).when(in_a, other).otherwise(F.col("child"))
    return rows.select("turn", F.lit(depth + SPLIT_BITS).alias("depth"), first.alias("node_a"), second.alias("node_b"), "key")


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of each batch, each node with the smallest one that it is connected with there."""
    for batch in batches:
        ends = np.concatenate([batch.column(c).to_numpy(zero_copy_only=False) for c in ("a", "b")])
        node, place = np.unique(ends, return_inverse=True)
        root = local_roots(len(node), place[: batch.num_rows], place[batch.num_rows :])
        linked = np.flatnonzero(root != np.arange(len(node)))
        yield pa.RecordBatch.from_arrays([pa.array(node[linked]), pa.array(node[root[linked]])], names=["a", "b"])


def _digest(links: DataFrame) -> tuple:
    """Tells sets of distinct links apart, but for odds of about 2^-64."""
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root): each node of the links (a, b) and the smallest node it is connected with.

    Links are joined within batches first. Then large-star and small-star steps alternate until nothing changes; each
    groups by node, with partial minima, and is written to the shared folder, so that lineage stays short and lost
    executors cost one step.
    """
    now = stage(map_arrow(edges.select("a", "b"), _contract, "a bigint, b bigint").distinct(), "cc")
    seen = _digest(now)
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = stage(both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct(), "cc")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        now = stage(small.filter("a <> b").distinct(), "cc")
        before, seen = seen, _digest(now)
        if before == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, fingerprint, component_id and root (a fingerprint) of each document.

    component_id is the smallest doc_id whose fingerprint can be reached by links of at most BUDGET bits; texts
    without a word have fingerprint 0 and are linked like any other. Rows equal in doc_id and text count as one
    document in the result's meaning, but each gives a row. A null doc_id is never the smallest unless all are null.
    text_key (a hash of the text) tells documents with one doc_id apart.
    """
    keyed = docs.select("doc_id", "text").withColumn("text_key", F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))
    prints = stage(add_fingerprint(keyed).select("doc_id", "text_key", "fingerprint"), "simhash-prints")
    by_print = stage(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    roots = components(links(by_print.select("fingerprint")))
    labelled = by_print.join(roots, by_print.fingerprint == roots.node, "left").select("fingerprint", "first_id", F.coalesce("root", "fingerprint").alias("root"))
    smallest = labelled.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_print = stage(labelled.join(smallest, "root").select("fingerprint", "component_id", "root"), "simhash-labels")
    return prints.join(by_print, "fingerprint").select("doc_id", "text_key", "fingerprint", "component_id", "root")


def deduplicate(docs: DataFrame) -> DataFrame:
    """docs without near-duplicates: of each component, one row with its smallest doc_id stays, with all columns."""
    rows = numbered(docs)
    row = rows.columns[-1]
    prints = stage(add_fingerprint(rows.select("doc_id", "text", row)).select("doc_id", "fingerprint", row), "simhash-prints")
    found = prints.groupBy("fingerprint").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", row)).alias("x"))
    roots = components(links(found.select("fingerprint")))
    kept = found.join(roots, found.fingerprint == roots.node, "left").groupBy(F.coalesce("root", "fingerprint").alias("root")).agg(F.min("x").alias("x"))
    return rows.join(if_small(stage(kept.select(F.col(f"x.{row}").alias(row)), "simhash-kept")), row, "left_semi").select(*map(quoted, docs.columns))
