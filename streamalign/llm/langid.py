"""Language identification by prediction by partial matching (PPM) with frozen byte context trees."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from .common import groups, if_small, map_arrow, numbered, stage, to_bytes

#: Longest context, in bytes.
ORDER = 3
#: Size of the tables that one task holds, besides the places of contexts in them (4 bytes for each three symbols, 68 MB
#: at most). More languages than fit, and a language's contexts that don't fit, are scored in several passes.
MODEL_BYTES = 128 << 20
#: Contexts whose code lengths are made at once.
_BLOCK = 4096
_PIECE = 1 << 20
_LETTER = regex.compile(r"\p{L}")

#: For each order, the codes of its distinct strings (a context and a symbol, as one number) and how often they occur.
Counts = list[tuple[np.ndarray, np.ndarray]]


def count_strings(text: bytes) -> Counts:
    """The counts of one text; contexts don't reach beyond it."""
    s = np.frombuffer(text, dtype=np.uint8)
    out = []
    for order in range(ORDER + 1):
        found = []
        for lo in range(0, max(0, len(s) - order), _PIECE):
            piece = s[lo : lo + _PIECE + order].astype(np.int64)
            code = np.zeros(len(piece) - order, dtype=np.int64)
            for k in range(order + 1):
                code = code << 8 | piece[k : len(piece) - order + k]
            found.append(np.unique(code, return_counts=True))
        out.append(add_counts([c for c, _ in found], [n for _, n in found]))
    return out


def add_counts(codes: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not codes:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    distinct, place = np.unique(np.concatenate(codes), return_inverse=True)
    return distinct, np.bincount(place, np.concatenate(times), len(distinct)).astype(np.int64)


def _code_lengths(shorter: np.ndarray, at: np.ndarray, symbol: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Bits of each symbol (columns) in each context (rows): those of its suffix and the escape, or of its own count."""
    total, kinds = np.bincount(at, times, len(shorter)), np.bincount(at, minlength=len(shorter))
    escape = np.zeros(len(shorter))
    live = total > 0
    escape[live] = np.log2((total[live] + kinds[live]) / kinds[live])
    out = shorter + escape[:, None]
    out[at, symbol] = np.log2((total[at] + kinds[at]) / times)
    return out


def _rounded(bits: np.ndarray) -> np.ndarray:
    return np.minimum(np.rint(bits * 256), 65535)


@dataclass
class PpmModel:
    """Code lengths in 1/256 bit for every (context, symbol) and language.

    `row_of[c1, c2, c3]` is the table row of the longest context that any language has seen; `cost[row, symbol]`
    holds the code lengths in all languages, with the escapes to shorter contexts already added. A part of a model has
    the symbols after the contexts from lo on, before hi (as numbers of three bytes); others count in other parts.
    """

    langs: list[str]
    symbol: np.ndarray
    row_of: np.ndarray
    cost: np.ndarray
    lo: int = 0
    hi: int = 1 << 8 * ORDER

    @classmethod
    def train(cls, samples: dict[str, bytes]) -> PpmModel:
        """samples: the training bytes of each language."""
        return cls.from_counts({lang: count_strings(x) for lang, x in samples.items()})

    @classmethod
    def from_counts(cls, counts: dict[str, Counts], lo: int = 0, hi: int = 1 << 8 * ORDER) -> PpmModel:
        """Freezes the trees of each language.

        Escapes are those of method C: a context with t symbols, d of them distinct, leaves d/(t+d) for symbols it
        hasn't seen. Below order 0, all 256 bytes are alike; bytes that no sample has share one symbol. No context
        is left out; of a part, counts has the longest strings of its own contexts only.
        """
        langs = sorted(counts)
        seen = np.zeros(256, dtype=bool)
        for x in counts.values():
            seen[x[0][0]] = True
        n = int(seen.sum()) + 1
        symbol = np.full(256, n - 1, dtype=np.int32)
        symbol[seen] = np.arange(n - 1)

        def of_symbols(lang: str, order: int) -> tuple[np.ndarray, np.ndarray]:
            code, times = counts[lang][order]
            own = np.zeros(len(code), dtype=np.int64)
            for k in range(order, -1, -1):
                own = own * n + symbol[code >> (8 * k) & 255]
            return own, times

        deep = [of_symbols(x, ORDER) for x in langs]
        contexts = np.unique(np.concatenate([c // n for c, _ in deep])) if langs else np.zeros(0, dtype=np.int64)
        rows = n * n + len(contexts)
        cost = np.zeros((rows, n, len(langs)), dtype=np.uint16)
        for k, lang in enumerate(langs):
            bits = np.full((1, n), 8.0)
            for order in range(ORDER):
                code, times = of_symbols(lang, order)
                bits = _code_lengths(np.tile(bits, (n, 1)) if order else bits, code // n, code % n, times)
            cost[: n * n, :, k] = _rounded(bits)
            # contexts that some language of these has, each after its suffix
            code, times = deep[k]
            at = np.searchsorted(contexts, code // n)
            for first in range(0, len(contexts), _BLOCK):
                some = slice(*np.searchsorted(at, [first, first + _BLOCK]))
                longer = bits[contexts[first : first + _BLOCK] % (n * n)]
                cost[n * n + first : n * n + first + len(longer), :, k] = _rounded(_code_lengths(longer, at[some] - first, code[some] % n, times[some]))
        row_of = np.tile(np.arange(n * n, dtype=np.int32), n)
        row_of[contexts] = n * n + np.arange(len(contexts), dtype=np.int32)
        return cls(langs, symbol, row_of, cost.reshape(rows * n, len(langs)), lo, hi)

    def bits(self, values: list[bytes]) -> np.ndarray:
        """Code length of each text in each language, in bits; each text starts after three spaces."""
        n = int(self.symbol.max()) + 1
        lead = b" " * ORDER
        size = np.fromiter(map(len, values), dtype=np.int64, count=len(values))
        raw = np.frombuffer(lead + lead.join(values) + lead, dtype=np.uint8)
        s = self.symbol[raw]
        row = self.row_of[(s[:-3] * n + s[1:-2]) * n + s[2:-1]]
        each = self.cost[row * n + s[3:]]
        if self.hi - self.lo < 1 << 8 * ORDER:
            before = raw[:-3].astype(np.int32) << 16 | raw[1:-2].astype(np.int32) << 8 | raw[2:-1]
            each[(before < self.lo) | (before >= self.hi)] = 0
        end = np.cumsum(size + ORDER) - ORDER
        out = np.zeros((len(values), len(self.langs)), dtype=np.int64)
        for k in range(len(self.langs)):
            total = np.concatenate([[0], np.cumsum(each[:, k], dtype=np.int64)])
            out[:, k] = total[end] - total[end - size]
        return out / 256.0


class LanguageModel:
    """Counts of the training strings, in a table, and the parts in which they are scored: languages, and a range of contexts."""

    def __init__(self, counts: DataFrame, ranges: list[tuple[list[str], int, int]]):
        self.counts, self.ranges = counts, ranges
        self.langs = sorted({x for g, _, _ in ranges for x in g})

    def parts(self) -> Iterator[PpmModel]:
        """The frozen trees, one part at a time; what the driver gets for it has an entry of the part's table for each row."""
        context = F.shiftright("code", 8)
        for group, lo, hi in self.ranges:
            wanted = F.col("lang").isin(group) & ((F.col("order") < ORDER) | ((context >= lo) & (context < hi)))
            found: dict[str, list[list]] = {x: [[[], []] for _ in range(ORDER + 1)] for x in group}
            for r in self.counts.filter(wanted).groupBy("lang", "order").agg(F.collect_list("code").alias("codes"), F.collect_list("n").alias("times")).collect():
                found[r.lang][r.order] = [[np.array(r.codes, np.int64)], [np.array(r.times, np.int64)]]
            yield PpmModel.from_counts({x: [add_counts(*c) for c in orders] for x, orders in found.items()}, lo, hi)


def _ranges(counts: DataFrame, group: list[str], n: int, contexts: int) -> list[tuple[list[str], int, int]]:
    """Ranges of contexts of a group of languages whose tables fit in MODEL_BYTES each; one range if all do."""
    row = 2 * n * len(group)
    room = max(MODEL_BYTES - row * n * n, MODEL_BYTES // 8)
    k = -(-row * contexts // room)
    if k < 2:
        return [(group, 0, 1 << 8 * ORDER)]
    own = counts.filter(F.col("lang").isin(group) & (F.col("order") == ORDER)).select(F.shiftright("code", 8).alias("c")).distinct()
    cuts = sorted(set(own.agg(F.percentile_approx("c", [i / k for i in range(1, k)], 100 * k)).first()[0]))
    bounds = [0, *cuts, 1 << 8 * ORDER]
    return [(group, lo, hi) for lo, hi in zip(bounds[:-1], bounds[1:], strict=True) if lo < hi]


def train_language_model(docs: DataFrame, sample_docs: int = 300) -> LanguageModel:
    """PPM statistics from a bounded sample of the rows of docs (text, lang, doc_id) that have a lang.

    sample_docs documents of each language, in the order of a hash of doc_id; the whole text of each, of any length,
    is counted where it lies. Null and empty texts teach nothing; rows with one doc_id and lang all count.
    """
    usable = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.octet_length("text") > 0))
    counts = if_small(stage(usable.groupBy("lang").agg(F.count("*").alias("n")), "language-sizes"))
    # about twice as many as wanted by their hash, then the first of them
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    few = usable.select("doc_id", "lang").join(counts, "lang").filter(share < F.lit(2.0 * sample_docs + 50) / F.col("n")).select("doc_id", "lang").distinct()
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    chosen = if_small(stage(few.withColumn("rank", rank).filter(F.col("rank") <= sample_docs).select("doc_id", "lang"), "language-sample"))
    rows = usable.select("doc_id", "lang", "text").join(chosen, ["doc_id", "lang"], "left_semi")
    strings = map_arrow(rows.select("lang", "text"), _count_batches, "lang string, order int, code bigint, n bigint")
    table = stage(strings.groupBy("lang", "order", "code").agg(F.sum("n").alias("n")), "language-counts")
    sizes = table.groupBy("lang").agg(F.count_if(F.col("order") == 0).alias("symbols"), F.count_distinct(F.when(F.col("order") == ORDER, F.shiftright("code", 8))).alias("contexts")).orderBy("lang").collect()
    groups_of: list[tuple[list[str], int, int]] = []  # languages, symbols, contexts
    n = contexts = 0
    for r in sizes:
        n_new, contexts_new = max(n, r.symbols + 1), contexts + r.contexts
        if not groups_of or 2 * n_new * (n_new**2 + contexts_new) * (len(groups_of[-1][0]) + 1) > MODEL_BYTES:
            groups_of.append(([], 0, 0))
            n_new, contexts_new = r.symbols + 1, r.contexts
        n, contexts = n_new, contexts_new
        groups_of[-1] = ([*groups_of[-1][0], r.lang], n, contexts)
    return LanguageModel(table, [x for g in groups_of for x in _ranges(table, *g)])


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), to_bytes(batch.column("text")), strict=True):
            for order, (code, n) in enumerate(count_strings(text)):
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(code), pa.string()), pa.array(np.full(len(code), order, np.int32)), pa.array(code), pa.array(n)], names=["lang", "order", "code", "n"])


def identify_languages(docs: DataFrame, model: LanguageModel, group_bytes: int = 1 << 20) -> DataFrame:
    """doc_id, lang_pred and score of every text; other columns aren't carried.

    The language with the shortest code for the whole text wins, the first by name in a tie. score is its share of
    2^-(code length), 0 for `und`, which stands for null texts, texts without a letter, and a model of no language.
    Each part of the model is a pass over docs.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    spark = docs.sparkSession

    def scores(rows: DataFrame, part: PpmModel, names: list[str], fields: str) -> DataFrame:
        """names of rows, whether the text has a letter, and its code length in each language of the part."""
        shared = spark.sparkContext.broadcast(part)

        def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part = shared.value
            for batch in batches:
                values = to_bytes(batch.column("text"))
                letter = [_LETTER.search(x.decode("utf-8", "replace")) is not None for x in values]
                bits = np.concatenate([np.zeros((0, len(part.langs))), *(part.bits(values[lo:hi]) for lo, hi in groups(values, group_bytes))])
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(letter, pa.bool_()), pa.array(list(bits), pa.list_(pa.float64()))], names=[*names, "letter", "bits"])

        return map_arrow(rows, predict, f"{fields}, letter boolean, bits array<double>")

    def chosen(bits: Column, langs: list[str]) -> list[Column]:
        """The language with the shortest code, `und` without a letter, and the sum of 2^-(what others are longer)."""
        least = F.array_min(bits)
        best = F.get(F.array(*map(F.lit, langs)).cast("array<string>"), F.array_position(bits, least).cast("int") - 1)
        others = F.aggregate(bits, F.lit(0.0), lambda s, b: s + F.pow(F.lit(2.0), F.greatest(least - b, F.lit(-1000.0))))
        return [F.when(F.col("letter"), F.coalesce(best, F.lit("und"))).otherwise("und").alias("lang_pred"), others.alias("others")]

    score = F.when(F.col("lang_pred") == "und", F.lit(0.0)).otherwise(1 / F.col("others")).alias("score")
    if len(model.ranges) < 2:
        part = next(model.parts(), PpmModel.from_counts({}))
        one = scores(docs.select("doc_id", "text"), part, ["doc_id"], f"doc_id {kind}")
        return one.select("doc_id", *chosen(F.col("bits"), part.langs)).select("doc_id", "lang_pred", score)
    rows = numbered(docs.select("doc_id", "text"))
    row = rows.columns[-1]
    found = None
    for part in model.parts():
        # a part's code lengths in the places of all languages, 0 in those of others
        bits = F.array(*[F.get("bits", F.lit(part.langs.index(x))) if x in part.langs else F.lit(0.0) for x in model.langs])
        one = stage(scores(rows, part, ["doc_id", row], f"doc_id {kind}, {row} bigint").select("doc_id", row, "letter", bits.alias("bits")), "language-scores")
        found = one if found is None else found.unionByName(one)
    # code lengths of a text's parts are added, language by language
    sums = found.groupBy(row).agg(F.first("doc_id").alias("doc_id"), F.max("letter").alias("letter"), *[F.sum(F.col("bits")[i]).alias(f"b{i}") for i in range(len(model.langs))])
    whole = sums.select("doc_id", "letter", F.array(*[F.col(f"b{i}") for i in range(len(model.langs))]).alias("bits"))
    return whole.select("doc_id", *chosen(F.col("bits"), model.langs)).select("doc_id", "lang_pred", score)
