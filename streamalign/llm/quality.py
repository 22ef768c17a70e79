"""Quality rules: text counts, and a calibrated logistic regression on hashed word and character n-grams."""

from __future__ import annotations

import warnings
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import Texts, groups, map_arrow, mix, pair_hash, per_text, schema_with, span_hash, to_bytes, with_columns

#: Feature slots; the upper half is for word n-grams, the lower one for character n-grams.
SLOTS = 1 << 15
#: Characters of a character n-gram.
CHAR_N = 4
#: Weights are whole multiples of 1/SCALE, so that a text's sum is exact and doesn't depend on its batch.
SCALE = 1 << 24
SYMBOLS = "#*$%&|<>"

_IS_SYMBOL = np.zeros(256, dtype=bool)
_IS_SYMBOL[[ord(c) for c in SYMBOLS]] = True
_ODD = np.uint64(0x9E3779B97F4A7C15)
_HALF = np.uint64(SLOTS // 2 - 1)

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def text_counts(values: list[bytes]) -> dict[str, np.ndarray]:
    """The counts of the base rules for each text."""
    t = Texts(values)
    start, end, first = t.words()
    chars = (t.buf & 0xC0) != 0x80
    upto = np.concatenate([[0], np.cumsum(chars, dtype=np.int64)])
    symbols = np.concatenate([[0], np.cumsum(_IS_SYMBOL[t.buf], dtype=np.int64)])
    word_chars = per_text(upto[end] - upto[start], first)

    h = span_hash(t.buf, start, end - start)
    n = np.diff(first)
    repeated = np.zeros(t.n, dtype=np.int64)
    if len(h) >= 8:
        two = pair_hash(h[:-1], h[1:])
        four = pair_hash(two[:-2], two[2:])
        eight = pair_hash(four[:-4], four[4:])
        text = np.repeat(np.arange(t.n), n)
        inside = np.flatnonzero(text[:-7] == text[7:])
        key = mix(eight[inside] + text[inside].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(key)
        same = key[order[1:]] == key[order[:-1]]
        twice = np.zeros(len(key), dtype=bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        step = np.zeros(len(h) + 1, dtype=np.int64)
        np.add.at(step, inside[twice], 1)
        np.add.at(step, inside[twice] + 8, -1)
        repeated = per_text(np.cumsum(step)[:-1] > 0, first)
    return {"n_words": n, "word_chars": word_chars, "n_symbols": symbols[t.end] - symbols[t.start], "n_dup_lines": np.array([_dup_lines(x) for x in values], dtype=np.int64), "n_repeat_words": repeated}


def _dup_lines(text: bytes) -> int:
    lines = text.split(b"\n")
    if len(lines) == len(set(lines)):
        return 0
    lines = [x for x in lines if x.strip(b" \t\n\x0b\x0c\r")]
    return len(lines) - len(set(lines))


def features(values: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Feature slots of the words and word pairs of each text, where each text's begin (and one more bound), and the same for character n-grams.

    No pair and no n-gram reaches beyond its text; a text of fewer than CHAR_N characters has no n-gram.
    """
    t = Texts(values)
    start, end, first = t.words()
    h = span_hash(t.buf, start, end - start)
    text = np.repeat(np.arange(t.n), np.diff(first))
    pairs = pair_hash(h[:-1], h[1:])[text[:-1] == text[1:]] if len(h) > 1 else h[:0]
    n_pairs = np.maximum(np.diff(first) - 1, 0)
    pair_first = np.concatenate([[0], np.cumsum(n_pairs)])
    # a text's words, then its pairs
    at = np.arange(len(h)) + np.repeat(pair_first[:-1], np.diff(first))
    at_pairs = np.arange(len(pairs)) + np.repeat(first[1:], n_pairs)
    words = np.empty(len(h) + len(pairs), dtype=np.int32)
    words[at] = (h & _HALF).astype(np.int32) + SLOTS // 2
    words[at_pairs] = (pairs & _HALF).astype(np.int32) + SLOTS // 2

    points = np.frombuffer(b"".join(values).decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), dtype="<u4")
    upto = np.concatenate([[0], np.cumsum((t.buf & 0xC0) != 0x80)])
    n_chars = upto[t.end] - upto[t.start]
    n_grams = np.maximum(n_chars - CHAR_N + 1, 0)
    char_first = np.concatenate([[0], np.cumsum(n_grams)])
    at = np.arange(int(char_first[-1])) + np.repeat(np.cumsum(n_chars) - n_chars - char_first[:-1], n_grams)
    gram = np.zeros(len(at), dtype=np.uint64)
    for k in range(CHAR_N):
        gram = gram * _ODD + points[at + k]
    chars = (gram * _ODD >> np.uint64(50)).astype(np.int32)
    return words, first + pair_first, chars, char_first


@dataclass
class QualityModel:
    """Weights (in 1/SCALE), intercept and the calibration of the score into a probability.

    Without weights there is no regression and probabilities are missing (NaN). With a regression that held-out rows
    contradict, all are 0.5. In both cases `reason` says so.
    """

    weights: np.ndarray | None
    bias: float = 0.0
    slope: float = 1.0
    offset: float = 0.0
    reason: str = ""

    def probability(self, values: list[bytes]) -> np.ndarray:
        if self.weights is None:
            return np.full(len(values), np.nan)
        words, word_first, chars, char_first = features(values)
        score = np.full(len(values), self.bias)
        for slots, first in ((words, word_first), (chars, char_first)):
            score += per_text(self.weights[slots], first) / SCALE / np.maximum(1, np.diff(first))
        return 1 / (1 + np.exp(-np.clip(self.slope * score + self.offset, -500, 500)))


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int, penalty: float) -> tuple[np.ndarray, float]:
    """Weights and intercept by accelerated gradient steps; both classes weigh the same."""
    share = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    share, y, penalty = share.astype(x.dtype), y.astype(x.dtype), x.dtype.type(penalty)
    w, b = np.zeros(x.shape[1], x.dtype), 0.0
    v, c, k = w.copy(), b, 1.0
    rate = x.dtype.type(4.0 / max(1e-12, (share * (np.einsum('ij,ij->i', x, x) + 1)).sum() + penalty))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ v + c, -500, 500)))
        g = share * (p - y)
        w_new, b_new = v - rate * (x.T @ g + penalty * v), c - rate * g.sum()
        k_new = (1 + (1 + 4 * k * k) ** 0.5) / 2
        v, c = w_new + x.dtype.type((k - 1) / k_new) * (w_new - w), b_new + (k - 1) / k_new * (b_new - b)
        w, b, k = w_new, b_new, k_new
    return w, b


def train_quality(docs: DataFrame, labels: DataFrame, per_class: int = 400, rounds: int = 150) -> QualityModel:
    """Fits the regression on a bounded sample of labelled rows and calibrates it on a fourth of them that it hasn't seen.

    per_class documents of each class, in the order of a hash of doc_id; whole texts of any length, null texts not.
    A quality outside 0 and 1 is ignored; of rows with one doc_id one counts. If a class has no document, the
    model has no weights; if the held-out rows contradict the regression, it gives 0.5. Then it has a `reason`, and a
    warning is given.
    """
    rows = []
    for quality in (0, 1):
        few = labels.filter(F.col("quality") == quality).select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        rows.append(few.withColumn("__quality", F.lit(quality)))
    chosen = rows[0].unionByName(rows[1])
    usable = docs.select("doc_id", "text").filter(F.col("text").isNotNull())
    sample = usable.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "__quality")
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = map_arrow(sample, _sample_features, f"doc_id {kind}, quality int, slots binary, shares binary").collect()
    texts = sorted({r.doc_id: r for r in sorted(texts, key=lambda r: (r.slots, r.shares, r.quality))}.values(), key=lambda r: r.doc_id)
    y = np.array([r.quality for r in texts])
    if len(set(y.tolist())) < 2:
        return _without("a class has no labelled document with a text")
    used, place = np.unique(np.concatenate([np.frombuffer(r.slots, np.int32) for r in texts]), return_inverse=True)
    x = np.zeros((len(texts), len(used)), dtype=np.float32)
    at = 0
    for k, r in enumerate(texts):
        shares = np.frombuffer(r.shares, np.float32)
        x[k, place[at : at + len(shares)]] = shares
        at += len(shares)
    fold = np.array([zlib.crc32(str(r.doc_id).encode()) % 4 == 0 for r in texts])
    if len(set(y[fold].tolist())) < 2 or len(set(y[~fold].tolist())) < 2:  # too few to hold any out
        fold = np.zeros(len(texts), dtype=bool)
    held = fold if fold.any() else ~fold
    w, b = _logistic(x[~fold], y[~fold], rounds, 1e-6)
    score = (x[held] @ w + b)[:, None]
    spread = float(score.std()) or 1.0
    slope, offset = _logistic(score / spread, y[held], 500, 1e-3)
    weights = np.zeros(SLOTS, dtype=np.int64)
    weights[used] = np.rint(w.astype(np.float64) * SCALE)
    if not slope[0] > 0:  # no evidence either way: both classes, which weigh the same, are as likely
        reason = "the held-out rows contradict the regression"
        _warn(reason)
        return QualityModel(weights, float(b), 0.0, 0.0, reason)
    return QualityModel(weights, float(b), float(slope[0]) / spread, float(offset))


def _warn(reason: str) -> None:
    warnings.warn(f"no quality regression: {reason}; only the base rules decide", stacklevel=3)


def _without(reason: str) -> QualityModel:
    _warn(reason)
    return QualityModel(None, reason=reason)


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        slots_of, shares_of = [], []
        for x in to_bytes(batch.column("text")):
            words, _, chars, _ = features([x])
            count = np.bincount(words, minlength=SLOTS) / max(1, len(words)) + np.bincount(chars, minlength=SLOTS) / max(1, len(chars))
            slots = np.flatnonzero(count).astype(np.int32)
            slots_of.append(slots.tobytes())
            shares_of.append(count[slots].astype(np.float32).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("__quality").cast(pa.int32()), pa.array(slots_of, pa.binary()), pa.array(shares_of, pa.binary())], names=["doc_id", "quality", "slots", "shares"])


def score_quality(docs: DataFrame, model: QualityModel, threshold: float = 0.5, group_bytes: int = 1 << 20) -> DataFrame:
    """docs with the counts, base_failed, quality_p (the probability of good quality) and kept added, or replaced.

    base_failed: fewer than 20 words, or over 30 % of the words in repeated 8-word windows. kept: not base_failed and
    quality_p at least the threshold. Null text counts as empty, which fails. Each row is judged by itself, so that
    equal texts get equal values in any batch. A model without weights gives null quality_p, and base_failed alone
    decides.
    """
    new = [*COUNTS, "base_failed", "quality_p", "kept"]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, failed, p = _judge(to_bytes(batch.column("text")), shared.value, group_bytes)
            yield with_columns(batch, new, [*(pa.array(x.astype(np.int64)) for x in counts.values()), pa.array(failed), pa.array(p, pa.float64(), mask=np.isnan(p)), pa.array(~failed & ~(p < threshold))])

    return map_arrow(docs, run, schema_with(docs, ", ".join(f"{c} bigint" for c in COUNTS) + ", base_failed boolean, quality_p double, kept boolean"))


def keep_good(docs: DataFrame, model: QualityModel, threshold: float = 0.5, group_bytes: int = 1 << 20) -> DataFrame:
    """The rows of docs that score_quality would keep, with their columns and no others."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, failed, p = _judge(to_bytes(batch.column("text")), shared.value, group_bytes)
            yield batch.filter(pa.array(~failed & ~(p < threshold)))

    return map_arrow(docs, run, docs.schema)


def _judge(values: list[bytes], model: QualityModel, group_bytes: int) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """Counts, whether the base rules fail, and the probability of good quality, of each text."""
    found: dict[str, list] = {c: [] for c in COUNTS}
    chance = []
    for lo, hi in groups(values, group_bytes):
        for c, x in text_counts(values[lo:hi]).items():
            found[c].append(x)
        chance.append(model.probability(values[lo:hi]))
    counts = {c: np.concatenate(x) if x else np.zeros(0, np.int64) for c, x in found.items()}
    p = np.concatenate(chance) if chance else np.zeros(0)
    return counts, (counts["n_words"] < 20) | (100 * counts["n_repeat_words"] > 30 * counts["n_words"]), p
