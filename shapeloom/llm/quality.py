"""Quality classifier from weak labels.

Eight overlapping heuristics vote ``bad``, ``good`` or abstain on every document.
Expectation-maximisation over the counts of vote patterns estimates how each
heuristic behaves on good and on bad documents, and so the probability that a
document with a given pattern is good. Those probabilities are the soft labels on
which a linear scorer over hashed words and hashed word shapes is trained; the
scorer alone decides. No hand label is used.

Vote patterns are counted over all documents (at most 3**8 counts reach the
driver). The scorer is fitted on at most ``max_fit_rows`` documents, picked by a
hash of their id; scoring is one pass over the texts without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shapeloom.llm.common import mix, share, ship, slices, text_buffers
from shapeloom.llm.words import powers, word_bounds, word_hashes

BAD, GOOD, ABSTAIN = 0, 1, 2
_CHUNK = 1 << 20
#: Frequent function words of English, German, French and Spanish.
FUNCTION_WORDS = (
    "the of and to in a is that it for on was be with as by at from or this are "
    "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als "
    "de la le et les des en un du une que est pour qui dans par au pas sur avec "
    "el los y que del las por con una su para es al lo como no se"
).split()


@dataclass
class Stats:
    """Counts of each text: one array entry per document."""

    words: np.ndarray
    letters: np.ndarray
    upper: np.ndarray
    symbols: np.ndarray
    marks: np.ndarray
    stops: np.ndarray
    repeats: np.ndarray
    function_words: np.ndarray
    word_bytes: np.ndarray


def _classes(data: np.ndarray) -> np.ndarray:
    """1 lower-case letter, 2 capital, 3 digit, else the byte itself (white space included)."""
    table = np.arange(256, dtype=np.uint8)
    table[97:123], table[65:91], table[48:58], table[128:] = 1, 2, 3, 1
    out = table[data]
    if len(data) > 1:
        lead = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E))
        out[lead] = out[lead + 1] = 2
    return out


def _per_text(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.append(0, np.cumsum(values, dtype=np.int64))
    return total[at[1:]] - total[at[:-1]]


def _word_set(words: list[str]) -> np.ndarray:
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    return np.unique(word_hashes(data, *word_bounds(data, np.array([0, len(data)]))))


def _is_in(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[at] == values


def _lowered(data: np.ndarray) -> np.ndarray:
    out = data.copy()
    out[(data >= 65) & (data <= 90)] += 32
    return out


def text_stats(data: np.ndarray, offsets: np.ndarray) -> tuple[Stats, np.ndarray, np.ndarray, np.ndarray]:
    """Counts per text, then all words' hashes, shape hashes and the first word of each text."""
    kind = _classes(data)
    starts, ends = word_bounds(data, offsets)
    at = np.searchsorted(starts, offsets)
    words = word_hashes(_lowered(data), starts, ends)
    same = np.zeros(len(words), bool)
    same[1:] = words[1:] == words[:-1]
    same[at[:-1][at[:-1] < len(words)]] = False
    ordinary = np.zeros(256, bool)
    ordinary[[1, 2, 3, 9, 10, 11, 12, 13, 32, *b".,;:'\"()-?!"]] = True
    mark = (data == ord("!")) | (data == ord("|"))
    stop = (data == ord(".")) | (data == ord("?"))
    stats = Stats(
        np.diff(at), _per_text((kind == 1) | (kind == 2), offsets), _per_text(kind == 2, offsets),
        _per_text(~ordinary[kind], offsets), _per_text(mark, offsets), _per_text(stop, offsets), _per_text(same, at),
        _per_text(_is_in(words, _word_set(FUNCTION_WORDS)), at), _per_text(ends - starts, at),
    )
    return stats, words, _shapes(kind, starts, ends), at


def _shapes(kind: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each word's runs of equal byte classes: ``Then!!`` and ``Abc!`` share one."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    own = kind[np.repeat(starts - first, lengths) + np.arange(int(lengths.sum()))]
    begins = np.ones(len(own), bool)
    begins[1:] = own[1:] != own[:-1]
    begins[first] = True
    runs = np.cumsum(begins)
    rank = runs - np.repeat(runs[first], lengths)
    values = np.where(begins, own.astype(np.uint64) + np.uint64(1), np.uint64(0)) * powers(int(rank.max()) + 1)[rank]
    return mix(np.add.reduceat(values, first))


def votes(s: Stats) -> np.ndarray:
    """One row per text, one column per heuristic."""
    n, letters = np.maximum(s.words, 1), np.maximum(s.letters, 1)

    def vote(bad: np.ndarray, good: np.ndarray) -> np.ndarray:
        return np.where(bad, BAD, np.where(good, GOOD, ABSTAIN))

    size = s.word_bytes / n
    return np.stack([
        vote(s.upper > 0.4 * letters, s.upper < 0.15 * letters),
        vote(s.symbols > 0.06 * s.word_bytes, s.symbols < 0.01 * s.word_bytes),
        vote(s.marks > 0.15 * n, s.marks < 0.02 * n),
        vote(s.repeats > 0.08 * n, (s.repeats < 0.02 * n) & (s.words >= 20)),
        vote((s.stops < 0.005 * n) & (s.words >= 20), (s.stops > 0.02 * n) & (s.stops < 0.5 * n)),
        vote((s.function_words < 0.05 * n) & (s.words >= 20), s.function_words > 0.15 * n),
        vote((size < 2.5) | (size > 14), (size > 3.2) & (size < 9)),
        vote(s.words < 4, s.words >= 30),
    ], axis=1)


HEURISTICS = ("capitals", "symbols", "marks", "repeats", "sentences", "function words", "word size", "length")


def pattern_codes(text: Column) -> Column:
    """The votes on each text as one number in base three."""

    @F.arrow_udf("int")
    def code(column: pa.Array) -> pa.Array:
        data, offsets = text_buffers(column)
        out = [np.zeros(0, np.int64)]
        for a, b in slices(offsets, _CHUNK):
            stats = text_stats(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])[0]
            out.append(votes(stats) @ (3 ** np.arange(len(HEURISTICS))))
        return pa.array(np.concatenate(out).astype(np.int32))

    return code(text)


@dataclass
class LabelModel:
    """prior: share of good documents; behaviour[h, y, v]: chance of vote v by heuristic h on a document of class y."""

    prior: float
    behaviour: np.ndarray

    def accuracy(self) -> np.ndarray:
        """Of each heuristic where it does not abstain."""
        p = np.array([1 - self.prior, self.prior])
        right = p[0] * self.behaviour[:, 0, BAD] + p[1] * self.behaviour[:, 1, GOOD]
        given = (p[None, :, None] * self.behaviour[:, :, :2]).sum((1, 2))
        return right / np.maximum(given, 1e-12)

    def posterior(self, codes: np.ndarray) -> np.ndarray:
        """Probability that documents with these vote patterns are good."""
        given = _unpack(codes)
        logs = np.log(np.array([1 - self.prior, self.prior]))[None, :].repeat(len(given), 0)
        for h in range(given.shape[1]):
            logs += np.log(self.behaviour[h][:, given[:, h]]).T
        return 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -500, 500)))


def _unpack(codes: np.ndarray) -> np.ndarray:
    return np.asarray(codes)[:, None] // 3 ** np.arange(len(HEURISTICS)) % 3


def fit_label_model(codes: np.ndarray, counts: np.ndarray, rounds: int = 200, tolerance: float = 1e-7) -> LabelModel:
    """Expectation-maximisation from the majority vote on; one pseudo-count for every cell."""
    given, counts = _unpack(codes), np.asarray(counts, float)
    good, bad = (given == GOOD).sum(1), (given == BAD).sum(1)
    chance = np.clip((good - 2.0 * bad) / np.maximum(good + bad, 1) * 0.45 + 0.5, 0.05, 0.95)
    model = LabelModel(0.5, np.full((given.shape[1], 2, 3), 1 / 3))
    for _ in range(rounds):
        weight = np.stack([counts * (1 - chance), counts * chance])
        behaviour = np.ones_like(model.behaviour)
        for v in (BAD, GOOD, ABSTAIN):
            behaviour[:, :, v] += (weight[:, :, None] * (given == v)[None]).sum(1).T
        behaviour /= behaviour.sum(2, keepdims=True)
        total = counts.sum()
        model = LabelModel(float((weight[1].sum() + 1) / (total + 2)), behaviour)
        new = model.posterior(codes)
        moved = float((np.abs(new - chance) * counts).sum() / max(total, 1))
        chance = new
        if moved < tolerance:
            break
    return model


@dataclass
class Scorer:
    """Mean weight of a text's words plus mean weight of their shapes."""

    weights: np.ndarray
    intercept: float

    def slots(self, words: np.ndarray, shapes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        half = np.uint64(len(self.weights) // 2)
        return (words % half).astype(np.int64), (shapes % half + half).astype(np.int64)

    def chance(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        stats, words, shapes, at = text_stats(data, offsets)
        a, b = self.slots(words, shapes)
        total = np.append(0.0, np.cumsum(self.weights[a] + self.weights[b]))
        mean = (total[at[1:]] - total[at[:-1]]) / np.maximum(stats.words, 1)
        out = 1 / (1 + np.exp(-np.clip(mean + self.intercept, -500, 500)))
        return np.where(stats.words > 0, out, 0.0)


def _features(text: Column, buckets: int) -> Column:
    """Hashed word and shape slots of a text with their mean counts, as bytes (int32 slots, then float32 values)."""
    empty = Scorer(np.zeros(buckets), 0.0)

    @F.arrow_udf("binary")
    def features(column: pa.Array) -> pa.Array:
        data, offsets = text_buffers(column)
        out = []
        for a, b in slices(offsets, _CHUNK):
            _, words, shapes, at = text_stats(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            for i in range(b - a):
                x, y = empty.slots(words[at[i] : at[i + 1]], shapes[at[i] : at[i + 1]])
                slot, n = np.unique(np.concatenate([x, y]), return_counts=True)
                out.append(slot.astype(np.int32).tobytes() + (n / max(len(x), 1)).astype(np.float32).tobytes())
        return pa.array(out, pa.binary())

    return features(text)


def fit_scorer(features: list[bytes], chance: np.ndarray, buckets: int, rounds: int = 300, rate: float = 0.3, ridge: float = 1e-5) -> Scorer:
    """Logistic regression on soft labels by full gradients with adaptive steps; classes weigh the same."""
    chance = np.asarray(chance, float)
    if not len(features) or chance.sum() < 1e-9 or (1 - chance).sum() < 1e-9:
        return Scorer(np.zeros(buckets), 5.0)  # nothing tells the classes apart: reject nothing
    sizes = np.array([len(f) // 8 for f in features])
    rows = np.repeat(np.arange(len(features)), sizes)
    slot = np.concatenate([np.frombuffer(f[: len(f) // 2], np.int32) for f in features])
    value = np.concatenate([np.frombuffer(f[len(f) // 2 :], np.float32) for f in features]).astype(float)
    balance = np.where(chance >= 0.5, 0.5 / max((chance >= 0.5).sum(), 1), 0.5 / max((chance < 0.5).sum(), 1))
    w = np.zeros(buckets + 1)
    first, second = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, rounds + 1):
        z = np.bincount(rows, value * w[slot], len(features)) + w[-1]
        error = balance * (1 / (1 + np.exp(-np.clip(z, -500, 500))) - chance)
        gradient = np.append(np.bincount(slot, value * error[rows], buckets) + ridge * w[:-1], error.sum())
        first, second = 0.9 * first + 0.1 * gradient, 0.999 * second + 0.001 * gradient**2
        w -= rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-6)
    return Scorer(w[:-1], float(w[-1]))


def fit_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_fit_rows: int = 6000, buckets: int = 1 << 13, seed: int = 7) -> tuple[LabelModel, Scorer]:
    """Count vote patterns over all documents, estimate the heuristics, train the scorer.

    ``max_fit_rows`` bounds (in expectation) the documents whose hashed features
    come to the driver; a text has at most ``buckets`` of them.
    """
    ship(docs)
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    patterns = docs.select(pattern_codes(F.col("text")).alias("code")).groupBy("code").count().toPandas()
    codes, counts = patterns["code"].to_numpy(np.int64), patterns["count"].to_numpy(np.int64)
    model = fit_label_model(codes, counts)
    picked = docs.where(share("id", seed=seed) < max_fit_rows / max(int(counts.sum()), 1)) if len(counts) else docs.limit(0)
    rows = picked.select(pattern_codes(F.col("text")).alias("code"), _features(F.col("text"), buckets).alias("f")).toArrow()
    return model, fit_scorer(rows["f"].to_pylist(), model.posterior(rows["code"].to_numpy().astype(np.int64)), buckets)


def quality_score(text: Column, scorer: Scorer) -> Column:
    """Probability of a good text; an empty or null text has 0."""

    @F.arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        data, offsets = text_buffers(column)
        out = [np.zeros(0)]
        for a, b in slices(offsets, _CHUNK):
            out.append(scorer.chance(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]))
        return pa.array(np.concatenate(out))

    return score(text)


def classify_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", out: str = "quality_score") -> DataFrame:
    """``docs`` with the score in ``out``.

    Null and empty texts score 0. Repeated rows score alike. Null ids are allowed.
    Columns of any other name pass through; an existing column ``out`` is replaced.
    Very long texts are scored whole. An empty table gives an empty table.
    """
    _, scorer = fit_quality(docs, id_col, text_col)
    return docs.withColumn(out, quality_score(F.col(text_col), scorer))


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, unchanged columns."""
    return classify_quality(docs, id_col, text_col, out="__quality").where(F.col("__quality") >= threshold).drop("__quality")
