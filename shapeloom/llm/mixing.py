"""Mix documents to target weights of soft domains, in DataFrame functions alone.

A labelled table names the domain of some documents. A softmax classifier over
the words that tell domains apart (and four coarse traits of the text) gives every
document a probability for each domain. Projected steps along the gradient, scaled
by its curvature, then find the nonnegative document rates closest to 1 whose
expected token totals by domain meet the targets.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shapeloom.llm.common import set_aside, share, stored


@dataclass
class DomainModel:
    """Softmax over present features: ``base`` by domain, ``weights`` by feature and domain."""

    domains: list[str]
    base: list[float]
    vocabulary: list[str]
    weights: list[list[float]]


def _numbers(values: list[float]) -> Column:
    """A constant array that the plan holds as one value, however long."""
    return F.split(F.lit(",".join(map(repr, map(float, values)))), ",").cast("array<double>")


def _strings(values: list[str]) -> Column:
    return F.split(F.lit("\x01".join(values)), "\x01")


def words_of(text: Column) -> Column:
    """Lower-case words of a text without the punctuation around them (null: none)."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\s.,;:()\"]+"), "")


def features(text: Column, words: Column) -> Column:
    """Words and four traits of a text in coarse steps; words may repeat."""
    text = F.coalesce(text, F.lit(""))
    chars = F.greatest(F.length(text), F.lit(1))

    def step(name: str, pattern: str) -> Column:
        """The share of characters that the pattern matches, in octaves."""
        rest = F.length(F.regexp_replace(text, pattern, ""))
        octave = F.floor(F.log2((chars - rest) / chars + F.lit(1 / 256)))
        return F.concat(F.lit(f" {name} "), F.greatest(octave, F.lit(-8)).cast("string"))

    size = F.concat(F.lit(" size "), F.floor(F.log2(chars.cast("double")) / 2).cast("string"))
    traits = F.array(step("capitals", r"\p{Lu}+"), step("marks", r"[^\p{L}\p{N}\s.,;:?'-]+"), step("stops", r"[.?]+"), size)
    return F.concat(words, traits)


class NothingToLearn(ValueError):
    """No document has a label, or none has the anchor's."""


def fit_domains(docs: DataFrame, labels: DataFrame, domain_col: str = "domain", id_col: str = "doc_id", text_col: str = "text", max_rows: int = 20_000, max_vocabulary: int = 200, least_documents: int = 10, least_surprise: float = 5.0, least_ratio: float = 4.0, ridge: float = 1e-4, seed: int = 11) -> DomainModel:
    """Learn the domains that ``labels`` (id, domain) names.

    At most ``max_rows`` labelled rows are used (in expectation; picked by a hash of
    the id), so the sample of labels may be broadcast. Of their features the
    ``max_vocabulary`` with the largest standardised difference between a domain
    and all rows are kept, if that is ``least_surprise`` at least and some domain
    has the feature ``least_ratio`` times as often as another; the rest does not
    vote. The weights are then fitted together, so features that go together share theirs.
    """
    labels = labels.where(F.col(domain_col).isNotNull() & F.col(id_col).isNotNull())
    labels = labels.select(F.col(id_col).alias("id"), F.col(domain_col).cast("string").alias("domain"))
    total = labels.count()
    if not total:
        raise NothingToLearn("no labelled rows to learn domains from")
    picked = labels.where(share("id", seed=seed) < max_rows / total)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(picked), "id")
    marked = rows.select("domain", F.explode(F.array_append(F.array_distinct(features(F.col("text"), words_of(F.col("text")))), F.lit(""))).alias("w"))
    counted = stored(marked.groupBy("w", "domain").agg(F.count(F.lit(1)).alias("n")), "features")
    kept = {r["domain"]: r["n"] for r in counted.where("w = ''").collect()}
    if not kept:
        raise NothingToLearn("no labelled row has a document")
    domains, n = sorted(kept), sum(kept.values())
    columns = [F.sum(F.when(F.col("domain") == d, F.col("n")).otherwise(0)).alias(f"d{j}") for j, d in enumerate(domains)]
    table = counted.where("w <> ''").groupBy("w").agg(F.sum("n").alias("seen"), *columns).where(F.col("seen") >= least_documents)
    part = [kept[d] / n for d in domains]
    surprise = [F.abs(F.col(f"d{j}") - F.col("seen") * p) / F.sqrt(F.col("seen") * (p * (1 - p)) + 1) for j, p in enumerate(part)]
    rate = [(F.col(f"d{j}") + 0.1) / (kept[d] + 1) for j, d in enumerate(domains)]
    table = table.withColumn("surprise", F.greatest(*surprise, F.lit(0.0)))
    if len(domains) > 1:
        table = table.where(F.greatest(*rate) >= F.least(*rate) * least_ratio)
    best = table.where(F.col("surprise") >= least_surprise).orderBy(F.col("surprise").desc(), "w").limit(max_vocabulary).collect()
    vocabulary = [r["w"] for r in best]
    sample = rows.select("domain", features(F.col("text"), words_of(F.col("text"))).alias("f"))
    base, weights = _fit_softmax(sample, domains, vocabulary, ridge)
    return DomainModel(domains, base, vocabulary, weights)


def _fit_softmax(sample: DataFrame, domains: list[str], vocabulary: list[str], ridge: float, rounds: int = 20) -> tuple[list[float], list[list[float]]]:
    """Limited-memory quasi-Newton; every evaluation is one aggregate over the stored sample."""
    k, v = len(domains), len(vocabulary)
    stored_sample = stored(sample.select(F.array_position(_strings(domains), F.col("domain")).alias("y"), _places(F.col("f"), vocabulary).alias("at")), "sample")
    n = stored_sample.count()

    def evaluate(x: np.ndarray) -> tuple[float, np.ndarray]:
        logs = _scores(F.col("at"), x[v * k :].tolist(), x[: v * k].tolist(), k)
        shifted = stored_sample.select("y", "at", logs.alias("z")).select("y", "at", F.transform("z", lambda a: a - F.array_max("z")).alias("z"))
        total = F.aggregate("z", F.lit(0.0), lambda s, a: s + F.exp(a))
        rows = shifted.select("y", "at", "z", total.alias("t")).select(
            F.explode(F.array_append("at", F.lit(v))).alias("place"), (F.log("t") - F.get("z", F.col("y").cast("int") - 1)).alias("loss"),
            *[(F.exp(F.get("z", F.lit(j))) / F.col("t") - (F.col("y") == j + 1).cast("double")).alias(f"g{j}") for j in range(k)],
        )
        sums = rows.groupBy("place").agg(*[F.sum(f"g{j}").alias(f"g{j}") for j in range(k)], F.sum("loss").alias("loss")).collect()
        gradient, loss = np.zeros((v + 1, k)), 0.0
        for r in sums:
            gradient[r["place"]] = [r[f"g{j}"] for j in range(k)]
            loss = r["loss"] if r["place"] == v else loss
        held = np.append(x[: v * k], np.zeros(k))
        return loss / n + ridge / 2 * float(held @ held), gradient.ravel() / n + ridge * held

    x = np.zeros((v + 1) * k)
    value, gradient = evaluate(x)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        direction, kept = -gradient, []
        for s, y in reversed(pairs):
            a = s @ direction / (s @ y)
            kept.append(a)
            direction = direction - a * y
        if pairs:
            s, y = pairs[-1]
            direction = direction * (s @ y) / (y @ y)
        for (s, y), a in zip(pairs, reversed(kept), strict=True):
            direction = direction + s * (a - y @ direction / (s @ y))
        step, slope = (1.0 if pairs else min(1.0, 1 / max(np.abs(gradient).sum(), 1e-12))), gradient @ direction
        for _ in range(8):
            new_value, new_gradient = evaluate(x + step * direction)
            if new_value <= value + 1e-4 * step * slope:
                break
            step /= 4
        else:
            break
        s, y = step * direction, new_gradient - gradient
        if s @ y > 1e-12:
            pairs = [*pairs[-7:], (s, y)]
        gain = value - new_value
        x, value, gradient = x + s, new_value, new_gradient
        if gain < 1e-4 * max(value, 1e-3):
            break
    return x[v * k :].tolist(), x[: v * k].reshape(v, k).tolist()


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once however often it is used."""
    return F.get(F.transform(F.array(value), body), 0)


def _places(found: Column, vocabulary: list[str]) -> Column:
    """Positions in the vocabulary of the features that a document has."""
    known = _strings(vocabulary or [""])
    return F.transform(F.array_intersect(found, known), lambda w: F.array_position(known, w).cast("int") - 1)


def _scores(places: Column, base: list[float], flat_weights: list[float], k: int) -> Column:
    flat = _numbers(flat_weights or [0.0])

    def score(j: int) -> Column:
        return F.aggregate(places, F.lit(float(base[j])), lambda s, i: s + F.get(flat, i * k + j))

    return F.array(*[score(j) for j in range(k)])


def posteriors(text: Column, words: Column, model: DomainModel) -> Column:
    """Array of probabilities, one per domain in the model's order."""
    flat = [w for row in model.weights for w in row]

    def chances(at: Column) -> Column:
        scores = _scores(at, model.base, flat, len(model.domains))
        return _bound(scores, lambda x: F.transform(x, lambda y: F.exp(y - F.array_max(x))))

    def to_one(x: Column) -> Column:
        return F.transform(x, lambda y: y / F.aggregate(x, F.lit(0.0), lambda s, z: s + z))

    return _bound(_bound(_places(features(text, words), model.vocabulary), chances), to_one)


def rate_of(chances: Column, steps: list[list[float]]) -> Column:
    """A document's rate after gradient steps, each projected to at least 0."""
    if not steps:
        return F.lit(1.0)
    k = len(steps[0])
    flat = _numbers([x for step in steps for x in step])

    def follow(rate: Column, i: Column) -> Column:
        for j in range(k):
            rate = rate - F.get(chances, F.lit(j)) * F.get(flat, i * k + j)
        return F.greatest(rate, F.lit(0.0))

    return F.aggregate(F.sequence(F.lit(0), F.lit(len(steps) - 1)), F.lit(1.0), follow)


@dataclass
class Mixture:
    """Targets and reached totals by domain, the steps that give a document its rate, and whether all targets are met."""

    domains: list[str]
    before: list[float]
    targets: list[float]
    after: list[float]
    steps: list[list[float]]
    reached: bool = True


def _solve_rates(slim: DataFrame, before: list[float], targets: list[float], scale: float, met: Callable[[list[float]], bool]) -> tuple[list[float], list[float]]:
    """``x`` of the rates ``max(0, 1 - chances . x)``, and the totals by domain that they give.

    Minimises the dual of the distance from 1 plus a large multiple of the squared
    distances from the targets: convex and piecewise quadratic, so that the steps end.
    """
    k, t = len(targets), np.array(targets)
    chance = [F.get(F.col("chances"), F.lit(j)) for j in range(k)]
    give = 1e-8 * np.maximum(np.maximum(before, t), 1e-9 * scale)

    def evaluate(x: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        rated = slim.select("tokens", "chances", rate_of(F.col("chances"), [x.tolist()]).alias("r"))
        live = F.when(F.col("r") > 0, F.col("tokens")).otherwise(0.0)
        row = rated.agg(
            F.sum(F.col("tokens") * F.col("r") * F.col("r")).alias("square"), *[F.sum(F.col("tokens") * F.col("r") * c).alias(f"s{j}") for j, c in enumerate(chance)],
            *[F.sum(live * chance[i] * chance[j]).alias(f"m{i}_{j}") for i in range(k) for j in range(i, k)],
        ).first()
        moment = np.array([[row[f"m{min(i, j)}_{max(i, j)}"] for j in range(k)] for i in range(k)])
        return row["square"] / 2 + float(t @ x + give @ (x * x) / 2), np.array([row[f"s{j}"] for j in range(k)]), moment

    x, now = np.zeros(k), np.array(before)
    if met(before):
        return x.tolist(), before
    value, now, moment = evaluate(x)
    while not met(now.tolist()):
        slope = t - now + give * x
        step = -np.linalg.solve(moment + np.diag(give), slope)
        fall = float(slope @ step)
        if not fall < -1e-12 * max(abs(value), scale):
            break
        length = 1.0
        while length > 1e-15:
            new = evaluate(x + length * step)
            if new[0] <= value + 1e-4 * length * fall:
                break
            length /= 4
        else:
            break
        x = x + length * step
        value, now, moment = new
    return x.tolist(), now.tolist()


def fit_rates(slim: DataFrame, domains: list[str], weights: dict[str, float], anchor: str, max_steps: int | None = None, tolerance: float = 2e-3) -> Mixture:
    """Rates closest to 1 (weighted by tokens) whose expected token totals meet the targets.

    ``slim`` holds ``tokens`` and the array ``chances``; it is read once per step,
    and each pass returns a few totals. Targets are in proportion to ``weights``; the
    ``anchor`` domain keeps its present total, so the others are measured against
    it. The rates sought are ``max(0, 1 - chances . x)``; Newton steps find ``x``
    until every total is within ``tolerance`` of its own target (of the anchor's for
    a target of 0), or no step brings them closer. Then ``reached`` is false, and the
    rates leave the least squares of the distances, weighted by the larger of target
    and present total. A ``max_steps`` asks for
    so many plain steps of projected gradient descent on the weighted squares of
    (expected tokens - target) at most: a document's step is its gradient
    divided by its tokens, the step size the inverse of the largest curvature.
    """
    k = len(domains)
    share_of = [max(0.0, float(weights.get(d, 0.0))) for d in domains]
    chance = [F.get(F.col("chances"), F.lit(j)) for j in range(k)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    moments = slim.agg(
        *[F.coalesce(F.sum(F.col("tokens") * c), F.lit(0.0)).alias(f"s{j}") for j, c in enumerate(chance)],
        *[F.coalesce(F.sum(F.col("tokens") * chance[i] * chance[j]), F.lit(0.0)).alias(f"m{i}_{j}") for i, j in pairs],
    ).first()
    before = [moments[f"s{j}"] for j in range(k)]
    if not weights.get(anchor):
        raise ValueError(f"the anchor {anchor!r} needs a weight")
    if anchor not in domains:
        raise NothingToLearn(f"no labelled row is of the anchor {anchor!r}")
    scale = before[domains.index(anchor)] / share_of[domains.index(anchor)]
    targets = [scale * w for w in share_of]
    if scale <= 0:
        return Mixture(domains, before, targets, before, [], not any(targets))
    allowed = [tolerance * (t or targets[domains.index(anchor)]) for t in targets]

    def met(totals: list[float]) -> bool:
        return all(abs(a - t) <= e for a, t, e in zip(totals, targets, allowed, strict=True))

    if max_steps is None:
        x, now = _solve_rates(slim, before, targets, scale, met)
        return Mixture(domains, before, targets, now, [x] if any(x) else [], met(now))
    inverse = [1 / max(b, t, 1e-9 * scale) for b, t in zip(before, targets, strict=True)]
    curvature = max(sum(moments[f"m{min(i, j)}_{max(i, j)}"] * math.sqrt(inverse[i] * inverse[j]) for j in range(k)) for i in range(k))
    steps: list[list[float]] = []
    now = before
    for _ in range(max_steps):
        if met(now):
            break
        steps.append([w * (a - t) / curvature for w, a, t in zip(inverse, now, targets, strict=True)])
        rated = slim.select("tokens", "chances", rate_of(F.col("chances"), steps).alias("r"))
        row = rated.agg(*[F.sum(F.col("tokens") * F.col("r") * c).alias(f"s{j}") for j, c in enumerate(chance)]).first()
        now = [row[f"s{j}"] for j in range(k)]
    return Mixture(domains, before, targets, now, steps, met(now))


def with_chances(docs: DataFrame, model: DomainModel, text_col: str = "text") -> DataFrame:
    """``docs`` plus ``__tokens`` (words) and ``__chances``."""
    out = docs.withColumn("__words", words_of(F.col(text_col)))
    out = out.withColumn("__tokens", F.size("__words").cast("double"))
    return out.withColumn("__chances", posteriors(F.col(text_col), F.col("__words"), model)).drop("__words")


def copies_of(rate: Column, *key: Column | str, seed: int = 13) -> Column:
    """Whole copies of a document: the rate rounded up or down by a hash of ``key``, right on average."""
    return (F.floor(rate) + (share(*key, seed=seed) < rate - F.floor(rate)).cast("long")).cast("long")


def mix_rates(docs: DataFrame, labels: DataFrame, weights: dict[str, float], anchor: str, carry: list[str] | None = None, domain_col: str = "domain", id_col: str = "doc_id", text_col: str = "text", out: str = "", **fit: int) -> tuple[DataFrame, Mixture]:
    """``docs`` with ``tokens``, ``chances`` (array by domain), ``rate`` and ``copies``, and the fitted mixture.

    ``carry`` names the columns of ``docs`` to return (default: all); ``out`` is a
    prefix for the new columns, which replace columns of their names.
    Null and empty texts have no tokens: they follow the prior and count nothing.
    Rows with a null id share one rounding. Repeated rows are separate rows with
    the same rate. An empty table gives an empty table. Where no document has a label,
    or none the anchor's, there is nothing to fit: every rate is 1, ``chances`` is
    null, the mixture has no domains, and a warning says so. Texts are judged in one
    scan, written with the columns to carry, and never shuffled.
    """
    wanted = docs.columns if carry is None else carry
    docs, back = set_aside(docs)
    ours = {old: new for new, old in back.items()}
    id_col, text_col, carry = ours.get(id_col, id_col), ours.get(text_col, text_col), [ours.get(c, c) for c in wanted]
    back = {new: old for new, old in back.items() if new in carry}
    try:
        model = fit_domains(docs, labels.withColumnsRenamed(ours), domain_col, id_col, text_col, **fit)
        judged = with_chances(docs, model, text_col).withColumn("__key", F.col(id_col))
        judged = stored(judged.select(*carry, "__tokens", "__chances", "__key"), "chances")
        mixture = fit_rates(judged.select(F.col("__tokens").alias("tokens"), F.col("__chances").alias("chances")), model.domains, weights, anchor)
    except NothingToLearn as reason:
        warnings.warn(f"{reason}: every rate is 1", stacklevel=2)
        alike = {"tokens": F.size(words_of(F.col(text_col))).cast("double"), "chances": F.lit(None).cast("array<double>"), "rate": F.lit(1.0), "copies": F.lit(1).cast("long")}
        new = [c.alias(out + name) for name, c in alike.items()]
        return docs.select(*[c for c in carry if c not in [out + name for name in alike]], *new).withColumnsRenamed(back), Mixture([], [], [], [], [], False)
    if not mixture.reached:
        told = ", ".join(f"{d} {a:.0f} of {t:.0f}" for d, a, t in zip(mixture.domains, mixture.after, mixture.targets, strict=True))
        warnings.warn(f"the rates miss their targets (expected tokens by domain: {told})", stacklevel=2)
    rated = judged.withColumn("__rate", rate_of(F.col("__chances"), mixture.steps))
    rated = rated.withColumn("__copies", copies_of(F.col("__rate"), "__key")).drop("__key")
    for name in ("tokens", "chances", "rate", "copies"):
        rated = rated.withColumn(out + name, F.col(f"__{name}")).drop(f"__{name}")
    return rated.withColumnsRenamed(back), mixture


def mixed(docs: DataFrame, labels: DataFrame, weights: dict[str, float], anchor: str, **options: int) -> DataFrame:
    """``docs`` with every row repeated as often as its rate says; same columns. Without labels to learn from, ``docs`` as they are."""
    docs, back = set_aside(docs)
    ours = {old: new for new, old in back.items()}
    options |= {k: ours[v] for k, v in options.items() if k in ("id_col", "text_col") and v in ours}
    rated, _ = mix_rates(docs, labels, weights, anchor, out="__mix_", **options)
    rated = rated.where("__mix_copies > 0").withColumn("__mix_nth", F.explode(F.sequence(F.lit(1), F.col("__mix_copies").cast("int"))))
    return rated.select(*docs.columns).withColumnsRenamed(back)
