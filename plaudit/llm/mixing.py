"""Mixing to target weights with soft domain membership.

A classifier learned from the labelled table gives every document a posterior
over the domains. Document rates r >= 0 are then fitted so that the expected
token totals ``sum_d r_d * tokens_d * p_dk`` meet the targets of the domains:

    minimise 1/2 (A r - t)' M (A r - t),  r >= 0,   A_kd = tokens_d * p_dk

by projected gradient steps from rate 1. M is the inverse Gram matrix of the
domains, so the gradient of a document is ``p_d . M (A r - t)`` and a step size
of 1 is safe. A pass is one global sum over the documents; it tries longer
steps, and steps scaled by the Gram matrix of the documents with a positive
rate, and takes the best. Only k numbers a step are kept on the driver, and the
rates so far are written to the shared folder every few steps.

Any s whose products with all posteriors are at most 0 bounds the minimum from
below, which tells how far the totals can be from the best ones, and ends the
steps. Targets far out of reach press nearly all rates to 0, where gradient
steps crawl; the minimum is then finished by Newton steps on the dual.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, RegexTokenizer, UnivariateFeatureSelector
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, no_text
from .quality import held_out

DOMAINS = ("clean", "low", "toxic")
# Names that the classifier's columns take while it runs; the caller's
# columns are carried in one struct beside them, so no name can clash.
_ROW, _TEXT = "_row", "_text"
# A token is a run of letters or a run of other signs.
_BETWEEN = r"\s+|(?<=\p{L})(?=[^\p{L}\s])|(?<=[^\p{L}\s])(?=\p{L})"


def domain_of(quality: str = "quality", toxic: str = "toxic") -> Column:
    """Domain of a labelled row: toxic first, then low quality; null without labels."""
    return (F.when(F.col(toxic) == 1, F.lit(2.0)).when((F.col(quality) == 0) & (F.col(toxic) == 0), F.lit(1.0))
            .when((F.col(quality) == 1) & (F.col(toxic) == 0), F.lit(0.0)))


@dataclass
class DomainModel:
    """Posteriors over ``domains``; without labelled rows of two domains all
    mass is on the one seen, or spread evenly; without frequent words the
    posteriors are the labels' shares."""
    domains: tuple[str, ...] = DOMAINS
    pipeline: PipelineModel | None = None
    constant: list[float] = field(default_factory=list)

    def apply(self, docs: DataFrame, text: str = "text") -> DataFrame:
        """(_row, tokens, p) per row of ``docs``: the row as a struct, its
        number of tokens (runs of letters or of other signs), the posteriors. Empty texts have no
        tokens and the model's prior."""
        rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(_ROW),
                           F.trim(no_text(text)).alias(_TEXT))
        if self.pipeline is None:
            words = F.when(F.length(_TEXT) == 0, 0).otherwise(F.size(F.split(_TEXT, _BETWEEN)))
            return rows.select(_ROW, words.cast("long").alias("tokens"),
                               F.array(*map(F.lit, self.constant)).alias("p"))
        p = vector_to_array("probability")
        k = len(self.domains)
        return self.pipeline.transform(rows).select(
            _ROW, F.size("_words").cast("long").alias("tokens"),
            F.array(*[F.coalesce(F.get(p, i), F.lit(0.0)) for i in range(k)]).alias("p"))


def fit_domains(docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id",
                per_domain: int = 2500, max_chars: int = 20_000, seed: int = 11) -> DomainModel:
    """Multinomial logistic regression over the presence of the 256 words that
    tell the domains apart best (chi-squared),
    fitted on a bounded sample: at most ``per_domain`` labelled documents a
    domain, chosen by a hash of the id among the labelled ids that ``docs``
    holds with a text of 1 to ``max_chars`` characters, and weighted back to
    the domains' shares of those ids."""
    texts = (docs.select(F.col(id_col).cast("long").alias("id"), F.trim(no_text(text)).alias(_TEXT))
             .where(F.length(_TEXT).between(1, max_chars)))
    usable = cut(labels.select(F.col(id_col).cast("long").alias("id"), domain_of().alias("y"))
                 .where("id is not null and y is not null").where(~held_out("id"))
                 .groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("y2")).where("y = y2")
                 .join(texts.select("id"), "id", "left_semi")
                 .select("id", "y", F.xxhash64("id", F.lit(seed)).alias("h")), "domain-labels")
    counts = {int(r["y"]): r["count"] for r in usable.groupBy("y").count().collect()}  # a row a domain
    k = len(DOMAINS)
    picks = None
    for y in range(k):
        part = usable.where(F.col("y") == y).orderBy("h", "id").limit(per_domain)
        picks = part if picks is None else picks.unionByName(part)
    sample = cut(texts.join(F.broadcast(picks), "id").groupBy("id", "y").agg(F.min(_TEXT).alias(_TEXT)),
                 "domain-sample")
    got = {int(r["y"]): r["count"] for r in sample.groupBy("y").count().collect()}
    if len(got) < 2:
        return DomainModel(constant=[1.0 if y in got else 0.0 if got else 1 / k for y in range(k)])
    # words in a fixed order and rows in a fixed order: the same sample gives
    # the same model in every run
    tokens = RegexTokenizer(inputCol=_TEXT, outputCol="_words", pattern=_BETWEEN, toLowercase=True)
    vocabulary = [r["w"] for r in tokens.transform(sample).select(F.explode(F.array_distinct("_words")).alias("w"))
                  .groupBy("w").count().where(F.col("count") >= 8)
                  .orderBy(F.col("count").desc(), "w").limit(1 << 13).collect()]
    if not vocabulary:
        return DomainModel(constant=[counts.get(y, 0) / sum(counts.values()) for y in range(k)])
    weight = F.create_map(*[F.lit(x) for y, n in got.items() for x in (float(y), counts[y] / n)])
    model = Pipeline(stages=[
        tokens,
        CountVectorizerModel.from_vocabulary(vocabulary, inputCol="_words", outputCol="_vec", binary=True),
        UnivariateFeatureSelector(featuresCol="_vec", outputCol="_best", labelCol="y",
                                  selectionMode="numTopFeatures")
        .setFeatureType("categorical").setLabelType("categorical").setSelectionThreshold(256),
        LogisticRegression(featuresCol="_best", labelCol="y", weightCol="_w", family="multinomial",
                           regParam=1e-4, maxIter=40),
    ]).fit(sample.withColumn("_w", weight[F.col("y")]).coalesce(1).sortWithinPartitions("id"))
    return DomainModel(pipeline=model)


def rate_column(steps: list[np.ndarray], p: str = "p", start: Column | None = None) -> Column:
    """Rate of a document from its posteriors: ``start`` (default 1), then a
    clipped step each."""
    k, start = len(DOMAINS), F.lit(1.0) if start is None else start
    if not steps:
        return start
    path = F.array(*[F.array(*[F.lit(float(x)) for x in s]) for s in steps])
    return F.aggregate(path, start, lambda r, s: F.greatest(
        F.lit(0.0), r + sum((F.col(p)[i] * s[i] for i in range(1, k)), F.col(p)[0] * s[0])))


@dataclass
class _Aim:
    """Totals of the domains at rate 1, their targets, the Gram matrix of the
    domains with mass (``there``) and its inverse, zero for the others."""
    now: np.ndarray
    target: np.ndarray
    there: np.ndarray
    gram: np.ndarray
    metric: np.ndarray

    @property
    def total(self) -> float:
        return self.now.sum()


def _masses() -> list[Column]:
    return [F.col("tokens") * F.col("p")[i] for i in range(len(DOMAINS))]


def _aim(members: DataFrame, weights: dict[str, float], budget: float | None, keep: str | None,
         surplus: float) -> _Aim:
    """The targets are the shares ``weights`` of ``budget`` tokens; ``keep``
    sets the budget so that this domain's target is ``surplus`` times its
    present expected total. Default budget: the present total. Domains without
    any mass can't be met and are left out of the objective."""
    k, mass = len(DOMAINS), _masses()
    first = members.agg(
        *[F.coalesce(F.sum(m), F.lit(0.0)).alias(f"a{i}") for i, m in enumerate(mass)],
        *[F.coalesce(F.sum(mass[i] * F.col("p")[j]), F.lit(0.0)).alias(f"g{i}{j}")
          for i in range(k) for j in range(k)]).first()
    now = np.array([first[f"a{i}"] for i in range(k)])
    total = now.sum()
    share = np.array([weights.get(d, 0.0) for d in DOMAINS])
    share = share / share.sum()
    if keep is not None and share[DOMAINS.index(keep)] > 0:
        budget = surplus * now[DOMAINS.index(keep)] / share[DOMAINS.index(keep)]
    target = share * (total if budget is None else budget)
    there = now > 1e-9 * total
    gram, metric = np.zeros((k, k)), np.zeros((k, k))
    if total > 0:
        on = np.ix_(there, there)
        gram[on] = np.array([[first[f"g{i}{j}"] for j in range(k)] for i in range(k)])[on]
        gram[on] += 1e-9 * np.trace(gram) * np.eye(there.sum())
        metric[on] = np.linalg.inv(gram[on])
    return _Aim(now, target, there, gram, metric)


@dataclass
class _Point:
    """What one pass tells about ``s``: totals, Gram matrix of the documents
    with a positive rate, sum of tokens times squared rate, largest p . s."""
    s: np.ndarray
    now: np.ndarray
    active: np.ndarray
    square: float
    most: float


def _along(s: np.ndarray) -> Column:
    """p . s of a document with tokens."""
    return F.when(F.col("tokens") > 0, sum((F.col("p")[i] * float(s[i]) for i in range(1, len(DOMAINS))),
                                           F.col("p")[0] * float(s[0])))


def _points(members: DataFrame, tries: list[np.ndarray], before: Column | None = None,
            beside: np.ndarray | None = None) -> tuple[list[_Point], float]:
    """One pass: each of ``tries`` as a step from the rates ``before`` (default
    1), and the largest p . ``beside``."""
    k, mass = len(DOMAINS), _masses()
    found = [F.max(_along(tries[0] if beside is None else beside)).alias("beside")]
    for n, s in enumerate(tries):
        rate = rate_column([s], start=before)
        found += [*[F.sum(m * rate).alias(f"a{n}_{i}") for i, m in enumerate(mass)],
                  *[F.sum(F.when(rate > 0, mass[i] * F.col("p")[j]).otherwise(0.0)).alias(f"g{n}_{i}_{j}")
                    for i in range(k) for j in range(i, k)],
                  F.sum(F.col("tokens") * rate * rate).alias(f"q{n}"),
                  F.max(_along(s)).alias(f"m{n}")]
    row = members.agg(*found).first()
    return [_Point(s, np.array([row[f"a{n}_{i}"] for i in range(k)]),
                   np.array([[row[f"g{n}_{min(i, j)}_{max(i, j)}"] for j in range(k)] for i in range(k)]),
                   row[f"q{n}"], row[f"m{n}"]) for n, s in enumerate(tries)], row["beside"]


@dataclass
class Rates:
    """``steps`` for ``rate_column``, the totals reached and the targets;
    ``unmet`` has what is missing (or, negative, too much) of the targets that
    are off by more than the tolerance, ``settled`` says that the totals are
    within the tolerance of the targets or of the best that rates >= 0 reach."""
    steps: list[np.ndarray]
    now: np.ndarray
    target: np.ndarray
    unmet: dict[str, float]
    settled: bool


def fit_rates(members: DataFrame, weights: dict[str, float], budget: float | None = None, keep: str | None = None,
              surplus: float = 1.0, tolerance: float = 1e-4, max_steps: int = 24, rewrite: int = 6) -> Rates:
    """Rates for ``members`` (tokens, p) whose totals are within ``tolerance``
    of the total of the targets (those of ``_aim``), or, out of reach, of the
    totals at the minimum of the objective; unmet targets are logged too.

    Projected gradient from rate 1; ``max_steps`` without an end go on in
    ``_finish``. The rates are written every ``rewrite`` steps, so that a pass
    evaluates few of them."""
    aim = _aim(members, weights, budget, keep, surplus)
    within, on = tolerance * aim.total, np.ix_(aim.there, aim.there)
    steps, recent, now, active, length, floor = [], [], aim.now, aim.gram, 1.0, 0.0
    state, start = members.select("tokens", "p"), None

    def loss(totals: np.ndarray) -> float:
        off = (aim.target - totals) * aim.there
        return off @ aim.metric @ off / 2

    def done() -> bool:
        if np.abs((aim.target - now) * aim.there).max() <= within:
            return True
        return np.sqrt(2 * max(0.0, loss(now) - floor) * np.diag(aim.gram).max()) <= within

    settled = aim.total <= 0 or done()
    while not settled and len(steps) < max_steps:
        off = (aim.target - now) * aim.there
        slope, scaled = aim.metric @ off, np.zeros(len(DOMAINS))
        scaled[aim.there] = np.linalg.solve(
            active[on] + 1e-9 * np.trace(active) * np.eye(aim.there.sum()), off[aim.there])
        tries = [slope * length * f for f in (1, 4, 16)] + [scaled * f for f in (1, 0.3, 0.05)]
        found, most = _points(state, tries, rate_column(recent, start=start), slope)
        low = np.where(aim.there, slope - max(0.0, most), 0.0)  # p . low <= 0 for every document
        floor = max(floor, low @ aim.target - low @ aim.gram @ low / 2)
        best = min(range(len(tries)), key=lambda i: loss(found[i].now))
        if loss(found[best].now) >= loss(now):
            if settled := done():  # by the new bound
                break
            length /= 16
            if length < 1e-6:
                break
            continue
        length *= (0.5, 2, 8)[best] if best < 3 else 1
        steps.append(tries[best])
        recent.append(tries[best])
        now, active = found[best].now, found[best].active
        settled = done()
        if len(recent) == rewrite and not settled:
            state = cut(state.select("tokens", "p", rate_column(recent, start=start).alias("r")), "rates")
            recent, start = [], F.col("r")
    if not settled:
        steps, now, settled = _finish(members, aim, within)
    off = aim.target - now
    unmet = {d: float(x) for d, x in zip(DOMAINS, off) if abs(x) > within}
    if unmet or not settled:
        logging.getLogger(__name__).warning("mixing targets %s, tokens missing (negative: too many): %s",
                                            "out of reach" if settled else "not reached", unmet)
    return Rates(steps, now, aim.target, unmet, bool(settled))


def _finish(members: DataFrame, aim: _Aim, within: float, max_passes: int = 100) -> tuple[list[np.ndarray], np.ndarray, bool]:
    """(steps, totals, settled): the minimum as the limit of a small weight
    ``ridge`` on the distance of the rates from 1. They have the form
    ``r_d = max(0, 1 + p_d . s)``, found by Newton steps on the convex dual in
    s; each pass tries four lengths."""
    on = np.ix_(aim.there, aim.there)
    ridge, at, passes = 1e-4, _points(members, [np.zeros(len(DOMAINS))])[0][0], 1

    def value(x: _Point) -> float:
        return x.square / 2 + ridge * (x.s @ aim.gram @ x.s) / 2 - aim.target @ x.s

    def best(x: _Point) -> bool:
        off = (aim.target - x.now) * aim.there
        if np.abs(off).max() <= within:
            return True
        low = np.where(aim.there, ridge * (x.s - max(0.0, x.most)), 0.0)  # p . low <= 0 for every document
        gap = (off @ aim.metric @ off) / 2 - (low @ aim.target - low @ aim.gram @ low / 2)
        return np.sqrt(2 * max(0.0, gap) * np.diag(aim.gram).max()) <= within

    while not (settled := best(at)) and passes < max_passes:
        slope = (at.now + ridge * (aim.gram @ at.s) - aim.target) * aim.there
        move = np.zeros(len(DOMAINS))
        move[aim.there] = -np.linalg.solve((at.active + ridge * aim.gram)[on], slope[aim.there])
        new = min(_points(members, [at.s + f * move for f in (1.0, 0.3, 0.1, 0.01)])[0], key=value)
        passes += 1
        flat = value(at) - value(new) <= 1e-12 * abs(value(at))
        at = at if value(new) > value(at) else new
        if flat or np.abs((at.now + ridge * (aim.gram @ at.s) - aim.target) * aim.there).max() <= within / 100:
            if not (settled := best(at)):
                ridge /= 10
    return [at.s] if at.s.any() else [], at.now, settled


def copies_column(rate: Column, key: list[Column], seed: int = 5) -> Column:
    """Whole copies whose expectation is ``rate``: the integer part, and one
    more where a hash of the document falls below the rest."""
    u = F.pmod(F.xxhash64(*key, F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    return (F.floor(rate) + (u < rate - F.floor(rate)).cast("long")).cast("int")


def mix(docs: DataFrame, labels: DataFrame, weights: dict[str, float], text: str = "text", id_col: str = "doc_id",
        budget: float | None = None, keep: str | None = None, surplus: float = 1.0) -> DataFrame:
    """(doc_id, tokens, p_clean, p_low, p_toxic, rate, copies) per row of
    ``docs``. Repeated rows get the same rate and copies."""
    model = fit_domains(docs, labels, text, id_col)
    members = cut(model.apply(docs, text).select(
        F.col(f"{_ROW}.`{id_col}`").alias("doc_id"),
        F.xxhash64(F.col(f"{_ROW}.`{text}`")).alias("h"), "tokens", "p"), "members")
    steps = fit_rates(members.select("tokens", "p"), weights, budget, keep, surplus).steps
    return (members.withColumn("rate", rate_column(steps))
            .withColumn("copies", copies_column(F.col("rate"), [F.col("doc_id"), F.col("h")]))
            .select("doc_id", "tokens", *[F.col("p")[i].alias(f"p_{d}") for i, d in enumerate(DOMAINS)],
                    "rate", "copies"))


def mixed_documents(docs: DataFrame, labels: DataFrame, weights: dict[str, float], text: str = "text",
                    id_col: str = "doc_id", budget: float | None = None, keep: str | None = None,
                    surplus: float = 1.0) -> DataFrame:
    """The rows of ``docs``, each as often as its ``copies`` say."""
    model = fit_domains(docs, labels, text, id_col)
    # the rows are written with their posteriors: the classifier runs once
    members = cut(model.apply(docs, text).withColumn("h", F.xxhash64(F.col(f"{_ROW}.`{text}`"))), "members")
    steps = fit_rates(members.select("tokens", "p"), weights, budget, keep, surplus).steps
    copies = copies_column(rate_column(steps), [F.col(f"{_ROW}.`{id_col}`"), F.col("h")])
    return (members.withColumn("_n", copies).where("_n > 0")
            .withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("_n")))).select(f"{_ROW}.*"))
