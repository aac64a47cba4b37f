"""Mixing sources to target weights by soft membership.

A naive Bayes classifier over hashed words, counted from a table of labelled documents and
calibrated on each of them with the others' counts, gives every document a posterior over
domains. Document rates r ≥ 0 are then fitted so that the expected tokens of
each domain, the sum of rate × tokens × posterior, match the targets, by least squares: the
squared misses of the domains plus a small weight times the squared distance of the rates from
one common rate. Misses are weighed by the inverse of the sums of products of posteriors, so a
rare domain counts for as much as a common one.

The fit is a projected gradient: a step takes from every rate the weighed misses times its
posterior and puts the rate back between the bounds. A step is one aggregate over all
documents, which gives the misses; its length follows from the last step (Barzilai and
Borwein). A rate is the outcome of all steps, an expression over the posterior, so nothing is
stored by document. Targets that no rates meet are approached, logged, and told by ``met`` and
``reached``; a bound on rates keeps texts next to nothing of a missing domain from being taken
very often. All of it is DataFrame expressions.

Defined results: null and empty texts have no tokens and the prior as posterior; rows are
rated one by one; a row without ``doc_id`` is rated like any other; without labels all
domains are equally likely.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacegrid.llm.common import let, written

#: Domains by the labels of a document, and the wanted shares of tokens.
DOMAINS = {"good": "toxic = 0 AND quality = 1", "poor": "toxic = 0 AND quality = 0", "toxic": "toxic = 1"}
TARGETS = {"good": 0.7, "poor": 0.2, "toxic": 0.1}
#: Rows of ``labels`` that the classifier is counted from at most, chosen by a hash.
LABELLED_ROWS = 20_000
#: Whole words are hashed into so many features; the weights are one array a domain.
FEATURES = 1 << 17
#: Texts that a feature's ratio between a domain and all is drawn towards 1 by.
PRIOR_TEXTS = 1.0
#: Powers of a text's length that its sum may be divided by, and the calibration's ridge.
POWERS = (0.0, 0.5, 1.0)
RIDGE = 1.0
#: Total tokens wanted, over the least total that needs no document to be left out.
HEADROOM = 1.05
#: Weight of a rate's distance from the common one, against the domains' weighed misses: both
#: are squares in shares of all tokens. It decides which of the rates that meet the targets are
#: taken, and bounds the rates where none do.
PULL = 1e-6
#: Steps at most; a fit that misses its targets after them says so.
STEPS = 40
#: A step may raise the sum of squares, but not above the greatest of so many last ones.
RECENT = 8
#: Steps end too when rates no longer move, as a share of the common rate.
STILL = 1e-5
#: Characters of a plan that Spark keeps; the classifier's weights are in it.
PLAN_CHARACTERS = 20_000
#: With a floor, the total grows by this factor until the targets are met, so many times at most.
GROWTH, GROWTHS = 1.5, 8
#: Steps end when every domain is this near to its target, as a share of all tokens.
CLOSE = 1e-4
SEED = 41
LOG = logging.getLogger(__name__)
#: Least and greatest rate.
FREE = (0.0, float("inf"))


def features(text: Column) -> Column:
    """``n`` words, and the distinct features of a text."""
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), "")

    def both(found: Column) -> Column:
        hashed = F.transform(found, lambda w: F.pmod(F.xxhash64(w), F.lit(FEATURES)).cast("int"))
        return F.struct(F.size(found).cast("bigint").alias("n"), F.array_distinct(hashed).alias("at"))

    return let(words, both)


def numbers(values: list[float]) -> Column:
    """A constant array."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>")


@dataclass
class Classifier:
    domains: list[str]
    prior: list[float]
    weights: list[list[float]]
    #: By domain, what the sums of all domains, the log of the length and 1 count for; from
    #: labelled rows. None takes the sums as they are.
    mixture: list[list[float]] | None = None
    power: float = 0.5

    def posterior(self, found: Column) -> Column:
        """An array of probabilities, one a domain, from ``features``."""
        size = F.size(found["at"]).cast("double")
        scale = F.pow(F.greatest(size, F.lit(1.0)), F.lit(self.power))

        def total(weights: Column) -> Column:
            return F.aggregate(found["at"], F.lit(0.0), lambda a, f: a + F.get(weights, f))

        sums = F.array(*(total(numbers(w)) / scale for w in self.weights))
        prior = [F.log(F.lit(p)) for p in self.prior]

        def logs(given: Column) -> Column:
            if self.mixture is None:
                return F.array(*(F.get(given, F.lit(d)) + p for d, p in enumerate(prior)))
            out = []
            for row, p in zip(self.mixture, prior):
                one = F.lit(row[-1]) + F.lit(row[-2]) * F.log1p(size)
                for d in range(len(self.domains)):
                    one = one + F.lit(row[d]) * F.get(given, F.lit(d))
                out.append(F.when(size > 0, one).otherwise(p))
            return F.array(*out)

        def normal(logs: Column) -> Column:
            return let(
                F.transform(logs, lambda x: F.exp(x - F.array_max(logs))),
                lambda e: F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, b: a + b)),
            )

        return let(let(sums, logs), normal)


def learn(
    documents: DataFrame, labels: DataFrame, domains: dict[str, str] | None = None, rows: int = LABELLED_ROWS
) -> Classifier:
    """Counts of features by domain, from at most ``rows`` labelled documents."""
    domains = domains or DOMAINS
    names = list(domains)
    which = F.coalesce(*(F.when(F.expr(e), F.lit(n)) for n, e in domains.items()))
    known = labels.where("doc_id IS NOT NULL").withColumn("domain", which).where("domain IS NOT NULL")
    known = known.groupBy("doc_id").agg(F.min("domain").alias("domain"))
    chosen = known.orderBy(F.xxhash64("doc_id", F.lit(SEED)), "doc_id").limit(rows)
    # Bounded by ``rows``: one text of each id.
    texts = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    found = texts.select("doc_id", "domain", features(F.col("text"))["at"].alias("at"))
    found = found.groupBy("doc_id", "domain").agg(F.min("at").alias("at"))
    found = written(found.withColumn("own", F.array_position(F.lit(names), F.col("domain")) - 1), "mixing-labelled")
    return trained(names, found)


def trained(names: list[str], found: DataFrame) -> Classifier:
    """Weights by counts, and what their sums tell about the domain by how they came out for
    each labelled row (``doc_id, own, at``) with weights counted from the other rows.

    Features are counted and summed by Spark; the driver gets a row for each feature and a few
    numbers for each labelled row, however long the texts are.
    """
    domains = range(len(names))
    count = np.zeros(len(names), np.int64)
    for own, times in found.groupBy("own").count().collect():
        count[own] = times
    n = int(count.sum())
    prior = [(int(c) + 1) / (n + len(names)) for c in count]
    by = np.zeros((len(names), FEATURES), np.int64)
    hits = found.select("own", F.explode("at").alias("at")).groupBy("at")
    counts = written(hits.agg(*(F.count_if(F.col("own") == d).alias(f"n{d}") for d in domains)), "mixing-counts")
    counted = counts.toArrow()
    for d in domains:
        by[d][counted["at"].to_numpy()] = counted[f"n{d}"].to_numpy()
    whole = by.sum(axis=0)

    def weight(here, texts, everywhere, of):
        # Presence against what the feature's share of all texts lets expect.
        return np.log((here + PRIOR_TEXTS) / (texts * everywhere / max(of, 1) + PRIOR_TEXTS))

    weights = [np.round(weight(by[d], count[d], whole, n), 4).tolist() for d in domains]
    if n < 2 or (count > 0).sum() < 2:
        return Classifier(names, prior, weights)

    # Every feature of a labelled row with its counts, less the row's own. The counts are a row
    # for each feature, 2**17 at most.
    each = found.select("doc_id", "own", F.explode("at").alias("at"))
    each = each.join(F.broadcast(counts), "at")
    others = sum(F.col(f"n{d}") for d in domains) - 1
    sums = []
    for d in domains:
        less = F.when(F.col("own") == d, 1).otherwise(0)
        expected = (F.lit(int(count[d])) - less) * others / max(n - 1, 1)
        ratio = (F.col(f"n{d}") - less + PRIOR_TEXTS) / (expected + PRIOR_TEXTS)
        # Rounded, so that the order of a sum does not matter.
        sums.append(F.sum(F.round(F.log(ratio), 6).cast("decimal(18,6)")).cast("double").alias(f"s{d}"))
    rows = each.groupBy("doc_id").agg(*sums)
    rows = found.select("doc_id", "own", F.size("at").alias("size")).join(rows, "doc_id", "left").fillna(0.0)
    # Bounded by the labelled rows; the order in which they come must not matter.
    rows = rows.toArrow().sort_by("doc_id")
    own, sizes = rows["own"].to_numpy(), rows["size"].to_numpy()
    sums = [rows[f"s{d}"].to_numpy() for d in domains]
    best = None
    for power in POWERS:
        given = np.stack([s / np.maximum(sizes, 1) ** power for s in sums] + [np.log1p(sizes), np.ones(n)], axis=1)
        loss, mixture = calibrated(given[sizes > 0], own[sizes > 0], len(names), prior)
        if best is None or loss < best[0]:
            best = (loss, power, mixture)
    return Classifier(names, prior, weights, np.round(best[2], 6).tolist(), best[1])


def calibrated(given: np.ndarray, own: np.ndarray, classes: int, prior: list[float]) -> tuple[float, np.ndarray]:
    """Multinomial logistic regression by Newton steps: loss, and coefficients by class."""
    middle, spread = given.mean(axis=0), given.std(axis=0)
    spread[spread < 1e-9] = 1.0
    middle[-1], spread[-1] = 0.0, 1.0
    x, wide = (given - middle) / spread, given.shape[1]
    beta = np.zeros((classes, wide))
    beta[:, -1] = np.log(prior)
    hit = np.eye(classes)[own]
    pull = np.full((classes, wide), RIDGE)
    pull[:, -1] = 1e-3

    def chances(b):
        z = x @ b.T
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def loss(b, p):
        return -np.log(np.maximum(p[np.arange(len(own)), own], 1e-300)).sum() + (pull * b**2).sum() / 2

    p = chances(beta)
    now = loss(beta, p)
    for _ in range(100):
        slope = (p - hit).T @ x + pull * beta
        bend = np.diag(pull.ravel())
        for a in range(classes):
            for b in range(classes):
                w = p[:, a] * ((a == b) - p[:, b])
                bend[a * wide : (a + 1) * wide, b * wide : (b + 1) * wide] += (x * w[:, None]).T @ x
        move = np.linalg.solve(bend, slope.ravel()).reshape(beta.shape)
        length = 1.0
        while length > 1e-6 and loss(beta - length * move, chances(beta - length * move)) > now:
            length /= 2
        beta = beta - length * move
        p, last = chances(beta), now
        now = loss(beta, p)
        if last - now < 1e-7 * max(1.0, abs(now)):
            break
    out = beta / spread
    out[:, -1] -= (beta[:, :-1] * middle[:-1] / spread[:-1]).sum(axis=1)
    return now, out


def rate_of(
    posterior: Column, history: list[list[float]], start: float, pull: float, step: float | list[float],
    bounds: tuple[float, float] = FREE
) -> Column:
    """The rate after all steps so far, each projected onto the rates between ``bounds``.

    A step takes ``step`` times the gradient away: the misses of all domains by the posterior,
    and the pull towards ``start``.
    """
    if not history:
        return _between(F.lit(float(start)), bounds)
    return stepped(posterior, history, start, pull, step, bounds)["rate"]


def stepped(
    posterior: Column, history: list[list[float]], start: float, pull: float, step: float | list[float],
    bounds: tuple[float, float] = FREE
) -> Column:
    """The rate ``before`` the last of one or more steps, and the ``rate`` after it.

    The numbers of the steps are constant arrays that one lambda goes through, so the expression
    is as small after many steps as after one, and all passes of a fit run the same code.
    """
    lengths = step if isinstance(step, list) else [step] * len(history)
    kept = numbers([1.0 - length * pull for length in lengths])
    pulled = numbers([length * pull * start for length in lengths])
    taken = [numbers([length * m for m, length in zip(of, lengths)]) for of in zip(*history)]

    def follow(acc: Column, k: Column) -> Column:
        rate = acc["rate"] * F.get(kept, k) + F.get(pulled, k)
        for d, moves in enumerate(taken):
            rate = rate - F.get(posterior, F.lit(d)) * F.get(moves, k)
        return F.struct(acc["rate"].alias("before"), _between(rate, bounds).alias("rate"))

    first = _between(F.lit(float(start)), bounds)
    steps = F.sequence(F.lit(0), F.lit(len(history) - 1))
    return F.aggregate(steps, F.struct(first.alias("before"), first.alias("rate")), follow)


@dataclass
class Mix:
    """A fitted mix; applied to documents without a join."""

    classifier: Classifier
    history: list[list[float]]
    start: float
    step: float | list[float]
    targets: list[float]
    bounds: tuple[float, float] = FREE
    #: Expected tokens of each domain, and whether all are as near to the targets as ``CLOSE``.
    reached: list[float] = field(default_factory=list)
    met: bool = False

    def shares(self) -> dict[str, float]:
        whole = sum(self.reached) or 1.0
        return {n: round(r / whole, 4) for n, r in zip(self.classifier.domains, self.reached)}

    def rate(self, posterior: Column) -> Column:
        return rate_of(posterior, self.history, self.start, PULL, self.step, self.bounds)

    def apply(self, documents: DataFrame, text: str = "text") -> DataFrame:
        """``documents`` with ``n_tokens``, ``posterior`` and ``rate``."""
        found = documents.withColumn("_features", features(F.col(text)))
        found = found.withColumn("_posterior", self.classifier.posterior(F.col("_features")))
        rate = self.rate(F.col("_posterior"))
        return found.select(
            *(found[c] for c in documents.columns if c not in {"n_tokens", "posterior", "rate"}),
            F.col("_features.n").alias("n_tokens"),
            F.col("_posterior").alias("posterior"),
            rate.alias("rate"),
        )


def scored(posteriors: DataFrame) -> DataFrame:
    """Posteriors written and read again, without the driver keeping the weights' text."""
    conf, name = posteriors.sparkSession.conf, "spark.sql.maxPlanStringLength"
    before = conf.get(name)
    conf.set(name, str(PLAN_CHARACTERS))
    try:
        return written(posteriors, "mixing")
    finally:
        conf.set(name, before)


def fit(
    documents: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, bounds: tuple[float, float] = FREE
) -> Mix:
    """Classifier and rates; targets are shares of tokens by domain. ``bounds`` are
    the least and the greatest rate: from 1 on no document is left out, and with an upper one
    none is repeated more often. ``reached`` and ``met`` tell how near the totals come."""
    model = learn(documents, labels)
    data = scored(Mix(model, [], 1.0, 0.0, []).apply(documents.select("text")).drop("text", "rate"))
    return solve(data, model, targets, bounds)


def rated(
    documents: DataFrame, labels: DataFrame, keep: list[str], targets: dict[str, float] | None = None,
    bounds: tuple[float, float] = FREE
) -> tuple[DataFrame, Mix]:
    """The ``keep`` columns with ``n_tokens``, ``posterior`` and ``rate``; texts are scored once."""
    model = learn(documents, labels)
    data = scored(Mix(model, [], 1.0, 0.0, []).apply(documents).select(*keep, "n_tokens", "posterior"))
    mix = solve(data, model, targets, bounds)
    return data.withColumn("rate", mix.rate(F.col("posterior"))), mix


def solve(
    rows: DataFrame, model: Classifier, targets: dict[str, float] | None = None, bounds: tuple[float, float] = FREE
) -> Mix:
    """Rates from ``n_tokens`` and ``posterior`` of all documents, a written table."""
    targets = targets or TARGETS
    domains = range(len(model.domains))
    blank = Mix(model, [], 1.0, 0.0, [], bounds)
    data = rows.select(
        F.col("n_tokens").cast("double").alias("t"), *(F.get("posterior", F.lit(d)).alias(f"p{d}") for d in domains)
    )
    pairs = [(a, b) for a in domains for b in domains if a <= b]
    found = data.agg(
        F.sum("t"), *(F.sum(F.col("t") * F.col(f"p{d}")) for d in domains),
        *(F.sum(F.col("t") * F.col(f"p{a}") * F.col(f"p{b}")) for a, b in pairs),
    ).first()
    total = found[0] or 0.0
    if not total:
        return blank
    share = [found[1 + d] / total for d in domains]
    gram = {p: found[1 + len(share) + i] / total for i, p in enumerate(pairs)}
    whole = sum(targets.values())
    wanted = [targets[n] / whole for n in model.domains]
    least = HEADROOM * max(s / w for s, w in zip(share, wanted) if w)

    bends = np.zeros((len(domains), len(domains)))
    for a, b in pairs:
        bends[a, b] = bends[b, a] = gram[a, b]
    weigh = np.linalg.inv(bends + PULL * np.eye(len(domains)))

    def fitted(start: float, bounds: tuple[float, float]) -> Mix:
        """Projected gradient steps with the lengths of Barzilai and Borwein."""
        goal = start * np.array(wanted)
        posterior, t = F.array(*(F.col(f"p{d}") for d in domains)), F.col("t")

        def squares(misses: np.ndarray, far: float) -> float:
            return (misses @ weigh @ misses + PULL * far) / 2

        def at(history: list, lengths: list) -> tuple[np.ndarray, float, float]:
            """Domain totals at the rates after some steps, how far these are from the start
            and how far the last step went, in squares, as shares of all tokens: one pass."""
            still = F.lit(float(np.clip(start, *bounds)))
            if history:
                found = data.withColumn("_s", stepped(posterior, history, start, PULL, lengths, bounds))
            else:
                found = data.withColumn("_s", F.struct(still.alias("before"), still.alias("rate")))
            rates = found.withColumn("_b", F.col("_s.before")).withColumn("_r", F.col("_s.rate"))
            r = F.col("_r")
            row = rates.agg(
                *(F.sum(r * t * F.col(f"p{d}")) for d in domains),
                F.sum(t * (r - start) * (r - start)), F.sum(t * (r - F.col("_b")) * (r - F.col("_b"))),
            ).first()
            return np.array(row[: len(domains)]) / total, row[-2] / total, row[-1] / total

        history: list[list[float]] = []
        lengths: list[float] = []
        now, far, _ = at(history, lengths)
        values = [squares(now - goal, far)]
        length = 1.0  # misses weighed as they are bend the squares by 1 at most
        for turn in range(STEPS):
            misses = now - goal
            if np.abs(misses).max() < CLOSE * start:
                break
            tried = [*history, [float(m) for m in weigh @ misses]], [*lengths, float(length)]
            then, far, moved = at(*tried)
            value = squares(then - goal, far)
            if value > max(values[-RECENT:]):
                length /= 4
                continue
            (history, lengths), change = tried, then - now
            now = then
            values.append(value)
            if moved <= (STILL * start) ** 2:
                break
            # Long and short lengths in turn.
            slant, bent = change @ weigh @ change, weigh @ change
            along = slant + PULL * moved
            across = bent @ bends @ bent + 2 * PULL * slant + PULL**2 * moved
            length = min(max(moved / along if turn % 3 else along / across, 0.5), 1.0 / PULL)
        met = bool(np.abs(now - goal).max() < CLOSE * start)
        reached = [float(n) * total for n in now]
        return Mix(model, history, start, lengths, [float(g) * total for g in goal], bounds, reached, met)

    mix = fitted(least, bounds)
    # A floor may need a larger total, but none helps where free rates miss the targets too.
    if not mix.met and bounds[0] > 0 and bounds[1] == FREE[1] and fitted(least, FREE).met:
        for _ in range(GROWTHS):
            mix = fitted(mix.start * GROWTH, bounds)
            if mix.met:
                break
    if not mix.met:
        LOG.warning("mixing: targets %s not met, reached %s", dict(zip(model.domains, wanted)), mix.shares())
    return mix


def _between(z: Column, bounds: tuple[float, float]) -> Column:
    return F.least(F.lit(float(bounds[1])), F.greatest(F.lit(float(bounds[0])), z))


def copies(rate: Column, *key: Column) -> Column:
    """How often a document is taken: its rate, rounded up with the chance of its fraction."""
    chance = F.pmod(F.xxhash64(*key, F.lit(SEED)), F.lit(1 << 30)) / (1 << 30)
    return F.floor(rate + chance).cast("int")


def mixed(
    documents: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, bounds: tuple[float, float] = FREE
) -> DataFrame:
    """Every document as often as its rate says, with the columns of ``documents``."""
    # All columns travel in one struct, so that none clashes with those of the mix.
    whole = documents.select("doc_id", "text", F.struct(*documents.columns).alias("_row"))
    found, _ = rated(whole, labels, ["_row"], targets, bounds)
    row = F.col("_row")
    times = copies(F.col("rate"), row["doc_id"], F.xxhash64(row["text"]))
    return found.select(row, F.explode(F.array_repeat(F.lit(0), times))).select("_row.*")
