"""Mixing to target weights by soft membership, in DataFrame operations only.

A naive Bayes classifier over hashed beginnings and ends of words, learnt from the labelled table, gives
every document a posterior over domains. Document rates r >= 0 are then fitted so
that the expected tokens of every domain, the sum of r x tokens x posterior, match
the targets: projected gradient for least squares over the domain residuals. Its
state per document is a function of the few gradients so far, so every round is
one aggregate over the staged posteriors and nothing is rewritten.

The metric weighs documents by their tokens, so equal posteriors get equal rates,
and residuals by the inverse Gram matrix of the domains, so small domains converge
as fast as large ones.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..workspace import sized, stage

SLOTS = 4096  # hashed beginnings of words, and as many ends
ROUNDS, CLOSE_ENOUGH = 30, 1e-5  # most rounds, and the largest residual share that ends them
LONGEST_STEP = 100.0
PATIENCE = 12.0  # words; longer texts weigh their average word as this many
SMOOTHING = 1.0
GRAIN = 1_000_000  # weights are whole numbers of its inverse, so their sums are exact in any order

# Domains of the labelled table and the share of all tokens each is to have.
DOMAINS = ("sound", "poor", "toxic")
TARGETS = (0.85, 0.13, 0.02)


def domain_of(quality: Column, toxic: Column) -> Column:
    """The number of a labelled row's domain; NULL if it has no usable label."""
    return F.when(toxic == 1, 2).when(quality == 0, 1).when(quality == 1, 0)


def _words(text: Column) -> Column:
    """The words of a text. It is trimmed of all that separates them first, so none is empty."""
    trimmed = F.btrim(F.coalesce(text.cast("string"), F.lit("")), F.lit(" \t\n\x0b\f\r"))
    return F.when(trimmed != "", F.split(trimmed, r"\s+")).otherwise(F.array().cast("array<string>"))


def _pair(word: Column) -> list[Column]:
    """Two hashed features of a word: its first four characters, lower-cased, and its last two as they stand."""
    begins = F.pmod(F.xxhash64(F.lower(F.left(word, F.lit(4)))), F.lit(SLOTS))
    ends = F.pmod(F.xxhash64(F.right(word, F.lit(2))), F.lit(SLOTS))
    return [begins.cast("int").alias("begins"), (ends + SLOTS).cast("int").alias("ends")]


def _pairs(text: Column) -> Column:
    """The features of all words of a text in one array. Over a whole table, words as rows are much cheaper."""
    return F.transform(_words(text), lambda word: F.struct(*_pair(word)))


def word_weights(docs: DataFrame, labels: DataFrame, domains: int) -> tuple[list[list[float]], list[float]]:
    """Log-likelihood per domain and slot, and log-priors, from all labelled rows.

    Rows of one document with different labels all count. Without labelled rows
    every domain is equally likely.
    """
    known = labels.select(F.col("doc_id").alias("_labelled"), domain_of(F.col("quality"), F.col("toxic")).alias("domain")).where(
        "domain is not null and _labelled is not null"
    )
    known = stage(known, "labels")
    texts = docs.select(F.col("doc_id").alias("_doc"), F.col("text").cast("string").alias("text"))
    # Labels are few and narrow: as long as they are, no text has to travel to meet them.
    labelled = texts.join(sized(known), F.col("_doc") == F.col("_labelled"))
    counted = (
        labelled.select("domain", F.explode(_words(F.col("text"))).alias("word"))
        .select("domain", *_pair(F.col("word")))
        .groupBy("domain", "begins", "ends")
        .count()
        .select("domain", "count", F.explode(F.array("begins", "ends")).alias("slot"))
        .groupBy("domain", "slot")
        .agg(F.sum("count").alias("count"))
        .collect()  # domains x 2 x SLOTS rows at most
    )
    sizes = {r.domain: r["count"] for r in known.groupBy("domain").count().collect()}
    totals, counts = [0] * domains, [[0] * 2 * SLOTS for _ in range(domains)]
    for r in counted:
        counts[r.domain][r.slot] = r["count"]
        totals[r.domain] += r["count"]
    weights = [[log((c + SMOOTHING) / (totals[d] + SMOOTHING * 2 * SLOTS)) for c in counts[d]] for d in range(domains)]
    everything = sum(sizes.values())
    return weights, [log((sizes.get(d, 0) + 1) / (everything + domains)) for d in range(domains)]


def numbered(docs: DataFrame, *columns: Column) -> DataFrame:
    """``columns`` of ``docs`` and a number per row, as rows may be equal in all columns."""
    return docs.select(F.monotonically_increasing_id().alias("number"), *columns)


def with_posteriors(rows: DataFrame, weights: list[list[float]], priors: list[float]) -> DataFrame:
    """All columns of numbered ``rows`` but the text, with its words counted and a probability per domain.

    Words are rows until they are summed up by row, and no text goes further than
    that. Only differences to the first domain are summed up. A text without words
    has the priors as its posterior and no tokens.
    """
    domains = len(priors)
    gains = [[round((w - b) * GRAIN) for w, b in zip(weights[d], weights[0], strict=True)] for d in range(1, domains)]
    tables = [F.expr(f"cast(split('{','.join(map(str, g))}', ',') as array<int>)") for g in gains]
    names = [c for c in rows.columns if c != "text"]
    words = rows.select(*names, F.explode_outer(_words(F.col("text"))).alias("word"))
    summed = (
        words.select(*names, "word", *_pair(F.col("word")))
        .groupBy(*names)
        .agg(
            F.count("word").alias("tokens"),
            *(F.sum(F.get(t, F.col("begins")) + F.get(t, F.col("ends"))).alias(f"_gain{d}") for d, t in enumerate(tables, 1)),
        )
    )
    pull = F.least(F.lit(1.0), F.lit(PATIENCE) / F.greatest(F.col("tokens"), F.lit(1)))
    # The row that stands for no words has been hashed as well.
    gained = [F.when(F.col("tokens") > 0, F.col(f"_gain{d}")).otherwise(0) / F.lit(float(GRAIN)) for d in range(1, domains)]
    scores = [F.lit(0.0), *(pull * g + F.lit(priors[d] - priors[0]) for d, g in enumerate(gained, 1))]
    scored = summed.select(*names, "tokens", F.array(*scores).alias("scores"))
    raised = scored.withColumn("raised", F.transform("scores", lambda s: F.exp(s - F.array_max("scores"))))
    total = F.aggregate("raised", F.lit(0.0), lambda a, b: a + b)
    return raised.select(*names, "tokens", F.transform("raised", lambda s: s / total).alias("posteriors"))


def _rate(gradients: Sequence[Sequence[float]], domains: int) -> Column:
    """A document's rate after the given projected steps, one fold over its posterior."""
    if not gradients:
        return F.lit(1.0)
    steps = F.lit([[float(x) for x in g] for g in gradients])
    return F.aggregate(
        steps,
        F.lit(1.0),
        lambda rate, g: F.greatest(
            F.lit(0.0), rate - sum((F.col("posteriors")[d] * F.get(g, F.lit(d)) for d in range(domains)), F.lit(0.0))
        ),
    )


def _solve(matrix: list[list[float]], right: list[float]) -> list[float]:
    """Solve a small symmetric system; a little on the diagonal keeps empty domains out of the way."""
    n = len(right)
    ridge = 1e-9 * (sum(matrix[i][i] for i in range(n)) or 1.0)
    rows = [[*matrix[i], right[i]] for i in range(n)]
    for i in range(n):
        rows[i][i] += ridge
    for i in range(n):
        pivot = max(range(i, n), key=lambda r: abs(rows[r][i]))
        rows[i], rows[pivot] = rows[pivot], rows[i]
        for r in range(n):
            if r != i and rows[i][i]:
                share = rows[r][i] / rows[i][i]
                rows[r] = [x - share * y for x, y in zip(rows[r], rows[i], strict=True)]
    return [rows[i][n] / rows[i][i] if rows[i][i] else 0.0 for i in range(n)]


def fit_rates(posteriors: DataFrame, targets: Sequence[float]) -> list[list[float]]:
    """The gradients, each times its step, whose projected steps lead to the fitted rates.

    The fitted totals are ``targets`` x all tokens. Documents whose rate is 0 answer
    no step, so steps are lengthened by what the last one fell short of; a step that
    did not bring the totals closer is followed by one of length 1, which always
    does. Targets outside what the documents' posteriors span cannot be met; the
    closest totals found are then taken.
    """
    domains = len(targets)
    tokens = F.col("tokens").cast("double")
    p = [F.col("posteriors")[d] for d in range(domains)]
    moments = posteriors.agg(
        F.sum(tokens).alias("all"),
        *(F.sum(tokens * p[d] * p[e]).alias(f"g{d}_{e}") for d in range(domains) for e in range(d, domains)),
    ).first()
    everything = moments["all"]
    if not everything:
        return []
    gram = [[moments[f"g{min(d, e)}_{max(d, e)}"] for e in range(domains)] for d in range(domains)]
    wanted = [everything * t / sum(targets) for t in targets]

    def dot(a: Sequence[float], b: Sequence[float]) -> float:
        return sum(x * y for x, y in zip(a, b, strict=True))

    gradients: list[list[float]] = []
    best, closest, step, before = 0, float("inf"), 1.0, None
    for _ in range(ROUNDS):
        rate = _rate(gradients, domains)
        row = posteriors.agg(*(F.sum(rate * tokens * p[d]).alias(f"t{d}") for d in range(domains))).first()
        residual = [row[f"t{d}"] - wanted[d] for d in range(domains)]
        gradient = _solve(gram, residual)
        error = dot(residual, gradient)  # in the metric of the inverse Gram matrix
        if before is not None:
            last, last_gradient, last_error = before
            answered = dot([x - y for x, y in zip(last, residual, strict=True)], last_gradient)
            step = min(LONGEST_STEP, max(1.0, step * last_error / answered)) if error <= last_error and answered > 0 else 1.0
        if error < closest:
            best, closest = len(gradients), error
        if max(abs(x) for x in residual) <= CLOSE_ENOUGH * everything:
            break
        gradients.append([step * g for g in gradient])
        before = residual, gradient, error
    return gradients[:best]


def fitted(rows: DataFrame, labels: DataFrame, targets: Sequence[float]) -> DataFrame:
    """(number, doc_id, tokens, posteriors, rate) of numbered rows, staged once before the rates are fitted."""
    weights, priors = word_weights(rows, labels, len(targets))
    known = stage(with_posteriors(rows, weights, priors), "posteriors")
    return known.withColumn("rate", _rate(fit_rates(known, targets), len(targets)))


def mixed(docs: DataFrame, labels: DataFrame, targets: Sequence[float] = TARGETS) -> DataFrame:
    """``docs`` with ``tokens``, ``posteriors`` (per domain) and ``rate``.

    Every row gets a rate, also one without text (no tokens, posterior = prior).
    Columns of these names replace equally named ones of ``docs``. An empty
    table gives an empty one.
    """
    kept = [F.col(f"row.{c}").alias(c) for c in docs.columns if c not in ("tokens", "posteriors", "rate")]
    rows = stage(numbered(docs, F.struct(*docs.columns).alias("row")), "rows")
    known = fitted(rows.select("number", "row.doc_id", "row.text"), labels, targets).drop("doc_id")
    # One row for every document: this side grows as the other one does and is never broadcast.
    return rows.join(known.hint("merge"), "number").select(*kept, "tokens", "posteriors", "rate")


def rates(docs: DataFrame, labels: DataFrame, targets: Sequence[float] = TARGETS) -> DataFrame:
    """doc_id, tokens, a posterior per domain, rate."""
    rows = numbered(docs, F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return fitted(rows, labels, targets).select(
        "doc_id", "tokens", *(F.col("posteriors")[i].alias(f"p_{d}") for i, d in enumerate(DOMAINS)), "rate"
    )
