"""Mixing sources to target weights with soft membership.

A classifier, trained on the labelled table, gives every document a posterior
over domains. Each document then gets a nonnegative rate; with w its rate, n its
tokens and p its posterior, the expected tokens of a domain are sum(w * n * p).
The rates start at one and projected-gradient steps on the least squares
distance to the target totals move them until the totals fit.

Only DataFrame operations run. Documents whose posteriors agree to a hundredth
share a rate, so they are added up first, and a step is one aggregate over
these cells; the driver sees one total a domain.

Null and empty texts have no tokens; their posterior is the classifier's prior
and their rate follows from it. Labels with a null in quality or toxic, and
unlabelled documents, train nothing. Without two labelled domains every
document belongs to the first domain. Repeated rows are weighed one by one. An
empty table gives no rows. Extra columns are ignored by ``document_rates`` and
kept by ``mixed``, whatever their names.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalograph.llm.support import let, text_column, unused, written

# Domains of the labelled table, and the share of tokens each shall have.
TARGETS = {"good": 0.90, "toxic": 0.04, "low": 0.06}
BUCKETS = 1 << 12
# The classifier is fitted on at most so many labelled documents, chosen by hash.
MAX_LABELLED = 8_000
GRID = 100
STEPS = 200
CLOSE = 1e-6


def domain_of(labels: DataFrame) -> Column:
    """``toxic`` before ``low`` before ``good``; null if a label is missing."""
    whole = F.col("quality").isNotNull() & F.col("toxic").isNotNull()
    return F.when(whole & (F.col("toxic") != 0), "toxic").when(whole & (F.col("quality") == 0), "low").when(whole, "good")


def words_of(text: Column) -> Column:
    """Lower-case runs of letters, and every other run of signs as one word."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+|[^\p{L}\s]+"), 0)


def n_tokens(text: Column) -> Column:
    """Words between white space."""
    return F.call_function("regexp_count", F.coalesce(text, F.lit("")), F.lit(r"\S+")).cast("long")


def fit_classifier(documents: DataFrame, labels: DataFrame, domains: list[str], limit: int = MAX_LABELLED):
    """Multinomial logistic regression on hashed words of a bounded labelled sample; null if it has one domain.

    The sample's ids are at most ``limit`` (8 bytes each), hence the broadcast;
    the text is then read once and only the sample's rows go on.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import HashingTF, Normalizer

    number = F.create_map(*[F.lit(v) for i, name in enumerate(domains) for v in (name, float(i))])
    ids = (labels.select(F.col("doc_id").cast("long").alias("__id"), F.element_at(number, domain_of(labels)).alias("label"))
           .where("__id IS NOT NULL AND label IS NOT NULL").groupBy("__id").agg(F.min("label").alias("label"))
           .orderBy(F.xxhash64("__id"), "__id").limit(limit))
    sample = written(documents.select("doc_id", text_column(documents).alias("text"))
                     .join(F.broadcast(ids), F.col("doc_id") == F.col("__id"))
                     .select("label", words_of(F.col("text")).alias("words")), "labelled")
    seen = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if len(seen) < 2:
        return None
    # rare domains weigh as much as the square root of their share asks for
    weight = F.create_map(*[F.lit(v) for k, c in seen.items() for v in (k, (max(seen.values()) / c) ** 0.5)])
    # domains without a row keep their number: the classifier needs the largest label to be seen
    return Pipeline(stages=[
        HashingTF(numFeatures=BUCKETS, inputCol="words", outputCol="tf"), Normalizer(p=2.0, inputCol="tf", outputCol="features"),
        LogisticRegression(maxIter=30, regParam=1e-4, family="multinomial", weightCol="weight"),
    ]).fit(sample.withColumn("weight", F.element_at(weight, F.col("label"))))


def posterior_grid(text: Column, frame: DataFrame, model, n_domains: int, name: str) -> DataFrame:
    """``frame`` with ``name``: the posterior of each domain in hundredths, which add up to one hundred."""
    if model is None:
        return frame.withColumn(name, F.array(*[F.lit(GRID if k == 0 else 0) for k in range(n_domains)]))
    from pyspark.ml.functions import vector_to_array

    kept = frame.columns
    words, back = unused(frame, "__words"), {}
    inputs = frame.withColumn(words, words_of(F.coalesce(text, F.lit(""))))
    tf, norm, logistic = (s.copy() for s in model.stages)
    for stage, put in ((tf, "__tf"), (norm, "__features")):
        back[put] = unused(frame, put)
        stage.setOutputCol(back[put])
    tf.setInputCol(words)
    norm.setInputCol(back["__tf"])
    logistic.setFeaturesCol(back["__features"]).setProbabilityCol(unused(frame, "__p")).setRawPredictionCol("").setPredictionCol("")
    scored = logistic.transform(norm.transform(tf.transform(inputs)))
    p = vector_to_array(F.col(unused(frame, "__p")))
    parts = F.concat(F.transform(p, lambda x: F.round(x * GRID).cast("int")),
                     F.array_repeat(F.lit(0), F.lit(n_domains) - F.lit(logistic.numClasses)))

    def whole(own: Column) -> Column:
        # the largest domain takes what rounding leaves; classifier and domains have the same order
        rest = GRID - F.aggregate(own, F.lit(0), lambda s, x: s + x)
        largest = F.array_position(own, F.array_max(own)).cast("int") - 1
        return F.transform(own, lambda x, i: x + F.when(i == largest, rest).otherwise(0))

    return scored.withColumn(name, let(parts, whole)).select(*kept, name)


def rate_of(posterior: Column, steps: list[np.ndarray]) -> Column:
    """The rate after the given steps: from one, less each step's share for this posterior, never below zero."""
    if not steps:
        return F.lit(1.0)
    moves = F.array(*[F.array(*[F.lit(float(x) / GRID) for x in step]) for step in steps])
    return F.aggregate(moves, F.lit(1.0), lambda w, step: F.greatest(F.lit(0.0), w - F.aggregate(
        F.zip_with(posterior, step, lambda p, s: p * s), F.lit(0.0), lambda a, b: a + b)))


def solve(cells: DataFrame, targets: list[float], steps_at_most: int = STEPS) -> list[np.ndarray]:
    """Projected-gradient steps that bring the expected domain totals to their shares of all tokens.

    ``cells``: posterior (in hundredths) and tokens. The distance is measured
    in the domains' own scale (their overlap matrix), where a step of one is safe.
    """
    n = len(targets)
    p = [F.element_at("posterior", k + 1) / GRID for k in range(n)]
    overlap = cells.agg(F.sum("tokens").alias("all"), *[
        F.sum(F.col("tokens") * p[i] * p[j]).alias(f"g{i}_{j}") for i in range(n) for j in range(n)]).first()
    total = overlap["all"] or 0
    if not total:
        return []
    gram = np.array([[overlap[f"g{i}_{j}"] for j in range(n)] for i in range(n)], float) / total
    inverse = np.linalg.pinv(gram, rcond=1e-9)
    wish, steps = np.array(targets), []
    for _ in range(steps_at_most):
        w = rate_of(F.col("posterior"), steps)
        # a domain nobody belongs to cannot be filled: its target is left out by the pseudo-inverse
        now = cells.select("tokens", "posterior", w.alias("w")).agg(*[
            F.sum(F.col("tokens") * F.col("w") * p[k]).alias(f"t{k}") for k in range(n)]).first()
        step = inverse @ (np.array([now[k] for k in range(n)], float) / total - wish)
        if np.abs(gram @ step).max() < CLOSE:
            break
        steps.append(step)
    return steps


def _fitted(documents: DataFrame, labels: DataFrame, targets: dict[str, float]):
    """(classifier, steps, narrow table of doc_id, tokens and posterior)."""
    domains = list(targets)
    model = fit_classifier(documents, labels, domains)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    narrow = written(posterior_grid(F.col("text"), rows.withColumn("tokens", n_tokens(F.col("text"))), model, len(domains),
                                    "posterior").select("doc_id", "tokens", "posterior"), "posteriors")
    cells = written(narrow.groupBy("posterior").agg(F.sum("tokens").alias("tokens")), "cells")
    return model, solve(cells, [targets[d] for d in domains]), narrow


def copies_of(rate: Column, key: Column) -> Column:
    """A rate as a whole number: its floor, and one more for a share of ids that hashing fixes."""
    part = F.pmod(F.xxhash64(key), F.lit(1 << 30)) / float(1 << 30)
    return let(rate, lambda r: (F.floor(r) + F.when(part < r - F.floor(r), 1).otherwise(0)).cast("int"))


def document_rates(documents: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """doc_id, n_tokens, one posterior for each domain, rate and copies of every document."""
    targets = targets or TARGETS
    _, steps, narrow = _fitted(documents, labels, targets)
    return (narrow.withColumn("rate", rate_of(F.col("posterior"), steps)).select(
        "doc_id", F.col("tokens").alias("n_tokens"),
        *[(F.element_at("posterior", k + 1) / GRID).alias(f"p_{d}") for k, d in enumerate(targets)],
        F.round("rate", 9).alias("rate"), copies_of(F.round("rate", 9), F.col("doc_id")).alias("copies")))


def mixed(documents: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """``documents`` with each row as often as its rate says; columns stay.

    The rate follows from the row itself and the steps, so nothing is joined.
    """
    targets = targets or TARGETS
    model, steps, _ = _fitted(documents, labels, targets)
    posterior, copy = unused(documents, "__posterior"), unused(documents, "__copy")
    rated = posterior_grid(F.col("text").cast("string"), documents, model, len(targets), posterior)
    times = copies_of(F.round(rate_of(F.col(posterior), steps), 9), F.col("doc_id"))
    return rated.withColumn(copy, F.explode(F.array_repeat(F.lit(1), times))).select(documents.columns)
