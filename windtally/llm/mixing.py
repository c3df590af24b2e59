"""Mixing sources to target weights by soft membership.

A classifier fitted on the labelled table predicts every document's domain
posteriors.  Nonnegative document rates r then minimise

    1/2 * sum_k (sum_i w_i p_ik r_i - target_k)**2,   w_i = tokens_i / all tokens

by projected gradient steps from r = 1.  All rates see the same K domain
residuals g, whitened by the K x K second moment M of the rows whose rate is
not zero, so that rare domains and soft posteriors do not slow the descent:

    r = max(0, 1 - p . u),   u = sum over rounds of step * M^-1 (g - RIDGE * u)

These are Newton steps on the dual, so among all rates that meet the targets
the ones closest to 1 are found.  A round is one scan of the stored posteriors
at several step lengths; it returns K + K*K + 1 sums for each, and the best
length is taken.  A document's rate is a function of its posteriors and u, so
no per-document state is written between rounds.

Rounds end when every domain's share is within ``TOLERANCE`` of its target, or
when no step comes nearer: then the targets cannot be met (a domain without
documents, say), the rates are the nearest ones, and a warning is logged.  The
residuals are logged in any case.

Domains: toxic (toxic = 1), else good (quality = 1), else poor.

Defined results: null counts as empty text (no tokens, rate as its posteriors
say); labels with nulls in a needed column are not learned from; a domain
without labelled rows has posterior zero; without any usable label all
documents are of the first domain; repeated rows are returned each; of a
labelled id's several texts the one with the least hash is learned from; an empty
table gives no rows.  Only doc_id and text are read.
"""

from __future__ import annotations

import logging

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, table
from .textvec import BUCKETS, design, fit_softmax, profile, scores, softmax
from .weak_quality import _clean, _features, least_rows, sampled_rows

DOMAINS = ("good", "poor", "toxic")
#: Target shares of tokens.
TARGETS = (0.86, 0.10, 0.04)
#: Labelled documents the classifier is fitted on.
SAMPLE = 4000
#: The residual at which rounds end, and the gradient at which targets are out of reach.
TOLERANCE, STILL = 1e-4, 1e-6
#: Weight of the distance from rate 1, beside the residuals.
RIDGE = 1e-8
#: Step lengths tried in a round.
LENGTHS = 0.25 ** np.arange(16)

log = logging.getLogger(__name__)


def domain_labels(labels: DataFrame) -> DataFrame:
    known = labels.where("doc_id is not null and quality is not null and toxic is not null")
    domain = F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 1, 0).otherwise(1)
    return known.select("doc_id", domain.alias("domain")).groupBy("doc_id").agg(F.min("domain").alias("domain"))


def train(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """Classifier weights (features, domains)."""
    known = domain_labels(labels)
    # the sample is chosen among ids, so that only its texts are shuffled
    ids = sampled_rows(docs.select("doc_id").join(known, "doc_id"), SAMPLE).select("doc_id", "domain")
    texts = least_rows(docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(ids), "doc_id"))
    sample = (texts.select("doc_id", "domain", _features(F.col("text")).alias("f")).select("doc_id", "domain", "f.*").orderBy(F.xxhash64("doc_id"), "doc_id").toPandas())  # at most SAMPLE rows
    weights = np.zeros((BUCKETS + 9, len(DOMAINS)), np.float32)
    if not len(sample):
        weights[BUCKETS, 0] = 60
        return weights
    seen = np.unpackbits(np.stack([np.frombuffer(s, np.uint8) for s in sample["seen"]]), axis=1).astype(bool)
    y = np.eye(len(DOMAINS))[sample["domain"].to_numpy(int)]
    weights = fit_softmax(design(np.stack(sample["stats"]), seen), y)
    weights[:, y.sum(axis=0) == 0] = 0
    weights[BUCKETS, y.sum(axis=0) == 0] = -60
    return weights


def rates(p: np.ndarray, history: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Rates after the rounds whose directions are ``history`` (rounds, K), ``step`` (rounds) their lengths."""
    return np.maximum(0.0, 1.0 - p @ (step @ history))


def scan(posteriors: DataFrame, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """At each of ``points`` (S, K): half the mean squared rate (S), the domains'
    tokens (S, K) and the second moment of rows with a rate (S, K, K), each as a
    share of all tokens; and all tokens."""
    s, k = points.shape

    def add(batches):
        squares, m, second, total = np.zeros(s), np.zeros((s, k)), np.zeros((s, k * k)), 0.0
        for b in batches:
            if len(b):
                p, w = np.stack(b["p"]), b["tokens"].to_numpy(float)
                r = np.maximum(0.0, 1.0 - p @ points.T)
                squares += w @ r ** 2 / 2
                m += (r * w[:, None]).T @ p
                second += ((r > 0) * w[:, None]).T @ (p[:, :, None] * p[:, None, :]).reshape(len(p), k * k)
                total += w.sum()
        yield pd.DataFrame({"v": [[*squares, *m.ravel(), *second.ravel(), total]]})

    got = np.zeros(s * (1 + k + k * k) + 1)
    sums = posteriors.mapInPandas(add, "v array<double>").select(F.posexplode("v")).groupBy("pos").agg(F.sum("col"))
    for at, x in sums.collect():  # a few hundred rows
        got[at] = x
    total, got = got[-1], got[:-1] / max(got[-1], 1.0)
    return got[:s], got[s:s + s * k].reshape(s, k), got[s + s * k:].reshape(s, k, k), total


def solve(posteriors: DataFrame, targets=TARGETS) -> tuple[np.ndarray, np.ndarray]:
    """``posteriors(tokens, p)`` -> directions and step lengths of the rounds, for ``rates``."""
    target = np.asarray(targets, float)
    k = len(target)
    history, step, u = np.zeros((0, k)), np.zeros(0), np.zeros(k)

    def look(points):
        squares, m, second, total = scan(posteriors, points)
        values = squares + points @ target + RIDGE / 2 * (points ** 2).sum(axis=1)
        best = values.argmin()
        return best, values[best], m[best], second[best], total

    _, value, m, second, total = look(u[None, :])
    if total == 0:
        return history, step
    while True:
        g = m - target
        gradient = g - RIDGE * u
        if np.abs(g).max() < TOLERANCE or np.abs(gradient).max() < STILL:
            break
        direction = np.linalg.solve(second + RIDGE * np.eye(k), gradient)
        best, lower, m_next, second_next, _ = look(u + LENGTHS[:, None] * direction)
        if not lower < value:
            break
        value, m, second = lower, m_next, second_next
        history, step = np.vstack([history, direction]), np.append(step, LENGTHS[best])
        u = step @ history
    met = np.abs(g).max() < TOLERANCE
    log.log(logging.INFO if met else logging.WARNING, "token shares %s for targets %s%s after %d rounds, residuals %s",
            m.round(6).tolist(), target.tolist(), "" if met else ", which are out of reach,", len(step), g.tolist())
    return history, step


def posterior_table(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    @F.pandas_udf("tokens long, p array<double>")
    def predict(texts: pd.Series) -> pd.DataFrame:
        f = profile(_clean(texts))
        return pd.DataFrame({"tokens": f.stats[:, 0].astype(int), "p": list(softmax(scores(f, weights).astype(float)))})

    return (docs.select("doc_id", predict(F.col("text").cast("string")).alias("f")).select("doc_id", "f.tokens", "f.p"))


def copies(rate, doc_id, tokens):
    """How often a document is taken: the rate, its fraction decided by a hash of the id."""
    unit = (F.pmod(F.xxhash64(doc_id, tokens, F.lit("mix")), F.lit(1 << 30)) / F.lit(float(1 << 30)))
    return F.floor(rate + unit).cast("int")


def _rate_udf(history: np.ndarray, step: np.ndarray):
    @F.pandas_udf("double")
    def rate(p: pd.Series) -> pd.Series:
        return pd.Series(rates(np.stack(p), history, step)) if len(p) else pd.Series([], dtype=float)
    return rate


def mixing_rates(docs: DataFrame, labels: DataFrame, targets=TARGETS) -> DataFrame:
    """``(doc_id, tokens, p_<domain>..., rate, copies)``, one row per row of ``docs``."""
    found = stored(posterior_table(docs, train(docs, labels)), "posteriors")
    rate = _rate_udf(*solve(found, targets))
    return (found.withColumn("rate", rate("p"))
            .select("doc_id", "tokens", *(F.col("p")[k].alias(f"p_{d}") for k, d in enumerate(DOMAINS)), "rate",
                    copies(F.col("rate"), F.col("doc_id"), F.col("tokens")).alias("copies")))


def mixed(docs: DataFrame, labels: DataFrame, targets=TARGETS) -> DataFrame:
    """Rows of ``docs``, all columns, each as often as its rate says."""
    weights = train(docs, labels)
    history, step = solve(stored(posterior_table(docs, weights), "posteriors"), targets)

    @F.pandas_udf("tokens long, rate double")
    def judge(texts: pd.Series) -> pd.DataFrame:
        f = profile(_clean(texts))
        p = softmax(scores(f, weights).astype(float))
        return pd.DataFrame({"tokens": f.stats[:, 0].astype(int), "rate": rates(p, history, step)})

    keep = [docs[c] for c in docs.columns]
    judged = docs.select(*keep, judge(docs["text"].cast("string")).alias("_mix_judged"))
    times = copies(F.col("_mix_judged.rate"), F.col("doc_id"), F.col("_mix_judged.tokens"))
    return judged.withColumn("_mix_copy", F.explode(F.array_repeat(F.lit(0), times))).drop("_mix_judged", "_mix_copy")


def op2_soft_mixing(spark, sf_dir: str) -> DataFrame:
    return mixing_rates(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
