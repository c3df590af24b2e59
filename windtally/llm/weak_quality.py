"""Quality classifier from weak labels.

Eight heuristic labellers vote good, bad or abstain on every whole text.
Expectation-maximisation over the counts of vote patterns (at most 3**8 rows,
so it sees all documents yet runs on a small table) estimates each labeller's
accuracies and the share of good documents, without any labelled row.  The
posteriors are the labels of a hashed linear scorer, fitted on a bounded
sample (``SAMPLE`` documents in order of a hash) and applied to every text.

Defined results: null counts as empty (the length labeller calls it bad);
repeated rows are returned each; null doc_ids keep their row but are not
sampled; of a sampled id's several texts the one with the least hash is learned
from; an empty table gives no rows.  Only doc_id and text are read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table
from .textvec import BUCKETS, Profile, design, fit_softmax, profile, scores, softmax

LABELLERS = ("length", "word_size", "repeats", "marks", "digits", "capitals", "letters", "variety")
#: Words in which the variety labeller counts distinct ones, one run after the other; a longer text is judged by the mean of its runs.
RUN = 2000
#: Documents the scorer is fitted on.
SAMPLE = 4000
#: Documents of a lower score are not kept.
THRESHOLD = 0.3


def votes(p: Profile) -> np.ndarray:
    """(documents, labellers): 1 good, -1 bad, 0 abstain.  ``p`` is profiled with ``RUN``."""
    words, size, letters, digits, marks, _, again, upper = p.stats.T
    w, b = np.maximum(words, 1), np.maximum(size, 1)
    distinct = p.distinct / w
    mean = size / w

    def vote(good, bad):
        return np.where(bad, -1, np.where(good, 1, 0))

    return np.stack([
        vote(words >= 40, words < 12),
        vote((mean > 4) & (mean < 12), (mean < 2.5) | (mean > 20)),
        vote(again / w < 0.02, again / w > 0.2),
        vote(marks / b < 0.06, marks / b > 0.15),
        vote(digits / b < 0.03, digits / b > 0.15),
        vote((upper / b > 0.004) & (upper / b < 0.08), upper / b > 0.3),
        vote(letters / b > 0.72, letters / b < 0.55),
        vote(distinct > 0.45, distinct < 0.25),
    ], axis=1)


def pattern(v: np.ndarray) -> np.ndarray:
    return ((v + 1) * 3 ** np.arange(v.shape[1])).sum(axis=1)


def estimate(patterns: np.ndarray, counts: np.ndarray, n: int = len(LABELLERS), rounds: int = 200) -> tuple[np.ndarray, np.ndarray, float]:
    """EM over vote patterns -> posterior of good for every possible pattern,
    accuracies (labeller, class, vote) and the share of good."""
    every = (np.arange(3 ** n)[:, None] // 3 ** np.arange(n)) % 3
    weight = np.zeros(3 ** n)
    weight[patterns] = counts
    used = weight > 0
    v, c = every[used], weight[used]
    accuracy = np.empty((n, 2, 3))  # class 0 bad, 1 good; vote 0 bad, 1 abstain, 2 good
    accuracy[:, 0], accuracy[:, 1] = (0.5, 0.3, 0.2), (0.2, 0.3, 0.5)
    good = 0.5
    pick = np.arange(n)[None, :]

    def posterior(v):
        odds = np.log(good) - np.log(1 - good) + (np.log(accuracy[pick, 1, v]) - np.log(accuracy[pick, 0, v])).sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(odds, -60, 60)))

    for _ in range(rounds if len(c) else 0):
        p = posterior(v)
        for cls, share in ((0, 1 - p), (1, p)):
            for k in range(3):
                accuracy[:, cls, k] = ((c * share)[:, None] * (v == k)).sum(axis=0) + 1
            accuracy[:, cls] /= accuracy[:, cls].sum(axis=1, keepdims=True)
        good = float(np.clip((c * p).sum() / c.sum(), 0.01, 0.99))
    return posterior(every), accuracy, good


def _clean(s: pd.Series) -> list:
    return s.where(s.notna(), None).tolist()


@F.pandas_udf(T.IntegerType())
def _pattern(texts: pd.Series) -> pd.Series:
    return pd.Series(pattern(votes(profile(_clean(texts), run=RUN))))


# types, not DDL text: this module is imported before there is a session
@F.pandas_udf(T.StructType([T.StructField("pattern", T.IntegerType()), T.StructField("stats", T.ArrayType(T.DoubleType())),
                            T.StructField("seen", T.BinaryType())]))
def _features(texts: pd.Series) -> pd.DataFrame:
    p = profile(_clean(texts), run=RUN)
    return pd.DataFrame({"pattern": pattern(votes(p)), "stats": list(p.stats), "seen": [r.tobytes() for r in np.packbits(p.seen, axis=1)]})


def least_rows(rows: DataFrame) -> DataFrame:
    """One row of each doc_id, however the rows are dealt out: the least by a hash of its other columns."""
    others = [c for c in rows.columns if c != "doc_id"]
    return rows.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64(*others).alias("_hash"), *others)).alias("_row")).select(
        "doc_id", *(F.col("_row")[c].alias(c) for c in others))


def sampled_rows(rows: DataFrame, n: int) -> DataFrame:
    """At most ``n`` rows of distinct doc_ids, the least by a hash of the id; of
    several rows of an id the least by a hash of its other columns."""
    ids = rows.where("doc_id is not null").select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    return least_rows(rows.join(F.broadcast(ids), "doc_id", "left_semi"))  # at most n ids


def train(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Posterior by vote pattern, and the scorer's weights."""
    text = F.col("text").cast("string")
    found = docs.select(_pattern(text).alias("p")).groupBy("p").count().toPandas()  # at most 3**8 rows
    posterior, _, _ = estimate(found["p"].to_numpy(int), found["count"].to_numpy(float))
    ids = docs.select("doc_id", text.alias("text"))
    sample = sampled_rows(ids, SAMPLE).select("doc_id", _features(F.col("text")).alias("f")).select("doc_id", "f.*").orderBy(F.xxhash64("doc_id"), "doc_id").toPandas()
    if not len(sample):
        return posterior, np.zeros((BUCKETS + 9, 2), np.float32)
    seen = np.unpackbits(np.stack([np.frombuffer(s, np.uint8) for s in sample["seen"]]), axis=1).astype(bool)
    p = posterior[sample["pattern"].to_numpy(int)]
    return posterior, fit_softmax(design(np.stack(sample["stats"]), seen), np.stack([1 - p, p], axis=1))


def quality(docs: DataFrame) -> DataFrame:
    """``(doc_id, votes, posterior, score, keep)``, one row per row of ``docs``.
    ``votes`` has +, - or 0 for each of LABELLERS."""
    posterior, weights = train(docs)

    @F.pandas_udf("votes string, posterior double, score double")
    def judge(texts: pd.Series) -> pd.DataFrame:
        p = profile(_clean(texts), run=RUN)
        v = votes(p)
        return pd.DataFrame({"votes": ["".join("-0+"[x + 1] for x in r) for r in v], "posterior": posterior[pattern(v)],
                             "score": softmax(scores(p, weights).astype(float))[:, 1]})

    return (docs.select("doc_id", judge(F.col("text").cast("string")).alias("j")).select("doc_id", "j.*")
            .withColumn("keep", F.col("score") >= THRESHOLD))


def op3_weak_quality(spark, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"))
