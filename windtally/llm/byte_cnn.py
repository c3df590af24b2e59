"""Language ID by a byte convolutional network, trained in numpy.

Text bytes are cut into windows of ``WINDOW`` bytes (the last one padded); a
window goes through a byte embedding, filters of several widths, rectifier,
max pooling and softmax.  A text's language is the one with the highest mean
probability over all of its windows, and that mean is the score.

Training: every language is learned, from a bounded sample: all languages share
``SAMPLE_DOCS`` documents evenly, each with ``DOCS_PER_LANG`` at most and one at least (in
order of a hash of doc_id), and ``WINDOWS_PER_DOC`` evenly spaced windows of
each; everything else is predicted on whole texts, in batches of
``BATCH`` windows whatever a text's length.

Defined results: ``und`` with score 0 if the text is null or has no letter, or
if there was nothing to learn from; a null doc_id is not held out and never a
training row; null languages are not learned; repeated rows are predicted
each; an empty table gives no rows.  Only text is an input of a prediction.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import table

WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBED = 8
BATCH = 1024
DOCS_PER_LANG = 600
#: Documents of the whole training sample, unless there are more languages than that.
SAMPLE_DOCS = 24_000
#: Ids of a language that are ranked for the sample, as a multiple of its share, and the resolution of the hash that thins them.
THIN = 4
UNIT = 1 << 40
WINDOWS_PER_DOC = 6
EPOCHS = 5
UNKNOWN = "und"
#: ``keep_known`` rejects scores that are less than this share of the way from an even guess to certainty.
SURE = 2 / 15


def has_letter(text: str) -> bool:
    """Letters in Unicode's sense; numerals such as fractions are none."""
    return any(map(str.isalpha, text))


def windows_of(data: bytes) -> np.ndarray:
    """(n, WINDOW) uint8: the whole text, padded with zero bytes."""
    n = max(1, -(-len(data) // WINDOW))
    out = np.zeros(n * WINDOW, np.uint8)
    out[: len(data)] = np.frombuffer(data, np.uint8)
    return out.reshape(n, WINDOW)


class Net:
    """Parameters are a dict of float32 arrays, small enough to travel with a task."""

    def __init__(self, langs: list[str], seed: int = 7):
        r = np.random.default_rng(seed)
        self.langs = langs
        self.p = {"e": r.normal(0, 0.5, (256, EMBED)), "v": r.normal(0, 0.2, (FILTERS * len(WIDTHS), len(langs))), "c": np.zeros(len(langs))}
        for w in WIDTHS:
            self.p[f"k{w}"] = r.normal(0, (2 / (w * EMBED)) ** 0.5, (w * EMBED, FILTERS))
            self.p[f"b{w}"] = np.zeros(FILTERS)
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def hidden(self, x: np.ndarray, keep: bool = False):
        n, length = x.shape
        e = self.p["e"][x]
        pooled, kept = [], []
        for w in WIDTHS:
            at = length - w + 1
            cols = np.concatenate([e[:, j:j + at] for j in range(w)], axis=2).reshape(n * at, w * EMBED)
            act = (cols @ self.p[f"k{w}"]).reshape(n, at, FILTERS)
            if keep:
                top = act.argmax(axis=1)
                kept.append((cols.reshape(n, at, -1), top))
            pooled.append(np.maximum(act.max(axis=1) + self.p[f"b{w}"], 0))
        return np.concatenate(pooled, axis=1), kept

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        z = self.hidden(x)[0] @ self.p["v"] + self.p["c"]
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        h, kept = self.hidden(x, keep=True)
        z = h @ self.p["v"] + self.p["c"]
        z = np.exp(z - z.max(axis=1, keepdims=True))
        d = z / z.sum(axis=1, keepdims=True)
        d[np.arange(len(y)), y] -= 1
        d /= len(y)
        g = {"v": h.T @ d, "c": d.sum(axis=0), "e": np.zeros_like(self.p["e"])}
        dh = (d @ self.p["v"].T) * (h > 0)
        rows = np.arange(len(y))[:, None]
        for i, w in enumerate(WIDTHS):
            cols, top = kept[i]
            part = dh[:, i * FILTERS:(i + 1) * FILTERS]
            best = cols[rows, top]  # (n, filters, w * EMBED): the window each filter picked
            g[f"k{w}"] = np.einsum("nf,nfd->df", part, best)
            g[f"b{w}"] = part.sum(axis=0)
            de = (part[:, :, None] * self.p[f"k{w}"].T[None]).reshape(len(y), FILTERS, w, EMBED)
            for j in range(w):
                np.add.at(g["e"], x[rows, top + j], de[:, :, j])
        return g

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, rate: float = 0.01, seed: int = 7) -> "Net":
        r = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        for _ in range(epochs):
            order = r.permutation(len(y))
            for lo in range(0, len(order), 128):
                step += 1
                for k, g in self.gradients(x[order[lo:lo + 128]], y[order[lo:lo + 128]]).items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    s[k] = 0.99 * s[k] + 0.01 * g * g
                    self.p[k] -= (rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(s[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
        return self

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        total = np.zeros((len(texts), len(self.langs)))
        count = np.zeros(len(texts))
        held, owner, size = [], [], 0

        def flush():
            if held:
                x, o = np.concatenate(held), np.concatenate(owner)
                for lo in range(0, len(x), BATCH):
                    np.add.at(total, o[lo:lo + BATCH], self.probabilities(x[lo:lo + BATCH]))
                np.add.at(count, o, 1)
            held.clear()
            owner.clear()

        for i, t in enumerate(texts):
            if t is None or not self.langs or not has_letter(t):
                continue
            w = windows_of(t.encode("utf-8", "replace"))
            held.append(w)
            owner.append(np.full(len(w), i))
            size += len(w)
            if size >= BATCH:
                flush()
                size = 0
        flush()
        langs, scores = [], []
        for i in range(len(texts)):
            if count[i]:
                k = int(total[i].argmax())
                langs.append(self.langs[k])
                scores.append(float(min(1.0, total[i, k] / count[i])))
            else:
                langs.append(UNKNOWN)
                scores.append(0.0)
        return langs, scores


def least_score(n_langs: int) -> float:
    """The rejection threshold: it falls as an even guess does with the number of languages (0.35 for four)."""
    even = 1 / max(1, n_langs)
    return even + SURE * (1 - even) - 1e-6


def held_out() -> Column:
    return F.coalesce(F.pmod(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")), F.lit(4)) == 2, F.lit(False))


def training_windows(docs: DataFrame) -> pd.DataFrame:
    """Columns lang, windows (bytes) of the bounded training sample."""
    rows = docs.where(~held_out() & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    found = rows.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("ids")).collect()
    share = max(1, min(DOCS_PER_LANG, SAMPLE_DOCS // max(1, len(found))))
    # a language's ids are first thinned by hash to a few times the bound, so that none sends more than that to the ranking
    shares = docs.sparkSession.createDataFrame([(r.lang, -(-THIN * share * UNIT // r.ids)) for r in found], "lang string, below long")
    nth = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = (rows.join(F.broadcast(shares), "lang")  # a row for each language, that is for each class of the model
              .where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(UNIT)) < F.col("below")).select("doc_id", "lang").distinct()
              .withColumn("nth", F.row_number().over(nth)).where(F.col("nth") <= share).select("doc_id", "lang"))

    def cut(batches):
        for b in batches:
            out = []
            for t in b["text"]:
                w = windows_of(t.encode("utf-8", "replace"))
                out.append(w[np.unique(np.linspace(0, len(w) - 1, WINDOWS_PER_DOC).astype(int))].tobytes() if has_letter(t) else b"")
            yield pd.DataFrame({"doc_id": b["doc_id"], "lang": b["lang"], "windows": out})

    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = rows.select("doc_id", "lang", "text").join(F.broadcast(chosen), ["doc_id", "lang"], "left_semi")  # at most SAMPLE_DOCS ids, or one for each language
    cuts = texts.mapInPandas(cut, f"doc_id {kind}, lang string, windows binary")
    return cuts.groupBy("doc_id", "lang").agg(F.min("windows").alias("windows")).orderBy("lang", F.xxhash64("doc_id")).select("lang", "windows").toPandas()


def train(docs: DataFrame) -> Net:
    sample = training_windows(docs)
    langs = sorted(sample["lang"].unique())
    x = [np.frombuffer(w, np.uint8).reshape(-1, WINDOW) for w in sample["windows"]]
    y = np.concatenate([np.zeros(0, int), *(np.full(len(w), langs.index(lang)) for w, lang in zip(x, sample["lang"]))])
    return Net(langs).fit(np.concatenate([np.zeros((0, WINDOW), np.uint8), *x]), y)


def predictor(net: Net):
    @F.pandas_udf("lang string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        langs, scores = net.predict(texts.where(texts.notna(), None).tolist())
        return pd.DataFrame({"lang": langs, "score": scores})
    return predict


def identify(docs: DataFrame, net: Net | None = None) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)``, one row per row of ``docs``."""
    predict = predictor(net or train(docs))
    return (docs.select("doc_id", held_out().alias("held_out"), predict(F.col("text").cast("string")).alias("p"))
            .select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score")))


def keep_known(docs: DataFrame, net: Net | None = None) -> DataFrame:
    """Rows of ``docs``, all columns, whose language is known with at least ``least_score``.
    Rows whose text is null or has no letter are not known."""
    net = net or train(docs)
    predict = predictor(net)
    return docs.where(predict(F.col("text").cast("string"))["score"] >= least_score(len(net.langs)))


def op10_byte_cnn_language(spark, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
