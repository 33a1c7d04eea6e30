"""Quality classifier by positive-unlabelled learning.

Trusted positives P and the unlabelled corpus U (every training document, a mixture with share ``prior`` of positives)
give the unbiased risk  prior E_P[l(g)] + max(0, E_U[l(-g)] - prior E_P[l(-g)])  with the logistic loss; the second term,
a risk of negatives, must not turn negative. Labelled negatives never enter the risk; they only serve the estimate of
the prior. The model is linear in bounded text statistics and their hinges, so that the minimum is found by
a few Newton steps. Each step is one aggregation over all rows: every task adds up its own sums, only sums of
a fixed length are shuffled and read by the driver. The features are written once.

Null and empty texts have the features of the empty text and get a score. Null ids count as fold 0 (held out). Labels
without a value are ignored; a document with contradicting labels counts by the smaller one. Without any training
positive the score is the prior. Repeated rows count as often as they occur. Other columns are ignored or kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from .common import fold, stored

FOLDS = 5
THRESHOLD = 0.3
#: Characters whose share is a feature each.
MARKS = b"!#%&*$|@<>{}[]()=_-/\\\"':;?.,+~^0"
_UPPER, _LOWER, _DIGIT = (np.zeros(256, bool) for _ in range(3))
_UPPER[65:91], _LOWER[97:123], _DIGIT[48:58] = True, True, True
_SPACE = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))
_HIGH = np.arange(256) >= 128
_PUNCT = ~(_UPPER | _LOWER | _DIGIT | _SPACE | _HIGH)
_MARKS = np.frombuffer(MARKS, np.uint8)
BLOCK = 256  # bytes of the pieces whose extremes are features
RUN = 48  # words of the pieces whose repetition is a feature
_LINES = re.compile(rb"\n")


def text_features(text: str | None) -> np.ndarray:
    """Statistics of the whole text: its characters, words, lines, and the most extreme of its pieces."""
    data = (text or "").encode("utf-8", "surrogatepass")
    n = len(data)
    raw = np.frombuffer(data, np.uint8)
    hist = np.bincount(raw, minlength=256)
    share = lambda x, of: float(x) / of if of else 0.0
    letters = hist[_UPPER].sum() + hist[_LOWER].sum() + hist[_HIGH].sum() / 2
    out = [np.log1p(n), share(hist[_UPPER].sum(), letters), share(hist[_DIGIT].sum(), n), share(hist[_PUNCT].sum(), n), share(hist[_SPACE].sum(), n), share(hist[_HIGH].sum(), n)]
    out += [np.log1p(1000.0 * c / n) if n else 0.0 for c in hist[_MARKS]]
    out += [np.log1p(float(c)) for c in (hist[_UPPER].sum(), hist[_PUNCT].sum(), hist[_DIGIT].sum())]
    cuts = np.arange(0, n, BLOCK)
    sizes = np.diff(np.append(cuts, n)) if n else np.ones(1)
    for kind in (_UPPER, _PUNCT, _SPACE, _DIGIT, _HIGH):
        parts = np.add.reduceat(kind[raw], cuts, dtype=np.int64) / np.maximum(sizes, 64) if n else np.zeros(1)
        out += [parts.max(), parts.min()]
    words, m, distinct, repeats, most, alone = data.split(), 0, 0.0, 0.0, 0.0, 1.0
    m = len(words)
    lengths = np.fromiter(map(len, words), np.int64, m)
    if m:
        pieces = [words[i:i + RUN] for i in range(0, m, RUN)]
        kinds = np.array([len(set(p)) / len(p) if len(p) > RUN // 4 else 1.0 for p in pieces])
        alone, distinct = kinds.min(), len(set(words)) / m
        same = np.fromiter(map(bytes.__eq__, words, words[1:]), bool, m - 1)
        repeats, most = same.mean() if m > 1 else 0.0, max(map(len, pieces)) and kinds.mean()
    out += [np.log1p(m), lengths.mean() if m else 0.0, lengths.std() if m else 0.0, float(lengths.max()) ** 0.5 if m else 0.0, distinct, repeats, most, alone]
    lines = [x for x in _LINES.split(data) if x]
    k = len(lines)
    out += [np.log1p(k), share(n, k) ** 0.5, len(set(lines)) / k if k else 1.0, share(sum(x.rstrip().endswith((b".", b"!", b"?", b'"')) for x in lines), k), share(sum(len(x) < 40 for x in lines), k)]
    return np.nan_to_num(np.array(out, np.float32))


WIDTH = len(text_features(""))


def feature_rows(texts: pa.Array) -> np.ndarray:
    """One text at a time becomes a Python object."""
    out = np.empty((len(texts), WIDTH), np.float32)
    for i, t in enumerate(texts):
        out[i] = text_features(t.as_py())
    return out


@F.arrow_udf(ArrayType(FloatType()))
def features(texts: pa.Array) -> pa.Array:
    x = feature_rows(texts)
    return pa.ListArray.from_arrays(np.arange(0, x.size + 1, WIDTH, dtype=np.int32), x.ravel())


def expand(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Standard scores within +-5, their hinges on both sides, and a constant."""
    z = np.clip((x - mean) / scale, -5, 5)
    return np.hstack([z, np.maximum(z - 1, 0), np.maximum(-z - 1, 0), np.ones((len(z), 1))]).astype(np.float64)


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), np.float32).reshape(-1, WIDTH)


def _summed(rows: DataFrame, sums) -> np.ndarray:
    """``sums(x, positive)`` (a vector) added up over all batches."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                s = sums(_matrix(b.column("x")), np.asarray(b.column("positive"), bool))
                total = s if total is None else total + s
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], ["k", "v"])

    got = rows.select("x", "positive").mapInArrow(part, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).toPandas().sort_values("k")
    return got["v"].to_numpy()


class Model:
    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray, prior: float):
        self.mean, self.scale, self.weights, self.prior = mean, scale, weights, prior

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-expand(x, self.mean, self.scale) @ self.weights))


def class_prior(labels: DataFrame) -> float:
    """Share of positives among the labelled rows, which were drawn from the corpus at random; kept off 0 and 1."""
    got = labels.agg(F.sum("label"), F.count("label")).first()
    return ((got[0] or 0) + 1) / (got[1] + 2)


def fit(rows: DataFrame, prior: float, steps: int = 15, ridge: float = 1e-3) -> Model:
    """``rows``: x array<float>, positive boolean; all of them are unlabelled data, the positive ones also trusted positives."""
    moments = _summed(rows, lambda x, p: np.concatenate([[len(x), p.sum()], x.astype(np.float64).sum(0), (x.astype(np.float64) ** 2).sum(0)]))
    if not len(moments) or not moments[1]:
        return Model(np.zeros(WIDTH), np.ones(WIDTH), np.append(np.zeros(3 * WIDTH), np.log(prior / (1 - prior))), prior)
    mean = moments[2:2 + WIDTH] / moments[0]
    scale = np.sqrt(np.maximum(moments[2 + WIDTH:] / moments[0] - mean**2, 0)) + 1e-6
    d = 3 * WIDTH + 1
    upper = np.triu_indices(d)
    w = np.append(np.zeros(d - 1), np.log(prior / (1 - prior)))

    def sums(x: np.ndarray, p: np.ndarray, w: np.ndarray) -> np.ndarray:
        a = expand(x, mean, scale)
        g = a @ w
        s = 1 / (1 + np.exp(-g))
        loss = np.logaddexp(0, g)
        hess = (a * (s * (1 - s))[:, None]).T @ a
        return np.concatenate([[len(a), p.sum(), loss.sum(), loss[p].sum(), g[p].sum()], s @ a, a[p].sum(0), s[p] @ a[p], hess[upper]])

    best, rate = None, 1.0
    for _ in range(steps):
        t = _summed(rows, lambda x, p, w=w: sums(x, p, w))
        nu, np_, lu, lp, gp = t[:5]
        su, ap, sp = t[5:5 + d] / nu, t[5 + d:5 + 2 * d] / np_, t[5 + 2 * d:5 + 3 * d] / np_
        negatives = lu / nu - prior * lp / np_  # risk of negatives
        risk = prior * (lp - gp) / np_ + max(0.0, negatives) + ridge / 2 * w[:-1] @ w[:-1]
        if best and risk > best[0] + 1e-9:
            rate /= 2
            w = best[1] + rate * best[2]
            if rate < 1e-2:
                break
            continue
        hess = np.zeros((d, d))
        hess[upper] = t[5 + 3 * d:] / nu
        hess = hess + np.triu(hess, 1).T + ridge * np.eye(d)
        down_p, down_n = prior * (ap - sp), prior * sp - su  # descent of the two terms
        grad = (down_p + down_n if negatives >= 0 else down_p - down_n) - ridge * np.append(w[:-1], 0)
        move = np.linalg.solve(hess, grad)
        move *= min(1.0, 4 / np.abs(move).max())
        rate = min(1.0, 2 * rate)
        if best and best[0] - risk < 1e-5:
            best = (risk, w, move)
            break
        best = (risk, w, move)
        w = w + rate * move
    return Model(mean, scale, best[1], prior)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", prior: float | None = None) -> tuple[Model, DataFrame]:
    """The model and the stored features (row columns doc_id, held_out, x) of all documents."""
    feats = stored(docs.select("doc_id", (fold("doc_id", FOLDS) == 0).alias("held_out"), features("text").alias("x")), "features")
    return train_on(feats, labels, label, prior), feats


def train_on(feats: DataFrame, labels: DataFrame, label: str = "quality", prior: float | None = None) -> Model:
    known = labels.filter(F.col(label).isNotNull() & (fold("doc_id", FOLDS) != 0)).groupBy("doc_id").agg(F.min(label).cast("int").alias("label"))
    rows = feats.filter(~F.col("held_out")).join(known, "doc_id", "left").select("x", F.coalesce(F.col("label") == 1, F.lit(False)).alias("positive"))
    return fit(stored(rows, "rows"), class_prior(known) if prior is None else prior)


def score_features(feats: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score) from stored features."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = model.scores(_matrix(b.column("x"))) if b.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(s)], ["doc_id", "held_out", "score"])

    return feats.mapInArrow(part, feats.select("doc_id", "held_out", F.lit(0.5).alias("score")).schema)


def scores(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    model, feats = train(docs, labels, **how)
    return score_features(feats, model).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **how) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject. The features are stored beside the row, so that each text is
    looked at once and nothing is joined."""
    marked = stored(docs.select(F.struct("*").alias("_row"), features("text").alias("x")), "marked")
    held_out = (fold(F.col("_row.doc_id"), FOLDS) == 0).alias("held_out")
    model = train_on(marked.select(F.col("_row.doc_id").alias("doc_id"), held_out, "x"), labels, **how)

    @F.arrow_udf("double")
    def score(x: pa.Array) -> pa.Array:
        return pa.array(model.scores(_matrix(x)) if len(x) else np.zeros(0))

    return marked.filter(score("x") >= threshold).select("_row.*")
