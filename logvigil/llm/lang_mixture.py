"""Language identification as a mixture: expectation-maximisation over n-gram likelihoods.

Training counts byte n-grams (orders 1 to 4, lower-cased, hashed to 2^16 cells) for every language over all training
documents: each task adds up, sums of (language, cell) are shuffled. The model has one row of probabilities for each
language, 64 kB a language at 8 bits of precision and 256 kB as used, so it is bounded by the languages.

A document's n-grams are drawn from a mixture of languages. EM estimates the proportions; language sets grow from the single best one by the
language with the largest proportion, and the set with the best likelihood less ``penalty`` log(n) for each language is
selected; a text's set grows until the next language does not pay, up to all languages, and its EM runs until its shares stand still.
The prediction is the largest proportion in the selected set. Batches of documents run through EM together.

Null text and text without a letter are ``und`` with score 0, as is every text if nothing was learned. Null ids count as
fold 0; null languages are not learned from. Ties go to the language that sorts first. Repeated rows count as often
as they occur; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold

FOLDS = 5
CELLS = 1 << 16
ORDERS = (1, 2, 3, 4)
ROUNDS = 200
STILL = 1e-3  # a text's EM ends when no share moves by more
_LETTER = re.compile(r"[^\W\d_]")


def ngram_cells(text: str | None) -> np.ndarray:
    """Cell numbers of all n-grams, in blocks so that a long text needs little more than its own length."""
    raw = np.frombuffer(b" " + (text or "").lower().encode("utf-8", "surrogatepass") + b" ", np.uint8)
    raw = np.where((raw < 65) | ((raw > 90) & (raw < 97)) | ((raw > 122) & (raw < 128)), 32, raw).astype(np.uint32)  # digits, marks and space are one
    code, out = np.zeros(len(raw), np.uint32), []
    for n in ORDERS:
        m = len(raw) - n + 1
        if m <= 0:
            break
        code = (code[:m] << 8 | raw[n - 1:n - 1 + m]) if n > 1 else raw
        out.append(((code * np.uint32(2654435761) + np.uint32(n * 40503)) >> np.uint32(16)).astype(np.int32))
    return np.concatenate(out)


def counted(text: str | None, piece: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """(cells, counts) of a text."""
    text = text or ""
    if len(text) <= 500:
        cells, counts = np.unique(ngram_cells(text), return_counts=True)
        return cells, counts
    total = np.zeros(CELLS, np.int64)
    for i in range(0, len(text), piece):
        total += np.bincount(ngram_cells(text[i:i + piece]), minlength=CELLS)
    cells = np.flatnonzero(total)
    return cells, total[cells]


def train(docs: DataFrame, smooth: float = 0.5) -> tuple[list[str], np.ndarray]:
    """(languages, log probability of each cell for each language)."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(total):
            for lang, t in total.items():
                cells = np.flatnonzero(t)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(cells), pa.string()), pa.array(cells.astype(np.int32)), pa.array(t[cells])], ["lang", "cell", "n"])

        total: dict[str, np.ndarray] = {}
        for b in batches:
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text")):
                if lang not in total:
                    if len(total) >= 64:  # keeps a task small with any number of languages
                        yield from rows(total)
                        total = {}
                    total[lang] = np.zeros(CELLS, np.int64)
                if text.is_valid:
                    cells = ngram_cells(text.as_py())
                    total[lang] += np.bincount(cells, minlength=CELLS)
        yield from rows(total)

    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold("doc_id", FOLDS) != 0)).select("lang", "text")
    got = known.mapInArrow(add, "lang string, cell int, n bigint").groupBy("lang", "cell").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(got["lang"].unique())
    table = np.full((len(langs), CELLS), smooth)
    if len(got):
        table[np.searchsorted(langs, got["lang"]), got["cell"]] += got["n"]
    return langs, np.log(table / table.sum(1, keepdims=True)).astype(np.float32)


def mixtures(texts: list[str | None], logs: np.ndarray, penalty: float = 3.0) -> tuple[np.ndarray, np.ndarray]:
    """(proportions, selected) of each language for each text.

    The likelihood is concave in the proportions, so that no mixture gains more over the best single language than
    n (max over languages of the mean likelihood ratio - 1). Texts where that is below the price of a second language
    are settled; the others go through EM.
    """
    langs, docs = len(logs), len(texts)
    pairs = [counted(t) for t in texts]
    sizes = np.array([len(c) for c, _ in pairs])
    starts = np.cumsum(sizes) - sizes
    cells = np.concatenate([c for c, _ in pairs])
    counts = np.concatenate([n for _, n in pairs]).astype(np.float32)
    total = np.add.reduceat(counts, starts)
    cost = penalty * np.log(np.maximum(total, 2))
    like = logs[:, cells]  # languages x entries
    single = np.add.reduceat(counts * like, starts, axis=1, dtype=np.float64)
    best = single.argmax(0)
    of = np.repeat(best, sizes)
    ratio = np.exp(like - like[of, np.arange(len(of))])
    gain = total * ((np.add.reduceat(counts * ratio, starts, axis=1, dtype=np.float64) / total).max(0) - 1)
    chosen = np.zeros((langs, docs), bool)
    chosen[best, np.arange(docs)] = True
    theta = chosen.astype(np.float32)
    hard = np.flatnonzero(gain > cost)
    if len(hard):
        rows = np.concatenate([np.arange(starts[i], starts[i] + sizes[i]) for i in hard])
        theta[:, hard], chosen[:, hard] = _grown(like[:, rows], counts[rows], sizes[hard], single[:, hard], cost[hard])
    return theta, chosen


def _grown(logs: np.ndarray, counts: np.ndarray, sizes: np.ndarray, single: np.ndarray, cost: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Language sets by penalised likelihood: from the best language on, the next by its share in the full mixture.

    EM on scaled likelihoods: responsibilities are p_l(cell) theta_l over their sum; theta is their count-weighted mean.
    """
    langs, docs = single.shape
    starts = np.cumsum(sizes) - sizes
    total = np.add.reduceat(counts, starts)
    top = logs.max(0)
    like = np.exp(logs - top)
    base = np.add.reduceat(counts * top, starts, dtype=np.float64)

    def entries(at: np.ndarray) -> np.ndarray:
        return np.concatenate([np.arange(starts[i], starts[i] + sizes[i]) for i in at])

    def fit(theta: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shares and log likelihood of some texts; a text is left alone as soon as it stands still, so its neighbours don't matter."""
        theta, live = theta.copy(), np.arange(len(texts))
        for _ in range(ROUNDS):
            rows = entries(texts[live])
            of, size = np.repeat(np.arange(len(live)), sizes[texts[live]]), sizes[texts[live]]
            mass = like[:, rows] * theta[:, live][:, of]
            mass *= counts[rows] / np.maximum(mass.sum(0), 1e-30)
            now = np.add.reduceat(mass, np.cumsum(size) - size, axis=1) / total[texts[live]]
            moved = np.abs(now - theta[:, live]).max(0) > STILL
            theta[:, live] = now
            live = live[moved]
            if not len(live):
                break
        rows = entries(texts)
        of, size = np.repeat(np.arange(len(texts)), sizes[texts]), sizes[texts]
        inside = np.maximum((like[:, rows] * theta[:, of]).sum(0), 1e-30)
        return theta, base[texts] + np.add.reduceat(counts[rows] * np.log(inside), np.cumsum(size) - size, dtype=np.float64)

    full, _ = fit(np.full((langs, docs), 1 / langs, np.float32), np.arange(docs))
    best = single.argmax(0)
    chosen = np.zeros((langs, docs), bool)
    chosen[best, np.arange(docs)] = True
    theta, value = chosen.astype(np.float32), single.max(0) - cost
    order = np.argsort(-np.where(chosen, np.inf, full), axis=0, kind="stable")
    growing = np.arange(docs)  # a text's set grows until a language more does not pay, up to all of them
    for size in range(2, langs + 1):
        trial = np.zeros((langs, len(growing)), bool)
        np.put_along_axis(trial, order[:size, growing], True, 0)
        begin = np.where(trial, np.maximum(full[:, growing], 1e-3), 0).astype(np.float32)
        t, v = fit(begin / begin.sum(0), growing)
        better = v - size * cost[growing] > value[growing]
        at = growing[better]
        theta[:, at], chosen[:, at], value[at] = t[:, better], trial[:, better], (v - size * cost[growing])[better]
        growing = at
        if not len(growing):
            break
    return theta, chosen


def _judge(docs: DataFrame, langs: list[str], logs: np.ndarray, chunk: int = 1 << 20) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()
    model = docs.sparkSession.sparkContext.broadcast((langs, logs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, table = model.value
        for b in batches:
            texts = b.column("text")
            pred, score, mixed = ["und"] * len(texts), np.zeros(len(texts)), [[] for _ in texts]

            def settle(now: list[int], held: list[str]) -> None:
                theta, chosen = mixtures(held, table)
                top = theta.argmax(0)
                for j, i in enumerate(now):
                    pred[i], score[i] = names[top[j]], min(1.0, float(theta[top[j], j]))
                    mixed[i] = [(names[x], float(theta[x, j])) for x in np.flatnonzero(chosen[:, j])]

            size, now, held = 0, [], []
            for i, cell in enumerate(texts):  # about a megabyte of text at a time becomes Python objects
                t = cell.as_py()
                if names and t and _LETTER.search(t):
                    now.append(i)
                    held.append(t)
                    size += len(t)
                if size >= chunk:
                    settle(now, held)
                    size, now, held = 0, [], []
            if now:
                settle(now, held)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(pred), pa.array(score), pa.array(
                [[{"lang": n, "share": s} for n, s in m] for m in mixed], pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())])))],
                ["doc_id", "held_out", "lang_pred", "score", "languages"])

    rows = docs.select("doc_id", (fold("doc_id", FOLDS) == 0).alias("held_out"), "text")
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double, languages array<struct<lang:string,share:double>>")


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, languages (the selected set with proportions) for every document."""
    return _judge(docs, *train(docs))
