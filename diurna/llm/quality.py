"""Quality classifier by positive-unlabelled learning with the non-negative risk estimator.

Trusted positives are rows with label 1; unlabelled rows are web texts without regard to any label; negative labels are
not used. The class prior is estimated from the two samples (best bin: the least ratio, with a confidence term, of the shares of
unlabelled and positive rows among the lowest scores, where hardly any positive row lies, gives the share of other rows).
The model is additive over binned features (a weight per feature and quantile bin), fitted by gradient steps on

    prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)),

where a step goes the other way while the second term is negative. Its score is the estimated probability of label 1.
Fitting uses at most ``SAMPLE`` rows of each kind, taken by a hash of the id; scoring reads every whole text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import is_training_row, small_batches

#: Most rows of each kind that fitting uses; a documented bound
SAMPLE = 8000
#: Fewest rows of each kind that a model is fitted on
LEAST = 8
BINS = 24
#: Most steps. The risk on a fifth of the rows that is kept apart is looked at every WATCH steps: the weights with the least hold, and after PATIENCE looks without a lesser one no more steps are taken
EPOCHS = 2000
WATCH = 25
PATIENCE = 6
#: Steps of the classifier that the prior is estimated with
PLAIN_EPOCHS = 250
RATE = 0.1
DECAY = 1e-5

FEATURES = [
    "log_words", "mean_word", "upper", "digit", "mark", "odd_mark", "bar", "exclamation", "words_with_odd_end",
    "capital_words", "upper_words", "type_ratio", "same_as_last", "commonest", "longest_run", "pair_ratio", "short_words", "log_mean_line", "repeated_lines",
]
_ODD = re.compile(r"[^\w\s.,;:'\"()?!-]")
_ODD_END = re.compile(r"[^\w\s.,;:'\"()?-]{2,}(?=\s|$)")
_MARK = re.compile(r"[^\w\s]")
_DIGIT = re.compile(r"\d")


def features(text: str | None) -> list[float]:
    """FEATURES of a whole text; an empty one has zeros."""
    text = text or ""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    chars = len(text)
    low = [w.lower() for w in words]
    counts = Counter(low)
    same, run, longest, last = 0, 1, 1, None
    for w in low:
        if w == last:
            same += 1
            run += 1
            if run > longest:
                longest = run
        else:
            run, last = 1, w
    pairs = len(set(zip(low, low[1:], strict=False)))
    lines = text.split("\n")
    upper = sum(map(str.isupper, words))
    return [
        np.log1p(n),
        chars / n,
        sum(1 for a, b in zip(text, text.lower(), strict=False) if a != b) / chars if upper > 0.02 * n else sum(1 for w in words if w[0].isupper()) / chars,
        len(_DIGIT.findall(text)) / chars,
        len(_MARK.findall(text)) / n,
        len(_ODD.findall(text)) / n,
        text.count("|") / n,
        text.count("!") / n,
        len(_ODD_END.findall(text)) / n,
        sum(1 for w in words if w[0].isupper()) / n,
        upper / n,
        len(counts) / n ** 0.75,
        same / n,
        counts.most_common(1)[0][1] / n,
        longest / np.sqrt(n),
        pairs / n,
        sum(1 for w in low if len(w) <= 3) / n,
        np.log1p(n / len(lines)),
        1 - len(set(lines)) / len(lines),
    ]


class Model:
    """Additive model over binned features."""

    def __init__(self, edges: list[np.ndarray], weights: np.ndarray, bias: float, prior: float):
        self.edges, self.weights, self.bias, self.prior = edges, weights, bias, prior

    def cells(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], "right") + k * (BINS + 1) for k, e in enumerate(self.edges)], axis=1)

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.weights[self.cells(x)].sum(axis=1) + self.bias

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -40, 40)))


def _bins(x: np.ndarray) -> list[np.ndarray]:
    """Edges at the quantiles, finer toward both ends, where junk lies."""
    share = np.concatenate([[0.005, 0.01, 0.02, 0.035], np.linspace(0.05, 0.95, BINS - 8), [0.965, 0.98, 0.99, 0.995]])
    return [np.quantile(x[:, k], share) for k in range(x.shape[1])]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def risk(on_positive: np.ndarray, on_unlabelled: np.ndarray, prior: float) -> float:
    """Non-negative unbiased risk of margins with the logistic loss."""
    negative = np.logaddexp(0, on_unlabelled).mean() - prior * np.logaddexp(0, on_positive).mean()
    return float(prior * np.logaddexp(0, -on_positive).mean() + max(0.0, negative))


def _fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None, epochs: int, apart: tuple[np.ndarray, np.ndarray] | None = None) -> Model:
    """nnPU for a given prior; without one, a plain classifier of positive against unlabelled rows. With rows kept apart, the model at the step where their risk is least."""
    model = Model(_bins(np.concatenate([positive, unlabelled])), np.zeros(positive.shape[1] * (BINS + 1)), 0.0, prior or 0.5)
    cp, cu = model.cells(positive), model.cells(unlabelled)
    size, columns = len(model.weights), positive.shape[1]
    m, v, mb, vb = np.zeros(size), np.zeros(size), 0.0, 0.0
    least, best, since = np.inf, None, 0
    cells_apart = None if apart is None else [model.cells(x) for x in apart]

    def gather(cells: np.ndarray, slope: np.ndarray) -> np.ndarray:
        return np.bincount(cells.ravel(), np.repeat(slope, columns), size)

    for t in range(1, epochs + 1):
        gp, gu = model.weights[cp].sum(axis=1) + model.bias, model.weights[cu].sum(axis=1) + model.bias
        # logistic loss: log(1 + exp(-z)) for label +, log(1 + exp(z)) for label -
        up = -_sigmoid(-gp) / len(gp)
        down_p, down_u = _sigmoid(gp) / len(gp), _sigmoid(gu) / len(gu)
        if prior is None:
            sp, su = up, down_u
        elif np.logaddexp(0, gu).mean() >= prior * np.logaddexp(0, gp).mean():
            sp, su = prior * up - prior * down_p, down_u
        else:
            sp, su = prior * down_p, -down_u
        grad = gather(cp, sp) + gather(cu, su) + DECAY * model.weights
        gb = sp.sum() + su.sum()
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb**2
        c1, c2 = 1 - 0.9**t, 1 - 0.999**t
        model.weights = model.weights - RATE * (m / c1) / (np.sqrt(v / c2) + 1e-8)
        model.bias -= RATE * (mb / c1) / (np.sqrt(vb / c2) + 1e-8)
        if apart is not None and t % WATCH == 0:
            now = risk(*[model.weights[c].sum(axis=1) + model.bias for c in cells_apart], prior or 0.5)
            if now < least:
                least, best, since = now, (model.weights, model.bias), 0
            elif (since := since + 1) >= PATIENCE:
                break
    if best is not None:
        model.weights, model.bias = best
    return model


def class_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positive rows among the unlabelled: best bin estimation on the rows that a plain classifier wasn't fitted on."""
    cut_p, cut_u = len(positive) // 2, len(unlabelled) // 2
    plain = _fit(positive[:cut_p], unlabelled[:cut_u], None, PLAIN_EPOCHS)
    sp, su = np.sort(plain.margin(positive[cut_p:])), np.sort(plain.margin(unlabelled[cut_u:]))
    at = np.unique(sp)
    # shares at or above each bound
    qp, qu = 1 - np.searchsorted(sp, at, "left") / len(sp), 1 - np.searchsorted(su, at, "left") / len(su)
    error = np.sqrt(np.log(4 / 0.1) / 2)
    upper = (qu + 1.0 / len(su) ** 0.5 * error + qp / len(sp) ** 0.5 * error) / np.maximum(qp, 1e-9)
    best = np.argmin(np.where(qp > 0.05, upper, np.inf))
    return float(np.clip(qu[best] / max(qp[best], 1e-9), 0.05, 0.98))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None = None) -> Model:
    """A model from features of trusted positives and of unlabelled rows; the prior is estimated unless given."""
    prior = class_prior(positive, unlabelled) if prior is None else prior
    a, b = -(-len(positive) // 5), -(-len(unlabelled) // 5)
    return _fit(positive[a:], unlabelled[b:], prior, EPOCHS, (positive[:a], unlabelled[:b]))


def training_features(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """Features of trusted positives and of unlabelled rows, at most ``sample`` each: those with the least hashes of the id."""

    @F.pandas_udf("array<double>")
    def measured(texts: pd.Series) -> pd.Series:
        return texts.map(features)

    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("id is not null")
    marked = labels.where(is_training_row(F.col(id_col)) & (F.col(label_col) == 1)).select(F.col(id_col).alias("id"))

    def least(ids: DataFrame, kind: int) -> DataFrame:
        return ids.distinct().orderBy(F.xxhash64("id"), "id").limit(sample).withColumn("kind", F.lit(kind))

    ids = least(marked.join(texts.select("id"), "id", "left_semi"), 1).unionByName(least(texts.select("id"), 0))
    # 2 * sample ids at most, and of the rows that share an id the one with the least text
    texts = texts.select("id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(ids), "id").groupBy("id", "kind").agg(F.min("text").alias("text"))
    rows = texts.select("kind", "id", measured("text").alias("x")).orderBy("kind", F.xxhash64("id"), "id", "x").toPandas()
    return tuple(np.array(rows.loc[rows["kind"] == kind, "x"].tolist(), np.float64).reshape(-1, len(FEATURES)) for kind in (1, 0))


def quality_scores(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """docs' rows, all columns, with ``score``: the estimated probability of good quality. Null counts as empty text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        rows = np.array([features(t) for t in texts]).reshape(len(texts), len(FEATURES))
        return pd.Series(shared.value.score(rows))

    return docs.withColumn("score", score(F.col(text_col)))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", threshold: float = 0.5) -> DataFrame:
    """One row per input row: id_col, held_out, score, predicted.

    Labels are read only from training rows (crc32 of the id modulo 3 is not 1). Null and empty texts are scored like any
    text without words, very long ones whole. Repeated rows are scored each for itself; an id with several texts is one row to fit on. With fewer than LEAST
    trusted positives or texts to fit on, every score is 0.5.
    Other columns are ignored. A table without rows gives none.
    """
    small_batches(docs.sparkSession)
    positive, unlabelled = training_features(docs, labels, id_col, text_col, label_col)
    texts = docs.select(F.col(id_col), F.col(text_col).alias("_text"))
    if min(len(positive), len(unlabelled)) >= LEAST:
        scored = quality_scores(texts, fit(positive, unlabelled), "_text")
    else:
        scored = texts.withColumn("score", F.lit(0.5))
    return scored.select(
        F.col(id_col),
        F.coalesce(~is_training_row(F.col(id_col)), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
