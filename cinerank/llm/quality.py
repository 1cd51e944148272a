"""Quality classifier by positive-unlabelled learning.

A linear logistic model on writing-style features is trained on trusted positives and
unlabelled text by minimising the non-negative unbiased risk

    prior * R_p(+)  +  max(0, R_u(-) - prior * R_p(-)).

The class prior is estimated by a positive-versus-unlabelled model, fitted on halves of
the samples: the share of unlabelled documents above a rank, all but those it was fitted
on, divided by the share of held-back positives above it, at the rank where this is most
surely small, is the prior.  Labelled negatives are never used.
"""

from __future__ import annotations

import hashlib
import operator
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinerank.config import materialize
from cinerank.llm.common import bounded_batches, fold, text_of
from cinerank.llm.sampling import bounded_sample

FOLDS, HELD_OUT = 5, 0
SAMPLE = 8_000           # trusted positives, and as many unlabelled rows, used for fitting
CUT = 0.3
EPOCHS, STEP, SHRINK = 400, 0.05, 1e-4
CLIP = 6.0
SLICE = 512              # rows held at a time by the scorer
SEED = 31


def _byte_classes() -> np.ndarray:
    """Class of each byte: letters by case, digits, kinds of space and of punctuation,
    and bytes of longer characters (lead bytes and the rest)."""
    groups = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\n\r", "\t", ".", ",", "!?", ";:",
              "'\"", "()[]{}<>", "|", "-_/\\", "#$%&*+=@^~`"]
    out = np.full(256, len(groups), np.int64)
    for i, g in enumerate(groups):
        out[[ord(c) for c in g]] = i
    out[128:192], out[192:] = len(groups) + 1, len(groups) + 2
    return out


CLASS = _byte_classes()
N_CLASSES = int(CLASS.max()) + 1
N_FEATURES = N_CLASSES * N_CLASSES + 6


def features(text: str) -> np.ndarray:
    """Square roots of the shares of adjacent byte-class pairs, and shares of repeated
    neighbouring words, repeated words, repeated lines, long words, words without
    lower-case letters, and log length.  Whole text; the empty text gives zeros."""
    out = np.zeros(N_FEATURES, np.float32)
    if not text:
        return out
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    kind = CLASS[raw]
    pairs = np.bincount(kind[:-1] * N_CLASSES + kind[1:], minlength=N_CLASSES * N_CLASSES)
    out[:-6] = np.sqrt(pairs / max(1, len(raw) - 1))
    words = text.split()
    n = max(1, len(words))
    lines = text.split("\n")
    out[-6] = sum(map(operator.eq, words, words[1:])) / n
    out[-5] = 1 - len(set(words)) / n
    out[-4] = 1 - len(set(lines)) / len(lines)
    out[-3] = sum(len(w) > 25 for w in words) / n
    out[-2] = sum(w.upper() == w for w in words) / n
    out[-1] = np.log1p(len(raw)) / 10
    return out


class Model:
    """Standardised linear scores; ``prior`` is the estimated share of positives."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray, bias: float, prior: float) -> None:
        self.mean, self.scale, self.weights, self.bias, self.prior = mean, scale, weights, bias, prior

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -CLIP, CLIP)

    def scores(self, x: np.ndarray) -> np.ndarray:
        # summed row by row, so that a score does not depend on the rows it is worked out with
        return sigmoid((self.scaled(x) * self.weights).sum(1) + self.bias)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * np.asarray(z, float)))


def _descend(p: np.ndarray, u: np.ndarray, gradient, epochs: int) -> tuple[np.ndarray, float]:
    """Adam on (weights, bias) with ``gradient(zp, zu)`` giving the loss derivatives of
    each row's output."""
    w = np.zeros(p.shape[1] + 1)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, epochs + 1):
        gp, gu = gradient(p @ w[:-1] + w[-1], u @ w[:-1] + w[-1])
        g = np.append(p.T @ gp + u.T @ gu + SHRINK * w[:-1], gp.sum() + gu.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= STEP * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w[:-1], float(w[-1])


class Ranking:
    """Positive-versus-unlabelled output of scaled rows, fitted on the first ``n`` rows of
    each; cuts at quantiles of the held-back positives and their shares above each cut."""

    def __init__(self, p: np.ndarray, u: np.ndarray) -> None:
        self.n = n = min(len(p), len(u)) // 2
        self.weights, self.bias = _descend(p[:n], u[:n], lambda zp, zu: ((sigmoid(zp) - 1) / len(zp), sigmoid(zu) / len(zu)),
                                           EPOCHS // 2)
        sp = np.sort(p[n:] @ self.weights + self.bias)
        self.cuts, self.held = np.unique(np.quantile(sp, np.linspace(0, 0.99, 100))), len(sp)
        self.above = 1 - np.searchsorted(sp, self.cuts, "left") / len(sp)

    def histogram(self, x: np.ndarray) -> np.ndarray:
        """How many rows reach 0, 1, ... all of the cuts."""
        return np.bincount(np.searchsorted(self.cuts, x @ self.weights + self.bias, "right"), minlength=len(self.cuts) + 1)

    def prior(self, histogram: np.ndarray) -> float:
        n = histogram.sum()
        above = 1 - np.cumsum(histogram)[:-1] / n
        slack = np.sqrt(np.log(40) / (2 * n)) + np.sqrt(np.log(40) / (2 * self.held))
        at = np.argmin((above + slack) / self.above)
        return float(np.clip(above[at] / self.above[at], 0.02, 0.98))


def estimate_prior(p: np.ndarray, u: np.ndarray) -> float:
    """Share of positives among the unlabelled rows (see the module text)."""
    if min(len(p), len(u)) // 2 < 4:
        return 0.5
    ranking = Ranking(p, u)
    return ranking.prior(ranking.histogram(u[ranking.n:]))


def unfitted(positive: np.ndarray, unlabelled: np.ndarray) -> Model:
    both = np.concatenate([positive, unlabelled]).astype(float)
    return Model(both.mean(0), both.std(0) + 1e-3, np.zeros(N_FEATURES), 0.0, 0.5)


def train(positive: np.ndarray, unlabelled: np.ndarray, epochs: int = EPOCHS, prior: float | None = None) -> Model:
    """Non-negative PU risk with the logistic loss; the prior is estimated from the same
    rows where none is given.  Without positives or unlabelled rows
    the model scores every text 0.5."""
    if not len(positive) or not len(unlabelled):
        return Model(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(N_FEATURES), 0.0, 0.5)
    model = unfitted(positive, unlabelled)
    p, u = model.scaled(positive), model.scaled(unlabelled)
    model.prior = prior = estimate_prior(p, u) if prior is None else prior

    def gradient(zp: np.ndarray, zu: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sp, su = sigmoid(zp), sigmoid(zu)
        negative_risk = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        gu, gp_minus = su / len(zu), -prior * sp / len(zp)
        if negative_risk < 0:           # undo the overfit part instead of following it
            return -gp_minus, -gu
        return prior * (sp - 1) / len(zp) + gp_minus, gu
    model.weights, model.bias = _descend(p, u, gradient, epochs)
    return model


def _featurise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        yield pd.DataFrame({"positive": rows["positive"], "x": [features(t).tobytes() for t in rows["text"]]})


def _samples(batches: Iterator[pd.DataFrame]) -> tuple[np.ndarray, np.ndarray] | None:
    """Feature rows of the positives and of the unlabelled."""
    parts = [b for b in batches if len(b)]
    if not parts:
        return None
    rows = pd.concat(parts, ignore_index=True)
    # an order of their own, so that reruns split and sum alike however rows arrive
    rows = rows.assign(at=[hashlib.blake2b(x, digest_size=8).digest() for x in rows["x"]]).sort_values(["at", "positive"])
    x = np.frombuffer(b"".join(rows["x"]), np.float32).reshape(-1, N_FEATURES)
    is_p = rows["positive"].to_numpy(bool)
    return x[is_p], x[~is_p]


def _rank(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The ranking of the prior, with the histogram of the unlabelled rows it was fitted on."""
    both = _samples(batches)
    if both is not None and min(map(len, both)) // 2 >= 4:
        model = unfitted(*both)
        p, u = map(model.scaled, both)
        ranking = Ranking(p, u)
        yield pd.DataFrame({"ranking": [pickle.dumps((model, ranking, ranking.histogram(u[:ranking.n])))]})


def _reached(model: Model, ranking: Ranking):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(len(ranking.cuts) + 1, np.int64)
        for rows in batches:
            for i in range(0, len(rows), SLICE):
                total += ranking.histogram(model.scaled(np.stack([features(t) for t in rows["text"].iloc[i:i + SLICE]])))
        yield pd.DataFrame({"reached": np.arange(len(total)), "n": total})
    return run


def corpus_prior(text: DataFrame, samples: DataFrame) -> float | None:
    """The prior with its share of unlabelled rows counted over all of ``text``: one pass
    that leaves a histogram of fixed size.  None: too few rows, the sample decides."""
    row = samples.repartition(1).mapInPandas(_rank, "ranking binary").first()
    if row is None:
        return None
    model, ranking, fitted = pickle.loads(row["ranking"])
    sums = text.select("text").mapInPandas(_reached(model, ranking), "reached int, n long").groupBy("reached").agg(F.sum("n").alias("n"))
    counts = np.zeros(len(fitted), np.int64)
    for r in sums.collect():             # one row for each number of cuts
        counts[r["reached"]] = r["n"]
    return ranking.prior(np.maximum(counts - fitted, 0))


def _fit(prior: float | None):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        both = _samples(batches)
        if both is not None:
            m = train(*both, prior=prior)
            yield pd.DataFrame({"model": [np.concatenate([m.mean, m.scale, m.weights, [m.bias, m.prior]]).tobytes()]})
    return run


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        sample: int = SAMPLE, seed: int = SEED) -> Model:
    """Train on the folds that are not held out.  Trusted positives are documents that a
    label row marks 1 and none marks 0; unlabelled are the documents of those folds,
    whatever their label.  At most ``sample`` rows of each are used, chosen by id hash;
    they meet in one task, which returns the weights; of rows that share an id the text of
    the least digest is taken.  The prior's share of unlabelled rows
    is counted over all documents of those folds."""
    bounded_batches(docs.sparkSession)
    usable = fold("id", FOLDS) != HELD_OUT
    trusted = (labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label")).filter(usable & F.col("label").isNotNull())
               .groupBy("id").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo = 1 and hi = 1").select("id"))
    text = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).filter(usable)
    known = trusted.join(text.select("id").distinct(), "id")
    chosen = bounded_sample(known, F.col("id"), sample, seed)
    others = bounded_sample(text.select("id"), F.col("id"), sample, seed + 1).distinct()
    wanted = chosen.select("id", F.lit(True).alias("positive")).unionByName(others.select("id", F.lit(False).alias("positive")))
    rows = (text.join(F.broadcast(wanted), "id").groupBy("id", "positive")              # at most 2 * sample ids
            .agg(F.min_by("text", F.sha2("text", 256)).alias("text")))
    samples = materialize(rows.mapInPandas(_featurise, "positive boolean, x binary"), "quality-samples")
    fitted = samples.repartition(1).mapInPandas(_fit(corpus_prior(text, samples)), "model binary").first()
    if fitted is None:
        return train(np.empty((0, N_FEATURES)), np.empty((0, N_FEATURES)))
    v = np.frombuffer(fitted["model"], float)
    n = N_FEATURES
    return Model(v[:n], v[n:2 * n], v[2 * n:3 * n], float(v[-2]), float(v[-1]))


def score_of(model: Model, text_col: str = "text") -> Column:
    """Score of a text column, worked out batch by batch where the rows are."""
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for t in texts:
            parts = [model.scores(np.stack([features(x or "") for x in t.iloc[i:i + SLICE]])) for i in range(0, len(t), SLICE)]
            yield pd.Series(np.concatenate(parts) if parts else [], dtype="float64")
    return F.pandas_udf(run, "double")(F.col(text_col))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", cut: float = CUT) -> DataFrame:
    """Rows of ``docs`` whose text scores at least ``cut``; columns are unchanged."""
    return docs.filter(score_of(fit(docs, labels, id_col, text_col), text_col) >= cut)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", cut: float = CUT,
             sample: int = SAMPLE) -> DataFrame:
    """Per row of ``docs``: id, held_out, score (0 to 1), predicted.

    * Null text counts as empty; empty texts are scored like any other.
    * A null id belongs to no fold: held_out null, never trained on.  Repeated rows are
      scored one by one; labels that contradict each other are not trusted.  Scores do not
      depend on how rows are partitioned.
    * No labels: every score is 0.5.  Fewer than 8 positives or 8 unlabelled rows: too few to
      estimate the class prior, which is then taken as 0.5.  Empty table: empty result.  Label, lang, source and
      id are never inputs of a score; other columns are ignored."""
    model = fit(docs, labels, id_col, text_col, sample=sample)
    own = docs.select(id_col, F.col(text_col).alias("text__"))
    scored = own.select(id_col, score_of(model, "text__").alias("score"))
    return scored.select(id_col, (fold(id_col, FOLDS) == HELD_OUT).alias("held_out"), "score",
                         (F.col("score") >= cut).cast("int").alias("predicted"))
