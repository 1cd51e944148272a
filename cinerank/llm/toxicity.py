"""Toxicity: character n-gram linear classifier on naive Bayes log-count ratios.

A text's features are the distinct hashed character n-grams of its lower-cased form.
How many toxic and clean training documents hold each n-gram is counted over all
labelled rows of the training folds; an n-gram's feature value is its smoothed
log-count ratio.  N-grams whose document odds do not differ reliably between the classes
get no weight.  A logistic regression on the values of the others is fitted on a bounded
sample of the same rows, both classes weighed alike; an n-gram that no sampled document
holds gets the mean of the fitted coefficients, so the counts over all rows take effect.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cinerank.config import materialize
from cinerank.llm.common import FILTER_BITS, bounded_batches, fold, key_bitmap, maybe_in, text_of
from cinerank.llm.sampling import bounded_sample

FOLDS, HELD_OUT = 3, 1
CUT = 0.7
SIZES = (4, 5)           # characters (code points of the lower-cased text) of an n-gram
BITS = 18
DIMS = 1 << BITS
BLOCK = 4_096            # counters of one row of partial counts
PARTS = 64               # partial sums meet in so many groups per block first
SMOOTH = 1.0
RELIABLE = 4.0           # least distance of the log odds from equal, in standard errors
SAMPLE = 3_000           # labelled documents of each class used to fit the weights,
GRAMS = 1_500_000        # as far as they hold so many n-grams together (at least one document)
EPOCHS, STEP, SHRINK = 300, 0.05, 1e-4
SLICE = 256              # documents whose n-grams are held at a time
MODEL_SEED = 47


def hashed(text: str) -> np.ndarray:
    """Hashed n-grams of a whole text with a space at either end, in order."""
    raw = np.frombuffer((" " + text.lower() + " ").encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    found = [np.empty(0, np.int32)]
    for n in SIZES:
        if len(raw) >= n:
            h = np.zeros(len(raw) - n + 1, np.uint64)
            for i in range(n):
                h = h * np.uint64(1_114_127) + raw[i:len(raw) - n + 1 + i]
            h = (h + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            found.append((h >> np.uint64(64 - BITS)).astype(np.int32))
    return np.concatenate(found)


def ngrams(text: str, of: np.ndarray | None = None) -> np.ndarray:
    """Distinct hashed n-grams of a text, all or those that ``of`` marks."""
    h = hashed(text)
    return np.unique(h if of is None else h[of[h]])


def log_count_ratios(toxic: np.ndarray, clean: np.ndarray, smooth: float = SMOOTH) -> np.ndarray:
    p, q = toxic + smooth, clean + smooth
    return np.log(p / p.sum()) - np.log(q / q.sum())


def reliable(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int, least: float = RELIABLE) -> np.ndarray:
    """Marks n-grams whose odds of occurring in a document differ between the classes by
    at least ``least`` standard errors."""
    p, q = toxic + 0.5, clean + 0.5
    odds = np.log(p / (n_toxic - toxic + 0.5)) - np.log(q / (n_clean - clean + 0.5))
    return np.abs(odds) >= least * np.sqrt(1 / p + 1 / q) / 2


class Model:
    """``weights`` holds the log-count ratio times the fitted coefficient of each n-gram."""

    def __init__(self, weights: np.ndarray, bias: float) -> None:
        self.weights, self.bias = weights.astype(np.float32), float(bias)
        self.used = self.weights != 0

    def score(self, text: str) -> float:
        z = float(self.weights[ngrams(text, self.used)].sum(dtype=np.float64)) + self.bias
        return float(0.5 * (1 + np.tanh(0.5 * z)))


def train(grams: list[np.ndarray], toxic: np.ndarray, ratios: np.ndarray, epochs: int = EPOCHS,
          used: np.ndarray | None = None) -> Model:
    """Logistic regression on the ratios of each document's n-grams (Adam, full batch).
    N-grams that ``used`` marks and no document holds share the mean coefficient, at least 0.
    No rows: every score is 0.5; one class only: a constant score on its side."""
    if not len(grams) or toxic.all() or not toxic.any():
        return Model(np.zeros(DIMS), 0.0 if not len(grams) else (4.0 if toxic.all() else -4.0))
    sizes = np.array([len(g) for g in grams])
    cols, at = np.unique(np.concatenate(grams).astype(np.int32), return_inverse=True)
    owner = np.repeat(np.arange(len(grams)), sizes)
    r = ratios[cols]
    x = r[at]
    each = np.where(toxic, 0.5 / toxic.sum(), 0.5 / (~toxic).sum())
    w, m, v = (np.zeros(len(cols) + 1) for _ in range(3))
    for t in range(1, epochs + 1):
        z = np.bincount(owner, x * w[at], len(grams)) + w[-1]
        gz = each * (0.5 * (1 + np.tanh(0.5 * z)) - toxic)
        g = np.append(np.bincount(at, x * gz[owner], len(cols)) + SHRINK * w[:-1], gz.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= STEP * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-10)
    full = np.zeros(DIMS)
    if used is not None and len(cols):
        full[used] = ratios[used] * max(0.0, w[:-1].mean())
    full[cols] = r * w[:-1]
    return Model(full, w[-1])


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Partial counts of one task: a row per block of counters, and at block -1 the
    numbers of clean and toxic documents."""
    counts, n = np.zeros((2, DIMS), np.int64), np.zeros(2 * BLOCK, np.int64)
    for rows in batches:
        for text, label in zip(rows["text"], rows["toxic"]):
            counts[int(label)][ngrams(text)] += 1
            n[int(label)] += 1
    yield pd.DataFrame({"block": [-1], "counts": [n.tobytes()]})
    for b in range(DIMS // BLOCK):
        yield pd.DataFrame({"block": [b], "counts": [counts[:, b * BLOCK:(b + 1) * BLOCK].tobytes()]})


def _add(rows: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(2 * BLOCK, np.int64)
    for c in rows["counts"]:
        total += np.frombuffer(c, np.int64)
    return pd.DataFrame({"block": rows["block"].iloc[:1], "counts": [total.tobytes()]})


def count_ngrams(rows: DataFrame) -> tuple[np.ndarray, tuple[int, int]]:
    """(2, DIMS) numbers of clean and toxic documents with each n-gram, and of documents,
    over all rows.  Every task sums its own rows; the partial counters, 4 MB a task, are
    summed in two rounds.  The result has a fixed size."""
    partial = rows.mapInPandas(_count, "block int, counts binary").withColumn("part", F.spark_partition_id() % PARTS)
    once = partial.groupBy("block", "part").applyInPandas(_add, "block int, counts binary")
    whole = once.groupBy("block").applyInPandas(_add, "block int, counts binary")
    counts, n = np.zeros((2, DIMS)), (0, 0)
    for row in whole.collect():          # DIMS / BLOCK + 1 rows
        b, c = row["block"], np.frombuffer(row["counts"], np.int64)
        if b < 0:
            n = (int(c[0]), int(c[1]))
        else:
            counts[:, b * BLOCK:(b + 1) * BLOCK] = c.reshape(2, BLOCK)
    return counts, n


def _fit(ratios: np.ndarray, used: np.ndarray):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = []
        for rows in batches:
            found += zip(rows["grams"], rows["toxic"])
        found.sort()                    # an order of their own, so that reruns sum alike however rows arrive
        m = train([np.frombuffer(g, np.int32) for g, _ in found], np.array([t for _, t in found], bool), ratios, used=used)
        yield pd.DataFrame({"model": [m.weights.tobytes()], "bias": [m.bias]})
    return run


def _gram_rows(used: np.ndarray):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for i in range(0, len(rows), SLICE):
                part = rows.iloc[i:i + SLICE]
                yield pd.DataFrame({"id": part["id"], "toxic": part["toxic"], "grams": [ngrams(t, used).tobytes() for t in part["text"]]})
    return run


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        sample: int = SAMPLE, grams: int = GRAMS, seed: int = MODEL_SEED) -> Model:
    """Train on the folds that are not held out: log-count ratios on every labelled row,
    coefficients on at most ``sample`` documents and ``grams`` n-grams of each class, chosen by
    id hash, in one task.  A document with contradicting labels counts as toxic.  Of rows that
    share an id all are counted, and the text of the least digest is fitted."""
    bounded_batches(docs.sparkSession)
    usable = fold("id", FOLDS) != HELD_OUT
    known = (labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label")).filter(usable & F.col("label").isNotNull())
             .groupBy("id").agg((F.max("label") > 0).alias("toxic")))
    text = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).filter(usable)
    # the bitmap leaves texts without a label where they are; the join then decides exactly
    likely = maybe_in(text, F.xxhash64("id"), key_bitmap(known, F.xxhash64("id"), FILTER_BITS), FILTER_BITS)
    rows = likely.join(known, "id")
    counts, (n_clean, n_toxic) = count_ngrams(rows.select("text", "toxic"))
    ratios = log_count_ratios(counts[1], counts[0])
    used = reliable(counts[1], counts[0], n_toxic, n_clean)
    ids = text.select("id").distinct()
    parts = [bounded_sample(known.filter(f).join(ids, "id"), F.col("id"), sample, seed) for f in ("toxic", "not toxic")]
    wanted = parts[0].unionByName(parts[1])
    chosen = (text.join(F.broadcast(wanted), "id").groupBy("id", "toxic")           # at most 2 * sample ids
              .agg(F.min_by("text", F.sha2("text", 256)).alias("text")))
    held = materialize(chosen.mapInPandas(_gram_rows(used), "id long, toxic boolean, grams binary"), "toxicity-grams")
    bounded = (held.select("id", "toxic", F.octet_length("grams").alias("size"))
               .withColumn("before", F.sum("size").over(Window.partitionBy("toxic").orderBy(F.xxhash64("id", F.lit(seed)), "id")) - F.col("size"))
               .filter(F.col("before") < 4 * grams).select("id"))
    fitted = (held.join(F.broadcast(bounded), "id").select("toxic", "grams").repartition(1)
              .mapInPandas(_fit(ratios, used), "model binary, bias double").first())
    if fitted is None:
        return train([], np.empty(0, bool), ratios)
    return Model(np.frombuffer(fitted["model"], np.float32), fitted["bias"])


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", cut: float = CUT,
             sample: int = SAMPLE) -> DataFrame:
    """Per row of ``docs``: id, held_out, score (0 to 1), predicted.

    * Null text counts as empty; empty texts are scored like any other.
    * A null id belongs to no fold: held_out null, never trained on.  Repeated rows are
      scored one by one; scores do not depend on how rows are partitioned.
    * No usable labels: every score is 0.5; labels of one class only: a constant score on
      that class's side.  Empty table: empty result.  Label, lang, source and id are never
      inputs of a score; other columns are ignored."""
    model = fit(docs, labels, id_col, text_col, sample=sample)

    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for t in texts:
            yield pd.Series([model.score(x or "") for x in t], dtype="float64")
    scored = docs.select(id_col, F.col(text_col).alias("text__")).withColumn("score", F.pandas_udf(run, "double")("text__"))
    return scored.select(id_col, (fold(id_col, FOLDS) == HELD_OUT).alias("held_out"), "score",
                         (F.col("score") >= cut).cast("int").alias("predicted"))
