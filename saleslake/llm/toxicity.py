"""Operator 9: toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the hashes of its different words, word pairs, and pairs with one word between them,
in 2 ** ``bits`` dimensions.  Learning reads a bounded sample of the labelled rows (``sample_rows``, both
classes), in one task: each row updates the coordinates it has at their own rates, and L1 keeps most weights at
exactly zero.  What is broadcast to score all texts is the list of non-zero weights, at most 2 ** ``bits`` of them.

Defined results: null text counts as empty; an empty text scores the bias alone; labels that are null are no
labels; a label given twice counts as toxic if one of them is; without labelled rows the prior of ten per cent
is the score of every text; a null id is never held out and never learnt from; extra columns are ignored
by ``toxicity`` and returned unchanged by ``drop_toxic``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleslake.llm.common import WordHashes, crc_mod, fresh, text_of

BITS = 20
SAMPLE_ROWS = 16_000
FOLDS = 5
WORD = re.compile(r"\w+")
#: Odd 64-bit factors that mix the hashes of a pair's words.
MIX_PAIR, MIX_SKIP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)

def features(text: str | None, hashes: WordHashes, bits: int = BITS) -> np.ndarray:
    """The different hashed features of a text, sorted."""
    words = WORD.findall((text or "").lower())
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    parts = [h, h[:-1] * MIX_PAIR + h[1:], (h[:-2] * MIX_SKIP) ^ h[2:]] if len(h) > 2 else \
        [h, h[:-1] * MIX_PAIR + h[1:]]
    mixed = np.concatenate(parts) * MIX_PAIR
    return np.unique((mixed >> np.uint64(64 - bits)).astype(np.int32))


class Ftrl:
    """FTRL-proximal: z and n of each coordinate; the weight is zero until |z| passes l1."""

    def __init__(self, dims: int, alpha: float = 1.0, beta: float = 1.0, l1: float = 6.0, l2: float = 0.0, prior: float = 0.1):
        self.z, self.n = np.zeros(dims), np.zeros(dims)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.bias, self.bias_n = float(np.log(prior / (1 - prior))), 0.0

    def weights(self, at) -> np.ndarray:
        z = self.z[at]
        rate = (self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2
        return np.where(np.abs(z) <= self.l1, 0.0, (np.sign(z) * self.l1 - z) / rate)

    def learn(self, at: np.ndarray, label: int, weight: float = 1.0) -> None:
        w = self.weights(at)
        p = 1 / (1 + np.exp(-np.clip(w.sum() + self.bias, -35, 35)))
        g = (p - label) * weight
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g
        self.bias_n += g * g
        self.bias -= self.alpha * g / (self.beta + np.sqrt(self.bias_n))


def fit(rows: list[tuple[str, int, float]], bits: int = BITS, epochs: int = 3) -> Iterator[tuple[int, float]]:
    """(coordinate, weight) of the non-zero weights; the bias is coordinate -1.  rows: text, label, weight."""
    model, hashes = Ftrl(1 << bits), WordHashes()
    seen = [(features(t, hashes, bits), y, w) for t, y, w in rows]
    for _ in range(epochs):
        for at, label, weight in seen:
            model.learn(at, label, weight)
    yield -1, model.bias
    every = model.weights(slice(None))
    for i in np.flatnonzero(every):
        yield int(i), float(every[i])


def class_weights(counts: dict[int, int], took: dict[int, int]) -> list[float]:
    """Weights of the sampled clean and toxic rows that restore the classes' true shares, whichever class was cut more."""
    if not took[0] or not took[1]:
        return [1.0, 1.0]
    return [counts[0] / took[0] * took[1] / counts[1], 1.0]


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          sample_rows: int = SAMPLE_ROWS, bits: int = BITS, folds: int = FOLDS) -> dict[int, float]:
    """Non-zero weights by coordinate, learnt from at most ``sample_rows`` labelled rows outside the held-out fold.

    Up to a third of the sample are toxic rows; the weights of the rows restore the classes' true shares.
    """
    marked = (labels.where(F.col(f"`{label_col}`").isNotNull() & (crc_mod(id_col, folds) > 0))
              .groupBy(F.col(f"`{id_col}`").alias("id")).agg(F.max(F.col(f"`{label_col}`")).cast("int").alias("label")))
    counts = {r["label"]: r["n"] for r in marked.groupBy("label").agg(F.count("*").alias("n")).collect()}
    most = {1: sample_rows // 3, 0: sample_rows - sample_rows // 3}
    took = {y: min(counts.get(y, 0), most[y]) for y in most}
    if not took[0] + took[1]:
        return {}
    weight = class_weights(counts, took)
    order = F.xxhash64("id")
    sample = marked.where("label = 1").orderBy(order, "id").limit(most[1]).unionByName(
        marked.where("label = 0").orderBy(order, "id").limit(most[0]))
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), text_of(text_col).alias("text"))
    # at most sample_rows ids: the side that is sent to all tasks is bounded by that; of rows that share an id one text counts
    chosen = (texts.join(F.broadcast(sample), "id").groupBy("id", "label").agg(F.min("text").alias("text"))
              .select("id", "text", "label").repartition(1))

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = [r for b in batches for r in zip(b["id"], b["text"], b["label"])]
        rows.sort(key=lambda r: (xxhash.xxh64_intdigest(str(r[0]), 1), r[1], r[2]))
        yield pd.DataFrame(fit([(t, y, weight[y]) for _, t, y in rows], bits), columns=["at", "w"])

    return {r["at"]: r["w"] for r in chosen.mapInPandas(learn, "at long, w double").collect()}


def score_col(spark, weights: dict[int, float], text: Column, bits: int = BITS) -> Column:
    """The probability that a text is toxic; the weights are broadcast once."""
    at = np.array([i for i in weights if i >= 0], np.int64)
    shared = spark.sparkContext.broadcast((at, np.array([weights[i] for i in at.tolist()]),
                                           weights.get(-1, float(np.log(0.1 / 0.9)))))

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        at, w, bias = shared.value
        dense, hashes = np.zeros(1 << bits), WordHashes()
        dense[at] = w
        for texts in batches:
            sums = np.array([dense[features(t, hashes, bits)].sum() for t in texts]) if len(texts) else np.empty(0)
            yield pd.Series(1 / (1 + np.exp(-np.clip(sums + bias, -35, 35))))
    return scores(text)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic", sample_rows: int = SAMPLE_ROWS, bits: int = BITS, folds: int = FOLDS) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    weights = train(docs, labels, id_col, text_col, label_col, sample_rows, bits, folds)
    score = score_col(docs.sparkSession, weights, text_of(text_col), bits)
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), (crc_mod(id_col, folds) == 0).alias("held_out"),
                       score.alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               label_col: str = "toxic", threshold: float = 0.5, sample_rows: int = SAMPLE_ROWS, bits: int = BITS,
               folds: int = FOLDS) -> DataFrame:
    """``docs`` without the texts that score ``threshold`` or more, all columns unchanged."""
    weights = train(docs, labels, id_col, text_col, label_col, sample_rows, bits, folds)
    score = fresh(docs, "toxicity")
    scored = docs.withColumn(score, score_col(docs.sparkSession, weights, text_of(text_col), bits))
    return scored.where(F.col(f"`{score}`") < threshold).drop(score)
