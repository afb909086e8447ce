"""Toxicity scores by non-negative positive-unlabelled learning.

A linear model over a text's distinct words and their beginnings is trained in numpy from
confirmed toxic documents (P) and unlabelled documents (U). With the share ``prior`` of toxic
documents and the loss l, the risk is ``prior * E_P l(z) + max(0, E_U l(-z) - prior * E_P l(-z))``:
the second part estimates the clean documents' loss from unlabelled text, and is kept from
going below zero, where the model would only be fitting the toxic sample by heart.

Training runs in one task over a sample of at most ``MAX_POSITIVE`` and ``MAX_UNLABELLED``
whole documents, the smallest by a hash of their identifier. Scoring runs over every document;
the model (at most ``2 ** FEATURE_BITS`` weights) is broadcast.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import small_batches

FEATURE_BITS = 20
BEGINNINGS = (5, 6, 7)  # code points
MAX_POSITIVE = 3000
MAX_UNLABELLED = 9000
MIN_DOCS = 4  # toxic documents that a feature must be in
MIN_SURPLUS = 4.0  # standard errors by which a feature must be more frequent in toxic documents
STEPS = 300
RATE = 0.05
DECAY = 3e-5
THRESHOLD = 0.7

DEFAULT_PRIOR = 0.05  # where there is no label
CACHED_WORDS = 500_000
LENGTH_CENTRE = 5.0

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> set[str]:
    return set(_WORD.findall(text.lower())) if text else set()


def features_of(word: str) -> list[int]:
    """Hashed features of one word: itself and its beginnings."""
    mask = (1 << FEATURE_BITS) - 1
    found = [zlib.crc32(b"=" + word.encode()) & mask]
    found += [zlib.crc32(b"^" + word[:n].encode()) & mask for n in BEGINNINGS if len(word) > n]
    return found


class Documents:
    """Feature counts of documents as flat arrays, and the number of distinct words of each."""

    def __init__(self, texts):
        known: dict[str, np.ndarray] = {}
        flat, lengths, words = [], [], []
        for text in texts:
            parts = []
            own = words_of(text)
            for w in own:
                f = known.get(w)
                if f is None:
                    f = known[w] = np.array(features_of(w), dtype=np.int32)
                parts.append(f)
            doc = np.concatenate(parts) if parts else np.empty(0, np.int32)
            flat.append(doc)
            lengths.append(len(doc))
            words.append(len(own))
        self.flat = np.concatenate(flat) if flat else np.empty(0, np.int32)
        self.doc = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
        self.words = np.array(words, dtype=np.float64)


def length_term(words: np.ndarray) -> np.ndarray:
    return np.log1p(words) - LENGTH_CENTRE


def telling_features(docs: Documents, positive: np.ndarray) -> np.ndarray:
    """Features that toxic documents have more often than unlabelled ones, beyond chance."""
    size = 1 << FEATURE_BITS
    pairs = np.unique(docs.doc.astype(np.int64) << FEATURE_BITS | docs.flat)
    toxic = positive[pairs >> FEATURE_BITS]
    pairs &= size - 1
    n_p, n_u = max(1, int(positive.sum())), max(1, int((~positive).sum()))
    in_p, in_u = np.bincount(pairs[toxic], minlength=size), np.bincount(pairs[~toxic], minlength=size)
    both = (in_p + in_u + 1) / (n_p + n_u + 2)
    surplus = (in_p / n_p - in_u / n_u) / np.sqrt(both * (1 - both) * (1 / n_p + 1 / n_u))
    return np.flatnonzero((in_p >= MIN_DOCS) & (surplus > MIN_SURPLUS))


def train(texts: list, positive: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray, float, float]:
    """Feature numbers, their weights, the bias and the weight of the length term."""
    docs = Documents(texts)
    n = len(texts)
    used = telling_features(docs, positive)
    number = np.full(1 << FEATURE_BITS, -1, dtype=np.int32)
    number[used] = np.arange(len(used))
    column = number[docs.flat]
    row = docs.doc[column >= 0]
    column = column[column >= 0]
    length = length_term(docs.words)
    is_p, is_u = positive, ~positive
    weight, bias, slope = np.zeros(len(used)), 0.0, 0.0
    moment, spread2 = np.zeros(len(used) + 2), np.zeros(len(used) + 2)
    bias = float(np.log(prior / (1 - prior)))
    for step in range(1, STEPS + 1):
        z = np.bincount(row, weights=weight[column], minlength=n) + bias + slope * length
        s = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        loss_neg = np.logaddexp(0, z)  # l(-z) of the logistic loss
        negative = loss_neg[is_u].mean() - prior * loss_neg[is_p].mean()
        g = np.zeros(n)
        if negative >= 0:
            g[is_p] = prior * ((s[is_p] - 1) - s[is_p]) / is_p.sum()
            g[is_u] = s[is_u] / is_u.sum()
        else:  # climb out: the clean documents' risk can't be negative
            g[is_p] = prior * s[is_p] / is_p.sum()
            g[is_u] = -s[is_u] / is_u.sum()
        grad = np.concatenate((np.bincount(column, weights=g[row], minlength=len(used)) + DECAY * weight,
                               [g.sum(), (g * length).sum()]))
        moment = 0.9 * moment + 0.1 * grad
        spread2 = 0.999 * spread2 + 0.001 * grad * grad
        move = RATE * (moment / (1 - 0.9 ** step)) / (np.sqrt(spread2 / (1 - 0.999 ** step)) + 1e-8)
        weight -= move[:-2]
        bias -= move[-2]
        slope -= move[-1]
    return used, weight, float(bias), float(slope)


class Model:
    """Weights by feature, with a bounded cache of what whole words add to a score."""

    def __init__(self, weights: dict[int, float], bias: float, slope: float):
        self.weights, self.bias, self.slope = weights, bias, slope
        self.known: dict[str, float] = {}

    def score(self, text: str | None) -> float:
        own = words_of(text)
        z = self.bias + self.slope * (np.log1p(len(own)) - LENGTH_CENTRE)
        for w in own:
            v = self.known.get(w)
            if v is None:
                if len(self.known) >= CACHED_WORDS:
                    self.known.clear()
                v = self.known[w] = sum(self.weights.get(f, 0.0) for f in features_of(w))
            z += v
        return float(1 / (1 + np.exp(-min(30.0, max(-30.0, z)))))


_BIAS, _SLOPE = -1, -2  # feature numbers of the two plain terms


def _fit(prior: float):
    def fit(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat([*parts, pd.DataFrame({"id": [], "text": [], "p": [], "u": []})]).sort_values("id")
        # A document in both samples stands in both.
        texts = [*rows.text[rows.p == 1], *rows.text[rows.u == 1]]
        positive = np.arange(len(texts)) < int((rows.p == 1).sum())
        if positive.any() and not positive.all():
            used, weight, bias, slope = train(texts, positive, prior)
        else:
            used, weight, bias, slope = [], [], float(np.log(prior / (1 - prior))), 0.0
        yield pd.DataFrame({"feature": [*used, _BIAS, _SLOPE], "weight": [*weight, bias, slope]})
    return fit


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit_model(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              label_col: str = "toxic") -> Model:
    """Train on the rows of ``labels`` and ``docs`` that aren't held out."""
    small_batches(docs)
    known = (labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
             .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).alias("y")))
    prior = known.agg(F.avg("y")).first()[0]
    prior = min(0.99, max(0.001, DEFAULT_PRIOR if prior is None else prior))
    order = F.xxhash64(F.col("id").cast("string"), F.lit("sample"))
    toxic = known.where("y = 1").select("id", F.lit(1).alias("p"), F.lit(0).alias("u")).orderBy(order, "id").limit(MAX_POSITIVE)
    ids = docs.where(F.col(id_col).isNotNull() & ~held_out(id_col)).select(F.col(id_col).alias("id")).distinct()
    plain = ids.select("id", F.lit(0).alias("p"), F.lit(1).alias("u")).orderBy(order, "id").limit(MAX_UNLABELLED)
    # At most MAX_POSITIVE + MAX_UNLABELLED identifiers.
    chosen = toxic.unionByName(plain).groupBy("id").agg(F.max("p").alias("p"), F.max("u").alias("u"))
    sample = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
              .join(F.broadcast(chosen), "id")
              .groupBy("id").agg(F.max("p").alias("p"), F.max("u").alias("u"), F.min("text").alias("text")))
    learnt = sample.coalesce(1).mapInPandas(_fit(prior), "feature int, weight double").collect()
    got = {r["feature"]: r["weight"] for r in learnt}
    bias, slope = got.pop(_BIAS, float(np.log(prior / (1 - prior)))), got.pop(_SLOPE, 0.0)
    return Model({f: w for f, w in got.items() if w}, bias, slope)


def _scorer(shared, text_col: str):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            scores = pa.array([model.score(t) for t in batch.column(at).to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], names=[*batch.schema.names, "score"])
    return score


def score_toxicity(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Every column of ``docs`` plus ``score`` (0 to 1) and ``predicted`` (1 if at least ``THRESHOLD``).

    Only the text sways a score. Null and empty texts get the score of a text without words;
    equal texts get equal scores. Input columns of these two names are replaced. An empty
    table gives an empty result.
    """
    small_batches(docs)
    own = docs.drop("score", "predicted")
    schema = T.StructType([*own.schema.fields, T.StructField("score", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias, model.slope))
    return (own.mapInArrow(_scorer(shared, text_col), schema)
            .withColumn("predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0)))
