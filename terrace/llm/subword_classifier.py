"""Supervised subword embeddings: a linear classifier over averaged hashed feature vectors.

A document's features are its words, its pairs of neighbouring words and the character
3-, 4- and 5-grams of its words (with word borders), each hashed into one of ``BUCKETS``
learned vectors. The document vector is their mean; a softmax over two classes reads it.
Training is plain stochastic gradient descent in numpy over a bounded sample of labelled
documents. For scoring, a bucket matters only through its vector's product with the
difference of the two class weights, so the model that travels to the executors is one
number per bucket.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import python_workers

BUCKETS = 1 << 17
GRAMS = (3, 4, 5)
_PRIME = np.uint32(16777619)


def _spread(h: np.ndarray) -> np.ndarray:
    """Bucket of each 32-bit hash, well mixed."""
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    h = (h ^ (h >> np.uint32(12))) * np.uint32(0x297A2D39)
    return (h ^ (h >> np.uint32(15))) & np.uint32(BUCKETS - 1)


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, document index) of every feature of all ``texts``, whole.

    One flat array of code points is hashed for all documents at once. A word is a run of
    characters other than ASCII white space; every word has a border on either side.
    """
    joined = "".join(f" {t} " for t in texts)
    chars = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    ends = np.cumsum([len(t) + 2 for t in texts])
    space = (chars == 32) | ((chars >= 9) & (chars <= 13))
    chars = np.where(space, np.uint32(32), chars)
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    begin, end = edge[0::2], edge[1::2]
    if not len(begin):
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    owner = np.searchsorted(ends, begin, side="right")
    # Words: a polynomial over the word's characters, by differences of running sums.
    powers = np.cumprod(np.full(len(chars), _PRIME, np.uint32), dtype=np.uint32)
    inverse = pow(int(_PRIME), -1, 1 << 32)
    back = np.cumprod(np.full(len(chars), inverse, np.uint32), dtype=np.uint32)
    run = np.cumsum((chars + np.uint32(1)) * powers, dtype=np.uint32)
    word = (run[end - 1] - run[begin - 1]) * back[begin]
    same = word[1:] == word[:-1]
    pair = np.where(same, np.uint32(77), word[1:] * np.uint32(0x85EBCA6B) + word[:-1])
    inside = owner[1:] == owner[:-1]
    out = [_spread(word + np.uint32(1)), _spread(pair[inside] + np.uint32(2))]
    docs = [owner, owner[1:][inside]]
    # n-grams over the word with its border on either side: windows without white space inside.
    owner_of = np.repeat(np.arange(len(texts)), [len(t) + 2 for t in texts])
    for n in GRAMS:
        windows = len(chars) - n + 1
        h = np.zeros(max(windows, 0), np.uint32)
        crossing = np.zeros(len(h), bool)
        for k in range(n):
            h = h * _PRIME + chars[k:k + len(h)]
            if 0 < k < n - 1:
                crossing |= space[k:k + len(h)]
        at = np.flatnonzero(~crossing)
        out.append(_spread(h[at] + np.uint32(n)))
        docs.append(owner_of[at])
    return np.concatenate(out), np.concatenate(docs)


@dataclass
class Classifier:
    """Score of class 1 from one weight per bucket and a bias."""

    weights: np.ndarray
    bias: float

    def score(self, texts: list[str]) -> np.ndarray:
        """Probability of class 1 for each text; an empty one scores by the bias alone."""
        out = np.full(len(texts), self.bias)
        # About a million characters at a time: memory does not grow with the batch.
        first = 0
        sizes = np.cumsum([len(t) for t in texts])
        while first < len(texts):
            base = sizes[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(sizes, base + 1_000_000)))
            buckets, docs = features(texts[first:last])
            count = np.bincount(docs, minlength=last - first)
            total = np.bincount(docs, self.weights[buckets], minlength=last - first)
            out[first:last] += total / np.maximum(count, 1)
            first = last
        return 1 / (1 + np.exp(-out))


def train(texts: list[str], labels: list[int], dim: int = 16, epochs: int = 8, rate: float = 0.4,
          seed: int = 7) -> Classifier:
    """Stochastic gradient descent on the softmax loss, one document at a time, with a rate
    that falls to zero. Same rows in the same order give the same model. Without labels of
    both classes the score is the (smoothed) share of class 1."""
    y = np.array(labels, np.int64)
    prior = (float(y.sum()) + 1) / (len(y) + 2)
    bias = float(np.log(prior / (1 - prior)))
    if len(y) == 0 or y.min() == y.max():
        return Classifier(np.zeros(BUCKETS, np.float32), bias)
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, (BUCKETS, dim)).astype(np.float32)
    weights = np.zeros((2, dim), np.float32)
    biases = np.array([np.log(1 - prior), np.log(prior)], np.float32)
    bags = []
    for text in texts:
        buckets, count = np.unique(features([text])[0], return_counts=True)
        bags.append((buckets.astype(np.int32), (count / max(1, count.sum())).astype(np.float32)))
    steps, done = epochs * len(bags), 0
    for _ in range(epochs):
        for k in rng.permutation(len(bags)):
            step = rate * (1 - done / steps)
            done += 1
            buckets, share = bags[k]
            if not len(buckets):
                continue
            hidden = share @ vectors[buckets]
            z = weights @ hidden + biases
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[k]] -= 1
            back = p @ weights
            weights -= step * np.outer(p, hidden)
            biases -= step * p * 0.1
            # A feature moves by the whole gradient for each time it occurs, four at most: one
            # word said a thousand times must not throw its vector off.
            vectors[buckets] -= step * np.minimum(share[:, None] * len(buckets), 4) * back
    return Classifier((vectors @ (weights[1] - weights[0])).astype(np.float32), float(biases[1] - biases[0]))


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 0 modulo 5; a NULL id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = 4000,
        seed: int = 7) -> Classifier:
    """Learn from at most ``sample`` labelled documents that are not held out.

    The sample is the ``sample`` labels with the smallest hash of the id, whatever the order
    or partitioning of the tables; its bound is what may be broadcast and brought into one task. Rows
    with a NULL label, id or text are left out; a repeated label is an example each time. Of
    documents that share an id the one with the smallest text is learned from.
    """
    picked = (labels.select(F.col("doc_id").alias("id"), F.col(label).cast("int").alias("y"))
              .where(F.col("y").isin(0, 1) & F.col("id").isNotNull() & ~held_out(F.col("id")))
              .orderBy(F.xxhash64("id", F.lit(seed)), "id", "y").limit(sample))
    python_workers(docs.sparkSession)
    # One text for each id: an id that many rows share must not grow the task that learns.
    texts = (docs.select(F.col("doc_id").alias("id"), "text").where(F.col("text").isNotNull())
             .join(F.broadcast(picked.select("id").distinct()), "id").groupBy("id").agg(F.min("text").alias("text")))
    rows = texts.join(F.broadcast(picked), "id").select(F.lit(1).alias("all"), "id", "y", "text")

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["id", "y", "text"], kind="stable")
        model = train(part["text"].tolist(), part["y"].tolist(), seed=seed)
        return pd.DataFrame({"weights": [model.weights.tobytes()], "bias": [model.bias]})

    # The bounded sample is learned from in one task; only the weights come to the driver.
    learned = rows.groupBy("all").applyInPandas(run, "weights binary, bias double").collect()
    if not learned:
        return train([], [], seed=seed)
    return Classifier(np.frombuffer(learned[0]["weights"], np.float32), learned[0]["bias"])


def score_column(model: Classifier, text: Column) -> Column:
    """The model's score of a text column (NULL scores as empty), as a double column."""
    weights, bias = model.weights, model.bias

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = Classifier(weights, bias)
        for batch in batches:
            yield pd.Series(own.score(["" if t is None else t for t in batch.tolist()]))

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "double")(text)


def classify(docs: DataFrame, model: Classifier, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs`` (doc_id, text).

    Only the text is scored, whole; labels, language, source and id are no inputs. Repeated
    rows are each scored, a NULL or empty text by the bias alone."""
    python_workers(docs.sparkSession, rows=1000)
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                         score_column(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
