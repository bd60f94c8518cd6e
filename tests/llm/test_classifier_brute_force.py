"""The quality classifier against a plain one: features, scores and training, one at a time."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from helpers import documents, odd_rows, words

from terrace.llm import subword_classifier as sc

MASK = 2**32 - 1
PRIME = 16777619


def bucket(h):
    h &= MASK
    h = ((h ^ (h >> 15)) * 0x2C1B3C6D) & MASK
    h = ((h ^ (h >> 12)) * 0x297A2D39) & MASK
    return (h ^ (h >> 15)) & (sc.BUCKETS - 1)


def plain_features(text):
    """Buckets of the words, neighbouring words and 3- to 5-grams of bordered words of a text."""
    found = "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text).split(" ")
    found = [w for w in found if w]
    hashes = [sum((ord(c) + 1) * pow(PRIME, k, 2**32) for k, c in enumerate(w)) & MASK for w in found]
    out = [bucket(h + 1) for h in hashes]
    out += [bucket((77 if a == b else b * 0x85EBCA6B + a) + 2) for a, b in zip(hashes, hashes[1:])]
    for w in found:
        bordered = f" {w} "
        for n in (3, 4, 5):
            for k in range(len(bordered) - n + 1):
                h = 0
                for c in bordered[k:k + n]:
                    h = (h * PRIME + ord(c)) & MASK
                out.append(bucket(h + n))
    return out


def plain_score(text, weights, bias):
    found = plain_features(text)
    total = bias + (sum(float(weights[b]) for b in found) / len(found) if found else 0.0)
    return 1 / (1 + math.exp(-total))


def plain_train(texts, labels, dim, epochs, rate, seed):
    """The same steepest descent, number by number in double precision."""
    prior = (sum(labels) + 1) / (len(labels) + 2)
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, (sc.BUCKETS, dim)).astype(np.float32).astype(float)
    weights, biases = [[0.0] * dim, [0.0] * dim], [math.log(1 - prior), math.log(prior)]
    bags = [Counter(plain_features(t)) for t in texts]
    done, steps = 0, epochs * len(bags)
    for _ in range(epochs):
        for k in rng.permutation(len(bags)):
            step = rate * (1 - done / steps)
            done += 1
            count = sum(bags[k].values())
            if not count:
                continue
            hidden = [sum(n / count * vectors[b][d] for b, n in bags[k].items()) for d in range(dim)]
            z = [sum(w * h for w, h in zip(weights[c], hidden)) + biases[c] for c in (0, 1)]
            e = [math.exp(x - max(z)) for x in z]
            error = [x / sum(e) - (c == labels[k]) for c, x in enumerate(e)]
            back = [sum(error[c] * weights[c][d] for c in (0, 1)) for d in range(dim)]
            for c in (0, 1):
                weights[c] = [w - step * error[c] * h for w, h in zip(weights[c], hidden)]
                biases[c] -= step * error[c] * 0.1
            for b, n in bags[k].items():
                times = min(n / count * len(bags[k]), 4)
                vectors[b] -= step * times * np.array(back)
    return vectors @ (np.array(weights[1]) - np.array(weights[0])), biases[1] - biases[0]


def texts_of(n):
    rng = random.Random(n)
    return [r[1] or "" for r in odd_rows() if len(r[1] or "") < 3000] + [
        "".join(rng.choice("ab é日😀\t\n\x0b\x0c\r\x1c\u2003.!") for _ in range(rng.randrange(40))) for _ in range(n)]


def test_features_are_those_of_a_plain_loop():
    texts = texts_of(300)
    buckets, owner = sc.features(texts)
    got = [[] for _ in texts]
    for b, k in zip(buckets.tolist(), owner.tolist()):
        got[k].append(b)
    assert [sorted(x) for x in got] == [sorted(plain_features(t)) for t in texts]


def test_scores_are_those_of_a_plain_loop(spark):
    weights = np.random.default_rng(1).normal(size=sc.BUCKETS).astype(np.float32)
    texts = texts_of(60)
    docs = documents(spark, [(k, t, None, None, None) for k, t in enumerate(texts)] + [(-1, None, None, None, None)])
    got = {r.doc_id: r.score for r in sc.classify(docs, sc.Classifier(weights, -0.7)).collect()}
    assert len(got) == len(texts) + 1 and got[-1] == pytest.approx(plain_score("", weights, -0.7), abs=1e-9)
    for k, t in enumerate(texts):
        assert got[k] == pytest.approx(plain_score(t, weights, -0.7), abs=1e-9)


def test_training_is_that_of_a_plain_loop():
    texts = [" ".join(words(12, k)) if k % 3 else "?? ".join(words(9, k)).upper() for k in range(60)] + ["", "z"]
    labels = [int(k % 3 > 0) for k in range(60)] + [1, 0]
    model = sc.train(texts, labels, dim=4, epochs=3, rate=0.4, seed=5)
    weights, bias = plain_train(texts, labels, 4, 3, 0.4, 5)
    assert model.bias == pytest.approx(bias, abs=1e-3)
    assert np.abs(model.weights - weights).max() < 1e-3 < np.abs(weights).max()
    for t in texts + ["never seen", "W1 ?? W2"]:
        assert model.score([t])[0] == pytest.approx(plain_score(t, weights, bias), abs=1e-3)
