"""The pipeline's near-duplicate stage: five-word shingles, similarity 0.8, against brute force."""

import random

import numpy as np
import pytest
from helpers import SCHEMA, clashing, odd_rows, words
from test_near_duplicates import chains, components

import corpus_pipeline
from terrace.llm import sketch_join


def brute(rows, length, least):
    sets = []
    for _, text, *_ in rows:
        w = (text or "").encode().lower().split()
        sets.append(frozenset(tuple(w[k:k + length]) for k in range(max(1, len(w) - length + 1))) if w else frozenset())
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0))
    links = [(i, j) for i in range(len(rows)) for j in range(i + 1, len(rows))
             for a, b in [(sets[order[i]], sets[order[j]])] if a and 100 * len(a & b) >= least * len(a | b)]
    comp = components(len(rows), links)
    return sorted(((rows[k][0], len(sets[k]), rows[order[comp[i]]][0]) for i, k in enumerate(order)), key=repr)


def edited(n=1000, edits=20):
    """A text, a copy with scattered edits (3 words and 0.9 keep both), and one too far."""
    text = words(n, 77, 50_000)
    out = [(0, " ".join(text), None, None, None)]
    for doc_id, times in ((1, edits), (2, n // 40 + 15)):
        copy = list(text)
        for k in range(times):
            copy[7 + k * (n - 20) // times] = f"edit{doc_id}n{k}"
        out.append((doc_id, " ".join(copy), None, None, None))
    return out


def test_stage_drops_copies_with_scattered_edits(spark, tmp_path):
    docs = spark.createDataFrame(edited(), SCHEMA)
    assert sketch_join.keep_one(docs, sketch_join.near_duplicates(docs)).count() == 3
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, str(tmp_path)).collect()) == [0, 2]


@pytest.mark.parametrize("rows", [odd_rows(), chains()], ids=["odd", "chains"])
def test_five_words_at_eight_tenths(spark, rows):
    near = sketch_join.near_duplicates(clashing(spark.createDataFrame(rows, SCHEMA)), 5, 80, 100)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in near.collect()), key=repr)
    assert got == brute(rows, 5, 80)


def test_buckets_meet_for_every_linked_pair():
    rng = random.Random(5)
    linked = full = 0
    for _ in range(600):
        a = [rng.getrandbits(64) for _ in range(rng.randrange(1, 400))]
        b = list(a)
        for _ in range(rng.randrange(0, 2 + len(a) // 6)):
            if rng.random() < 0.5 and len(b) > 1:
                b.pop(rng.randrange(len(b)))
            else:
                b.append(rng.getrandbits(64))
        x, y = (np.unique(np.array(s, np.uint64)) for s in (a, b))
        if sketch_join.links(x, y, 80, 100):
            linked += 1
            assert np.intersect1d(sketch_join.bucket_keys(x, 80, 100), sketch_join.bucket_keys(y, 80, 100)).size
            band, bits = sketch_join.bands(max(len(x), len(y)), 80, 100)[0]
            full += np.bitwise_count(sketch_join.sketch(x, bits) ^ sketch_join.sketch(y, bits)).sum() > len(np.setxor1d(x, y))
    assert linked > 300 and not full
