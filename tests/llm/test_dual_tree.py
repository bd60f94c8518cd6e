"""Dual-tree Lloyd against plain Lloyd in Python integers."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrace.llm import dual_tree

SCHEMA = "vec_id long, embedding array<double>, label int"
MOST = (1 << 63) - 1


def brute(rows, parts=16, entries=64, rounds=2):
    kept = [(i, [math.floor(256 * x) if abs(x) < 2.0 ** 60 else int(x) * 256 for x in v], label, v) for i, v, label in rows
            if v and all(x is not None and math.isfinite(x) for x in v) and len(v) % parts == 0]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, len(r[1])))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[3]))
    if not kept:
        return []
    width = len(kept[0][1]) // parts
    cut = [[v[p * width:(p + 1) * width] for p in range(parts)] for _, v, _, _ in kept]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def nearest(part, book):
        far = [sum((x - y) ** 2 for x, y in zip(part, e)) for e in book]
        return far.index(min(far)), min(far)

    for _ in range(rounds):
        for p in range(parts):
            mine = [[] for _ in books[p]]
            for c in cut:
                mine[nearest(c[p], books[p])[0]].append(c[p])
            books[p] = [[sum(x) // len(m) for x in zip(*m)] if m else e for m, e in zip(mine, books[p])]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    coded = [[nearest(c[p], books[p]) for p in range(parts)] for c in cut]
    error = [min(sum(d for _, d in c), MOST) for c in coded]
    of_label = {}
    for (_, _, label, _), e in zip(kept, error):
        of_label[label] = min(of_label.get(label, 0) + e, MOST)
    return sorted(((i, "".join(f"{e:02x}" for e, _ in c), x, of_label[label], digest)
                   for (i, _, label, _), c, x in zip(kept, coded, error)), key=repr)


def vectors(n, dim, seed, spread=1.0):
    rng = random.Random(seed)
    centres = [[rng.uniform(-1, 1) for _ in range(dim)] for _ in range(9)]
    return [[x + rng.gauss(0, 0.02 * spread) for x in rng.choice(centres)] for _ in range(n)]


def odd_rows():
    rows = [(k, v, [0, 1, None, 7][k % 4]) for k, v in enumerate(vectors(300, 32, 5))]
    nan, inf = float("nan"), float("inf")
    rows += [(1000, None, 1), (1001, [], 1), (1002, [nan] + [0.0] * 31, 1), (1003, [inf] + [0.0] * 31, None),
             (1004, [None] + [0.0] * 31, 1), (1005, [0.0] * 31, 1), (1006, [0.0] * 16, 1), (1007, [0.0] * 32, 1),
             (None, [0.5] * 32, None), (None, [0.25] * 32, 3), (4, [-1.0] * 32, 2), (4, rows[4][1], rows[4][2])]
    return rows


def result(out):
    assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted((tuple(r) for r in out.collect()), key=repr)


def test_odd_vectors_against_plain_lloyd(spark):
    rows = odd_rows()
    table = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("vector", "code", "error", "of_label")})
    assert result(dual_tree.compress(table.repartition(5))) == brute(rows)


def test_single_precision_and_other_shapes(spark):
    rows = [(k, v, k % 3) for k, v in enumerate(vectors(500, 24, 6, 4))]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    single = [(i, [float(np.float32(x)) for x in v], label) for i, v, label in rows]
    assert result(dual_tree.compress(table, parts=8, entries=17, rounds=3)) == brute(single, 8, 17, 3)


def test_fewer_rows_than_entries_ties_and_repeats(spark):
    rows = [(k, [float(k % 3)] * 16, 1) for k in range(20)]
    assert result(dual_tree.compress(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_huge_components(spark):
    rows = odd_rows()[:80] + [(500 + k, [(-1.0) ** k * 10.0 ** (3 * k)] * 32, k % 2) for k in range(20)]
    rows += [(600, [1e300] * 32, 5), (2, [-1e300, 1.0] * 16, 5)]
    assert result(dual_tree.compress(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_empty_tables(spark):
    for rows in ([], [(1, None, 1), (2, [], None)]):
        assert result(dual_tree.compress(spark.createDataFrame(rows, SCHEMA))) == []


@pytest.mark.parametrize("leaf", [1, 4, 8])
def test_assignment_equals_all_distances(leaf):
    rng = np.random.default_rng(leaf)
    for trial in range(120):
        n, k, w = (int(rng.integers(1, m)) for m in (300, 65, 5))
        high = int(rng.choice([2, 5, 100, 100_000]))
        points, entries = rng.integers(-high, high + 1, (n, w)), rng.integers(-high, high + 1, (k, w))
        if trial % 3 == 0:
            entries = entries[rng.integers(0, k, k)]
        if trial % 5 == 0:
            points, entries = points.astype(object), entries.astype(object)
        far = ((points[:, None] - entries[None]) ** 2).sum(2)
        want = np.array([min(range(k), key=lambda e: (row[e], e)) for row in far])
        codes, sums, counts = dual_tree.assign(points, entries, leaf)
        assert (codes == want).all() and (counts == np.bincount(want, minlength=k)).all()
        assert all((sums[e] == points[want == e].sum(0)).all() for e in range(k))


def test_whole_nodes_and_dropped_pairs():
    rng = np.random.default_rng(2)
    centres = rng.integers(-100_000, 100_000, (64, 4))
    points = centres[rng.integers(0, 64, 20_000)] + rng.integers(-5, 6, (20_000, 4))
    stats = {}
    dual_tree.assign(points, centres, stats=stats)
    assert stats["whole"] > 15_000 and stats.get("pairs", 0) < 20_000 * 64 / 50


def test_digits_add_up():
    for value in (0, 5, -5, 1 << 31, -(1 << 40), (1 << 62) + 3, -(1 << 70), 3 ** 300, -(3 ** 300)):
        digits = dual_tree._limbs(value)
        assert sum(d << (31 * k) for k, d in enumerate(digits)) == value and all(abs(d) <= 1 << 31 for d in digits)
