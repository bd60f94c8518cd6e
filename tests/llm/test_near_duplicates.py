"""Vector and shingle near-duplicates and line dedup against brute force."""

import random

import numpy as np
import pytest
from helpers import SCHEMA, clashing, documents, odd_rows, rows_of, words

from pyspark.sql import functions as F

from terrace.llm import line_suffix, pivot_neardup, sketch_join
from terrace.llm.common import connected_components


def components(n, links):
    up = list(range(n))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return [top(k) for k in range(n)]


def test_connected_components(spark):
    rng = random.Random(1)
    links = [(k, k + 1) for k in range(100, 140)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(7, 7)]
    got = dict(rows_of(connected_components(spark.createDataFrame(links, "u long, v long")), "node", "root"))
    want = components(200, links)
    nodes = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: want[x] for x in nodes}
    assert connected_components(spark.createDataFrame([], "u long, v long")).collect() == []


# vectors

VECTORS = "vec_id long, embedding array<float>, label int, cid string, near int, rank int"


def vector_rows():
    rng = np.random.default_rng(5)
    rows = []
    for k in range(150):
        v = rng.normal(size=16)
        rows.append((k, v.tolist(), int(rng.integers(0, 3))))
        for m in range(int(rng.integers(0, 3))):
            noise = rng.normal(size=16) * rng.choice([0.02, 0.1, 0.18])
            rows.append((1000 + 10 * k + m, (v * rng.choice([0.01, 1, 50]) + noise * np.abs(v).max()).tolist(), rows[-1][2]))
    dense = rng.normal(size=16)
    rows += [(5000 + k, (dense + rng.normal(size=16) * 0.03).tolist(), 1) for k in range(80)]
    rows += [(6000 + k, dense.tolist(), 1) for k in range(20)]
    rows += [(7000, None, 1), (7001, [], 1), (7002, [0.0] * 16, 1), (7003, [float("nan")] + [1.0] * 15, 1),
             (7004, [float("inf")] + [1.0] * 15, 1), (7005, [None] + [1.0] * 15, 1), (7006, dense.tolist(), None),
             (None, dense.tolist(), 1), (7007, dense.tolist()[:8], 1), (7008, dense.tolist()[:8], 1),
             (7009, (dense * 1e30).tolist(), 1), (7010, [3.0], 1), (7011, [5.0], 1), (7012, [-5.0], 1),
             (7013, dense.tolist(), 2), (7013, dense.tolist(), 2)]
    return [r + ("x", 1, 1) for r in rows]


def brute_vectors(rows, least=0.98):
    def good(v):
        return v and all(x is not None and np.isfinite(np.float32(x)) for x in v) and any(np.float32(x) != 0 for x in v)

    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0]))
    links, direct = [], [0] * len(rows)
    for i, a in enumerate(order):
        for j in range(i + 1, len(order)):
            (ia, va, la, *_), (ib, vb, lb, *_) = rows[a], rows[order[j]]
            if ia is None or ib is None or la is None or la != lb or not good(va) or not good(vb) or len(va) != len(vb):
                continue
            x, y = (np.array(v, np.float32).astype(float) for v in (va, vb))
            x, y = x / np.abs(x).max(), y / np.abs(y).max()
            if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= least:
                links.append((i, j))
                direct[a] += 1
                direct[order[j]] += 1
    comp = components(len(rows), links)
    out = []
    for i, a in enumerate(order):
        vec_id, low = rows[a][0], rows[order[comp[i]]][0]
        out.append((vec_id, direct[a], low, vec_id is not None and vec_id == low))
    return sorted(out, key=repr)


@pytest.mark.parametrize("list_rows", [1024, 7])
def test_vector_near_duplicates(spark, list_rows):
    rows = vector_rows()
    out = pivot_neardup.near_duplicates(spark.createDataFrame(rows, VECTORS), list_rows=list_rows)
    assert rows_of(out, "vec_id", "n_links", "component_id", "kept") == brute_vectors(rows)


def test_vector_near_duplicates_of_nothing(spark):
    for rows in ([], [(1, None, 1, "x", 1, 1)]):
        out = pivot_neardup.near_duplicates(spark.createDataFrame(rows, VECTORS)).collect()
        assert [(r.vec_id, r.n_links, r.component_id, r.kept) for r in out] == [(1, 0, 1, True)] * len(rows)


def test_pivot_recall_at_the_threshold():
    """Pairs exactly at cosine 0.98 share enough pivots, by brute force over 4000 pairs."""
    rng = np.random.default_rng(1)
    u = rng.normal(size=(4000, 64))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    w = rng.normal(size=u.shape)
    w -= (w * u).sum(1, keepdims=True) * u
    v = 0.98 * u + np.sqrt(1 - 0.98**2) * w / np.linalg.norm(w, axis=1, keepdims=True)
    points = pivot_neardup._pivots(64, np.zeros((0, 64)), pivot_neardup.PIVOTS, 11)
    a, b = (pivot_neardup._nearest(x, points, pivot_neardup.NEAREST) for x in (u, v))
    shared = (a[:, :, None] == b[:, None, :]).any(2).sum(1)
    assert (shared >= pivot_neardup.SHARED).mean() > 0.999


# shingles

def brute_shingles(rows):
    sets = []
    for _, text, *_ in rows:
        w = (text or "").encode().lower().split()
        sets.append(frozenset(tuple(w[k:k + 3]) for k in range(max(1, len(w) - 2))) if w else frozenset())
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0))
    links = [(i, j) for i in range(len(rows)) for j in range(i + 1, len(rows))
             for a, b in [(sets[order[i]], sets[order[j]])] if a and 100 * len(a & b) >= 90 * len(a | b)]
    comp = components(len(rows), links)
    return sorted(((rows[k][0], len(sets[k]), rows[order[comp[i]]][0]) for i, k in enumerate(order)), key=repr)


def chains():
    """Chains of documents of which only neighbours link, and sizes around the band edges."""
    rows, doc_id = [], 0
    for chain in range(6):
        text = words(150 + 40 * chain, 50 + chain, 10_000)
        for step in range(8):
            text = list(text)
            for k in range(2):
                text[(17 * step + 40 * k) % len(text)] = f"c{chain}s{step}k{k}"
            rows.append((doc_id, " ".join(text), None, None, None))
            doc_id += 1
    for n in range(1, 45):
        text = words(n, 900 + n, 10_000)
        rows.append((doc_id, " ".join(text), None, None, None))
        rows.append((doc_id + 1, " ".join(text + ["more"]), None, None, None))
        doc_id += 2
    return rows


@pytest.mark.parametrize("rows", [odd_rows(), chains()], ids=["odd", "chains"])
def test_shingle_near_duplicates(spark, rows):
    docs = clashing(spark.createDataFrame(rows, SCHEMA))
    near = sketch_join.near_duplicates(docs)
    assert rows_of(near, "doc_id", "n_shingles", "component_id") == brute_shingles(rows)
    kept = sketch_join.keep_one(docs, near)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect() if r.text and r.text.split()]
    assert sorted(i for i in ids if i is not None) == sorted({c for i, n, c in brute_shingles(rows) if n and c is not None})


def test_tiles_give_a_forest_of_all_that_may_link(spark):
    """Of a chain of near documents every neighbour pair is needed, also across chunks; pairs of
    one component stay out, and of groups in parts only smaller ones are compared."""
    texts = {k: r[1] for k, r in enumerate(chains()[:8])}
    rows = []
    for k, text in texts.items():
        own = sketch_join.shingles(text)
        plan = sketch_join.bands(len(own))
        rows.append((k, 0, 0, len(own), [b for b, _ in plan], [sketch_join.sketch(own, n).view(np.int64).tolist() for _, n in plan]))
    nodes = spark.createDataFrame(rows, "fp long, k1 long, k2 long, n_shingles long, bands array<int>, words array<array<long>>")
    members = spark.createDataFrame([(1, 0, k, k, True) for k in texts] + [(2, 0, k, 0 if k <= 4 else k, k > 4) for k in texts],
                                    "lead long, was long, fp long, root long, minor boolean")
    with_text = spark.createDataFrame(list(texts.items()), "fp long, text string")
    for chunk_rows in (1024, 3):
        sketch_join.CHUNK_ROWS, old = chunk_rows, sketch_join.CHUNK_ROWS
        try:
            for extra in (False, True):
                for lead, want in ((1, {(k + 1, k) for k in range(7)}), (2, {(5, 4), (6, 5), (7, 6)})):
                    tiles = sketch_join.cut_into_tiles(members.where(F.col("lead") == lead), nodes)
                    tiles = tiles.join(with_text, "fp") if extra else tiles
                    assert want <= set(rows_of(sketch_join.compare_groups(tiles, 2), "u", "v")), (chunk_rows, extra, lead)
        finally:
            sketch_join.CHUNK_ROWS = old


def test_refuted_links_send_groups_round_again(spark, monkeypatch):
    """With sketches that rule nothing out in the first round, texts refute most of its links."""
    real = sketch_join._near

    def blind(tile, across):
        left, right = np.triu_indices(len(tile), 1)
        return (left, right) if "text" not in tile.columns else real(tile, across)

    monkeypatch.setattr(sketch_join, "_near", blind)
    rows = odd_rows()
    got = rows_of(sketch_join.near_duplicates(spark.createDataFrame(rows, SCHEMA)), "doc_id", "n_shingles", "component_id")
    assert got == brute_shingles(rows)


def test_sketches_meet_for_every_linked_pair():
    rng = random.Random(4)
    for _ in range(150):
        n = rng.randrange(1, 400)
        a = [rng.getrandbits(64) for _ in range(n)]
        b = list(a)
        for _ in range(rng.randrange(0, 2 + n // 12)):
            if rng.random() < 0.5 and len(b) > 1:
                b.pop(rng.randrange(len(b)))
            else:
                b.append(rng.getrandbits(64))
        x, y = (np.unique(np.array(s, np.uint64)) for s in (a, b))
        if sketch_join.links(x, y):
            plans = [dict(sketch_join.bands(len(s))) for s in (x, y)]
            band, words = sketch_join.bands(max(len(x), len(y)))[0]
            assert band in plans[0] and band in plans[1]
            p, q = sketch_join.sketch(x, words), sketch_join.sketch(y, words)
            assert (p == q).any()
            assert np.bitwise_count(p ^ q).sum() <= len(np.setxor1d(x, y)) <= sketch_join.allowed_difference(len(x) + len(y))


def test_shingle_near_duplicates_of_nothing(spark):
    assert sketch_join.near_duplicates(documents(spark, [])).collect() == []


# lines

def brute_lines(rows, min_words):
    """Later copies of every run of lines with at least ``min_words`` words, of any length."""
    docs = sorted({(i is None, i or 0, t) for i, t, *_ in rows if t is not None}, key=repr)
    docs.sort(key=lambda d: (d[0], d[1]))
    seen, gone = set(), {}
    for place, (none, doc_id, text) in enumerate(docs):
        lines = [(k, x) for k, x in enumerate(text.split("\n")) if x.encode().split()]
        cut = set()
        for a in range(len(lines)):
            for b in range(a, len(lines)):
                run = tuple(x for _, x in lines[a:b + 1])
                size = [len(x.encode().split()) for x in run]
                if sum(size) >= min_words:
                    if run in seen:
                        cut |= {k for k, _ in lines[a:b + 1]}
                        if min(sum(size[1:]), sum(size[:-1])) < min_words:  # lines without a word go with shortest runs
                            cut |= set(range(lines[a][0], lines[b][0] + 1))
                    seen.add(run)
        gone[(none, doc_id, text)] = cut
    out = []
    for i, t, *_ in rows:
        if t is None:
            out.append((i, None, 0, 0))
        else:
            cut, lines = gone[(i is None, i or 0, t)], t.split("\n")
            out.append((i, "\n".join(x for k, x in enumerate(lines) if k not in cut), len(lines), len(cut)))
    return sorted(out, key=repr)


def line_rows():
    rng = random.Random(8)
    pool = [" ".join(words(rng.randrange(1, 9), k)) for k in range(25)]
    rows = []
    for k in range(60):
        lines = [rng.choice(pool) if rng.random() < 0.8 else f"own {k} {n}" for n in range(rng.randrange(1, 30))]
        if k % 4 == 0:
            at = rng.randrange(len(lines) + 1)
            lines[at:at] = pool[:9]
        if k % 7 == 0:
            lines.insert(len(lines) // 2, "  ")
        rows.append((k, "\n".join(lines), None, "s", 1))
    rows += [(100, "same line\n" * 40, None, None, 1), (101, None, None, None, None), (102, "", None, None, None),
             (103, "\n\n \n", None, None, None), (3, rows[3][1], "again", None, None), (None, rows[4][1], None, None, None)]
    return rows


@pytest.mark.parametrize("min_words", [1, 12, 50])
def test_line_dedup(spark, min_words):
    rows = line_rows()
    docs = clashing(spark.createDataFrame(rows, SCHEMA))
    out = line_suffix.delete_repeats(docs, min_words)
    assert out.columns[:len(docs.columns)] == docs.columns
    n_lines, n_deleted = out.columns[-2:]
    got = sorted(((r["doc_id"], r["text"], r[n_lines], r[n_deleted]) for r in out.collect()), key=repr)
    assert got == brute_lines(rows, min_words)


def test_line_dedup_keeps_every_line_once_and_clean_documents_whole(spark):
    rows = line_rows()
    out = line_suffix.delete_repeats(spark.createDataFrame(rows, SCHEMA), 12).collect()
    before = {x for _, t, *_ in rows if t for x in t.split("\n") if x.strip()}
    assert before == {x for r in out if r.text for x in r.text.split("\n") if x.strip()}


def test_line_dedup_of_odd_documents_and_of_nothing(spark):
    got = line_suffix.delete_repeats(documents(spark), 50)
    assert sorted(((r.doc_id, r.text, r.n_lines, r.n_deleted) for r in got.collect()), key=repr) == brute_lines(odd_rows(), 50)
    assert line_suffix.delete_repeats(documents(spark, []), 50).collect() == []
