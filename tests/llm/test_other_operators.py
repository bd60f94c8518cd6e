"""Sharding, mixing, url filter, vector search and classifier against brute force."""

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import clashing, documents, odd_rows, rows_of, words
from pyspark.sql import functions as F

from terrace.llm import cube_mix, hash_tree, host_trust, one_bit_ann, subword_classifier
from terrace.llm.numbering import number_within


def test_numbers_within_groups(spark):
    rows = [(k % 3 if k % 5 else None, k * 7 % 50, "x") for k in range(300)]
    out = number_within(spark.createDataFrame(rows, "g long, v long, at string"), ["g"], ["v"], "n").collect()
    by = defaultdict(list)
    for r in out:
        by[r.g].append((r.n, r.v))
    for group, got in by.items():
        assert sorted(n for n, _ in got) == list(range(len(got)))
        assert [v for _, v in sorted(got)] == sorted(v for g, v, _ in rows if g == group)


# sharding

def brute_shard(doc_id, tree):
    key = "null" if doc_id is None else str(doc_id)

    def draw(name, weight):
        return -math.log((int(hashlib.md5(f"{key}:{name}".encode()).hexdigest()[:13], 16) + 1) / 2.0**52) / weight

    def best(shards, level, name):
        groups = defaultdict(list)
        for s in shards:
            groups[level(s)].append(s)
        return groups[min(groups, key=lambda g: (draw(name(groups[g][0]), sum(s.weight for s in groups[g])), g))]

    shards = best(tree, lambda s: s.region, lambda s: f"region {s.region}")
    shards = best(shards, lambda s: s.rack, lambda s: f"rack {s.region}/{s.rack}")
    return best(shards, lambda s: s.shard, lambda s: f"shard {s.shard}")[0].shard


def test_shards_match_brute_force_on_odd_rows(spark):
    out = hash_tree.assign(clashing(documents(spark)), 24).collect()
    want = sorted(((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode()), brute_shard(i, hash_tree.topology(24)),
                    brute_shard(i, hash_tree.topology(25))) for i, t, *_ in odd_rows()), key=repr)
    assert sorted(((r.doc_id, r["size"], r.text_crc32, r.shard, r.grown_shard) for r in out), key=repr) == want
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
        assert r.law == "key"
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert hash_tree.assign(documents(spark, [])).collect() == []


def test_one_more_shard_takes_rows_only_into_itself():
    for n in range(1, 41):
        # The tree of one more shard keeps the base that the tree of n has.
        before, after = hash_tree.topology(n), hash_tree.topology(n + 1, 24 if n >= 24 else 0)
        moved = [(a, b) for k in range(1500 if n < 6 or n > 22 else 400) for a, b in [(brute_shard(k, before), brute_shard(k, after))] if a != b]
        assert moved and {b for _, b in moved} == {n}


@pytest.mark.parametrize("n", [10, 20, 23])
def test_the_law_holds_for_fewer_shards_than_a_base(spark, n):
    df = spark.range(1500).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    rows = hash_tree.assign(df, n).collect()
    assert {r.shard for r in rows} == set(range(n)) and all(r.grown_shard in (r.shard, n) for r in rows)
    grown = {r.doc_id: r.shard for r in hash_tree.assign(df, n + 1, base=0).collect()}
    assert all(grown[r.doc_id] == r.grown_shard for r in rows)


def test_weights_are_followed_and_movement_stays_in_the_subtrees():
    tree = hash_tree.topology(24)
    counts = Counter(brute_shard(k, tree) for k in range(6000))
    assert len(counts) == 24 and max(abs(c - 250) for c in counts.values()) < 80
    heavier = [hash_tree.Shard(s.shard, s.region, s.rack, 3.0 if s.shard == 5 else 1.0) for s in tree]
    where = {s.shard: (s.region, s.rack) for s in tree}
    for k in range(3000):
        a, b = brute_shard(k, tree), brute_shard(k, heavier)
        if a != b:
            assert where[b][0] == where[5][0]  # into the region that grew
            if where[a][0] == where[5][0]:
                assert where[b] == where[5]  # inside it, into the rack that grew
                if where[a] == where[5]:
                    assert b == 5  # inside that, into the shard that grew


# mixing

def brute_targets(sizes, weights=(3, 1, 2)):
    sources = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[k % 3] for k, s in enumerate(sources)}
    target, rest, open_ = dict.fromkeys(sources, 0.0), 1.5 * sum(sizes.values()), set(sources)
    while rest > 1e-9 and open_:
        total = sum(w[s] for s in open_)
        for s in open_:
            target[s] += rest * w[s] / total
        rest = 0.0
        for s in list(open_):
            if target[s] >= 2 * sizes[s]:
                rest += target[s] - 2 * sizes[s]
                target[s] = 2.0 * sizes[s]
                open_.discard(s)
    return target


def test_flight_keeps_words_and_documents():
    rng = np.random.default_rng(1)
    for n, equal in itertools.product((1, 2, 3, 50, 700), (False, True)):
        size = np.full(n, 7.0) if equal else rng.integers(1, 300, n).astype(float)
        p = np.full(n, 0.37)
        q = cube_mix.flight(p, size, rng)
        assert ((q >= 0) & (q <= 1)).all() and ((q > 0) & (q < 1)).sum() <= 2
        assert abs(q.sum() - p.sum()) < 1e-6 and abs(q @ size - p @ size) < 1e-4
        done = cube_mix.landing(q, size)
        assert set(done) <= {0.0, 1.0} and abs(done @ size - p @ size) <= size.max()


def test_inclusion_follows_the_probabilities():
    size = np.arange(1.0, 31.0)
    taken = sum(cube_mix.flight(np.full(30, 0.4), size, np.random.default_rng(k)) for k in range(800)) / 800
    assert np.abs(taken - 0.4).max() < 0.08


@pytest.mark.parametrize("block_rows", [8192, 16])
def test_mix_of_odd_documents(spark, block_rows, monkeypatch):
    rows = odd_rows() + [(20_000 + k, " ".join(words(1 + k % 90, k)), "en", f"s{k % 5}", None) for k in range(600)]
    docs = clashing(documents(spark, rows))
    monkeypatch.setattr(cube_mix.take, "__defaults__", (block_rows, 5))
    out = cube_mix.mix(docs).collect()
    again = cube_mix.mix(docs.repartition(7)).collect()
    key = lambda r: repr((r.doc_id, r["size"], r.source_size, r.target, r.taken))
    assert sorted(map(key, out)) == sorted(map(key, again))
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, *_ in rows]
    assert sorted(((r.doc_id, r["size"]) for r in out), key=repr) == sorted(((r[0], n) for r, n in zip(rows, size)), key=repr)
    total = Counter()
    for r, n in zip(rows, size):
        total[r[3]] += n
    target = brute_targets(total)
    taken, largest = Counter(), Counter()
    for r in out:
        assert r.taken in (0, r["size"], 2 * r["size"])
        source = next(s for s in total if total[s] == r.source_size and abs(target[s] - r.target) < 1e-6 * (1 + target[s]))
        taken[source] += r.taken
        largest[source] = max(largest[source], r["size"])
    for s in total:
        assert abs(taken[s] - target[s]) <= largest[s] / 2 + 1, (s, taken[s], target[s])
    assert cube_mix.mix(documents(spark, [])).collect() == []


def test_mixed_documents_repeat_whole_rows(spark):
    docs = clashing(documents(spark))
    out = cube_mix.mixed_documents(docs)
    assert out.columns == docs.columns
    words_in, counts = Counter(), Counter()
    for r in docs.collect():
        words_in[r.source] += len((r.text or "").split())
    taken = Counter()
    for r in out.collect():
        counts[(r.doc_id, r.text)] += 1
        taken[r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
    stored = Counter((r[0], r[1]) for r in odd_rows())
    assert all(n <= 2 * stored[k] for k, n in counts.items())
    assert sum(taken.values()) > sum(words_in.values())


def test_mixed_documents_do_not_depend_on_partitions(spark):
    rows = odd_rows() + [(None, "same words here", "en", "a", 1)] * 40 + [(5000 + k, f"w{k} " * (k % 40 + 1), "en", f"s{k % 3}", k) for k in range(900)]
    docs = documents(spark, rows)
    out = [Counter(map(tuple, cube_mix.mixed_documents(docs.repartition(n)).collect())) for n in (3, 5)]
    assert out[0] == out[1] and sum(out[0].values()) > len(rows)


# urls

PAGES = "page_id long, url string, html string, host string, verdict string, rule string"


def page_rows():
    link = '<a href="http://{}/x">l</a>'
    urls = {1: "http://A.Example.NET/en/1?q", 2: "https://x.net", 3: "https://x.net/", 4: "ftp://sub.example.com/de/", 5: "http://example.com/den",
            6: "http://f.org/fr/a#b", 7: "http://notnet/x", 8: "no scheme", 9: None, 10: "http://", 11: "a://b://c/d", 12: "http://h?x#y",
            13: "http://example.net/en/", 14: "http://anexample.com/de/"}
    rows = [(k, u, None, "x", "y", "z") for k, u in urls.items()] + [(3, urls[3], None, "x", "y", "z")]
    # A farm that links to blocked hosts, its friend, and a good site that good hosts link to.
    for k in range(5):
        rows.append((100 + k, f"http://bad{k}.net/p", link.format("farm.com"), "", "", ""))
        rows.append((110 + k, f"http://farm.com/{k}", link.format(f"bad{k}.net") + "<img src='//BAD0.net/i'>", "", "", ""))
        rows.append((120 + k, f"http://good{k}.org/fr/1", link.format("praised.com") + '<a href="/own">', "", "", ""))
        rows.append((130 + k, f"http://praised.com/{k}", link.format("praised.com"), "", "", ""))
        rows.append((140 + k, f"http://quiet.com/{k}", "", "", "", ""))
    return rows


def brute_pages(rows, threshold=0.5, rounds=300):
    pages, edges = [], set()
    for page_id, url, html, *_ in rows:
        m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (m[1].translate({c: c + 32 for c in range(65, 91)}), m[2]) if m else ("", "")
        fits = [(len(h + p), h + p, v) for v, h, p in host_trust.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        pages.append((page_id, host, path, *(max(fits)[1:] if fits else (None, None))))
        for x in re.findall(r"""(?i)(?:href|src)\s*=\s*["']?\s*(?:[a-z][a-z0-9+.\-]*:)?//([^/?#"'\s<>]+)""", html or ""):
            if host and x.lower() != host:
                edges.add((host, x.lower()))
    hosts = {h for _, h, *_ in pages if h} | {h for e in edges for h in e}
    n = Counter(h for _, h, *_ in pages)
    seeds = {v: [h for h in hosts if 2 * sum(p[1] == h and p[4] == v for p in pages) > n[h]] for v in ("allow", "block")}
    rank = {}
    for v, flow in (("allow", edges), ("block", {(b, a) for a, b in edges})):
        seed = {h: (h in seeds[v]) / max(1, len(seeds[v])) for h in hosts}
        out, r = Counter(a for a, _ in flow), dict(seed)
        for _ in range(rounds):
            held = sum(r[h] for h in hosts if not out[h])
            new = {h: (0.15 + 0.85 * held) * seed[h] for h in hosts}
            for a, b in flow:
                new[b] += 0.85 * r[a] / out[a]
            r = new
        rank[v] = r
    blocked = {h for h in hosts if rank["block"][h] > rank["allow"][h] and rank["block"][h] * len(hosts) >= threshold}
    return sorted(((i, h, p, r, v or ("block" if h in blocked else "allow")) for i, h, p, r, v in pages), key=repr)


def test_pages_are_judged_by_rules_then_by_the_graph(spark):
    rows = page_rows()
    got = rows_of(host_trust.judge(spark.createDataFrame(rows, PAGES)), "page_id", "host", "path", "rule", "verdict")
    assert got == brute_pages(rows)
    verdict = {i: v for i, _, _, _, v in got}
    assert verdict[110] == "block" and verdict[130] == verdict[140] == "allow"  # the farm, the praised, the quiet
    assert (verdict[1], verdict[2], verdict[3], verdict[4], verdict[5], verdict[6]) == ("allow", "block", "block", "block", "allow", "allow")
    assert host_trust.judge(spark.createDataFrame([], PAGES)).collect() == []


def test_trust_and_distrust_reach_the_ends_of_a_long_chain(spark):
    n = 60
    names = ["fine.org", *[f"h{k}.example.biz" for k in range(1, n - 1)], "bad.net"]
    rows = [(k, f"https://{h}/" + ("fr/x" if k == 0 else "p"), f'<a href="https://{names[k + 1]}/p">n</a>' if k + 1 < n else "")
            for k, h in enumerate(names)]
    out = host_trust.judge(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = rows_of(out, "page_id", "host", "path", "rule", "verdict")
    assert got == brute_pages(rows, rounds=100)
    ranks = {r.page_id: (r.trust, r.distrust) for r in out.collect()}
    assert 0 < ranks[n - 1][0] == pytest.approx(ranks[0][0] * 0.85 ** 59, rel=1e-2)
    assert 0 < ranks[0][1] == pytest.approx(ranks[n - 1][1] * 0.85 ** 59, rel=1e-2)


def test_a_graph_that_cannot_settle_in_time_is_an_error(spark):
    hosts = spark.createDataFrame([("a", 1.0, 0.0), ("b", 0.0, 1.0)], "host string, good double, bad double")
    edges = spark.createDataFrame([("a", "b"), ("b", "a")], "src string, dst string")
    with pytest.raises(RuntimeError, match="converge"):
        host_trust.propagate(hosts, edges, tolerance=1e-12, most_rounds=3)


# search

def test_search_matches_brute_force(spark):
    rng = np.random.default_rng(9)
    mean = rng.normal(size=24)
    rows = [(k, (rng.normal(size=24) * rng.choice([0.1, 1, 3]) + mean).astype(np.float32).tolist(), "x") for k in range(400)]
    rows += [(500, rows[7][1], "x"), (501, rows[7][1], "x"), (7, rows[7][1], "x"), (502, None, "x"), (504, [0.0] * 24, "x"),
             (506, [float("nan")] * 24, "x"), (508, [None] * 24, "x"), (None, rows[3][1], "x"), (510, [], "x"), (512, [1.0, 2.0], "x"),
             (520, [3.0, 1.0], "x"), (540, [0.5], "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    out = one_bit_ann.search(df, F.col("vec_id") % 20 == 0, k=20, vector_block=100, query_block=9)
    got = defaultdict(list)
    for r in out.orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
        assert len(got[r.query_id]) == r["rank"]
    good = {i: np.array(v, float) for i, v, _ in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    missed = 0
    for q, v in good.items():
        if q % 20:
            continue
        near = sorted((-float(sum(a * b for a, b in zip(v, w))), i) for i, w in good.items() if i != q and len(w) == len(v))[:20]
        assert [s for _, s in got[q]] == sorted((s for _, s in got[q]), reverse=True)
        assert len(got[q]) == len(near)
        missed += len({i for _, i in near} - {i for i, _ in got[q]})
        for i, s in got[q]:
            assert s == pytest.approx(float(v @ good[i]), rel=1e-12)
    assert missed <= 4  # of 400: the bound holds but for a small chance
    assert not got[540] and [i for i, _ in got[520]] == [512]
    assert one_bit_ann.search(df.limit(0), F.col("vec_id") % 20 == 0).collect() == []


# classifier

def quality_tables(spark):
    rows, labels = [], []
    for k in range(400):
        good = k % 4 != 0
        text = " ".join(words(30, k)) if good else "!! ".join(words(30, k)).upper()
        rows.append((k, text, "en", "s", 1))
        labels.append((k, int(good), 0))
    labels += [(9999, 1, 0), (None, 1, 0), (1, None, None), (2, 1, 0)]
    return rows + odd_rows()[9:], spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_classifier_scores_held_out_documents(spark):
    rows, labels = quality_tables(spark)
    docs = clashing(documents(spark, rows))
    model = subword_classifier.fit(docs, labels, sample=200)
    out = subword_classifier.classify(docs, model)
    got = out.collect()
    assert len(got) == len(rows) and out.columns == ["doc_id", "held_out", "score", "predicted"]
    for r in got:
        assert r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 400]
    assert np.mean([r.predicted == int(r.doc_id % 4 != 0) for r in held]) > 0.95
    again = subword_classifier.fit(docs.repartition(5), labels.repartition(3), sample=200)
    assert np.array_equal(model.weights, again.weights) and model.bias == again.bias


def test_classifier_does_not_learn_held_out_rows(spark):
    rows, labels = quality_tables(spark)
    flipped = labels.withColumn("quality", F.when(subword_classifier.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    docs = documents(spark, rows)
    a, b = (subword_classifier.fit(docs, x, sample=150) for x in (labels, flipped))
    assert np.array_equal(a.weights, b.weights)


def test_classifier_learns_one_text_of_an_id_that_many_rows_share(spark):
    rows, labels = quality_tables(spark)
    hot = next(k for k in range(400) if zlib.crc32(str(k).encode()) % 5)
    more = [(hot, "zzz" + " ".join(words(40, 7000 + k)), "en", "s", 1) for k in range(50)] + [rows[hot]] * 50
    a, b = (subword_classifier.fit(documents(spark, r), labels) for r in (rows, rows + more))
    assert np.array_equal(a.weights, b.weights) and a.bias == b.bias


def test_classifier_without_labels_scores_the_prior(spark):
    docs = documents(spark)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = subword_classifier.fit(docs, none)
    assert {r.score for r in subword_classifier.classify(docs, model).collect()} == {0.5}
    assert subword_classifier.classify(documents(spark, []), model).collect() == []


def test_score_of_a_text_does_not_depend_on_its_batch():
    texts = [r[1] or "" for r in odd_rows()] * 3
    weights = np.random.default_rng(0).normal(size=subword_classifier.BUCKETS).astype(np.float32)
    model = subword_classifier.Classifier(weights, 0.3)
    together = model.score(texts)
    assert np.allclose(together, [model.score([t])[0] for t in texts], atol=1e-12)
    assert model.score([""])[0] == pytest.approx(1 / (1 + np.exp(-0.3)))
