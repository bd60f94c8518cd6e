"""N-gram Jaccard join by parity sketches.

A document's set holds the hashes of its distinct word 3-shingles. Two sets with
``|A & B| >= 0.9 |A | B|`` and together n shingles differ in at most d = n / 19 of them. A parity
sketch of a set flips one bit per shingle, so two sketches differ in at most d bits: the
Hamming distance is a lower bound of the symmetric difference. Sizes fall into geometric
bands. For a band with largest size s the sketch has d + 1 words of 64 bits, d = 2 (s - 1) / 19,
so by the pigeonhole principle any two sets of the band that may link have an equal word.
Equal words are what Spark joins; a set also enters each higher band in which it may have a
partner. No pair that should link is missed; pairs that meet are verified on their shingles.

Shingle length and similarity are parameters. A lower similarity has fewer shingles a word, so
that words would often be empty or equal by chance. There the shingles of a band are dealt into
buckets, and the XOR of a bucket's 64-bit hashes is its key (``bucket_keys``). A set that
differs in at most d shingles from any partner gives the keys of its first d + 1 buckets that
are not empty: one at least is the same in the partner, and of two sets the one that gets less far
finds it in the other. The few sets that fill no more than d give their empty buckets too.
Parity words, fewer of them, then serve the Hamming bound only.

Scale: equal sets are one node. Each word's group is known by its smallest member, the
leader, and groups of one leader are one group, so a set stands in a few of them, however
many words it shares. A group is cut into chunks, each pair of chunks is a tile of bounded
size, and a tile gives the links of a spanning forest, the closest first, never all pairs. All
this works on sketches; texts are read only for those links. Where a text refutes one, what
is left of its component is compared again, now by shingles. Set fingerprints have 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from terrace.llm.common import (broadcast_if_small, connected_components, document_key, free_name, materialize,
                                python_workers, rows_per_group)

WORDS = 3
LEAST, OUT_OF = 90, 100
# Parity words are keys if each holds so many shingles at least; else bucket_keys are.
WORD_SHINGLES = 8
# Bits of parity for a shingle where parity words are no keys.
PARITY_BITS = 4
CHUNK_ROWS = 1024
TILE_ROWS = 4096
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingles(text: str | None, length: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of a whole text's shingles of ``length`` words (A-Z lowered; words are runs
    of characters other than ASCII white space). Fewer words than a shingle has make one
    shingle; no words make none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, _U)
    h = np.fromiter(map(xxh3_64_intdigest, words), _U, len(words))
    n = min(length, len(h))
    out = np.full(len(h) - n + 1, n, _U)
    for k in range(n):
        out = _mix(out + h[k:len(h) - n + 1 + k])
    return np.unique(out)


def fingerprint(hashes: np.ndarray) -> int:
    """A signed 64-bit fingerprint of a set."""
    total = _mix(np.array([_mix(hashes ^ _U(0x5DEECE66D)).sum(dtype=_U) + _U(len(hashes))], _U))
    return int(total.view(np.int64)[0])


def band_edges(largest: int) -> list[int]:
    """First sizes of the bands, up to one beyond ``largest``: a quarter wider each time."""
    edges = [1]
    while edges[-1] <= largest:
        edges.append(max(edges[-1] + 1, edges[-1] * 5 // 4))
    return edges


def allowed_difference(total: int, least: int = LEAST, out_of: int = OUT_OF) -> int:
    """Largest symmetric difference of two sets that link and have at most ``total`` elements
    together: i >= (total - i) least / out_of bounds total - 2 i."""
    return total * (out_of - least) // (least + out_of)


def sketch(hashes: np.ndarray, words: int) -> np.ndarray:
    """Parity sketch: ``words`` 64-bit words, one bit flipped per shingle."""
    bits = np.bincount((_mix(hashes) % _U(64 * words)).astype(np.int64), minlength=64 * words) & 1
    return np.packbits(bits.astype(np.uint8)).view(_U)


def words_are_keys(least: int, out_of: int) -> bool:
    """Whether the d + 1 parity words of a band hold ``WORD_SHINGLES`` shingles each or more."""
    return 2 * WORD_SHINGLES * (out_of - least) <= least + out_of


def most_apart(size: int, high: int, least: int, out_of: int) -> int:
    """Largest symmetric difference of a set and any partner of fewer than ``high`` shingles."""
    return allowed_difference(size + min(high - 1, size * out_of // least), least, out_of)


@lru_cache(maxsize=10_000)
def band_buckets(low: int, high: int, least: int, out_of: int) -> int:
    """Buckets of a band: so few that sets of the sizes that enter it still fill more than
    ``most_apart`` of them, but for chances of 4.5 standard deviations."""
    sizes = sorted({-(-low * least // out_of), (low + low * least // out_of) // 2, low, (low + high) // 2, high - 1})
    buckets = 1
    for n in sizes:
        d = most_apart(n, high, least, out_of)
        buckets = max(buckets, d + 1)
        while 0 < d and buckets < 64 * (d + 1):
            p, q = (1 - 1 / buckets) ** n, max(0.0, 1 - 2 / buckets) ** n
            spread = max(0.0, buckets * p + buckets * (buckets - 1) * q - (buckets * p) ** 2) ** 0.5
            if buckets * (1 - p) - 4.5 * spread >= d + 1:
                break
            buckets += max(1, buckets // 100)
    return buckets


def bucket_keys(hashes: np.ndarray, least: int, out_of: int) -> np.ndarray:
    """Join keys of a set in all bands that it enters. Two sets that link have an equal one in
    the larger one's band."""
    edges, mixed, out = band_edges(len(hashes) * out_of // least + 1), _mix(hashes), []
    for band, _ in bands(len(hashes), least, out_of):
        buckets = band_buckets(edges[band], edges[band + 1], least, out_of)
        d = most_apart(len(hashes), edges[band + 1], least, out_of)
        at = (mixed % _U(buckets)).astype(np.int64)
        order = np.argsort(at, kind="stable")
        filled, first = np.unique(at[order], return_index=True)
        values = np.zeros(buckets, _U)
        values[filled] = np.bitwise_xor.reduceat(hashes[order], first)
        use = filled[:d + 1] if len(filled) > d else np.arange(buckets)
        out.append(_mix(_mix(values[use]) + _mix(use.astype(_U) + _U(band << 40))))
    return np.concatenate(out)


@lru_cache(maxsize=100_000)
def bands(size: int, least: int = LEAST, out_of: int = OUT_OF) -> list[tuple[int, int]]:
    """(band, words of its sketches) for each band that a set of this size enters: its own
    first, then each higher one that may hold a partner."""
    edges = band_edges(size * out_of // least + 1)
    keyed = words_are_keys(least, out_of)
    return [(band, allowed_difference(2 * (high - 1), least, out_of) + 1 if keyed else high * PARITY_BITS // 64 + 1)
            for band, (low, high) in enumerate(zip(edges, edges[1:])) if high > size and low * least <= size * out_of]


def links(a: np.ndarray, b: np.ndarray, least: int = LEAST, out_of: int = OUT_OF) -> bool:
    """out_of * |A & B| >= least * |A | B|, for sorted distinct hashes."""
    if min(len(a), len(b)) * out_of < least * max(len(a), len(b)) or not len(a):
        return False
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return out_of * shared >= least * (len(a) + len(b) - shared)


def document_sets(docs: DataFrame, length: int = WORDS, least: int = LEAST, out_of: int = OUT_OF) -> DataFrame:
    """One row per document: doc_id, its identity (k1, k2), n_shingles, the set's fingerprint
    (NULL for an empty set) and its sketches: the words for each of its bands."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [shingles(t, length) for t in batch["text"].tolist()]
            plans = [bands(len(s), least, out_of) if len(s) else [] for s in sets]
            yield pd.DataFrame({
                "row": batch["row"], "n_shingles": [len(s) for s in sets],
                "fp": pd.array([fingerprint(s) if len(s) else None for s in sets], "Int64"),
                "bands": [[band for band, _ in plan] for plan in plans],
                "words": [[sketch(s, words).view(np.int64) for _, words in plan] for s, plan in zip(sets, plans)]})

    k1, k2 = document_key(F.col("doc_id"), F.col("text"))
    out = (docs.select(F.struct("doc_id", k1.alias("k1"), k2.alias("k2")).alias("row"), "text")
           .mapInPandas(run, "row struct<doc_id: bigint, k1: bigint, k2: bigint>, n_shingles long, fp long, "
                             "bands array<int>, words array<array<long>>"))
    return out.select("row.*", "n_shingles", "fp", "bands", "words")


def bucket_table(docs: DataFrame, length: int, least: int, out_of: int) -> DataFrame:
    """(fp, key) for the bucket keys of every document that has words. They are made anew where
    they are read: stored, they would take more room than the texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [s for s in (shingles(t, length) for t in batch["text"].tolist()) if len(s)]
            yield pd.DataFrame({"fp": pd.Series([fingerprint(s) for s in sets], dtype="int64"),
                                "keys": [bucket_keys(s, least, out_of).view(np.int64) for s in sets]})

    return docs.select("text").mapInPandas(run, "fp long, keys array<long>").select("fp", F.explode("keys").alias("key"))


def groups_by_words(sets: DataFrame) -> DataFrame:
    """(lead, fp): the sets of each parity word that several have, under the smallest of them."""
    keyed = (sets.where(F.col("fp").isNotNull())
             .select("fp", F.explode(F.arrays_zip("bands", "words")).alias("s"))
             .select("fp", F.col("s.bands").alias("band"), F.posexplode("s.words").alias("at", "word"))
             .select("fp", F.xxhash64("band", "at", "word").alias("key")))
    shared = materialize(keyed.groupBy("key").agg(F.min("fp").alias("lead"), F.max("fp").alias("most"))
                         .where(F.col("lead") < F.col("most")).select("key", "lead"), "shared")
    return keyed.join(broadcast_if_small(shared), "key").select("lead", "fp").distinct()


def groups_by_buckets(keyed: DataFrame) -> DataFrame:
    """(lead, fp) as groups_by_words, for the keys of ``bucket_table``. Of a key that two have,
    both are known by its smallest and largest; only the others are joined again."""
    shared = materialize(keyed.groupBy("key").agg(F.min("fp").alias("lead"), F.max("fp").alias("most"), F.count(F.lit(1)).alias("n"))
                         .where(F.col("lead") < F.col("most")), "shared")
    two = shared.where("n = 2").select("lead", F.explode(F.array("lead", "most")).alias("fp"))
    more = materialize(shared.where("n > 2").select("key", "lead"), "shared")
    return keyed.join(broadcast_if_small(more), "key").select("lead", "fp").unionByName(two).distinct()


def _sketches(row_bands, row_words) -> dict[int, np.ndarray]:
    return {int(b): np.asarray(w, np.int64).view(_U) for b, w in zip(row_bands, row_words)}


def _near(tile: pd.DataFrame, across: bool) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs of a tile that may link by their sketches, closest first. Two sets are
    compared in the larger one's band, which the smaller one enters too. ``tile.attrs`` may
    name another similarity (least, out_of) than that of the module."""
    least, out_of = tile.attrs.get("similarity", (LEAST, OUT_OF))
    sizes, chunk = tile["n_shingles"].to_numpy(), tile["chunk"].to_numpy()
    sketches = [_sketches(b, w) for b, w in zip(tile["bands"], tile["words"])]
    own = np.array([b[0] for b in tile["bands"]])
    left, right, ratio = [], [], []
    for band in np.unique(own).tolist():
        has = np.array([k for k, s in enumerate(sketches) if band in s])
        matrix = np.array([sketches[k][band] for k in has])
        for k in np.flatnonzero(own == band).tolist():
            apart = np.bitwise_count(matrix ^ sketches[k][band]).sum(axis=1)
            total = sizes[has] + sizes[k]
            # A pair of one band is met twice; the earlier row counts it.
            use = (own[has] < band) | (has > k)
            use &= apart * (least + out_of) <= (out_of - least) * total
            if across:
                use &= chunk[has] != chunk[k]
            right.append(has[use])
            left.append(np.full(len(right[-1]), k))
            ratio.append(apart[use] / total[use])
    left, right, ratio = np.concatenate(left), np.concatenate(right), np.concatenate(ratio)
    order = np.lexsort((right, left, ratio))
    return left[order], right[order]


def compare_groups(tiles: DataFrame, groups: int, length: int = WORDS, least: int = LEAST, out_of: int = OUT_OF) -> DataFrame:
    """Pairs (u, v) within ``tiles`` (lead, was, ta, tb, chunk, fp, root, n_shingles, bands, words,
    and text or not): of every two that aren't in one component (root) yet, those of a
    spanning forest of the tile. Without texts they may link by their sketches; with texts
    they do link."""
    exact = "text" in tiles.columns
    key = ["lead", "was", "ta", "tb"]

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        out, sets = [], {}
        for (_, _, ta, tb), tile in rows.groupby(key, sort=True):
            tile = tile.sort_values("fp", kind="stable", ignore_index=True)
            tile.attrs["similarity"] = (least, out_of)
            fps, roots = tile["fp"].tolist(), tile["root"].tolist()
            up = {r: r for r in roots}

            def top(x):
                while up[x] != x:
                    up[x] = x = up[up[x]]
                return x

            for a, b in zip(*(side.tolist() for side in _near(tile, ta != tb))):
                x, y = top(roots[a]), top(roots[b])
                if x == y:
                    continue
                if exact:
                    for k in (a, b):
                        if fps[k] not in sets:
                            sets[fps[k]] = shingles(tile["text"].iloc[k], length)
                    if not links(sets[fps[a]], sets[fps[b]], least, out_of):
                        continue
                up[max(x, y)] = min(x, y)
                out.append((max(fps[a], fps[b]), min(fps[a], fps[b])))
        return pd.DataFrame(out, columns=["u", "v"], dtype="int64")

    part = F.pmod(F.xxhash64(*key), F.lit(groups))
    return tiles.withColumn("part", part).groupBy("part").applyInPandas(run, "u long, v long").distinct()


def verify(pairs: DataFrame, texts: DataFrame, length: int = WORDS, least: int = LEAST, out_of: int = OUT_OF) -> DataFrame:
    """(u, v, linked) for the pairs (u, v): whether the sets of their texts link."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            known: dict[int, np.ndarray] = {}
            linked = []
            for u, v, a, b in zip(batch["u"], batch["v"], batch["text_u"], batch["text_v"]):
                for fp, text in ((u, a), (v, b)):
                    if fp not in known:
                        known[fp] = shingles(text, length)
                linked.append(links(known[u], known[v], least, out_of))
            yield batch[["u", "v"]].assign(linked=linked)

    u = texts.select(F.col("fp").alias("u"), F.col("text").alias("text_u"))
    v = texts.select(F.col("fp").alias("v"), F.col("text").alias("text_v"))
    return pairs.join(u, "u").join(v, "v").mapInPandas(run, "u long, v long, linked boolean")


def texts_of(docs: DataFrame, wanted: DataFrame, nodes: DataFrame) -> DataFrame:
    """(fp, text) for the fingerprints in ``wanted``, one document's text for each."""
    need = broadcast_if_small(materialize(wanted.join(nodes.select("fp", "k1", "k2"), "fp"), "need"))
    k1, k2 = document_key(F.col("doc_id"), F.col("text"))
    found = docs.select(k1.alias("k1"), k2.alias("k2"), "text").join(need, ["k1", "k2"])
    return materialize(found.groupBy("fp").agg(F.min("text").alias("text")), "texts")


def cut_into_tiles(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """``members`` (lead, was, fp, root, minor) cut into tiles: in each group (lead, was) the
    minor members meet all others, every two chunks in a tile of their own."""
    size = F.lit(CHUNK_ROWS)
    groups = members.groupBy("lead", "was").agg(
        F.ceil(F.count_if("minor") / size).cast("int").alias("few"), F.ceil(F.count_if(~F.col("minor")) / size).cast("int").alias("many"))
    seat = F.xxhash64("fp")
    chunk = F.when(F.col("minor"), F.pmod(seat, "few")).otherwise(F.col("few") + F.pmod(seat, "many")).cast("int")
    meets = F.sequence(F.lit(0), F.when(F.col("minor"), F.col("few") + F.col("many")).otherwise(F.col("few")) - 1)
    return (members.join(groups, ["lead", "was"]).withColumn("chunk", chunk).withColumn("x", F.explode(meets))
            .select("lead", "was", "fp", "root", "chunk", F.least("x", "chunk").alias("ta"), F.greatest("x", "chunk").alias("tb"))
            .join(nodes.drop("k1", "k2"), "fp"))


def component_roots(docs: DataFrame, met: DataFrame, nodes: DataFrame, *measure: int) -> DataFrame:
    """(node, root) of the sets that link, from the groups ``met`` (lead, fp). ``measure`` is
    (length, least, out_of) as in near_duplicates."""
    members = met.select("lead", F.lit(0).cast("long").alias("was"), "fp", F.col("fp").alias("root"), F.lit(True).alias("minor"))
    forest = compare_groups(cut_into_tiles(members, nodes), rows_per_group(met, TILE_ROWS), *measure)
    forest = materialize(forest, "forest")
    texts = texts_of(docs, forest.select(F.explode(F.array("u", "v")).alias("fp")).distinct(), nodes)
    checked = materialize(verify(forest, texts, *measure), "checked")
    good, bad = (checked.where(F.col("linked") == ok).drop("linked") for ok in (True, False))
    roots = connected_components(good)
    if not bad.take(1):
        return roots
    # A refuted link may have held a component together. Where two members of a group were in
    # one component and no longer are, its parts are compared by shingles: all that are in a
    # smaller part with all others.
    were = connected_components(forest).withColumnRenamed("root", "was")
    torn = were.join(bad.select(F.col("u").alias("node")), "node").select("was").distinct()
    now = (were.join(torn, "was").join(roots, "node", "left")
           .select(F.col("node").alias("fp"), "was", F.coalesce("root", "node").alias("root")))
    placed = materialize(met.join(now, "fp"), "torn")
    parts = placed.groupBy("lead", "was", "root").agg(F.count(F.lit(1)).alias("n"))
    split = (parts.groupBy("lead", "was").agg(F.max(F.struct("n", "root")).alias("most"), F.count(F.lit(1)).alias("parts"))
             .where("parts > 1").select("lead", "was", F.col("most.root").alias("major")))
    members = materialize(placed.join(split, ["lead", "was"]).withColumn("minor", F.col("root") != F.col("major"))
                          .select("lead", "was", "fp", "root", "minor"), "members")
    texts = texts_of(docs, members.select("fp").distinct(), nodes)
    tiles = cut_into_tiles(members, nodes).join(texts, "fp")
    found = compare_groups(tiles, rows_per_group(members, TILE_ROWS // 2), *measure)
    return connected_components(good.unionByName(materialize(found, "found")))


def near_duplicates(docs: DataFrame, length: int = WORDS, least: int = LEAST, out_of: int = OUT_OF) -> DataFrame:
    """Link documents whose sets of ``length``-word shingles have a Jaccard similarity of at
    least ``least / out_of`` (3 words and 0.9 unless told otherwise).

    Returns for every row of ``docs`` (doc_id, text; other columns are ignored): doc_id,
    n_shingles, component_id (smallest doc_id reachable over links, itself included), k1 and
    k2 (the document's identity) and grp (the component's node; NULL for an empty set).
    NULL texts and texts without words have an empty set and link with nothing. Rows with a
    NULL id link by their text; the component of a group without any id is NULL. Repeated
    rows link with each other.
    """
    python_workers(docs.sparkSession, rows=1000)
    sets = materialize(document_sets(docs, length, least, out_of), "sets")
    met = materialize(groups_by_words(sets) if words_are_keys(least, out_of) else
                      groups_by_buckets(bucket_table(docs, length, least, out_of)), "met")
    need = broadcast_if_small(materialize(met.select("fp").distinct(), "need"))
    nodes = (sets.join(need, "fp").groupBy("fp")
             .agg(F.min(F.struct("k1", "k2")).alias("k"), F.first("n_shingles").alias("n_shingles"),
                  F.first("bands").alias("bands"), F.first("words").alias("words"))
             .select("fp", "k.*", "n_shingles", "bands", "words"))
    roots = component_roots(docs, met, materialize(nodes, "nodes"), length, least, out_of)

    grouped = (sets.select("doc_id", "k1", "k2", "n_shingles", "fp")
               .join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left")
               .withColumn("grp", F.coalesce("root", "fp")))
    grouped = materialize(grouped.drop("root", "fp"), "grouped")
    lowest = grouped.where(F.col("grp").isNotNull()).groupBy("grp").agg(F.min("doc_id").alias("component_id"))
    alone = grouped.where(F.col("grp").isNull()).withColumn("component_id", F.col("doc_id"))
    return (grouped.join(lowest, "grp").unionByName(alone)
            .select("doc_id", "n_shingles", "component_id", "k1", "k2", "grp"))


def keep_one(docs: DataFrame, near: DataFrame) -> DataFrame:
    """``docs`` with one document of each group of ``near`` (near_duplicates of them): the one
    with the smallest id, of repeated rows one. Documents with an empty set all stay."""
    k1, k2 = document_key(F.col("doc_id"), F.col("text"))
    times = near.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("times"))
    first = (near.where(F.col("grp").isNotNull()).groupBy("grp")
             .agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "k1", "k2")).alias("f"))
             .select("f.k1", "f.k2").join(times, ["k1", "k2"]))
    empty = near.where(F.col("grp").isNull()).select("k1", "k2").distinct().withColumn("times", F.lit(1).cast("long"))
    kept = materialize(first.unionByName(empty), "kept")
    names = docs.columns
    a, b = free_name(names, "k1"), free_name(names, "k2")
    keyed = docs.withColumn(a, k1).withColumn(b, k2)

    def only(condition: str) -> DataFrame:
        keys = materialize(kept.where(condition).select(F.col("k1").alias(a), F.col("k2").alias(b)), "kept")
        return keyed.join(broadcast_if_small(keys), [a, b], "left_semi")

    # Only documents stored more than once need their rows brought together.
    return only("times = 1").select(*names).unionByName(only("times > 1").dropDuplicates([a, b]).select(*names))
