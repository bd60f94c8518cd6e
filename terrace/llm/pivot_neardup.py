"""Near-duplicate vectors by a pivot-permutation index.

Every vector is described by its nearest reference points (pivots): of ``PIVOTS`` unit
vectors, the ``NEAREST`` with the largest cosine, in order. Near vectors keep most of them.
The inverted lists hold, for each label and each set of ``SHARED`` pivots, the vectors that
have all of these among their nearest, so two vectors meet in a list exactly if they share
at least ``SHARED`` pivots, and the number of lists grows with the cube of the pivots instead
of a few long lists of single pivots. Vectors that meet are compared by cosine in double
precision. A pair that meets in several lists is counted in one: the list of its smallest
shared pivots.

Measured by simulation, pairs at cosine 0.98 share 3 of 7 among 256 pivots with probability
0.9998; nearer pairs more often.

Scale: equal vectors are one entry with a count. A list longer than ``LIST_ROWS`` is cut into
chunks, and each pair of chunks is a tile of its own, dealt to tasks like any other; nothing
is capped. Tiles report sums per vector and the links of a spanning forest, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import connected_components, materialize, python_workers

PIVOTS, NEAREST, SHARED = 256, 7, 3
APART = 0.6
LIST_ROWS = 1024
TILE_ROWS = 16_384


def usable(vector: str = "embedding"):
    """Not null, not empty, every component finite and at least one not zero."""
    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(v, lambda x: x != 0), F.lit(False))


def choose_pivots(vectors: DataFrame, count: int = PIVOTS, seed: int = 11) -> dict[int, np.ndarray]:
    """Unit reference points for each dimension, from the ``count`` vectors with the smallest
    hash (all that the driver collects).

    A sampled vector is taken only if its cosine to those taken before is below ``APART``: in
    a dense group of near copies several pivots would differ by less than the copies do, and
    their order would be noise. Random directions fill up to ``count``, for a dimension that
    the sample doesn't show as well (:func:`_pivots`)."""
    rows = (vectors.select("embedding").orderBy(F.xxhash64("embedding", F.lit(seed)), "embedding")
            .limit(count).collect())
    found: dict[int, list[np.ndarray]] = {}
    for r in rows:
        v = np.array(r["embedding"], np.float64)
        found.setdefault(len(v), []).append(v / np.abs(v).max())
    return {dim: _pivots(dim, np.array(vs), count, seed) for dim, vs in found.items()}


def _pivots(dim: int, sample: np.ndarray, count: int, seed: int) -> np.ndarray:
    random = np.random.default_rng([seed, dim]).normal(size=(count, dim))
    sample = sample.reshape(-1, dim) / np.linalg.norm(sample.reshape(-1, dim), axis=1, keepdims=True)
    taken: list[int] = []
    for k, point in enumerate(sample):
        if not taken or (sample[taken] @ point).max() < APART:
            taken.append(k)
    return np.vstack([sample[taken], random / np.linalg.norm(random, axis=1, keepdims=True)])[:count]


def _units(vectors: list) -> np.ndarray:
    """Rows scaled to length 1 in double precision, first by the largest component so that
    very large or small ones neither overflow nor vanish."""
    v = np.array(vectors, np.float64)
    v /= np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _nearest(units: np.ndarray, pivots: np.ndarray, nearest: int) -> np.ndarray:
    k = min(nearest, len(pivots))
    return np.argsort(-(units @ pivots.T), axis=1, kind="stable")[:, :k]


def with_nearest(classes: DataFrame, pivots: dict[int, np.ndarray], count: int = PIVOTS,
                 nearest: int = NEAREST, seed: int = 11) -> DataFrame:
    """``classes`` (cid, embedding) with ``near``: the sorted numbers of each vector's nearest
    pivots. They are worked out once and stored, so no later step can see other ones."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, part in batch.groupby(batch["embedding"].map(len)):
                points = pivots[dim] if dim in pivots else _pivots(dim, np.zeros((0, dim)), count, seed)
                near = np.sort(_nearest(_units(part["embedding"].tolist()), points, nearest), axis=1)
                yield pd.DataFrame({"cid": part["cid"], "near": list(near.astype(np.int32))})

    return classes.join(classes.select("cid", "embedding").mapInPandas(run, "cid long, near array<int>"), "cid")


def list_keys(entries: DataFrame, nearest: int = NEAREST, shared: int = SHARED) -> DataFrame:
    """(label, list, cid) for every inverted list that a vector stands in; ``list`` packs the
    sorted pivots of a set, 16 bits each."""
    near = F.col("near")
    packed = [sum((F.shiftleft(near[i].cast("long"), 16 * k) for k, i in enumerate(chosen)), F.lit(0).cast("long"))
              for chosen in combinations(range(nearest), shared)]
    return entries.select("label", "cid", F.explode(F.array(*packed)).alias("list"))


def _pairs_of_tiles(tile: np.ndarray, chunk: np.ndarray, across: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row index pairs to compare among rows sorted by tile: all pairs in a tile of one
    chunk, the pairs of different chunks where the tile is ``across`` two."""
    starts = np.flatnonzero(np.r_[True, tile[1:] != tile[:-1]])
    ends = np.r_[starts[1:], len(tile)]
    after = np.repeat(ends, ends - starts) - np.arange(len(tile)) - 1
    left = np.repeat(np.arange(len(tile)), after)
    right = np.arange(len(left)) - np.repeat(np.cumsum(after) - after, after) + left + 1
    use = ~across[left] | (chunk[left] != chunk[right])
    return left[use], right[use]


def _forest(left: np.ndarray, right: np.ndarray, n: int) -> list[int]:
    """Positions of links that join two parts not yet joined (union by walking up)."""
    up = list(range(n))

    def top(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    kept = []
    for k, (a, b) in enumerate(zip(left.tolist(), right.tolist())):
        a, b = top(a), top(b)
        if a != b:
            up[max(a, b)] = min(a, b)
            kept.append(k)
    return kept


def compare_tiles(tiles: DataFrame, least: float, groups: int, shared: int = SHARED) -> DataFrame:
    """Rows (cid, add, other): ``add`` vectors linked to the entry, or a link of the forest."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["label", "list", "ta", "tb", "chunk", "cid"], kind="stable", ignore_index=True)
        same = (rows[["label", "list", "ta", "tb"]] == rows[["label", "list", "ta", "tb"]].shift()).all(axis=1)
        left, right = _pairs_of_tiles((~same).cumsum().to_numpy(), rows["chunk"].to_numpy(),
                                      (rows["ta"] != rows["tb"]).to_numpy())
        dims = rows["embedding"].map(len).to_numpy()
        use = dims[left] == dims[right]
        left, right = left[use], right[use]
        linked = np.zeros(len(left), bool)
        cid, n, key = rows["cid"].to_numpy(), rows["n"].to_numpy(), rows["list"].to_numpy()
        vectors, near = rows["embedding"].to_numpy(), np.array(rows["near"].tolist(), np.int64)
        for dim in np.unique(dims):
            at = np.flatnonzero(dims == dim)
            place = np.full(len(rows), -1)
            place[at] = np.arange(len(at))
            units = _units(vectors[at].tolist())
            for a in range(0, len(left), 65_536):
                ks = np.arange(a, min(a + 65_536, len(left)))
                ks = ks[place[left[ks]] >= 0]
                u, v = left[ks], right[ks]
                # In its own list only: the smallest shared pivots must be this list's.
                hit = (near[u][:, :, None] == near[v][:, None, :]).any(axis=2)
                first = hit & (np.cumsum(hit, axis=1) <= shared)
                shift = 16 * (np.cumsum(first, axis=1) - 1)
                own = np.where(first, near[u] << np.maximum(shift, 0), 0).sum(axis=1) == key[left[ks]]
                ks, u, v = ks[own], u[own], v[own]
                linked[ks] = np.einsum("ij,ij->i", units[place[u]], units[place[v]]) >= least
        left, right = left[linked], right[linked]
        add = np.bincount(left, n[right], len(rows)) + np.bincount(right, n[left], len(rows))
        # The links of all pairs stay in the task: sums and a spanning forest go on.
        sums = pd.DataFrame({"cid": cid, "add": add.astype(np.int64)}).groupby("cid", as_index=False).sum()
        sums = sums[sums["add"] > 0]
        kept = _forest(np.searchsorted(np.unique(cid), cid[left]), np.searchsorted(np.unique(cid), cid[right]), len(rows))
        links = pd.DataFrame({"cid": cid[left[kept]], "add": np.zeros(len(kept), np.int64), "other": cid[right[kept]]})
        return pd.concat([sums.assign(other=-1), links])[["cid", "add", "other"]].assign(
            is_link=np.r_[np.zeros(len(sums), bool), np.ones(len(kept), bool)])

    part = F.pmod(F.xxhash64("label", "list", "ta", "tb"), F.lit(groups))
    return (tiles.withColumn("part", part).groupBy("part")
            .applyInPandas(run, "cid long, add long, other long, is_link boolean"))


def near_duplicates(vectors: DataFrame, least: float = 0.98, list_rows: int = LIST_ROWS) -> DataFrame:
    """Link vectors of equal, non-null label with cosine of at least ``least``.

    ``vectors`` has vec_id, embedding (array of float or double) and label. One row comes back
    for every input row: vec_id, n_links (other rows linked directly), component_id (smallest
    vec_id reachable), kept (vec_id = component_id). Vectors that are NULL, empty, zero, or
    hold a NULL or non-finite component, and rows with a NULL label or id, link with nothing
    and are their own component. Vectors of different length do not link. Repeated rows are
    vectors of their own and link with each other. Other columns are ignored.
    """
    python_workers(vectors.sparkSession)
    rows = vectors.select("vec_id", "label", "embedding").withColumn(
        "ok", usable() & F.col("label").isNotNull() & F.col("vec_id").isNotNull())
    good = rows.where("ok").drop("ok")
    classes = materialize(good.groupBy("label", "embedding").agg(
        F.min("vec_id").alias("low"), F.count(F.lit(1)).alias("n"))
        .withColumn("cid", F.monotonically_increasing_id()), "vectors")
    classes = materialize(with_nearest(classes, choose_pivots(classes)), "entries")
    keys = list_keys(classes)
    lists = keys.groupBy("label", "list").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    chunks = F.ceil(F.col("m") / list_rows).cast("int")
    members = (keys.join(lists, ["label", "list"])
               .withColumn("chunks", chunks).withColumn("chunk", F.pmod(F.xxhash64("cid"), F.col("chunks")).cast("int")))
    # Chunk c meets every chunk: tiles (c, x) for x >= c and (x, c) for x < c.
    members = members.withColumn("x", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    tiles = (members.select("label", "list", "cid", "chunk", F.least("x", "chunk").alias("ta"), F.greatest("x", "chunk").alias("tb"))
             .join(classes.select("cid", "n", "embedding", "near"), "cid"))
    tiles = materialize(tiles, "tiles")
    groups = max(1, -(-tiles.count() // TILE_ROWS))
    found = materialize(compare_tiles(tiles, least, groups), "found")
    direct = found.groupBy("cid").agg(F.sum("add").alias("links"))
    low = classes.select("cid", "low")
    roots = connected_components(found.where("is_link").select(F.col("cid").alias("u"), F.col("other").alias("v")))
    component = (roots.join(low, roots["node"] == low["cid"]).groupBy("root").agg(F.min("low").alias("component"))
                 .join(roots, "root").select(F.col("node").alias("cid"), "component"))
    entry = (classes.join(direct, "cid", "left").join(component, "cid", "left")
             .select("label", "embedding", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                     F.coalesce("component", "low").alias("component_id")))
    linked = good.join(entry, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~F.col("ok")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
