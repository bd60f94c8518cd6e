"""Vector codes by dual-tree Lloyd iterations over product codebooks, in integers.

Vectors are cut into equal parts, each part position having a codebook of its own. A round
assigns every part to its nearest entry and moves the entries to the means of their parts.

Two trees per position do the assigning: one over the parts of a batch, one over the entries,
both halved level by level along the widest side of each node's box. Both are walked together,
all pairs of a level at once in numpy: a pair of nodes is dropped if the least distance of their
boxes exceeds the greatest distance from the part node to some other entry node. A part node
left with one entry is assigned whole, its sums taken from the running sums kept with the tree.
Parts in leaves that are still undecided are compared with their few entries one by one.

All of it is integer arithmetic, so bounds and ties are exact (values too large for 64 bits are
Python integers). Spark adds the sums of all batches; the driver sees codebooks only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.llm.common import broadcast_if_small, free_name, materialize, python_workers

LEAF = 8
LIMB = 31
LONGEST = (1 << 63) - 1


@dataclass
class Tree:
    """Points in tree order and, per level, the bounds and boxes of its nodes. Node j of a level
    has the children 2j and 2j + 1 of the next; in the last, nodes may be empty."""

    order: np.ndarray
    points: np.ndarray
    bounds: list[np.ndarray]
    low: list[np.ndarray]
    high: list[np.ndarray]


def grow(points: np.ndarray, leaf: int) -> Tree:
    """The tree over ``points`` (n, d), n >= 1, down to nodes of at most ``leaf`` points."""
    n = len(points)
    depth = max(0, math.ceil(math.log2(n / leaf)))
    order = np.arange(n)
    tree = Tree(order, points, [], [], [])
    for level in range(depth + 1):
        bounds = (np.arange((1 << level) + 1) * n) >> level
        inside = points[order]
        low, high = (f.reduceat(inside, bounds[:-1], axis=0) for f in (np.minimum, np.maximum))
        tree.bounds.append(bounds)
        tree.low.append(low)
        tree.high.append(high)
        if level < depth:
            node = np.repeat(np.arange(1 << level), np.diff(bounds))
            widest = np.argmax(high - low, axis=1)
            order = order[np.lexsort((inside[np.arange(n), widest[node]], node))]
    tree.order, tree.points = order, points[order]
    return tree


def _least(a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Least squared distance between boxes [a, b] and [c, d]."""
    gap = np.maximum(np.maximum(c - b, a - d), 0)
    return (gap * gap).sum(axis=1)


def _greatest(a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Greatest squared distance between boxes [a, b] and [c, d]."""
    gap = np.maximum(d - a, b - c)
    return (gap * gap).sum(axis=1)


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, value) of the ranges that begin at ``starts`` and have ``sizes`` values."""
    owner = np.repeat(np.arange(len(starts)), sizes)
    return owner, np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes) + starts[owner]


def assign(points: np.ndarray, entries: np.ndarray, leaf: int = LEAF,
           stats: dict[str, int] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(nearest entry of each point, sum of the points and number of points of each entry); of
    entries at the same distance the first. ``stats`` counts points assigned with their whole
    node, and point-entry distances."""
    n, k = len(points), len(entries)
    codes = np.zeros(n, np.int64)
    sums, counts = np.zeros_like(entries), np.zeros(k, np.int64)
    if not n:
        return codes, sums, counts
    parts, book = grow(points, leaf), grow(entries, 1)
    running = np.concatenate([np.zeros_like(parts.points[:1]), np.cumsum(parts.points, axis=0)])
    node, entry = np.zeros(1, np.int64), np.zeros(1, np.int64)
    level, book_level = 0, 0
    in_order = np.full(n, -1, np.int64)
    while True:
        a, b = parts.low[level][node], parts.high[level][node]
        c, d = book.low[book_level][entry], book.high[book_level][entry]
        best = np.full(len(parts.low[level]), -1, dtype=points.dtype)
        greatest = _greatest(a, b, c, d)
        first = np.flatnonzero(np.diff(node, prepend=-1))  # pairs are in order of the part nodes
        best[node[first]] = np.minimum.reduceat(greatest, first)
        stay = _least(a, b, c, d) <= best[node]
        node, entry = node[stay], entry[stay]
        first = np.flatnonzero(np.diff(node, prepend=-1))
        alone = np.diff(np.append(first, len(node))) == 1
        bounds, of_entry = parts.bounds[level], book.bounds[book_level]
        sure = first[alone & ((of_entry[entry[first] + 1] - of_entry[entry[first]]) == 1)]
        if len(sure):
            which = book.order[of_entry[entry[sure]]]
            starts, ends = bounds[node[sure]], bounds[node[sure] + 1]
            np.add.at(sums, which, running[ends] - running[starts])
            np.add.at(counts, which, ends - starts)
            owner, at = _ragged(starts, ends - starts)
            in_order[at] = which[owner]
            if stats is not None:
                stats["whole"] = stats.get("whole", 0) + len(at)
            keep = np.ones(len(node), bool)
            keep[sure] = False
            node, entry = node[keep], entry[keep]
        deeper, finer = level + 1 < len(parts.low), book_level + 1 < len(book.low)
        if not len(node) or not (deeper or finer):
            break
        if deeper:
            node, entry = np.repeat(node * 2, 2), np.repeat(entry, 2)
            node[1::2] += 1
            level += 1
        if finer:
            node, entry = np.repeat(node, 2), np.repeat(entry * 2, 2)
            entry[1::2] += 1
            book_level += 1
            filled = np.diff(book.bounds[book_level])[entry] > 0
            node, entry = node[filled], entry[filled]
        by = np.lexsort((entry, node))
        node, entry = node[by], entry[by]
    if len(node):  # leaves with several entries: every point with each of them
        bounds = parts.bounds[level]
        lead = np.flatnonzero(np.diff(node, prepend=-1))
        open_, entry_count = node[lead], np.diff(np.append(lead, len(node)))
        leaf_of, at = _ragged(bounds[open_], bounds[open_ + 1] - bounds[open_])
        point, pair = _ragged(lead[leaf_of], entry_count[leaf_of])
        which = book.order[book.bounds[book_level][entry[pair]]]
        gap = parts.points[at[point]] - entries[which]
        far = (gap * gap).sum(axis=1)
        begin = np.flatnonzero(np.diff(point, prepend=-1))
        least = np.minimum.reduceat(far, begin)
        nearest = np.minimum.reduceat(np.where(far == least[point], which, k), begin)
        in_order[at] = nearest
        np.add.at(sums, nearest, parts.points[at])
        np.add.at(counts, nearest, 1)
        if stats is not None:
            stats["pairs"] = stats.get("pairs", 0) + len(pair)
    codes[parts.order] = in_order
    return codes, sums, counts


def integers(vectors: np.ndarray) -> np.ndarray:
    """floor(256 * x) of finite doubles: 64-bit integers, or Python's if squared distances of
    such values might not fit 62 bits."""
    vectors = np.asarray(vectors, np.float64)
    if not vectors.size or np.abs(vectors).max() < 2.0 ** 18:
        return np.floor(vectors * 256).astype(np.int64)
    return np.array([[math.floor(x * 256) if abs(x) < 2.0 ** 60 else int(x) * 256 for x in row]
                     for row in vectors.tolist()], dtype=object)


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    return flat.reshape(-1, dim)


def _same_kind(points: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    kind = object if object in (points.dtype, books.dtype) else np.int64
    return points.astype(kind), books.astype(kind)


def _limbs(value: int) -> list[int]:
    """Base 2^31 digits of an integer, the last one signed: they add up without overflow."""
    out = []
    while not -(1 << 62) <= value < 1 << 62:
        out.append(value & ((1 << LIMB) - 1))
        value >>= LIMB
    return [*out, value] if abs(value) < 1 << LIMB else [*out, value & ((1 << LIMB) - 1), value >> LIMB]


def _positions(points: np.ndarray, books: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(position, that part of all points, its codebook)."""
    width = books.shape[2]
    for p in range(len(books)):
        yield p, *_same_kind(points[:, p * width:(p + 1) * width], books[p])


def _round(kept: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: assign all parts, and the codebooks with the means of their parts."""
    parts, k, width = books.shape
    dim = parts * width
    shared = kept.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((parts, k, width), object), np.zeros((parts, k), np.int64)
        for batch in batches:
            points = integers(_vectors(batch.column(0), dim))
            for p, mine, book in _positions(points, shared.value):
                _, s, c = assign(mine, book)
                sums[p] += s
                counts[p] += c
        rows = [(p, e, -1, 0, int(counts[p, e])) for p, e in zip(*np.nonzero(counts))]
        rows += [(p, e, x, level, digit) for p, e, *_ in list(rows) for x in range(width)
                 for level, digit in enumerate(_limbs(int(sums[p, e, x])))]
        columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(),) * 4 + (pa.int64(),))] if rows else []
        if columns:
            yield pa.RecordBatch.from_arrays(columns, names=["part", "entry", "place", "level", "value"])

    added = (kept.select("vector").mapInArrow(run, "part int, entry int, place int, level int, value long")
             .groupBy("part", "entry", "place", "level").agg(F.sum("value").alias("value")))
    total: dict[tuple[int, int, int], int] = {}
    for r in added.collect():  # codebook-sized: parts x entries x places
        at = (r["part"], r["entry"], r["place"])
        total[at] = total.get(at, 0) + (r["value"] << (LIMB * r["level"]))
    moved = books.astype(object)
    for (p, e, place), value in total.items():
        if place >= 0:
            moved[p, e, place] = value // total[p, e, -1]
    return _compact(moved)


def _compact(books: np.ndarray) -> np.ndarray:
    return books.astype(np.int64) if all(abs(x) < 1 << 26 for x in books.flat) else books


def usable(rows: DataFrame, parts: int) -> tuple[DataFrame, int]:
    """(vec_id, label, vector as doubles) of the rows that can be coded, and the vectors' length.

    Left out: vectors that are NULL, empty, or hold NULL or non-finite components, whose length
    is no multiple of ``parts``, or is not the length of the first vector (by vec_id) that is left.
    """
    def finite(x):
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))

    vector = F.transform("embedding", lambda x: x.cast("double"))
    kept = rows.select("vec_id", "label", vector.alias("vector")).where(
        F.col("vector").isNotNull() & (F.size("vector") > 0) & (F.size("vector") % parts == 0) & F.forall("vector", finite))
    first = kept.select("vec_id", F.size("vector").alias("dim")).orderBy(F.asc_nulls_last("vec_id"), "dim").first()
    dim = first["dim"] if first else parts
    return kept.where(F.size("vector") == dim), dim


def train(kept: DataFrame, dim: int, parts: int = 16, entries: int = 64, rounds: int = 2) -> np.ndarray:
    """Codebooks (part, entry, place): they start as the parts of the first ``entries`` vectors by
    vec_id (NULL last; equal ids by vector) and take ``rounds`` Lloyd rounds over all rows. The
    mean is rounded down; an entry without parts stays."""
    first = kept.orderBy(F.asc_nulls_last("vec_id"), "vector").limit(entries).select("vector").collect()
    start = integers(np.array([r["vector"] for r in first]).reshape(-1, dim))
    books = start.reshape(len(first), parts, dim // parts).transpose(1, 0, 2)
    for _ in range(rounds if len(first) else 0):
        books = _round(kept, books)
    return books


def books_digest(books: np.ndarray) -> str:
    return sha256(",".join(str(int(x)) for x in books.ravel()).encode()).hexdigest()


def encode(kept: DataFrame, books: np.ndarray) -> DataFrame:
    """(vec_id, label, code, error): per row its entries' indexes, two hex digits each, and the
    sum of the squared distances (at most the largest long)."""
    parts, _, width = books.shape
    dim = parts * width
    shared = kept.sparkSession.sparkContext.broadcast(books)
    schema = T.StructType([kept.schema["vec_id"], kept.schema["label"], T.StructField("code", T.StringType()),
                           T.StructField("error", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            points = integers(_vectors(batch.column(2), dim))
            codes = np.zeros((len(points), parts), np.uint8)
            error = np.zeros(len(points), object)
            for p, mine, book in _positions(points, shared.value):
                nearest, _, _ = assign(mine, book)
                gap = mine - book[nearest]
                codes[:, p] = nearest
                error += (gap * gap).sum(axis=1)
            text = codes.tobytes().hex()
            wide = 2 * parts
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 pa.array([text[k:k + wide] for k in range(0, len(text), wide)], pa.string()),
                 pa.array([min(int(e), LONGEST) for e in error], pa.int64())], names=schema.names)

    return kept.mapInArrow(run, schema)


def compress(rows: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 for the rows of ``rows`` (vec_id,
    embedding, label; other columns are ignored) that :func:`usable` keeps.

    Components count as floor(256 * x). ``label_error`` adds ``error`` over the rows with the same
    label, NULL being one (at most the largest long). Codes need ``entries`` <= 256. Repeated rows
    all count; fewer rows than ``entries`` make a smaller codebook; no rows, no result.
    """
    python_workers(rows.sparkSession, rows=8192)
    kept, dim = usable(rows, parts)
    kept = materialize(kept, "integers")
    books = train(kept, dim, parts, entries, rounds)
    if not books.size:
        empty = kept.select("vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"),
                            F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"))
        return empty.where(F.lit(False))
    coded = materialize(encode(kept, books), "codes")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONGEST).cast("decimal(38,0)"))
    of = free_name(coded.columns, "of_label")
    by_label = coded.groupBy(F.col("label").alias(of)).agg(total.cast("long").alias("label_error"))
    by_label = broadcast_if_small(materialize(by_label, "label-errors"))
    return (coded.join(by_label, F.col("label").eqNullSafe(F.col(of)))
            .select("vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256")))
