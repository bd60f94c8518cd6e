"""Mixing sources to target sizes by cube-method balanced sampling.

Every document of a source is to be taken ``target / source size`` times on average. The whole
part is taken for sure; the fraction is an inclusion probability, and the cube method turns
the probabilities into 0 or 1. Its flight moves them through the null space of the balance
constraints, here the words and the number of documents taken: of three documents, the
direction (s2 - s3, s3 - s1, s1 - s2) changes neither. Each step settles at least one of them,
so a flight ends with two open probabilities. Blocks of documents fly in parallel, what is
open in a source's blocks flies again, and only the last two documents of a source are
landed: the outcome closest to the target wins.

Random steps come from seeds made of the source, level and block, and blocks are cut by hash
and ordered by value, so reruns agree whatever the partitioning.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.common import broadcast_if_small, free_name, materialize, python_workers, word_count
from terrace.llm.numbering import number_within

BLOCK_ROWS = 8192
SMALL = 1e-9


def source_targets(sizes: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5,
                   most: float = 2.0) -> DataFrame:
    """(source, source_size, target) from rows (source, size).

    Sources in code-point order, NULL last, take ``weights`` in turn. All targets together are
    ``share`` of all sizes; none exceeds ``most`` times its source's size, and what is cut off
    is dealt again by weight until none is above. The dealing is a loop of one small
    aggregate over the sources, each round of which settles at least one of them.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = number_within(sources.withColumn("none", F.col("source").isNull()), [], ["none", "source"], "place")
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    sources = materialize(sources.select("source", "source_size", turn.alias("weight"),
                                         (F.col("source_size") * most).alias("cap")), "sources")
    total = (sources.agg(F.sum("source_size")).first()[0] or 0) * share
    level = 0.0
    while True:
        full = F.col("weight") * level >= F.col("cap")
        used, left = sources.agg(F.sum(F.when(full, F.col("cap")).otherwise(0.0)),
                                 F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        if not left or (total - used) / left <= level:
            break
        level = (total - used) / left
    return sources.select("source", "source_size", F.least(F.col("cap"), F.col("weight") * level).alias("target"))


def flight(p: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Probabilities after the flight: sums of p and of p * size are kept, and at most two
    entries are left strictly between 0 and 1."""
    p = p.astype(float).copy()
    sizes = size.astype(float).tolist()
    draws = rng.random(len(p) * 2 + 2).tolist()
    value, open_, at = p.tolist(), [], 0
    for k in range(len(value)):
        if not SMALL < value[k] < 1 - SMALL:
            continue
        open_.append(k)
        while len(open_) >= 3 or (len(open_) == 2 and sizes[open_[0]] == sizes[open_[1]]):
            pair = next(((x, y) for i, x in enumerate(open_) for y in open_[i + 1:] if sizes[x] == sizes[y]), None)
            if pair:  # equal sizes: trade between the two
                units, way = pair, (1.0, -1.0)
            else:
                a, b, c = units = tuple(open_[:3])
                way = (sizes[b] - sizes[c], sizes[c] - sizes[a], sizes[a] - sizes[b])
            up = min((1 - value[u]) / w if w > 0 else value[u] / -w for u, w in zip(units, way))
            down = min(value[u] / w if w > 0 else (1 - value[u]) / -w for u, w in zip(units, way))
            step = up if draws[at % len(draws)] * (up + down) < down else -down
            at += 1
            for u, w in zip(units, way):
                value[u] += step * w
                if value[u] < SMALL:
                    value[u] = 0.0
                elif value[u] > 1 - SMALL:
                    value[u] = 1.0
            open_ = [u for u in open_ if 0.0 < value[u] < 1.0]
    return np.array([round(v) if not SMALL < v < 1 - SMALL else v for v in value])


def landing(p: np.ndarray, size: np.ndarray) -> np.ndarray:
    """0 or 1 for the few entries that are open (two after a flight): of all outcomes the one
    whose words are closest to the expected ones, then the one nearest in number."""
    at = np.flatnonzero((p > 0) & (p < 1))
    out = p.copy()
    if len(at):
        words, count = p[at] @ size[at], p[at].sum()
        best = min(product((0.0, 1.0), repeat=len(at)),
                   key=lambda x: (abs(np.array(x) @ size[at] - words), abs(sum(x) - count), x))
        out[at] = best
    return out


def _seed(*parts) -> int:
    return int.from_bytes(hashlib.blake2b(repr(parts).encode(), digest_size=8).digest(), "little")


def told_apart(rows: DataFrame) -> DataFrame:
    """``rows`` with ``again``: NULL for one row of those that are equal, 1, 2 ... for the others,
    so that equal rows spread over blocks. A hash skips the NULL."""
    group, row = rows.columns, free_name(rows.columns, "row")
    stored = materialize(rows.withColumn(row, F.monotonically_increasing_id()), "rows")
    numbered = number_within(stored, group, [row], "again").drop(row)
    return numbered.withColumn("again", F.when(F.col("again") > 0, F.col("again")))


def block(keys: Sequence[str], level: int, blocks: Column) -> Column:
    """The block of a unit, by its keys."""
    return F.pmod(F.xxhash64(*keys, F.lit(level)), blocks)


def take(rows: DataFrame, targets: DataFrame, block_rows: int = BLOCK_ROWS, seed: int = 5) -> DataFrame:
    """``rows`` (key..., source, size) with ``copies``: how often each is taken.

    ``rows`` must be a stored table. Columns besides source and size travel along and order the
    units, so they should tell rows apart where they can.
    """
    python_workers(rows.sparkSession)
    names = rows.columns
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    units = (rows.join(targets.withColumnRenamed("source", "of"), rows["source"].eqNullSafe(F.col("of")))
             .withColumn("ratio", F.when(F.col("size") > 0, ratio).otherwise(0.0))
             .withColumn("whole", F.floor(F.col("ratio") + SMALL).cast("long"))
             .withColumn("p", F.greatest(F.col("ratio") - F.col("whole"), F.lit(0.0)))
             .select(*names, "whole", "p"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in units.schema) + ", block long"

    def fly(level: int, land: bool):
        def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values(["size", *[n for n in names if n != "size"]], kind="stable", ignore_index=True)
            # A random order, drawn after sorting: the same for the same rows.
            source = None if pd.isna(key[0]) else str(key[0])
            rng = np.random.default_rng(_seed(seed, level, source, int(key[1])))
            rows = rows.iloc[rng.permutation(len(rows))]
            size = rows["size"].to_numpy(float)
            p = flight(rows["p"].to_numpy(float), size, rng)
            return rows.assign(p=landing(p, size) if land else p)
        return run

    decided, level = None, 0
    keys = [n for n in names if n != "source"]
    while True:
        blocks = (units.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
                  .select(F.col("source").alias("of"), F.greatest(F.ceil(F.col("n") / block_rows), F.lit(1)).alias("blocks")))
        blocks = materialize(blocks, "blocks")
        last = (blocks.agg(F.max("blocks")).first()[0] or 1) <= 1
        dealt = (units.join(blocks, units["source"].eqNullSafe(F.col("of"))).drop("of")
                 .withColumn("block", block(keys, level, F.col("blocks"))).drop("blocks"))
        flown = materialize(dealt.groupBy("source", "block").applyInPandas(fly(level, last), schema).drop("block"), "flown")
        is_open = (F.col("p") > 0) & (F.col("p") < 1)
        done = flown.where(~is_open)
        decided = done if decided is None else decided.unionByName(done)
        if last:
            break
        units, level = flown.where(is_open), level + 1
    return decided.select(*names, (F.col("whole") + F.col("p").cast("long")).alias("copies"))


def mix(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Mix all rows of ``docs`` (doc_id, text, source): doc_id, size (words), source_size,
    target (of the source) and taken (words, repeats counted: 0, 1 or 2 times the size).

    A NULL text has no words; a document without words is never taken. Rows without a source
    are one source of their own, the last. Every row is a unit, also if it repeats another;
    equal rows are interchangeable. An empty table gives no rows. Other columns are ignored.
    """
    rows = materialize(told_apart(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))), "sizes")
    targets = materialize(source_targets(rows, weights, share, most), "targets")
    copies = take(rows, targets)
    return (copies.join(targets.withColumnRenamed("source", "of"), copies["source"].eqNullSafe(F.col("of")))
            .select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")))


def mixed_documents(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5,
                    most: float = 2.0) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with their own columns.

    What is taken depends on the rows alone, not on their order or partitions: rows are known by
    128 bits of hash of all their columns, and equal rows, which are interchangeable, by a number.
    """
    names = docs.columns
    row, count = free_name(names, "row_no"), free_name(names, "copies")
    stored = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "documents")
    every = [F.col(f"`{c}`") for c in names]
    null = F.concat(*[F.when(c.isNull(), "n").otherwise("v") for c in every])
    known = stored.select(F.col(row).alias("row"), F.xxhash64(null, *every).alias("k1"),
                          F.xxhash64(F.lit("second"), *reversed(every), null).alias("k2"),
                          F.col("source"), word_count(F.col("text")).alias("size"))
    known = materialize(number_within(known, ["k1", "k2"], ["row"], "again"), "sizes")
    targets = materialize(source_targets(known, weights, share, most), "targets")
    taken = take(known.select("k1", "k2", "again", "source", "size"), targets).where("copies > 0")
    copies = materialize(taken.select("k1", "k2", "again", F.col("copies").cast("int").alias(count))
                         .join(known.select(F.col("row").alias(row), "k1", "k2", "again"), ["k1", "k2", "again"])
                         .select(row, count), "copies")
    return (stored.join(broadcast_if_small(copies), row)
            .withColumn(count, F.explode(F.sequence(F.lit(1), F.col(count)))).select(*names))
