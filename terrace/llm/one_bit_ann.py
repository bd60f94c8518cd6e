"""Nearest neighbours by inner product with randomly rotated one-bit codes.

Vectors are centred on the mean, rotated at random, and kept as one sign bit per dimension
plus two numbers: the length of the centred vector and the cosine between it and its code.
A query's inner product with a vector is estimated from the bits and these numbers, with an
error bound that holds but for a chance set by ``CONFIDENCE``. The exact product, in double
precision on the original vectors, is worked out only where the bound leaves a chance to be
among the nearest.

Queries and vectors are cut into blocks of bounded size, and every pair of blocks is a task
of its own: a stated set of queries against all rows. A pair gives at most ``k`` rows per
query, which are then ranked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.common import materialize, python_workers, rows_per_group
from terrace.llm.pivot_neardup import usable

# Standard deviations of the estimate's error that the bound allows for.
CONFIDENCE = 3.0
VECTOR_BLOCK, QUERY_BLOCK = 16_384, 2048


def rotation(dim: int, seed: int = 3) -> np.ndarray:
    """A random rotation of ``dim`` dimensions, the same wherever it is made."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def means(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Mean vector for each dimension, from partial sums: one row per batch and dimension
    goes to a Spark aggregate, one per dimension and component to the driver."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, part in batch.groupby(batch["embedding"].map(len)):
                yield pd.DataFrame({"dim": dim, "n": len(part), "at": np.arange(dim),
                                    "total": np.array(part["embedding"].tolist(), np.float64).sum(axis=0)})

    rows = (vectors.select("embedding").mapInPandas(run, "dim int, n long, at int, total double")
            .groupBy("dim", "at").agg((F.sum("total") / F.sum("n")).alias("mean")).collect())
    out: dict[int, np.ndarray] = {}
    for r in rows:
        out.setdefault(r["dim"], np.zeros(r["dim"]))[r["at"]] = r["mean"]
    return out


def encode(vectors: DataFrame, centre: dict[int, np.ndarray], seed: int = 3) -> DataFrame:
    """``vectors`` (row, vec_id, embedding) with code (packed sign bits), length and fit."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, part in batch.groupby(batch["embedding"].map(len)):
                rest = np.array(part["embedding"].tolist(), np.float64) - centre[dim]
                turned = rest @ rotation(dim, seed)
                length = np.linalg.norm(turned, axis=1)
                fit = np.abs(turned).sum(axis=1) / np.sqrt(dim) / np.where(length > 0, length, 1)
                yield pd.DataFrame({"row": part["row"], "vec_id": part["vec_id"], "embedding": part["embedding"],
                                    "code": [x.tobytes() for x in np.packbits(turned > 0, axis=1)],
                                    "length": length, "fit": np.where(length > 0, fit, 1.0)})

    return vectors.select("row", "vec_id", "embedding").mapInPandas(
        run, f"row long, vec_id long, embedding {vectors.schema['embedding'].dataType.simpleString()}, "
             "code binary, length double, fit double")


def exact(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products in double precision, added in the order of the components; ``rows`` holds
    a vector in each column."""
    total = np.zeros(rows.shape[1])
    for q, column in zip(query, rows):
        total += q * column
    return total


def search_block(queries: pd.DataFrame, vectors: pd.DataFrame, k: int, centre: dict[int, np.ndarray],
                 seed: int = 3, confidence: float = CONFIDENCE) -> list[tuple]:
    """(query_row, query_id, vec_id, score) of the k nearest of a block, for each query of a block.

    Estimates and the first sifting of what the bound leaves are in single precision with
    an allowance for its rounding (in double, if the numbers are too large or small for it);
    the scores that count are in double precision."""
    out = []
    dims = queries["embedding"].map(len).to_numpy()
    theirs = vectors["embedding"].map(len).to_numpy()
    for dim in np.unique(dims):
        part = vectors[theirs == dim].sort_values(["vec_id", "row"], kind="stable")
        if not len(part):
            continue
        ids = part["vec_id"].to_numpy()
        rows = np.array(part["embedding"].tolist(), np.float64)
        asked = queries[dims == dim]
        asked_ids, asked_rows = asked["vec_id"].to_numpy(), asked["row"].to_numpy()
        q = np.array(asked["embedding"].tolist(), np.float64)
        norm, longest = np.linalg.norm(q, axis=1), np.linalg.norm(rows, axis=1).max()
        plain = all(1e-15 < x < 1e15 for x in (longest, norm.max(), norm.min()))
        kind = np.float32 if plain else np.float64
        rows_, q_ = rows.astype(kind), q.astype(kind)
        packed = np.frombuffer(b"".join(part["code"]), np.uint8).reshape(len(part), -1)
        signs = (np.unpackbits(packed, axis=1, count=int(dim)).astype(kind) * 2 - 1) / np.sqrt(kind(dim))
        length, fit = part["length"].to_numpy(), part["fit"].to_numpy()
        scale = (length / fit).astype(kind)
        spread = (length * np.sqrt(np.maximum(1 - fit**2, 0)) / fit * confidence / np.sqrt(max(dim - 1, 1))).astype(kind)
        slack = (norm * longest * (dim + 64) * 2 * np.finfo(kind).eps).astype(kind)
        turned, base = (q @ rotation(int(dim), seed)).astype(kind), (q @ centre[dim]).astype(kind)
        place = pd.Index(part["row"]).get_indexer(asked_rows)
        here = place >= 0
        for a in range(0, len(asked), 128):
            estimates = turned[a:a + 128] @ signs.T * scale + base[a:a + 128, None]
            for i, estimate in enumerate(estimates, a):
                if here[i]:
                    estimate[place[i]] = -np.inf
                n = min(k, len(ids) - int(here[i]))
                if not n:
                    continue
                # The k best by estimate give a score that the k nearest reach in any case.
                first = np.argpartition(estimate, len(ids) - n)[len(ids) - n:]
                floor = (rows_[first] @ q_[i]).min() - slack[i]
                left = estimate + spread * kind(norm[i]) >= floor
                left[first] = True
                near = np.flatnonzero(left)
                rough = rows_[near] @ q_[i]
                near = near[rough >= np.partition(rough, len(rough) - n)[len(rough) - n] - 2 * slack[i]]
                score = exact(q[i], rows[near].T)
                best = np.lexsort((ids[near], -score))[:n]
                out += [(int(asked_rows[i]), int(asked_ids[i]), v, s) for v, s in zip(ids[near][best].tolist(), score[best].tolist())]
    return out


def search(vectors: DataFrame, is_query: Column, k: int = 20, vector_block: int = VECTOR_BLOCK,
           query_block: int = QUERY_BLOCK) -> DataFrame:
    """The ``k`` nearest other rows by inner product for each row of ``vectors`` (vec_id,
    embedding) where ``is_query``: query_id, rank (from 1), vec_id, score.

    Nearest first, ties to the smaller vec_id; all candidates if there are fewer than ``k``.
    Vectors that are NULL, empty, zero or hold NULL or non-finite components and rows without
    a vec_id take no part. Rows that repeat a vec_id all count, as queries (each with ranks
    of its own) and as candidates, also of one another. Vectors of different length have no inner product and don't meet. Other
    columns are ignored.
    """
    python_workers(vectors.sparkSession)
    rows = vectors.select("vec_id", "embedding").where(usable() & F.col("vec_id").isNotNull())
    rows = materialize(rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "embedding"), "vectors")
    centre = means(rows)
    coded = materialize(encode(rows, centre), "codes")
    queries = rows.where(F.coalesce(is_query, F.lit(False)))
    n_vectors, n_queries = rows_per_group(coded, vector_block), rows_per_group(queries, query_block)

    def numbers(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = (queries.withColumn("qb", F.pmod(F.xxhash64("row", F.lit("query")), F.lit(n_queries)).cast("int"))
            .withColumn("vb", numbers(n_vectors)))
    right = (coded.withColumn("vb", F.pmod(F.xxhash64("row"), F.lit(n_vectors)).cast("int"))
             .withColumn("qb", numbers(n_queries)))

    def run(q: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        found = search_block(q, v, k, centre) if len(q) and len(v) else []
        return pd.DataFrame(found, columns=["query_row", "query_id", "vec_id", "score"])

    found = (left.groupBy("qb", "vb").cogroup(right.groupBy("qb", "vb"))
             .applyInPandas(run, "query_row long, query_id long, vec_id long, score double"))
    order = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
