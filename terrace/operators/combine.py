"""Distinct lists, deterministic de-duplication, first-non-NULL, unions, previews.

De-duplication and first-value picks are expressed as aggregations (``min`` over a
struct, ``min_by``) rather than ``row_number()`` windows: an aggregation combines
map-side before the shuffle, so a key holding a third of all rows still reaches the
reducer as one partial row per map task instead of one giant sorted window partition.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.operators.keys import store_counted
from terrace.operators.shape import fill_nulls


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def distinct_members(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct combinations of ``cols`` (a dimension's member list)."""
    return df.select(*[_q(c) for c in cols]).dropDuplicates()


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(_q(column)).distinct()


def sorted_distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values in ascending order (NULL first). The sort sits above the distinct,
    so the optimiser cannot discard it."""
    return distinct_values(df, column).orderBy(_q(column).asc_nulls_first())


DUPLICATE_KEYS_LIMIT = 64 * 1024 * 1024
# Rows of one key from which they are combined before the shuffle.
HOT_DUPLICATES = 100_000


def key_digest(keys: Sequence[str]) -> list[Column]:
    """128 bits of hash of a key, NULLs told apart from values: equal keys have equal digests, and
    at 10^12 keys the chance that any two different ones do is below 10^-14."""
    cols = [_q(k) for k in keys]
    nulls = F.concat(*[F.when(c.isNull(), "n").otherwise("v") for c in cols])
    return [F.xxhash64(nulls, *cols), F.xxhash64(F.lit("second"), *reversed(cols), nulls)]


def dedupe(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None,
           ascending: bool = True, late_rows: bool = True) -> DataFrame:
    """Keep exactly one row per ``keys`` combination, chosen deterministically.

    The survivor has the smallest (``ascending``) or largest ``order_by`` tuple, NULLs
    ordered first; ``order_by`` defaults to all non-key columns, so the choice never
    depends on partitioning. Rows that tie on every column are identical anyway.

    Keys are grouped by a digest of two longs, never sorted as text. The first long alone deals rows
    out and lists keys, the second tells keys apart that share it and is only worked out where rows
    are grouped, so it is not shuffled. Most rows of an extract are
    the only ones of their key, and those need no comparing: a hash aggregate over the first long
    alone finds the keys with several rows first. If the list of those is small (measured; up to
    ``DUPLICATE_KEYS_LIMIT`` it is broadcast), all other rows stay where they are and only rows of
    listed keys are shuffled and compared. Otherwise rows are shuffled once and sorted only there:
    most keys have too few rows for the sort of a map-side aggregation to pay. Only keys with more
    than ``HOT_DUPLICATES`` rows, of which there are few, keep it. With ``late_rows=False`` (``df``
    is costly to evaluate, or known to repeat most keys) all rows go through one aggregation. A key
    that holds a third of the rows reaches the reducer as one partial row per map task either way.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    order = list(order_by) if order_by is not None else rest
    payload = order + [c for c in rest if c not in order]
    if not payload:
        return df.dropDuplicates(keys)
    first, second = key_digest(keys)
    marked = df.withColumn("_k1", first)
    names = payload + [k for k in keys if k not in payload]
    pick = F.min if ascending else F.max

    def survivors(rows: DataFrame) -> DataFrame:
        best = rows.withColumn("_k2", second).groupBy("_k1", "_k2").agg(pick(F.struct(*[_q(c).alias(f"_f{i}") for i, c in enumerate(names)])).alias("_best"))
        of = {c: F.col(f"_best._f{i}") for i, c in enumerate(names)}
        return best.select(*[of[c].alias(c) for c in keys + [c for c in payload if c not in keys]])

    if not late_rows:
        return survivors(marked)
    repeated = marked.groupBy("_k1").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    rows, repeated = store_counted(repeated, "repeated-keys")
    if rows * 32 > DUPLICATE_KEYS_LIMIT:
        hot = repeated.where(F.col("_n") > HOT_DUPLICATES).select("_k1")
        if hot.isEmpty():
            return survivors(marked.repartition("_k1"))
        hot = F.broadcast(hot)
        cold = marked.join(hot, "_k1", "left_anti").repartition("_k1")
        return survivors(cold).unionByName(survivors(marked.join(hot, "_k1", "left_semi")))
    repeated = repeated.select("_k1")
    out = keys + [c for c in payload if c not in keys]
    alone = marked.join(F.broadcast(repeated), "_k1", "left_anti").select(*[_q(c) for c in out])
    return alone.unionByName(survivors(marked.join(F.broadcast(repeated), "_k1", "left_semi")))


def first_non_null(df: DataFrame, keys: Sequence[str], column: str, alias: str | None = None,
                   order_by: str | Sequence[str] | None = None) -> DataFrame:
    """Per ``keys``, the first non-NULL ``column`` value by ``order_by`` (one column or several,
    NULLs first; of values that tie the smallest), or the smallest non-NULL value when no order
    is given. NULL when the group has none."""
    order = [order_by] if isinstance(order_by, str) else list(order_by or [])
    value = _q(column)
    pick = F.struct(*[_q(c).alias(f"_o{i}") for i, c in enumerate(order)], value.alias("_v"))
    first = F.min(F.when(value.isNotNull(), pick))["_v"]
    return df.groupBy(*[_q(k) for k in keys]).agg(first.alias(alias or column))


def union_all_by_name(*dfs: DataFrame) -> DataFrame:
    """Bag union aligned by column name; every input must have the same column set."""
    if not dfs:
        raise ValueError("nothing to union")
    first = {c.lower() for c in dfs[0].columns}
    for other in dfs[1:]:
        if {c.lower() for c in other.columns} != first:
            raise ValueError(f"column sets differ: {sorted(first)} vs {sorted(c.lower() for c in other.columns)}")
    return reduce(lambda a, b: a.unionByName(b), dfs)


def consolidate(dfs: Sequence[DataFrame], keys: Sequence[str], fill: Mapping[str, object] | None = None,
                order_by: Sequence[str] | None = None) -> DataFrame:
    """Overlapping extracts -> one table: union by name, fill NULLs (so they take part in
    the key), then keep one row per key."""
    merged = union_all_by_name(*dfs)
    if fill:
        merged = fill_nulls(merged, fill)
    return dedupe(merged, keys, order_by)


def preview(df: DataFrame, n: int | None = 20, order_by: Sequence[str] | None = None) -> DataFrame:
    """The first ``n`` rows by ``order_by`` (default: all columns). Planned as a per-task
    top-n followed by a merge, never a full sort. ``n=None`` lists every row in order
    (a distributed range sort), for evidence listings such as a column's value list."""
    order = [_q(c).asc_nulls_first() for c in (order_by or df.columns)]
    ordered = df.orderBy(*order)
    return ordered if n is None else ordered.limit(n)


def count_rows(df: DataFrame, alias: str = "n_rows") -> DataFrame:
    """Row count as a one-row DataFrame (map-side partial counts, one tiny shuffle)."""
    return df.agg(F.count(F.lit(1)).alias(alias))
