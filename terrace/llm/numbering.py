"""Gapless numbers within groups, for groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.common import free_name, materialize

_POSITION_BITS = 33


def number_within(df: DataFrame, group: Sequence[str], order: Sequence[str], name: str = "no") -> DataFrame:
    """Add ``name`` = 0, 1, 2 ... within each ``group``, in ``order``.

    The rows are range-sorted by group and order, so a group of any size is spread over as
    many tasks as it needs, and written once to the shared folder with their positions. Only
    the counts per group and sort partition are windowed: their number follows the
    partitions, not the rows.
    """
    at, part = free_name(df.columns, "at"), free_name(df.columns, "part")
    rows = materialize(df.orderBy(*group, *order).withColumn(at, F.monotonically_increasing_id()), "numbered")
    rows = rows.withColumn(part, F.shiftright(at, _POSITION_BITS))
    first, count, before = (free_name(rows.columns, n) for n in ("first", "count", "before"))
    parts = rows.groupBy(*group, part).agg(F.min(at).alias(first), F.count(F.lit(1)).alias(count))
    earlier = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn(before, F.coalesce(F.sum(count).over(earlier), F.lit(0))).drop(count)
    theirs = {c: free_name(rows.columns, f"of_{c}") for c in [*group, part]}
    parts = parts.withColumnsRenamed(theirs)
    same = [F.col(f"`{c}`").eqNullSafe(F.col(f"`{of}`")) for c, of in theirs.items()]
    joined = rows.join(parts, same)
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], (F.col(at) - F.col(first) + F.col(before)).alias(name))
