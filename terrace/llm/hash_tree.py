"""Sharding by a hierarchical weighted hash tree.

A document descends a tree of regions, racks and shards. At each level every child draws
``-ln(u) / weight`` with u a hash of the document's id and the child's name, and the smallest
draw wins, so children get documents in proportion to their weights and a document's choice
among the others does not depend on a child whose weight changes. A change of weights thus
moves documents only into, out of or within the subtrees it touches. A shard that joins
does so as a region of its own: all it changes is one child of the root, so documents move
into it and nowhere else.

DataFrame functions only. The tree is part of the plan, as the shards of a cluster are few.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.numbering import number_within

# 13 hex digits of the hash: 52 bits, exact in a double.
_DIGITS, _RANGE = 13, 2.0**52


@dataclass(frozen=True)
class Shard:
    shard: int
    region: int
    rack: int
    weight: float = 1.0


def topology(shards: int, base: int = 24, racks: int = 2, rack_size: int = 4) -> list[Shard]:
    """The first ``base`` shards in regions of ``racks`` racks of ``rack_size``; every further
    shard is a region of one rack of one shard, so it takes keys from all and gives none back.

    ``base`` belongs to the cluster, not to a call: whoever adds shards keeps the one the cluster
    was built with (0: every shard a region). A tree of fewer shards than ``base`` has no base.
    """
    base = base if shards >= base else 0
    region_size = racks * rack_size
    tree = [Shard(k, k // region_size, k % region_size // rack_size) for k in range(base)]
    first = -(-base // region_size)
    return tree + [Shard(k, first + k - base, 0) for k in range(base, shards)]


def _draw(key: Column, name: str, weight: float) -> Column:
    """The child's draw for the key: exponential with the child's weight as its rate."""
    digits = F.substring(F.md5(F.concat(key, F.lit(":" + name))), 1, _DIGITS)
    uniform = (F.conv(digits, 16, 10).cast("double") + 1.0) / F.lit(_RANGE)
    return -F.log(uniform) / F.lit(float(weight))


def _choose(key: Column, children: dict[int, tuple[str, float]]) -> Column:
    """The child (by number) with the smallest draw; ties go to the smaller number."""
    if len(children) == 1:
        return F.lit(next(iter(children))).cast("int")
    draws = [F.struct(_draw(key, name, weight).alias("draw"), F.lit(number).cast("int").alias("child"))
             for number, (name, weight) in children.items()]
    return F.array_min(F.array(*draws))["child"]


def _case(on: Column, branches: dict[int, Column]) -> Column:
    """The branch for the value of ``on``; only that one is evaluated."""
    out = None
    for value, branch in branches.items():
        out = F.when(on == value, branch) if out is None else out.when(on == value, branch)
    return out


def place(df: DataFrame, key: Column, tree: Sequence[Shard], region: str, rack: str, shard: str) -> DataFrame:
    """Add the region, rack and shard that ``key`` (a string column) descends to."""
    racks: dict[int, dict[int, list[Shard]]] = {}
    for s in tree:
        racks.setdefault(s.region, {}).setdefault(s.rack, []).append(s)
    weight = {r: {k: sum(s.weight for s in shards) for k, shards in inside.items()} for r, inside in racks.items()}
    df = df.withColumn(region, _choose(key, {r: (f"region {r}", sum(w.values())) for r, w in weight.items()}))
    df = df.withColumn(rack, _case(F.col(region), {
        r: _choose(key, {k: (f"rack {r}/{k}", x) for k, x in w.items()}) for r, w in weight.items()}))
    return df.withColumn(shard, _case(F.col(region), {
        r: _case(F.col(rack), {k: _choose(key, {s.shard: (f"shard {s.shard}", s.weight) for s in shards})
                               for k, shards in inside.items()}) for r, inside in racks.items()}))


def assign(docs: DataFrame, shards: int = 24, base: int = 24) -> DataFrame:
    """Put every row of ``docs`` (doc_id, text; other columns are ignored) into a shard.

    ``base`` as in :func:`topology`; below it the cluster has none, and keeps none when it grows.

    Columns: doc_id, size (UTF-8 bytes of the text and 8 more; a NULL text has none),
    text_crc32 (unsigned; 0 for NULL), law (always ``key``: id and shard count decide),
    shard, slot (gapless from 0 within the shard, by id, then size and checksum),
    grown_shard (the shard with one more), region and rack. Rows without an id share one
    key; repeated rows go to one shard with a slot each.
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    rows = docs.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), F.lit("key").alias("law"))
    rows = place(rows, key, topology(shards, base), "region", "rack", "shard")
    rows = place(rows, key, topology(shards + 1, base if shards >= base else 0), "grown_region", "grown_rack", "grown_shard")
    rows = number_within(rows.drop("grown_region", "grown_rack"), ["shard"], ["doc_id", "size", "text_crc32"], "slot")
    return rows.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "region", "rack")
