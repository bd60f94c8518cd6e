"""Dense, deterministic surrogate keys without a single-partition window over the data.

Members must be unique on the ordering columns. They are range-sorted, tagged with
``monotonically_increasing_id()`` (partition index in the high bits, position in the low 33
bits) and written to a table in the shared checkpoint folder, which cuts the lineage. That
write observes how many rows each sort partition has; their running sums are the offsets, and
the key is offset + position + 1, a projection of the stored rows. No second pass counts
anything, nothing but the partition counts reaches the driver, and the path is the same at
every size.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from terrace.session import shared_dir

_POSITION_BITS = 33
ROW_ID = "_row_id"


def payload_row_bytes(cols: Sequence[str]) -> Column:
    """Per-row payload of ``cols``: text by octet length plus 8 bytes for every value."""
    per_row = sum((F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in cols), F.lit(0))
    return per_row + F.lit(8 * len(cols))


def payload_bytes(cols: Sequence[str]) -> Column:
    """Aggregate: measured in-memory payload of ``cols``. The size proof behind a
    broadcast decision."""
    return F.sum(payload_row_bytes(cols))


def measure(df: DataFrame) -> tuple[int, int]:
    """(rows, payload bytes) of ``df`` in one aggregation pass."""
    stats = df.agg(F.count(F.lit(1)).alias("n"), payload_bytes(df.columns).alias("b")).first()
    return int(stats["n"]), int(stats["b"] or 0)


def measure_bounded(df: DataFrame, limit_bytes: int) -> tuple[int, int] | None:
    """(rows, payload bytes) of ``df`` if its payload is at most ``limit_bytes``, else None.

    One distributed aggregation (partial counts and byte sums per task, combined on one
    row). A ``limit``-based early exit is deliberately not used: Spark plans it as a
    single-partition exchange of up to the limit's rows, costlier than this pass.
    """
    rows, size = measure(df)
    return (rows, size) if size <= limit_bytes else None


def _order(natural_key: Sequence[str]) -> list[Column]:
    return [F.col(f"`{c}`").asc_nulls_first() for c in natural_key]


def store_counted(df: DataFrame, name: str) -> tuple[int, DataFrame]:
    """Write ``df`` to the shared folder (a lineage cut) and read it back, with the row count that
    the write observed."""
    observation = Observation(f"{name}_{uuid.uuid4().hex}")
    path = shared_dir(df.sparkSession, name)
    df.observe(observation, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return int(observation.get["rows"]), df.sparkSession.read.schema(df.schema).parquet(path)


def order_of(natural_key: Sequence[str]) -> list[Column]:
    return [F.col(f"`{c}`").asc_nulls_first() for c in natural_key]


@dataclass
class Tagged:
    """Stored rows in sort order, their ``ROW_ID``, the first rank of each sort partition, and
    what was observed while they were written."""

    df: DataFrame
    offsets: list[int]
    metrics: dict[str, object]

    def rank(self) -> Column:
        """Place of a row in the whole order, from 1."""
        position = F.col(ROW_ID).bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
        if len(self.offsets) > 1:
            known = F.split(F.lit(",".join(map(str, self.offsets))), ",").cast("array<bigint>")
            position = position + F.element_at(known, (F.shiftright(F.col(ROW_ID), _POSITION_BITS) + 1).cast("int"))
        return position + F.lit(1)


def write_tagged(ranged: DataFrame, name: str, metrics: Mapping[str, Column] | None = None) -> Tagged:
    """Write ``ranged`` (range-partitioned and sorted within its partitions) once, with row ids,
    observing ``metrics`` and the rows of each partition.

    The counts per partition are a histogram of the partition index with more bins than there
    are partitions, so every index keeps a bin of its own and the counts are exact. The
    metrics sit in the writing stage, whose tasks count once however often one is run again.
    """
    spark = ranged.sparkSession
    most = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
               int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or 0))
    tagged = ranged.withColumn(ROW_ID, F.monotonically_increasing_id())
    part = F.shiftright(F.col(ROW_ID), _POSITION_BITS).cast("double")
    observation = Observation(f"{name}_{uuid.uuid4().hex}")  # unique: builds may run side by side
    observed = tagged.observe(observation, F.count(F.lit(1)).alias("_rows"),
                              F.histogram_numeric(part, F.lit(2 * most + 16)).alias("_parts"),
                              *[m.alias(k) for k, m in (metrics or {}).items()])
    path = shared_dir(spark, name)
    observed.write.mode("overwrite").parquet(path)
    seen = dict(observation.get)
    counts = {int(b["x"]): int(b["y"]) for b in (seen.pop("_parts") or [])}
    if sum(counts.values()) != seen["_rows"] or len(counts) > most:
        raise RuntimeError(f"{name}: {seen['_rows']} rows, but {sum(counts.values())} in {len(counts)} partitions")
    offsets, total = [], 0
    for k in range(max(counts, default=-1) + 1):
        offsets.append(total)
        total += counts.get(k, 0)
    return Tagged(spark.read.schema(tagged.schema).parquet(path), offsets, seen)


def add_surrogate_key(df: DataFrame, natural_key: Sequence[str], sk: str) -> DataFrame:
    """Add ``sk`` = 1..n, dense and ordered by ``natural_key`` (NULLs first).

    Rows must be unique on ``natural_key`` for the numbering to be stable; then the key
    depends only on the data, never on partition boundaries or on re-evaluation.
    """
    tagged = write_tagged(df.orderBy(*order_of(natural_key)), "keys")
    return tagged.df.select(*[F.col(f"`{c}`") for c in df.columns], tagged.rank().alias(sk))
