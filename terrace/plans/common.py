"""Shared pieces of the subject-area jobs: storage layout and star assembly."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.operators.star import Dimension, DimensionSpec, build_dimensions, store_dimension
from terrace.operators.profile import log_evidence
from terrace.sources.tables import read_table, write_table

FACT_MAX_RECORDS = 1_000_000
# Independent table writes submitted at once from driver threads (Spark schedules jobs
# from several threads side by side, filling executor slots idle between stages).
WRITE_CONCURRENCY = 4

T_ = TypeVar("T_")


def concurrently(tasks: Sequence[Callable[[], T_]], workers: int = WRITE_CONCURRENCY) -> list[T_]:
    """Run independent Spark actions (e.g. writes of different tables) side by side and
    return their results in order; the first failure is raised."""
    if len(tasks) <= 1 or workers <= 1:
        return [t() for t in tasks]
    with ThreadPoolExecutor(max_workers=min(workers, len(tasks))) as pool:
        futures = [pool.submit(t) for t in tasks]
        return [f.result() for f in futures]


@dataclass(frozen=True)
class Layout:
    """Where an area's files live. ``landing`` holds the source extracts; ``warehouse``
    the bronze/silver/gold tables, addressed by path. ``fmt`` is the table format
    (parquet by default; any format whose connector is on the classpath works).
    ``evidence=True`` logs every written table's schema report and a preview."""

    landing: str
    warehouse: str
    fmt: str = "parquet"
    evidence: bool = False

    def path(self, layer: str, table: str) -> str:
        return f"{self.warehouse.rstrip('/')}/{layer}/{table}"

    def src(self, name: str) -> str:
        return f"{self.landing.rstrip('/')}/{name}"

    def read(self, spark: SparkSession, layer: str, table: str,
             partition_types: Mapping[str, str] | None = None) -> DataFrame:
        return read_table(spark, self.path(layer, table), self.fmt, partition_types)

    def write(self, df: DataFrame, layer: str, table: str, partition_by: Sequence[str] = (),
              max_records: int | None = None) -> None:
        write_table(df, self.path(layer, table), self.fmt, partition_by, max_records)
        if self.evidence:
            log_evidence(read_table(df.sparkSession, self.path(layer, table), self.fmt), f"{layer}/{table}")


@dataclass(frozen=True)
class DimSpec:
    """A gold dimension: table name, natural key, dependent attributes, key column, and
    ``derived`` attributes given as SQL expressions over the members (e.g. ``hour(ts)``)."""

    table: str
    natural_key: tuple[str, ...]
    sk: str
    attributes: tuple[str, ...] = ()
    derived: Mapping[str, str] | None = None


def build_and_store(layout: Layout, source: DataFrame, specs: Mapping[str, DimSpec]) -> dict[str, Dimension]:
    """Build the dimensions of one source in a single scan, write each to gold and return
    the stored copies, so the fact is built from exactly the keys that were written."""
    dims = build_dimensions(source, {
        name: DimensionSpec(spec.natural_key, spec.sk, spec.attributes,
                            {k: F.expr(v) for k, v in spec.derived.items()} if spec.derived else None)
        for name, spec in specs.items()})
    names = list(dims)
    stored = concurrently([lambda n=n: store_dimension(dims[n], layout.path("gold", specs[n].table), layout.fmt)
                           for n in names])
    return dict(zip(names, stored))
