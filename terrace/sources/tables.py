"""Stored tables addressed by path (no catalog), full-overwrite refresh semantics."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.session import _context

DEFAULT_FORMAT = "parquet"
# Formats whose tables are plain folders of files (others keep a schema of their own).
FILE_FORMATS = ("parquet", "orc", "csv", "json", "avro")


# A hidden folder of a partitioned table (readers skip names that begin with an underscore).
SCHEMA_FOLDER = "_schema"


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is there, asked of its own file system (any store Spark reads)."""
    context = _context(spark)
    if context is None:  # a client without a JVM of its own infers, as for any other table
        return False
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(context._jsc.hadoopConfiguration()).exists(folder)


def stored_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The schema that :func:`write_table` left beside a partitioned table, or None."""
    folder = f"{path.rstrip('/')}/{SCHEMA_FOLDER}"
    if not _exists(spark, folder):
        return None
    lines = spark.read.schema("value string").text(folder).collect()
    return T.StructType.fromJson(json.loads(lines[0]["value"])) if len(lines) == 1 else None


def read_table(spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT,
               partition_types: Mapping[str, str] | None = None) -> DataFrame:
    """Scan a stored table by path. Hive-style partition folders become columns and
    filters on them prune folders (``PartitionFilters`` in the plan).

    Folder names carry no type: Spark would infer one, and ``01`` and ``1`` become the same
    integer. Tables of :func:`write_table` carry their schema, which is used as it is. For
    tables written elsewhere ``partition_types`` declares the types (column -> type); columns
    that the table doesn't have are ignored.
    """
    schema = stored_schema(spark, path) if fmt in FILE_FORMATS else None
    reader = spark.read.format(fmt)
    df = reader.schema(schema).load(path) if schema is not None else reader.load(path)
    declared = {c.lower(): t for c, t in (partition_types or {}).items()}
    if not any(f.name.lower() in declared for f in df.schema):
        return df
    types = {c: T._parse_datatype_string(t) for c, t in declared.items()}
    if all(types.get(f.name.lower(), f.dataType) == f.dataType for f in df.schema):
        return df
    schema = T.StructType([T.StructField(f.name, types.get(f.name.lower(), f.dataType), True) for f in df.schema])
    return spark.read.format(fmt).schema(schema).load(path)


def write_table(df: DataFrame, path: str, fmt: str = DEFAULT_FORMAT,
                partition_by: Sequence[str] = (), max_records: int | None = None,
                rebalance: bool = True) -> None:
    """Full-overwrite write of ``df`` to ``path``.

    ``partition_by`` gives a Hive-style layout; ``max_records`` caps rows per file.
    For a partitioned write, ``rebalance`` first clusters rows by the partition columns
    with Spark's ``REBALANCE`` hint: each partition value is written by few tasks (few,
    large files instead of tasks x values small ones), and adaptive execution splits a
    value that holds a large share of the rows over several tasks, so skew cannot pile
    it into one writer. A partitioned table also gets its schema in a hidden folder, written
    by the same call right after the rows and replaced with them, so a reader knows the
    partition columns' types; if a run dies in between, readers infer them as for any other
    table, and the rerun mends it.
    Never overwrite a path that ``df`` itself reads: a Parquet overwrite is not atomic.
    """
    if rebalance and partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format(fmt).mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if max_records:
        writer = writer.option("maxRecordsPerFile", int(max_records))
    writer.save(path)
    if partition_by and fmt in FILE_FORMATS:
        last = [c.lower() for c in partition_by]
        fields = [f for f in df.schema if f.name.lower() not in last]
        fields += [next(f for f in df.schema if f.name.lower() == c) for c in last]
        text = T.StructType([T.StructField(f.name, f.dataType, True) for f in fields]).json()
        spark = df.sparkSession
        (spark.range(1, numPartitions=1).select(F.lit(text).alias("value"))
         .write.mode("overwrite").text(f"{path.rstrip('/')}/{SCHEMA_FOLDER}"))


@dataclass
class LoadSpec:
    """One landing file (or folder) and where its table goes.

    ``target`` defaults to the stem of the source name, one output folder per file.
    """

    source: str
    target: str | None = None
    options: dict = field(default_factory=dict)

    def target_name(self) -> str:
        stem = self.source.rstrip("/").rsplit("/", 1)[-1]
        for suffix in (".json", ".csv", ".parquet"):
            if stem.endswith(suffix):
                stem = stem[: -len(suffix)]
        return self.target or stem


def load_many(spark: SparkSession, specs: Iterable[LoadSpec],
              loader: Callable[[SparkSession, LoadSpec], DataFrame]) -> dict[str, DataFrame]:
    """Apply the same load to several landing files; one DataFrame per target name.

    The loop only builds lazy plans on the driver; each DataFrame is read and written
    by its own distributed job when the caller acts on it.
    """
    out: dict[str, DataFrame] = {}
    for spec in specs:
        name = spec.target_name()
        if name in out:
            raise ValueError(f"two load specs share the target {name!r}")
        out[name] = loader(spark, spec)
    return out
