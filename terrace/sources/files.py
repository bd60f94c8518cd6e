"""Row-oriented landing formats: headered CSV and JSON envelopes.

A JSON *envelope* is one JSON object per file whose records sit in an array under a
root key (``{"value": [{...}, ...]}``). Such a file is not splittable, so the reader
spreads the exploded records over the cluster before any further work, and the
writer caps the records per envelope so no single file (or task) grows with the data.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.sources.landing import land_csv


def read_csv(spark: SparkSession, path: str | list[str], delimiter: str = ",",
             schema: T.StructType | str | None = None, header: bool = True) -> DataFrame:
    """Headered CSV scan.

    With ``schema`` the scan is lazy and typed by it. Without one the types are those of the
    values, as the landing jobs infer them, yet the extract is parsed once
    (:func:`terrace.sources.landing.land_csv`).
    """
    if schema is None:
        return land_csv(spark, path, delimiter, header)
    return spark.read.option("header", header).option("delimiter", delimiter).schema(schema).csv(path)


def write_csv(df: DataFrame, path: str, delimiter: str = ",") -> None:
    """Write a headered CSV folder (full overwrite); used to stage landing files."""
    df.write.mode("overwrite").option("header", True).option("delimiter", delimiter).csv(path)


def _array_root_field(df: DataFrame, array_field: str | None) -> str | None:
    if array_field is not None:
        if array_field not in df.columns:
            raise ValueError(f"envelope has no root key {array_field!r}; keys: {df.columns}")
        return array_field
    arrays = [f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)]
    if not arrays:
        return None  # a bare top-level array: Spark already yields one row per record
    if len(arrays) != 1:
        raise ValueError(
            f"cannot pick the record array: {len(arrays)} array-typed root keys {arrays}; "
            "pass array_field explicitly")
    return arrays[0]


def read_json_envelope(spark: SparkSession, path: str | list[str], array_field: str | None = None,
                       schema: T.StructType | None = None, mode: str = "FAILFAST") -> DataFrame:
    """Read whole-file JSON envelopes and return one flat row per record.

    ``array_field=None`` picks the only array-typed root key (an error when there are
    several); a file that is a bare top-level array is read as its records. Records are
    flattened (``rec.*``); an empty or NULL array yields no rows.
    Each file is one task (whole-file parse); adaptive execution and the writers downstream
    even out what follows. A malformed file (one that was cut off, say) is an error;
    ``mode="PERMISSIVE"`` reads the others and leaves it out.
    """
    reader = spark.read.option("multiLine", True).option("mode", mode)
    if schema is not None:
        reader = reader.schema(schema)
    raw = reader.json(path)
    field = _array_root_field(raw, array_field)
    if field is None:
        return raw
    records = raw.select(F.explode(F.col(f"`{field}`")).alias("rec"))
    return records.select("rec.*") if isinstance(records.schema["rec"].dataType, T.StructType) else records


def write_json_envelope(df: DataFrame, path: str, array_field: str = "value",
                        records_per_file: int = 100_000, compression: str | None = None) -> None:
    """Write ``df`` as JSON envelope files, at most ``records_per_file`` records each.

    Every input partition cuts its rows, by position, into envelopes of its own, so the cap
    holds exactly, the input is evaluated once, nothing is shuffled or sorted, and neither an
    envelope nor a task's memory grows with the table. One envelope is one file; ``compression``
    names its codec (``gzip``, say): an envelope is read whole, so it loses no splits by it.
    """
    def envelopes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            while batch.num_rows:
                rows = batch.slice(0, records_per_file - n)
                held, n, batch = [*held, rows], n + rows.num_rows, batch.slice(rows.num_rows)
                if n == records_per_file:
                    yield envelope(held)
                    held, n = [], 0
        if held:
            yield envelope(held)

    def envelope(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        records = pa.Table.from_batches(held).combine_chunks().to_batches()[0].to_struct_array()
        return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(records)], pa.int32()), records)],
                                          names=[array_field])

    schema = T.StructType([T.StructField(array_field, T.ArrayType(df.schema))])
    # NULL fields are written as ``null`` (not omitted), so a field that is NULL in every
    # record of an envelope still appears in the schema a reader infers. One record to a file
    # keeps each envelope a file of its own.
    writer = df.mapInArrow(envelopes, schema).write.mode("overwrite").option("ignoreNullFields", False).option("maxRecordsPerFile", 1)
    if compression:  # the fastest level: names that come back in every record shrink well at any
        writer = writer.option("compression", compression).option("zlib.compress.level", "BEST_SPEED")
    writer.json(path)
