"""Landing zone -> bronze as an incremental, restartable file stream.

The batch bronze jobs re-read every landing file on each run (full overwrite). When
extracts keep arriving, the same load can run as a Structured Streaming query over the
landing folder with ``trigger(availableNow=True)``: each run picks up only files it has
not committed yet and processes them in bounded micro-batches.

A micro-batch is written by ``foreachBatch`` to folders named after the stream (the id that its
checkpoint keeps) and the batch, always as a full
overwrite of those folders: the records to the table, what could not be read to the quarantine
table, and the counts per file to the report. A batch that died half-way runs again under the
same id with the same files and replaces what it had written, so nothing is loaded twice and
nothing is lost. One damaged file no longer stops the stream: it is listed, the others load.

Supported landing formats: headered CSV (any delimiter) and JSON envelopes (one object per
file with the records in an array). A stream needs its schema up front: pass the landing
schema (for envelopes, the schema of one record).
"""

from __future__ import annotations

import json

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.session import shared_dir

BATCH = "ingest_batch"
_BAD, _FILE, _RECORDS = "_damaged", "_landing_file", "_records"


def _landing_stream(spark: SparkSession, source: str, fmt: str, schema: T.StructType, delimiter: str,
                    array_field: str, max_files: int) -> DataFrame:
    """The landing rows with their file, what is damaged in them, and (envelopes) their records."""
    reader = (spark.readStream.option("maxFilesPerTrigger", max_files).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", _BAD))
    bad = T.StructField(_BAD, T.StringType())
    if fmt == "csv":
        rows = reader.schema(T.StructType([*schema.fields, bad])).option("header", True).option("delimiter", delimiter).csv(source)
        return rows.withColumn(_FILE, F.col("_metadata.file_path"))
    if fmt == "json_envelope":
        envelope = T.StructType([T.StructField(array_field, T.ArrayType(schema)), bad])
        raw = reader.schema(envelope).option("multiLine", True).json(source)
        array = F.col(f"`{array_field}`")
        reason = F.coalesce(F.col(_BAD), F.when(array.isNull(), F.lit(f"no array {array_field}")))
        return raw.select(array.alias(_RECORDS), reason.alias(_BAD), F.col("_metadata.file_path").alias(_FILE))
    raise ValueError("fmt must be 'csv' or 'json_envelope'")


def _split(batch: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(records, damaged, counts per file) of a micro-batch."""
    whole = F.col(_BAD).isNull()
    if _RECORDS in batch.columns:
        records = batch.where(whole).select(F.explode(_RECORDS).alias("rec")).select("rec.*")
        loaded = F.sum(F.when(whole, F.size(_RECORDS)).otherwise(0))
    else:
        records = batch.where(whole).select(*[F.col(f"`{f.name}`") for f in schema])
        loaded = F.count_if(whole)
    damaged = batch.where(~whole).select(F.col(_FILE).alias("file"), F.col(_BAD).alias("content"))
    counts = (batch.groupBy(F.col(_FILE).alias("file"))
              .agg(loaded.cast("long").alias("loaded"), F.count_if(~whole).alias("quarantined")))
    return records, damaged, counts


def quarantine_of(target: str) -> str:
    return f"{target.rstrip('/')}_quarantine"


def report_of(target: str) -> str:
    return f"{target.rstrip('/')}_report"


def ingest_landing(spark: SparkSession, source: str, target: str, schema: T.StructType, fmt: str = "csv",
                   delimiter: str = ",", array_field: str = "value", checkpoint: str | None = None,
                   partition_by: tuple[str, ...] = (), max_files_per_trigger: int = 1000,
                   table_format: str = "parquet") -> str:
    """Load every not-yet-ingested landing file under ``source`` into the table at ``target`` and
    stop when caught up. Returns the checkpoint location (keep it: it is the record of which
    files were loaded).

    Rows (CSV) and files (envelopes) that cannot be read go to ``quarantine_of(target)`` as
    (file, content). ``report_of(target)`` has for every file what was loaded and quarantined.
    Read the three with :func:`read_landed`.
    """
    checkpoint = checkpoint or shared_dir(spark, "stream-checkpoints")
    stream = _landing_stream(spark, source, fmt, schema, delimiter, array_field, max_files_per_trigger)

    def load(batch: DataFrame, batch_id: int) -> None:
        # The stream's own id: a table that a second stream fills as well keeps both apart.
        name = json.loads(spark.read.schema("value string").text(f"{checkpoint.rstrip('/')}/metadata").first()["value"])["id"]
        # Parsed once for the three writes; a lost block is parsed again from the same files.
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            records, damaged, counts = _split(batch, schema)
            for rows, path, parts in ((records, target, partition_by), (damaged, quarantine_of(target), ()), (counts, report_of(target), ())):
                writer = rows.write.format(table_format).mode("overwrite")
                if parts:
                    writer = writer.partitionBy(*parts)
                writer.save(f"{path.rstrip('/')}/{BATCH}={name}.{batch_id}")
        finally:
            batch.unpersist()

    query = (stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:  # pragma: no cover - surfaced to the caller
        raise RuntimeError(str(query.exception()))
    return checkpoint


def read_landed(spark: SparkSession, path: str, schema: T.StructType | None = None, table_format: str = "parquet",
                with_batch: bool = False) -> DataFrame:
    """A table that :func:`ingest_landing` fills. ``schema`` (of the table, if it is known) avoids
    inferring it; ``with_batch`` keeps the column that names the micro-batch."""
    reader = spark.read.format(table_format)
    if schema is not None:
        reader = reader.schema(T.StructType([*schema.fields, T.StructField(BATCH, T.StringType())]))
    df = reader.load(path)
    return df if with_batch else df.drop(BATCH)
