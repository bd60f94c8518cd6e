"""Helpers shared by the training-data operators: lineage cuts, identities, components."""

from __future__ import annotations

import os
import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.session import shared_dir

# Fixed value: the ASCII white space that separates words (space, tab to carriage return).
WORD = r"[^\x20\x09-\x0D]+"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: a lineage cut that
    survives the loss of any executor, and gives Catalyst the true size of the table."""
    path = shared_dir(df.sparkSession, f"llm-{name}") + "/table"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


BROADCAST_BYTES = 16 * 1024 * 1024


def broadcast_if_small(table: DataFrame) -> DataFrame:
    """``table`` (a materialized one of fixed-width columns), marked for broadcast if its rows
    take at most ``BROADCAST_BYTES``; beyond that Spark shuffles both sides of the join, with
    the same result."""
    wide = table.count() * 8 * (len(table.columns) + 1)
    return F.broadcast(table) if wide <= BROADCAST_BYTES else table


def free_name(taken: Iterable[str], base: str) -> str:
    """``base``, with underscores appended until no name in ``taken`` equals it in any case."""
    used = {c.lower() for c in taken}
    while base.lower() in used:
        base += "_"
    return base


def word_count(text: Column) -> Column:
    """Words of the whole text, separated by ASCII white space (NULL: 0), as long."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def document_key(doc_id: Column, text: Column) -> tuple[Column, Column]:
    """A 128-bit identity of a stored document: its id and whole text. Rows that repeat
    both are the same document."""
    empty = F.coalesce(text, F.lit(""))
    null = text.isNull()
    return (F.xxhash64(doc_id, empty, null), F.xxhash64(F.lit("second"), empty, doc_id, null))


def rows_per_group(df: DataFrame, rows: int) -> int:
    """How many hash groups keep about ``rows`` rows of ``df`` each (at least 1)."""
    return max(1, -(-df.count() // rows))


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v); root is the component's smallest node.

    Alternating large-star and small-star contraction: each round joins every node to the
    smallest neighbour it knows, so a star is final after one round and a path halves.
    Every round is written to the shared folder; the driver sees one row a round at most. Nodes are longs (or anything ordered); self links are allowed.
    """
    links = materialize(edges.select("u", "v").where(F.col("u") != F.col("v")).distinct(), "links")
    for _ in range(max_rounds):
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        # Every link now points from a larger to a smaller node.
        small = large.join(large.groupBy("u").agg(F.min("v").alias("m")), "u")
        links = materialize(
            small.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(small.select("u", F.col("m").alias("v"))).distinct(), "links")
        # Done when every node has one link at most and none that is pointed at has any.
        ends = links.select(F.col("u").alias("x"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
            links.select(F.col("v").alias("x"), F.lit(0).alias("out"), F.lit(1).alias("into")))
        unsettled = ends.groupBy("x").agg(F.sum("out").alias("out"), F.max("into").alias("into")).where("out + into > 1")
        if not unsettled.where("out > 0").take(1):
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    member = links.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
    roots = member.select(F.col("root").alias("node"), "root").distinct()
    return member.unionByName(roots)


_SHIPPED: set[str] = set()


def python_workers(spark: SparkSession, rows: int | None = None) -> None:
    """Make this package importable in Python workers, and bound a batch of long rows.

    On a cluster the package is on the workers' path as any dependency is (``--py-files`` or
    an installed wheel). A local session started from elsewhere gets the folder itself.
    ``rows`` lowers the rows of an Arrow batch, as a worker holds one batch at a time.
    """
    context = spark.sparkContext
    if re.match(r"local($|\[)", context.master) and context.applicationId not in _SHIPPED:
        context.addFile(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), recursive=True)
        _SHIPPED.add(context.applicationId)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if rows and not 0 < int(spark.conf.get(key, "10000")) <= rows:
        spark.conf.set(key, str(rows))
