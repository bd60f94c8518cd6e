"""Central-bank currency production: one JSON envelope (``value`` array) -> star with
time, denomination and species dimensions; fact partitioned by year."""

from __future__ import annotations

from pyspark.sql import SparkSession

from terrace.functions import cast_columns, rename
from terrace.operators import DimRef, build_fact
from terrace.plans.common import DimSpec, Layout, build_and_store
from terrace.sources import read_json_envelope

AREA = "currency"
SOURCE = "dados_banco.json"

RENAMES = {"DESC_ano": "ano", "DESC_deno": "denominacao", "DESC_especie": "especie",
           "DESC_quant_produzida": "quant_produzida"}
CASTS = {"ano": "int", "denominacao": "double", "quant_produzida": "int"}

DIMS = {
    "tempo": DimSpec("dim_tempo", ("ano",), "sk_tempo"),
    "denominacao": DimSpec("dim_denominacao", ("denominacao",), "sk_denominacao"),
    "especie": DimSpec("dim_especie", ("especie",), "sk_especie"),
}


def bronze(spark: SparkSession, layout: Layout) -> None:
    records = read_json_envelope(spark, layout.src(SOURCE), array_field="value")
    layout.write(records, "bronze", AREA)


def silver(spark: SparkSession, layout: Layout) -> None:
    df = cast_columns(rename(layout.read(spark, "bronze", AREA), RENAMES), CASTS)
    layout.write(df, "silver", AREA, partition_by=["ano"])


def gold(spark: SparkSession, layout: Layout) -> None:
    s = layout.read(spark, "silver", AREA, {"ano": "int"})
    dims = build_and_store(layout, s, DIMS)
    fact = build_fact(s, [DimRef(dims[k]) for k in DIMS], measures=["quant_produzida"], degenerate=["ano"])
    layout.write(fact, "gold", "fato", partition_by=["ano"])


def run(spark: SparkSession, layout: Layout) -> None:
    bronze(spark, layout)
    silver(spark, layout)
    gold(spark, layout)
