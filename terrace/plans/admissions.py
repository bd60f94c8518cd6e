"""Hospital admissions: headered CSV -> dates parsed, city names normalised, ages cast ->
star with specialty, city, date and sex dimensions; fact partitioned by month."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from terrace.functions import normalize_text, parse_date, try_cast
from terrace.operators import DimRef, build_fact
from terrace.plans.common import FACT_MAX_RECORDS, DimSpec, Layout, build_and_store
from terrace.sources import read_csv

AREA = "admissions"
SOURCE = "internacoes.csv"

DIMS = {
    "especialidade": DimSpec("dim_especialidade", ("especialidade",), "sk_especialidade"),
    "municipio": DimSpec("dim_municipio", ("municipio",), "sk_municipio"),
    "data": DimSpec("dim_data", ("data_internacao",), "sk_data", ("ano", "mes", "dia")),
    "sexo": DimSpec("dim_sx", ("sexo",), "sk_sexo"),
}


def bronze(spark: SparkSession, layout: Layout) -> None:
    layout.write(read_csv(spark, layout.src(SOURCE)), "bronze", AREA)


def silver(spark: SparkSession, layout: Layout) -> None:
    df = layout.read(spark, "bronze", AREA)
    admitted = parse_date("data_internacao", "dd/MM/yyyy HH:mm")
    df = df.withColumn("data_internacao", admitted).withColumns({
        "ano": F.year("data_internacao"),
        "mes": F.month("data_internacao"),
        "dia": F.dayofmonth("data_internacao"),
        "municipio": normalize_text("municipio"),
        "idade": try_cast(F.col("idade").cast("string"), "int"),
    })
    layout.write(df, "silver", AREA, partition_by=["sexo", "mes"])


def gold(spark: SparkSession, layout: Layout) -> None:
    s = layout.read(spark, "silver", AREA, {"sexo": "string", "mes": "int"})
    d = build_and_store(layout, s, DIMS)
    fact = build_fact(
        s,
        [DimRef(d["especialidade"]), DimRef(d["municipio"]), DimRef(d["data"]), DimRef(d["sexo"])],
        measures=["idade"], degenerate=["mes"], constants={"qtd_internacoes": 1})
    layout.write(fact, "gold", "fato_internacoes", partition_by=["mes"], max_records=FACT_MAX_RECORDS)


def run(spark: SparkSession, layout: Layout) -> None:
    bronze(spark, layout)
    silver(spark, layout)
    gold(spark, layout)
