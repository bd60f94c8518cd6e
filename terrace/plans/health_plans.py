"""Health plans: three ``;`` CSV extracts (pricing, plan features, operator register) ->
decimal-comma repair, age-band labels, recodes, de-duplication, date parsing -> star with
age band, time, operator, plan (snowflaked to operator) and technical-note dimensions;
fact with six pricing measures partitioned by (ano, mes)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.functions import (
    cast_columns, lower_columns, parse_date, parse_decimal_comma, recode, recode_numeric_text, rename,
)
from terrace.operators import DimRef, build_fact, dedupe
from terrace.operators.star import enrich, left_lookup_first, store_dimension, build_dimension
from terrace.plans.common import FACT_MAX_RECORDS, DimSpec, Layout, build_and_store, concurrently
from terrace.sources import read_csv

AREA = "health_plans"
SOURCES = {"precificacao": "saude_precificacao.csv", "caracteristicas": "caracteristicas_plano.csv",
           "operadora": "registro_operadoras.csv"}

MEASURES = ["vcm", "pct_desp_ass", "pct_carreg", "pct_carreg_admin", "pct_carreg_coml", "pct_carreg_lucro"]
# Age-band labels per code (unknown codes get NULL) and maternity-cover labels.
AGE_BANDS = {1: "0-18", 2: "19-23", 3: "24-28", 4: "29-33", 5: "34-38",
             6: "39-43", 7: "44-48", 8: "49-53", 9: "54-58", 10: "59+"}
OBSTETRICS = {"COM OBSTETRICIA": "COM", "SEM OBSTETRICIA": "SEM", "NAO SE APLICA": "NAO_APLICA",
              "NAO IDENTIFICADO": "NAO_IDENTIFICADO"}
OBSTETRICS_DEFAULT = "OUTROS"
OPERATOR_RENAMES = {"reg ans": "reg_ans", "Operadora Medico-Hospitalar": "op_medico_hospitalar"}
OPERATOR_DATES = ["data_da_primeira_acreditacao", "inicio_validade", "fim_validade"]

PRICING_DIMS = {
    "faixa": DimSpec("dim_faixa", ("cd_faixa_etaria",), "sk_faixa_etaria", ("faixa_etaria_desc",)),
    "tempo": DimSpec("dim_tempo", ("ano_mes",), "sk_tempo", ("ano", "mes")),
    "nota": DimSpec("dim_nota", ("cd_nota",), "sk_nota"),
}

PLAN_COLUMNS = ["id_plano", "nm_plano", "cd_plano", "obstetricia", "cobertura", "tipo_financiamento",
                "registro_operadora", "situacao_plano", "nt_tipo", "sk_operadora"]


def _month_start(c: str):
    """``ANO_MES`` as a DATE whatever CSV inference made of it (date, timestamp or text)."""
    col = F.col(c)
    return F.coalesce(F.try_to_date(col.cast("string"), "yyyy-MM-dd"),
                      F.try_to_date(col.cast("string"), "yyyy-MM"),
                      F.try_to_date(col.cast("string"), "yyyyMM"))


def bronze(spark: SparkSession, layout: Layout) -> None:
    def pricing() -> None:
        df = read_csv(spark, layout.src(SOURCES["precificacao"]), delimiter=";")
        month = _month_start("ANO_MES")
        df = df.withColumns({"ano": F.year(month), "mes": F.month(month)})
        layout.write(df, "bronze", f"{AREA}/precificacao", partition_by=["ano", "mes"])

    def features() -> None:
        layout.write(read_csv(spark, layout.src(SOURCES["caracteristicas"]), delimiter=";"),
                     "bronze", f"{AREA}/caracteristicas")

    def operators() -> None:
        df = rename(read_csv(spark, layout.src(SOURCES["operadora"]), delimiter=";"), OPERATOR_RENAMES)
        layout.write(df, "bronze", f"{AREA}/operadora")

    concurrently([pricing, features, operators])


def clean_pricing(df: DataFrame) -> DataFrame:
    df = lower_columns(df)
    df = df.withColumns({m: parse_decimal_comma(m) for m in MEASURES if m in df.columns})
    band = df.schema["cd_faixa_etaria"].dataType
    label = (recode("cd_faixa_etaria", AGE_BANDS) if isinstance(band, T.IntegralType)
             else recode_numeric_text("cd_faixa_etaria", AGE_BANDS))
    return df.withColumn("faixa_etaria_desc", label)


def clean_features(df: DataFrame) -> DataFrame:
    # A code that is no number matches no operator; it must not stop the job.
    df = cast_columns(lower_columns(df), {"registro_operadora": "int"})
    df = df.withColumns({
        "lg_odontologico": F.col("lg_odontologico").cast("string").try_cast("boolean"),
        "obstetricia": recode("obstetricia", OBSTETRICS, OBSTETRICS_DEFAULT),
    })
    return dedupe(df, ["id_plano"])


def clean_operators(df: DataFrame) -> DataFrame:
    df = cast_columns(lower_columns(df), {"reg_ans": "int", "prazo_validade": "int"})
    return df.withColumns({c: parse_date(c, "dd/MM/yyyy") for c in OPERATOR_DATES})


def silver(spark: SparkSession, layout: Layout) -> None:
    concurrently([
        lambda: layout.write(clean_pricing(layout.read(spark, "bronze", f"{AREA}/precificacao")),
                             "silver", f"{AREA}/precificacao", partition_by=["ano", "mes"]),
        lambda: layout.write(clean_features(layout.read(spark, "bronze", f"{AREA}/caracteristicas")),
                             "silver", f"{AREA}/caracteristicas"),
        lambda: layout.write(clean_operators(layout.read(spark, "bronze", f"{AREA}/operadora")),
                             "silver", f"{AREA}/operadora"),
    ])


def plan_types_of(pricing: DataFrame) -> DataFrame:
    """One type per plan, NULL first: the one that the plan's row keeps. The pairs are told apart by
    a hash aggregate; a minimum of text alone would sort all of pricing, map-side as well. (The
    optimizer drops a plain distinct below a minimum, so the pairs are counted.)"""
    pairs = pricing.groupBy("id_plano", "nt_tipo").agg(F.count(F.lit(1)).alias("_n")).where("_n > 0")
    return (pairs.groupBy("id_plano").agg(F.min(F.struct("nt_tipo")).alias("t")).select("id_plano", "t.nt_tipo"))


def gold(spark: SparkSession, layout: Layout) -> None:
    pricing = layout.read(spark, "silver", f"{AREA}/precificacao", {"ano": "int", "mes": "int"})
    features = layout.read(spark, "silver", f"{AREA}/caracteristicas")
    operators = layout.read(spark, "silver", f"{AREA}/operadora")

    def operator_dim():
        # Operator: every registered operator, with the first known company name from the plans.
        members = left_lookup_first(operators.select("reg_ans"), "reg_ans", features, "registro_operadora",
                                    "razao_social")
        return store_dimension(build_dimension(members, ["reg_ans"], "sk_operadora", ["razao_social"],
                                               members_unique=True),
                               layout.path("gold", "dim_operadora"), layout.fmt)

    d, operadora = concurrently([lambda: build_and_store(layout, pricing, PRICING_DIMS), operator_dim])
    faixa, tempo, nota = d["faixa"], d["tempo"], d["nota"]

    # Plan: features enriched with the technical-note type and the operator key (snowflake).
    plan_types = plan_types_of(pricing)
    plans = enrich(features, plan_types, "id_plano", dedupe_other=False, other_unique=True)
    op_keys = operadora.df.select(F.col("reg_ans").alias("_reg"), "sk_operadora")
    plans = plans.join(op_keys, F.col("registro_operadora") == F.col("_reg"), "left").select(*PLAN_COLUMNS)
    plan_members = dedupe(plans, ["id_plano"], late_rows=False)
    plano = store_dimension(build_dimension(plan_members, ["id_plano"], "sk_plano",
                                            [c for c in PLAN_COLUMNS if c != "id_plano"], members_unique=True),
                            layout.path("gold", "dim_plano"), layout.fmt)

    fact = build_fact(pricing,
                      [DimRef(plano, carry=["sk_operadora"]), DimRef(nota), DimRef(faixa), DimRef(tempo)],
                      measures=MEASURES, degenerate=["mes", "ano"])
    layout.write(fact, "gold", "fato_planos", partition_by=["ano", "mes"], max_records=FACT_MAX_RECORDS)


def run(spark: SparkSession, layout: Layout) -> None:
    bronze(spark, layout)
    silver(spark, layout)
    gold(spark, layout)
