"""Deaths: headered CSV -> rows with a non-numeric age removed, casts, 18 renames ->
star with six dimensions; fact with a death counter partitioned by month."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.functions import cast_columns, rename
from terrace.operators import DimRef, build_fact, keep_matching, profile_filter
from terrace.plans.common import FACT_MAX_RECORDS, DimSpec, Layout, build_and_store
from terrace.sources import read_csv

AREA = "deaths"
SOURCE = "obitos.csv"
AGE_PATTERN = r"^\d+$"

# Bronze names and casts.
BRONZE_RENAMES = {"i_faixa_etaria": "faixa_etaria", "i_mes_obito": "mes_obito"}
BRONZE_CASTS = {"i_ano_obito": "int", "i_idade_anos": "int", "mes_obito": "int"}
# Source -> silver names. The last two name columns bronze already renamed
# (one with a typo); they are no-ops, kept as published.
SILVER_RENAMES = {
    "i_ano_obito": "ano_obito", "i_cid_capitulo": "cid_capitulo", "i_cid_obito": "cid_obito",
    "i_desc_emprego": "obito_emprego", "i_desc_cid_obito": "desc_cid_obito", "i_desc_local_obito": "local_obito",
    "i_desc_raca_cor": "cor_obito", "i_desc_radf_res": "reg_adm_moradia",
    "i_desc_regiao_saude_estab": "reg_atendimento", "i_desc_regiao_saude_res": "reg_moradia",
    "i_desc_sigla_estab_cnes": "sigla_estab_atend", "i_desc_tipo_obito": "tipo_obito",
    "i_desc_tipo_violencia": "tipo_violencia", "i_desc_uf_res": "uf_moradia", "i_idade_anos": "idade_obito",
    "i_sexo": "sexo_obito", "i_faixa_etaira": "faixa_etaria", "i_mes_obito": "mes_obito",
}

DIMS = {
    "tempo": DimSpec("dim_tempo", ("ano_obito", "mes_obito"), "sk_tempo"),
    "moradia": DimSpec("dim_local_moradia", ("uf_moradia", "reg_moradia", "reg_adm_moradia"), "sk_local_moradia"),
    "atendimento": DimSpec("dim_local_atendimento", ("reg_atendimento", "sigla_estab_atend"),
                           "sk_local_atendimento"),
    "pessoa": DimSpec("dim_pessoa", ("faixa_etaria", "idade_obito", "sexo_obito", "cor_obito"), "sk_pessoa"),
    "causa": DimSpec("dim_causa", ("cid_obito", "desc_cid_obito", "cid_capitulo"), "sk_causa"),
    "tipo": DimSpec("dim_tipo_obito", ("tipo_obito", "tipo_violencia"), "sk_tipo_obito"),
}


def age_profile(raw: DataFrame) -> DataFrame:
    """Evidence for the cleansing filter: each age value, its rows, and how many survive."""
    age = F.col("i_idade_anos")
    return profile_filter(raw, "i_idade_anos", age.isNotNull() & age.cast("string").rlike(AGE_PATTERN))


def bronze(spark: SparkSession, layout: Layout) -> None:
    raw = read_csv(spark, layout.src(SOURCE))
    layout.write(age_profile(raw), "bronze", f"{AREA}_age_profile")
    df = keep_matching(raw, "i_idade_anos", AGE_PATTERN)
    df = cast_columns(rename(df, BRONZE_RENAMES), BRONZE_CASTS)
    layout.write(df, "bronze", AREA, partition_by=["mes_obito"])


def silver(spark: SparkSession, layout: Layout) -> None:
    df = rename(layout.read(spark, "bronze", AREA, {"mes_obito": "int"}), SILVER_RENAMES)
    layout.write(df, "silver", AREA, partition_by=["mes_obito", "uf_moradia"])


def gold(spark: SparkSession, layout: Layout) -> None:
    s = layout.read(spark, "silver", AREA, {"mes_obito": "int", "uf_moradia": "string"})
    d = build_and_store(layout, s, DIMS)
    fact = build_fact(s, [DimRef(d[k]) for k in DIMS], degenerate=["mes_obito"],
                      constants={"quantidade_obitos": 1})
    layout.write(fact, "gold", "fato_obito", partition_by=["mes_obito"], max_records=FACT_MAX_RECORDS)


def run(spark: SparkSession, layout: Layout) -> None:
    bronze(spark, layout)
    silver(spark, layout)
    gold(spark, layout)
