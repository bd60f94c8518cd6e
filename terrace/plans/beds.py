"""Hospital beds: JSON envelope (``hospitais_leitos``) -> 21 renames, 14 tolerant casts,
management-type recode -> star with location, management, legal-nature and unit-type
dimensions; fact with 14 bed counts partitioned by (regiao, uf)."""

from __future__ import annotations

from pyspark.sql import SparkSession

from terrace.functions import cast_columns, recode, rename, underscores_to_spaces
from terrace.operators import DimRef, build_fact
from terrace.plans.common import DimSpec, Layout, build_and_store
from terrace.sources import read_json_envelope

AREA = "beds"
SOURCE = "dados_leitos.json"

# Source column names (spelling as published, typos included) and targets.
RENAMES = {
    "codigo_do_tipo_da_unidade": "cd_tipo_uni",
    "descricao_da_natureza_juridica_do_hosptial": "desc_juri_hosp",
    "descricao_do_tipo_da_unidade": "desc_tipo_uni",
    "nome_da_regiao_do_brasil_onde_fica_o_hospital": "regiao",
    "nome_do_municipio_onde_fica_o_hospital": "municipio",
    "quantidade_de_leitos_de_uti_adulto_do_hosptial": "qnt_uti_adulto",
    "quantidade_de_leitos_de_uti_coronariana_do_hosptial": "qnt_uti_coronariana",
    "quantidade_de_leitos_de_uti_do_hosptial": "qnt_leitos_uti",
    "quantidade_de_leitos_de_uti_neonatal_do_hosptial": "qnt_uti_neonatal",
    "quantidade_de_leitos_de_uti_pediatrico_do_hosptial": "qnt_uti_pediatrico",
    "quantidade_de_leitos_de_uti_queimado_do_hosptial": "qnt_uti_queimado",
    "quantidade_de_leitos_de_uti_sus_adulto_do_hosptial": "qnt_uti_sus_adulto",
    "quantidade_de_leitos_de_uti_sus_coronariana_do_hosptial": "qnt_uti_sus_coronariana",
    "quantidade_de_leitos_de_uti_sus_do_hosptial": "qnt_uti_sus",
    "quantidade_de_leitos_de_uti_sus_neonatal_do_hosptial": "qnt_uti_sus_neonatal",
    "quantidade_de_leitos_de_uti_sus_pediatrico_do_hosptial": "qnt_uti_sus_pediatrico",
    "quantidade_de_leitos_de_uti_sus_queimado_do_hosptial": "qnt_uti_sus_queimado",
    "quantidade_total_de_leitos_do_hosptial": "qnt_total_leitos",
    "quantidade_total_de_leitos_sus_do_hosptial": "qnt_total_leitos_sus",
    "tipo_da_gestao_do_hospital": "tipo_gestao",
    "unidade_da_federacao_onde_fica_o_hospital": "uf",
}
# The bed counts and the columns that the source jobs drop.
COUNTS = ["qnt_uti_adulto", "qnt_uti_coronariana", "qnt_leitos_uti", "qnt_uti_neonatal", "qnt_uti_pediatrico",
          "qnt_uti_queimado", "qnt_uti_sus_adulto", "qnt_uti_sus_coronariana", "qnt_uti_sus",
          "qnt_uti_sus_neonatal", "qnt_uti_sus_pediatrico", "qnt_uti_sus_queimado", "qnt_total_leitos",
          "qnt_total_leitos_sus"]
# Management-type labels and the default for anything else (NULL included).
MANAGEMENT_TYPES = {"M": "Municipal", "E": "Estadual", "D": "Dupla", "S": "Sem Gestão"}
MANAGEMENT_DEFAULT = "Não informado"
BRONZE_DROP = ["motivo_da_desabilitacao_do_hospital,_caso_esteja_desabilitado"]
SILVER_DROP = ["codigo_ibge_do_municipio", "complemento_do_endereco_do_hospital", "enderco_do_hospital",
               "natureza_juridica_do_hospital", "nome_da_razao_social_do_hospital",
               "nome_do_bairro_do_endereco_do_hosptial", "nome_do_hospital", "numero_do_cep_do_hospital",
               "numero_do_endereco_do_hospital"]

DIMS = {
    "localizacao": DimSpec("dim_localizacao", ("regiao", "municipio", "uf"), "sk_localizacao"),
    "gestao": DimSpec("dim_gestao", ("tipo_gestao", "desc_tipo_gestao"), "sk_gestao"),
    "natureza": DimSpec("dim_natureza_juridica", ("desc_juri_hosp",), "sk_natureza_juridica"),
    "tipo_unidade": DimSpec("dim_tipo_unidade", ("cd_tipo_uni", "desc_tipo_uni"), "sk_tipo_unidade"),
}


def bronze(spark: SparkSession, layout: Layout) -> None:
    records = read_json_envelope(spark, layout.src(SOURCE), array_field="hospitais_leitos")
    layout.write(records.drop(*BRONZE_DROP), "bronze", AREA)


def silver(spark: SparkSession, layout: Layout) -> None:
    df = rename(layout.read(spark, "bronze", AREA), RENAMES)
    df = cast_columns(df, {c: "int" for c in COUNTS})
    df = df.withColumns({
        "desc_juri_hosp": underscores_to_spaces("desc_juri_hosp"),
        "desc_tipo_gestao": recode("tipo_gestao", MANAGEMENT_TYPES, MANAGEMENT_DEFAULT),
    }).drop(*SILVER_DROP)
    layout.write(df, "silver", AREA, partition_by=["regiao", "uf"])


def gold(spark: SparkSession, layout: Layout) -> None:
    s = layout.read(spark, "silver", AREA, {"regiao": "string", "uf": "string"})
    d = build_and_store(layout, s, DIMS)
    fact = build_fact(s, [DimRef(d["localizacao"]), DimRef(d["gestao"]), DimRef(d["natureza"]),
                          DimRef(d["tipo_unidade"])],
                      measures=COUNTS, degenerate=["regiao", "uf"])
    layout.write(fact, "gold", "fato_leitos", partition_by=["regiao", "uf"])


def run(spark: SparkSession, layout: Layout) -> None:
    bronze(spark, layout)
    silver(spark, layout)
    gold(spark, layout)
