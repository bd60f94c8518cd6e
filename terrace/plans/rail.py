"""Rail accidents: three overlapping JSON extracts -> per-extract silver tables ->
consolidated silver (union, fill, de-duplication) -> star with time, location, accident,
railway and transport dimensions; fact partitioned by (ano, mes).

Time look-up: the time dimension's natural key is (data_ocorrencia, data_hora_ocorrencia,
ano, mes). By default the fact matches the full key, NULL-safe on the timestamp (an
accident with unknown hour keeps its row). ``time_lookup="date"`` reproduces the
date-only match of the source job, where each accident joins every distinct time of its
day and the counters inflate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.functions import cast_columns, combine_date_time, lower_columns, parse_date, rename
from terrace.operators import DimRef, build_fact, consolidate, fill_nulls
from terrace.plans.common import DimSpec, Layout, build_and_store, concurrently
from terrace.sources import LoadSpec, load_many, read_json_envelope

AREA = "rail"
# The three published extracts (two overlap in 2020-2025).
SOURCES = ["acidentes_2004-2020.json", "acidentes_2020-2025.json", "acidentes_2020-2026.json"]
PARTITIONS = {"ano": "int", "mes": "int"}

# Published column names, their targets, the consolidation key and fillers.
BRONZE_RENAMES = {"Perímetro_Urbano": "perimetro_urbano", "Perímetro Urbano": "perimetro_urbano"}
SILVER_RENAMES = {"estação_anterior": "estacao_anterior", "estação_posterior": "estacao_posterior",
                  "interrupção": "interrupcao", "quilômetro_inicial": "quilometro_inicial",
                  "serviço_transporte": "servico_transporte"}
# Columns only the newer extracts carry (spelling as published).
NEWER_ONLY = ["quilômetro_final", "causa_contibutiva", "n_trem", "double_stack", "prejuízo_financeiro"]
DEDUPE_KEY = ["data_hora_ocorrencia", "linha", "municipio", "concessionaria", "natureza"]
NOT_INFORMED = "nao_informada"
GOLD_FILL = {"estacao_anterior": NOT_INFORMED, "estacao_posterior": NOT_INFORMED,
             "outra_ferrovia": NOT_INFORMED, "pn": NOT_INFORMED}

DIMS = {
    "tempo": DimSpec("dim_tempo", ("data_ocorrencia", "data_hora_ocorrencia", "ano", "mes"), "sk_tempo",
                     derived={"hora": "hour(data_hora_ocorrencia)"}),
    "localizacao": DimSpec("dim_localizacao", ("uf", "municipio", "perimetro_urbano"), "sk_localizacao"),
    "acidente": DimSpec("dim_acidente", ("gravidade", "natureza", "causa_direta", "interrupcao"), "sk_acidente"),
    "ferrovia": DimSpec("dim_ferrovia", ("concessionaria", "linha", "estacao_anterior", "estacao_posterior",
                                         "outra_ferrovia", "pn"), "sk_ferrovia"),
    "transporte": DimSpec("dim_transporte", ("servico_transporte", "mercadoria", "equipagem", "prefixo"),
                          "sk_transporte"),
}


def _stem(name: str) -> str:
    return name[: -len(".json")] if name.endswith(".json") else name


def bronze(spark: SparkSession, layout: Layout) -> None:
    specs = [LoadSpec(layout.src(name)) for name in SOURCES]
    def load(s: SparkSession, spec: LoadSpec) -> DataFrame:
        records = read_json_envelope(s, spec.source)
        return rename(records, BRONZE_RENAMES)

    def one(spec: LoadSpec) -> None:
        # Reading an extract infers its types, a pass of its own: extracts take it side by side.
        for n, df in load_many(spark, [spec], load).items():
            layout.write(df, "bronze", f"{AREA}/{n}")

    concurrently([lambda spec=spec: one(spec) for spec in specs])


def clean_extract(df: DataFrame) -> DataFrame:
    df = rename(lower_columns(df), SILVER_RENAMES)
    df = df.withColumn("data_ocorrencia", parse_date("data_ocorrencia", "dd/MM/yyyy"))
    df = df.withColumns({
        "data_hora_ocorrencia": combine_date_time("data_ocorrencia", "hora_ocorrencia"),
        "ano": F.year("data_ocorrencia"),
        "mes": F.month("data_ocorrencia"),
    })
    return cast_columns(df, {"n_feridos": "int", "n_obitos": "int"}).drop(*NEWER_ONLY)


def silver(spark: SparkSession, layout: Layout) -> None:
    def one(name: str) -> None:
        df = clean_extract(layout.read(spark, "bronze", f"{AREA}/{_stem(name)}"))
        layout.write(df, "silver", f"{AREA}/{_stem(name)}", partition_by=["ano", "mes"])

    concurrently([lambda n=n: one(n) for n in SOURCES])


def consolidated(spark: SparkSession, layout: Layout) -> None:
    parts = [layout.read(spark, "silver", f"{AREA}/{_stem(n)}", PARTITIONS) for n in SOURCES]
    merged = consolidate(parts, keys=DEDUPE_KEY, fill={"linha": NOT_INFORMED})
    layout.write(merged, "silver", f"{AREA}/acidentes_consolidado", partition_by=["ano", "mes"])


def gold(spark: SparkSession, layout: Layout, time_lookup: str = "full") -> None:
    s = fill_nulls(layout.read(spark, "silver", f"{AREA}/acidentes_consolidado", PARTITIONS), GOLD_FILL)
    d = build_and_store(layout, s, DIMS)
    if time_lookup == "full":
        tempo = DimRef(d["tempo"], null_policy={"data_hora_ocorrencia": "match"})
    elif time_lookup == "date":
        tempo = DimRef(d["tempo"], on=["data_ocorrencia", "ano", "mes"], allow_fanout=True)
    else:
        raise ValueError("time_lookup must be 'full' or 'date'")
    fact = build_fact(s, [tempo, DimRef(d["localizacao"]), DimRef(d["acidente"]), DimRef(d["ferrovia"]),
                          DimRef(d["transporte"])],
                      measures=["n_feridos", "n_obitos"], constants={"quantidade_acidentes": 1},
                      degenerate=["ano", "mes"])
    fact = fact.select(*[c for c in fact.columns if c not in ("ano", "mes")], "ano", "mes")
    layout.write(fact, "gold", "fato_acidentes_ferroviarios", partition_by=["ano", "mes"])


def run(spark: SparkSession, layout: Layout, time_lookup: str = "full") -> None:
    bronze(spark, layout)
    silver(spark, layout)
    consolidated(spark, layout)
    gold(spark, layout, time_lookup)
