"""Whole subject-area jobs as registered queries.

Each query derives a landing extract from the full driver tables (so the work grows with
them), runs the area's bronze -> silver -> gold jobs unchanged, and returns the stored
gold fact. Dirty values (non-integer quantities, dates without a time, ages such as
``<3``, NULL dimension parts) are derived from column values, never from row subsets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.plans import Layout, admissions, currency, deaths
from terrace.session import shared_dir
from terrace.sources import read_table, write_csv, write_json_envelope


# Records per landing envelope: an API-page-sized file, so envelopes parse in parallel.
ENVELOPE_RECORDS = 100_000
# An envelope repeats its field names in every record and is read whole, so nothing is lost by it. Envelopes
# are unpacked twice (types, then records): a codec that packs a little less costs far less time.
ENVELOPE_CODEC = "lz4"


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return read_table(spark, f"{d}/{name}.parquet")


def _layout(spark: SparkSession, area: str) -> Layout:
    base = shared_dir(spark, f"area-{area}")
    return Layout(f"{base}/landing", f"{base}/lake")


def currency_gold_fact(spark, d):
    """Currency job over envelopes built from lineitem: year, discount as denomination,
    return flag as species, quantity (text ending in .5 for open lines -> NULL)."""
    li = _t(spark, d, "lineitem")
    qty = F.round("l_quantity").cast("int").cast("string")
    records = li.select(
        F.year("l_shipdate").cast("string").alias("DESC_ano"),
        F.col("l_discount").cast("string").alias("DESC_deno"),
        F.col("l_returnflag").alias("DESC_especie"),
        F.when(F.col("l_linestatus") == "O", F.concat(qty, F.lit(".5"))).otherwise(qty).alias("DESC_quant_produzida"))
    lay = _layout(spark, "currency")
    write_json_envelope(records, lay.src(currency.SOURCE), array_field="value", records_per_file=ENVELOPE_RECORDS,
                        compression=ENVELOPE_CODEC)
    currency.run(spark, lay)
    return lay.read(spark, "gold", "fato")


def admissions_gold_fact(spark, d):
    """Admissions job over a CSV built from orders, their customers and nations."""
    o = _t(spark, d, "orders")
    cust = _t(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    nation = _t(spark, d, "nation").select("n_nationkey", "n_name")
    src = o.join(cust, o.o_custkey == cust.c_custkey).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    no_time = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "5-LOW")
    age = (F.col("o_custkey") % 90).cast("string")
    landing = src.select(
        F.when(no_time, F.date_format("o_orderdate", "dd/MM/yyyy"))
         .otherwise(F.date_format("o_orderdate", "dd/MM/yyyy HH:mm")).alias("data_internacao"),
        F.initcap("n_name").alias("municipio"),
        F.col("c_mktsegment").alias("sexo"),
        F.when(F.col("o_orderstatus") == "P", F.concat(age, F.lit("a"))).otherwise(age).alias("idade"),
        F.col("o_orderpriority").alias("especialidade"))
    lay = _layout(spark, "admissions")
    write_csv(landing, lay.src(admissions.SOURCE))
    admissions.run(spark, lay)
    return lay.read(spark, "gold", "fato_internacoes")


def deaths_gold_fact(spark, d):
    """Deaths job over a CSV built from events: ages '<k' and NULL are filtered in bronze,
    a NULL violence type drops the row from the fact."""
    e = _t(spark, d, "events")
    k = F.regexp_extract("props", r'"k": (\d+)', 1)
    u = F.col("user_id")
    tag = lambda prefix, m: F.concat(F.lit(prefix), (u % m).cast("string"))
    landing = e.select(
        F.year("ts").cast("string").alias("i_ano_obito"),
        F.month("ts").cast("string").alias("i_mes_obito"),
        F.when(F.col("event_type") == "error", F.lit(None).cast("string"))
         .when(F.col("event_type") == "signup", F.concat(F.lit("<"), k)).otherwise(k).alias("i_idade_anos"),
        F.col("event_type").alias("i_faixa_etaria"),
        tag("CAP", 3).alias("i_cid_capitulo"),
        tag("I", 13).alias("i_cid_obito"),
        tag("causa ", 13).alias("i_desc_cid_obito"),
        tag("emprego ", 2).alias("i_desc_emprego"),
        tag("local ", 3).alias("i_desc_local_obito"),
        tag("cor ", 5).alias("i_desc_raca_cor"),
        tag("S", 2).alias("i_sexo"),
        tag("UF", 4).alias("i_desc_uf_res"),
        tag("REG", 6).alias("i_desc_regiao_saude_res"),
        tag("RA", 8).alias("i_desc_radf_res"),
        tag("REGE", 6).alias("i_desc_regiao_saude_estab"),
        tag("EST", 11).alias("i_desc_sigla_estab_cnes"),
        tag("TIPO", 2).alias("i_desc_tipo_obito"),
        F.when(F.col("event_type") != "view", tag("VIOL", 3)).alias("i_desc_tipo_violencia"))
    lay = _layout(spark, "deaths")
    write_csv(landing, lay.src(deaths.SOURCE))
    deaths.run(spark, lay)
    return lay.read(spark, "gold", "fato_obito")


AREA_QUERIES = {
    "currency_gold_fact": currency_gold_fact,
    "admissions_gold_fact": admissions_gold_fact,
    "deaths_gold_fact": deaths_gold_fact,
}


def _rail_record(o: DataFrame, newer: bool, revision: int | None = None) -> DataFrame:
    """Accident records of orders. With a ``revision`` (one per extract) places and times are shared
    by many orders, and extracts tell the same accident differently."""
    k, c, st, pr = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus"), F.col("o_orderpriority")
    lbl = lambda prefix, col, m: F.concat(F.lit(prefix), (col % m).cast("string"))
    shared, r = revision is not None, revision or 0
    impossible = (st == "P") & (pr == "1-URGENT")
    fields = {
        "data_ocorrencia": F.when(impossible, F.concat(F.lit("31/02/"), F.year("o_orderdate").cast("string")))
                            .otherwise(F.date_format("o_orderdate", "dd/MM/yyyy")),
        "hora_ocorrencia": F.when(pr != "3-MEDIUM", F.concat(F.lpad((k % (3 if shared else 24)).cast("string"), 2, "0"), F.lit(":"),
                                                             F.lit("00") if shared else F.lpad((c % 60).cast("string"), 2, "0"))),
        "n_feridos": F.when(pr == "5-LOW", F.lit("x")).otherwise(((k + r) % 5).cast("string")),
        "n_obitos": (c % 3).cast("string"),
        "uf": st,
        "municipio": F.concat(F.lit("M"), (k % 50 if shared else k).cast("string")),
        ("Perímetro Urbano" if newer else "Perímetro_Urbano"): F.when(c % 2 == 0, F.lit("S")).otherwise(F.lit("N")),
        "gravidade": pr,
        "natureza": lbl("N", c, 4),
        "causa_direta": lbl("C", k + r, 6),
        "interrupção": F.when(k % 2 == 0, F.lit("S")).otherwise(F.lit("N")),
        "concessionaria": lbl("CONC", c, 5),
        "linha": F.when(~((st == "F") & (pr == "2-HIGH")), lbl("L", k, 9)),
        "outra_ferrovia": F.when(pr == "4-NOT SPECIFIED", F.lit("OF")),
        "pn": F.lit(None).cast("string"),
        "estação_anterior": lbl("E", k, 7),
        "estação_posterior": F.when(st != "O", lbl("E", c, 7)),
        "serviço_transporte": lbl("SERV", c, 3),
        "mercadoria": F.when(~((st == "P") & (pr == "2-HIGH")), lbl("MERC", k, 4)),
        "equipagem": (c % 4).cast("string"),
        "prefixo": lbl("P", k, 10),
        "quilômetro_inicial": (k % 100).cast("string"),
    }
    if newer:
        fields.update({"quilômetro_final": (k % 100 + 1).cast("string"), "causa_contibutiva": lbl("CC", k, 3),
                       "n_trem": (k % 50).cast("string"), "double_stack": F.lit("N"),
                       "prejuízo_financeiro": (c % 1000).cast("string")})
    return o.select(*[v.alias(n) for n, v in fields.items()])


def _rail_fact(spark, d, revised: bool, time_lookup: str) -> DataFrame:
    """Rail job over three JSON extracts of orders (years <= 1997, 1997-1999, >= 1998; two
    spellings of one column; newer-only columns)."""
    o = _t(spark, d, "orders")
    y = F.year("o_orderdate")
    lay = _layout(spark, "rail")
    from terrace.plans import rail
    from terrace.plans.common import concurrently
    slices = {"acidentes_2004-2020.json": (o.filter(y <= 1997), False, "acidentes"),
              "acidentes_2020-2025.json": (o.filter(y.between(1997, 1999)), True, "dados"),
              "acidentes_2020-2026.json": (o.filter((y >= 1998) | y.isNull()), True, "dados")}
    concurrently([lambda k=k, name=name, part=part, newer=newer, root=root: write_json_envelope(
        _rail_record(part, newer, k if revised else None), lay.src(name), array_field=root,
        records_per_file=ENVELOPE_RECORDS, compression=ENVELOPE_CODEC)
        for k, (name, (part, newer, root)) in enumerate(slices.items())])
    rail.run(spark, lay, time_lookup)
    return lay.read(spark, "gold", "fato_acidentes_ferroviarios")


def rail_gold_fact(spark, d):
    """Equal overlaps: the dedupe key is unique per order, so they collapse to one row per order."""
    return _rail_fact(spark, d, False, "full")


def rail_overlaps_gold_fact(spark, d):
    """Overlaps that differ, and places and times shared by many accidents: the consolidation key
    chooses among different rows, and the location dimension has few members."""
    return _rail_fact(spark, d, True, "full")


def rail_by_date_gold_fact(spark, d):
    """The same extracts with the date-only time look-up: each accident joins every distinct time
    of its day."""
    return _rail_fact(spark, d, True, "date")


AREA_QUERIES.update({"rail_gold_fact": rail_gold_fact, "rail_overlaps_gold_fact": rail_overlaps_gold_fact,
                     "rail_by_date_gold_fact": rail_by_date_gold_fact})


def beds_gold_fact(spark, d):
    """Beds job over a JSON envelope built from part: management codes M/E/D/S, an
    unknown code and NULL (dropped from the fact), an empty bed count (-> NULL)."""
    from terrace.plans import beds
    p = _t(spark, d, "part")
    key, size = F.col("p_partkey"), F.col("p_size")
    counts = [src for src in beds.RENAMES if src.startswith("quantidade")]
    gestao = (F.when(size % 6 == 0, F.lit("M")).when(size % 6 == 1, F.lit("E")).when(size % 6 == 2, F.lit("D"))
              .when(size % 6 == 3, F.lit("S")).when(size % 6 == 4, F.lit("Z")))
    fields = {
        "codigo_do_tipo_da_unidade": F.concat(F.lit("T"), (size % 5).cast("string")),
        "descricao_da_natureza_juridica_do_hosptial": F.concat(F.lit("ENTIDADE_"), (key % 3).cast("string")),
        "descricao_do_tipo_da_unidade": F.concat(F.lit("TIPO "), (size % 5).cast("string")),
        "nome_da_regiao_do_brasil_onde_fica_o_hospital": F.concat(F.lit("R"), (key % 5).cast("string")),
        "nome_do_municipio_onde_fica_o_hospital": F.col("p_brand"),
        "tipo_da_gestao_do_hospital": gestao,
        "unidade_da_federacao_onde_fica_o_hospital": F.concat(F.lit("UF"), (key % 7).cast("string")),
        "motivo_da_desabilitacao_do_hospital,_caso_esteja_desabilitado": F.lit(None).cast("string"),
    }
    for i, src in enumerate(counts):
        value = ((key * (i + 1)) % 50).cast("string")
        fields[src] = F.when((i == 0) & (size > 45), F.lit("")).otherwise(value) if i == 0 else value
    for src in beds.SILVER_DROP:
        fields[src] = F.concat(F.lit("x"), (key % 3).cast("string"))
    lay = _layout(spark, "beds")
    write_json_envelope(p.select(*[v.alias(n) for n, v in fields.items()]), lay.src(beds.SOURCE),
                        array_field="hospitais_leitos", records_per_file=ENVELOPE_RECORDS, compression=ENVELOPE_CODEC)
    beds.run(spark, lay)
    return lay.read(spark, "gold", "fato_leitos")


AREA_QUERIES["beds_gold_fact"] = beds_gold_fact


def health_plans_gold_fact(spark, d):
    """Health-plan job over three ';' CSV extracts: pricing from lineitem (decimal-comma
    text, a thousands point making some values NULL, band 11 without a label), plan
    features from part (with a second copy of small plans to de-duplicate, NULL company
    names, unknown maternity labels) and operators from supplier."""
    from terrace.plans import health_plans
    li, part, sup = _t(spark, d, "lineitem"), _t(spark, d, "part"), _t(spark, d, "supplier")
    comma = lambda c: F.replace(F.col(c).cast("string"), F.lit("."), F.lit(","))
    pricing = li.select(
        F.date_format(F.trunc("l_shipdate", "month"), "yyyy-MM-dd").alias("ANO_MES"),
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("ID_PLANO"),
        F.col("l_returnflag").alias("NT_TIPO"),
        F.concat(F.lit("N"), F.col("l_linenumber").cast("string")).alias("CD_NOTA"),
        (F.col("l_suppkey") % 11 + 1).cast("string").alias("CD_FAIXA_ETARIA"),
        F.when(F.col("l_returnflag") == "R", F.concat(F.lit("1."), comma("l_extendedprice")))
         .otherwise(comma("l_extendedprice")).alias("VCM"),
        comma("l_discount").alias("PCT_DESP_ASS"), comma("l_tax").alias("PCT_CARREG"),
        comma("l_quantity").alias("PCT_CARREG_ADMIN"), F.col("l_linenumber").cast("string").alias("PCT_CARREG_COML"),
        comma("l_tax").alias("PCT_CARREG_LUCRO"))
    key, size = F.col("p_partkey"), F.col("p_size")
    reg = (key % 120 + 1).cast("string")
    # Some operator codes are no numbers: they match no operator and must not stop the job.
    reg_text = F.when(size % 13 == 0, F.concat(reg, F.lit("x"))).otherwise(reg)
    maternity = (F.when(size % 5 == 0, F.lit("COM OBSTETRICIA")).when(size % 5 == 1, F.lit("SEM OBSTETRICIA"))
                 .when(size % 5 == 2, F.lit("NAO SE APLICA")).when(size % 5 == 3, F.lit("NAO IDENTIFICADO"))
                 .otherwise(F.lit("XYZ")))

    def features_of(df, name):
        return df.select(F.concat(F.lit("P"), key.cast("string")).alias("ID_PLANO"), name.alias("NM_PLANO"),
                         F.col("p_brand").alias("CD_PLANO"), maternity.alias("OBSTETRICIA"),
                         F.col("p_type").alias("COBERTURA"),
                         F.concat(F.lit("F"), (key % 3).cast("string")).alias("TIPO_FINANCIAMENTO"),
                         reg_text.alias("REGISTRO_OPERADORA"), F.lit("ATIVO").alias("SITUACAO_PLANO"),
                         F.when(size % 7 != 0, F.concat(F.lit("Op "), reg)).alias("RAZAO_SOCIAL"),
                         (size % 2).cast("string").alias("LG_ODONTOLOGICO"))

    features = features_of(part, F.col("p_name")).unionByName(
        features_of(part.filter(size <= 5), F.concat(F.col("p_name"), F.lit(" (copia)"))))
    day = lambda n: F.date_format(F.date_add(F.lit("2020-01-01").cast("date"), n), "dd/MM/yyyy")
    nk = F.col("s_nationkey")
    code = F.col("s_suppkey").cast("string")
    operators = sup.select(
        F.when(F.col("s_suppkey") % 29 == 0, F.concat(F.lit("?"), code)).otherwise(code).alias("reg ans"),
        F.when(nk % 2 == 0, F.lit("S")).otherwise(F.lit("N")).alias("Operadora Medico-Hospitalar"),
        F.when(nk % 5 == 0, F.lit("x")).otherwise(nk.cast("string")).alias("prazo_validade"),
        day(F.col("s_suppkey").cast("int")).alias("data_da_primeira_acreditacao"),
        day(nk).alias("inicio_validade"),
        F.when(nk % 4 == 0, F.lit("31/02/2024")).otherwise(day(nk + 1000)).alias("fim_validade"))
    lay = _layout(spark, "health_plans")
    write_csv(pricing, lay.src(health_plans.SOURCES["precificacao"]), delimiter=";")
    write_csv(features, lay.src(health_plans.SOURCES["caracteristicas"]), delimiter=";")
    write_csv(operators, lay.src(health_plans.SOURCES["operadora"]), delimiter=";")
    health_plans.run(spark, lay)
    return lay.read(spark, "gold", "fato_planos")


AREA_QUERIES["health_plans_gold_fact"] = health_plans_gold_fact
