"""Spark side of the query catalogue: one callable per operator of the inventory.

Every callable takes ``(spark, sf_dir)``, reads the driver's parquet tables (whole
tables, no subsets) and returns a lazy DataFrame whose column names match the DuckDB
oracle in ``oracles.py``. Round-trip queries write to a fresh folder under the shared
checkpoint location and never delete it (the caller collects lazily).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.functions import (
    combine_date_time, lower_columns, normalize_text, parse_date, parse_decimal_comma, recode, rename,
    safe_columns, try_cast, underscores_to_spaces,
)
from terrace.operators import (
    DimRef, DimensionSpec, build_dimension, build_dimensions, build_fact, consolidate, count_rows, dedupe, describe_schema,
    distinct_members, distinct_values, explode_records, fill_nulls, first_non_null, flatten_struct,
    keep_matching, preview, profile_filter, sorted_distinct_values, star_rollup, store_dimension,
    union_all_by_name, with_constant,
)
from terrace.operators.star import enrich, join_small, left_lookup_first
from terrace.plans.health_plans import AGE_BANDS
from terrace.session import shared_dir
from terrace.streaming import ingest_landing, read_landed
from terrace.sources import (
    LoadSpec, load_many, read_csv, read_json_envelope, read_table, write_csv, write_json_envelope,
    write_table,
)


ORDER_STATUS_LABELS = {"F": "Finalizado", "O": "Aberto"}
EVENT_TYPE_LABELS = {"click": "CLIQUE", "view": "VISUALIZACAO", "purchase": "COMPRA"}


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return read_table(spark, f"{d}/{name}.parquet")


def _orders_silver(spark: SparkSession, d: str) -> DataFrame:
    o = _t(spark, d, "orders")
    return o.withColumn("o_date", F.col("o_orderdate").cast("date"))


def _age_text(spark: SparkSession, d: str) -> DataFrame:
    """events with an age-like text column: numeric, '<n' (signup) or NULL (error)."""
    e = _t(spark, d, "events")
    k = F.regexp_extract("props", r'"k": (\d+)', 1)
    age = (F.when(F.col("event_type") == "error", F.lit(None).cast("string"))
           .when(F.col("event_type") == "signup", F.concat(F.lit("<"), k))
           .otherwise(k))
    return e.select("event_id", age.alias("age_text"))


# --------------------------------------------------------------------------- sources / sinks

def scan_table(spark, d):
    return read_table(spark, f"{d}/region.parquet")


def scan_csv(spark, d):
    out = shared_dir(spark, "landing") + "/customer_csv"
    write_csv(_t(spark, d, "customer"), out)
    return read_csv(spark, out)


def scan_csv_semicolon(spark, d):
    part = _t(spark, d, "part")
    out = shared_dir(spark, "landing") + "/part_csv"
    write_csv(part, out, delimiter=";")
    return read_csv(spark, out, delimiter=";", schema=part.schema)


def scan_json_envelope(spark, d):
    out = shared_dir(spark, "landing") + "/nation_json"
    write_json_envelope(_t(spark, d, "nation"), out, array_field="value", records_per_file=10)
    return read_json_envelope(spark, out)


def sink_overwrite_roundtrip(spark, d):
    out = shared_dir(spark, "tables") + "/supplier"
    s = _t(spark, d, "supplier")
    write_table(s, out)
    write_table(s, out)  # a refresh replaces, never appends
    return read_table(spark, out)


def sink_partitioned(spark, d):
    out = shared_dir(spark, "tables") + "/orders_by_year"
    o = _orders_silver(spark, d).withColumn("o_year", F.year("o_date"))
    write_table(o.drop("o_orderdate"), out, partition_by=["o_year"])
    back = read_table(spark, out)
    return back.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                       F.col("o_date").alias("o_orderdate"), "o_orderpriority", "o_year")


def sink_partitioned_text_codes(spark, d):
    """Codes such as 1 and 01 are different text and stay so as partition folders."""
    out = shared_dir(spark, "tables") + "/orders_by_code"
    number = (F.col("o_custkey") % 4).cast("string")
    code = F.when(F.col("o_custkey") % 2 == 0, F.concat(F.lit("0"), number)).otherwise(number)
    o = _t(spark, d, "orders").select("o_orderkey", F.when(F.col("o_custkey") % 5 == 0, F.lit("1")).otherwise(code).alias("code"))
    write_table(o, out, partition_by=["code"])
    return read_table(spark, out)


def sink_partitioned_two_level(spark, d):
    out = shared_dir(spark, "tables") + "/lineitem_by_month"
    li = _t(spark, d, "lineitem").withColumns({
        "l_shipdate": F.col("l_shipdate").cast("date"),
        "l_year": F.year("l_shipdate"), "l_month": F.month("l_shipdate")})
    write_table(li, out, partition_by=["l_year", "l_month"])
    return read_table(spark, out)


MAX_RECORDS = 1_000_000


def sink_max_records(spark, d):
    out = shared_dir(spark, "tables") + "/lineitem_capped"
    write_table(_t(spark, d, "lineitem"), out, max_records=MAX_RECORDS)
    per_file = read_table(spark, out).groupBy(F.input_file_name().alias("f")).agg(F.count(F.lit(1)).alias("n"))
    return per_file.agg(F.sum("n").alias("n_rows"),
                        F.count_if(F.col("n") > MAX_RECORDS).alias("files_over_cap"))


def _order_slices(spark, d):
    o = _orders_silver(spark, d).drop("o_orderdate").withColumn("y", F.year("o_date"))
    return {"orders_1992_1996": o.filter(F.col("y") <= 1996).drop("y"),
            "orders_1997_1998": o.filter(F.col("y").between(1997, 1998)).drop("y"),
            "orders_1999_2001": o.filter((F.col("y") >= 1999) | F.col("y").isNull()).drop("y")}


def load_many_files(spark, d):
    base = shared_dir(spark, "landing")
    for name, part in _order_slices(spark, d).items():
        write_table(part, f"{base}/{name}.parquet")
    specs = [LoadSpec(f"{base}/{name}.parquet") for name in _order_slices(spark, d)]
    tables = load_many(spark, specs, lambda s, spec: read_table(s, spec.source))
    tagged = [df.select(F.lit(name).alias("source"), "o_orderkey") for name, df in tables.items()]
    return union_all_by_name(*tagged).groupBy("source").agg(F.count(F.lit(1)).alias("n_rows"))


def stream_ingest_csv(spark, d):
    """Landing CSV files arriving in two drops, ingested incrementally; the second run of
    the stream loads only the new file."""
    cust = _t(spark, d, "customer")
    base = shared_dir(spark, "landing")
    landing, target = f"{base}/customer_drops", f"{base}/customer_bronze"
    checkpoint = shared_dir(spark, "stream-checkpoints")
    write_csv(cust.filter(F.col("c_mktsegment") <= "FURNITURE"), f"{landing}/drop1")
    ingest_landing(spark, f"{landing}/*", target, cust.schema, checkpoint=checkpoint)
    write_csv(cust.filter((F.col("c_mktsegment") > "FURNITURE") | F.col("c_mktsegment").isNull()), f"{landing}/drop2")
    ingest_landing(spark, f"{landing}/*", target, cust.schema, checkpoint=checkpoint)
    return read_landed(spark, target)


def stream_ingest_json_envelope(spark, d):
    """Page-sized JSON envelopes built from lineitem, ingested by the available-now file
    stream: records exploded from each envelope and appended exactly once."""
    from pyspark.sql import types as T
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag",
                                          F.col("l_quantity").cast("string").alias("l_quantity"))
    base = shared_dir(spark, "landing")
    write_json_envelope(li, f"{base}/lineitem_envelopes", array_field="value", records_per_file=100_000)
    record = T.StructType([T.StructField("l_orderkey", T.LongType()), T.StructField("l_linenumber", T.IntegerType()),
                           T.StructField("l_returnflag", T.StringType()), T.StructField("l_quantity", T.StringType())])
    target = f"{base}/lineitem_bronze"
    ingest_landing(spark, f"{base}/lineitem_envelopes", target, record, fmt="json_envelope")
    return read_landed(spark, target)


# --------------------------------------------------------------------------- projections / filters

def project_columns(spark, d):
    return _t(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")


def explode_array(spark, d):
    e = _t(spark, d, "embeddings")
    return explode_records(e, "embedding", alias="x", keep=["vec_id", "label"])


def flatten_struct_q(spark, d):
    n = _t(spark, d, "nation")
    nested = n.select(F.struct(*n.columns).alias("rec"))
    return flatten_struct(nested, "rec")


def rename_columns(spark, d):
    s = _t(spark, d, "supplier")
    return rename(s, {"S_SUPPKEY": "supplier_id", "s_name": "supplier_name",
                      "s_acctbal": "balance", "s_not_there": "ignored"})


def lower_case_columns(spark, d):
    r = _t(spark, d, "region").toDF("R_RegionKey", "R_NAME")
    return lower_columns(r)


def safe_column_names(spark, d):
    n = _t(spark, d, "nation").toDF("Nação Chave", "Nome, País", "Região-Chave")
    return safe_columns(n)


def drop_columns(spark, d):
    return _t(spark, d, "part").drop("p_name", "p_retailprice", "p_not_there")


def constant_measure(spark, d):
    o = _t(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return with_constant(o, "quantidade", 1)


def filter_regex_not_null(spark, d):
    return keep_matching(_age_text(spark, d), "age_text", r"^\d+$")


def parse_timestamp_guarded(spark, d):
    e = _t(spark, d, "events")
    hour_text = F.when(F.col("event_type") != "error", F.date_format("ts", "HH:mm"))
    ts = combine_date_time(F.col("ts").cast("date"), hour_text)
    return e.select("event_id", ts.cast("string").alias("data_hora"))


# --------------------------------------------------------------------------- scalar functions

def try_cast_int(spark, d):
    o = _t(spark, d, "orders")
    return o.select("o_orderkey",
                    try_cast(F.substring("o_orderpriority", 1, 1), "int").alias("priority_code"),
                    try_cast("o_orderstatus", "int").alias("status_code"))


def try_cast_double(spark, d):
    e = _t(spark, d, "events")
    k = F.regexp_extract("props", r'"k": (\d+)', 1)
    return e.select("event_id", try_cast(k, "double").alias("k_value"),
                    try_cast(F.concat(k, F.lit("x")), "double").alias("k_dirty"),
                    try_cast("event_type", "double").alias("type_value"))


def try_cast_boolean(spark, d):
    lb = _t(spark, d, "labels")
    return lb.select("doc_id", try_cast(F.col("quality").cast("string"), "boolean").alias("is_quality"),
                     try_cast(F.concat(F.lit("x"), F.col("toxic").cast("string")), "boolean").alias("is_dirty"))


def parse_date_q(spark, d):
    o = _t(spark, d, "orders")
    text = (F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("31/02/"), F.year("o_orderdate").cast("string")))
            .otherwise(F.date_format("o_orderdate", "dd/MM/yyyy")))
    return o.select("o_orderkey", parse_date(text, "dd/MM/yyyy").alias("data_pedido"))


def parse_datetime_to_date(spark, d):
    e = _t(spark, d, "events")
    text = F.date_format("ts", "dd/MM/yyyy HH:mm")
    return e.select("event_id", parse_date(text, "dd/MM/yyyy HH:mm").alias("data_evento"))


def concat_ws_q(spark, d):
    c = _t(spark, d, "customer")
    seg = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment"))
    return c.select("c_custkey", F.concat_ws(" - ", "c_name", seg, F.col("c_nationkey").cast("string")).alias("rotulo"))


def date_parts(spark, d):
    o = _t(spark, d, "orders")
    return o.select("o_orderkey", F.year("o_orderdate").alias("ano"), F.month("o_orderdate").alias("mes"),
                    F.dayofmonth("o_orderdate").alias("dia"))


def hour_of_day(spark, d):
    return _t(spark, d, "events").select("event_id", F.hour("ts").alias("hora"))


def normalize_text_q(spark, d):
    docs = _t(spark, d, "documents")
    return docs.select("doc_id", normalize_text("text").alias("text_norm"))


def decimal_comma(spark, d):
    e = _t(spark, d, "events")
    text = F.regexp_replace(F.col("value").cast("string"), r"\.", ",")
    grouped = F.concat(F.lit("1."), text)  # thousands point stays -> not a number
    return e.select("event_id", parse_decimal_comma(text).alias("valor"),
                    parse_decimal_comma(grouped).alias("valor_milhar"))


def regexp_replace_text(spark, d):
    p = _t(spark, d, "part")
    return p.select("p_partkey", underscores_to_spaces(F.concat_ws("_", "p_brand", "p_type")).alias("rotulo"))


def recode_with_default(spark, d):
    o = _t(spark, d, "orders")
    return o.select("o_orderkey", recode("o_orderstatus", ORDER_STATUS_LABELS, "Não informado").alias("desc_status"))


def recode_no_default(spark, d):
    p = _t(spark, d, "part")
    return p.select("p_partkey", recode("p_size", AGE_BANDS).alias("faixa_etaria_desc"))


def recode_values(spark, d):
    e = _t(spark, d, "events")
    return e.select("event_id", recode("event_type", EVENT_TYPE_LABELS, "OUTROS").alias("tipo"))


# --------------------------------------------------------------------------- NULL handling, profiling

def _docs_labels(spark, d):
    docs = _t(spark, d, "documents").select("doc_id", "lang", "source")
    return enrich(docs, _t(spark, d, "labels"), "doc_id")


def fill_nulls_q(spark, d):
    j = _docs_labels(spark, d)
    return fill_nulls(j, {"quality": -1, "toxic": -1, "lang": "nao_informada", "source": 0})


def schema_report(spark, d):
    return describe_schema(_t(spark, d, "orders"))


def profile_filter_q(spark, d):
    a = _age_text(spark, d)
    return profile_filter(a, "age_text", F.col("age_text").rlike(r"^\d+$"))


# --------------------------------------------------------------------------- aggregation, sets

def distinct_members_q(spark, d):
    return distinct_members(_t(spark, d, "orders"), ["o_orderstatus", "o_orderpriority"])


def dedupe_by_key(spark, d):
    docs = _t(spark, d, "documents")
    return dedupe(docs, ["text"], order_by=["doc_id"]).drop("text")


def distinct_values_q(spark, d):
    return distinct_values(_t(spark, d, "events"), "event_type")


def sorted_distinct_values_q(spark, d):
    return sorted_distinct_values(_t(spark, d, "part"), "p_size")


def group_first_non_null(spark, d):
    return first_non_null(_docs_labels(spark, d), ["source"], "quality", order_by="doc_id")


def count_rows_q(spark, d):
    return count_rows(_t(spark, d, "lineitem"))


def preview_top_n(spark, d):
    o = _t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return preview(o, 20, order_by=["o_orderkey"])


def union_by_name(spark, d):
    slices = list(_order_slices(spark, d).values())
    permuted = [slices[0], slices[1].select(*reversed(slices[1].columns)),
                slices[2].select(*sorted(slices[2].columns))]
    return union_all_by_name(*permuted)


def consolidate_overlapping(spark, d):
    o = _orders_silver(spark, d).drop("o_orderdate")
    y = F.year("o_date")
    older = o.filter(y <= 1998)
    newer = o.filter((y >= 1997) | y.isNull()).withColumn(
        "o_orderpriority", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")))
    return consolidate([older, newer], keys=["o_orderkey"], fill={"o_orderpriority": "nao_informada"})


# --------------------------------------------------------------------------- joins

def join_broadcast_single_key(spark, d):
    c = _t(spark, d, "customer").alias("c")
    n = _t(spark, d, "nation").alias("n")
    j = join_small(c, n, F.col("c.c_nationkey") == F.col("n.n_nationkey"))
    return j.select("c.c_custkey", "c.c_name", "n.n_name")


def join_broadcast_composite_and(spark, d):
    li = _t(spark, d, "lineitem")
    dim = build_dimension(li, ["l_returnflag", "l_linestatus"], "sk_flag_status")
    fact = build_fact(li, [DimRef(dim)], degenerate=["l_orderkey", "l_linenumber"])
    return fact


def join_broadcast_composite_list(spark, d):
    p = _t(spark, d, "part").alias("p")
    dim = build_dimension(p, ["p_brand", "p_type"], "sk_brand_type")
    dd = dim.df.alias("b")
    j = join_small(p, dd, [F.col("p.p_brand") == F.col("b.p_brand"), F.col("p.p_type") == F.col("b.p_type")])
    return j.select("p.p_partkey", "b.sk_brand_type")


def join_using_composite(spark, d):
    o = _t(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    dim = build_dimension(o, ["o_orderstatus", "o_orderpriority"], "sk_status_priority")
    return join_small(o, dim.df, ["o_orderstatus", "o_orderpriority"])


def join_left_using(spark, d):
    return _docs_labels(spark, d).select("doc_id", "lang", "quality", "toxic")


def join_left_expr(spark, d):
    p = _t(spark, d, "part").select("p_partkey", "p_brand")
    li = _t(spark, d, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", "l_quantity")
    j = enrich(p, li, (["p_partkey"], ["l_partkey"]), dedupe_other=False)
    return j.select("p_partkey", "p_brand", "l_orderkey", "l_linenumber", "l_quantity")


def _orders_star(spark, d):
    silver = _orders_silver(spark, d).withColumns({"ano": F.year("o_date"), "mes": F.month("o_date")})
    dims = build_dimensions(silver, {
        "date": DimensionSpec(("o_date",), "sk_date", ("ano", "mes")),
        "status": DimensionSpec(("o_orderstatus", "o_orderpriority"), "sk_status_priority"),
        "customer": DimensionSpec(("o_custkey",), "sk_customer"),
    })
    return silver, dims


def star_fact_build(spark, d):
    silver, dims = _orders_star(spark, d)
    return build_fact(silver, [DimRef(dims["date"]), DimRef(dims["status"]), DimRef(dims["customer"])],
                      measures=["o_totalprice"], degenerate=["o_orderkey"], constants={"quantidade": 1})


def star_fact_null_drop(spark, d):
    silver = _orders_silver(spark, d).withColumn(
        "o_orderpriority", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")))
    dim = build_dimension(silver, ["o_orderstatus", "o_orderpriority"], "sk_status_priority")
    return build_fact(silver, [DimRef(dim)], measures=["o_totalprice"], degenerate=["o_orderkey"])


def fact_partial_key_fanout(spark, d):
    e = _t(spark, d, "events").withColumns({"dia": F.col("ts").cast("date"), "hora": F.hour("ts")})
    dim = build_dimension(e, ["dia", "hora"], "sk_tempo")
    return build_fact(e, [DimRef(dim, on=["dia"], allow_fanout=True)], degenerate=["event_id"],
                      constants={"quantidade": 1})


def fact_determinant_key(spark, d):
    silver = _orders_silver(spark, d).withColumns(
        {"ano": F.year("o_date"), "mes": F.month("o_date"), "dia": F.dayofmonth("o_date")})
    dim = build_dimension(silver, ["o_date"], "sk_date", attributes=["ano", "mes", "dia"])
    return build_fact(silver, [DimRef(dim, on=["o_date"])], degenerate=["o_orderkey"])


def snowflake_key_carry(spark, d):
    region = build_dimension(_t(spark, d, "region"), ["r_regionkey"], "sk_region", attributes=["r_name"])
    nation = _t(spark, d, "nation")
    nation_k = build_fact(nation, [DimRef(region, on=["r_regionkey"], fact_on=["n_regionkey"])],
                          degenerate=["n_nationkey", "n_name"])
    dim_nation = build_dimension(nation_k, ["n_nationkey"], "sk_nation", attributes=["n_name", "sk_region"])
    c = _t(spark, d, "customer")
    return build_fact(c, [DimRef(dim_nation, on=["n_nationkey"], fact_on=["c_nationkey"], carry=["sk_region"])],
                      degenerate=["c_custkey"])


# --------------------------------------------------------------------------- keys, dimensions, roll-up

def surrogate_key_dense(spark, d):
    # range sort, then offsets per sort partition
    o = _orders_silver(spark, d)
    return build_dimension(o, ["o_custkey", "o_date"], "sk_cliente_data").df


def dim_build(spark, d):
    return build_dimension(_t(spark, d, "orders"), ["o_orderpriority"], "sk_priority").df


def dim_build_derived(spark, d):
    e = _t(spark, d, "events").withColumns({
        "data_ocorrencia": F.col("ts").cast("date"),
        "data_hora": F.date_trunc("hour", "ts"),
        "ano": F.year("ts"), "mes": F.month("ts")})
    dim = build_dimension(e, ["data_ocorrencia", "data_hora"], "sk_tempo", attributes=["ano", "mes"],
                          derived={"hora": F.hour("data_hora")})
    return dim.df.withColumn("data_hora", F.col("data_hora").cast("string"))


def dim_write_then_read(spark, d):
    s = _t(spark, d, "supplier")
    dim = build_dimension(s, ["s_nationkey"], "sk_nation_sup")
    stored = store_dimension(dim, shared_dir(spark, "gold") + "/dim_nation_sup")
    return build_fact(s, [DimRef(stored)], degenerate=["s_suppkey"])


def dim_from_join(spark, d):
    s = _t(spark, d, "supplier").select("s_suppkey")
    li = _t(spark, d, "lineitem").select("l_suppkey", "l_returnflag")
    members = left_lookup_first(s, "s_suppkey", li, "l_suppkey", "l_returnflag", alias="first_flag")
    return build_dimension(members, ["s_suppkey"], "sk_supplier", attributes=["first_flag"],
                           members_unique=True).df


def dim_snowflake(spark, d):
    dim_nation = build_dimension(_t(spark, d, "nation"), ["n_nationkey"], "sk_nation")
    c = _t(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    prio = _t(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderpriority")
    j = enrich(c, prio, "c_custkey")
    j = join_small(j, dim_nation.df.select("n_nationkey", "sk_nation"),
                   F.col("c_nationkey") == F.col("n_nationkey"), how="left")
    members = dedupe(j.select("c_custkey", "c_name", "o_orderpriority", "sk_nation"), ["c_custkey"],
                     order_by=["o_orderpriority"], late_rows=False)  # most customers have several orders
    return build_dimension(members, ["c_custkey"], "sk_customer",
                           attributes=["c_name", "o_orderpriority", "sk_nation"], members_unique=True).df


def star_rollup_q(spark, d):
    silver, dims = _orders_star(spark, d)
    fact = build_fact(silver, [DimRef(dims["date"]), DimRef(dims["status"])], measures=["o_totalprice"],
                      constants={"quantidade": 1})
    out = star_rollup(fact, [dims["date"], dims["status"]], ["ano", "o_orderpriority"],
                      {"n_orders": ("sum", "quantidade"), "total_price": ("sum", "o_totalprice")})
    return out.select("ano", "o_orderpriority", F.col("n_orders").cast("long").alias("n_orders"),
                      F.col("total_price").cast("decimal(18,2)").alias("total_price"))


def star_rollup_merges(spark, d):
    """Every merge, with dimensions above the broadcast limit: the fact is reduced first."""
    silver, dims = _orders_star(spark, d)
    fact = build_fact(silver, [DimRef(dims["date"]), DimRef(dims["status"])], measures=["o_totalprice", "o_custkey"])
    price = F.col("o_totalprice").cast("decimal(18,2)")
    return star_rollup(fact, [dims["date"], dims["status"]], ["ano", "o_orderstatus"],
                       {"n": ("count", "o_custkey"), "least": ("min", price), "most": ("max", price),
                        "mean_key": ("avg", "o_custkey")}, broadcast_limit=0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_table": scan_table,
    "scan_csv": scan_csv,
    "scan_csv_semicolon": scan_csv_semicolon,
    "scan_json_envelope": scan_json_envelope,
    "sink_overwrite_roundtrip": sink_overwrite_roundtrip,
    "sink_partitioned": sink_partitioned,
    "sink_partitioned_two_level": sink_partitioned_two_level,
    "sink_max_records": sink_max_records,
    "load_many_files": load_many_files,
    "stream_ingest_csv": stream_ingest_csv,
    "stream_ingest_json_envelope": stream_ingest_json_envelope,
    "project_columns": project_columns,
    "explode_array": explode_array,
    "flatten_struct": flatten_struct_q,
    "rename_columns": rename_columns,
    "lower_case_columns": lower_case_columns,
    "safe_column_names": safe_column_names,
    "drop_columns": drop_columns,
    "constant_measure": constant_measure,
    "filter_regex_not_null": filter_regex_not_null,
    "parse_timestamp_guarded": parse_timestamp_guarded,
    "try_cast_int": try_cast_int,
    "try_cast_double": try_cast_double,
    "try_cast_boolean": try_cast_boolean,
    "parse_date": parse_date_q,
    "parse_datetime_to_date": parse_datetime_to_date,
    "concat_ws": concat_ws_q,
    "date_parts": date_parts,
    "hour_of_day": hour_of_day,
    "normalize_text": normalize_text_q,
    "decimal_comma": decimal_comma,
    "regexp_replace_text": regexp_replace_text,
    "recode_with_default": recode_with_default,
    "recode_no_default": recode_no_default,
    "recode_values": recode_values,
    "fill_nulls": fill_nulls_q,
    "schema_report": schema_report,
    "profile_filter": profile_filter_q,
    "distinct_members": distinct_members_q,
    "dedupe_by_key": dedupe_by_key,
    "distinct_values": distinct_values_q,
    "sorted_distinct_values": sorted_distinct_values_q,
    "group_first_non_null": group_first_non_null,
    "count_rows": count_rows_q,
    "preview_top_n": preview_top_n,
    "union_by_name": union_by_name,
    "consolidate_overlapping": consolidate_overlapping,
    "join_broadcast_single_key": join_broadcast_single_key,
    "join_broadcast_composite_and": join_broadcast_composite_and,
    "join_broadcast_composite_list": join_broadcast_composite_list,
    "join_using_composite": join_using_composite,
    "join_left_using": join_left_using,
    "join_left_expr": join_left_expr,
    "star_fact_build": star_fact_build,
    "star_fact_null_drop": star_fact_null_drop,
    "fact_partial_key_fanout": fact_partial_key_fanout,
    "fact_determinant_key": fact_determinant_key,
    "snowflake_key_carry": snowflake_key_carry,
    "surrogate_key_dense": surrogate_key_dense,
    "dim_build": dim_build,
    "dim_build_derived": dim_build_derived,
    "dim_write_then_read": dim_write_then_read,
    "dim_from_join": dim_from_join,
    "dim_snowflake": dim_snowflake,
    "star_rollup": star_rollup_q,
    "star_rollup_merges": star_rollup_merges,
    "sink_partitioned_text_codes": sink_partitioned_text_codes,
}

from queries_areas import AREA_QUERIES  # noqa: E402  (whole subject-area jobs)

QUERIES.update(AREA_QUERIES)
