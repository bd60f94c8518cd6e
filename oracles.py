"""DuckDB oracle SQL for every query in ``queries_impl.QUERIES``.

Conventions (see SURVEY §5.3): integer sums are cast to BIGINT, year/month/hour to
INTEGER, dense keys are ``row_number()`` over the distinct members ordered by the
natural key with NULLs first, de-duplication is ``QUALIFY row_number() = 1``.
"""

from __future__ import annotations

ACCENTS = "translate({c}, 'áàãâäéèêëíìîïóòõôöúùûüç', 'aaaaaeeeeiiiiooooouuuuc')"

# Spark upper-cases with full Unicode case mapping (one letter may become two).
_SPARK_UPPER_SPECIALS = [("ß", "SS"), ("ﬁ", "FI"), ("ﬂ", "FL"), ("ﬀ", "FF"), ("ﬃ", "FFI"), ("ﬄ", "FFL")]


def _spark_upper(expr: str) -> str:
    for src, dst in _SPARK_UPPER_SPECIALS:
        expr = f"replace({expr}, '{src}', '{dst}')"
    return f"upper({expr})"


AGE_TEXT = """(SELECT event_id,
        CASE WHEN event_type = 'error' THEN NULL
             WHEN event_type = 'signup' THEN '<' || regexp_extract(props, '"k": (\\d+)', 1)
             ELSE regexp_extract(props, '"k": (\\d+)', 1) END AS age_text
   FROM events)"""

ORDER_SLICE = """CASE WHEN year(o_orderdate) <= 1996 THEN 'orders_1992_1996'
            WHEN year(o_orderdate) <= 1998 THEN 'orders_1997_1998'
            ELSE 'orders_1999_2001' END"""

ORDERS_FACT = """
WITH s AS (SELECT *, CAST(o_orderdate AS DATE) AS o_date FROM orders),
d_date AS (SELECT o_date, row_number() OVER (ORDER BY o_date NULLS FIRST) AS sk_date
           FROM (SELECT DISTINCT o_date, CAST(year(o_date) AS INTEGER) AS ano,
                        CAST(month(o_date) AS INTEGER) AS mes FROM s)),
d_status AS (SELECT o_orderstatus, o_orderpriority,
                    row_number() OVER (ORDER BY o_orderstatus NULLS FIRST, o_orderpriority NULLS FIRST) AS sk_status_priority
             FROM (SELECT DISTINCT o_orderstatus, o_orderpriority FROM s)),
d_cust AS (SELECT o_custkey, row_number() OVER (ORDER BY o_custkey NULLS FIRST) AS sk_customer
           FROM (SELECT DISTINCT o_custkey FROM s))
"""

ORACLES: dict[str, str] = {
    # ------------------------------------------------------------------ sources / sinks
    "scan_table": "SELECT * FROM region",
    "scan_csv": """SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
                   FROM customer""",
    "scan_csv_semicolon": "SELECT * FROM part",
    "scan_json_envelope": """SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, n_name,
                                    CAST(n_regionkey AS BIGINT) AS n_regionkey FROM nation""",
    "sink_overwrite_roundtrip": "SELECT * FROM supplier",
    "sink_partitioned": """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
                                  CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority,
                                  CAST(year(o_orderdate) AS INTEGER) AS o_year FROM orders""",
    "sink_partitioned_two_level": """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
                                            l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
                                            CAST(l_shipdate AS DATE) AS l_shipdate,
                                            CAST(year(l_shipdate) AS INTEGER) AS l_year,
                                            CAST(month(l_shipdate) AS INTEGER) AS l_month FROM lineitem""",
    "sink_max_records": """SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS files_over_cap
                           FROM lineitem""",
    "load_many_files": f"""SELECT {ORDER_SLICE} AS source, count(*) AS n_rows FROM orders GROUP BY 1""",
    "stream_ingest_csv": "SELECT * FROM customer",
    "stream_ingest_json_envelope": """SELECT l_orderkey, l_linenumber, l_returnflag,
                                             CAST(l_quantity AS VARCHAR) AS l_quantity FROM lineitem""",
    # ------------------------------------------------------------------ projections / filters
    "project_columns": "SELECT c_custkey, c_name, c_mktsegment FROM customer",
    "explode_array": "SELECT vec_id, label, unnest(embedding) AS x FROM embeddings",
    "flatten_struct": "SELECT * FROM nation",
    "rename_columns": """SELECT s_suppkey AS supplier_id, s_name AS supplier_name, s_nationkey,
                                s_acctbal AS balance FROM supplier""",
    "lower_case_columns": "SELECT r_regionkey, r_name FROM region",
    "safe_column_names": """SELECT n_nationkey AS nacao_chave, n_name AS nome_pais,
                                   n_regionkey AS regiao_chave FROM nation""",
    "drop_columns": "SELECT p_partkey, p_brand, p_type, p_size FROM part",
    "constant_measure": "SELECT o_orderkey, o_orderstatus, 1 AS quantidade FROM orders",
    "filter_regex_not_null": f"""SELECT event_id, age_text FROM {AGE_TEXT}
                                 WHERE age_text IS NOT NULL AND regexp_matches(age_text, '^\\d+$')""",
    "parse_timestamp_guarded": """SELECT event_id,
        CASE WHEN event_type <> 'error' THEN CAST(try_strptime(CAST(CAST(ts AS DATE) AS VARCHAR) || ' ' ||
             strftime(ts, '%H:%M'), '%Y-%m-%d %H:%M') AS VARCHAR) END AS data_hora FROM events""",
    # ------------------------------------------------------------------ scalar functions
    "try_cast_int": """SELECT o_orderkey, TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority_code,
                              TRY_CAST(o_orderstatus AS INTEGER) AS status_code FROM orders""",
    "try_cast_double": """SELECT event_id, TRY_CAST(regexp_extract(props, '"k": (\\d+)', 1) AS DOUBLE) AS k_value,
                                 TRY_CAST(regexp_extract(props, '"k": (\\d+)', 1) || 'x' AS DOUBLE) AS k_dirty,
                                 TRY_CAST(event_type AS DOUBLE) AS type_value FROM events""",
    "try_cast_boolean": """SELECT doc_id, TRY_CAST(CAST(quality AS VARCHAR) AS BOOLEAN) AS is_quality,
                                  TRY_CAST('x' || CAST(toxic AS VARCHAR) AS BOOLEAN) AS is_dirty FROM labels""",
    "parse_date": """SELECT o_orderkey, CAST(try_strptime(
                            CASE WHEN o_orderstatus = 'P' THEN '31/02/' || CAST(year(o_orderdate) AS VARCHAR)
                                 ELSE strftime(o_orderdate, '%d/%m/%Y') END, '%d/%m/%Y') AS DATE) AS data_pedido
                     FROM orders""",
    "parse_datetime_to_date": """SELECT event_id, CAST(try_strptime(strftime(ts, '%d/%m/%Y %H:%M'),
                                        '%d/%m/%Y %H:%M') AS DATE) AS data_evento FROM events""",
    "concat_ws": """SELECT c_custkey, concat_ws(' - ', c_name,
                           CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END,
                           CAST(c_nationkey AS VARCHAR)) AS rotulo FROM customer""",
    "date_parts": """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS ano,
                            CAST(month(o_orderdate) AS INTEGER) AS mes,
                            CAST(day(o_orderdate) AS INTEGER) AS dia FROM orders""",
    "hour_of_day": "SELECT event_id, CAST(hour(ts) AS INTEGER) AS hora FROM events",
    "normalize_text": f"SELECT doc_id, {_spark_upper(ACCENTS.format(c='text'))} AS text_norm FROM documents",
    "decimal_comma": """SELECT event_id,
                               TRY_CAST(replace(replace(CAST(value AS VARCHAR), '.', ','), ',', '.') AS DOUBLE) AS valor,
                               TRY_CAST(replace('1.' || replace(CAST(value AS VARCHAR), '.', ','), ',', '.') AS DOUBLE)
                                   AS valor_milhar FROM events""",
    "regexp_replace_text": """SELECT p_partkey, replace(concat_ws('_', p_brand, p_type), '_', ' ') AS rotulo
                              FROM part""",
    "recode_with_default": """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Finalizado' WHEN 'O' THEN 'Aberto'
                                     ELSE 'Não informado' END AS desc_status FROM orders""",
    "recode_no_default": """SELECT p_partkey, CASE p_size WHEN 1 THEN '0-18' WHEN 2 THEN '19-23' WHEN 3 THEN '24-28'
                                   WHEN 4 THEN '29-33' WHEN 5 THEN '34-38' WHEN 6 THEN '39-43' WHEN 7 THEN '44-48'
                                   WHEN 8 THEN '49-53' WHEN 9 THEN '54-58' WHEN 10 THEN '59+' END AS faixa_etaria_desc
                            FROM part""",
    "recode_values": """SELECT event_id, CASE event_type WHEN 'click' THEN 'CLIQUE' WHEN 'view' THEN 'VISUALIZACAO'
                               WHEN 'purchase' THEN 'COMPRA' ELSE 'OUTROS' END AS tipo FROM events""",
    # ------------------------------------------------------------------ NULL handling, profiling
    "fill_nulls": """SELECT d.doc_id, coalesce(d.lang, 'nao_informada') AS lang, d.source,
                            coalesce(l.quality, -1) AS quality, coalesce(l.toxic, -1) AS toxic
                     FROM documents d LEFT JOIN (SELECT DISTINCT * FROM labels) l ON d.doc_id = l.doc_id""",
    "schema_report": """SELECT 1 AS position, 'o_orderkey' AS name, 'bigint' AS type, count(o_orderkey) AS non_null FROM orders
                        UNION ALL SELECT 2, 'o_custkey', 'bigint', count(o_custkey) FROM orders
                        UNION ALL SELECT 3, 'o_orderstatus', 'string', count(o_orderstatus) FROM orders
                        UNION ALL SELECT 4, 'o_totalprice', 'double', count(o_totalprice) FROM orders
                        UNION ALL SELECT 5, 'o_orderdate', 'timestamp_ntz', count(o_orderdate) FROM orders
                        UNION ALL SELECT 6, 'o_orderpriority', 'string', count(o_orderpriority) FROM orders""",
    "profile_filter": f"""SELECT age_text AS value, count(*) AS rows,
                                 count(*) FILTER (WHERE regexp_matches(age_text, '^\\d+$')) AS kept
                          FROM {AGE_TEXT} GROUP BY age_text""",
    # ------------------------------------------------------------------ aggregation, sets
    "distinct_members": "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders",
    "dedupe_by_key": """SELECT doc_id, lang, source, n_chars FROM documents
                        QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1""",
    "distinct_values": "SELECT DISTINCT event_type FROM events",
    "sorted_distinct_values": "SELECT DISTINCT p_size FROM part ORDER BY p_size NULLS FIRST",
    "group_first_non_null": """SELECT d.source, arg_min(l.quality, d.doc_id) FILTER (WHERE l.quality IS NOT NULL) AS quality
                               FROM documents d LEFT JOIN (SELECT DISTINCT * FROM labels) l ON d.doc_id = l.doc_id
                               GROUP BY d.source""",
    "count_rows": "SELECT count(*) AS n_rows FROM lineitem",
    "preview_top_n": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 20",
    "union_by_name": """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
                               CAST(o_orderdate AS DATE) AS o_date FROM orders""",
    "consolidate_overlapping": """
        WITH u AS (
          SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, CAST(o_orderdate AS DATE) AS o_date
          FROM orders WHERE year(o_orderdate) <= 1998
          UNION ALL
          SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
                 coalesce(CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END, 'nao_informada'),
                 CAST(o_orderdate AS DATE)
          FROM orders WHERE year(o_orderdate) >= 1997)
        SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY o_orderkey
            ORDER BY o_custkey, o_orderstatus, o_totalprice, o_orderpriority, o_date) = 1""",
    # ------------------------------------------------------------------ joins
    "join_broadcast_single_key": """SELECT c.c_custkey, c.c_name, n.n_name
                                    FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "join_broadcast_composite_and": """
        WITH d AS (SELECT l_returnflag, l_linestatus,
                          row_number() OVER (ORDER BY l_returnflag NULLS FIRST, l_linestatus NULLS FIRST) AS sk_flag_status
                   FROM (SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem))
        SELECT d.sk_flag_status, l.l_orderkey, l.l_linenumber FROM lineitem l
        JOIN d ON l.l_returnflag = d.l_returnflag AND l.l_linestatus = d.l_linestatus""",
    "join_broadcast_composite_list": """
        WITH b AS (SELECT p_brand, p_type,
                          row_number() OVER (ORDER BY p_brand NULLS FIRST, p_type NULLS FIRST) AS sk_brand_type
                   FROM (SELECT DISTINCT p_brand, p_type FROM part))
        SELECT p.p_partkey, b.sk_brand_type FROM part p JOIN b ON p.p_brand = b.p_brand AND p.p_type = b.p_type""",
    "join_using_composite": """
        WITH d AS (SELECT o_orderstatus, o_orderpriority,
                          row_number() OVER (ORDER BY o_orderstatus NULLS FIRST, o_orderpriority NULLS FIRST) AS sk_status_priority
                   FROM (SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders))
        SELECT o.o_orderstatus, o.o_orderpriority, o.o_orderkey, d.sk_status_priority
        FROM orders o JOIN d USING (o_orderstatus, o_orderpriority)""",
    "join_left_using": """SELECT d.doc_id, d.lang, l.quality, l.toxic
                          FROM documents d LEFT JOIN (SELECT DISTINCT * FROM labels) l ON d.doc_id = l.doc_id""",
    "join_left_expr": """SELECT p.p_partkey, p.p_brand, l.l_orderkey, l.l_linenumber, l.l_quantity
                         FROM part p LEFT JOIN lineitem l ON p.p_partkey = l.l_partkey""",
    "star_fact_build": ORDERS_FACT + """
        SELECT d_date.sk_date, d_status.sk_status_priority, d_cust.sk_customer, s.o_totalprice, s.o_orderkey,
               1 AS quantidade
        FROM s JOIN d_date ON s.o_date = d_date.o_date
               JOIN d_status ON s.o_orderstatus = d_status.o_orderstatus AND s.o_orderpriority = d_status.o_orderpriority
               JOIN d_cust ON s.o_custkey = d_cust.o_custkey""",
    "star_fact_null_drop": """
        WITH s AS (SELECT o_orderkey, o_orderstatus, o_totalprice,
                          CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS o_orderpriority FROM orders),
        d AS (SELECT o_orderstatus, o_orderpriority,
                     row_number() OVER (ORDER BY o_orderstatus NULLS FIRST, o_orderpriority NULLS FIRST) AS sk_status_priority
              FROM (SELECT DISTINCT o_orderstatus, o_orderpriority FROM s))
        SELECT d.sk_status_priority, s.o_totalprice, s.o_orderkey FROM s
        JOIN d ON s.o_orderstatus = d.o_orderstatus AND s.o_orderpriority = d.o_orderpriority""",
    "fact_partial_key_fanout": """
        WITH e AS (SELECT event_id, CAST(ts AS DATE) AS dia, CAST(hour(ts) AS INTEGER) AS hora FROM events),
        d AS (SELECT dia, hora, row_number() OVER (ORDER BY dia NULLS FIRST, hora NULLS FIRST) AS sk_tempo
              FROM (SELECT DISTINCT dia, hora FROM e))
        SELECT d.sk_tempo, e.event_id, 1 AS quantidade FROM e JOIN d ON e.dia = d.dia""",
    "fact_determinant_key": """
        WITH s AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_date FROM orders),
        d AS (SELECT o_date, row_number() OVER (ORDER BY o_date NULLS FIRST) AS sk_date
              FROM (SELECT DISTINCT o_date FROM s))
        SELECT d.sk_date, s.o_orderkey FROM s JOIN d ON s.o_date = d.o_date""",
    "snowflake_key_carry": """
        WITH r AS (SELECT r_regionkey, row_number() OVER (ORDER BY r_regionkey NULLS FIRST) AS sk_region
                   FROM (SELECT DISTINCT r_regionkey, r_name FROM region)),
        n AS (SELECT n_nationkey, sk_region, row_number() OVER (ORDER BY n_nationkey NULLS FIRST) AS sk_nation
              FROM (SELECT DISTINCT n.n_nationkey, n.n_name, r.sk_region FROM nation n
                    JOIN r ON n.n_regionkey = r.r_regionkey))
        SELECT n.sk_nation, n.sk_region, c.c_custkey FROM customer c JOIN n ON c.c_nationkey = n.n_nationkey""",
    # ------------------------------------------------------------------ keys, dimensions, roll-up
    "surrogate_key_dense": """
        SELECT o_custkey, o_date, row_number() OVER (ORDER BY o_custkey NULLS FIRST, o_date NULLS FIRST) AS sk_cliente_data
        FROM (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS o_date FROM orders)""",
    "dim_build": """SELECT o_orderpriority, row_number() OVER (ORDER BY o_orderpriority NULLS FIRST) AS sk_priority
                    FROM (SELECT DISTINCT o_orderpriority FROM orders)""",
    "dim_build_derived": """
        SELECT data_ocorrencia, CAST(data_hora AS VARCHAR) AS data_hora, ano, mes,
               CAST(hour(data_hora) AS INTEGER) AS hora,
               row_number() OVER (ORDER BY data_ocorrencia NULLS FIRST, data_hora NULLS FIRST,
                                           ano NULLS FIRST, mes NULLS FIRST) AS sk_tempo
        FROM (SELECT DISTINCT CAST(ts AS DATE) AS data_ocorrencia, date_trunc('hour', ts) AS data_hora,
                              CAST(year(ts) AS INTEGER) AS ano, CAST(month(ts) AS INTEGER) AS mes FROM events)""",
    "dim_write_then_read": """
        WITH d AS (SELECT s_nationkey, row_number() OVER (ORDER BY s_nationkey NULLS FIRST) AS sk_nation_sup
                   FROM (SELECT DISTINCT s_nationkey FROM supplier))
        SELECT d.sk_nation_sup, s.s_suppkey FROM supplier s JOIN d ON s.s_nationkey = d.s_nationkey""",
    "dim_from_join": """
        SELECT s_suppkey, first_flag, row_number() OVER (ORDER BY s_suppkey NULLS FIRST, first_flag NULLS FIRST) AS sk_supplier
        FROM (SELECT s.s_suppkey, min(l.l_returnflag) AS first_flag
              FROM supplier s LEFT JOIN lineitem l ON s.s_suppkey = l.l_suppkey GROUP BY s.s_suppkey)""",
    "dim_snowflake": """
        WITH n AS (SELECT n_nationkey, row_number() OVER (ORDER BY n_nationkey NULLS FIRST) AS sk_nation
                   FROM (SELECT DISTINCT * FROM nation)),
        j AS (SELECT c.c_custkey, c.c_name, p.o_orderpriority, n.sk_nation
              FROM customer c
              LEFT JOIN (SELECT DISTINCT o_custkey, o_orderpriority FROM orders) p ON c.c_custkey = p.o_custkey
              LEFT JOIN n ON c.c_nationkey = n.n_nationkey),
        m AS (SELECT * FROM j QUALIFY row_number() OVER (PARTITION BY c_custkey
                  ORDER BY o_orderpriority NULLS FIRST, c_name NULLS FIRST, sk_nation NULLS FIRST) = 1)
        SELECT *, row_number() OVER (ORDER BY c_custkey NULLS FIRST, c_name NULLS FIRST,
                                     o_orderpriority NULLS FIRST, sk_nation NULLS FIRST) AS sk_customer FROM m""",
    "star_rollup_merges": """SELECT CAST(year(o_orderdate) AS INTEGER) AS ano, o_orderstatus, count(o_custkey) AS n,
            min(CAST(o_totalprice AS DECIMAL(18,2))) AS least, max(CAST(o_totalprice AS DECIMAL(18,2))) AS most,
            CAST(sum(o_custkey) AS DOUBLE) / count(o_custkey) AS mean_key FROM orders GROUP BY 1, 2""",
    "sink_partitioned_text_codes": """SELECT o_orderkey, CASE WHEN o_custkey % 5 = 0 THEN '1'
            WHEN o_custkey % 2 = 0 THEN '0' || CAST(o_custkey % 4 AS VARCHAR) ELSE CAST(o_custkey % 4 AS VARCHAR) END AS code
            FROM orders""",
    "star_rollup": ORDERS_FACT + """
        SELECT CAST(year(s.o_date) AS INTEGER) AS ano, s.o_orderpriority, CAST(count(*) AS BIGINT) AS n_orders,
               CAST(sum(s.o_totalprice) AS DECIMAL(18,2)) AS total_price
        FROM s JOIN d_date ON s.o_date = d_date.o_date
               JOIN d_status ON s.o_orderstatus = d_status.o_orderstatus AND s.o_orderpriority = d_status.o_orderpriority
        GROUP BY 1, 2""",
}


def _dense(cols: list[str], sk: str, source: str) -> str:
    order = ", ".join(f"{c} NULLS FIRST" for c in cols)
    return f"SELECT *, row_number() OVER (ORDER BY {order}) AS {sk} FROM (SELECT DISTINCT {', '.join(cols)} FROM {source})"


def _on(alias: str, cols: list[str]) -> str:
    return " AND ".join(f"s.{c} = {alias}.{c}" for c in cols)


AREA_ORACLES: dict[str, str] = {
    "currency_gold_fact": f"""
        WITH s AS (
          SELECT CAST(year(l_shipdate) AS INTEGER) AS ano, l_discount AS denominacao, l_returnflag AS especie,
                 CASE WHEN l_linestatus = 'O' THEN NULL ELSE CAST(round(l_quantity) AS INTEGER) END AS quant_produzida
          FROM lineitem),
        t AS ({_dense(['ano'], 'sk_tempo', 's')}),
        dn AS ({_dense(['denominacao'], 'sk_denominacao', 's')}),
        es AS ({_dense(['especie'], 'sk_especie', 's')})
        SELECT t.sk_tempo, dn.sk_denominacao, es.sk_especie, s.quant_produzida, s.ano
        FROM s JOIN t ON {_on('t', ['ano'])} JOIN dn ON {_on('dn', ['denominacao'])}
               JOIN es ON {_on('es', ['especie'])}""",
    "admissions_gold_fact": f"""
        WITH src AS (
          SELECT CASE WHEN o.o_orderstatus = 'F' AND o.o_orderpriority = '5-LOW' THEN NULL
                      ELSE CAST(o.o_orderdate AS DATE) END AS data_internacao,
                 upper(n.n_name) AS municipio, c.c_mktsegment AS sexo,
                 CASE WHEN o.o_orderstatus = 'P' THEN NULL ELSE CAST(o.o_custkey % 90 AS INTEGER) END AS idade,
                 o.o_orderpriority AS especialidade
          FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey),
        s AS (SELECT *, CAST(year(data_internacao) AS INTEGER) AS ano, CAST(month(data_internacao) AS INTEGER) AS mes,
                     CAST(day(data_internacao) AS INTEGER) AS dia FROM src),
        de AS ({_dense(['especialidade'], 'sk_especialidade', 's')}),
        dm AS ({_dense(['municipio'], 'sk_municipio', 's')}),
        dd AS ({_dense(['data_internacao', 'ano', 'mes', 'dia'], 'sk_data', 's')}),
        dx AS ({_dense(['sexo'], 'sk_sexo', 's')})
        SELECT de.sk_especialidade, dm.sk_municipio, dx.sk_sexo, dd.sk_data, s.mes, s.idade, 1 AS qtd_internacoes
        FROM s JOIN de ON {_on('de', ['especialidade'])} JOIN dm ON {_on('dm', ['municipio'])}
               JOIN dd ON {_on('dd', ['data_internacao'])} JOIN dx ON {_on('dx', ['sexo'])}""",
    "deaths_gold_fact": f"""
        WITH ev AS (SELECT *, regexp_extract(props, '"k": (\\d+)', 1) AS k, user_id AS u FROM events),
        raw AS (
          SELECT CAST(year(ts) AS INTEGER) AS ano_obito, CAST(month(ts) AS INTEGER) AS mes_obito,
                 CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'signup' THEN '<' || k ELSE k END AS age_text,
                 event_type AS faixa_etaria,
                 'CAP' || CAST(u % 3 AS VARCHAR) AS cid_capitulo, 'I' || CAST(u % 13 AS VARCHAR) AS cid_obito,
                 'causa ' || CAST(u % 13 AS VARCHAR) AS desc_cid_obito, 'cor ' || CAST(u % 5 AS VARCHAR) AS cor_obito,
                 'S' || CAST(u % 2 AS VARCHAR) AS sexo_obito, 'UF' || CAST(u % 4 AS VARCHAR) AS uf_moradia,
                 'REG' || CAST(u % 6 AS VARCHAR) AS reg_moradia, 'RA' || CAST(u % 8 AS VARCHAR) AS reg_adm_moradia,
                 'REGE' || CAST(u % 6 AS VARCHAR) AS reg_atendimento,
                 'EST' || CAST(u % 11 AS VARCHAR) AS sigla_estab_atend, 'TIPO' || CAST(u % 2 AS VARCHAR) AS tipo_obito,
                 CASE WHEN event_type <> 'view' THEN 'VIOL' || CAST(u % 3 AS VARCHAR) END AS tipo_violencia
          FROM ev),
        s AS (SELECT *, CAST(age_text AS INTEGER) AS idade_obito FROM raw
              WHERE age_text IS NOT NULL AND regexp_matches(age_text, '^\\d+$')),
        dt AS ({_dense(['ano_obito', 'mes_obito'], 'sk_tempo', 's')}),
        dmo AS ({_dense(['uf_moradia', 'reg_moradia', 'reg_adm_moradia'], 'sk_local_moradia', 's')}),
        dat AS ({_dense(['reg_atendimento', 'sigla_estab_atend'], 'sk_local_atendimento', 's')}),
        dp AS ({_dense(['faixa_etaria', 'idade_obito', 'sexo_obito', 'cor_obito'], 'sk_pessoa', 's')}),
        dc AS ({_dense(['cid_obito', 'desc_cid_obito', 'cid_capitulo'], 'sk_causa', 's')}),
        dto AS ({_dense(['tipo_obito', 'tipo_violencia'], 'sk_tipo_obito', 's')})
        SELECT dt.sk_tempo, dmo.sk_local_moradia, dat.sk_local_atendimento, dp.sk_pessoa, dc.sk_causa,
               dto.sk_tipo_obito, s.mes_obito, 1 AS quantidade_obitos
        FROM s JOIN dt ON {_on('dt', ['ano_obito', 'mes_obito'])}
               JOIN dmo ON {_on('dmo', ['uf_moradia', 'reg_moradia', 'reg_adm_moradia'])}
               JOIN dat ON {_on('dat', ['reg_atendimento', 'sigla_estab_atend'])}
               JOIN dp ON {_on('dp', ['faixa_etaria', 'idade_obito', 'sexo_obito', 'cor_obito'])}
               JOIN dc ON {_on('dc', ['cid_obito', 'desc_cid_obito', 'cid_capitulo'])}
               JOIN dto ON {_on('dto', ['tipo_obito', 'tipo_violencia'])}""",
}

ORACLES.update(AREA_ORACLES)


_RAIL_SILVER = """
  SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus AS st, o_orderpriority AS pr,
         CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN NULL
              ELSE CAST(o_orderdate AS DATE) END AS data_ocorrencia,
         CASE WHEN o_orderpriority <> '3-MEDIUM' THEN lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') || ':' ||
              lpad(CAST(o_custkey % 60 AS VARCHAR), 2, '0') END AS hora_ocorrencia,
         CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE CAST(o_orderkey % 5 AS INTEGER) END AS n_feridos,
         CAST(o_custkey % 3 AS INTEGER) AS n_obitos,
         o_orderstatus AS uf, 'M' || CAST(o_orderkey AS VARCHAR) AS municipio,
         CASE WHEN o_custkey % 2 = 0 THEN 'S' ELSE 'N' END AS perimetro_urbano,
         o_orderpriority AS gravidade, 'N' || CAST(o_custkey % 4 AS VARCHAR) AS natureza,
         'C' || CAST(o_orderkey % 6 AS VARCHAR) AS causa_direta,
         CASE WHEN o_orderkey % 2 = 0 THEN 'S' ELSE 'N' END AS interrupcao,
         'CONC' || CAST(o_custkey % 5 AS VARCHAR) AS concessionaria,
         coalesce(CASE WHEN NOT (o_orderstatus = 'F' AND o_orderpriority = '2-HIGH')
                       THEN 'L' || CAST(o_orderkey % 9 AS VARCHAR) END, 'nao_informada') AS linha,
         coalesce(CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'OF' END, 'nao_informada') AS outra_ferrovia,
         'nao_informada' AS pn,
         'E' || CAST(o_orderkey % 7 AS VARCHAR) AS estacao_anterior,
         coalesce(CASE WHEN o_orderstatus <> 'O' THEN 'E' || CAST(o_custkey % 7 AS VARCHAR) END,
                  'nao_informada') AS estacao_posterior,
         'SERV' || CAST(o_custkey % 3 AS VARCHAR) AS servico_transporte,
         CASE WHEN NOT (o_orderstatus = 'P' AND o_orderpriority = '2-HIGH')
              THEN 'MERC' || CAST(o_orderkey % 4 AS VARCHAR) END AS mercadoria,
         CAST(o_custkey % 4 AS VARCHAR) AS equipagem, 'P' || CAST(o_orderkey % 10 AS VARCHAR) AS prefixo
  FROM orders"""

_RAIL_DIMS = {
    "dt": (["data_ocorrencia", "data_hora_ocorrencia", "ano", "mes"], "sk_tempo"),
    "dl": (["uf", "municipio", "perimetro_urbano"], "sk_localizacao"),
    "da": (["gravidade", "natureza", "causa_direta", "interrupcao"], "sk_acidente"),
    "df": (["concessionaria", "linha", "estacao_anterior", "estacao_posterior", "outra_ferrovia", "pn"], "sk_ferrovia"),
    "dtr": (["servico_transporte", "mercadoria", "equipagem", "prefixo"], "sk_transporte"),
}

ORACLES["rail_gold_fact"] = f"""
    WITH b AS ({_RAIL_SILVER}),
    s AS (SELECT *, CASE WHEN hora_ocorrencia IS NOT NULL THEN
                   try_strptime(CAST(data_ocorrencia AS VARCHAR) || ' ' || hora_ocorrencia, '%Y-%m-%d %H:%M') END
                   AS data_hora_ocorrencia,
                 CAST(year(data_ocorrencia) AS INTEGER) AS ano, CAST(month(data_ocorrencia) AS INTEGER) AS mes FROM b),
    {", ".join(f"{a} AS ({_dense(cols, sk, 's')})" for a, (cols, sk) in _RAIL_DIMS.items())}
    SELECT dt.sk_tempo, dl.sk_localizacao, da.sk_acidente, df.sk_ferrovia, dtr.sk_transporte,
           s.n_feridos, s.n_obitos, 1 AS quantidade_acidentes, s.ano, s.mes
    FROM s JOIN dt ON s.data_ocorrencia = dt.data_ocorrencia AND s.ano = dt.ano AND s.mes = dt.mes
                  AND s.data_hora_ocorrencia IS NOT DISTINCT FROM dt.data_hora_ocorrencia
           JOIN dl ON {_on('dl', _RAIL_DIMS['dl'][0])} JOIN da ON {_on('da', _RAIL_DIMS['da'][0])}
           JOIN df ON {_on('df', _RAIL_DIMS['df'][0])} JOIN dtr ON {_on('dtr', _RAIL_DIMS['dtr'][0])}"""

# The revised extracts as the jobs store them: one SELECT for each, nothing filled but the line.
_RAIL_REVISED = """
  SELECT CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN NULL
              ELSE CAST(o_orderdate AS DATE) END AS data_ocorrencia,
         CASE WHEN o_orderpriority <> '3-MEDIUM' THEN lpad(CAST(o_orderkey % 3 AS VARCHAR), 2, '0') || ':00' END AS hora_ocorrencia,
         CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE CAST((o_orderkey + {r}) % 5 AS INTEGER) END AS n_feridos,
         CAST(o_custkey % 3 AS INTEGER) AS n_obitos, o_orderstatus AS uf, 'M' || CAST(o_orderkey % 50 AS VARCHAR) AS municipio,
         CASE WHEN o_custkey % 2 = 0 THEN 'S' ELSE 'N' END AS perimetro_urbano, o_orderpriority AS gravidade,
         'N' || CAST(o_custkey % 4 AS VARCHAR) AS natureza, 'C' || CAST((o_orderkey + {r}) % 6 AS VARCHAR) AS causa_direta,
         CASE WHEN o_orderkey % 2 = 0 THEN 'S' ELSE 'N' END AS interrupcao, 'CONC' || CAST(o_custkey % 5 AS VARCHAR) AS concessionaria,
         CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '2-HIGH' THEN 'nao_informada'
              ELSE 'L' || CAST(o_orderkey % 9 AS VARCHAR) END AS linha,
         CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'OF' END AS outra_ferrovia, CAST(NULL AS VARCHAR) AS pn,
         'E' || CAST(o_orderkey % 7 AS VARCHAR) AS estacao_anterior,
         CASE WHEN o_orderstatus <> 'O' THEN 'E' || CAST(o_custkey % 7 AS VARCHAR) END AS estacao_posterior,
         'SERV' || CAST(o_custkey % 3 AS VARCHAR) AS servico_transporte,
         CASE WHEN NOT (o_orderstatus = 'P' AND o_orderpriority = '2-HIGH') THEN 'MERC' || CAST(o_orderkey % 4 AS VARCHAR) END AS mercadoria,
         CAST(o_custkey % 4 AS VARCHAR) AS equipagem, 'P' || CAST(o_orderkey % 10 AS VARCHAR) AS prefixo,
         CAST(o_orderkey % 100 AS VARCHAR) AS quilometro_inicial
  FROM orders WHERE {where}"""
# The order of the stored columns outside the consolidation key, which chooses the survivor.
_RAIL_SURVIVOR = ["perimetro_urbano", "causa_direta", "data_ocorrencia", "equipagem", "estacao_anterior", "estacao_posterior",
                  "gravidade", "hora_ocorrencia", "interrupcao", "mercadoria", "n_feridos", "n_obitos", "outra_ferrovia", "pn",
                  "prefixo", "quilometro_inicial", "servico_transporte", "uf"]


def _rail_revised_fact(time: str) -> str:
    year = "year(o_orderdate)"
    extracts = (f"{year} <= 1997", f"{year} BETWEEN 1997 AND 1999", f"{year} >= 1998 OR o_orderdate IS NULL")
    union = " UNION ALL ".join(_RAIL_REVISED.format(r=k, where=w) for k, w in enumerate(extracts))
    filled = ("estacao_anterior", "estacao_posterior", "outra_ferrovia", "pn")
    return f"""
    WITH b AS (SELECT *, CASE WHEN hora_ocorrencia IS NOT NULL THEN
                   try_strptime(CAST(data_ocorrencia AS VARCHAR) || ' ' || hora_ocorrencia, '%Y-%m-%d %H:%M') END AS data_hora_ocorrencia,
                 CAST(year(data_ocorrencia) AS INTEGER) AS ano, CAST(month(data_ocorrencia) AS INTEGER) AS mes FROM ({union})),
    one AS (SELECT * FROM b QUALIFY row_number() OVER (
        PARTITION BY data_hora_ocorrencia, linha, municipio, concessionaria, natureza
        ORDER BY {", ".join(f"{c} NULLS FIRST" for c in [*_RAIL_SURVIVOR, "ano", "mes"])}) = 1),
    s AS (SELECT * REPLACE ({", ".join(f"coalesce({c}, 'nao_informada') AS {c}" for c in filled)}) FROM one),
    {", ".join(f"{a} AS ({_dense(cols, sk, 's')})" for a, (cols, sk) in _RAIL_DIMS.items())}
    SELECT dt.sk_tempo, dl.sk_localizacao, da.sk_acidente, df.sk_ferrovia, dtr.sk_transporte,
           s.n_feridos, s.n_obitos, 1 AS quantidade_acidentes, s.ano, s.mes
    FROM s JOIN dt ON s.data_ocorrencia = dt.data_ocorrencia AND s.ano = dt.ano AND s.mes = dt.mes {time}
           JOIN dl ON {_on('dl', _RAIL_DIMS['dl'][0])} JOIN da ON {_on('da', _RAIL_DIMS['da'][0])}
           JOIN df ON {_on('df', _RAIL_DIMS['df'][0])} JOIN dtr ON {_on('dtr', _RAIL_DIMS['dtr'][0])}"""


ORACLES["rail_overlaps_gold_fact"] = _rail_revised_fact("AND s.data_hora_ocorrencia IS NOT DISTINCT FROM dt.data_hora_ocorrencia")
ORACLES["rail_by_date_gold_fact"] = _rail_revised_fact("")

_BEDS_COUNTS = ["qnt_uti_adulto", "qnt_uti_coronariana", "qnt_leitos_uti", "qnt_uti_neonatal", "qnt_uti_pediatrico",
                "qnt_uti_queimado", "qnt_uti_sus_adulto", "qnt_uti_sus_coronariana", "qnt_uti_sus",
                "qnt_uti_sus_neonatal", "qnt_uti_sus_pediatrico", "qnt_uti_sus_queimado", "qnt_total_leitos",
                "qnt_total_leitos_sus"]
# Source order of the count columns (the order the extract lists them), mapped to silver names.
_BEDS_SOURCE_ORDER = ["qnt_uti_adulto", "qnt_uti_coronariana", "qnt_leitos_uti", "qnt_uti_neonatal",
                      "qnt_uti_pediatrico", "qnt_uti_queimado", "qnt_uti_sus_adulto", "qnt_uti_sus_coronariana",
                      "qnt_uti_sus", "qnt_uti_sus_neonatal", "qnt_uti_sus_pediatrico", "qnt_uti_sus_queimado",
                      "qnt_total_leitos", "qnt_total_leitos_sus"]


def _beds_count_expr(i: int, name: str) -> str:
    value = f"CAST((p_partkey * {i + 1}) % 50 AS INTEGER)"
    if i == 0:
        value = f"CASE WHEN p_size > 45 THEN NULL ELSE {value} END"
    return f"{value} AS {name}"


ORACLES["beds_gold_fact"] = f"""
    WITH s AS (
      SELECT 'T' || CAST(p_size % 5 AS VARCHAR) AS cd_tipo_uni,
             'ENTIDADE ' || CAST(p_partkey % 3 AS VARCHAR) AS desc_juri_hosp,
             'TIPO ' || CAST(p_size % 5 AS VARCHAR) AS desc_tipo_uni,
             'R' || CAST(p_partkey % 5 AS VARCHAR) AS regiao, p_brand AS municipio,
             'UF' || CAST(p_partkey % 7 AS VARCHAR) AS uf,
             CASE p_size % 6 WHEN 0 THEN 'M' WHEN 1 THEN 'E' WHEN 2 THEN 'D' WHEN 3 THEN 'S' WHEN 4 THEN 'Z' END
                 AS tipo_gestao,
             CASE p_size % 6 WHEN 0 THEN 'Municipal' WHEN 1 THEN 'Estadual' WHEN 2 THEN 'Dupla'
                  WHEN 3 THEN 'Sem Gestão' ELSE 'Não informado' END AS desc_tipo_gestao,
             {", ".join(_beds_count_expr(i, n) for i, n in enumerate(_BEDS_SOURCE_ORDER))}
      FROM part),
    dl AS ({_dense(['regiao', 'municipio', 'uf'], 'sk_localizacao', 's')}),
    dg AS ({_dense(['tipo_gestao', 'desc_tipo_gestao'], 'sk_gestao', 's')}),
    dn AS ({_dense(['desc_juri_hosp'], 'sk_natureza_juridica', 's')}),
    du AS ({_dense(['cd_tipo_uni', 'desc_tipo_uni'], 'sk_tipo_unidade', 's')})
    SELECT dl.sk_localizacao, dg.sk_gestao, dn.sk_natureza_juridica, du.sk_tipo_unidade,
           {", ".join("s." + c for c in _BEDS_COUNTS)}, s.regiao, s.uf
    FROM s JOIN dl ON {_on('dl', ['regiao', 'municipio', 'uf'])} JOIN dg ON {_on('dg', ['tipo_gestao', 'desc_tipo_gestao'])}
           JOIN dn ON {_on('dn', ['desc_juri_hosp'])} JOIN du ON {_on('du', ['cd_tipo_uni', 'desc_tipo_uni'])}"""

_FEATURES_ROW = """'P' || CAST(p_partkey AS VARCHAR) AS id_plano, {name} AS nm_plano, p_brand AS cd_plano,
         CASE p_size % 5 WHEN 0 THEN 'COM' WHEN 1 THEN 'SEM' WHEN 2 THEN 'NAO_APLICA' WHEN 3 THEN 'NAO_IDENTIFICADO'
              ELSE 'OUTROS' END AS obstetricia,
         p_type AS cobertura, 'F' || CAST(p_partkey % 3 AS VARCHAR) AS tipo_financiamento,
         CASE WHEN p_size % 13 <> 0 THEN CAST(p_partkey % 120 + 1 AS INTEGER) END AS registro_operadora, 'ATIVO' AS situacao_plano,
         CASE WHEN p_size % 7 <> 0 THEN 'Op ' || CAST(p_partkey % 120 + 1 AS VARCHAR) END AS razao_social,
         (p_size % 2 = 1) AS lg_odontologico"""

_FEATURE_ORDER = ["nm_plano", "cd_plano", "obstetricia", "cobertura", "tipo_financiamento", "registro_operadora",
                  "situacao_plano", "razao_social", "lg_odontologico"]
_PLAN_ORDER = ["nm_plano", "cd_plano", "obstetricia", "cobertura", "tipo_financiamento", "registro_operadora",
               "situacao_plano", "nt_tipo", "sk_operadora"]


def _nf(cols):
    return ", ".join(f"{c} NULLS FIRST" for c in cols)


ORACLES["health_plans_gold_fact"] = f"""
    WITH pr AS (
      SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS ano_mes,
             'P' || CAST(l_partkey AS VARCHAR) AS id_plano, l_returnflag AS nt_tipo,
             'N' || CAST(l_linenumber AS VARCHAR) AS cd_nota, CAST(l_suppkey % 11 + 1 AS INTEGER) AS cd_faixa_etaria,
             CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_extendedprice END AS vcm,
             l_discount AS pct_desp_ass, l_tax AS pct_carreg, l_quantity AS pct_carreg_admin,
             CAST(l_linenumber AS DOUBLE) AS pct_carreg_coml, l_tax AS pct_carreg_lucro,
             CAST(year(l_shipdate) AS INTEGER) AS ano, CAST(month(l_shipdate) AS INTEGER) AS mes
      FROM lineitem),
    s AS (SELECT *, CASE cd_faixa_etaria WHEN 1 THEN '0-18' WHEN 2 THEN '19-23' WHEN 3 THEN '24-28'
                     WHEN 4 THEN '29-33' WHEN 5 THEN '34-38' WHEN 6 THEN '39-43' WHEN 7 THEN '44-48'
                     WHEN 8 THEN '49-53' WHEN 9 THEN '54-58' WHEN 10 THEN '59+' END AS faixa_etaria_desc FROM pr),
    feat_raw AS (
      SELECT {_FEATURES_ROW.format(name="p_name")} FROM part
      UNION ALL
      SELECT {_FEATURES_ROW.format(name="p_name || ' (copia)'")} FROM part WHERE p_size <= 5),
    feat AS (SELECT * FROM feat_raw QUALIFY row_number() OVER (PARTITION BY id_plano ORDER BY {_nf(_FEATURE_ORDER)}) = 1),
    op AS (SELECT CASE WHEN s_suppkey % 29 <> 0 THEN s_suppkey END AS reg_ans FROM supplier),
    op_members AS (SELECT o.reg_ans, min(f.razao_social) AS razao_social
                   FROM op o LEFT JOIN feat f ON o.reg_ans = f.registro_operadora GROUP BY o.reg_ans),
    dim_op AS (SELECT *, row_number() OVER (ORDER BY {_nf(['reg_ans', 'razao_social'])}) AS sk_operadora FROM op_members),
    plan_members AS (
      SELECT f.id_plano, f.nm_plano, f.cd_plano, f.obstetricia, f.cobertura, f.tipo_financiamento,
             f.registro_operadora, f.situacao_plano, p.nt_tipo, d.sk_operadora
      FROM feat f LEFT JOIN (SELECT DISTINCT id_plano, nt_tipo FROM s) p ON f.id_plano = p.id_plano
                  LEFT JOIN dim_op d ON f.registro_operadora = d.reg_ans),
    plan_dedup AS (SELECT * FROM plan_members QUALIFY row_number() OVER (PARTITION BY id_plano ORDER BY {_nf(_PLAN_ORDER)}) = 1),
    dp AS (SELECT *, row_number() OVER (ORDER BY {_nf(['id_plano'] + _PLAN_ORDER)}) AS sk_plano FROM plan_dedup),
    dfx AS ({_dense(['cd_faixa_etaria', 'faixa_etaria_desc'], 'sk_faixa_etaria', 's')}),
    dt AS ({_dense(['ano_mes', 'ano', 'mes'], 'sk_tempo', 's')}),
    dn AS ({_dense(['cd_nota'], 'sk_nota', 's')})
    SELECT dp.sk_plano, dp.sk_operadora, dn.sk_nota, dfx.sk_faixa_etaria, dt.sk_tempo, s.vcm, s.pct_desp_ass,
           s.pct_carreg, s.pct_carreg_admin, s.pct_carreg_coml, s.pct_carreg_lucro, s.mes, s.ano
    FROM s JOIN dp ON s.id_plano = dp.id_plano JOIN dn ON s.cd_nota = dn.cd_nota
           JOIN dfx ON s.cd_faixa_etaria = dfx.cd_faixa_etaria JOIN dt ON s.ano_mes = dt.ano_mes"""
