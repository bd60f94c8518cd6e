"""Cleaning helpers: tolerant under ANSI mode, exact on the documented edge cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from terrace.functions import (
    combine_date_time, lower_columns, normalize_text, parse_date, parse_decimal_comma, recode,
    recode_numeric_text, rename, safe_column_name, safe_columns, try_cast,
)


def one(df):
    return [tuple(r) for r in df.collect()]


def test_ansi_mode_is_on(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"


def test_try_cast_int_double_boolean(spark):
    df = spark.createDataFrame([(" 7 ",), ("7.9",), ("12a",), (None,)], "v string")
    got = one(df.select(try_cast("v", "int"), try_cast("v", "double")))
    assert got == [(7, 7.0), (None, 7.9), (None, None), (None, None)]
    b = spark.createDataFrame([("y",), ("1",), ("S",), ("SIM",), ("false",)], "v string")
    assert [r[0] for r in b.select(try_cast("v", "boolean")).collect()] == [True, True, None, None, False]


def test_parse_date_never_throws(spark):
    df = spark.createDataFrame([("01/03/2024",), ("31/02/2020",), ("2024-03-01",), ("xx",)], "v string")
    got = [r[0] for r in df.select(parse_date("v")).collect()]
    assert got == [dt.date(2024, 3, 1), None, None, None]


def test_parse_datetime_discards_time(spark):
    df = spark.createDataFrame([("05/03/2024 10:30",), ("5/3/24",)], "v string")
    assert [r[0] for r in df.select(parse_date("v", "dd/MM/yyyy HH:mm")).collect()] == [dt.date(2024, 3, 5), None]


def test_combine_date_time_guarded(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 2), "14:30"), (dt.date(2024, 1, 2), None),
                                (None, "14:30"), (dt.date(2024, 1, 2), "99:99")], "d date, h string")
    got = [r[0] for r in df.select(combine_date_time("d", "h").cast("string")).collect()]
    assert got == ["2024-01-02 14:30:00", None, None, None]


def test_normalize_text_keeps_capital_accents(spark):
    df = spark.createDataFrame([("São João",), ("Águas",), (None,)], "v string")
    assert [r[0] for r in df.select(normalize_text("v")).collect()] == ["SAO JOAO", "ÁGUAS", None]
    assert [r[0] for r in df.select(normalize_text("v", fold_upper=True)).collect()] == ["SAO JOAO", "AGUAS", None]


def test_decimal_comma(spark):
    df = spark.createDataFrame([("1234,56",), ("1.234,56",), ("12",), (None,)], "v string")
    assert [r[0] for r in df.select(parse_decimal_comma("v")).collect()] == [1234.56, None, 12.0, None]


def test_recode_with_and_without_default(spark):
    df = spark.createDataFrame([("M",), ("Z",), (None,)], "v string")
    got = [r[0] for r in df.select(recode("v", {"M": "Municipal"}, "Não informado")).collect()]
    assert got == ["Municipal", "Não informado", "Não informado"]
    got = [r[0] for r in df.select(recode("v", {"M": "Municipal"})).collect()]
    assert got == ["Municipal", None, None]
    codes = spark.createDataFrame([("1",), ("11",), ("x",)], "v string")
    assert [r[0] for r in codes.select(recode_numeric_text("v", {1: "0-18"})).collect()] == ["0-18", None, None]


def test_rename_case_insensitive_and_missing(spark):
    df = spark.createDataFrame([(1, 2)], "DESC_ano int, b int")
    assert rename(df, {"desc_ANO": "ano", "missing": "x"}).columns == ["ano", "b"]


def test_lower_and_safe_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`Perímetro Urbano` int, `Nome, País` int, `Região-Chave` int")
    assert safe_columns(df).columns == ["perimetro_urbano", "nome_pais", "regiao_chave"]
    assert safe_column_name("Operadora Medico-Hospitalar") == "operadora_medico_hospitalar"
    assert lower_columns(df).columns == ["perímetro urbano", "nome, país", "região-chave"]
    clash = spark.createDataFrame([(1, 2)], "Ab int, aB int")
    with pytest.raises(ValueError):
        lower_columns(clash)


def test_rename_rejects_two_spellings_in_one_extract(spark):
    df = spark.createDataFrame([(1, 2)], "`Perímetro_Urbano` int, `Perímetro Urbano` int")
    with pytest.raises(ValueError):
        rename(df, {"Perímetro_Urbano": "perimetro_urbano", "Perímetro Urbano": "perimetro_urbano"})
    one = spark.createDataFrame([(1,)], "`Perímetro Urbano` int")
    assert rename(one, {"Perímetro_Urbano": "perimetro_urbano", "Perímetro Urbano": "perimetro_urbano"}).columns == [
        "perimetro_urbano"]


def test_guarded_casts_keep_the_meaning_of_a_cast(spark):
    texts = [" 7 ", "+7", "-7", "7.9", "", " ", "abc", "2147483648", "-2147483648", "\t7\n", "7a", "1e3", None, "T", "yes", " N ", "0", "maybe", "1"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    for kind in ("int", "bigint", "boolean", "double"):
        rows = df.select("s", try_cast("s", kind).alias("a"), F.col("s").try_cast(kind).alias("b")).collect()
        assert [r.a for r in rows] == [r.b for r in rows], kind
    assert spark.createDataFrame([(7.9,)], "x double").select(try_cast("x", "int")).first()[0] == 7


def test_rename_sees_names_that_differ_by_case(spark):
    df = spark.createDataFrame([(1, 2)], "a int, B int")
    with pytest.raises(ValueError):
        rename(df, {"a": "b"})
