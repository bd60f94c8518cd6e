"""Steps of the health-plan job that grew too fast: typed landing, decimals, plan types, look-ups."""

from pyspark.sql import functions as F

from terrace.functions import parse_decimal_comma
from terrace.operators import DimRef, build_dimension, build_fact
from terrace.plans import health_plans
from terrace.sources import landing


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_broadcast_lookups_come_before_the_shuffled_ones(spark, tmp_path):
    i = F.col("id")
    spark.range(0, 300, 1, 2).select(F.concat(F.lit("a long key "), i).alias("big"), (i % 3).cast("string").alias("small"), i.alias("m")).write.parquet(str(tmp_path / "s"))
    s = spark.read.parquet(str(tmp_path / "s"))
    big, small = build_dimension(s, ["big"], "sk_big"), build_dimension(s, ["small"], "sk_small")
    fact = build_fact(s, [DimRef(big), DimRef(small)], measures=["m"], broadcast_limit=1000)
    assert fact.columns == ["sk_big", "sk_small", "m"]
    plan = fact._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join Inner" in line]
    assert len(joins) == 2 and "broadcast" not in joins[0] and "broadcast" in joins[1]  # the outer join is the shuffled one
    ranks = {k: n for n, k in enumerate(sorted(f"a long key {n}" for n in range(300)), 1)}
    assert sorted(map(tuple, fact.collect())) == sorted((ranks[f"a long key {n}"], n % 3 + 1, n) for n in range(300))


def test_decimal_texts_with_two_points_are_not_cast(spark):
    values = ["1,5", "1.234,56", "1,2,3", "1.2.3", ".", "..", ",", " 7,25 ", "-3", "1e3", "NaN", "inf", "", None, "x", "1..", ",5", "0x1p3"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    for to in ("double", "decimal(10,2)", "string"):
        got = [repr(r[0]) for r in df.select(parse_decimal_comma("v", to)).collect()]
        assert got == [repr(r[0]) for r in df.select(F.regexp_replace("v", ",", ".").try_cast(to)).collect()]
    assert "substring_index" in df.select(parse_decimal_comma("v"))._jdf.queryExecution().analyzed().toString()


def test_landing_checks_make_no_struct_for_each_value(spark, tmp_path, monkeypatch):
    (tmp_path / "x.csv").write_text("a;b;c;d\n1;N1;1,5;99999999999999999999\n2;Nan;2020-01-01, x;7\n;T10:00;12:00,5;\n")
    def refuse(*_):
        raise AssertionError("a struct for each value")
    monkeypatch.setattr(landing.F, "struct", refuse)
    got = landing.land_csv(spark, str(tmp_path / "x.csv"), ";")
    want = spark.read.option("header", True).option("delimiter", ";").option("inferSchema", True).csv(str(tmp_path / "x.csv"))
    assert got.dtypes == want.dtypes and sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_plan_types_are_reduced_by_a_hash_aggregate(spark):
    rows = [("p", "b"), ("p", None), ("q", "c"), ("q", "a"), (None, "z"), ("p", "b")]
    got = health_plans.plan_types_of(spark.createDataFrame(rows, "id_plano string, nt_tipo string"))
    assert sorted(map(tuple, got.collect()), key=repr) == [("p", None), ("q", "a"), (None, "z")]
    lowest = [line for line in plan_of(got).splitlines() if "Aggregate" in line][-1]
    assert "HashAggregate(keys=[id_plano" in lowest and "SortAggregate" not in lowest
