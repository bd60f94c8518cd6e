"""Property tests: operators agree with brute-force references on random data and random
partitionings (few examples each: every example runs Spark jobs)."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from terrace.operators import DimRef, add_surrogate_key, build_dimension, build_fact, dedupe, star_rollup
from terrace.operators.star import enrich

SETTINGS = settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

keys = st.one_of(st.none(), st.integers(min_value=0, max_value=6))
rows_strategy = st.lists(st.tuples(keys, st.integers(0, 3), st.text("abc", max_size=2)), min_size=1, max_size=60)


@SETTINGS
@given(rows=rows_strategy, parts=st.integers(1, 9))
def test_dedupe_equals_row_number_reference(spark, rows, parts):
    df = spark.createDataFrame(rows, "k int, o int, v string").repartition(parts)
    got = sorted(map(tuple, dedupe(df, ["k"], order_by=["o", "v"]).collect()), key=repr)
    w = Window.partitionBy("k").orderBy(F.col("o").asc_nulls_first(), F.col("v").asc_nulls_first())
    ref = df.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")
    assert got == sorted(map(tuple, ref.collect()), key=repr)


@SETTINGS
@given(rows=rows_strategy, parts=st.integers(1, 9), distributed=st.booleans())
def test_dense_keys_equal_row_number(spark, rows, parts, distributed):
    df = spark.createDataFrame(rows, "k int, o int, v string").select("k", "v").distinct().repartition(parts)
    keyed = add_surrogate_key(df.repartition(5) if distributed else df, ["k", "v"], "sk")
    ref = df.withColumn("sk", F.row_number().over(
        Window.orderBy(F.col("k").asc_nulls_first(), F.col("v").asc_nulls_first())).cast("long"))
    assert sorted(map(tuple, keyed.collect()), key=repr) == sorted(map(tuple, ref.collect()), key=repr)


@SETTINGS
@given(left=st.lists(st.tuples(keys, st.text("xy", max_size=2)), min_size=1, max_size=20),
       right=st.lists(st.tuples(keys, st.integers(0, 5)), max_size=40),
       hot_key_rows=st.sampled_from([1, 2, 10**6]))
def test_enrich_equals_left_join(spark, left, right, hot_key_rows):
    l_df = spark.createDataFrame(left, "k int, a string")
    r_df = spark.createDataFrame(right, "rk int, b int")
    got = enrich(l_df, r_df, (["k"], ["rk"]), dedupe_other=False, hot_key_rows=hot_key_rows)
    ref = l_df.join(r_df, l_df.k == r_df.rk, "left")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, ref.collect()), key=repr)


@SETTINGS
@given(rows=rows_strategy, limit=st.sampled_from([0, 64 * 1024 * 1024]))
def test_fact_and_rollup_preserve_totals(spark, rows, limit):
    df = spark.createDataFrame(rows, "k int, o int, v string")
    dk = build_dimension(df, ["k"], "sk_k")
    dv = build_dimension(df, ["v"], "sk_v")
    fact = build_fact(df, [DimRef(dk), DimRef(dv)], measures=["o"], broadcast_limit=limit)
    non_null = df.filter(F.col("k").isNotNull() & F.col("v").isNotNull())
    assert fact.count() == non_null.count()  # NULL key parts drop, nothing else does
    roll = star_rollup(fact, [dk, dv], ["k"], {"total": ("sum", "o"), "n": ("count", F.lit(1))}, broadcast_limit=limit)
    ref = non_null.groupBy("k").agg(F.sum("o").alias("total"), F.count(F.lit(1)).alias("n"))
    assert sorted(map(tuple, roll.collect()), key=repr) == sorted(map(tuple, ref.collect()), key=repr)
