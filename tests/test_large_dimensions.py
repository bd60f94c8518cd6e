"""Facts and roll-ups over several dimensions that are too large to broadcast."""

import re

import pytest
from pyspark.sql import functions as F

from terrace.operators import DimRef, DimensionSpec, build_dimension, build_dimensions, build_fact, star_rollup


def silver(spark):
    i = F.col("id")
    return spark.range(6000).select(
        F.when(i % 17 != 0, i % 700).alias("a"), F.when(i % 5 != 0, F.concat(F.lit("b"), i % 300)).alias("b"),
        F.when(i % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("c"), i % 40)).alias("c"), (i % 4).alias("d"), i.alias("v"))


def dims(df):
    made = build_dimensions(df, {"a": DimensionSpec(("a",), "sk_a"), "bc": DimensionSpec(("b", "c"), "sk_bc"),
                                 "d": DimensionSpec(("d",), "sk_d")})
    return made["a"], made["bc"], made["d"]


def same(a, b):
    assert a.columns == b.columns
    assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


def wide_shuffles(df, column):
    """Exchanges between the scan that reads ``column`` and the result."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    found = []
    for k, line in enumerate(lines):
        if re.search(rf"(FileScan|Scan ).*\b{column}#", line):
            depth, count = len(re.match(r"[\s:+\-]*", line).group()), 0
            for up in reversed(lines[:k]):
                here = len(re.match(r"[\s:+\-]*", up).group())
                if here < depth:
                    depth = here
                    count += "Exchange" in up and "Broadcast" not in up
            found.append(count)
    return found


@pytest.mark.parametrize("policy", ["drop", {"b": "match"}, "match"])
def test_fact_of_large_dimensions_equals_the_broadcast_one(spark, policy):
    df = silver(spark)
    a, bc, d = dims(df)
    refs = [DimRef(d), DimRef(a, null_policy="drop" if isinstance(policy, dict) else policy), DimRef(bc, null_policy=policy)]
    want = build_fact(df, refs, measures=["v"], degenerate=["b"], constants={"one": 1})
    got = build_fact(df, refs, measures=["v"], degenerate=["b"], constants={"one": 1}, broadcast_limit=0)
    same(got, want)
    kept = df.where("a is not null and b is not null") if policy == "drop" else df.where("a is not null") if policy != "match" else df
    assert got.count() == kept.count()


def test_fanout_and_renamed_keys(spark):
    df = silver(spark)
    a, bc, d = dims(df)
    moved = df.withColumnRenamed("a", "first")
    refs = [DimRef(bc, on=["c"], allow_fanout=True), DimRef(a, fact_on=["first"], carry=["a"]), DimRef(d)]
    same(build_fact(moved, refs, measures=["v"], broadcast_limit=0), build_fact(moved, refs, measures=["v"]))


def test_look_ups_that_need_each_other_stay_a_chain(spark):
    df = silver(spark)
    a, _, _ = dims(df)
    second = build_dimension(a.df.select((F.col("sk_a") % 9).alias("nine"), "sk_a"), ["sk_a"], "sk_two", ["nine"])
    refs = [DimRef(a), DimRef(second, on=["sk_a"])]
    same(build_fact(df, refs, measures=["v"], broadcast_limit=0), build_fact(df, refs, measures=["v"]))


def test_one_shuffle_of_the_fact(spark, tmp_path):
    silver(spark).write.parquet(str(tmp_path / "silver"))
    df = spark.read.parquet(str(tmp_path / "silver"))
    refs = [DimRef(x) for x in dims(df)]
    saved = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", None)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = build_fact(df, refs, measures=["v"], broadcast_limit=0)
        assert wide_shuffles(out, "v") == [1]
        chain = build_fact(df, refs[:1], measures=["v"], broadcast_limit=0)
        assert wide_shuffles(chain, "v") == [1]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold") if saved is None else spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)


def test_roll_up_over_small_and_large_dimensions(spark):
    df = silver(spark)
    a, bc, d = dims(df)
    fact = build_fact(df, [DimRef(a), DimRef(bc), DimRef(d)], measures=["v"])
    measures = {"n": ("count", "v"), "total": ("sum", "v"), "least": ("min", "v"), "mean": ("avg", "v")}
    by = ["c", "d"]
    want = star_rollup(fact, [a, bc, d], by, measures)
    limits = sorted({0, d.bytes, max(d.bytes, a.bytes), bc.bytes})
    for limit in limits:
        same(star_rollup(fact, [a, bc, d], by, measures, broadcast_limit=limit), want)
    plain = df.where("a is not null and b is not null").groupBy(*by).agg(F.count("v").alias("n"), F.sum("v").alias("total"))
    same(want.select("c", "d", "n", "total"), plain)
    # Reduced to the small dimension's attribute and the large ones' keys before the shuffled joins.
    text = star_rollup(fact, [a, bc, d], by, measures, broadcast_limit=d.bytes)._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Aggregate \[d#\d+L, sk_a#\d+L, sk_bc#\d+L\]", text)
