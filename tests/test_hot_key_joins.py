"""Left joins with hot keys: found by a sketch, spread over salts, one join, few scans."""

import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.operators.star import enrich, hot_keys, join_small
from terrace.sources import read_table


def same(a, b):
    assert a.columns == b.columns
    assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


def sides(spark, n=20_000):
    i = F.col("id")
    key = F.when(i % 3 == 0, 7).when(i % 7 == 0, 11).when(i % 50 == 1, F.lit(None)).otherwise(i % 3000)
    right = spark.range(n).repartition(6).select(key.cast("int").alias("k"), F.concat(F.lit("x"), i % 2).alias("t"), i.alias("v"))
    left = spark.range(4000).select((F.col("id") % 3900).cast("int").alias("k"), F.concat(F.lit("x"), F.col("id") % 3).alias("t"), F.col("id").alias("w"))
    return left, right


def test_sketch_finds_every_hot_key(spark):
    _, right = sides(spark)
    assert sorted((r.a, r._hot) for r in hot_keys(right, ["k"], 1000, ["a"]).collect()) == [(7, 7), (11, 2)]
    both = hot_keys(right, ["k", "t"], 1000, ["a", "b"])
    assert both.schema["a"].dataType == T.IntegerType()
    assert {(r.a, r.b) for r in both.collect()} >= {(7, "x0"), (7, "x1")}
    assert hot_keys(right, ["k"], 100_000, ["a"]) is None and hot_keys(right.limit(0), ["k"], 1, ["a"]) is None
    assert hot_keys(right.select(F.lit(None).cast("int").alias("k")), ["k"], 1, ["a"]) is None


@pytest.mark.parametrize("kind", ["int", "string", "date", "decimal(9,2)", "double", "binary", "boolean"])
def test_keys_of_any_type(spark, kind):
    def cast(c):
        base = F.date_add(F.lit("2020-01-01").cast("date"), c) if kind == "date" else c % 2 == 0 if kind == "boolean" else c
        return base.cast("string").cast("binary") if kind == "binary" else base.cast(kind)

    right = spark.range(3000).select(cast(F.when(F.col("id") % 2 == 0, 4).otherwise(F.col("id") % 9).cast("int")).alias("rk"), F.col("id").alias("v"))
    left = spark.range(12).select(cast(F.col("id").cast("int")).alias("k"), F.col("id").alias("w"))
    assert hot_keys(right, ["rk"], 500, ["a"]).count() >= 1
    got = enrich(left, right, (["k"], ["rk"]), dedupe_other=False, hot_key_rows=500)
    same(got, left.join(right, left.k == right.rk, "left"))


def test_several_hot_keys_on_one_and_two_columns(spark):
    left, right = sides(spark)
    for rows in (300, 1000, 10**6):
        same(enrich(left, right.drop("t"), "k", dedupe_other=False, hot_key_rows=rows), left.join(right.drop("t"), "k", "left"))
        same(enrich(left, right, ["k", "t"], hot_key_rows=rows), left.join(right.dropDuplicates(), ["k", "t"], "left"))
    twice = right.unionAll(right).withColumn("v", F.col("v") % 5)
    same(enrich(left, twice, ["k", "t"], hot_key_rows=200), left.join(twice.dropDuplicates(), ["k", "t"], "left"))


def test_no_task_gets_a_whole_hot_key(spark):
    left, right = sides(spark, 60_000)
    saved = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = enrich(left.select("k", "w").limit(3000), right.select("k", "v"), "k", dedupe_other=False, hot_key_rows=2000)
        share = out.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count"), F.sum("count")).first()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", saved)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert share[0] < 0.34 * share[1]  # key 7 alone holds a third of the right rows and more of the result


def test_each_side_is_scanned_at_most_twice(spark, tmp_path):
    left, right = sides(spark)
    left.write.parquet(str(tmp_path / "left"))
    right.write.parquet(str(tmp_path / "right"))
    left, right = read_table(spark, str(tmp_path / "left")), read_table(spark, str(tmp_path / "right"))
    tracker = spark.sparkContext.statusTracker()
    for rows in (1000, 10**6):  # with salts and without
        before = max(tracker.getJobIdsForGroup(None))
        out = enrich(left, right, ["k", "t"], dedupe_other=False, hot_key_rows=rows)
        assert max(tracker.getJobIdsForGroup(None)) - before <= 3  # one sketch of the right keys (its map, groups, result)
        plan = out._jdf.queryExecution().executedPlan().toString()
        scans = re.findall(r"FileScan parquet [^\n]*?/(left|right)\]", plan)
        assert sorted(scans) == ["left", "right"], plan
        assert plan.count("LeftOuter") == (3 if rows == 1000 else 1)


def test_unique_other_needs_no_sketch(spark):
    left, right = sides(spark)
    one = right.groupBy("k").agg(F.max("v").alias("v")).cache()
    one.count()
    tracker = spark.sparkContext.statusTracker()
    before = max(tracker.getJobIdsForGroup(None))
    out = enrich(left, one, "k", dedupe_other=False, other_unique=True)
    assert max(tracker.getJobIdsForGroup(None)) == before
    same(out, left.join(one, "k", "left"))
    one.unpersist()


def test_keys_of_different_types_are_an_error(spark):
    left, right = sides(spark)
    text = right.select(F.col("k").cast("string").alias("rk"), "v")
    for join in (lambda: enrich(left, text, (["k"], ["rk"])), lambda: enrich(left, text.withColumnRenamed("rk", "k"), "k"),
                 lambda: join_small(left, text.withColumnRenamed("rk", "k"), ["k"])):
        with pytest.raises(TypeError, match="different types"):
            join()
    wide = right.select(F.col("k").cast("long").alias("rk"), "v")  # numbers of any width are fine
    same(enrich(left, wide, (["k"], ["rk"]), dedupe_other=False), left.join(wide, left.k == wide.rk, "left"))
