"""Dimensions of one source: one sort, one write, keys from what that write observed."""

from dataclasses import replace

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from terrace.operators import DimensionSpec, add_surrogate_key, build_dimension, build_dimensions
from terrace.operators.star import _passes


@pytest.fixture()
def conf(spark):
    saved = {}

    def use(**settings):
        for key, value in settings.items():
            key = "spark.sql." + key.replace("__", ".")
            saved.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield use
    for key, value in saved.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


def numbered(df, members, key, sk):
    order = Window.orderBy(*[F.col(c).asc_nulls_first() for c in key])
    return df.select(*members).distinct().withColumn(sk, F.row_number().over(order).cast("long"))


def same(a, b):
    assert sorted(map(tuple, a.select(*b.columns).collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


def source(spark, n=4000):
    i = F.col("id")
    return spark.range(n).repartition(5).select(
        F.when(i % 11 != 0, i % 70).alias("a"), F.concat(F.lit("t"), i % 13).alias("b"),
        F.when(i % 11 != 0, i % 70 * 3).alias("a3"), F.to_date(F.lit("2020-01-01")).alias("c"),
        F.when(i % 7 != 0, (i % 10).cast("double")).alias("d"), (i % 900).alias("e"))


SPECS = {
    "one": DimensionSpec(("a",), "sk_one", ("a3",)),
    "two": DimensionSpec(("b", "a"), "sk_two"),
    "three": DimensionSpec(("d", "b", "c"), "sk_three"),
    "four": DimensionSpec(("e", "d"), "sk_four", ("b",), allow_fanout=True),
    "five": DimensionSpec(("a3",), "sk_five", ("a",)),
    "six": DimensionSpec(("b", "a"), "sk_six"),
    "seven": DimensionSpec(("a", "b"), "sk_seven"),
}


@pytest.mark.parametrize("parts", ["coalesced", "many"])
def test_dimensions_of_one_source_equal_row_numbers(spark, conf, parts):
    if parts == "many":
        conf(adaptive__coalescePartitions__enabled="false", shuffle__partitions="23")
    df = source(spark)
    specs = {**SPECS, "three": replace(SPECS["three"], derived={"e2": F.col("d") * 2})}
    dims = build_dimensions(df, specs)
    assert list(dims) == list(specs)
    for name, spec in specs.items():
        want = numbered(df, spec.members, spec.key, spec.sk)
        if spec.derived:
            want = want.withColumns(dict(spec.derived))
        assert dims[name].df.columns == spec.members + list(spec.derived or []) + [spec.sk]
        same(dims[name].df, want)
        assert dims[name].rows == want.count() and dims[name].bytes > 0
        assert dims[name].natural_key == list(spec.natural_key)


def test_keys_use_offsets_of_several_partitions(spark, conf):
    conf(adaptive__coalescePartitions__enabled="false", shuffle__partitions="17")
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k"))
    keyed = add_surrogate_key(df, ["k"], "sk")
    assert "split" not in str(keyed._jdf.queryExecution().optimizedPlan())  # offsets are a constant of the plan
    same(keyed, numbered(df, ["k"], ["k"], "sk"))


def test_passes_are_split_only_where_they_must_be():
    passes = _passes(SPECS)
    # five has the columns of one, but another key; seven has the columns of two in another order.
    assert [list(p) for p in passes] == [["one", "two", "three", "four", "six"], ["five", "seven"]]


def jobs(spark, action):
    tracker = spark.sparkContext.statusTracker()
    before = max(tracker.getJobIdsForGroup(None), default=-1)
    result = action()
    return max(tracker.getJobIdsForGroup(None), default=-1) - before, result


def test_jobs_do_not_grow_with_the_number_of_dimensions(spark):
    df = source(spark).cache()
    df.count()
    one, dim = jobs(spark, lambda: build_dimension(df, ["b"], "sk"))
    assert one <= 5
    first = {k: SPECS[k] for k in ("one", "two", "three", "four", "six")}
    five, _ = jobs(spark, lambda: build_dimensions(df, first))
    assert five <= one
    read, _ = jobs(spark, lambda: dim.df.collect())
    assert read == 1
    df.unpersist()


def test_guard_is_part_of_the_same_write(spark):
    df = source(spark)
    for attributes in (("e",), ("b", "e")):
        with pytest.raises(ValueError, match="do not depend"):
            build_dimension(df, ["a"], "sk", attributes)
    with pytest.raises(ValueError, match="do not depend"):
        build_dimensions(df, {"ok": SPECS["one"], "bad": DimensionSpec(("d",), "sk", ("e",))})
    with pytest.raises(ValueError, match="do not depend"):
        build_dimension(spark.createDataFrame([(1, "x"), (1, None)], "k int, v string"), ["k"], "sk", ["v"], members_unique=True)


def test_empty_and_null_only_sources(spark):
    df = source(spark)
    for empty in (df.limit(0), df.where("a > 1000")):
        for dim in build_dimensions(empty, SPECS).values():
            assert dim.df.collect() == [] and dim.rows == 0
    nulls = spark.createDataFrame([(None, None), (None, None)], "k int, v string")
    assert [tuple(r) for r in build_dimension(nulls, ["k"], "sk", ["v"]).df.collect()] == [(None, None, 1)]
