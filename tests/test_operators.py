"""Operators: determinism, skew tolerance, key density, guards and NULL policies."""

import json

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from terrace.operators import (
    DimRef, add_surrogate_key, build_dimension, build_fact, consolidate, dedupe, describe_schema,
    explode_records, fill_nulls, first_non_null, keep_matching, preview, profile_filter, star_rollup,
    union_all_by_name,
)
from terrace.sources import read_json_envelope, write_json_envelope


def test_dedupe_is_deterministic_and_skew_safe(spark):
    # One hot key holds most rows; the pick must not depend on partitioning.
    rows = [("hot", i, f"v{i % 7}") for i in range(3000)] + [("cold", 5, "a"), ("cold", 2, "b")]
    df = spark.createDataFrame(rows, "k string, n int, v string")
    a = dedupe(df.repartition(13), ["k"], order_by=["n"]).orderBy("k").collect()
    b = dedupe(df.repartition(3), ["k"], order_by=["n"]).orderBy("k").collect()
    assert [tuple(r) for r in a] == [tuple(r) for r in b] == [("cold", 2, "b"), ("hot", 0, "v0")]
    plan = dedupe(df, ["k"], order_by=["n"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan  # combined map-side before the shuffle


def test_surrogate_key_dense_across_partitions(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7 % 5003).alias("k")).repartition(17)
    keyed = add_surrogate_key(df, ["k"], "sk")
    assert keyed.count() == 5000
    again = add_surrogate_key(df.repartition(3), ["k"], "sk")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, keyed.collect()))
    expected = df.withColumn("sk", F.row_number().over(Window.orderBy("k")).cast("long"))
    assert sorted(map(tuple, keyed.collect())) == sorted(map(tuple, expected.collect()))


def test_surrogate_key_nulls_first(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "k string")
    assert sorted(map(tuple, add_surrogate_key(df, ["k"], "sk").collect()), key=lambda r: r[1]) == [
        (None, 1), ("a", 2), ("b", 3)]


def test_fanout_guard_and_null_policy(spark):
    silver = spark.createDataFrame([("2024-01-01", "10:00", 1), ("2024-01-01", None, 2), (None, "09:00", 3)],
                                   "d string, h string, id int")
    dim = build_dimension(silver, ["d", "h"], "sk")
    with pytest.raises(ValueError):
        build_fact(silver, [DimRef(dim, on=["d"])])
    fan = build_fact(silver, [DimRef(dim, on=["d"], allow_fanout=True)], degenerate=["id"])
    assert fan.count() == 4  # the two 2024-01-01 rows each match both members of that day
    drop = build_fact(silver, [DimRef(dim)], degenerate=["id"])
    assert sorted(r.id for r in drop.collect()) == [1]
    match = build_fact(silver, [DimRef(dim, null_policy="match")], degenerate=["id"])
    assert sorted(r.id for r in match.collect()) == [1, 2, 3]
    per_col = build_fact(silver, [DimRef(dim, null_policy={"h": "match"})], degenerate=["id"])
    assert sorted(r.id for r in per_col.collect()) == [1, 2]


def test_build_dimensions_single_scan(spark):
    silver = spark.createDataFrame([("a", 1, None), ("a", 2, "x"), ("b", 1, "x"), (None, 1, None)],
                                   "p string, q int, r string")
    from terrace.operators import DimensionSpec, build_dimensions
    dims = build_dimensions(silver, {"p": DimensionSpec(("p",), "sk_p"),
                                     "qr": DimensionSpec(("q", "r"), "sk_qr"),
                                     "r": DimensionSpec(("r",), "sk_r", derived={"r_up": F.upper("r")})})
    assert sorted(map(tuple, dims["p"].df.collect()), key=lambda t: t[1]) == [(None, 1), ("a", 2), ("b", 3)]
    assert sorted(map(tuple, dims["qr"].df.collect()), key=lambda t: t[2]) == [(1, None, 1), (1, "x", 2), (2, "x", 3)]
    assert sorted(map(tuple, dims["r"].df.collect()), key=lambda t: t[2]) == [(None, None, 1), ("x", "X", 2)]
    assert dims["r"].attributes == ["r_up"] and dims["p"].rows == 3


def test_fact_keys_exist_in_dimension(spark):
    silver = spark.range(0, 2000).select((F.col("id") % 37).alias("a"), (F.col("id") % 5).alias("b"),
                                         F.lit(1).alias("m"))
    dim = build_dimension(silver, ["a", "b"], "sk")
    fact = build_fact(silver, [DimRef(dim)], measures=["m"])
    assert fact.count() == 2000
    assert fact.join(dim.df, "sk", "left_anti").count() == 0
    keys = [r.sk for r in dim.df.collect()]
    assert sorted(keys) == list(range(1, len(keys) + 1))


def test_star_rollup_small_and_large_paths(spark):
    silver = spark.range(0, 1000).select((F.col("id") % 4).alias("g"), (F.col("id") % 10).alias("h"),
                                         F.lit(1).alias("one"), F.col("id").alias("v"))
    dg = build_dimension(silver, ["g"], "sk_g")
    dh = build_dimension(silver, ["h"], "sk_h")
    fact = build_fact(silver, [DimRef(dg), DimRef(dh)], measures=["one", "v"])
    measures = {"n": ("sum", "one"), "total": ("sum", "v"), "k": ("count", "v"), "lo": ("min", "v"), "hi": ("max", "v"),
                "mean": ("avg", "v"), "dec": ("sum", F.col("v").cast("decimal(10,2)"))}
    small = star_rollup(fact, [dg, dh], ["g"], measures)
    large = star_rollup(fact, [dg, dh], ["g"], measures, broadcast_limit=0)
    expected = silver.groupBy("g").agg(F.sum("one").alias("n"), F.sum("v").alias("total"), F.count("v").alias("k"),
                                       F.min("v").alias("lo"), F.max("v").alias("hi"), F.avg("v").alias("mean"),
                                       F.sum(F.col("v").cast("decimal(10,2)")).alias("dec"))
    assert small.dtypes == large.dtypes == expected.dtypes
    for limit in (0, 10**9):
        with pytest.raises(ValueError):
            star_rollup(fact, [dg, dh], ["g"], {"x": ("median", "v")}, broadcast_limit=limit)
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, expected.collect()))
    assert sorted(map(tuple, large.collect())) == sorted(map(tuple, expected.collect()))


def test_union_requires_same_columns(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([("y", 2)], "b string, a int")
    assert union_all_by_name(a, b).count() == 2
    with pytest.raises(ValueError):
        union_all_by_name(a, spark.createDataFrame([(1,)], "a int"))


def test_consolidate_fill_then_dedupe(spark):
    old = spark.createDataFrame([(1, None, 5), (2, "L1", 6)], "id int, linha string, n int")
    new = spark.createDataFrame([(1, None, 5), (3, "L2", 7)], "id int, linha string, n int")
    out = consolidate([old, new], keys=["id", "linha"], fill={"linha": "nao_informada"})
    assert sorted(map(tuple, out.collect())) == [(1, "nao_informada", 5), (2, "L1", 6), (3, "L2", 7)]


def test_fill_nulls_only_compatible_types(spark):
    df = spark.createDataFrame([(None, None)], "n int, s string")
    assert tuple(fill_nulls(df, {"n": "x", "s": "y", "zz": 1}).first()) == (None, "y")
    assert tuple(fill_nulls(df, {"n": 0}).first()) == (0, None)


def test_keep_matching_and_profile(spark):
    df = spark.createDataFrame([("45",), ("<1",), (None,), ("45",)], "age string")
    assert sorted(r.age for r in keep_matching(df, "age", r"^\d+$").collect()) == ["45", "45"]
    prof = {r.value: (r.rows, r.kept) for r in profile_filter(df, "age", F.col("age").rlike(r"^\d+$")).collect()}
    assert prof == {"45": (2, 2), "<1": (1, 0), None: (1, 0)}
    ints = spark.createDataFrame([(7,), (None,)], "age int")
    assert keep_matching(ints, "age", r"^\d+$").count() == 1


def test_first_non_null_and_preview(spark):
    df = spark.createDataFrame([(1, 3, None), (1, 1, None), (1, 2, "b"), (2, 1, None)], "k int, o int, v string")
    got = sorted(map(tuple, first_non_null(df, ["k"], "v", order_by="o").collect()))
    assert got == [(1, "b"), (2, None)]
    tied = spark.createDataFrame([(1, 1, 2, "x"), (1, 1, 1, "z"), (1, 1, 2, "a")], "k int, o int, p int, v string")
    for n in (1, 2, 3):  # ties give the smallest value, whatever the order of the rows
        assert first_non_null(tied.repartition(n), ["k"], "v", order_by="o").collect()[0].v == "a"
    assert first_non_null(tied, ["k"], "v", order_by=["o", "p"]).collect()[0].v == "z"
    assert [r.o for r in preview(df, 2, order_by=["o"]).collect()] == [1, 1]


def test_describe_schema(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a bigint, b string")
    assert [tuple(r) for r in describe_schema(df).collect()] == [(1, "a", "bigint", 2), (2, "b", "string", 1)]


def test_json_envelope_roundtrip_and_guards(spark, tmp_path):
    df = spark.range(0, 45).select(F.col("id").alias("x"), (F.col("id") * 2).alias("y"))
    write_json_envelope(df, str(tmp_path / "env"), array_field="value", records_per_file=10)
    back = read_json_envelope(spark, str(tmp_path / "env"))
    assert sorted(map(tuple, back.select("x", "y").collect())) == sorted(map(tuple, df.collect()))
    two = tmp_path / "two.json"
    two.write_text(json.dumps({"a": [{"x": 1}], "b": [{"x": 2}]}))
    with pytest.raises(ValueError):
        read_json_envelope(spark, str(two))
    assert [r.x for r in read_json_envelope(spark, str(two), array_field="b").collect()] == [2]
    empty = tmp_path / "empty.json"
    empty.write_text(json.dumps({"value": [], "meta": 1}))
    arr = spark.read.option("multiLine", True).json(str(empty))
    assert explode_records(arr, "value").count() == 0


def test_enrich_matches_plain_left_join(spark):
    from terrace.operators.star import enrich
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "d")], "k int, v string")
    hot = [(1, i) for i in range(2000)] + [(2, 7), (2, 7), (9, 1)]
    right = spark.createDataFrame(hot, "rk int, w int")
    got = enrich(left, right, (["k"], ["rk"]), dedupe_other=False)
    want = left.join(right, left.k == right.rk, "left")
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    using = enrich(left, right.withColumnRenamed("rk", "k"), "k")
    want_u = left.join(right.withColumnRenamed("rk", "k").dropDuplicates(), "k", "left")
    assert using.columns == want_u.columns
    assert sorted(map(tuple, using.collect()), key=repr) == sorted(map(tuple, want_u.collect()), key=repr)
    fallback = enrich(left, right, (["k"], ["rk"]), dedupe_other=False, hot_key_rows=100)
    assert sorted(map(tuple, fallback.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_enrich_salts_hot_keys(spark):
    from terrace.operators.star import enrich
    left = spark.createDataFrame([(k, f"l{k}") for k in range(20)] + [(0, "dup"), (None, "n")], "k int, a string")
    right = spark.createDataFrame([(0, i) for i in range(900)] + [(1, 1), (5, 2), (5, 3), (None, 4)], "rk int, b int")
    want = left.join(right, left.k == right.rk, "left")
    got = enrich(left, right, (["k"], ["rk"]), dedupe_other=False, hot_key_rows=100)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert "_salt" in got._jdf.queryExecution().optimizedPlan().toString()
    r2 = right.withColumnRenamed("rk", "k")
    got_u = enrich(left, r2, ["k"], dedupe_other=False, hot_key_rows=100)
    want_u = left.join(r2, "k", "left")
    assert got_u.columns == want_u.columns
    assert sorted(map(tuple, got_u.collect()), key=repr) == sorted(map(tuple, want_u.collect()), key=repr)
    none_hot = enrich(left, r2, ["k"], dedupe_other=False, hot_key_rows=10_000)
    assert sorted(map(tuple, none_hot.collect()), key=repr) == sorted(map(tuple, want_u.collect()), key=repr)


def test_log_evidence(spark, caplog):
    import logging

    from terrace.operators.profile import log_evidence
    df = spark.createDataFrame([(2, None), (1, "x")], "a int, b string")
    with caplog.at_level(logging.INFO, logger="terrace.evidence"):
        log_evidence(df, "t", rows=1)
    text = caplog.text
    assert "1:a int (2 non-null)" in text and "2:b string (1 non-null)" in text
    assert "{'a': 1, 'b': 'x'}" in text and "'a': 2" not in text


def test_build_dimensions_packs_wide_stars_into_several_passes(spark, monkeypatch):
    import terrace.operators.star as star
    from terrace.operators import DimensionSpec, build_dimensions
    monkeypatch.setattr(star, "MAX_GROUPING_COLUMNS", 2)
    df = spark.createDataFrame([(1, "a", 2.0), (1, "b", 2.0)], "x int, y string, z double")
    dims = build_dimensions(df, {"x": DimensionSpec(("x",), "sk_x"), "y": DimensionSpec(("y",), "sk_y"),
                                 "z": DimensionSpec(("z",), "sk_z")})
    assert [tuple(r) for r in dims["y"].df.orderBy("sk_y").collect()] == [("a", 1), ("b", 2)]
    assert dims["x"].rows == 1 and dims["z"].rows == 1


def test_bare_top_level_array_is_read_as_records(spark, tmp_path):
    p = tmp_path / "bare.json"
    p.write_text(json.dumps([{"a": 1, "b": "x"}, {"a": 2, "b": "y"}]))
    got = read_json_envelope(spark, str(p))
    assert sorted(tuple(r) for r in got.select("a", "b").collect()) == [(1, "x"), (2, "y")]


def test_grouping_sets_with_the_same_columns_are_one(spark):
    from terrace.operators import DimensionSpec, build_dimensions
    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, "a")], "k int, g string")
    dims = build_dimensions(df, {"kg": DimensionSpec(("k", "g"), "sk1"), "gk": DimensionSpec(("g", "k"), "sk2")})
    assert dims["kg"].df.count() == 2 and dims["gk"].df.count() == 2


def test_attributes_must_depend_on_the_key(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a")], "k int, v string")
    with pytest.raises(ValueError, match="do not depend"):
        build_dimension(df, ["k"], "sk", attributes=["v"])
    assert build_dimension(df, ["k"], "sk", attributes=["v"], allow_fanout=True).df.count() == 3


def test_salts_follow_each_hot_key(spark):
    from terrace.operators.star import enrich
    left = spark.createDataFrame([(k, f"l{k}") for k in range(6)], "k int, a string")
    right = spark.createDataFrame([(k, i) for k, n in ((0, 900), (1, 150), (2, 40), (3, 1)) for i in range(n)], "k int, b int")
    got = enrich(left, right, ["k"], hot_key_rows=60)
    want = left.join(right, "k", "left")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_truncated_envelope_is_an_error_unless_allowed(spark, tmp_path):
    (tmp_path / "env").mkdir()
    (tmp_path / "env" / "a.json").write_text(json.dumps({"value": [{"x": 1}, {"x": 2}]}))
    (tmp_path / "env" / "b.json").write_text('{"value": [{"x": 3}, {"x"')
    with pytest.raises(Exception):
        read_json_envelope(spark, str(tmp_path / "env")).collect()
    kept = read_json_envelope(spark, str(tmp_path / "env"), array_field="value", mode="PERMISSIVE")
    assert sorted(r.x for r in kept.select("x").collect()) == [1, 2]
