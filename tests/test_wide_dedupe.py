"""De-duplication of wide rows: digests are grouped, single rows stay in place."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from terrace.operators import combine, dedupe
from terrace.sources import read_table


def extract(spark, n=3000):
    i = F.col("id")
    return spark.range(n).repartition(5).select(
        F.when(i % 10 != 0, F.concat(F.lit("key with a long text "), F.when(i % 4 == 0, i % 40).otherwise(i))).alias("k"),
        F.when(i % 9 != 0, i % 5).alias("j"), F.when(i % 7 != 0, i % 11).alias("o"), F.repeat(F.lit("w"), 50).alias("wide"), i.alias("v"))


def reference(df, keys, order, ascending):
    by = [F.col(c).asc_nulls_first() if ascending else F.col(c).desc_nulls_last() for c in order]
    rn = F.row_number().over(Window.partitionBy(*keys).orderBy(*by))
    return df.withColumn("rn", rn).where("rn = 1").drop("rn")


def same(a, b):
    assert sorted(map(tuple, a.select(*b.columns).collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


@pytest.mark.parametrize("ascending", [True, False])
@pytest.mark.parametrize("path", ["listed", "all", "direct"])
def test_survivors_equal_row_numbers(spark, monkeypatch, ascending, path):
    if path == "all":
        monkeypatch.setattr(combine, "DUPLICATE_KEYS_LIMIT", 0)
    df = extract(spark)
    for keys in (["k"], ["k", "j"], ["j"]):
        order = ["o", "v"] + [c for c in df.columns if c not in (*keys, "o", "v")]
        got = dedupe(df, keys, order_by=["o", "v"], ascending=ascending, late_rows=path != "direct")
        assert got.columns == keys + order
        same(got, reference(df, keys, order, ascending))


def test_null_keys_are_one_key_and_told_apart(spark):
    rows = [(None, "a", 1), ("a", None, 2), (None, "a", 3), (None, None, 4), ("", "a", 5), ("n", "v", 6)]
    df = spark.createDataFrame(rows, "x string, y string, v int")
    assert sorted(r.v for r in dedupe(df, ["x", "y"]).collect()) == [1, 2, 4, 5, 6]


def test_single_rows_are_neither_shuffled_nor_sorted(spark, tmp_path):
    extract(spark).write.parquet(str(tmp_path / "t"))
    df = read_table(spark, str(tmp_path / "t"))
    plan = dedupe(df, ["k"], order_by=["v"])._jdf.queryExecution().executedPlan().toString()
    alone, several = plan.split("SortAggregate", 1)
    assert "Union" in alone and "LeftAnti" in alone and "Exchange hash" not in alone and "Sort " not in alone
    assert "Sort [_k1#" in several and "Sort [k#" not in plan and "hashpartitioning(k#" not in plan


def test_keys_with_several_rows_are_found_by_a_hash_aggregate(spark, monkeypatch):
    seen = []
    store = combine.store_counted
    monkeypatch.setattr(combine, "store_counted", lambda df, name: (seen.append(df), store(df, name))[1])
    dedupe(extract(spark), ["k"])
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate(keys=[_k1#" in plan and "SortAggregate" not in plan


def test_empty_and_key_only_tables(spark):
    df = extract(spark)
    assert dedupe(df.limit(0), ["k"]).collect() == []
    same(dedupe(df.select("k"), ["k"]), df.select("k").distinct())
