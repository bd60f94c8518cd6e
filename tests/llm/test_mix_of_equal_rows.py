"""Equal rows spread over the blocks of the mix."""

from collections import Counter

from pyspark.sql import functions as F

from terrace.llm import cube_mix


def test_equal_rows_spread_over_blocks(spark):
    rows = [(1, "a", 9)] * 800 + [(None, None, 4)] * 800 + [(k, "a", k % 7) for k in range(2, 802)]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long")
    out = cube_mix.told_apart(df)
    keys = [c for c in out.columns if c != "source"]
    parts = Counter((r.source, r.b) for r in out.withColumn("b", cube_mix.block(keys, 0, F.lit(16))).collect())
    assert sum(parts.values()) == len(rows) and max(parts.values()) < 2.5 * 100
    first = out.where("again IS NULL").select("doc_id", "size", cube_mix.block(keys, 0, F.lit(16)).alias("b"),
                                              cube_mix.block(["doc_id", "size"], 0, F.lit(16)).alias("was")).collect()
    assert len(first) == 802 and all(r.b == r.was for r in first)


def test_mix_of_equal_rows_hits_its_target(spark, monkeypatch):
    monkeypatch.setattr(cube_mix.take, "__defaults__", (64, 5))
    rows = [(7, "x " * 5, "a")] * 900 + [(k, "y " * 3, "b") for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = [sorted(map(repr, cube_mix.mix(d).collect())) for d in (df, df.repartition(5))]
    assert out[0] == out[1] and len(out[0]) == 1200
    for r in cube_mix.mix(df).groupBy("target").agg(F.sum("taken").alias("t")).collect():
        assert abs(r.t - r.target) <= 5
