"""Steps of the rail job that grew too fast: writing envelopes, de-duplicating many repeated keys."""

import glob
import gzip
import json

import pytest
from pyspark.sql import functions as F

import queries_areas
from terrace.operators import combine, dedupe
from terrace.sources import read_json_envelope, write_json_envelope


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_envelopes_are_written_without_a_shuffle(spark, tmp_path):
    df = spark.range(0, 95, 1, 3).select(F.col("id").alias("x"), F.when(F.col("id") % 2 == 0, "á").alias("a b"), F.lit(None).cast("string").alias("n"))
    spark.sparkContext.setJobGroup("envelopes", "")
    write_json_envelope(df, str(tmp_path / "e"), array_field="dados", records_per_file=10, compression="gzip")
    spark.sparkContext.setJobGroup("other", "")
    tracker = spark.sparkContext.statusTracker()
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup("envelopes")]
    assert len(jobs) == 1 and len(jobs[0].stageIds) == 1
    held = []
    for f in glob.glob(str(tmp_path / "e" / "*.json.gz")):
        with gzip.open(f, "rt", encoding="utf-8") as fh:
            held.append(json.load(fh)["dados"])
    assert sorted(map(len, held)) == [1, 2, 2, *[10] * 9] and all(list(r) == ["x", "a b", "n"] for rows in held for r in rows)
    back = read_json_envelope(spark, str(tmp_path / "e"))
    assert back.dtypes == [("a b", "string"), ("n", "string"), ("x", "bigint")]
    assert sorted(map(repr, back.select(*df.columns).collect())) == sorted(map(repr, df.collect()))


@pytest.mark.parametrize("hot", [100_000, 20])
def test_rows_with_many_repeated_keys_are_sorted_once_after_the_shuffle(spark, tmp_path, monkeypatch, hot):
    monkeypatch.setattr(combine, "DUPLICATE_KEYS_LIMIT", 0)
    monkeypatch.setattr(combine, "HOT_DUPLICATES", hot)
    i = F.col("id")
    spark.range(0, 600, 1, 4).select(F.when(i % 3 == 0, "hot").otherwise((i % 150).cast("string")).alias("k"), (i % 7).cast("string").alias("v"),
                                     i.alias("w")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    got = dedupe(df, ["k"])
    want = df.groupBy("k").agg(F.min(F.struct("v", "w")).alias("m")).select("k", "m.v", "m.w")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    if hot > 600:
        before, after = plan_of(dedupe(df, ["k"])).split("Exchange hashpartitioning(_k1", 1)
        assert "Sort [_k1" in before and "Sort" not in after  # plans read from the result down to the scan


def test_envelopes_of_the_queries_are_packed_by_a_fast_codec(spark, tmp_path):
    rows = [(i, None if i % 3 else f"á{i}") for i in range(50)]
    df = spark.createDataFrame(rows, "x bigint, `a b` string").coalesce(1)
    write_json_envelope(df, str(tmp_path / "e"), array_field="dados", records_per_file=20, compression=queries_areas.ENVELOPE_CODEC)
    assert len(glob.glob(str(tmp_path / "e" / "*.json.lz4"))) == 3 and not glob.glob(str(tmp_path / "e" / "*.gz"))
    assert sorted(map(tuple, read_json_envelope(spark, str(tmp_path / "e")).select("x", "a b").collect())) == rows


@pytest.mark.parametrize("listed, hot", [(0, 100_000), (0, 20), (1 << 26, 100_000)])
def test_one_half_of_a_digest_is_shuffled_and_the_other_tells_keys_apart(spark, tmp_path, monkeypatch, listed, hot):
    monkeypatch.setattr(combine, "DUPLICATE_KEYS_LIMIT", listed)
    monkeypatch.setattr(combine, "HOT_DUPLICATES", hot)
    i = F.col("id")
    spark.range(0, 300, 1, 4).select(F.when(i % 7 != 0, (i % 110).cast("string")).alias("k"), (i % 2).alias("l"),
                                     (i % 5).cast("string").alias("v")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    want = df.groupBy("k", "l").agg(F.min("v")).collect()
    shuffled = plan_of(dedupe(df, ["k", "l"])).split("Exchange hashpartitioning(_k1", 1)[1] if (listed, hot) == (0, 100_000) else ""
    assert "_k2" not in shuffled
    digest = combine.key_digest
    monkeypatch.setattr(combine, "key_digest", lambda keys: [F.pmod(digest(keys)[0], F.lit(3)), digest(keys)[1]])
    got = dedupe(df, ["k", "l"]).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, map(tuple, want)))
