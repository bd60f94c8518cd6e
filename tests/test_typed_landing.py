"""One-pass CSV typing against Spark's own inference, which parses twice."""

import random

import pytest
from pyspark.sql import functions as F

from terrace.sources import land_csv, read_csv, write_csv

POOLS = {
    "int": ["0", "5", "-3", "+7", "007", "2147483647", "-2147483648"],
    "long": ["2147483648", "-99999999999", "9223372036854775807"],
    "big": ["99999999999999999999", "-123456789012345678901234567890"],
    "huge": ["1" * 45],
    "double": ["1.5", "-0.25", "1e5", ".5", "2f", "3D", "NaN", "Inf", "-Inf", "Infinity", " 2.5", "7 ", "0x1p3"],
    "date": ["2020-01-01", "1999-12-31", "2020-02-29"],
    "time": ["2020-01-01 10:00:00", "2020-1-1", "2020-01", "2020-01-01T10:00:00Z", "2020-01-01 10:00:00.123", "2020-01-01T10:00:00+02:00"],
    "bool": ["true", "FALSE", "True"],
    "text": ["x", "1 Main Street", "31/02/2020", "2020-02-30", "2020-01-01x", "12:x", "1.2.3", "1,5", "1e", "--5", "tru", "e5", "NaN2", "_"],
    "none": [""],
}
MIXES = [("int",), ("int", "none"), ("none",), ("int", "long"), ("int", "double"), ("long", "double"), ("int", "big", "long"),
         ("big", "double"), ("huge", "int"), ("date",), ("date", "time"), ("time",), ("date", "int"), ("bool",), ("bool", "int"),
         ("bool", "none"), ("text",), ("text", "int"), ("text", "date"), ("double", "date"), ("time", "double"), ("time", "text"),
         ("date", "none", "time"), ("double", "none"), ("int", "text", "bool", "date")]


def write(tmp_path, columns, name="extract", files=3):
    folder = tmp_path / name
    folder.mkdir()
    rows = list(zip(*columns.values()))
    for f in range(files):
        text = "|".join(columns) + "\n" + "".join("|".join(r) + "\n" for r in rows[f::files])
        (folder / f"part{f}.csv").write_text(text, encoding="utf-8")
    return str(folder)


def inferred(spark, path):
    return spark.read.option("header", True).option("delimiter", "|").option("inferSchema", True).csv(path)


def rows(df):
    return sorted((tuple(map(str, r)) for r in df.collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_types_and_values_of_wide_mixes_equal_inference(spark, tmp_path, seed):
    rng = random.Random(seed)
    columns = {}
    for k, mix in enumerate(MIXES):
        values = [x for pool in mix for x in POOLS[pool]]
        drawn = [rng.choice(values) for _ in range(60)]
        drawn[:len(mix)] = [rng.choice(POOLS[p]) for p in mix]
        columns[f"c {k} {'+'.join(mix)}; ção.x"] = drawn
    columns["last"] = [str(k) for k in range(60)]  # no line is blank
    path = write(tmp_path, columns)
    got, want = land_csv(spark, path, "|"), inferred(spark, path)
    assert got.columns == want.columns == list(columns)
    assert {f.name: f.dataType.simpleString() for f in got.schema} == {f.name: f.dataType.simpleString() for f in want.schema}
    assert rows(got) == rows(want)


def test_every_single_value_is_typed_as_inference_does(spark, tmp_path):
    values = [v for pool in POOLS.values() for v in pool if v]
    path = write(tmp_path, {**{f"v{k}": [v] for k, v in enumerate(values)}, "last": ["1"]}, files=1)
    got, want = land_csv(spark, path, "|"), inferred(spark, path)
    different = {v: (a.dataType.simpleString(), b.dataType.simpleString())
                 for v, a, b in zip(values, got.schema, want.schema) if a.dataType != b.dataType}
    assert not different


def test_the_extract_is_parsed_once(spark, tmp_path):
    df = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") / 8).alias("v"), F.concat(F.lit("t"), "id").alias("t"))
    write_csv(df.repartition(4), str(tmp_path / "csv"))
    tracker = spark.sparkContext.statusTracker()
    before = max(tracker.getJobIdsForGroup(None))
    got = read_csv(spark, str(tmp_path / "csv"))
    assert max(tracker.getJobIdsForGroup(None)) - before == 2  # the header line of one file, then the landing write
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "FileScan csv" not in plan and "FileScan parquet" in plan
    assert [f.dataType.simpleString() for f in got.schema] == ["int", "double", "string"]
    assert rows(got) == rows(df)


def test_no_rows_and_short_rows(spark, tmp_path):
    (tmp_path / "e").mkdir()
    (tmp_path / "e" / "a.csv").write_text("a,b,c\n")
    empty = land_csv(spark, str(tmp_path / "e"))
    assert empty.collect() == [] and [f.dataType.simpleString() for f in empty.schema] == ["string"] * 3
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "a.csv").write_text('a,b,c\n1,"x, y",2.5\n2\n3,"line\n')
    assert [tuple(r) for r in land_csv(spark, str(tmp_path / "s")).collect()][:2] == [(1, "x, y", 2.5), (2, None, None)]
