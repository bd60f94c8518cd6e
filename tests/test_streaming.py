"""Incremental landing ingest: each file exactly once across runs; damage listed, not fatal."""

import json
import os
import shutil

from pyspark.sql import types as T

from terrace.streaming import ingest_landing, quarantine_of, read_landed, report_of

RECORD = T.StructType([T.StructField("DESC_ano", T.StringType()), T.StructField("DESC_deno", T.StringType())])


def names(df):
    return {os.path.basename(r.file): (r.loaded, r.quarantined) for r in df.collect()}


def test_csv_drops_are_loaded_once(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType())])
    landing, target, ckpt = tmp_path / "landing", str(tmp_path / "bronze"), str(tmp_path / "ckpt")
    landing.mkdir()
    (landing / "a.csv").write_text("id;name\n1;x\n2;y\n")
    ingest_landing(spark, str(landing), target, schema, delimiter=";", checkpoint=ckpt)
    assert read_landed(spark, target).count() == 2
    ingest_landing(spark, str(landing), target, schema, delimiter=";", checkpoint=ckpt)  # nothing new
    assert read_landed(spark, target).count() == 2
    (landing / "b.csv").write_text("id;name\n3;z\nnot a number;w\n4;\n")
    ingest_landing(spark, str(landing), target, schema, delimiter=";", checkpoint=ckpt)
    back = read_landed(spark, target, schema)
    assert back.columns == ["id", "name"]
    assert sorted((r.id, r.name) for r in back.collect()) == [(1, "x"), (2, "y"), (3, "z"), (4, None)]
    assert [r.content for r in read_landed(spark, quarantine_of(target)).collect()] == ["not a number;w"]
    assert names(read_landed(spark, report_of(target))) == {"a.csv": (2, 0), "b.csv": (2, 1)}


def test_json_envelopes_stream(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "e1.json").write_text(json.dumps({"value": [{"DESC_ano": "2020", "DESC_deno": "1"},
                                                          {"DESC_ano": "2021", "DESC_deno": "2"}]}))
    (landing / "e2.json").write_text(json.dumps({"value": []}))
    target = str(tmp_path / "bronze")
    ingest_landing(spark, str(landing), target, RECORD, fmt="json_envelope", checkpoint=str(tmp_path / "ck"))
    assert sorted(tuple(r) for r in read_landed(spark, target).collect()) == [("2020", "1"), ("2021", "2")]
    assert names(read_landed(spark, report_of(target))) == {"e1.json": (2, 0), "e2.json": (0, 0)}


def landing_of_ten(tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    for k in range(10):
        text = json.dumps({"value": [{"DESC_ano": str(2000 + k), "DESC_deno": str(n)} for n in range(5)]})
        (landing / f"e{k}.json").write_text(text[:60] if k == 4 else text)
    return str(landing)


def test_one_cut_off_envelope_in_ten_is_listed_and_nine_load(spark, tmp_path):
    target = str(tmp_path / "bronze")
    ingest_landing(spark, landing_of_ten(tmp_path), target, RECORD, fmt="json_envelope", checkpoint=str(tmp_path / "ck"),
                   max_files_per_trigger=3)
    got = read_landed(spark, target, with_batch=True)
    assert got.count() == 45 and got.select("ingest_batch").distinct().count() == 4
    assert {r.DESC_ano for r in got.collect()} == {str(2000 + k) for k in range(10) if k != 4}
    bad = read_landed(spark, quarantine_of(target)).collect()
    assert [os.path.basename(r.file) for r in bad] == ["e4.json"]
    assert names(read_landed(spark, report_of(target))) == {f"e{k}.json": (0, 1) if k == 4 else (5, 0) for k in range(10)}


def test_an_envelope_without_its_array_is_listed(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "a.json").write_text(json.dumps({"other": []}))
    target = str(tmp_path / "bronze")
    ingest_landing(spark, str(landing), target, RECORD, fmt="json_envelope", checkpoint=str(tmp_path / "ck"))
    assert [r.content for r in read_landed(spark, quarantine_of(target)).collect()] == ["no array value"]


def test_a_killed_batch_reruns_without_doubles(spark, tmp_path):
    landing, target, ckpt = landing_of_ten(tmp_path), str(tmp_path / "bronze"), str(tmp_path / "ck")
    ingest_landing(spark, landing, target, RECORD, fmt="json_envelope", checkpoint=ckpt, max_files_per_trigger=4)
    before = sorted(map(tuple, read_landed(spark, target).collect()))
    # As if the run had died after the last batch was written (whole or in part), before its commit.
    last = max(int(f) for f in os.listdir(f"{ckpt}/commits") if f.isdigit())
    for f in (f"{ckpt}/commits/{last}", f"{ckpt}/commits/.{last}.crc"):
        if os.path.exists(f):
            os.remove(f)
    folder = next(f"{target}/{d}" for d in os.listdir(target) if d.endswith(f".{last}"))
    shutil.rmtree(f"{report_of(target)}/{os.path.basename(folder)}")
    ingest_landing(spark, landing, target, RECORD, fmt="json_envelope", checkpoint=ckpt, max_files_per_trigger=4)
    assert sorted(map(tuple, read_landed(spark, target).collect())) == before
    assert len(names(read_landed(spark, report_of(target)))) == 10 == read_landed(spark, report_of(target)).count()


def test_a_second_stream_into_the_table_replaces_nothing(spark, tmp_path):
    target = str(tmp_path / "bronze")
    for k in range(2):
        landing = tmp_path / f"landing{k}"
        landing.mkdir()
        (landing / "a.json").write_text(json.dumps({"value": [{"DESC_ano": str(k), "DESC_deno": "1"}]}))
        ingest_landing(spark, str(landing), target, RECORD, fmt="json_envelope", checkpoint=str(tmp_path / f"ck{k}"),
                       partition_by=("DESC_deno",))
    assert sorted(r.DESC_ano for r in read_landed(spark, target).collect()) == ["0", "1"]
    assert os.path.isdir(next(f"{target}/{d}/DESC_deno=1" for d in os.listdir(target) if d.startswith("ingest_batch=")))
