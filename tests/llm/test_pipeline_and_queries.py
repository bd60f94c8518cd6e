"""The pipeline's stages in a row, and the registered queries against their SQL."""

import os
from collections import Counter, defaultdict

import duckdb
import pytest
from helpers import clashing, documents, odd_rows, words

import corpus_pipeline
from terrace.llm.oracles import ORACLES
from terrace.llm.queries import QUERIES
from tools.compare_oracle import TABLES, compare_one

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """A folder with documents and labels: odd rows, clean ones, junk, copies and shared runs."""
    rows = odd_rows()
    passage = "\n".join(" ".join(words(12, 7000 + k)) for k in range(6))
    labels = []
    for k in range(2000, 2300):
        text = "\n".join(" ".join(words(9, 10 * k + n, 3000)) for n in range(8))
        if k % 10 == 0:
            text = passage + "\n" + text
        if k % 6 == 0:
            text = "%%% ".join(text.upper().split()) + "###"
        rows.append((k, text, "en", f"s{k % 3}", len(text)))
        labels.append((k, int(k % 6 != 0), 0))
    folder = str(tmp_path_factory.mktemp("small"))
    clashing(documents(spark, rows)).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, rows


def test_pipeline_stages(spark, small):
    folder, rows = small
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "quality classifier" and len(corpus_pipeline.STAGES) == 5
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, seen[-1], folder)
        if stage is not corpus_pipeline.packing:
            assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        path = f"{folder}/{name.replace(' ', '_')}"
        out.write.mode("overwrite").parquet(path)
        seen.append(spark.read.parquet(path))
    ids = [{r.doc_id for r in s.select("doc_id").collect()} for s in seen]
    clean = {k for k in range(2000, 2300) if k % 6}
    junk = {k for k in range(2000, 2300) if k % 6 == 0}
    assert clean <= ids[1] and not junk & ids[1]
    assert clean <= ids[2]
    texts = {r.doc_id: r.text for r in seen[2].collect() if r.doc_id}
    first = min(k for k in clean if k % 10 == 0)
    passage = "\n".join(" ".join(words(12, 7000 + k)) for k in range(6))
    assert [k for k in clean if passage in texts[k]] == [first]
    assert len(ids[3]) < len(ids[2]) and clean <= ids[3]
    copies = Counter(r.doc_id for r in seen[4].collect())
    assert max(copies.values()) <= 2 and ids[4] <= ids[3]
    bins = defaultdict(int)
    for r in seen[5].collect():
        bins[r.sequence_id] += r.length
        assert copies[r.doc_id]
    assert max(bins.values()) <= 1024


def test_pipeline_run_equals_its_stages_and_takes_an_empty_table(spark, small, tmp_path):
    folder, _ = small
    stages = spark.read.parquet(f"{folder}/best-fit_packing")
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    ran = corpus_pipeline.run(spark, folder)
    assert sorted(map(repr, ran.select(*key).collect())) == sorted(map(repr, stages.select(*key).collect()))
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_registered_names():
    numbers = [int(n[2:].split("_")[0]) for n in QUERIES if n != "pipeline"]
    assert sorted(numbers) == list(range(1, 14)) and "pipeline" in QUERIES and set(ORACLES) <= set(QUERIES)


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    problems, n = compare_one(spark, con, QUERIES[name], ORACLES[name], SF)
    assert not problems and n, problems


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_runs(spark, name):
    out = QUERIES[name](spark, SF)
    assert out.count() >= 50 and len(out.columns) == len(set(out.columns))
