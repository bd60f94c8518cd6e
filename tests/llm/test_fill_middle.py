"""Fill-in-middle: the Arrow pipeline against a plain loop, and the way back."""

import hashlib
import re

import pyarrow as pa
import pytest
from helpers import clashing, documents, odd_rows
from pyspark.sql import functions as F

from terrace.llm import fill_middle

MARKED = [(3000, "before <P> after", "en", "a", 1), (3001, "<S>", "en", "a", 1), (3002, "a <M>", "en", "a", 1),
          (3003, "almost <P < S> <M", "en", "a", 1), (3004, "\x00\x01é\U0001f600<", "en", "a", 1), (3005, "<", "en", "a", 1)]


def brute(doc_id, text):
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k:8 * k + 8], 16) for k in range(4))
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", text, None, None
    if h4 % 100 < 20:
        return doc_id, n, "spm", f"<S>{suffix}<P>{prefix}<M>{middle}", len(prefix), len(middle)
    return doc_id, n, "psm", f"<P>{prefix}<S>{suffix}<M>{middle}", len(prefix), len(middle)


def result(docs):
    out = fill_middle.transform(docs)
    names = out.columns[len(docs.columns):]
    rows = [(r["doc_id"], *(r[len(docs.columns) + k] for k in (0, 1, 2, 3, 4))) for r in out.collect()]
    return names, sorted(rows, key=repr)


@pytest.mark.parametrize("clash", [False, True])
def test_every_text_against_a_plain_loop(spark, clash):
    rows = odd_rows() + MARKED + [(4000 + k, "Words, and 12 more.\n", None, None, None) for k in range(40)]
    docs = documents(spark, rows)
    if clash:
        docs = clashing(docs).withColumns({c: F.lit("x") for c in ("n", "FORM", "output", "h1_", "prefix_chars")})
    names, got = result(docs)
    assert got == sorted((brute(r[0], r[1]) for r in rows), key=repr)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    assert names == (["n_", "form_", "output_", "prefix_chars_", "middle_chars"] if clash
                     else ["n", "form", "output", "prefix_chars", "middle_chars"])


def test_other_columns_stay_and_texts_come_back(spark):
    docs = documents(spark, odd_rows() + MARKED)
    out = fill_middle.transform(docs)
    assert out.columns[:5] == docs.columns and out.schema.fields[:5] == docs.schema.fields
    back = out.withColumn("back", fill_middle.restored(F.col("output"), F.col("form")))
    assert back.where(~F.coalesce("text", F.lit("")).eqNullSafe(F.col("back"))).count() == 0
    assert sorted(map(repr, out.select(docs.columns).collect())) == sorted(map(repr, docs.collect()))


def test_shares_are_parameters(spark):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.lit("some text here").alias("text"))
    forms = {r.form for r in fill_middle.transform(docs, plain_above=100, spm_below=0).collect()}
    assert forms == {"psm"}
    assert {r.form for r in fill_middle.transform(docs, plain_above=0).collect()} == {"plain"}


def test_empty_table(spark):
    assert fill_middle.transform(documents(spark, [])).collect() == []


def test_slices_change_nothing(monkeypatch):
    texts = pa.array(["one two", "", "x" * 50, "three  four!", "é日本 a"] * 7)
    monkeypatch.setattr(fill_middle, "SLICE_BYTES", 10)
    cuts = list(fill_middle._slices(texts))
    assert sum(n for _, n in cuts) == len(texts) and len(cuts) > 10
    units = [fill_middle.units(texts.slice(s, n)).to_pylist() for s, n in cuts]
    assert [u for part in units for u in part] == fill_middle.units(texts).to_pylist()
    assert [b"".join(u).decode() for part in units for u in part] == texts.to_pylist()
