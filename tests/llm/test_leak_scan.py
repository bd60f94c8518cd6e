"""Benchmark decontamination against a brute-force search of every window."""

import random
import re

import pytest
from helpers import clashing, documents, odd_rows, words
from pyspark.sql import functions as F

from terrace.llm import leak_scan

ITEM = "item_id long, text string"


def word_spans(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return [(m.group(), m.start(), m.end()) for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)]


def brute(rows, items, size=10):
    windows = {}
    for item, text in items:
        ws = [w for w, _, _ in word_spans(text)]
        for k in range(max(len(ws) - size, 0) + 1 if ws else 0):
            windows.setdefault(tuple(ws[k:k + size]), set()).add(item)
    out = []
    for doc_id, text, *_ in rows:
        spans = word_spans(text)
        ws, hit, ids = [w for w, _, _ in spans], set(), set()
        for m in {len(w) for w in windows}:
            for k in range(len(ws) - m + 1):
                if tuple(ws[k:k + m]) in windows:
                    hit |= set(range(k, k + m))
                    ids |= windows[tuple(ws[k:k + m])] - {None}
        runs, clean, at = [], "", 0
        for k in sorted(hit):
            if runs and runs[-1][1] == k - 1:
                runs[-1][1] = k
            else:
                runs.append([k, k])
        cuts = [(spans[a][1], spans[b][2]) for a, b in runs]
        for s, e in cuts:
            clean, at = clean + text[at:s], e
        out.append((doc_id, len(ws), len(hit), sorted(map(str, ids)), cuts, None if text is None else clean + text[at:]))
    return sorted(out, key=repr)


def case():
    rng = random.Random(11)
    items = [(k, " ".join(words(rng.randrange(10, 40), 900 + k, 50))) for k in range(30)]
    items += [(30, "Short ITEM, é日本"), (31, "single"), (32, None), (33, ""), (34, " -- "), (5, items[6][1]), (None, "nobody's words"),
              (35, items[0][1]), (100, "w1 w2"), (36, "single")]
    rows = odd_rows()
    for k in range(200, 260):
        parts = [" ".join(words(rng.randrange(0, 30), k + 5, 60))]
        for _ in range(rng.randrange(0, 4)):
            ws = (items[rng.randrange(30)][1]).split(" ")
            a = rng.randrange(len(ws))
            passage = ws[a:a + rng.randrange(5, 25)]
            parts += [rng.choice([" ", "\n", " -- ", "_"]).join(passage).upper(), " ".join(words(rng.randrange(0, 9), k, 60))]
        rows.append((k, rng.choice([" ", ".\n", "é "]).join(parts), "en", "a", None))
    rows += [(300, "a SHORT item É日本 b short_item,é日本", "en", "a", 1), (301, "single", "en", "a", 1), (302, "singles Single.single", "en", "a", 1),
             (303, "Nobody's words " * 3, "en", "a", 1), (304, "w1 w2", None, None, None), (305, "w1", None, None, None), (304, "w1 w2", None, None, None)]
    return rows, items


def result(found, n_columns):
    def cuts(spans):
        return [(s["start"], s["end"]) for s in spans]

    return sorted(((r["doc_id"], r[n_columns], r[n_columns + 1], r[n_columns + 2], cuts(r[n_columns + 3]), r[n_columns + 4])
                   for r in found.collect()), key=repr)


@pytest.mark.parametrize("set_bytes", [leak_scan.SET_BYTES, 8_000])
def test_every_window_against_brute_force(spark, set_bytes):
    rows, items = case()
    docs = clashing(documents(spark, rows)).withColumn("Spans", F.lit(1)).withColumn("word_spans", F.lit(2))
    benchmark = spark.createDataFrame(items, ITEM).withColumn("window", F.lit("clash")).withColumn("w", F.lit(0))
    if set_bytes < leak_scan.SET_BYTES:
        assert len(leak_scan._parts(leak_scan.benchmark_windows(benchmark), set_bytes)) > leak_scan.PASSES_A_STAGE
    found = leak_scan.find(docs, benchmark, set_bytes=set_bytes)
    assert found.columns[:len(docs.columns)] == docs.columns
    assert found.columns[len(docs.columns):] == ["n_words", "n_hit", "items", "spans_", "clean_text"]
    got = result(found, len(docs.columns))
    assert got == brute(rows, items)
    assert sum(r[2] > 0 for r in got) > 20


def test_items_of_many_ids_and_hot_windows(spark, monkeypatch):
    monkeypatch.setattr(leak_scan, "ITEMS_A_ROW", 7)
    items = [(k, "the same short text") for k in range(40)] + [(99, "common")]
    rows = [(k, "common " * 50 + ("the same short text" if k % 2 else ""), "en", "a", 1) for k in range(20)]
    found = leak_scan.find(documents(spark, rows), spark.createDataFrame(items, ITEM), set_bytes=400)
    assert result(found, 5) == brute(rows, items)


def test_remove_spans_or_documents(spark):
    rows, items = case()
    docs, benchmark = documents(spark, rows), spark.createDataFrame(items, ITEM)
    want = brute(rows, items)
    cut = leak_scan.remove(docs, benchmark)
    assert cut.columns == docs.columns and cut.schema["text"].dataType == docs.schema["text"].dataType
    assert sorted(((r.doc_id, r.text) for r in cut.collect()), key=repr) == sorted(((r[0], r[5]) for r in want), key=repr)
    left = leak_scan.remove(docs, benchmark, what="documents")
    assert sorted((r.doc_id for r in left.collect()), key=repr) == sorted((r[0] for r in want if not r[2]), key=repr)
    with pytest.raises(ValueError):
        leak_scan.remove(docs, benchmark, what="words")


def test_empty_tables(spark):
    rows, items = case()
    none = spark.createDataFrame([], ITEM)
    assert leak_scan.find(documents(spark, []), spark.createDataFrame(items, ITEM)).collect() == []
    assert result(leak_scan.find(documents(spark, rows), none), 5) == brute(rows, [])


def test_hash_collisions_are_told_apart(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(leak_scan, "window_hashes", lambda hashes, size: hashes[:max(len(hashes) - size + 1, 0)] * 0)
    windows = leak_scan.WindowSet(["a b", "c d"], [["1"], ["2"]])
    found = leak_scan.scan(pa.array(["a b", "a c d", "b a d c", ""]), windows)
    assert [(r["spans"], r["items"]) for r in found] == [([(0, 1)], ["1"]), ([(1, 2)], ["2"]), ([], []), ([], [])]
