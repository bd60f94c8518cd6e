"""Small document tables with every odd case the operators must handle."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(n, seed, vocabulary=400):
    rng = random.Random(seed)
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def odd_rows():
    """NULLs in each column, empty and blank texts, a very long text, ties, repeated rows."""
    long_text = " ".join(words(30_000, 1, 5000)) + "\n" + "x" * 5000
    base = " ".join(words(200, 2))
    near = base.split(" ")
    near[100] = "changed"
    rows = [
        (1, base, "en", "a", None), (2, base, None, "b", 5), (2, base, None, "b", 5), (3, " ".join(near), "en", "a", 1),
        (4, None, "en", None, None), (5, "", "en", "a", 0), (6, " \n\t ", "en", "b", 4), (7, "One", "en", None, 3),
        (8, "one", "en", "a", 3), (9, "two words", "en", "c", 9), (None, "no id here at all", "en", "a", 2),
        (None, base, "en", "a", 2), (10, long_text, "en", "c", 9), (11, long_text, "de", "c", 9),
        (12, "Hällo Wörld <|endoftext|> 日本 😀  two  spaces\r\n\n", "de", "é", 1),
        (13, "A\x0bB\x0cC D E", "de", "z", 1)]
    rng = random.Random(3)
    for k in range(14, 60):
        text = words(rng.randrange(3, 120), k)
        rows.append((k, " ".join(text), "en", rng.choice(["a", "b", "c", None]), len(text)))
        if k % 5 == 0:  # near copies
            for n in range(3):
                copy = list(text)
                copy[rng.randrange(len(copy))] = "other"
                rows.append((1000 + 10 * k + n, "\n".join(copy), "fr", "b", 1))
    return rows


def documents(spark, rows=None):
    return spark.createDataFrame(odd_rows() if rows is None else rows, SCHEMA)


def clashing(docs):
    """The same rows with columns more that are named like results and helper columns."""
    for name in ("n_shingles", "component_id", "k1", "K2", "size", "shard", "slot", "rank", "row", "score", "no",
                 "runs", "lines", "copies", "n_lines", "grp", "at", "part", "p", "block"):
        docs = docs.withColumn(name, F.lit("extra"))
    return docs


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.select(*columns).collect()), key=repr)
