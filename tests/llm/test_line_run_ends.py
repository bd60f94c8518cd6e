"""Line dedup deletes repeated runs to their end, against all runs of enough words."""

import pytest
from helpers import SCHEMA, clashing, odd_rows, words
from test_near_duplicates import line_rows

from terrace.llm import line_suffix


def brute(rows, min_words):
    """Later copies of every run of lines with at least ``min_words`` words, of any length."""
    docs = {(i is None, i or 0, t) for i, t, *_ in rows if t is not None}
    seen, gone = set(), {}
    for none, doc_id, text in sorted(docs, key=lambda d: d[:2]):
        lines = [(k, x) for k, x in enumerate(text.split("\n")) if x.encode().split()]
        cut = set()
        for a in range(len(lines)):
            for b in range(a, len(lines)):
                run = tuple(x for _, x in lines[a:b + 1])
                if sum(len(x.encode().split()) for x in run) >= min_words:
                    if run in seen:
                        cut |= set(range(lines[a][0], lines[b][0] + 1))
                    seen.add(run)
        gone[(none, doc_id, text)] = cut
    out = []
    for i, t, *_ in rows:
        cut, lines = (set(), []) if t is None else (gone[(i is None, i or 0, t)], t.split("\n"))
        out.append((i, None if t is None else "\n".join(x for k, x in enumerate(lines) if k not in cut), len(lines), len(cut)))
    return sorted(out, key=repr)


def result(spark, rows, min_words):
    out = line_suffix.delete_repeats(clashing(spark.createDataFrame(rows, SCHEMA)), min_words)
    return sorted(((r["doc_id"], r["text"], r[-2], r[-1]) for r in out.collect()), key=repr)


@pytest.mark.parametrize("sizes", [(60, 8), (30, 30, 10), (8, 60), (10, 30, 30), (49, 1, 1)])
def test_runs_go_to_their_end(spark, sizes):
    run = [" ".join(words(n, 300 + k, 10_000)) for k, n in enumerate(sizes)]
    rows = [(k, "\n".join([f"before {k}", *run, f"after {k}"]), None, None, None) for k in range(3)]
    got = result(spark, rows, 50)
    assert got == brute(rows, 50)
    assert [r[3] for r in got] == [0, len(run), len(run)] and got[1][1] == "before 1\nafter 1"


@pytest.mark.parametrize("rows", [line_rows(), odd_rows()], ids=["lines", "odd"])
@pytest.mark.parametrize("min_words", [12, 50])
def test_all_runs_of_enough_words(spark, rows, min_words):
    assert result(spark, rows, min_words) == brute(rows, min_words)
