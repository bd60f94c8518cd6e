"""Token counts and packing against the public tokenizer library and one-by-one best fit."""

import random
import time
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from helpers import clashing, documents, odd_rows, rows_of
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from terrace.llm import best_fit, bpe_count
from terrace.llm.numbering import number_within
from terrace.llm.pieces import cut, is_plain

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["", " ", "  a  b\n\n c", " x  y", "a" * 500, "aaa bbb<|endoftext|>x <|endoftext|><|endoftext|>", "\x1c\x1dx \x85y",
         "日本語 テキスト😀😀", "it's don't I'LL 123 45,6", "a\nb\nc d", "tail ", "\nlead", "a \nb", "x y z"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_counts_match_the_library_for_texts_and_characters(library):
    count = bpe_count.counter(VOCABULARY)
    texts = TEXTS + [f"a {chr(c)} b{chr(c)}c {chr(c)}{chr(c)}" for c in range(1, 0x3100)]
    assert count(texts) == [len(ids(library, t)) for t in texts]


def test_ids_match_the_library_for_texts_and_characters(library):
    read = best_fit.reader(VOCABULARY)
    texts = TEXTS + [f"a {chr(c)} b{chr(c)}c {chr(c)}{chr(c)}" for c in range(1, 0x3100)]
    for text in texts:
        assert np.frombuffer(read(text), "<u4").tolist() == ids(library, text), text


def test_cut_pieces_make_up_the_text():
    for text in TEXTS + ["one two\nthree"]:
        bare, spaced = cut(text)
        assert sorted("".join(bare) + "".join(" " + s for s in spaced)) == sorted(text)
    assert is_plain("one two\nthree") and not is_plain("one  two") and not is_plain("x y z")


def test_cache_limit_changes_nothing(library):
    count = bpe_count.TextCounter(VOCABULARY)
    count.cache.limit = 3
    for text in ("one two three four five", "six seven one two"):
        assert count([text]) == [len(ids(library, text))]


def unbroken(kind, n):
    rng = random.Random(n)
    return "".join(rng.choice(kind) for _ in range(n))


@pytest.mark.parametrize("kind", ["abcdefghijklmnopqrstuvwxyz", "a", "ab", "éa日😀", ["the", "ing", "er", "s"], "="])
def test_long_pretokens_match_the_library(library, kind):
    count = bpe_count.counter(VOCABULARY)
    texts = [unbroken(kind, n) for n in (511, 512, 513, 514, 2000, 20_001)]
    assert count(texts) == [len(ids(library, t)) for t in texts]


def test_both_ways_of_merging_agree():
    merger, rng = bpe_count.counter(VOCABULARY).merger, random.Random(4)
    for _ in range(200):
        sequences = [unbroken("aab treéin", rng.randint(1, 60)).encode() for _ in range(rng.randint(1, 9))]
        assert merger.count_long(sequences).tolist() == merger.count(sequences).tolist()


def test_time_of_an_unbroken_run_follows_its_length():
    count, text = bpe_count.counter(VOCABULARY), unbroken("abcdefghijklmnopqrstuvwxyz", 400_000)
    begin = time.process_time()
    assert 200_000 < count([text])[0] < 300_000
    assert time.process_time() - begin < 8  # under 1 s here; 40 s when rounds look at every symbol


def test_token_counts_of_odd_documents(spark, library):
    got = rows_of(bpe_count.token_counts(clashing(documents(spark)), VOCABULARY), "doc_id", "n_bytes", "n_tokens", "over_limit")
    want = []
    for doc_id, text, *_ in odd_rows():
        n = len(ids(library, text))
        want.append((doc_id, len((text or "").encode()), n, n > 1024))
    assert got == sorted(want, key=repr)


def brute_best_fit(lengths, capacity):
    rooms = []
    for x in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= x]
        if fits:
            rooms[rooms.index(min(fits))] -= x
        else:
            rooms.append(capacity - x)
    return sorted(rooms)


@pytest.mark.parametrize("capacity", [1, 5, 16, 20, 64])
def test_plan_is_best_fit_decreasing(capacity):
    rng = random.Random(capacity)
    for _ in range(60):
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 120))]
        histogram = {x: lengths.count(x) for x in set(lengths)}
        bins, numbers = defaultdict(list), defaultdict(list)
        for length, first, last, per_bin, first_bin, offset in best_fit.plan_best_fit(histogram, capacity):
            for n in range(first, last + 1):
                bins[first_bin + (n - first) // per_bin].append((offset + (n - first) % per_bin * length, length))
                numbers[length].append(n)
        assert {k: sorted(v) for k, v in numbers.items()} == {k: list(range(n)) for k, n in histogram.items()}
        rooms = []
        for placed in bins.values():
            end = 0
            for offset, length in sorted(placed):
                assert offset == end
                end += length
            assert end <= capacity
            rooms.append(capacity - end)
        assert sorted(rooms) == brute_best_fit(lengths, capacity)


def test_packing_of_odd_documents(spark, library):
    out = best_fit.pack_documents(clashing(documents(spark)), VOCABULARY, capacity=64).collect()
    want = []
    for doc_id, text, *_ in odd_rows():
        all_ids = ids(library, text) + [2]
        rest = len(all_ids) % 64
        cuts = sorted({0, len(all_ids)} | set(range(rest, len(all_ids), 64)))
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want.append((doc_id, k, a, b - a, zlib.crc32(np.array(all_ids[a:b], "<u4").tobytes())))
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    bins = defaultdict(list)
    for r in out:
        bins[r.sequence_id].append((r.offset, r.length))
    for placed in bins.values():
        assert sum(n for _, n in placed) <= 64
        assert [o for o, _ in sorted(placed)] == np.cumsum([0] + [n for _, n in sorted(placed)])[:-1].tolist()
    assert len(bins) == len(brute_best_fit([w[3] for w in want], 64))


def test_equal_rows_are_packed_one_by_one_and_in_several_tasks(spark, monkeypatch):
    rows = [(None, None, None, None, None)] * 700 + [(None, "", "en", "a", 1)] * 500 + [(k, "one two", "en", "a", 1) for k in range(300)]
    numbered = []

    def watch(df, group, order, name="no"):
        out = number_within(df, group, order, name)
        numbered.append(out)
        return out

    monkeypatch.setattr(best_fit, "number_within", watch)
    out = best_fit.pack_documents(documents(spark, rows).repartition(6), VOCABULARY, capacity=16).collect()
    assert len(out) == 1500 and len({(r.sequence_id, r.offset) for r in out}) == 1500
    rooms = defaultdict(int)
    for r in out:
        rooms[r.sequence_id] += r.length
    assert max(rooms.values()) <= 16 and len(rooms) == len(brute_best_fit([r.length for r in out], 16))
    got = numbered[0].where("length = 1").select("no").collect()
    assert sorted(r.no for r in got) == list(range(1200))
    # The sort tells equal rows apart, so it can spread them.
    plan = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    pieces = best_fit.token_pieces(plan.repartition(6), VOCABULARY, 16).withColumn("stored", F.monotonically_increasing_id())
    spread = pieces.repartitionByRange(6, "length", "row", "stored").groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in spread) < 600


def test_pieces_carry_ids_on_request(spark, library):
    docs = documents(spark, [(1, "one two three four five six", None, None, None)])
    rows = best_fit.pack(best_fit.token_pieces(docs, VOCABULARY, capacity=4, with_ids=True), 4).orderBy("piece").collect()
    assert [i for r in rows for i in r.ids] == ids(library, "one two three four five six") + [2]


def test_empty_tables(spark):
    assert bpe_count.token_counts(documents(spark, []), VOCABULARY).collect() == []
    assert best_fit.pack_documents(documents(spark, []), VOCABULARY).collect() == []
