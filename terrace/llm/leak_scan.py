"""Benchmark decontamination: a broadcast hash set of test n-grams, scanned for in token windows.

Benchmark texts become windows of consecutive normalised words in Spark, one row for each
distinct window. They reach the tasks as a hash set: per window size a table of hash bits, the
sorted hashes, and the windows' words themselves. A task takes the words of its documents out
of the byte buffer with numpy, hashes every window of each size by a sum of its words' hashes,
looks the windows up, and compares the words of those found, so a hit is exact. Hit words, the
items they come from and the texts without them are results.

The set is measured in Spark before it is broadcast. Beyond ``SET_BYTES`` it is dealt into
parts, and the documents are scanned once for each; found spans are merged on the way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.llm.common import free_name, materialize, python_workers

# Fixed value: after A-Z are lower-cased, words are 0-9, a-z and all that is not ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SET_BYTES = 8 * 1024 * 1024
SLICE_BYTES = 4 * 1024 * 1024
ITEMS_A_ROW = 1000
PASSES_A_STAGE = 4

_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[ord("A"):ord("Z") + 1] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("z") + 1), *range(128, 256)]] = True
# Odd multipliers, one for a byte's place in its word and one for a word's place in its window.
_BYTE, _PLACE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(max(n - 1, 0), base)]), dtype=np.uint64)


def words_of(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, hashes) of the words in ``data``, lower-cased UTF-8 bytes of texts that
    lie side by side and begin at ``bounds``. No word crosses a bound."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    inside = _IN_WORD[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[bounds] = True
    fresh = inside.copy()
    fresh[1:] &= ~inside[:-1] | cut[1:-1]
    final = inside.copy()
    final[:-1] &= ~inside[1:] | cut[1:-1]
    starts, ends = np.flatnonzero(fresh), np.flatnonzero(final) + 1
    if not len(starts):
        return starts, ends, np.zeros(0, np.uint64)
    size = ends - starts
    first = np.cumsum(size) - size
    place = np.arange(int(size.sum())) - np.repeat(first, size)
    values = (data[inside].astype(np.uint64) + np.uint64(1)) * _powers(_BYTE, int(size.max()))[place]
    hashes = np.add.reduceat(values, first)
    hashes ^= hashes >> np.uint64(29)
    hashes *= _MIX
    hashes ^= hashes >> np.uint64(32)
    return starts, ends, hashes


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash of each window of ``size`` words, also of those that cross texts."""
    total = np.zeros(max(len(hashes) - size + 1, 0), np.uint64)
    for k, factor in enumerate(_powers(_PLACE, size)):
        total += hashes[k:k + len(total)] * factor
    return total ^ (total >> np.uint64(31))


class WindowSet:
    """The hash set that is broadcast: windows (words joined by one space) and their items."""

    def __init__(self, windows: list[str], items: list[list[str]]):
        self.number: dict[bytes, int] = {}
        self.items: list[list[str]] = []
        for w, ids in zip(windows, items):  # a window with many items has several rows
            k = self.number.setdefault(w.encode(), len(self.items))
            if k == len(self.items):
                self.items.append([])
            self.items[k].extend(ids)
        by_size: dict[int, list[bytes]] = {}
        for w in self.number:
            by_size.setdefault(w.count(b" ") + 1, []).append(w)
        self.sizes = {}
        for size, texts in by_size.items():
            data = np.frombuffer(b"".join(texts), np.uint8)
            lengths = np.array([len(t) for t in texts])
            _, _, hashes = words_of(data, np.cumsum(lengths) - lengths)
            keys = np.unique(window_hashes(hashes, size)[::size])
            bits = max(10, int(16 * len(keys)).bit_length())
            seen = np.zeros(1 << bits, bool)
            seen[keys & np.uint64(len(seen) - 1)] = True
            self.sizes[size] = (keys, seen)

    def hits(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray,
             text_of: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(window size, first words, window numbers) of the windows found, words compared."""
        raw = None
        for size, (keys, seen) in self.sizes.items():
            total = window_hashes(hashes, size)
            at = np.flatnonzero(seen[total & np.uint64(len(seen) - 1)])
            at = at[text_of[at] == text_of[at + size - 1]]
            place = np.minimum(np.searchsorted(keys, total[at]), len(keys) - 1)
            at = at[keys[place] == total[at]]
            if not len(at):
                continue
            raw = data.tobytes() if raw is None else raw
            found = np.array([self.number.get(b" ".join([raw[s:e] for s, e in zip(
                starts[k:k + size].tolist(), ends[k:k + size].tolist())]), -1) for k in at.tolist()], np.int64)
            yield size, at[found >= 0], found[found >= 0]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Word spans (first, last) in order, those that overlap or touch made one."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


def scan(texts: pa.Array, windows: WindowSet, before: list[tuple[list, list]] | None = None) -> list[dict]:
    """Per text its word count, hit spans (in words, code points and bytes) and items.
    ``before`` holds what earlier parts of the set found: (word spans, items) per text."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    low, high = int(offsets[0]), int(offsets[-1])
    source = np.frombuffer(texts.buffers()[2], np.uint8)[low:high] if high > low else np.zeros(0, np.uint8)
    bounds = offsets - low
    data = _LOWERED[source]
    starts, ends, hashes = words_of(data, bounds)
    text_of = np.searchsorted(bounds, starts, "right") - 1
    upto = np.searchsorted(starts, bounds)
    words = np.diff(upto)

    found: dict[int, tuple[list, list]] = {}
    if before is not None:
        found = {k: (list(s), list(i)) for k, (s, i) in enumerate(before) if s}
    marks = np.zeros(len(starts) + 1, np.int32)
    pairs = []
    for size, at, number in windows.hits(data, starts, ends, hashes, text_of):
        marks[at] += 1  # each place is there once a size
        marks[at + size] -= 1
        pairs.append(np.stack([text_of[at], number], 1))
    if pairs:
        hit = np.cumsum(marks[:-1]) > 0
        edge = np.zeros(len(hit) + 1, bool)
        edge[upto] = True
        opens = hit.copy()
        opens[1:] &= ~hit[:-1] | edge[1:-1]
        closes = hit.copy()
        closes[:-1] &= ~hit[1:] | edge[1:-1]
        for first, last in zip(np.flatnonzero(opens).tolist(), np.flatnonzero(closes).tolist()):
            k = int(text_of[first])
            found.setdefault(k, ([], []))[0].append((first - int(upto[k]), last - int(upto[k])))
        for k, number in np.unique(np.concatenate(pairs), axis=0).tolist():
            found[k][1].extend(windows.items[number])
    chars = np.concatenate([[0], np.cumsum((source & 0xC0) != 0x80)]) if found else None
    out = [{"words": int(n), "spans": [], "items": [], "chars": [], "bytes": []} for n in words]
    for k, (spans, items) in found.items():
        row = out[k]
        row["spans"], row["items"] = merged(spans), sorted(set(items))
        for first, last in row["spans"]:
            s, e = int(starts[upto[k] + first]), int(ends[upto[k] + last])
            row["chars"].append((int(chars[s] - chars[bounds[k]]), int(chars[e] - chars[bounds[k]])))
            row["bytes"].append((s - int(bounds[k]), e - int(bounds[k])))
    return out


def _without(text: str, spans: list[tuple[int, int]]) -> str:
    raw, out, at = text.encode(), [], 0
    for s, e in spans:
        out.append(raw[at:s])
        at = e
    return b"".join([*out, raw[at:]]).decode()


def benchmark_windows(benchmark: DataFrame, size: int = 10) -> DataFrame:
    """(window, items): the distinct windows of ``size`` words of all texts, an item with fewer
    words (but not none) being one window; ``items`` has at most ``ITEMS_A_ROW`` ids a row."""
    words = F.regexp_extract_all(F.translate(F.col("text"), UPPER, LOWER), F.lit(WORD), 0)
    first = F.sequence(F.lit(1), F.greatest(F.size("w") - (size - 1), F.lit(1)))
    rows = (benchmark.select(F.col("item_id").cast("string").alias("item"), words.alias("w")).where(F.size("w") > 0)
            .select("item", F.explode(F.transform(first, lambda k: F.array_join(F.slice("w", k, size), " "))).alias("window")))
    grouped = rows.groupBy("window").agg(F.array_sort(F.collect_set("item")).alias("ids"))
    chunk = F.sequence(F.lit(0), F.greatest(F.size("ids") - 1, F.lit(0)), F.lit(ITEMS_A_ROW))
    return (grouped.select("window", "ids", F.explode(chunk).alias("k"))
            .select("window", F.slice("ids", F.col("k") + 1, ITEMS_A_ROW).alias("items")))


def _parts(windows: DataFrame, limit: int) -> list[DataFrame]:
    """The measured table in parts of about ``limit`` bytes each (one, if it is empty)."""
    weight = F.octet_length("window") + F.octet_length(F.concat_ws(",", "items")) + 64
    total = windows.agg(F.sum(weight)).first()[0] or 0
    n = max(1, -(-int(total) // limit))
    return [windows.where(F.pmod(F.xxhash64("window", "items"), F.lit(n)) == k) for k in range(n)]


def find(docs: DataFrame, benchmark: DataFrame, size: int = 10, set_bytes: int = SET_BYTES) -> DataFrame:
    """``docs`` (text and any other columns) with n_words, n_hit, items, spans and clean_text
    added; a name that is taken gets underscores.

    Words are runs of 0-9, a-z and non-ASCII characters after A-Z are lower-cased. A word is hit
    if a window of the ``benchmark`` (item_id, text) covers it. ``items`` are the ids, as sorted
    text, whose windows occur; equal ids are one item, and items without an id mark words but
    are not listed. ``spans`` are (start, end) in code points, touching ones merged;
    ``clean_text`` is the text without them. NULL, empty and wordless texts have no words and
    stay as they are, as do all texts if the benchmark has no words. Repeated rows are judged each.
    """
    spark = docs.sparkSession
    names = list(docs.columns)
    added: list[str] = []
    for name in ("n_words", "n_hit", "items", "spans", "clean_text"):
        added.append(free_name(names + added, name))
    held = [free_name(names + added, x) for x in ("word_spans", "held_items")]
    ints = T.ArrayType(T.LongType())
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    between = T.StructType(list(docs.schema.fields) + [T.StructField(held[0], ints),
                                                       T.StructField(held[1], T.ArrayType(T.StringType()))])
    final = T.StructType(list(docs.schema.fields) + [
        T.StructField(added[0], T.LongType()), T.StructField(added[1], T.LongType()),
        T.StructField(added[2], T.ArrayType(T.StringType())), T.StructField(added[3], T.ArrayType(span)),
        T.StructField(added[4], T.StringType())])
    text_at = [c.lower() for c in names].index("text")
    windows = materialize(benchmark_windows(benchmark, size), "benchmark-windows")
    python_workers(spark, rows=2000)

    def scanner(shared, last: bool):
        schema = final if last else between

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start, rows in _slices(batch.column(text_at)):
                    part = batch.slice(start, rows)
                    own, texts = part.columns[:len(names)], part.column(text_at)
                    before = None
                    if part.num_columns > len(names):
                        before = [(list(zip(s[::2], s[1::2])), i) for s, i in zip(
                            part.column(len(names)).to_pylist(), part.column(len(names) + 1).to_pylist())]
                    found = scan(texts.fill_null(""), shared.value, before)
                    yield pa.RecordBatch.from_arrays([*own, *columns(texts, found)], names=schema.names)

        def columns(texts: pa.Array, found: list[dict]) -> list[pa.Array]:
            items = pa.array([r["items"] for r in found], pa.list_(pa.string()))
            if not last:
                return [pa.array([[x for s in r["spans"] for x in s] for r in found], pa.list_(pa.int64())), items]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            spans = [[{"start": s, "end": e} for s, e in r["chars"]] for r in found]
            if any(r["bytes"] for r in found):
                clean = pa.array([_without(t, r["bytes"]) if r["bytes"] else t
                                  for t, r in zip(texts.to_pylist(), found)], texts.type)
            else:
                clean = texts
            return [pa.array([r["words"] for r in found], pa.int64()),
                    pa.array([sum(e - s + 1 for s, e in r["spans"]) for r in found], pa.int64()),
                    items, pa.array(spans, kind), clean]

        return run, schema

    parts = _parts(windows, set_bytes)
    for k, part in enumerate(parts):
        rows = part.collect()  # bounded by set_bytes
        shared = spark.sparkContext.broadcast(WindowSet([r["window"] for r in rows], [list(r["items"]) for r in rows]))
        run, schema = scanner(shared, k == len(parts) - 1)
        docs = docs.mapInArrow(run, schema)
        if k % PASSES_A_STAGE == PASSES_A_STAGE - 1 and k < len(parts) - 1:
            docs = materialize(docs, "scanned")  # no more sets than that in a task's workers
    return docs


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """(start, rows) of slices of about ``SLICE_BYTES``; one longer text is a slice by itself."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if pa.types.is_large_string(texts.type) else np.int32)
    offsets = offsets[texts.offset:texts.offset + len(texts) + 1]
    start = 0
    while start < len(texts):
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + SLICE_BYTES, "right")) - 1)
        yield start, min(stop, len(texts)) - start
        start = stop


def remove(docs: DataFrame, benchmark: DataFrame, what: str = "spans", size: int = 10) -> DataFrame:
    """``docs`` with its columns, without hit spans (``what="spans"``: texts are cut, rows stay) or
    without the documents that have one (``what="documents"``)."""
    if what not in ("spans", "documents"):
        raise ValueError("what must be 'spans' or 'documents'")
    names = docs.columns
    found = find(docs, benchmark, size)
    n_hit, clean = found.columns[len(names) + 1], found.columns[-1]
    if what == "documents":
        return found.where(F.col(n_hit) == 0).select(*[F.col(f"`{c}`") for c in names])
    return found.select(*[F.col(clean).alias(c) if c.lower() == "text" else F.col(f"`{c}`") for c in names])
