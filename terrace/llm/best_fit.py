"""Best-fit decreasing packing of token pieces, with a segment tree over remaining capacities.

Best-fit decreasing looks at pieces only through their lengths, and a length is at most the
capacity. So the packing is planned on the length histogram (one row per length, at most
``capacity`` rows): lengths in falling order, each piece to the tightest open bin, found in
logarithmic time by descending a segment tree over remaining capacities. Bins with the same
remaining room are held as runs of bin numbers, so one descent places a whole run of equal
pieces exactly where one-by-one placement would. Spark then numbers the pieces within each
length and joins them with the plan. The packing is the global one at every size; no task
and no driver ever holds the pieces.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.bpe_count import byte_symbols
from terrace.llm.common import free_name, materialize, python_workers
from terrace.llm.numbering import number_within
from terrace.llm.pieces import PATTERN

PIECES = "row struct<doc_id: bigint>, piece int, start long, length long, ids_crc32 long"


class OpenBins:
    """Bins by remaining room, with a segment tree for "least room of at least this much"."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.filled = [0] * (2 * self.size)
        self.runs: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def _add(self, room: int, change: int) -> None:
        at = self.size + room
        while at:
            self.filled[at] += change
            at //= 2

    def put(self, room: int, first: int, bins: int) -> None:
        """Bins first .. first + bins - 1 have ``room`` left (no room: closed)."""
        if room and bins:
            self.runs[room].append((first, bins))
            self._add(room, 1)

    def take(self, length: int) -> tuple[int, int, int] | None:
        """(room, first, bins): the run of bins with the least room >= ``length``, or None."""
        at = self.size + length
        if not self.filled[at]:
            while at > 1 and (at % 2 or not self.filled[at + 1]):
                at //= 2
            if at <= 1:
                return None
            at += 1
            while at < self.size:
                at = 2 * at if self.filled[2 * at] else 2 * at + 1
        room = at - self.size
        first, bins = self.runs[room].pop()
        self._add(room, -1)
        return room, first, bins


def plan_best_fit(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first_no, last_no, per_bin, first_bin, offset): the pieces of a length
    numbered first_no..last_no go ``per_bin`` to a bin, from ``first_bin`` on, and the first
    piece of a bin lies at ``offset``. This is best-fit decreasing with ties among equal
    rooms broken by the run opened last."""
    bins, next_bin, rows = OpenBins(capacity), 0, []
    for length in sorted(histogram, reverse=True):
        number, left = 0, histogram[length]
        while left:
            found = bins.take(length)
            if found:
                room, first, there = found
            else:
                # As many new bins as this length needs: none that is open has room.
                room, first, there = capacity, next_bin, -(-left // (capacity // length))
                next_bin += there
            # A bin just filled is the tightest, so it takes equal pieces until none fits.
            per_bin = room // length
            full = min(there, left // per_bin)
            if full:
                rows.append((length, number, number + full * per_bin - 1, per_bin, first, capacity - room))
                bins.put(room - per_bin * length, first, full)
                number, left = number + full * per_bin, left - full * per_bin
            rest = min(left, per_bin - 1) if full < there else 0
            if rest:
                rows.append((length, number, number + rest - 1, rest, first + full, capacity - room))
                bins.put(room - rest * length, first + full, 1)
                number, left = number + rest, left - rest
            bins.put(room, first + full + bool(rest), there - full - bool(rest))
    return rows


class IdReader:
    """Token ids of a whole text as little-endian bytes: those that ``tokenizers`` gives for
    the file, without added special tokens.

    A text with a special string in it goes to ``tokenizers`` itself. All others are encoded
    with the same vocabulary and pattern by ``tiktoken``, which gives the same ids in a
    quarter of the time (7.4 against 1.9 MB a second here). The tests hold the ids against
    ``tokenizers`` for texts and for every character.
    """

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one thread a task
        from tiktoken import Encoding
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        byte_of = byte_symbols()
        ranks = {bytes(byte_of[c] for c in token): k
                 for token, k in self.tokenizer.get_vocab(with_added_tokens=False).items()}
        self.encoding = Encoding(os.path.basename(vocabulary), pat_str=PATTERN, mergeable_ranks=ranks,
                                 special_tokens={})

    def __call__(self, text: str) -> bytes:
        if any(s in text for s in self.specials):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        else:
            ids = self.encoding.encode_ordinary(text)
        return np.array(ids, "<u4").tobytes()


_READERS: dict[str, IdReader] = {}


def reader(vocabulary: str) -> IdReader:
    if vocabulary not in _READERS:
        _READERS[vocabulary] = IdReader(vocabulary)
    return _READERS[vocabulary]


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int = 1024, end_id: int = 2,
                 with_ids: bool = False) -> DataFrame:
    """Every document's ids, then ``end_id``, cut into pieces of at most ``capacity`` tokens.

    Only documents of more than ``capacity`` tokens are cut; the first piece takes the rest,
    all others are full. Columns: row.doc_id, piece, start, length, ids_crc32 (and ids, when
    ``with_ids``). A NULL or empty text is the end token alone. Row by row, no shuffle.
    """
    python_workers(docs.sparkSession, rows=1000)
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        read = reader(vocabulary)
        for batch in batches:
            out = []
            for row, text in zip(batch["row"], batch["text"].tolist()):
                ids = read(text or "") + end
                n = len(ids) // 4
                count = -(-n // capacity)
                cuts = [0, *range(n - (count - 1) * capacity, n + 1, capacity)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    part = ids[4 * a:4 * b]
                    out.append((row, k, a, b - a, zlib.crc32(part)) + ((np.frombuffer(part, "<u4").astype(np.int64),) if with_ids else ()))
            names = ["row", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
            yield pd.DataFrame(out, columns=names)

    return (docs.select(F.struct(F.col("doc_id")).alias("row"), F.col("text"))
            .mapInPandas(run, PIECES + (", ids array<long>" if with_ids else "")))


def pack(pieces: DataFrame, capacity: int = 1024) -> DataFrame:
    """Add sequence_id and offset to ``pieces`` (columns of token_pieces).

    The pieces are written once to the shared folder and numbered within their length by a
    range sort, so a length that holds most rows is still many tasks; so are equal rows,
    which the order of the stored table tells apart. The driver sees one histogram row per
    length, at most ``capacity``; the plan made from it is what the last join broadcasts, and
    its size depends on ``capacity`` alone. An empty input packs into no sequences.
    """
    spark = pieces.sparkSession
    names, row = pieces.columns, free_name(pieces.columns, "stored")
    pieces = materialize(pieces.withColumn(row, F.monotonically_increasing_id()), "pieces")
    numbered = number_within(pieces, ["length"], ["row", "piece", "start", "ids_crc32", row])
    histogram = {int(r["length"]): int(r["count"]) for r in pieces.groupBy("length").count().collect()}
    plan = spark.createDataFrame(
        plan_best_fit(histogram, capacity),
        "p_length long, first_no long, last_no long, per_bin long, first_bin long, p_offset long")
    at = F.col("no") - F.col("first_no")
    placed = numbered.join(F.broadcast(plan), (F.col("length") == F.col("p_length"))
                           & F.col("no").between(F.col("first_no"), F.col("last_no")))
    return placed.select(
        F.col("row.doc_id").alias("doc_id"), "piece", "start", "length", "ids_crc32",
        (F.col("first_bin") + F.floor(at / F.col("per_bin"))).cast("long").alias("sequence_id"),
        (F.col("p_offset") + at % F.col("per_bin") * F.col("length")).alias("offset"),
        *(["ids"] if "ids" in names else []))


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """Pieces of all documents with their place: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset. Every stored row is a document of its own, also if it repeats
    another or has no id."""
    return pack(token_pieces(docs, vocabulary, capacity, end_id), capacity)
