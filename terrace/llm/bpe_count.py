"""Token counts by rank-synchronous merging of ragged numpy arrays.

Many pre-tokens are held in one flat array of symbols with an owner per symbol. A round
looks up the merge rank of every neighbouring pair, takes each sequence's lowest rank, and
applies that pair everywhere in its sequence at once (left to right, without overlap), for
all sequences together. A sequence without a known pair is done; its surviving symbols are
its tokens. Nothing is counted token by token in Python.

A round costs a look at every symbol that is left. That suits pre-tokens of a few letters;
an unbroken run of 100,000 letters has thousands of different lowest ranks. Sequences over
``LONG`` symbols are merged by rounds over linked arrays: positions wait in a list per rank,
and a round takes one rank in all of those sequences and touches only its places and their
neighbours.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import python_workers
from terrace.llm.pieces import PRETOKENS, PieceCache, cut

_NONE = np.int32(2**31 - 1)
# Symbols of a sequence from which rounds over its active pairs alone are the quicker ones.
LONG = 512


def byte_symbols() -> dict[str, int]:
    """The printable character that byte-level vocabularies write for each byte: printable
    Latin-1 bytes stand for themselves, the others follow from code point 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class RankMerger:
    """The merges of a byte-level BPE file, applied to batches of byte strings."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in merges]
        self.specials = sorted((t["content"] for t in spec.get("added_tokens", [])), key=len, reverse=True)
        self.start = np.zeros(256, np.int32)
        for char, byte in byte_symbols().items():
            self.start[byte] = vocab[char]
        self.width = np.int64(max(vocab.values()) + 1)
        left, right = (np.array([vocab[m[k]] for m in merges], np.int64) for k in (0, 1))
        keys = left * self.width + right
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int32)
        # Pairs by hash: a slot holds its first pair; the few others are looked up by bisection.
        self.bits = np.uint64(64 - 19)
        slot = self._slot(keys)
        self.slot_key = np.full(1 << 19, -1, np.int64)
        self.slot_rank = np.full(1 << 19, _NONE, np.int32)
        first = np.unique(slot, return_index=True)[1]
        self.slot_key[slot[first]], self.slot_rank[slot[first]] = keys[first], first
        rest = np.setdiff1d(np.arange(len(keys)), first)
        rest = rest[np.argsort(keys[rest], kind="stable")]
        self.rest_key, self.rest_rank = keys[rest], rest.astype(np.int32)
        self.slot_shared = np.zeros(1 << 19, bool)
        self.slot_shared[slot[rest]] = True

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.bits).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge rank of each pair, or a number above all ranks."""
        keys = left.astype(np.int64) * self.width + right
        slot = self._slot(keys)
        out = np.where(self.slot_key[slot] == keys, self.slot_rank[slot], _NONE)
        again = np.flatnonzero((out == _NONE) & self.slot_shared[slot])
        if len(again) and len(self.rest_key):
            at = np.minimum(np.searchsorted(self.rest_key, keys[again]), len(self.rest_key) - 1)
            out[again] = np.where(self.rest_key[at] == keys[again], self.rest_rank[at], _NONE)
        return out

    def count(self, sequences: list[bytes]) -> np.ndarray:
        """Number of symbols that survive all merges, for each byte string."""
        lengths = np.fromiter(map(len, sequences), np.int64, len(sequences))
        long = np.flatnonzero(lengths > LONG)
        if len(long):
            out = np.zeros(len(sequences), np.int64)
            out[long] = self.count_long([sequences[k] for k in long])
            short = np.flatnonzero(lengths <= LONG)
            out[short] = self.count([sequences[k] for k in short])
            return out
        counts = lengths.copy()
        symbols = self.start[np.frombuffer(b"".join(sequences), np.uint8)]
        owners = np.repeat(np.arange(len(sequences)), lengths)
        while len(symbols):
            rank = np.full(len(symbols), _NONE, np.int32)
            inside = np.flatnonzero(owners[1:] == owners[:-1])
            rank[inside] = self.ranks(symbols[inside], symbols[inside + 1])
            starts = np.flatnonzero(np.r_[True, owners[1:] != owners[:-1]])
            sizes = np.diff(np.r_[starts, len(symbols)])
            lowest = np.minimum.reduceat(rank, starts)
            counts[owners[starts]] = sizes
            low = np.repeat(lowest, sizes)
            live = low != _NONE
            if not live.any():
                break
            hits = np.flatnonzero(live & (rank == low))
            # Of touching pairs (a a a), every second one of the run stays a pair.
            order = np.arange(len(hits))
            begins = np.r_[True, np.diff(hits) != 1]
            hits = hits[(order - np.maximum.accumulate(np.where(begins, order, 0))) % 2 == 0]
            symbols[hits] = self.merged[rank[hits]]
            live[hits + 1] = False
            symbols, owners = symbols[live], owners[live]
        return counts

    def count_long(self, sequences: list[bytes]) -> np.ndarray:
        """What ``count`` gives for byte strings that are not empty, in time that follows their
        merges: each round takes the lowest rank that is left in any, and only the pairs next to
        a merge are ranked again."""
        symbols = self.start[np.frombuffer(b"".join(sequences), np.uint8)]
        n = len(symbols)
        first = np.cumsum([0, *map(len, sequences[:-1])])
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[first - 1], before[first] = n, -1
        there = np.ones(n, np.int64)
        # Rank of the pair that begins at each symbol; a symbol that is gone begins none.
        rank = np.full(n, _NONE, np.int32)
        waiting: dict[int, list[np.ndarray]] = {}
        queue: list[int] = []

        def note(places: np.ndarray) -> None:
            places = places[rank[places] != _NONE]
            places = places[np.argsort(rank[places], kind="stable")]
            ranks = rank[places]
            edges = np.flatnonzero(np.r_[True, ranks[1:] != ranks[:-1], True]) if len(ranks) else []
            for a, b in zip(edges[:-1], edges[1:]):
                r = int(ranks[a])
                if r not in waiting:
                    waiting[r] = []
                    heapq.heappush(queue, r)
                waiting[r].append(places[a:b])

        places = np.flatnonzero(after < n)
        rank[places] = self.ranks(symbols[places], symbols[places + 1])
        note(places)
        while queue:
            low = heapq.heappop(queue)
            hits = np.unique(np.concatenate(waiting.pop(low)))
            hits = hits[rank[hits] == low]
            if not len(hits):
                continue
            # Of touching pairs (a a a), every second one of the run stays a pair.
            order = np.arange(len(hits))
            begins = np.r_[True, after[hits[:-1]] != hits[1:]]
            hits = hits[(order - np.maximum.accumulate(np.where(begins, order, 0))) % 2 == 0]
            gone = after[hits]
            symbols[hits], after[hits], rank[gone], there[gone] = self.merged[low], after[gone], _NONE, 0
            follow = after[hits]
            inside = follow < n
            before[follow[inside]] = hits[inside]
            ahead = before[hits]
            places = np.unique(np.concatenate([hits, ahead[ahead >= 0]]))
            ends = after[places] >= n
            rank[places[ends]] = _NONE
            places = places[~ends]
            rank[places] = self.ranks(symbols[places], symbols[after[places]])
            note(places)
        return np.add.reduceat(there, first)

    def count_pieces(self, pieces: list[str]) -> list[int]:
        """Tokens of each piece of text, by way of its distinct pre-tokens."""
        split = [PRETOKENS.findall(x) for x in pieces]
        index: dict[str, int] = {}
        ids = [index.setdefault(t, len(index)) for parts in split for t in parts]
        counts = self.count([t.encode("utf-8") for t in index])[np.array(ids, np.int64)]
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        ends = np.cumsum(np.r_[0, counts])[np.cumsum(sizes)]
        return np.diff(np.r_[0, ends]).tolist()


class TextCounter:
    """Token counts of whole texts; special strings inside a text count as one token."""

    def __init__(self, path: str):
        self.merger = RankMerger(path)
        self.cache = PieceCache(self.merger.count_pieces)

    def segments(self, text: str) -> tuple[list[str], int]:
        """The stretches of ``text`` between special strings, and how many of those it has.
        The library takes the leftmost special string, the longest if several start there."""
        specials = [s for s in self.merger.specials if s in text]
        if not specials:
            return [text], 0
        import re
        parts = re.split("|".join(map(re.escape, specials)), text)
        return parts, len(parts) - 1

    def __call__(self, texts: list[str]) -> list[int]:
        cuts, specials = [], []
        for text in texts:
            parts, n = self.segments(text)
            bare, spaced = cut(parts[0])
            for part in parts[1:]:
                more = cut(part)
                bare, spaced = bare + more[0], spaced + more[1]
            cuts.append((bare, spaced))
            specials.append(n)
        self.cache.learn({x for bare, _ in cuts for x in bare}, {x for _, spaced in cuts for x in spaced})
        bare_of, spaced_of = self.cache.bare.__getitem__, self.cache.spaced.__getitem__
        return [n + sum(map(bare_of, bare)) + sum(map(spaced_of, spaced))
                for (bare, spaced), n in zip(cuts, specials)]


_COUNTERS: dict[str, TextCounter] = {}


def counter(path: str) -> TextCounter:
    """The worker's counter for a vocabulary file; loaded once per Python worker."""
    if path not in _COUNTERS:
        _COUNTERS[path] = TextCounter(path)
    return _COUNTERS[path]


def token_counts(docs: DataFrame, vocabulary: str, max_tokens: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of ``docs`` (doc_id, text).

    ``vocabulary`` is the path of a byte-level BPE file on every executor. Row by row: no
    shuffle, and a text is counted whole, however long. A NULL text counts as empty (0 bytes,
    0 tokens); repeated rows are each counted; other columns are not read. Counts equal
    those of the library that the file is for, without begin, end or padding tokens.
    """
    python_workers(docs.sparkSession, rows=1000)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = counter(vocabulary)
        for batch in batches:
            texts = ["" if t is None else t for t in batch["text"].tolist()]
            yield pd.DataFrame({"row": batch["row"],
                                "n_bytes": [len(t.encode("utf-8")) for t in texts],
                                "n_tokens": count(texts)})

    # The id travels as an opaque struct, so a NULL id keeps its type.
    out = (docs.select(F.struct(F.col("doc_id")).alias("row"), F.col("text"))
           .mapInPandas(run, "row struct<doc_id: bigint>, n_bytes long, n_tokens long"))
    return out.select(F.col("row.doc_id").alias("doc_id"), "n_bytes", "n_tokens",
                      (F.col("n_tokens") > max_tokens).alias("over_limit"))
