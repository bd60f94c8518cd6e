"""Cutting a text into pieces that a byte-level BPE encodes independently of each other.

The public byte-level vocabularies split a text with one regular expression before any
merge, so a text's tokens are the tokens of its pre-tokens put side by side. Where a text
holds only single spaces and single line feeds between non-space characters, every space
starts a new pre-token and every line feed is one by itself. Such texts are cut with
``str.split``, several times faster than the expression; all others go through the
expression. Either way the pieces repeat a lot, so each worker keeps what it has worked out
for the pieces it met last.
"""

from __future__ import annotations

from collections.abc import Callable

import regex

# Fixed value: the pattern that splits text before the merges of the byte-level files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PRETOKENS = regex.compile(PATTERN)
_SPACE = regex.compile(r"\s")
# Every white-space character of the pattern's \s but the two that plain texts use.
OTHER_SPACES = tuple(c for c in map(chr, range(0x3001)) if c not in " \n" and _SPACE.match(c))


def is_plain(text: str) -> bool:
    """Single spaces and line feeds only, each between two characters that are no space."""
    return not (text[0] in " \n" or text[-1] in " \n" or "  " in text or "\n\n" in text
                or " \n" in text or "\n " in text or any(c in text for c in OTHER_SPACES))


def cut(text: str) -> tuple[list[str], list[str]]:
    """(pieces as they stand, words that each follow one space) of ``text``, out of order."""
    if not text:
        return [], []
    if not is_plain(text):
        return PRETOKENS.findall(text), []
    bare, spaced = [], []
    for k, line in enumerate(text.split("\n")):
        words = line.split(" ")
        if k:
            bare.append("\n")
        bare.append(words[0])
        spaced += words[1:]
    return bare, spaced


class PieceCache:
    """piece -> value for the pieces a worker met, worked out for many pieces at a time.

    ``solve`` takes a list of piece strings and returns their values. The cache is emptied
    when it holds ``limit`` pieces, which bounds memory and changes no result.
    """

    def __init__(self, solve: Callable[[list[str]], list], limit: int = 400_000):
        self.solve, self.limit = solve, limit
        self.bare: dict[str, object] = {}
        self.spaced: dict[str, object] = {}

    def learn(self, bare: set[str], spaced: set[str]) -> None:
        """Make sure that all of these are in the cache."""
        new_bare = [x for x in bare if x not in self.bare]
        new_spaced = [x for x in spaced if x not in self.spaced]
        if len(self.bare) + len(self.spaced) + len(new_bare) + len(new_spaced) > self.limit:
            self.bare.clear()
            self.spaced.clear()
            new_bare, new_spaced = list(bare), list(spaced)
        if new_bare or new_spaced:
            values = self.solve(new_bare + [" " + x for x in new_spaced])
            self.bare.update(zip(new_bare, values))
            self.spaced.update(zip(new_spaced, values[len(new_bare):]))
