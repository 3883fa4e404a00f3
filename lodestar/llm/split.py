"""Pieces of texts by a pattern with classes of letters and digits, and tables of what is known of pieces."""

from __future__ import annotations

import re
from collections.abc import Callable

#: Letters and numbers among the ASCII characters.
_ASCII = {r"\p{L}": "A-Za-z", r"\p{N}": "0-9"}


def ascii_pattern(pattern: str) -> re.Pattern | None:
    """The pattern for texts of ASCII characters only, for the standard library; None if it cannot be put so."""
    classes = re.sub(r"\[[^\]]*\]", lambda m: re.sub(r"\\p\{[LN]\}", lambda c: _ASCII[c[0]], m[0]), pattern)
    plain = re.sub(r"\\p\{[LN]\}", lambda c: f"[{_ASCII[c[0]]}]", classes)
    if re.search(r"\\[pPX]|\(\?[a-zA-Z]|\(\?\||\[\[|&&|\|\|", plain):
        return None
    try:
        return re.compile(plain, re.ASCII)
    except re.error:
        return None


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """All matches of the pattern in a text: those of ASCII texts by the standard library, which is faster, else by ``regex``."""
    import regex

    every, plain = regex.compile(pattern).findall, ascii_pattern(pattern)
    if plain is None:
        return every
    ascii_ = plain.findall
    return lambda text: ascii_(text) if text.isascii() else every(text)


class Pieces:
    """What is known of pieces, made by ``make`` when first met. There are two tables: when the newer one is full it takes the place
    of the older, so pieces that come again and again are never lost."""

    def __init__(self, make: Callable[[str], bytes], most: int, longest: int = 1 << 30) -> None:
        self.make, self.most, self.longest = make, most, longest
        self.newer: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def of(self, pieces: list[str]) -> bytes:
        """What is known of each piece, joined."""
        found = list(map(self.newer.get, pieces))
        if None in found:
            for k, x in enumerate(found):
                if x is None:
                    found[k] = self._one(pieces[k])
        return b"".join(found)

    def _one(self, piece: str) -> bytes:
        made = self.newer.get(piece)
        if made is None:
            made = self.older.get(piece)
            if made is None:
                made = self.make(piece)
            if len(piece) <= self.longest:
                if len(self.newer) >= self.most:
                    self.older, self.newer = self.newer, {}
                self.newer[piece] = made
        return made
