"""Hashes of the words of many texts at once, in numpy.

Words are what lies between runs of the white space U+0020 and U+0009 to U+000D.
"""

from __future__ import annotations

import re

import numpy as np

SLICE = 1 << 18
_BLANK = re.compile(r"[\x20\x09-\x0d]")


def slices(text: str, limit: int = SLICE):
    """Parts of a text, each of `limit` characters and on to the next white space.

    No word is cut, so a part is as long as its last word needs.
    """
    at = 0
    while len(text) - at > limit:
        blank = _BLANK.search(text, at + limit)
        if blank is None:
            break
        yield text[at:blank.start()]
        at = blank.start()
    yield text[at:]


def grouped(texts: list[str | None], limit: int = SLICE):
    """Lists of (text number, slice) of bounded total length, but for words longer than that."""
    some, size = [], 0
    for i, text in enumerate(texts):
        for part in slices(text or ""):
            some.append((i, part))
            size += len(part) + 64
            if size > limit:
                yield some
                some, size = [], 0
    if some:
        yield some


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2**64 and their inverses."""
    base = 0x9E3779B97F4A7C15
    up = np.full(n, base, np.uint64)
    down = np.full(n, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def mixed(hashes: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    hashes = (hashes ^ (hashes >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    hashes = (hashes ^ (hashes >> np.uint64(32))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return hashes ^ (hashes >> np.uint64(32))


class Words:
    """Finds and hashes words; keeps the tables of powers between calls."""

    def __init__(self):
        self.up, self.down = powers(1 << 16)

    def codes(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Code points of the texts, with a space before and between and four after them; blanks."""
        joined = " " + " ".join(texts) + "    "
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        blank = (codes == 32) | ((codes >= 9) & (codes <= 13))
        return codes, blank

    def spans(self, blank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of each run that isn't blank."""
        edge = np.flatnonzero(np.diff(blank))
        return edge[::2] + 1, edge[1::2] + 1

    def hashes(self, codes: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """Hash of each span."""
        if len(codes) >= len(self.up):
            self.up, self.down = powers(2 * len(codes))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * self.up[:len(codes)])])
        return (sums[stops] - sums[starts]) * self.down[starts]

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Scrambled hashes of all words, A-Z read as a-z, text after text; words per text."""
        hashes, number = [np.zeros(0, np.uint64)], np.zeros(len(texts), np.int64)
        for some in grouped(texts):
            parts = [part for _, part in some]
            codes, blank = self.codes(parts)
            codes[(codes >= 65) & (codes <= 90)] += np.uint64(32)
            starts, stops = self.spans(blank)
            found = self.hashes(codes, starts, stops)
            ends = np.cumsum([len(t) + 1 for t in parts])
            owner = np.searchsorted(ends, starts, "right")
            hashes.append(mixed(found))
            np.add.at(number, [i for i, _ in some], np.bincount(owner, minlength=len(some)))
        return np.concatenate(hashes), number
