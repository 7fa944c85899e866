"""Hashes of words, worked out on the bytes of many texts at a time.

The hash of a word is a polynomial over its bytes modulo 2**64, taken from
running sums: with a random odd base B and a random number per byte, the sum of
``value[b_i] * B**i`` from a word's start to its end, divided by ``B**start``.
A-Z have the values of a-z, so words that differ in case have one hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from .common import SPACE

# Bytes of texts that are hashed in one go; a longer text is cut at white space.
# Its arrays, of 8 bytes a byte, stay in the processor's cache.
PIECE = 1 << 16

_RNG = np.random.default_rng(64)
_BASE = int(_RNG.integers(1 << 62, 1 << 63)) * 2 + 1
_VALUES = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_VALUES[65:91] = _VALUES[97:123]
# One where a byte belongs to a word.
_FILLED = bytes(c not in SPACE for c in range(256))


class _Powers:
    """Powers of a number modulo 2**64, as many as were asked for."""

    def __init__(self, base: int):
        self.base, self.known = base, np.ones(1, np.uint64)

    def first(self, n: int) -> np.ndarray:
        while len(self.known) < n:
            step = np.uint64(pow(self.base, len(self.known), 1 << 64))
            self.known = np.concatenate((self.known, self.known * step))
        return self.known[:n]


_POWERS, _INVERSES = _Powers(_BASE), _Powers(pow(_BASE, -1, 1 << 64))


def _hash_piece(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every word of ``data``."""
    codes = np.frombuffer(data, np.uint8)
    filled = np.zeros(len(codes) + 2, bool)
    filled[1:-1] = np.frombuffer(data.translate(_FILLED), bool)
    edges = np.flatnonzero(filled[1:] != filled[:-1])
    starts, ends = edges[::2], edges[1::2]
    terms = np.take(_VALUES, codes)
    terms *= _POWERS.first(len(codes))
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(terms, out=sums[1:])
    found = (sums[ends] - sums[starts]) * _INVERSES.first(len(codes) + 1)[starts]
    # The low bits of a polynomial know only the low bits of what it sums.
    found = (found ^ (found >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return starts, found ^ (found >> np.uint64(32))


def _cut(text: bytes) -> Iterator[bytes]:
    """Pieces of some ``PIECE`` bytes that end before white space."""
    start = 0
    while start < len(text):
        end = start + PIECE
        while end < len(text) and text[end] not in SPACE:
            end += 1
        yield text[start:end]
        start = end


def word_groups(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The word hashes of some texts at a time, one after the other, and how many
    words each of them has."""
    group: list[bytes] = []
    size = 0
    for text in [*texts, None]:
        if group and (text is None or size + len(text) > PIECE):
            starts, found = _hash_piece(b" ".join(group))
            ends = np.cumsum([len(t) + 1 for t in group])
            yield found, np.diff(np.searchsorted(starts, ends), prepend=0)
            group, size = [], 0
        if text is not None and len(text) > PIECE:
            found = np.concatenate([_hash_piece(piece)[1] for piece in _cut(text)])
            yield found, np.array([len(found)])
        elif text is not None:
            group.append(text)
            size += len(text)


def word_hashes(texts: list[bytes]) -> list[np.ndarray]:
    """The hashes of the words of each text, in their order."""
    return [words for found, sizes in word_groups(texts) for words in np.split(found, np.cumsum(sizes)[:-1])]
