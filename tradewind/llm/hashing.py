"""Hashes of a text's words, as numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

# Bytes of a text that are hashed at once; a piece ends at a blank, so a longer word makes a longer piece.
PIECE = 1 << 16
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = (np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits after which every bit depends on every other."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64."""
    global _powers
    while len(_powers[0]) < n:
        have = len(_powers[0])
        _powers = tuple(
            np.concatenate((table, table * np.uint64(pow(base, have, 1 << 64))))
            for table, base in zip(_powers, (_BASE, _INVERSE)))
    return _powers


def _blank(symbols: np.ndarray) -> np.ndarray:
    """Whether each byte is a space or one of the five from the tab to the return."""
    return (symbols == 0x20) | (symbols - np.uint8(0x09) < 5)


def _pieces(data: bytes) -> Iterator[tuple[int, np.ndarray]]:
    """Where each piece starts, and its bytes."""
    symbols = np.frombuffer(data, dtype=np.uint8)
    start = 0
    while start < len(symbols):
        end = min(start + PIECE, len(symbols))
        while end < len(symbols):
            blanks = np.flatnonzero(_blank(symbols[end:end + PIECE]))
            if len(blanks):
                end += int(blanks[0])
                break
            end = min(end + PIECE, len(symbols))
        yield start, symbols[start:end]
        start = end


def _hashed(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where each word starts, and its hash."""
    places, found = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.uint64)]
    for at, symbols in _pieces(data):
        inside = np.zeros(len(symbols) + 2, dtype=bool)
        np.logical_not(_blank(symbols), out=inside[1:-1])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        power, inverse = _power_tables(len(symbols) + 1)
        sums = np.zeros(len(symbols) + 1, dtype=np.uint64)
        terms = symbols.astype(np.uint64)
        terms += np.uint64(1)
        terms *= power[:len(symbols)]
        np.cumsum(terms, out=sums[1:])
        places.append(starts + at)
        found.append(mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64)))
    return np.concatenate(places), np.concatenate(found)


def word_hashes(data: bytes | None) -> np.ndarray:
    """A 64-bit hash of each word of a text in UTF-8, in order. Words are runs of anything but blanks; a
    word's hash depends on its bytes alone. Null has no words."""
    return _hashed(data or b"")[1]


def text_hashes(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """``word_hashes`` of several texts, one behind the other, and the number of words of each."""
    starts, hashes = _hashed(b" ".join(texts))
    ends = np.cumsum([len(text) + 1 for text in texts], dtype=np.int64)
    return hashes, np.diff(np.searchsorted(starts, ends), prepend=0)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of every ``size`` consecutive words; of all words, if there are fewer."""
    if not len(words):
        return words
    size = min(size, len(words))
    count = len(words) - size + 1
    state = np.zeros(count, dtype=np.uint64)
    for k in range(size):
        state = mixed(state * np.uint64(0xD6E8FEB86659FD93) + words[k:k + count])
    return np.unique(state)
