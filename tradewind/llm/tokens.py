"""Token counts by rank-synchronous merging of ragged arrays (operator 5).

The distinct pieces of a batch lie in one flat array of symbols. In every round each piece applies the
pair of lowest rank it holds, at all its places at once; pieces without a pair leave with the number of
symbols they are left with. A pair that a merge creates ranks behind that merge, so this gives the counts
of merging one pair at a time.

Null and empty texts have no tokens. Whole texts are counted; special strings in a text are one token
each. Rows are counted one by one, so ties, repeated rows, empty tables and other columns need no care.
Letters that were assigned after the Unicode version of the ``regex`` module may split otherwise than in the
library. Needs a byte-level file of the ``tokenizers`` library without normalizer, such as ``byte_bpe_50k.json``.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space, and the pattern that splits text before the merges.
SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + SPACE + r"\p{L}\p{N}]+|["
           + SPACE + r"]+(?![^" + SPACE + r"])|[" + SPACE + r"]+")
# No piece reaches across the start of a run of white space.
RUNS = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
# Entries of the table of known runs, per Python worker; it starts anew when it is full.
KNOWN_RUNS = 1_000_000
# Characters of the longest run that is remembered.
KNOWN_LENGTH = 64
NONE = np.iinfo(np.int64).max


@cache
def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if it is printable, else
    the next letter after the first 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


def _first_of_each(piece: np.ndarray) -> np.ndarray:
    first = np.empty(len(piece), dtype=bool)
    first[0] = True
    np.not_equal(piece[1:], piece[:-1], out=first[1:])
    return first


class RankMerger:
    """Merges of a vocabulary file, applied to many pieces at once."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        if content["normalizer"] or content["pre_tokenizer"]["type"] != "ByteLevel" or model["type"] != "BPE":
            raise ValueError(f"{path} is not a plain byte-level vocabulary")
        vocab = model["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.ranks = order.astype(np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)  # by rank
        self.symbol = np.array([vocab[byte_letters()[b]] for b in range(256)], dtype=np.int64)
        special = [t["content"] for t in content["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.pattern = regex.compile(PATTERN)
        self.known: dict[str, int] = {}

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], NONE)

    def piece_counts(self, pieces: Sequence[bytes]) -> np.ndarray:
        """Symbols left of each piece when no more pairs merge."""
        lengths = np.array([len(p) for p in pieces], dtype=np.int64)
        counts = np.zeros(len(pieces), dtype=np.int64)
        symbols = self.symbol[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        piece = np.repeat(np.arange(len(pieces)), lengths)
        rank = np.full(len(symbols), NONE, dtype=np.int64)
        together = np.flatnonzero(piece[:-1] == piece[1:])
        rank[together] = self._rank(symbols[together], symbols[together + 1])
        while len(symbols):
            starts = np.flatnonzero(_first_of_each(piece))
            sizes = np.diff(np.append(starts, len(symbols)))
            lowest = np.minimum.reduceat(rank, starts)
            done = lowest == NONE
            counts[piece[starts[done]]] = sizes[done]
            of_each = np.repeat(lowest, sizes)
            merging = (rank == of_each) & (of_each != NONE)
            if done.any():
                stay = np.repeat(~done, sizes)
                symbols, piece, rank, merging = symbols[stay], piece[stay], rank[stay], merging[stay]
                if not len(symbols):
                    break
            # In a run of equal symbols every second place merges.
            at = np.flatnonzero(merging)
            begins = np.append(True, np.diff(at) != 1)
            run = np.maximum.accumulate(np.where(begins, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - run) % 2 == 0]
            symbols[at] = self.made[rank[at]]
            keep = np.ones(len(symbols), dtype=bool)
            keep[at + 1] = False
            moved = np.cumsum(keep) - 1
            symbols, piece, rank = symbols[keep], piece[keep], rank[keep]
            at = moved[at]
            touched = np.unique(np.concatenate((at, at[at > 0] - 1)))
            rank[touched] = NONE
            inner = touched[touched + 1 < len(symbols)]
            inner = inner[piece[inner] == piece[inner + 1]]
            rank[inner] = self._rank(symbols[inner], symbols[inner + 1])
        return counts

    def _learn(self, runs: set[str]) -> dict[str, int]:
        """Token counts of runs not seen before."""
        split = {run: self.pattern.findall(run) for run in runs}
        pieces = list({piece for found in split.values() for piece in found})
        count = dict(zip(pieces, self.piece_counts([p.encode("utf-8", "replace") for p in pieces]).tolist()))
        return {run: sum(map(count.__getitem__, found)) for run, found in split.items()}

    def counts(self, texts: Sequence[str | None]) -> list[int]:
        """Tokens of each text."""
        out, runs_of, new = [], [], set()
        if len(self.known) > KNOWN_RUNS:
            self.known = {}
        for text in texts:
            parts = [text or ""] if self.special is None else self.special.split(text or "")
            out.append(len(parts) - 1)
            runs = [run for part in parts for run in RUNS.findall(part)]
            runs_of.append(runs)
            new.update(run for run in runs if run not in self.known)
        if new:
            self.known.update(self._learn(new))
        counts = [n + sum(map(self.known.__getitem__, runs)) for n, runs in zip(out, runs_of)]
        for run in new:
            if len(run) > KNOWN_LENGTH:
                del self.known[run]
        return counts


@cache
def merger(path: str) -> RankMerger:
    """One per Python worker."""
    return RankMerger(path)


def blocks(texts: pa.Array, characters: int = 1 << 21):
    """Lists of consecutive values, each list of about so many characters or one longer value."""
    block, size = [], 0
    for value in texts:
        text = value.as_py()
        block.append(text)
        size += len(text or "")
        if size >= characters:
            yield block
            block, size = [], 0
    if block:
        yield block


def token_count(text: Column, path: str) -> Column:
    """Tokens of ``text`` under the vocabulary file ``path``, which every executor can read."""
    @F.arrow_udf("long")
    def count(texts: pa.Array) -> pa.Array:
        return pa.array([n for block in blocks(texts) for n in merger(path).counts(block)], pa.int64())

    return count(text)
