"""BPE encoding and decoding as streams (operator 6).

Encoding reads a word's symbols from left to right and keeps, for each place of a short window, the last
token of the encoding of the word up to there: the one token that ends there, encodes to itself and stands
behind the token before it as the merges would leave the two. The longest token of the merge list bounds
how far back a later symbol can reach: whatever follows, one of the last ``lookahead`` places is a token
border, so the tokens that all of these agree on are final and are emitted. Memory is a few windows,
however long the word. Words that end before the first window is full take each step together with all
different words of their texts: the candidates for a place's last token, longest first, are what an automaton of
all tokens has read there.

Decoding is a state machine from bytes to text that holds back an incomplete character until the bytes
that complete it have come.

Null and empty texts have no tokens and decode to an empty text. Rows are encoded one by one, so ties,
repeated rows, empty tables and other columns need no care. The vocabulary file is one of the
``tokenizers`` library with word ends, such as ``word_bpe_49k.json``; special strings in a text are one
token each, nothing is added, cut or padded. Letters that were assigned after the Unicode version of Python
and its ``regex`` module may split otherwise than in the library.
"""

from __future__ import annotations

import codecs
import json
import re
import unicodedata
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from tradewind.llm.tokens import SPACE, byte_letters

# Entries of the tables of known words (of two generations) and of token pairs, per Python worker; a full table of
# pairs starts anew, and known words in use pass to the next generation.
KNOWN_RUNS = 50_000
KNOWN_PAIRS = 200_000
# Places for what is known of token pairs in `Steps`, as a power of two; a new pair takes the place of another.
KNOWN_FITS = 20
# Bytes of words that are encoded at once, and the least and the most different words that take steps together.
BLOCK = 1 << 21
FEW_WORDS = 64
MANY_WORDS = 1 << 14
# Characters of the longest word that is remembered.
KNOWN_LENGTH = 64
# Characters of a text that are normalised at once; cuts fall before white space.
SLICE = 1 << 16
INFINITY = float("inf")
LINE_BREAK, SPECIAL = b"\n "
SPACES = re.compile(f"[{SPACE}]+")


def _lower(text: str) -> str:
    """Lower case letter by letter: a capital sigma does not depend on its neighbours."""
    return text.replace("Σ", "σ").lower()


def _slices(text: str) -> Iterator[str]:
    start = 0
    while start < len(text):
        cut = SPACES.search(text, start + SLICE) if len(text) - start > SLICE else None
        end = cut.start() if cut else len(text)
        yield text[start:end]
        start = end


class Transducer:
    """Merges and vocabulary of a file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model, before = content["model"], content["pre_tokenizer"]["pretokenizers"]
        kinds = [n["type"] for n in content["normalizer"]["normalizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"] or [p["type"] for p in before] != ["Split", "ByteLevel"]:
            raise ValueError(f"{path} is not a vocabulary of lower-case words")
        self.vocab = model["vocab"]
        self.end = model["end_of_word_suffix"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.rank = {pair: k for k, pair in enumerate(pairs)}
        self.parts = {a + b: (a, b) for a, b in pairs}
        if len(self.parts) < len(pairs):
            raise ValueError(f"{path} makes a token in two ways")
        self.lookahead = max(len((a + b).removesuffix(self.end)) for a, b in pairs)
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.at_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        pattern = before[0]["pattern"]["Regex"].replace(r"\s", SPACE)
        self.words = regex.compile(pattern)
        # The same for lower-case ASCII, which ``re`` splits in less than half the time.
        self.ascii_words = re.compile(pattern.replace(r"\p{L}", "a-z").replace(r"\p{N}", "0-9"))
        self.letters = byte_letters()
        self.code = {token: array("i", [id_]).tobytes() for token, id_ in self.vocab.items()}
        self.known: dict[str, bytes] = {}
        self.earlier: dict[str, bytes] = {}
        self.fits: dict[tuple[str, str], bool] = {}
        self.whole: dict[str, bool] = {}
        self.spines: tuple[dict, dict] = {}, {}
        self.steps = Steps(self)

    def _spine(self, token: str, side: int) -> list[tuple[str, float]]:
        """What stands at one border of ``token`` (0: left, 1: right) while it is merged, from the whole
        token down, each with the rank at which the next larger one takes it."""
        spines = self.spines[side]
        found = spines.get(token)
        if found is None:
            found, taken = [], INFINITY
            while token:
                found.append((token, taken))
                parts = self.parts.get(token)
                token, taken = (parts[side], self.rank[parts]) if parts else ("", 0)
            spines[found[0][0]] = found
        return found

    def _crossed(self, left: str, right: str, before: float = INFINITY) -> bool:
        """Whether a merge of rank under ``before`` reaches across the border of the two tokens.

        Of two equal merges that compete for a symbol the left one comes first.
        """
        rank = self.rank
        for a, taken_a in self._spine(left, 1):
            for b, taken_b in self._spine(right, 0):
                across = rank.get((a, b), INFINITY)
                if across < taken_a and across <= taken_b and across < before:
                    return True
        return False

    def _alone(self, token: str) -> bool:
        """Whether the merges make ``token`` of its own symbols."""
        found = self.whole.get(token)
        if found is None:
            parts = self.parts.get(token)
            found = self.whole[token] = parts is None or (
                self._alone(parts[0]) and self._alone(parts[1])
                and not self._crossed(*parts, before=self.rank[parts]))
        return found

    def _stands(self, before: str, token: str) -> bool:
        """Whether the merges leave ``token`` as it is behind ``before`` (empty: alone)."""
        if len(self.fits) >= KNOWN_PAIRS:
            self.fits = {}
        found = self._alone(token) and not (before and self._crossed(before, token))
        self.fits[before, token] = found
        return found

    def _last(self, window: str, place: int, ending: str, before: Callable[[int], str]) -> str:
        """The last token of the encoding of ``window`` up to ``place``; ``before`` has those of the places
        before it. There is one, so the likely starts are tried first: the last token's, and the symbol's."""
        fits, vocab = self.fits, self.vocab
        likely = place - 1 - len(before(place - 1)) if place > 1 else 0
        for start in chain((likely, place - 1), range(max(0, place - self.lookahead), place - 1)):
            token = window[start:place] + ending
            if token in vocab:
                left = before(start) if start else ""
                fit = fits.get((left, token))
                if self._stands(left, token) if fit is None else fit:
                    return token
        raise ValueError(f"no token ends at {window[place - 1]!r}")

    def tokens(self, symbols: Iterable[str]) -> Iterator[str]:
        """Tokens of one word, given as its symbols; each is emitted once nothing that follows can
        change it."""
        window, last = "", [""]  # symbols since the last final border; the last token up to each place
        source = iter(symbols)
        symbol = next(source, None)
        while symbol is not None:
            following = next(source, None)
            window += symbol
            ending = self.end if following is None else ""
            last.append(self._last(window, len(window), ending, last.__getitem__))
            if following is not None and len(window) >= 4 * self.lookahead:
                border, final = self._agreed(last)
                yield from final
                window, last = window[border:], [""] + last[border + 1:]
            symbol = following
        if window:
            yield from self._chain(last, len(window))[1]

    def _short_word(self, word: str) -> list[str]:
        """``tokens`` of a word that ends before the window is full."""
        return list(self.tokens(word))

    def _chain(self, last: list[str], place: int) -> tuple[list[int], list[str]]:
        """Borders and tokens of the encoding up to ``place``."""
        borders, tokens = [place], []
        while place:
            tokens.append(last[place])
            place -= len(last[place].removesuffix(self.end))
            borders.append(place)
        return borders[::-1], tokens[::-1]

    def _agreed(self, last: list[str]) -> tuple[int, list[str]]:
        """The last border that the encodings up to each of the latest places share, and the tokens up
        to it."""
        newest = len(last) - 1
        shared = set(self._chain(last, newest)[0])
        for place in range(newest - self.lookahead + 1, newest):
            shared &= set(self._chain(last, place)[0])
        border = max(shared)
        return border, self._chain(last, border)[1]

    def _word(self, word: str) -> bytes:
        if not (word.isascii() and word.isprintable()):
            word = "".join(map(self.letters.__getitem__, word.encode("utf-8", "replace")))
        found = self._short_word(word) if len(word) < 4 * self.lookahead else self.tokens(word)
        return b"".join(map(self.code.__getitem__, found))

    def _found(self, word: str) -> bytes:
        """Token ids of a word that may have been met before."""
        found = self.known.get(word)
        if found is None:
            found = self.earlier.get(word)
            if found is None:
                found = self._word(word)
            if len(word) <= KNOWN_LENGTH:
                if len(self.known) >= KNOWN_RUNS:
                    self.known, self.earlier = {}, self.known
                self.known[word] = found
        return found

    def _different(self, symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of different words, one behind the other but in any order, and where each word's are."""
        order = np.argsort(-sizes, kind="stable")
        # A few words are not worth the steps together.
        together = (sizes < 4 * self.lookahead) & (symbols[starts] != SPECIAL) & (len(sizes) >= FEW_WORDS)
        values, slots, done = [], np.zeros((len(sizes), 2), dtype=np.int64), 0
        for word in np.flatnonzero(~together).tolist():
            name = symbols[starts[word]:starts[word] + sizes[word]].tobytes().decode()
            ids = np.frombuffer(self._found(name), dtype=np.int32) if name[0] != " " else [self.special[name[1:]]]
            values.append(np.asarray(ids, dtype=np.int32))
            slots[word] = done, done + len(ids)
            done += len(ids)
        order = order[together[order]]
        for at in range(0, len(order), MANY_WORDS):
            some = order[at:at + MANY_WORDS]
            ids, borders = self.steps.tokens(symbols, starts[some], sizes[some])
            values.append(ids)
            slots[some, 0], slots[some, 1] = done + borders[:-1], done + borders[1:]
            done += len(ids)
        return np.concatenate(values), slots

    def _lines(self, lines: bytearray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of words that end in line breaks, and the borders between the words."""
        if not lines:
            return np.zeros(0, dtype=np.int32), np.zeros(1, dtype=np.int64)
        offsets = np.append(0, np.flatnonzero(np.frombuffer(lines, dtype=np.uint8) == LINE_BREAK) + 1)
        words = pa.Array.from_buffers(
            pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(lines)]).dictionary_encode()
        _, offsets, symbols = words.dictionary.buffers()
        offsets = np.frombuffer(offsets, dtype=np.int64)[:len(words.dictionary) + 1]
        values, slots = self._different(np.frombuffer(symbols, dtype=np.uint8), offsets[:-1], np.diff(offsets) - 1)
        starts, ends = slots[words.indices.to_numpy()].T
        borders = np.append(0, np.cumsum(ends - starts))
        return values[np.repeat(starts - borders[:-1], ends - starts) + np.arange(borders[-1])], borders

    def _split(self, text: str) -> Iterator[list[str]]:
        """Words of a slice of the text, or a special string behind a blank, which no word has."""
        for part in self.at_special.split(text):
            if part in self.special:
                yield [" " + part]
                continue
            for piece in _slices(part):
                if piece.isascii():
                    yield self.ascii_words.findall(piece.lower())
                else:
                    yield self.words.findall(_lower(unicodedata.normalize("NFC", piece)))

    def encoded(self, texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of whole texts, one behind the other, and the borders between the texts."""
        values, ends, done = [], [np.zeros(1, dtype=np.int64)], 0

        def write() -> None:
            nonlocal done
            found, borders = self._lines(lines)
            values.append(found)
            ends.append(done + borders[np.array(text_ends, dtype=np.int64)])
            done += len(found)

        lines, count, text_ends = bytearray(), 0, []
        for text in texts:
            for words in self._split(text or ""):
                if words:
                    lines += "\n".join([*words, ""]).encode("utf-8", "replace")
                    count += len(words)
                if len(lines) >= BLOCK:
                    write()
                    lines, count, text_ends = bytearray(), 0, []
            text_ends.append(count)
        write()
        return np.concatenate(values), np.concatenate(ends)

    def ids(self, text: str) -> np.ndarray:
        """Token ids of a whole text."""
        return self.encoded([text])[0]


class Steps:
    """A transducer's steps, taken by many words at once.

    The automaton's node at a place is the longest beginning of a token that ends there. ``longest`` and
    ``at_end`` have the longest token that ends there, inside a word and at its end, and ``shorter`` the next one
    of the same kind. Nodes that no symbol leads on from share the row of the node they fall back to.
    """

    def __init__(self, coder: Transducer):
        size, byte = max(coder.vocab.values()) + 1, {letter: b for b, letter in coder.letters.items()}
        self.coder, self.none = coder, size
        self.names = [""] * size
        self.length = np.zeros(size, dtype=np.int64)
        following: list[dict[int, int]] = [{}]
        own: dict[bool, dict[int, int]] = {False: {}, True: {}}
        for token, id_ in coder.vocab.items():
            if not coder._alone(token):
                continue
            plain, node = token.removesuffix(coder.end), 0
            for letter in plain:
                child = following[node].setdefault(byte[letter], len(following))
                if child == len(following):
                    following.append({})
                node = child
            own[plain != token][node] = id_
            self.names[id_], self.length[id_] = token, len(plain)
        self.next = np.zeros((sum(map(bool, following)), 256), dtype=np.int32)
        self.row, self.longest, self.at_end = (np.zeros(len(following), dtype=np.int32) for _ in range(3))
        self.shorter = np.full(size, -1, dtype=np.int32)
        back, queue, rows = [0] * len(following), [0], 0
        for node in queue:
            less = back[node]
            for table, ids in ((self.longest, own[False]), (self.at_end, own[True])):
                shorter = table[less] if node else -1
                table[node] = ids.get(node, shorter)
                if node in ids:
                    self.shorter[ids[node]] = shorter
            before = self.next[self.row[less]]
            if not following[node]:
                self.row[node] = self.row[less]
                continue
            self.row[node], rows = rows, rows + 1
            here = self.next[self.row[node]]
            if node:
                here[:] = before
            for symbol, child in following[node].items():
                back[child] = int(before[symbol]) if node else 0
                here[symbol] = child
                queue.append(child)
        self.fits = np.full(1 << KNOWN_FITS, -1, dtype=np.int64)

    def _fit(self, left: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Whether the merges leave each token as it is behind the left one."""
        pair = left.astype(np.int64) * (self.none + 1) + token
        place = (pair.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - KNOWN_FITS)
        known = self.fits[place]
        fit = (known & 1).astype(bool)
        unknown = np.flatnonzero(known >> 1 != pair)
        if len(unknown):
            pairs, first, which = np.unique(pair[unknown], return_index=True, return_inverse=True)
            found = np.array([
                a == self.none or not self.coder._crossed(self.names[a], self.names[b])
                for a, b in zip(*(part.tolist() for part in np.divmod(pairs, self.none + 1)))])
            fit[unknown] = found[which]
            self.fits[place[unknown[first]]] = pairs << 1 | found
        return fit

    def tokens(self, symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of the words at ``starts`` in ``symbols``, which come by falling size, and the borders between
        the words."""
        count, most = len(sizes), int(sizes[0])
        last = np.full((most + 1, count), self.none, dtype=np.int32)  # the last token up to each place
        row = np.zeros(count, dtype=np.int32)
        inside = np.searchsorted(-sizes, -np.arange(most + 2), side="right")  # words of so many symbols or more
        for place in range(1, most + 1):
            live, longer = inside[place], inside[place + 1]
            node = self.next[row[:live], symbols[starts[:live] + (place - 1)]]
            row = self.row[node]
            token = self.longest[node]
            token[longer:] = self.at_end[node[longer:]]
            open_, tried = np.arange(live), token
            while True:
                fit = self._fit(last[place - self.length[tried], open_], tried)
                if fit.all():
                    break
                open_ = open_[~fit]
                tried = self.shorter[tried[~fit]]
                if (tried < 0).any():
                    raise ValueError("no token ends at a symbol")
                token[open_] = tried
            last[place, :live] = token
        where, place, found = np.arange(count), sizes, []
        while len(where):
            token = last[place, where]
            found.append((where, token))
            place = place - self.length[token]
            where, place = where[place > 0], place[place > 0]
        borders = np.append(0, np.cumsum(np.bincount(np.concatenate([of for of, _ in found]), minlength=count)))
        values = np.empty(borders[-1], dtype=np.int32)
        for k, (of, token) in enumerate(found):
            values[borders[of + 1] - 1 - k] = token
        return values, borders


class Decoder:
    """From token ids to text. A file without a decoder joins its tokens by blanks."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        if content["decoder"] is not None:
            raise ValueError(f"{path} has a decoder of its own")
        tokens = {i: t for t, i in content["model"]["vocab"].items()}
        tokens |= {t["id"]: t["content"] for t in content["added_tokens"]}
        self.pieces = {i: t.encode() for i, t in tokens.items()}

    def stream(self, ids: Iterable[int], block: int = 4096) -> Iterator[str]:
        """Text of the ids, as far as it is complete, block by block. Unknown ids are left out."""
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        ids, glue = iter(ids), b""
        while some := list(islice(ids, block)):
            pieces = [p for p in map(self.pieces.get, some) if p is not None]
            if pieces:
                yield machine.decode(glue + b" ".join(pieces))
                glue = b" "
        yield machine.decode(b"", final=True)

    def text(self, ids: Iterable[int]) -> str:
        return "".join(self.stream(ids))


@cache
def transducer(path: str) -> Transducer:
    """One per Python worker."""
    return Transducer(path)


@cache
def decoder(path: str) -> Decoder:
    """One per Python worker."""
    return Decoder(path)


def _encoded(texts: pa.Array, path: str) -> pa.Array:
    values, ends = transducer(path).encoded(value.as_py() for value in texts)
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values))


def _decoded(lists: pa.Array, path: str) -> pa.Array:
    # Written one behind the other, so that a batch's texts are held once.
    texts, ends = bytearray(), array("q", [0])
    for value in lists:
        if value.is_valid:
            for part in decoder(path).stream(value.values.to_numpy(zero_copy_only=False).tolist()):
                texts += part.encode("utf-8")
        ends.append(len(texts))
    long = pa.LargeStringArray.from_buffers(len(lists), pa.py_buffer(ends), pa.py_buffer(texts))
    return long.cast(pa.string())


def encode(text: Column, path: str) -> Column:
    """Token ids of ``text`` under the vocabulary file ``path``, which every executor can read."""
    @F.arrow_udf("array<int>")
    def encoded(texts: pa.Array) -> pa.Array:
        return _encoded(texts, path)

    return encoded(text)


def decode(ids: Column, path: str) -> Column:
    """Text of token ids under the vocabulary file ``path``."""
    @F.arrow_udf("string")
    def decoded(lists: pa.Array) -> pa.Array:
        return _decoded(lists, path)

    return decoded(ids)


def encode_and_decode(text: Column, path: str) -> Column:
    """``(ids, text)``: ``encode`` of ``text`` and ``decode`` of that. Of the two columns beside each other Spark
    would make two, the second with an encoding of its own."""
    @F.arrow_udf("struct<ids: array<int>, text: string>")
    def coded(texts: pa.Array) -> pa.Array:
        ids = _encoded(texts, path)
        return pa.StructArray.from_arrays([ids, _decoded(ids, path)], names=["ids", "text"])

    return coded(text)
