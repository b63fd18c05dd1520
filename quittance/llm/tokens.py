"""A public tokenizer over whole Arrow columns, with a bounded memory of pieces of text.

The tokenizer of ``word_bpe_49k.json`` drops white space and cuts words into pieces (runs of
letters, single digits, runs of other signs) before it merges, and merges never cross a piece.
So a text's ids are its pieces' ids in order, and a piece needs the tokenizer once. Numpy cuts
a batch of texts into pieces, looks all of them up at once, and only unknown ones go to the
tokenizer's model.

Only words made of ASCII and Latin-1 letters, digits and signs are cut here. A word with
anything else (other scripts, combining marks, apostrophes, which begin contractions, or text
that looks like a special token) is one piece and goes through the whole tokenizer; white
space on both sides keeps that exact. ``checked`` compares both ways over all signs that are
cut here, and refuses a tokenizer file for which they differ.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import lru_cache
from typing import NamedTuple

import numpy as np
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

WORD_BPE = "word_bpe_49k.json"

#: Pieces remembered by one worker, about 40 bytes each.
LIMIT = 1 << 19

_ODD, _LETTER, _DIGIT, _SIGN = range(4)
_KIND = np.zeros(256, np.uint8)
_KIND[0x21:0x7F] = _SIGN
_KIND[ord("0") : ord("9") + 1] = _DIGIT
_KIND[ord("a") : ord("z") + 1] = _KIND[ord("A") : ord("Z") + 1] = _LETTER
_KIND[ord("'")] = _ODD
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
#: First byte of U+00C0 to U+00FF, whose second bytes are letters but for two signs.
_LATIN = 0xC3
_LATIN_SIGNS = (0x97, 0xB7)
_SHARP_S = 0x9F

_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_APART = np.uint64(0xA0761D6478BD642F)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(WORD_BPE)


@lru_cache(maxsize=4)
def load(path: str) -> Tokenizer:
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def encode(tokenizer: Tokenizer, text: bytes) -> list[int]:
    """The ids of one text, all by the tokenizer."""
    return tokenizer.encode(text.decode("utf-8"), add_special_tokens=False).ids


@lru_cache(maxsize=4)
def id_texts(path: str) -> list[str]:
    """The text of each id."""
    tokenizer = load(path)
    return [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size(with_added_tokens=True))]


def decode(path: str, ids: Iterable[int]) -> str:
    """What the tokenizer's decode gives: it names no decoder, so tokens are joined by spaces."""
    known = id_texts(path)
    return " ".join([known[i] for i in ids])


class Pieces(NamedTuple):
    starts: np.ndarray  # of the pieces
    ends: np.ndarray
    words: np.ndarray  # the number of the first piece of each word, and at last how many there are
    odd: np.ndarray  # whole words that only the tokenizer may cut
    first: np.ndarray  # two hashes
    second: np.ndarray


class Encoded(NamedTuple):
    ids: np.ndarray
    texts: np.ndarray  # where each text's ids begin, and at last how many ids there are
    words: np.ndarray  # the same for words
    spans: np.ndarray  # where each word begins and ends in the bytes


@lru_cache(maxsize=2)
def _powers(base: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of an odd base modulo 2^64 and of its inverse."""
    made = []
    for factor in (base, pow(base, -1, 1 << 64)):
        steps = np.full(length + 1, factor, np.uint64)
        steps[0] = 1
        made.append(np.multiply.accumulate(steps))
    return made[0], made[1]


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    length = 1 << max(19, int(len(data)).bit_length())
    up, down = _powers(base, length)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * down[starts]
    hashes ^= hashes >> np.uint64(31)
    hashes *= _MIX
    return hashes ^ (hashes >> np.uint64(29))


def _solid(data: np.ndarray) -> np.ndarray:
    return ~((data == 32) | ((data >= 9) & (data <= 13)))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of texts begin and end; white space is that of bytes.split()."""
    solid = _solid(data)
    begins, ends = solid.copy(), solid.copy()
    inner = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
    begins[1:] &= ~solid[:-1]
    begins[inner] |= solid[inner]
    ends[:-1] &= ~solid[1:]
    ends[inner - 1] |= solid[inner - 1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def cut_pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[Pieces, np.ndarray, np.ndarray]:
    """The pieces, the text that they are hashed by (lower case where cut here), the words' spans."""
    begins, stops = word_spans(data, offsets)
    solid = _solid(data)
    kind, text = _KIND[data], _LOWER[data]
    if len(data) and data.max() >= 0x80:
        lead = data == _LATIN
        after = np.zeros(len(data), bool)
        after[1:] = lead[:-1]
        letter = lead | after & (data >= 0x80) & (data < 0xC0)
        kind[letter & ~(after & np.isin(data, _LATIN_SIGNS))] = _LETTER
        text[after & (data >= 0x80) & (data < _SHARP_S) & (data != _LATIN_SIGNS[0])] += 32
    odd = solid & (kind == _ODD)
    if len(data) > 1:
        odd[:-1] |= (data[:-1] == ord("<")) & (data[1:] == ord("|"))
    odd_words = np.zeros(len(begins), bool)
    odd_words[np.searchsorted(begins, np.flatnonzero(odd), "right") - 1] = True

    new = np.zeros(len(data), bool)
    new[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    if odd_words.any():
        marks = np.zeros(len(data) + 1, np.int8)
        marks[begins[odd_words]] = 1
        marks[stops[odd_words]] -= 1
        whole = np.cumsum(marks[:-1], dtype=np.int8) > 0
        new &= ~whole
        text = np.where(whole, data, text)
    new &= solid
    new[begins] = True
    starts = np.flatnonzero(new)
    first = np.searchsorted(starts, begins)
    counts = np.diff(np.append(first, len(starts)))
    ends = np.append(starts[1:], len(data))
    ends = np.minimum(ends, np.repeat(stops, counts))
    one, two = (hash_spans(text, starts, ends, base) for base in _BASES)
    is_odd = np.repeat(odd_words, counts)
    one[is_odd] ^= _APART
    one[one == 0] = 1
    return Pieces(starts, ends, np.append(first, len(starts)), is_odd, one, two), text, np.stack([begins, stops], 1)


class Encoder:
    """Texts to ids; remembers at most ``limit`` pieces, in a table of open addresses."""

    def __init__(self, path: str, limit: int = LIMIT) -> None:
        self.tokenizer = load(path)
        self.model, self.limit = self.tokenizer.model, limit
        self.signs = {ord(c): c for c in ByteLevel.alphabet() if ord(c) < 256}
        spare = iter(sorted(c for c in ByteLevel.alphabet() if ord(c) >= 256))
        self.signs |= {b: next(spare) for b in range(256) if b not in self.signs}
        self.bits = max(10, (2 * limit - 1).bit_length())
        self.forget()

    def forget(self) -> None:
        size = 1 << self.bits
        self.keys, self.others = np.zeros(size, np.uint64), np.zeros(size, np.uint64)
        self.places = np.zeros(size, np.int32)
        self.count, self.used = 0, 0
        self.begin, self.length = np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int32)
        self.pool = np.zeros(1 << 18, np.int32)

    def look_up(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """The number of each piece, -1 for unknown ones."""
        found = np.full(len(one), -1, np.int32)
        slots = (one >> np.uint64(64 - self.bits)).astype(np.int64)
        left = np.arange(len(one))
        while len(left):
            at = slots[left]
            keys = self.keys[at]
            hit = (keys == one[left]) & (self.others[at] == two[left])
            found[left[hit]] = self.places[at[hit]]
            left = left[~hit & (keys != 0)]
            slots[left] = (slots[left] + 1) & ((1 << self.bits) - 1)
        return found

    def remember(self, one: np.ndarray, two: np.ndarray, ids: list[list[int]]) -> None:
        lengths = np.fromiter(map(len, ids), np.int32, len(ids))
        flat = np.fromiter((i for x in ids for i in x), np.int32, int(lengths.sum()))
        for name, size in (("begin", self.count + len(ids)), ("length", self.count + len(ids)), ("pool", self.used + len(flat))):
            if size > len(array := getattr(self, name)):
                setattr(self, name, np.concatenate([array, np.zeros(max(size, len(array)), np.int32)]))
        places = np.arange(self.count, self.count + len(ids), dtype=np.int32)
        self.length[places] = lengths
        self.begin[places] = self.used + np.cumsum(lengths) - lengths
        self.pool[self.used : self.used + len(flat)] = flat
        self.used, self.count = self.used + len(flat), self.count + len(ids)
        slots, left = (one >> np.uint64(64 - self.bits)).astype(np.int64), np.arange(len(one))
        while len(left):
            free = left[self.keys[slots[left]] == 0]
            won = free[np.unique(slots[free], return_index=True)[1]]
            self.keys[slots[won]], self.others[slots[won]], self.places[slots[won]] = one[won], two[won], places[won]
            left = np.setdiff1d(left, won, assume_unique=True)
            slots[left] = (slots[left] + 1) & ((1 << self.bits) - 1)

    def piece_ids(self, piece: bytes, odd: bool) -> list[int]:
        if odd:
            return encode(self.tokenizer, piece)
        text = piece.decode("ascii") if piece.isascii() else piece.decode("latin-1").translate(self.signs)
        return [t.id for t in self.model.tokenize(text)]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> Encoded:
        """The ids of the texts between ``offsets`` in ``data``, UTF-8."""
        pieces, text, spans = cut_pieces(data, offsets)
        found = self.look_up(pieces.first, pieces.second)
        unknown = np.flatnonzero(found < 0)
        if len(unknown):
            _, at = np.unique(pieces.first[unknown], return_index=True)
            if self.count + len(at) > self.limit:
                self.forget()
                unknown = np.arange(len(found))
                _, at = np.unique(pieces.first, return_index=True)
            new, whole = unknown[at], text.tobytes()
            ids = [
                self.piece_ids(whole[a:b], odd)
                for a, b, odd in zip(
                    pieces.starts[new].tolist(), pieces.ends[new].tolist(), pieces.odd[new].tolist(), strict=True
                )
            ]
            if len(new) > self.limit:  # one text with more pieces than are remembered
                return self._at_once(data, offsets)
            self.remember(pieces.first[new], pieces.second[new], ids)
            found[unknown] = self.look_up(pieces.first[unknown], pieces.second[unknown])
            if (found < 0).any():  # two pieces with one hash but not the other
                return self._at_once(data, offsets)
        lengths = self.length[found]
        stops = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
        ids = self.pool[np.repeat(self.begin[found] - stops[:-1], lengths) + np.arange(stops[-1])]
        return Encoded(ids, stops[np.searchsorted(pieces.starts, offsets)], stops[pieces.words], spans)

    def _at_once(self, data: np.ndarray, offsets: np.ndarray) -> Encoded:
        begins, ends = word_spans(data, offsets)
        whole = data.tobytes()
        ids = [encode(self.tokenizer, whole[a:b]) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
        stops = np.cumsum([0, *map(len, ids)])
        flat = np.array([i for x in ids for i in x], np.int32)
        return Encoded(flat, stops[np.searchsorted(begins, offsets)], stops, np.stack([begins, ends], 1))


@lru_cache(maxsize=4)
def checked(path: str) -> None:
    """Raise unless pieces cut here get the tokenizer's ids for whole texts, and it names no decoder."""
    signs = [chr(c) for c in [*range(0x21, 0x7F), *range(0xC0, 0x100)]]
    text = " ".join([*signs, *map("a{0}Ab{0}{0}1{0}".format, signs), "don't", "é x", "<|endoftext|>a \t\r\n"])
    data = np.frombuffer(text.encode("utf-8"), np.uint8)
    same = Encoder(path, 1 << 12).encode(data, np.array([0, len(data)])).ids.tolist() == encode(load(path), data.tobytes())
    if not same or load(path).decoder:
        raise ValueError(f"{path} doesn't cut words as this encoder does")


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """This worker's encoder; tasks that follow find it filled."""
    return Encoder(path)
