"""Token ids of whole texts by a public tokenizer, remembering the ids of text pieces.

Both tokenizers split a text into words before anything else, and encode each word by itself. So a
text may be cut where such a split is certain, and the ids of its pieces joined. Words repeat, so a
worker encodes each piece once and looks it up from then on: cutting, hashing and lookup are numpy
steps over the bytes of many texts. Cuts are made only where they hold for any text; all between
two cuts goes to the tokenizer as it is. The tests compare the ids with those of whole texts.

Strings of special tokens within a text are these tokens, as the library has it by default. A text
with one is encoded whole, outside of the memory of pieces.

Pieces are known by 128 hash bits: two polynomials over random values of the bytes, and a digest
for the long ones. The memory is bounded: beyond ``MOST_PIECES`` it starts anew.
"""

from __future__ import annotations

import hashlib
import os
from functools import lru_cache
from typing import NamedTuple

import numpy as np

WORD_BPE, BYTE_BPE = "word_bpe_49k.json", "byte_bpe_50k.json"
MOST_PIECES = 1 << 20
# Pieces that one call of the tokenizer gets as one text.
JOINED = 256
# Longer pieces are known by a digest.
SHORT = 64

_U = np.uint64


# What a byte is, as bits: a letter or digit of ASCII; punctuation of ASCII but the apostrophe,
# which starts contractions; the start of a character that is certainly no white space; a space or
# newline; an upper-case letter of ASCII; part of a character beyond ASCII.
_ALNUM, _MARK, _SOLID, _GAP, _UPPER, _WIDE = (1 << i for i in range(6))
_KIND = np.zeros(256, np.uint8)
for _kind, _ranges in (
    (_ALNUM, ((48, 57), (65, 90), (97, 122))),
    (_MARK, ((33, 38), (40, 47), (58, 64), (91, 96), (123, 126))),
    (_SOLID, ((33, 126), (0xC3, 0xE0), (0xE4, 0xF4))),
    (_GAP, ((32, 32), (10, 10))),
    (_UPPER, ((65, 90),)),
    (_WIDE, ((128, 255),)),
):
    for _low, _high in _ranges:
        _KIND[_low : _high + 1] |= _kind


class Encoded(NamedTuple):
    """The ids of all texts after another, and how many each text has."""

    ids: np.ndarray
    lengths: np.ndarray


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(31))) * _U(0x9E3779B97F4A7C15)
    return h ^ (h >> _U(29))


class _Polynomials:
    """Hashes of many ranges of one byte array, from running sums modulo 2**64."""

    def __init__(self, seed: int) -> None:
        random = np.random.default_rng(seed)
        self._values = random.integers(1, 1 << 63, 256, np.uint64)
        self._base = int(random.integers(1 << 20, 1 << 62)) | 1
        self._powers = self._inverses = np.ones(1, np.uint64)

    def _grow(self, size: int) -> None:
        if size > len(self._powers):
            size = max(size, 2 * len(self._powers))
            inverse = pow(self._base, -1, 1 << 64)
            for name, base in (("_powers", self._base), ("_inverses", inverse)):
                steps = np.full(size, base & (2**64 - 1), np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))

    def of(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        self._grow(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self._values[data] * self._powers[: len(data)], out=sums[1:])
        return _mixed((sums[ends] - sums[starts]) * self._inverses[starts])


class _Numbers:
    """A hash table in arrays: 128-bit key to the number of a piece, for many keys at once."""

    def __init__(self) -> None:
        size = 2 * MOST_PIECES
        self._mask = _U(size - 1)
        self._first = np.zeros(size, np.uint64)
        self._second = np.zeros(size, np.uint64)
        self._number = np.full(size, -1, np.int32)
        self.count = 0

    def find(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The number of each key, -1 where it is unknown."""
        found = np.full(len(first), -1, np.int64)
        open_ = np.arange(len(first))
        slot = (first & self._mask).astype(np.int64)
        while len(open_):
            number = self._number[slot]
            hit = (self._first[slot] == first[open_]) & (self._second[slot] == second[open_])
            hit &= number >= 0
            found[open_[hit]] = number[hit]
            on = ~hit & (number >= 0)
            open_, slot = open_[on], (slot[on] + 1) & int(self._mask)
        return found

    def add(self, first: np.ndarray, second: np.ndarray) -> None:
        """Number new distinct keys in their order."""
        numbers = np.arange(self.count, self.count + len(first), dtype=np.int32)
        self.count += len(first)
        open_ = np.arange(len(first))
        slot = (first & self._mask).astype(np.int64)
        while len(open_):
            free = self._number[slot] < 0
            # Of several keys for a free slot the last one written wins.
            self._number[slot[free]] = numbers[open_[free]]
            won = self._number[slot] == numbers[open_]
            self._first[slot[won]], self._second[slot[won]] = first[open_[won]], second[open_[won]]
            on = ~won
            open_, slot = open_[on], (slot[on] + 1) & int(self._mask)


class Encoder:
    """With ``special``, strings of special tokens are these tokens, otherwise ordinary text."""

    def __init__(self, path: str, special: bool = False) -> None:
        # A task has one core.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        # Above all ids.
        self.vocabulary = max(self._tokenizer.get_vocab(with_added_tokens=True).values(), default=0) + 1
        self._tokenizer.encode_special_tokens = not special
        own = self._tokenizer.get_added_tokens_decoder().values()
        self._specials = [t.content for t in own if t.special] if special else []
        self._drops_space = not self._ids_of("  ")
        self._ignores_case = self._ids_of("Word") == self._ids_of("word")
        if self._drops_space:
            # A word of its own between two pieces marks their border.
            self._separator, self._joiner, self._joint = "|", " | ", self._tokenizer
        else:
            self._joint = Tokenizer.from_file(path)
            added = self._joint.get_added_tokens_decoder().values()
            self._separator = self._joiner = next(t.content for t in added if t.special)
        border = self._joint.encode(self._joiner, add_special_tokens=False).ids
        if len(border) != 1:
            raise ValueError("the tokenizer has no id that marks borders")
        self._border = border[0]
        self._hashes = _Polynomials(1), _Polynomials(2)
        self._reset()

    def _ids_of(self, text: str) -> list[int]:
        return self._tokenizer.encode(text, add_special_tokens=False).ids

    def _reset(self) -> None:
        self._numbers = _Numbers()
        self._ids = np.empty(1 << 16, np.uint32)
        self._n_ids = 0
        self._starts = np.empty(1 << 14, np.int64)
        self._lengths = np.empty(1 << 14, np.int64)

    def _pieces(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The bytes of all texts, start and end of each piece, and the pieces of each text."""
        data = np.frombuffer(b"".join(texts), np.uint8)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        counts = np.zeros(len(texts), np.int64)
        if not len(data):
            return data, counts[:0], counts[:0], counts
        text_starts = (np.cumsum(sizes) - sizes)[sizes > 0]
        kind = _KIND[data]
        before, here = kind[:-1], kind[1:]
        cut = np.zeros(len(data), bool)
        # Between a word and punctuation, either way round.
        cut[1:] = (before | here) & (_ALNUM | _MARK) == _ALNUM | _MARK
        cut[1:] &= before & (_ALNUM | _MARK) != 0
        cut[1:] &= here & (_ALNUM | _MARK) != 0
        # A space belongs to the word that follows it, in the same text.
        leads = (before & _GAP != 0) & (here & _SOLID != 0)
        leads[text_starts[1:] - 1] = False
        cut[:-1] |= leads
        cut[text_starts] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(data))
        counts[sizes > 0] = np.diff(np.append(np.searchsorted(starts, text_starts), len(starts)))
        if self._ignores_case:
            # Only in pieces of ASCII, where case has nothing to do with composed characters.
            plain = np.bitwise_or.reduceat(kind, starts) & _WIDE == 0
            upper = np.repeat(plain, ends - starts) & (kind & _UPPER != 0)
            data = data + upper.astype(np.uint8) * np.uint8(32)
        if self._drops_space:
            starts = starts + (kind[starts] & _GAP != 0)
        return data, starts, ends, counts

    def _encode_pieces(self, pieces: list[str]) -> list[np.ndarray]:
        found: list[np.ndarray | None] = [None] * len(pieces)
        plain = [i for i, piece in enumerate(pieces) if self._separator not in piece]
        rest = [i for i, piece in enumerate(pieces) if self._separator in piece]
        groups = [plain[i : i + JOINED] for i in range(0, len(plain), JOINED)]
        joined = self._joint.encode_batch_fast(
            [self._joiner.join([pieces[i] for i in group]) for group in groups],
            add_special_tokens=False,
        )
        for group, encoding in zip(groups, joined):
            ids = np.array(encoding.ids, np.uint32)
            borders = np.flatnonzero(ids == self._border).tolist()
            starts, ends = [0, *(b + 1 for b in borders)], [*borders, len(ids)]
            for i, start, end in zip(group, starts, ends, strict=True):
                found[i] = ids[start:end]
        alone = self._tokenizer.encode_batch_fast(
            [pieces[i] for i in rest], add_special_tokens=False
        )
        for i, encoding in zip(rest, alone):
            found[i] = np.array(encoding.ids, np.uint32)
        return found

    def _learn(self, pieces: list[str]) -> None:
        found = self._encode_pieces(pieces)
        last = self._numbers.count
        first = last - len(pieces)
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        total = self._n_ids + int(lengths.sum())
        self._ids = _grown(self._ids, total)
        self._starts, self._lengths = _grown(self._starts, last), _grown(self._lengths, last)
        self._ids[self._n_ids : total] = np.concatenate(found)
        self._lengths[first:last] = lengths
        self._starts[first:last] = self._n_ids + np.cumsum(lengths) - lengths
        self._n_ids = total

    def _keys(
        self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        sizes = (ends - starts).astype(np.uint64)
        first, second = (hashes.of(data, starts, ends) + sizes for hashes in self._hashes)
        for i in np.flatnonzero(sizes > SHORT):
            digest = hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=16).digest()
            first[i], second[i] = np.frombuffer(digest, np.uint64)
        return first, second

    def _numbered(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        first, second = self._keys(data, starts, ends)
        numbers = self._numbers.find(first, second)
        missing = np.flatnonzero(numbers < 0)
        while len(missing):
            _, which = np.unique(first[missing], return_index=True)
            new = missing[which]
            self._numbers.add(first[new], second[new])
            self._learn(
                [
                    data[start:end].tobytes().decode()
                    for start, end in zip(starts[new].tolist(), ends[new].tolist())
                ]
            )
            numbers[missing] = self._numbers.find(first[missing], second[missing])
            # Again only if two keys agree in their first half.
            missing = np.flatnonzero(numbers < 0)
        return numbers

    def encode(self, texts: list[str]) -> Encoded:
        """The ids of each whole text, without adding special tokens."""
        alone = [any(special in text for special in self._specials) for text in texts]
        if not any(alone):
            return self._joined(texts)
        ids, lengths = self._joined(["" if whole else text for whole, text in zip(alone, texts)])
        found = np.split(ids, np.cumsum(lengths)[:-1])
        for i, whole in enumerate(alone):
            if whole:
                found[i] = np.array(self._ids_of(texts[i]), np.uint32)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return Encoded(np.concatenate(found), sizes)

    def _joined(self, texts: list[str]) -> Encoded:
        """The ids of each text, from those of its pieces."""
        data, starts, ends, counts = self._pieces([text.encode() for text in texts])
        found, sizes = [np.empty(0, np.uint32)], [np.zeros(1, np.int64)]
        # Blocks keep the table at most half full, also for one very long text.
        for i in range(0, len(starts), MOST_PIECES // 2):
            block = slice(i, i + MOST_PIECES // 2)
            if self._numbers.count + len(starts[block]) > MOST_PIECES:
                self._reset()
            numbers = self._numbered(data, starts[block], ends[block])
            lengths = self._lengths[numbers]
            shift = np.repeat(self._starts[numbers] - (np.cumsum(lengths) - lengths), lengths)
            found.append(self._ids[shift + np.arange(len(shift))])
            sizes.append(lengths)
        before = np.cumsum(np.concatenate(sizes))
        last = np.cumsum(counts)
        return Encoded(np.concatenate(found), before[last] - before[last - counts])


def _grown(array: np.ndarray, size: int) -> np.ndarray:
    if size <= len(array):
        return array
    larger = np.empty(max(size, 2 * len(array)), array.dtype)
    larger[: len(array)] = array
    return larger


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """The worker's encoder, kept between tasks, with the library's default for special tokens."""
    return Encoder(path, special=True)


def tokenizer_path(name: str) -> str:
    """Where the installed tokenizer files lie."""
    import public_tokenizers

    return public_tokenizers.path(name)
