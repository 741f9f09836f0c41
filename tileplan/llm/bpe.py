"""Byte-level BPE of many texts at once.

The tokenizer cuts a text into pieces and encodes each piece by itself. Here numpy finds the pieces of a whole slice
and the ids of a piece are looked up; pieces not seen before go to the tokenizers library. Texts with characters
outside the table below go to the library whole, so the ids are always its own. Pieces are told apart by 64-bit hashes.
"""

from __future__ import annotations

import os
import unicodedata
from functools import lru_cache

import numpy as np

from tileplan.llm.words import BASE, STEP, mix, powers

# Unicode white space below U+2500.
WHITE = [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F]
KNOWN = 0x2500  # code points below it are classed here; unassigned ones are not
OTHER, LETTER, NUMBER, BLANK, UNKNOWN, NOTHING = range(6)
CACHED_PIECES = 2_000_000


def _byte_signs() -> dict[int, str]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the others from
    U+0100 upwards."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


BYTE_SIGNS = _byte_signs()


def _classes() -> np.ndarray:
    kind = {"L": LETTER, "N": NUMBER}
    out = np.full(KNOWN + 1, UNKNOWN, np.uint8)
    for code in range(KNOWN):
        name = unicodedata.category(chr(code))
        if name != "Cn":
            out[code] = kind.get(name[0], OTHER)
    out[WHITE] = BLANK
    return out


CLASSES = _classes()


def piece_starts(codes: np.ndarray, kinds: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where pieces begin: runs of letters, numbers or others, each with one space before, white space, and the English
    endings 's 't 're 've 'm 'll 'd. ``first`` marks the first character of each text."""
    n = len(codes)
    blank = kinds == BLANK
    before = np.empty(n, np.uint8)
    before[0], before[1:] = NOTHING, kinds[:-1]
    before[first] = NOTHING
    after_space = np.zeros(n, bool)
    after_space[1:] = codes[:-1] == 32
    after_space[first] = False
    solid_next = np.zeros(n, bool)
    solid_next[:-1] = ~blank[1:] & ~first[1:]
    starts = np.where(blank, solid_next | (before != BLANK), (before != kinds) & ~after_space)
    for i in np.flatnonzero((codes == 39) & starts):
        tail = ""
        for j in (i + 1, i + 2):
            if j >= n or first[j]:
                break
            tail += chr(codes[j])
        size = 1 if tail[:1] in ("s", "t", "m", "d") and tail else 2 if tail in ("re", "ve", "ll") else 0
        if size:
            starts[i + 1] = False
            if i + 1 + size < n:
                starts[i + 1 + size] = True
    return starts


class Encoder:
    """Ids of the texts of a slice; keeps the ids of pieces between slices."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.dtype = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self.forget()

    def forget(self) -> None:
        self.keys, self.places = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # sorted hashes of pieces, their numbers
        self.flat, self.bounds = np.zeros(0, self.dtype), np.zeros(1, np.int64)

    def learn(self, keys: np.ndarray, pieces: list[str]) -> None:
        """Add the ids of pieces whose hashes are ``keys`` (ascending, all new)."""
        tokenize, ids, ends = self.tokenizer.model.tokenize, [], []
        for piece in pieces:
            ids += [t.id for t in tokenize(piece.encode("utf-8").decode("latin-1").translate(BYTE_SIGNS))]
            ends.append(len(ids))
        at = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, at, keys)
        self.places = np.insert(self.places, at, len(self.bounds) - 1 + np.arange(len(keys)))
        self.bounds = np.concatenate([self.bounds, np.array(ends, np.int64) + len(self.flat)])
        self.flat = np.concatenate([self.flat, np.array(ids, self.dtype)])

    def encode(self, values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, int64 offsets of the texts in them)."""
        texts = len(offsets) - 1
        if not len(values):
            return np.zeros(0, self.dtype), np.zeros(texts + 1, np.int64)
        whole = values.tobytes().decode("utf-8")
        codes = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        chars = np.concatenate([[0], np.cumsum((values & 0xC0) != 0x80)])[offsets]
        kinds = CLASSES[np.minimum(codes, KNOWN)]
        first = np.zeros(len(codes), bool)
        first[chars[:-1][chars[:-1] < chars[1:]]] = True
        at = np.flatnonzero(piece_starts(codes, kinds, first))
        lengths = np.diff(np.append(at, len(codes)))
        data = codes.astype(np.uint64) + np.uint64(1)
        data *= powers(BASE, int(lengths.max()))[np.arange(len(codes)) - np.repeat(at, lengths)]
        key = mix(np.add.reduceat(data, at) ^ (lengths.astype(np.uint64) * STEP))
        keys, sample, inverse = np.unique(key, return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > CACHED_PIECES:
            self.forget()
        near = np.searchsorted(self.keys, keys)
        new = np.append(self.keys, np.uint64(0))[near] != keys
        new |= near == len(self.keys)
        begin, end = at[sample[new]], at[sample[new]] + lengths[sample[new]]
        self.learn(keys[new], [whole[a:b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)])
        place = self.places[np.searchsorted(self.keys, keys)][inverse]
        size = self.bounds[place + 1] - self.bounds[place]
        ends = np.cumsum(size)
        ids = self.flat[np.arange(ends[-1]) + np.repeat(self.bounds[place] - (ends - size), size)]
        # the number of pieces before each text gives its bounds
        out = np.concatenate([[0], ends])[np.searchsorted(at, chars)]
        odd = np.unique(np.searchsorted(chars, np.flatnonzero(kinds == UNKNOWN), "right") - 1)
        if len(odd):
            parts = [ids[out[i]:out[i + 1]] for i in range(texts)]
            for i in odd:
                text = whole[chars[i]:chars[i + 1]]
                parts[i] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype)
            out = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
            ids = np.concatenate(parts)
        return ids, out


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker process."""
    return Encoder(path)


def with_end(ids: np.ndarray, offsets: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's ids followed by the id ``end``."""
    out = np.full(len(ids) + len(offsets) - 1, end, ids.dtype)
    out[np.arange(len(ids)) + np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))] = ids
    return out, offsets + np.arange(len(offsets))
