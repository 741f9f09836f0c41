"""Words, lines and five-word shingles of many texts at once, on their UTF-8 bytes.

A word is a maximal run of bytes other than space and \\x09-\\x0D. Hashes are 64 bits wide, those in shingle sets
52; equal hashes count as equal words, lines and shingles.
"""

from __future__ import annotations

import numpy as np

SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BASE = np.uint64(0x9E3779B97F4A7C15)
STEP = np.uint64(0xD6E8FEB86659FD93)
SHINGLE_BITS = np.uint64(52)  # the other 12 number the texts of a slice, see arrow.SLICE_ROWS


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads them evenly."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def run_hashes(data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Hash of each run of bytes; ``data`` holds the runs one after the other."""
    if not len(lengths):
        return np.zeros(0, np.uint64)
    first = np.cumsum(lengths) - lengths
    inside = np.arange(len(data)) - np.repeat(first, lengths)
    data = data.astype(np.uint64)
    data += np.uint64(1)
    data *= powers(BASE, int(lengths.max()))[inside]
    sums = np.zeros(len(lengths), np.uint64)
    some = lengths > 0
    sums[some] = np.add.reduceat(data, first[some])
    return mix(sums ^ (lengths.astype(np.uint64) * STEP))


class Words:
    """The words of the texts values[offsets[i]:offsets[i + 1]], in order."""

    def __init__(self, values: np.ndarray, offsets: np.ndarray, lower: bool = False):
        self.values = LOWER[values] if lower else values
        self.offsets, self.texts = offsets, len(offsets) - 1
        inside = ~SPACE[values]
        begin = inside.copy()
        begin[1:] &= ~inside[:-1]
        heads = offsets[:-1][offsets[:-1] < offsets[1:]]
        begin[heads] |= inside[heads]
        stop = inside.copy()
        stop[:-1] &= ~inside[1:]
        tails = offsets[1:][offsets[:-1] < offsets[1:]] - 1
        stop[tails] |= inside[tails]
        self.starts = np.flatnonzero(begin)
        self.lengths = np.flatnonzero(stop) + 1 - self.starts
        self.inside = inside
        # words of text i are first[i] to first[i + 1]
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)
        self.text_of = np.repeat(np.arange(self.texts), self.counts)

    def hashes(self) -> np.ndarray:
        return run_hashes(self.values[self.inside], self.lengths)

    def shingles(self, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
        """(hash, index of the first word) of all windows of ``width`` words inside a text, in order."""
        words = self.hashes()
        if len(words) < width:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        n = len(words) - width + 1
        total = np.zeros(n, np.uint64)
        factor = powers(STEP, width)
        for j in range(width):
            total += words[j:j + n] * factor[j]
        at = np.flatnonzero(self.text_of[:n] == self.text_of[width - 1:])
        return mix(total[at]), at

    def shingle_sets(self, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
        """Distinct shingle hashes of each text, ascending, one after the other, and int64 offsets.

        A text of fewer words has its whole word sequence as its only shingle; a text without words has none.
        """
        shingle, at = self.shingles(width)
        text = self.text_of[at] if len(at) else np.zeros(0, np.int64)
        short = np.flatnonzero((self.counts > 0) & (self.counts < width))
        if len(short):
            words, factor = self.hashes(), powers(STEP, width)
            whole = np.zeros(len(short), np.uint64)
            for j in range(width - 1):
                has = self.counts[short] > j
                whole[has] += words[self.first[short[has]] + j] * factor[j]
            whole = mix(whole ^ self.counts[short].astype(np.uint64))
            shingle, text = np.concatenate([shingle, whole]), np.concatenate([text, short])
        key = np.sort((text.astype(np.uint64) << SHINGLE_BITS) | (shingle >> (np.uint64(64) - SHINGLE_BITS)))
        keep = np.ones(len(key), bool)
        keep[1:] = key[1:] != key[:-1]
        key = key[keep]
        bounds = np.searchsorted(key, np.arange(self.texts, dtype=np.uint64) << SHINGLE_BITS)
        return key & ((np.uint64(1) << SHINGLE_BITS) - np.uint64(1)), np.append(bounds, len(key))

    def repeated_words(self, width: int = 5) -> np.ndarray:
        """Words of each text that lie in a window of ``width`` words found twice or more in that text."""
        shingle, at = self.shingles(width)
        out = np.zeros(self.texts, np.int64)
        if not len(at):
            return out
        key = mix(shingle ^ mix(self.text_of[at].astype(np.uint64) + np.uint64(1)))
        twice = repeated(key)
        change = np.zeros(len(self.starts) + 1, np.int64)
        change[at[twice]] += 1
        change[at[twice] + width] -= 1
        covered = np.cumsum(change)[:-1] > 0
        return np.bincount(self.text_of[covered], minlength=self.texts).astype(np.int64)


def repeated(key: np.ndarray) -> np.ndarray:
    """Which entries have an equal entry elsewhere."""
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    out = np.zeros(len(key), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def duplicate_lines(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Lines of each text, split at \\n, that hold a word and equal an earlier line of that text."""
    texts = len(offsets) - 1
    if not len(values):
        return np.zeros(texts, np.int64)
    begin = np.zeros(len(values) + 1, bool)
    begin[1:] = values == 10
    begin[offsets[:-1]] = True
    starts = np.flatnonzero(begin[:-1])
    ends = np.append(starts[1:], len(values))
    text = np.searchsorted(offsets, starts, "right") - 1
    lengths = ends - starts
    lengths -= values[ends - 1] == 10
    word = np.logical_or.reduceat(~SPACE[values], starts)
    hashes = run_hashes(values[values != 10], lengths)[word]
    text = text[word]
    key = mix(hashes ^ mix(text.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key, kind="stable")
    again = order[1:][key[order][1:] == key[order][:-1]]
    return np.bincount(text[again], minlength=texts).astype(np.int64)


def counted(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flags are set in each text."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]
