"""Words of many texts at once, as arrays: bounds, hashes, hashes of windows.

A word is found in the UTF-8 bytes, so the class of its characters must be a set
of bytes; all bytes of characters beyond ASCII are alike in it. Hashes take eight
bytes of a word at a time, those of long words are polynomials over 64 bits; they
depend on nothing but the words.
"""

from dataclasses import dataclass

import numpy as np

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Everything but space and the controls 09-0D.
PLAIN = ~SPACE

BASE, WINDOW_BASE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64 bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))
#: A-Z as a-z.
FOLDED_BYTES = np.arange(256, dtype=np.uint8)
FOLDED_BYTES[65:91] += 32
#: The first bytes of eight, none to all; words beyond LONG bytes are hashed byte by byte.
FIRST_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
LONG = 64


def powers(base: np.uint64, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    if count:
        out[0] = 1
    return np.multiply.accumulate(out)


def inverse(odd: np.uint64) -> np.uint64:
    return np.uint64(pow(int(odd), -1, 1 << 64))


@dataclass
class Words:
    """Words of consecutive rows: where each starts and ends in the bytes, and the
    first word of each row (one more entry than rows)."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def find(data: np.ndarray, offsets: np.ndarray, in_word: np.ndarray = PLAIN) -> Words:
    """Words of the rows that ``offsets`` (from 0) cut out of ``data``."""
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = in_word[data]
    begins = inside[:-1].copy()
    begins[1:] &= ~inside[:-2]
    cuts = offsets[:-1][offsets[:-1] < len(data)]
    begins[cuts] = inside[cuts]
    start = np.flatnonzero(begins)
    ends = inside[:-1] & ~inside[1:]
    inner = cuts[cuts > 0]
    ends[inner - 1] = inside[inner - 1]
    return Words(start, np.flatnonzero(ends) + 1, np.searchsorted(start, offsets))


def eights(data: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The eight bytes from each place; ``data`` is whole eights and has two to spare."""
    at, shift = start >> 3, (start & 7).astype(np.uint64) << np.uint64(3)
    # A shift by 64 gives 0.
    return (data.take(at) >> shift) | (data.take(at + 1) << (np.uint64(64) - shift))


def hashes(data: np.ndarray, words: Words, folded: np.ndarray | None = None) -> np.ndarray:
    """A 64-bit hash of each word, its bytes replaced by those of ``folded`` if given."""
    size = words.end - words.start
    if not len(size):
        return np.zeros(0, np.uint64)
    raw = np.zeros((len(data) + 31) // 8 * 8, np.uint8)
    raw[: len(data)] = data if folded is None else folded[data]
    wide = raw.view("<u8")
    total = mix(eights(wide, words.start) & FIRST_BYTES[np.minimum(size, 8)] ^ (size.astype(np.uint64) * BASE))
    more, done = np.flatnonzero((size > 8) & (size <= LONG)), 8
    while len(more):
        value = eights(wide, words.start[more] + done) & FIRST_BYTES[np.minimum(size[more] - done, 8)]
        total[more] = mix(total[more] * WINDOW_BASE + value)
        done += 8
        more = more[size[more] > done]
    long = np.flatnonzero(size > LONG)
    if len(long):
        size = size[long]
        first = np.cumsum(size) - size
        place = np.arange(int(size.sum())) - np.repeat(first, size)
        value = BYTES[raw[place + np.repeat(words.start[long], size)]] * powers(BASE, int(size.max()))[place]
        total[long] = mix(np.add.reduceat(value, first) + size.astype(np.uint64))
    return total


def windows(hashed: np.ndarray, length: int, base: np.uint64 = WINDOW_BASE) -> np.ndarray:
    """A hash for each run of ``length`` words, whether or not it stays in a row."""
    count = len(hashed) - length + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    if length <= 8:
        total = hashed[:count].copy()
        for k in range(1, length):
            total *= base
            total += hashed[k : count + k]
        return mix(total)
    total = np.zeros(len(hashed) + 1, np.uint64)
    np.cumsum(hashed * powers(base, len(hashed)), out=total[1:])
    return mix((total[length:] - total[:-length]) * powers(inverse(base), count))


def window_rows(words: Words, length: int) -> tuple[np.ndarray, np.ndarray]:
    """First words of the runs of ``length`` that stay in their row, and the rows."""
    row = words.row
    at = np.arange(max(0, len(row) - length + 1))
    kept = at + length <= words.first[row[: len(at)] + 1]
    return at[kept], row[: len(at)][kept]
