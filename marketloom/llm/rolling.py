"""Vectorised hashes of bytes and of word runs, for tasks that scan whole texts."""

from __future__ import annotations

import numpy as np

#: Bytes hashed at a time.
SLICE = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_rng = np.random.Generator(np.random.PCG64(20_240_229))
#: A random 64-bit value for each byte value.
BYTE_VALUES = _rng.integers(0, 2**64, 256, dtype=np.uint64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    have, step = 1, base
    while have < n:
        take = min(have, n - have)
        np.multiply(out[:take], np.uint64(step), out=out[have : have + take])
        have, step = have + take, step * step % 2**64
    return out


class Prefixes:
    """Prefix sums of byte values times powers of a base, modulo 2^64; equal byte runs of equal
    length get equal hashes wherever they start."""

    _up = _powers(_BASE, 1)
    _down = _powers(pow(_BASE, -1, 2**64), 1)

    def __init__(self, data: np.ndarray, values: np.ndarray = BYTE_VALUES):
        n = len(data) + 1
        if len(Prefixes._up) < n:
            size = max(n, SLICE + 4096)
            Prefixes._up, Prefixes._down = _powers(_BASE, size), _powers(pow(_BASE, -1, 2**64), size)
        self.sums = np.empty(n, np.uint64)
        self.sums[0] = 0
        np.cumsum(values[data] * Prefixes._up[: n - 1], dtype=np.uint64, out=self.sums[1:])

    def runs(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * Prefixes._down[starts] + (ends - starts).astype(np.uint64))

    def windows(self, width: int) -> np.ndarray:
        """The hash of the `width` bytes from each start."""
        if len(self.sums) <= width:
            return np.empty(0, np.uint64)
        return mix((self.sums[width:] - self.sums[:-width]) * Prefixes._down[: len(self.sums) - width])


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def word_bytes() -> np.ndarray:
    """For each byte what it counts as in a word: letters in lower case, digits and all bytes
    beyond ASCII as they are, and 0 (no part of a word) for the rest."""
    table = np.zeros(256, np.uint8)
    for b in range(256):
        if b >= 0x80 or chr(b).isalnum():
            table[b] = b + 32 if 65 <= b <= 90 else b
    return table


WORD_BYTES = word_bytes()


def word_hashes(data: np.ndarray, starts_of_texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of the texts laid end to end in data, and each text's first word.

    starts_of_texts: the offsets at which texts begin, ascending, the first 0. Returns the
    hashes and, for each text and one past the last, the number of words before it.
    """
    hashes, before = [], []
    begins = np.zeros(len(data) + 1, bool)
    begins[starts_of_texts] = True
    at, total, next_text = 0, 0, 0
    while at < len(data):
        end = min(len(data), at + SLICE)
        if end < len(data):  # cut where no word is cut
            while end < len(data) and WORD_BYTES[data[end]] and WORD_BYTES[data[end - 1]] and not begins[end]:
                end += 1
        part = WORD_BYTES[data[at:end]]
        inside = part != 0
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1] | begins[at + 1 : end]
        last[:-1] &= ~inside[1:] | begins[at + 1 : end]
        a, b = np.flatnonzero(first), np.flatnonzero(last) + 1
        hashes.append(Prefixes(part).runs(a, b))
        stop = np.searchsorted(starts_of_texts, end, "left")
        before.append(total + np.searchsorted(a, starts_of_texts[next_text:stop] - at, "left"))
        next_text, total, at = stop, total + len(a), end
    before.append(np.full(len(starts_of_texts) - next_text + 1, total))
    return (np.concatenate(hashes) if hashes else np.empty(0, np.uint64)), np.concatenate(before)


def runs_of_words(hashes: np.ndarray, width: int) -> np.ndarray:
    """The hash of the `width` words from each word on."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = hashes[:n].copy()
    for k in range(1, width):
        out = out * np.uint64(0x9FB21C651E98DF25) + hashes[k : k + n]
    return mix(out)
