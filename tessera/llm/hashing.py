"""64-bit hashes of words and word n-grams, the same on every machine."""

from __future__ import annotations

import functools

import numpy as np

# Odd multipliers that mix the bytes of a word and the words of a gram.
MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
BYTE_STEP = 0xD1342543DE82EF97 | 3
#: Bytes of texts that are hashed at once.
SLICE = 1 << 20

#: Lower-cased A-Z; white space (20, 09 to 0D) parts words.
PLAIN = bytes(32 if 9 <= b <= 13 else b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Digits, letters and everything beyond ASCII belong to words; A-Z are lower-cased.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX[1])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX[2])
    return x ^ (x >> np.uint64(31))


@functools.lru_cache(maxsize=8)
def _of_bytes() -> np.ndarray:
    return mixed((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(MIX[0]))


@functools.lru_cache(maxsize=64)
def _powers(bits: int) -> np.ndarray:
    return np.cumprod(np.full(1 << bits, BYTE_STEP, dtype=np.uint64))


def _hashed(raws: list[bytes], table: bytes) -> list[np.ndarray]:
    a = np.frombuffer((b" ".join(raws) + b" ").translate(table), np.uint8)
    inside = a != 32
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edge = np.r_[0, edge]
    starts, lengths = edge[::2], edge[1::2] - edge[::2]
    if not len(starts):
        return [np.zeros(0, np.uint64) for _ in raws]
    place = np.flatnonzero(inside)
    step = place - np.repeat(starts, lengths)
    value = _of_bytes()[a[place]] * _powers(max(6, int(lengths.max()).bit_length()))[step]
    words = mixed(np.add.reduceat(value, np.cumsum(lengths) - lengths))
    bounds = np.cumsum([len(r) + 1 for r in raws])
    return np.split(words, np.searchsorted(starts, bounds[:-1]))


def word_hashes(raws: list[bytes], table: bytes = PLAIN) -> list[np.ndarray]:
    """Hashes of each text's words.  ``table`` lower-cases and turns what parts words into
    spaces.  A word's hash is a sum over its bytes, so no word is looked up."""
    out: list[np.ndarray] = []
    held: list[bytes] = []
    size = 0
    for raw in raws:
        if held and size + len(raw) > SLICE:
            out += _hashed(held, table)
            held, size = [], 0
        held.append(raw)
        size += len(raw)
    return out + _hashed(held, table) if held else out


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k words, given the words' hashes."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        out = out * np.uint64(MIX[0]) + h[j : j + n]
    return mixed(out)
