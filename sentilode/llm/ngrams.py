"""Hashed character n-grams of a text as numpy arrays; weights of a linear model over them."""

from __future__ import annotations

import numpy as np

# Odd 64-bit constants of a multiplicative hash.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_SIZE = 0x2545F4914F6CDD1D
_SPACES = str.maketrans(dict.fromkeys("\t\n\x0b\x0c\r", " "))


def hashed(text: str, lengths: tuple[int, ...], bits: int) -> np.ndarray:
    """The feature of every n-gram of code points, in lower case, line ends as spaces, a space at both ends."""
    plain = f" {text} ".lower().translate(_SPACES).encode("utf-32-le", "replace")
    data = np.frombuffer(plain, np.uint32).astype(np.uint64)
    out, rolling = [], data
    for n in range(1, min(max(lengths), len(data)) + 1):
        if n > 1:
            rolling = rolling[:-1] * _BASE
            rolling += data[n - 1:]
        if n in lengths:
            h = rolling + np.uint64(n * _SIZE % (1 << 64))
            h ^= h >> np.uint64(29)
            h *= _MIX
            out.append((h >> np.uint64(64 - bits)).astype(np.int32))
    return np.concatenate(out) if out else np.zeros(0, np.int32)


class Presence:
    """The distinct features of a text; the table of all features is reused from text to text."""

    def __init__(self, lengths: tuple[int, ...], bits: int) -> None:
        self.lengths, self.bits = lengths, bits
        self.last = np.zeros(1 << bits, np.int32)

    def __call__(self, text: str) -> np.ndarray:
        found = hashed(text, self.lengths, self.bits)
        at = np.arange(len(found), dtype=np.int32)
        self.last[found] = at
        return found[self.last[found] == at]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))
