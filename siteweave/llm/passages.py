"""Words as numbers, rolling hashes and minimisers: what the two passage operators share."""

from __future__ import annotations

import numpy as np
import xxhash

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX
    return (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)


def words_of(text: bytes | None) -> list[bytes]:
    """Words [^\\x20\\x09-\\x0D]+ after A-Z are lowered."""
    return (text or b"").lower().split()


_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return x << np.uint64(bits) | x >> np.uint64(64 - bits)


def word_hashes(words: list[bytes]) -> np.ndarray:
    """XXH64 with seed 42 of each word, by array steps over all words of under 32 bytes."""
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    at = np.cumsum(size) - size
    data = np.frombuffer(b"".join(words) + bytes(8), dtype=np.uint8)
    number = np.lib.stride_tricks.sliding_window_view(data, 8)  # the eight bytes from each place on
    out = np.uint64(42) + _P5 + size.astype(np.uint64)
    for k in range(3):
        i = np.flatnonzero(size >= 8 * k + 8)
        x = _turned(number[at[i] + 8 * k].view("<u8")[:, 0] * _P2, 31) * _P1
        out[i] = _turned(out[i] ^ x, 27) * _P1 + _P4
    at, left = at + (size & ~7), size & 7
    tail = np.ascontiguousarray(number[np.minimum(at, len(data) - 8)]).view("<u8")[:, 0]
    i = np.flatnonzero(left >= 4)
    out[i] = _turned(out[i] ^ (tail[i] & np.uint64(0xFFFFFFFF)) * _P1, 23) * _P2 + _P3
    tail[i] >>= np.uint64(32)
    left = left & 3
    for k in range(3):
        i = np.flatnonzero(left > k)
        out[i] = _turned(out[i] ^ (tail[i] >> np.uint64(8 * k) & np.uint64(255)) * _P5, 11) * _P1
    out = (out ^ out >> np.uint64(33)) * _P2
    out = (out ^ out >> np.uint64(29)) * _P3
    out ^= out >> np.uint64(32)
    for i in np.flatnonzero(size >= 32).tolist():
        out[i] = xxhash.xxh64_intdigest(words[i], 42)
    return out


_powers: list[np.ndarray] = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _powers_up_to(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, 2 * len(_powers[0]))
        for i, base in enumerate((_BASE, _INVERSE)):
            step = np.full(size, base, dtype=np.uint64)
            step[0] = 1
            _powers[i] = np.cumprod(step, dtype=np.uint64)
    return _powers


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """One hash for each run of k words, by differences of a running sum modulo 2^64."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    up, down = _powers_up_to(len(hashes) + 1)
    total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(mixed(hashes) * up[: len(hashes)], dtype=np.uint64)])
    return mixed((total[k:] - total[:-k]) * down[:n])


def _sliding(f, x: np.ndarray, w: int) -> np.ndarray:
    """f (np.minimum or np.maximum) over each w numbers in a row, by doubling."""
    size = 1
    while 2 * size <= w:
        x = f(x[:-size], x[size:])
        size *= 2
    return f(x[: len(x) - (w - size)], x[w - size :]) if w > size else x


def minimisers(x: np.ndarray, w: int) -> np.ndarray:
    """Places that hold the least of some w numbers in a row (all of them if there are several)."""
    if len(x) < w:
        return np.zeros(0, dtype=np.int64)
    low = _sliding(np.minimum, x, w)
    pad = np.zeros(w - 1, dtype=x.dtype)
    return np.flatnonzero(_sliding(np.maximum, np.concatenate([pad, low, pad]), w) == x)
