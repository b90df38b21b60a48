"""SHA-256 on many messages at once, with states that can be kept and resumed.

A state is eight 32-bit words, a row of a uint32 matrix: the hash after some
whole 64-byte blocks. ``absorb`` takes a state one block further and leaves the
given one as it is, so that one state can be continued in several ways, stored
in a table and resumed elsewhere (the states of ``hashlib`` can't leave their
process). A hexadecimal digest is 64 bytes, so one block.
"""

from __future__ import annotations

import math

import numpy as np

_M = np.uint32


def _primes(n: int) -> list[int]:
    out, k = [], 2
    while len(out) < n:
        if all(k % p for p in out):
            out.append(k)
        k += 1
    return out


def _root_bits(p: int, power: int) -> int:
    """The first 32 bits of the fraction of the square or cube root of ``p``."""
    if power == 2:
        return math.isqrt(p << 64) & 0xFFFFFFFF
    lo, hi = 0, p << 32
    while lo < hi:                       # the largest r with r**3 <= p * 2**96
        mid = (lo + hi + 1) >> 1
        lo, hi = (mid, hi) if mid ** 3 <= p << 96 else (lo, mid - 1)
    return lo & 0xFFFFFFFF


#: The standard's constants: roots of the first primes.
START = np.array([_root_bits(p, 2) for p in _primes(8)], _M)
_K = np.array([_root_bits(p, 3) for p in _primes(64)], _M)
_HEX = np.frombuffer(b"0123456789abcdef", np.uint8)


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x >> _M(n)) | (x << _M(32 - n))


def _schedule(words: list) -> list:
    """The 64 words of a block, round constants added."""
    w = list(words)
    for t in range(16, 64):
        a, b = w[t - 15], w[t - 2]
        s0 = _turn(a, 7) ^ _turn(a, 18) ^ (a >> _M(3))
        s1 = _turn(b, 17) ^ _turn(b, 19) ^ (b >> _M(10))
        w.append(w[t - 16] + s0 + w[t - 7] + s1)
    return [w[t] + _K[t] for t in range(64)]


def _rounds(states: np.ndarray, scheduled: list) -> np.ndarray:
    a, b, c, d, e, f, g, h = (states[:, i].copy() for i in range(8))
    for w in scheduled:
        s1 = _turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)
        t1 = h + s1 + (g ^ (e & (f ^ g))) + w
        s0 = _turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)
        t2 = s0 + ((a & b) | (c & (a | b)))
        a, b, c, d, e, f, g, h = t1 + t2, a, b, c, d + t1, e, f, g
    return np.stack([a, b, c, d, e, f, g, h], axis=1) + states


def start(n: int) -> np.ndarray:
    """``n`` states of hashes that have read nothing."""
    return np.broadcast_to(START, (n, 8))


def absorb(states: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """States after one more block each; ``blocks`` is a (n, 64) byte matrix."""
    words = np.ascontiguousarray(blocks).view(">u4").astype(_M)
    return _rounds(states, _schedule([np.ascontiguousarray(words[:, i]) for i in range(16)]))


_endings: dict[int, list] = {}


def finish(states: np.ndarray, n_blocks: int) -> np.ndarray:
    """Digests (n, 32 bytes) of messages that ended after ``n_blocks`` whole blocks."""
    if n_blocks not in _endings:
        words = [_M(0x80000000), *[_M(0)] * 13, _M(n_blocks * 512 >> 32), _M(n_blocks * 512 & 0xFFFFFFFF)]
        with np.errstate(over="ignore"):
            _endings[n_blocks] = _schedule(words)
    return _rounds(states, _endings[n_blocks]).astype(">u4").view(np.uint8).reshape(-1, 32)


def hex_blocks(digests: np.ndarray) -> np.ndarray:
    """(n, 64) lowercase hexadecimal bytes of (n, 32) digests."""
    out = np.empty((len(digests), 64), np.uint8)
    out[:, 0::2], out[:, 1::2] = _HEX[digests >> 4], _HEX[digests & 15]
    return out
