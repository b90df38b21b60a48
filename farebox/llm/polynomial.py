"""Integer polynomials with real roots only, and the exact characteristic polynomial of a symmetric integer matrix.

A polynomial is a list of Python integers, the constant first. The
characteristic polynomial is found modulo many 31-bit primes (Hessenberg form by
similarity, then the recurrence of its leading blocks) and put together by
Chinese remainders, so it is exact. As all roots of a symmetric matrix are real,
Descartes' rule is exact too: the sign changes of p(x + a) count the roots above
a, which isolates every root by halving intervals with dyadic ends.
"""

from __future__ import annotations

import math

import numpy as np

_WITNESSES = (2, 3, 5, 7)            # decide primality below 3,215,031,751


def _is_prime(n: int) -> bool:
    if n % 2 == 0:
        return n == 2
    s = (n - 1 & 1 - n).bit_length() - 1
    for a in _WITNESSES:
        x = pow(a, n - 1 >> s, n)
        if x not in (1, n - 1) and all((x := x * x % n) != n - 1 for _ in range(s - 1)):
            return False
    return True


def primes_below(limit: int, n: int) -> list[int]:
    out, k = [], limit - 1 | 1
    while len(out) < n:
        k -= 2
        if _is_prime(k):
            out.append(k)
    return out


# ---- modulo a prime -----------------------------------------------------------------

def charpoly_mod(matrix: np.ndarray, p: int) -> list[int]:
    """Characteristic polynomial of an int64 matrix with entries 0..p-1, modulo the prime ``p`` < 2**31."""
    a, n = matrix.copy(), len(matrix)
    for j in range(n - 2):
        nonzero = np.flatnonzero(a[j + 1:, j])
        if not len(nonzero):
            continue
        k = j + 1 + int(nonzero[0])
        if k != j + 1:                              # a similarity: swap rows and columns alike
            a[[k, j + 1]] = a[[j + 1, k]]
            a[:, [k, j + 1]] = a[:, [j + 1, k]]
        times = a[j + 2:, j] * pow(int(a[j + 1, j]), -1, p) % p
        a[j + 2:] = (a[j + 2:] - times[:, None] * a[j + 1]) % p
        # the inverse step on columns; products are reduced before they are added up
        a[:, j + 1] = (a[:, j + 1] + (a[:, j + 2:] * times % p).sum(axis=1)) % p
    polys = [np.array([1], np.int64)]
    for k in range(1, n + 1):
        now = np.zeros(k + 1, np.int64)
        now[1:] = polys[-1]
        now[:-1] = (now[:-1] - int(a[k - 1, k - 1]) * polys[-1]) % p
        below = 1
        for i in range(1, k):
            below = below * int(a[k - i, k - i - 1]) % p
            if not below:
                break
            part = polys[k - i - 1]
            now[: len(part)] = (now[: len(part)] - int(a[k - i - 1, k - 1]) * below % p * part) % p
        polys.append(now)
    return polys[-1].tolist()


def gcd_mod(a: list[int], b: list[int], p: int) -> list[int]:
    """Monic greatest common divisor modulo ``p``."""
    trim = lambda f: f[: max((i + 1 for i, c in enumerate(f) if c % p), default=0)]
    a, b = [c % p for c in trim(a)], [c % p for c in trim(b)]
    while b:
        inverse = pow(b[-1], -1, p)
        while len(a) >= len(b):
            q, shift = a[-1] * inverse % p, len(a) - len(b)
            a = trim([c - q * b[i - shift] if i >= shift else c for i, c in enumerate(a)])
            a = [c % p for c in a]
        a, b = b, a
    inverse = pow(a[-1], -1, p)
    return [c * inverse % p for c in a]


def remainders(residues: list[list[int]], primes: list[int]) -> list[int]:
    """The integers of least size with the given residues (one list per prime)."""
    product = math.prod(primes)
    weights = [product // p * pow(product // p, -1, p) for p in primes]
    out = [sum(w * r[i] for w, r in zip(weights, residues)) % product for i in range(len(residues[0]))]
    return [c - product if 2 * c > product else c for c in out]


# ---- real roots ------------------------------------------------------------------------

def derivative(f: list[int]) -> list[int]:
    return [i * c for i, c in enumerate(f)][1:]


def square_free(f: list[int], limit: int = 1 << 31) -> list[int]:
    """The monic polynomial with the distinct roots of the monic ``f``."""
    d = derivative(f)
    p = primes_below(limit, 1)[0]
    if len(gcd_mod(f, d, p)) == 1:       # a common factor would be one modulo p too
        return f
    # a divisor of a monic integer polynomial is monic and integer; its coefficients are below Mignotte's bound
    bits = len(f) + max(abs(c) for c in f).bit_length() + len(f).bit_length() + 2
    primes = primes_below(limit, bits // 30 + 40)
    found = [(gcd_mod(f, d, p), p) for p in primes]
    least = min(len(g) for g, _ in found)
    found = [(g, p) for g, p in found if len(g) == least]
    return divide(f, remainders([g for g, _ in found], [p for _, p in found]))


def divide(f: list[int], g: list[int]) -> list[int]:
    """The exact quotient by a monic divisor."""
    f, out = list(f), [0] * (len(f) - len(g) + 1)
    for k in reversed(range(len(out))):
        out[k] = f[k + len(g) - 1]
        for i, c in enumerate(g):
            f[k + i] -= out[k] * c
    assert not any(f), "not a divisor"
    return out


def roots_above(f: list[int], a: int, shift: int) -> int:
    """How many roots of ``f`` (all real) lie above a / 2**shift, with multiplicity."""
    n = len(f) - 1
    g = [c << shift * (n - i) for i, c in enumerate(f)]      # roots times 2**shift
    for i in range(n):
        for j in range(n - 1, i - 1, -1):
            g[j] += a * g[j + 1]
    signs = [c > 0 for c in g if c]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def value(f: list[int], x: int, shift: int) -> int:
    """f(x / 2**shift) * 2**(shift * degree), exact."""
    out, scale = 0, 0
    for c in reversed(f):
        out = out * x + (c << scale)
        scale += shift
    return out


def largest_roots(f: list[int], k: int, bits: int) -> list[tuple[int, int, int, int]]:
    """The ``k`` largest distinct roots of ``f``, falling, as (near, shift, low, low_shift).

    ``f`` is square-free, all its roots are real and at least 0. A root differs from near / 2**shift by at most
    2**-shift, a ``2**-bits``th part of it, and is the only one above low / 2**low_shift but below the root before it.
    """
    top = 0
    while roots_above(f, 1 << top, 0):
        top += 1
    out, todo = [], [(0, 1 << top, 0, roots_above(f, 0, 0), 0)]      # (low, high] at a shift; roots above each end
    while todo and len(out) < k:
        low, high, shift, above_low, above_high = todo.pop()
        if above_low == above_high:
            continue
        if above_low - above_high == 1 and (low or high - low == 1):
            out.append((*_refine(f, low, high, shift, bits), low, shift))
            continue
        if high - low == 1:
            low, high, shift = 2 * low, 2 * high, shift + 1
        mid = (low + high) // 2
        above = roots_above(f, mid, shift)
        todo += [(low, mid, shift, above_low, above), (mid, high, shift, above, above_high)]
    if len(out) < k and f[0] == 0:
        out.append((0, 0, -1, 0))
    return out


def _refine(f: list[int], low: int, high: int, shift: int, bits: int) -> tuple[int, int]:
    """The one simple root in (low, high] / 2**shift, by interpolated subdivision.

    Each round cuts the interval into 2**m parts and tries the one where a straight line puts the root; a hit (signs
    prove it) squares the number of parts, a miss takes its root. With two parts a round always hits.
    """
    at_high = value(f, high, shift)
    if at_high == 0:
        return high, shift
    positive = at_high > 0
    below = lambda v: v != 0 and (v > 0) != positive
    while high - low > 1:
        mid = (low + high) // 2
        v = value(f, mid, shift)
        if v == 0:
            return mid, shift
        low, high = (mid, high) if below(v) else (low, mid)
    m, degree = 1, len(f) - 1
    at_low, at_high = value(f, low, shift), value(f, high, shift)
    while low.bit_length() <= bits:
        if at_high == 0:
            return high, shift
        parts = 1 << m
        guess = min(parts - 1, max(1, parts * abs(at_low) // (abs(at_low) + abs(at_high))))
        at = value(f, (low << m) + guess, shift + m)
        if at == 0:
            return (low << m) + guess, shift + m
        other = guess + 1 if below(at) else guess - 1
        if other in (0, parts):
            at_other = (at_high if other else at_low) << m * degree
        else:
            at_other = value(f, (low << m) + other, shift + m)
        if below(at) == below(at_other):
            m = max(1, m // 2)
            continue
        ends = sorted([(guess, at), (other, at_other)])
        low, high, shift = (low << m) + ends[0][0], (low << m) + ends[1][0], shift + m
        at_low, at_high, m = ends[0][1], ends[1][1], 2 * m
    return low, shift
