"""Number-theoretic transform modulo a 23-bit prime, by matrix products that float64 keeps exact.

A transform of length N is cut into lengths of at most 64 (rows by columns, twiddle factors in
between), each a product with the matrix of powers of a root of unity.  A product's entries
are sums of at most 64 products below P * P, hence below 2 ** 53: no rounding occurs.  The
result is left in the order in which the steps produce it, which pointwise products do not
mind and :func:`inverse` undoes.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

P = 7 * (1 << 20) + 1        # prime; 3 generates its multiplicative group
GENERATOR = 3
MOST = 1 << 20               # longest transform
RADIX = 64


def reduced(x: np.ndarray) -> np.ndarray:
    """``x`` (below 2 ** 53) modulo P, in place; P itself or a value just below 0 may stand for its residue."""
    x -= np.floor(x * (1.0 / P)) * P
    return x


@lru_cache(maxsize=None)
def _powers(n: int, back: bool) -> np.ndarray:
    """w ** 0 .. w ** (n - 1) for a primitive n-th root of unity w (its inverse, if ``back``)."""
    w = pow(GENERATOR, (P - 1) // n, P)
    if back:
        w = pow(w, P - 2, P)
    out = np.ones(1, dtype=np.int64)
    while len(out) < n:
        out = np.concatenate([out, out * pow(w, len(out), P) % P])
    return out[:n]


@lru_cache(maxsize=None)
def _matrix(n: int, back: bool) -> np.ndarray:
    k = np.arange(n)
    return _powers(n, back)[np.outer(k, k) % n].astype(np.float64)


@lru_cache(maxsize=None)
def _twiddles(n: int, r: int, back: bool) -> np.ndarray:
    return _powers(n, back)[np.outer(np.arange(n // r), np.arange(r)) % n].astype(np.float64)


def _first(n: int) -> int:
    """Length of the first step of a transform of length n: about its root, at most RADIX."""
    return min(RADIX, 1 << ((n.bit_length() - 1) // 2))


def forward(x: np.ndarray) -> np.ndarray:
    """Transform of each row (length a power of two, values from 0 to P) in step order."""
    rows, n = x.shape
    if n <= RADIX:
        return reduced(x @ _matrix(n, False))
    r = _first(n)
    m = n // r
    y = reduced(np.ascontiguousarray(x.reshape(rows, r, m).transpose(0, 2, 1)).reshape(-1, r) @ _matrix(r, False))
    y = reduced(y.reshape(rows, m, r) * _twiddles(n, r, False))
    return forward(np.ascontiguousarray(y.transpose(0, 2, 1)).reshape(rows * r, m)).reshape(rows, n)


def _inverse(x: np.ndarray) -> np.ndarray:
    rows, n = x.shape
    if n <= RADIX:
        return reduced(x @ _matrix(n, True))
    r = _first(n)
    m = n // r
    y = _inverse(x.reshape(rows * r, m)).reshape(rows, r, m).transpose(0, 2, 1)
    y = reduced(y * _twiddles(n, r, True))
    y = reduced(y.reshape(-1, r) @ _matrix(r, True)).reshape(rows, m, r)
    return np.ascontiguousarray(y.transpose(0, 2, 1)).reshape(rows, n)


def inverse(x: np.ndarray) -> np.ndarray:
    """The rows whose :func:`forward` is ``x``."""
    return reduced(_inverse(x) * float(pow(x.shape[1], P - 2, P)))


def convolve(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cyclic convolution of equal rows, as int64 residues modulo P."""
    return inverse(reduced(forward(a) * forward(b))).astype(np.int64) % P
