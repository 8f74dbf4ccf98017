"""Exact sums of squared differences by number-theoretic transforms, many short rows at once."""

from __future__ import annotations

from functools import cache

import numpy as np

# Primes with roots of unity of order 2**23 at least, each with a primitive root.
PRIMES = ((998244353, 3), (2013265921, 31), (469762049, 3))


@cache
def _roots(size: int, prime: int, generator: int, inverse: bool) -> np.ndarray:
    """Powers 0 to ``size`` / 2 of a root of unity of order ``size``."""
    root = pow(generator, (prime - 1) // size, prime)
    if inverse:
        root = pow(root, prime - 2, prime)
    powers = np.ones(max(1, size // 2), dtype=np.uint64)
    done, step = 1, root
    while done < len(powers):
        powers[done : 2 * done] = powers[:done] * np.uint64(step) % np.uint64(prime)
        step = step * step % prime
        done *= 2
    return powers


def _transform(rows: np.ndarray, prime: int, generator: int) -> np.ndarray:
    """Transform of each row, in bit-reversed order."""
    count, size = rows.shape
    p = np.uint64(prime)
    half = size // 2
    while half:
        pairs = rows.reshape(count, -1, 2, half)
        low, high = pairs[:, :, 0], pairs[:, :, 1]
        out = np.empty_like(pairs)
        out[:, :, 0] = (low + high) % p
        out[:, :, 1] = (low + (p - high)) * _roots(2 * half, prime, generator, False) % p
        rows = out.reshape(count, size)
        half //= 2
    return rows


def _back(rows: np.ndarray, prime: int, generator: int) -> np.ndarray:
    """Rows of which ``rows`` are the transforms."""
    count, size = rows.shape
    p = np.uint64(prime)
    half = 1
    while half < size:
        pairs = rows.reshape(count, -1, 2, half)
        low = pairs[:, :, 0]
        high = pairs[:, :, 1] * _roots(2 * half, prime, generator, True) % p
        out = np.empty_like(pairs)
        out[:, :, 0] = (low + high) % p
        out[:, :, 1] = (low + (p - high)) % p
        rows = out.reshape(count, size)
        half *= 2
    return rows * np.uint64(pow(size, prime - 2, prime)) % p


def squared_differences_vanish(blocks: np.ndarray, windows: np.ndarray, shifts: int) -> np.ndarray:
    """For each row, at which of the first ``shifts`` places of its window its block stands without a mismatch.

    Values are non-negative integers. A sum of squared differences is known modulo so many primes that their product
    exceeds any such sum: it is zero if and only if it is zero for each of them.
    """
    rows, width = blocks.shape
    size = 1 << (windows.shape[1] - 1).bit_length()
    top = int(max(blocks.max(initial=0), windows.max(initial=0)))
    bound, product = width * top * top, 1
    zero = np.ones((rows, shifts), dtype=bool)
    for prime, generator in PRIMES:
        p = np.uint64(prime)
        block, window = blocks.astype(np.uint64) % p, windows.astype(np.uint64) % p
        left = np.zeros((rows, size), dtype=np.uint64)
        left[:, :width] = block[:, ::-1]
        right = np.zeros((rows, size), dtype=np.uint64)
        right[:, : window.shape[1]] = window
        product_ = _transform(left, prime, generator) * _transform(right, prime, generator) % p
        # Places that a cyclic product wraps onto come before those that are read.
        cross = _back(product_, prime, generator)[:, width - 1 : width - 1 + shifts]
        sums = np.zeros((rows, window.shape[1] + 1), dtype=np.uint64)
        np.cumsum(window * window % p, axis=1, out=sums[:, 1:])
        squares = sums[:, width : width + shifts] - sums[:, :shifts]
        own = (block * block % p).sum(axis=1, dtype=np.uint64)[:, None]
        zero &= (own + squares) % p == 2 * cross % p
        product *= prime
        if product > bound:
            return zero
    raise ValueError(f"values up to {top} in blocks of {width} are too large to be told apart")
