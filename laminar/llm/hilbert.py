"""Keys of a Hilbert curve for blocks of points (numpy, all points at once)."""

from __future__ import annotations

import numpy as np


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position along the Hilbert curve of integer points ``cells`` (n, dims), as 63-bit keys.

    The usual transposed form: Gray decoding from the top bit down, with the swaps and
    reflections undone plane by plane, then the bits of all dimensions interleaved.  ``dims * bits`` must not
    exceed 63.
    """
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    if dims * bits > 63:
        raise ValueError("a key has 63 bits at most")
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(dims):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            if i:
                x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    fix = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        fix ^= np.where(x[-1] & q, q - 1, 0)
        q >>= 1
    x ^= fix
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key
