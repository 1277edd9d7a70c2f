"""Hashes of runs of bytes, by array operations over all runs of a block at once.

A run is taken eight bytes at a time, and each eight pass through the mixing of all that come after them, so unlike
sums of powers no pattern of letters cancels out. Runs of over SHORT bytes get their BLAKE2b instead.
"""

from __future__ import annotations

import hashlib

import numpy as np

U = np.uint64
SHORT = 64
_STEPS = np.random.Generator(np.random.PCG64(20240229)).integers(1, 2**63, (2, 2 + SHORT // 8), dtype=U) << U(1) | U(1)
_ENDS = np.array([(1 << 8 * k) - 1 for k in range(9)], U)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose bits all depend on all bits."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_SIZES = [mixed(np.arange(SHORT + 2, dtype=U) * s[0] + s[1]) for s in _STEPS]


def of_runs(body: bytes, start: np.ndarray, size: np.ndarray, lanes: int = 1) -> list[np.ndarray]:
    """One or two 64-bit hashes of each run body[start : start + size].

    Runs of up to 8 bytes: one hash tells those of one size apart, two (the second is the bytes themselves) all of them.
    Longer ones: the hashes are independent, so a pair of runs has both the same with a chance of 2**-128.
    """
    # all runs of eight bytes, wherever they begin
    eights = np.ndarray(len(body) + 1, "<u8", body + bytes(8), strides=(1,))
    x = eights[start] & _ENDS[np.minimum(size, 8)]
    out = [mixed((_SIZES[0][np.minimum(size, SHORT + 1)] ^ x) * _STEPS[0][0] + _STEPS[0][2])]
    if lanes > 1:
        out.append(x)
    on = np.flatnonzero((size > 8) & (size <= SHORT))
    if lanes > 1:
        x[on] = mixed((_SIZES[1][size[on]] ^ x[on]) * _STEPS[1][0] + _STEPS[1][2])
    for k in range(1, SHORT // 8):
        on = on[size[on] > 8 * k]
        if not len(on):
            break
        x = eights[start[on] + 8 * k] & _ENDS[np.minimum(size[on] - 8 * k, 8)]
        for h, s in zip(out, _STEPS, strict=False):
            h[on] = mixed((h[on] ^ x) * s[0] + s[2 + k])
    for i in np.flatnonzero(size > SHORT).tolist():
        digest = np.frombuffer(hashlib.blake2b(body[start[i] : start[i] + size[i]], digest_size=16).digest(), "<u8")
        for h, d in zip(out, digest, strict=False):
            h[i] = d
    return out
