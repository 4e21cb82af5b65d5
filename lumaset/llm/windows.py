"""Rolling fingerprints of byte strings and content-chosen positions, vectorised."""

from __future__ import annotations

import numpy as np

#: Fixed odd multipliers of two independent polynomials modulo 2**64.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
#: Powers that a worker keeps.
KEPT = (1 << 20) + 1
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose high bits depend on all bits."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


def powers(n: int, which: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse; tables for more than KEPT aren't kept."""
    held = _powers.get(which)
    if held is None or len(held[0]) < n:
        out = []
        for base in (BASES[which], pow(BASES[which], -1, 1 << 64)):
            steps = np.full(max(n, KEPT), np.uint64(base))
            steps[0] = 1
            out.append(np.multiply.accumulate(steps))
        held = (out[0], out[1])
        if n <= KEPT:
            _powers[which] = held
    return held[0][:n], held[1][:n]


class Rolling:
    """Fingerprints of any substring of ``x`` in constant time."""

    def __init__(self, x: np.ndarray, which: int):
        up, self.down = powers(len(x) + 1, which)
        # each byte value stands for a random-looking number
        letters = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASES[which]))
        self.sums = np.zeros(len(x) + 1, np.uint64)
        np.cumsum(letters[x] * up[:-1], out=self.sums[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix((self.sums[stop] - self.sums[start]) * self.down[start])

    def every(self, width: int) -> np.ndarray:
        """Fingerprints of all substrings of a width, by start."""
        return mix((self.sums[width:] - self.sums[:-width]) * self.down[: len(self.sums) - width])


def sliding_argmin(keys: np.ndarray, width: int) -> np.ndarray:
    """Position of the least key in each window of ``width`` keys, the first of equal ones (40 bits compared)."""
    n = len(keys)
    low = np.uint64((1 << 24) - 1)
    if n > int(low):
        raise ValueError("too many keys at once")
    marked = (keys & ~low) | np.arange(n, dtype=np.uint64)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = marked
    blocks = padded.reshape(-1, width)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = n - width + 1
    return (np.minimum(backward[:starts], forward[width - 1 : width - 1 + starts]) & low).astype(np.int64)
