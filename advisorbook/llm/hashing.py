"""Hashes of all stretches of a byte array at once."""

import numpy as np

from advisorbook.llm.common import worker_cache

# Odd multipliers.
BASE, MIX, NEXT = 0xD6E8FEB86659FD93, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least ``n`` powers of the base and of its inverse, modulo 2**64."""
    kept = worker_cache("powers")
    if len(kept.get("up", ())) < n:
        n = max(n, 1 << 20)
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            kept[name] = np.cumprod(steps, dtype=np.uint64)
    return kept["up"], kept["down"]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(MIX)
    return h ^ (h >> np.uint64(29))


class Stretches:
    """Polynomial hashes of stretches of bytes; equal bytes hash alike wherever they stand."""

    def __init__(self, data: np.ndarray) -> None:
        up, self.down = powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=self.sums[1:])

    def between(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """The hashes from each start to its stop, before mixing."""
        return (self.sums[stop] - self.sums[start]) * self.down[start]

    def all_of(self, size: int) -> np.ndarray:
        """The mixed hashes of all stretches of one size."""
        n = len(self.sums) - size
        return mix((self.sums[size:] - self.sums[:n]) * self.down[:n])
