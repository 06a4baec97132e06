"""The numbers that Spark's ``XORShiftRandom`` draws, many at a time.

Its state is 64 bits, and one step is linear in them. So the states of far apart steps (lanes) come from one another
by a table of that many steps, and all lanes then go on together.
"""

from __future__ import annotations

import functools

import numpy as np

_MASK = (1 << 64) - 1
#: Steps that a lane goes, and lanes (a power of 2), of one filling.
STEPS, LANES = 64, 1_024


def _murmur(data: bytes, seed: int) -> int:
    """Scala's ``MurmurHash3.bytesHash`` of whole words."""
    h = seed
    for i in range(0, len(data), 4):
        k = int.from_bytes(data[i : i + 4], "little") * 0xCC9E2D51 & 0xFFFFFFFF
        k = (k << 15 | k >> 17) * 0x1B873593 & 0xFFFFFFFF
        h ^= k & 0xFFFFFFFF
        h = ((h << 13 | h >> 19) & 0xFFFFFFFF) * 5 + 0xE6546B64 & 0xFFFFFFFF
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & 0xFFFFFFFF
    h = (h ^ h >> 13) * 0xC2B2AE35 & 0xFFFFFFFF
    return h ^ h >> 16


def first_state(seed: int) -> int:
    data = (seed & _MASK).to_bytes(8, "big")
    low = _murmur(data, 0x3C074A61)
    return _murmur(data, low) << 32 | low


def _next(x: np.ndarray) -> np.ndarray:
    x = x ^ (x << np.uint64(21))
    x ^= x >> np.uint64(35)
    x ^= x << np.uint64(4)
    return x


def next_int(seed: int) -> int:
    """The first ``nextInt()`` of a generator with this seed."""
    x = int(_next(np.array([first_state(seed)], np.uint64))[0]) & 0xFFFFFFFF
    return x - (1 << 32) if x >> 31 else x


def _table(columns: np.ndarray) -> np.ndarray:
    """By byte of a state and its value: what it adds to the state that the linear map with these columns gives."""
    out = np.zeros((8, 256), np.uint64)
    for bit in range(8):
        with_bit = (np.arange(256) >> bit & 1).astype(bool)
        out[:, with_bit] ^= columns[bit::8, None]
    return out


def _apply(table: np.ndarray, x: np.ndarray) -> np.ndarray:
    out = np.zeros_like(x)
    for byte in range(8):
        out ^= table[byte][(x >> np.uint64(8 * byte)) & np.uint64(255)]
    return out


@functools.cache
def _jumps() -> list[np.ndarray]:
    """Tables of STEPS, 2 x STEPS, 4 x STEPS ... steps, up to those between the first lane and the middle one."""
    columns = np.uint64(1) << np.arange(64, dtype=np.uint64)
    for _ in range(STEPS):
        columns = _next(columns)
    out = [_table(columns)]
    while STEPS << len(out) < STEPS * LANES:
        columns = _apply(out[-1], columns)
        out.append(_table(columns))
    return out


class Draws:
    """``nextDouble()`` of a generator with this seed, in their order."""

    def __init__(self, seed: int):
        self._state = np.array([first_state(seed)], np.uint64)
        self._ready = np.empty(0)

    def take(self, n: int) -> np.ndarray:
        while len(self._ready) < n:
            self._ready = np.concatenate([self._ready, self._fill()])
        out, self._ready = self._ready[:n], self._ready[n:]
        return out

    def _fill(self) -> np.ndarray:
        lanes = self._state
        for table in _jumps():
            lanes = np.concatenate([lanes, _apply(table, lanes)])
        states = np.empty((STEPS, LANES), np.uint64)
        for i in range(STEPS):
            lanes = states[i] = _next(lanes)
        self._state = lanes[-1:].copy()
        pairs = states.T.reshape(-1, 2)
        high, low = pairs[:, 0] & np.uint64((1 << 26) - 1), pairs[:, 1] & np.uint64((1 << 27) - 1)
        return ((high << np.uint64(27)) + low).astype(float) * 2.0**-53
