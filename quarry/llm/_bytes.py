"""Arrays of integers as compressed bytes, and a reversible mix of 64-bit keys, for rows that carry many numbers."""

from __future__ import annotations

import numpy as np
import zstandard


def pack(*arrays: np.ndarray, width: int = 4) -> bytes:
    """Unsigned integers of `width` bytes, arrays of one length, by byte planes, compressed."""
    planes = [np.ascontiguousarray(a, f"<u{width}").view(np.uint8).reshape(-1, width).T.tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unpack(data: bytes, number: int = 1, width: int = 4) -> list[np.ndarray]:
    """The `number` arrays that pack() packed."""
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(number, width, -1)
    return [np.ascontiguousarray(r.T).view(f"<u{width}").ravel() for r in raw]


def pack_sorted(keys: np.ndarray) -> bytes:
    """Ascending unsigned 64-bit keys by their differences."""
    return pack(np.diff(keys, prepend=keys.dtype.type(0)), width=8)


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, width=8)[0], dtype=np.uint64)


_STEPS = ((30, 0xBF58476D1CE4E5B9, 0x96DE1B173F119089), (27, 0x94D049BB133111EB, 0x319642B2D24D8EC3))


def mix(keys: np.ndarray) -> np.ndarray:
    """A one-to-one mix of unsigned 64-bit keys, so that their leading bits depend on all bits."""
    x = keys.astype(np.uint64)
    for shift, factor, _ in _STEPS:
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def unmix(mixed: np.ndarray) -> np.ndarray:
    """The keys that mix() mixed."""
    x = _unshift(mixed.astype(np.uint64), 31)
    for shift, _, inverse in reversed(_STEPS):
        x = _unshift(x * np.uint64(inverse), shift)
    return x


def _unshift(x: np.ndarray, shift: int) -> np.ndarray:
    out = x
    for _ in range(64 // shift):
        out = x ^ (out >> np.uint64(shift))
    return out


def ranges(mixed: np.ndarray, buckets: int) -> np.ndarray:
    """Which of the equal ranges each mixed key is in; ascending keys have ascending ranges."""
    return ((mixed >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def runs(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each run of equal values starts, and how long it is."""
    if not len(ordered):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    return first, np.diff(np.append(first, len(ordered)))
