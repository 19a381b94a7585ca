"""A minimal perfect hash over 64-bit keys, in numpy: built for one shard in one task, a few bits per key.

Level by level, keys are hashed into a bit array twice as large as their number. Keys alone in their place are done;
the others go on to the next level. A key's index is the number of bits set before its own.
"""

from __future__ import annotations

import io

import numpy as np

_LEVELS = 64


def _mix(keys: np.ndarray, level: int) -> np.ndarray:
    """A 64-bit mixing step, different for each level."""
    with np.errstate(over="ignore"):
        x = keys + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """``index(keys)`` gives 0..n-1 without collisions for the keys it was built from, and anything in range or -1 for others."""

    def __init__(self, bits: list[np.ndarray]) -> None:
        self.bits = bits
        self.ranks, total = [], 0
        for level in bits:
            before = np.concatenate(([0], np.cumsum(np.bitwise_count(level), dtype=np.int64)))
            self.ranks.append(before + total)
            total += int(before[-1])

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """``keys`` must be distinct unsigned 64-bit integers."""
        left, bits = np.asarray(keys, dtype=np.uint64), []
        for level in range(_LEVELS):
            if not len(left):
                break
            size = max(64, 2 * len(left) + 63 & ~63)
            place = _mix(left, level) % np.uint64(size)
            alone = np.bincount(place.astype(np.int64), minlength=size) == 1
            bits.append(np.packbits(alone, bitorder="little").view(np.uint64))
            left = left[~alone[place.astype(np.int64)]]
        if len(left):
            raise ValueError("keys are not distinct")
        return cls(bits)

    def index(self, keys: np.ndarray) -> np.ndarray:
        keys = np.asarray(keys, dtype=np.uint64)
        found, open_ = np.full(len(keys), -1, dtype=np.int64), np.arange(len(keys))
        for level, (words, ranks) in enumerate(zip(self.bits, self.ranks)):
            place = _mix(keys[open_], level) % np.uint64(64 * len(words))
            word, bit = (place >> np.uint64(6)).astype(np.int64), place & np.uint64(63)
            mask = np.uint64(1) << bit
            hit = words[word] & mask != 0
            below = np.bitwise_count(words[word] & (mask - np.uint64(1))).astype(np.int64)
            found[open_[hit]] = (ranks[word] + below)[hit]
            open_ = open_[~hit]
            if not len(open_):
                break
        return found


class Shard:
    """Arrays behind a perfect hash: a fingerprint that tells strangers from members, and a value or more per key."""

    def __init__(self, hash_: PerfectHash, prints: np.ndarray, values: dict[str, np.ndarray]) -> None:
        self.hash, self.prints, self.values = hash_, prints, values

    @classmethod
    def build(cls, keys: np.ndarray, prints: np.ndarray, values: dict[str, np.ndarray]) -> Shard:
        hash_ = PerfectHash.build(keys)
        order = np.argsort(hash_.index(keys))
        return cls(hash_, prints[order], {k: v[order] for k, v in values.items()})

    def lookup(self, keys: np.ndarray, prints: np.ndarray) -> np.ndarray:
        """The place of each key in the arrays, or -1 if it is no member."""
        if not len(self.prints):
            return np.full(len(keys), -1, dtype=np.int64)
        at = self.hash.index(keys)
        return np.where((at >= 0) & (self.prints[at] == prints), at, -1)

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        levels = {f"level{i:02d}": b for i, b in enumerate(self.hash.bits)}
        np.savez(out, prints=self.prints, **levels, **{f"value_{k}": v for k, v in self.values.items()})
        return out.getvalue()

    @classmethod
    def from_bytes(cls, blob: bytes) -> Shard:
        with np.load(io.BytesIO(blob)) as z:
            bits = [z[k] for k in sorted(z.files) if k.startswith("level")]
            values = {k[6:]: z[k] for k in z.files if k.startswith("value_")}
            return cls(PerfectHash(bits), z["prints"], values)
