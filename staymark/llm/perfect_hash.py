"""Minimal perfect hash of a set of keys, with fingerprints, as a small binary block.

Levels of bit arrays: on each level a key that meets no other at its bit sets it and is
done; the others go to the next, smaller level. A key's number is the rank of its bit, so
n keys get the numbers 0 to n - 1, and a key is found by looking at a few bits. A stored
fingerprint tells keys that were never put in.
"""

from __future__ import annotations

import struct
from collections.abc import Sequence

import numpy as np
import xxhash

from staymark.llm.texts import mix

_SPACIOUS = 2  # bits per key and level
_HEAD = struct.Struct("<4sII")
_MAGIC = b"MPH1"


def hash_keys(keys: Sequence[str]) -> np.ndarray:
    """Two 64-bit hashes of each key, as an array of shape (n, 2)."""
    joined = b"".join(xxhash.xxh3_128_digest(key) for key in keys)
    return np.frombuffer(joined, "<u8").reshape(-1, 2)


def _bits(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
    mixed = mix(hashes[:, 0] + hashes[:, 1] * np.uint64(level + 1))
    return (mixed % np.uint64(size)).astype(np.int64)


def _fingerprints(hashes: np.ndarray) -> np.ndarray:
    return (mix(hashes[:, 1]) >> np.uint64(32)).astype("<u4")


class PerfectHash:
    """Numbers for a fixed set of keys; ``find`` gives -1 for all others."""

    def __init__(self, levels: list[np.ndarray], fingerprints: np.ndarray):
        self._levels = levels
        self._fingerprints = fingerprints
        self._ranks, before = [], 0
        for level in levels:
            ranks = np.cumsum(level, dtype=np.int64) - level + before
            before += int(level.sum())
            self._ranks.append(ranks)

    @classmethod
    def of(cls, hashes: np.ndarray) -> PerfectHash:
        """Built from the hashes of distinct keys."""
        levels, left = [], hashes
        while len(left):
            if len(levels) > 200:
                raise ValueError("keys repeat")
            size = max(64, _SPACIOUS * len(left))
            at = _bits(left, len(levels), size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            left = left[~alone[at]]
        made = cls(levels, np.zeros(len(hashes), "<u4"))
        made._fingerprints[made._numbers(hashes)] = _fingerprints(hashes)
        return made

    def _numbers(self, hashes: np.ndarray) -> np.ndarray:
        numbers = np.full(len(hashes), -1, np.int64)
        open_ = np.arange(len(hashes))
        for i, (level, ranks) in enumerate(zip(self._levels, self._ranks, strict=True)):
            at = _bits(hashes[open_], i, len(level))
            hit = level[at]
            numbers[open_[hit]] = ranks[at[hit]]
            open_ = open_[~hit]
        return numbers

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each key, -1 where the fingerprint tells it was not put in."""
        numbers = self._numbers(hashes)
        known = numbers >= 0
        known[known] = self._fingerprints[numbers[known]] == _fingerprints(hashes[known])
        return np.where(known, numbers, -1)

    def to_bytes(self) -> bytes:
        parts = [_HEAD.pack(_MAGIC, len(self._levels), len(self._fingerprints))]
        for level in self._levels:
            parts += [struct.pack("<I", len(level)), np.packbits(level).tobytes()]
        return b"".join([*parts, self._fingerprints.tobytes()])

    @classmethod
    def from_bytes(cls, block: bytes) -> tuple[PerfectHash, int]:
        """The hash stored at the beginning of ``block``, and where it ends."""
        magic, levels, n = _HEAD.unpack_from(block)
        if magic != _MAGIC:
            raise ValueError("not a key index")
        at, read = _HEAD.size, []
        for _ in range(levels):
            (size,) = struct.unpack_from("<I", block, at)
            packed = np.frombuffer(block, np.uint8, -(-size // 8), at + 4)
            read.append(np.unpackbits(packed, count=size).astype(bool))
            at += 4 + len(packed)
        return cls(read, np.frombuffer(block, "<u4", n, at)), at + 4 * n
