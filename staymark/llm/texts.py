"""Words, lines and hashes of whole batches of texts, as numpy arrays.

A batch is worked on as one run of UTF-8 bytes with the offsets of its texts, so the
cost per text is small however short it is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa

# Bytes of text worked on at once; a longer text is a piece of its own. Hashes keep powers for
# one place more, rounded up to a power of two: so they just fit.
CHUNK_BYTES = (1 << 20) - 1

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
# The field of the polynomial hashes, and the seeds that their bases are drawn from: two bases
# for each hash. A power of two as modulus would make some strings of any two letters equal
# under every base, however long.
_PRIME = (1 << 31) - 1
_BASE = 20_240_601
SECOND_BASE = 20_240_602


def mix(h: np.ndarray) -> np.ndarray:
    """Finish 64-bit hashes, so that every bit of the result depends on all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _reduced(x: np.ndarray) -> np.ndarray:
    """``x`` modulo the prime, by folding its high bits onto its low ones."""
    prime, bits = np.uint64(_PRIME), np.uint64(31)
    x = (x & prime) + (x >> bits)
    x = (x & prime) + (x >> bits)
    x = (x & prime) + (x >> bits)
    return np.where(x >= prime, x - prime, x)


def _run(base: int, size: int) -> np.ndarray:
    """base ** i modulo the prime, for i below ``size``, doubled up from the first."""
    powers = np.ones(size, np.uint64)
    done = 1
    while done < size:
        more = min(done, size - done)
        powers[done : done + more] = _reduced(powers[:more] * np.uint64(pow(base, done, _PRIME)))
        done += more
    return powers


@cache
def _bases(seed: int) -> list[int]:
    rng = np.random.default_rng(seed)
    return [int(b) for b in rng.integers(1 << 20, _PRIME - 1, 2)]


def _made_powers(base: int, size: int) -> np.ndarray:
    return _run(base, size).astype(np.uint32)


_kept_powers = lru_cache(maxsize=8)(_made_powers)


def _powers(base: int, size: int) -> np.ndarray:
    """Powers of a base. Those of usual sizes are kept, those that a very long text needs
    are not."""
    if size > 2 * CHUNK_BYTES:
        return _made_powers(base, size)
    return _kept_powers(base, 1 << max(16, (size - 1).bit_length()))


@dataclass
class Chunk:
    """Some texts of a batch: their bytes, and where each starts (and the last ends)."""

    first: int  # index in the batch
    data: np.ndarray
    offsets: np.ndarray

    @property
    def n(self) -> int:
        return len(self.offsets) - 1

    def lowered(self) -> Chunk:
        """A-Z as a-z, everything else as it is."""
        return Chunk(self.first, _LOWER[self.data], self.offsets)

    def hashes(self, seed: int = _BASE, polynomials: int = 2) -> RangeHash:
        return RangeHash(self.data, seed, polynomials)

    def code_points(self) -> np.ndarray:
        """Code points of the texts, one after another."""
        return np.frombuffer(self.data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), "<u4")

    def code_point_at(self, positions: np.ndarray) -> np.ndarray:
        """Where the character at each byte position lies among the code points."""
        starts = np.concatenate([[0], np.cumsum((self.data & 0xC0) != 0x80)])
        return starts[positions]

    def words(self) -> Spans:
        """Runs of bytes other than space, tab, LF, VT, FF and CR."""
        return self._runs(~_SPACE[self.data])

    def lines(self) -> Spans:
        r"""Parts between ``\n``, blank ones included; every text has at least one."""
        breaks = np.flatnonzero(self.data == 0x0A)
        starts = np.sort(np.concatenate([self.offsets[:-1], breaks + 1]), kind="stable")
        ends = np.sort(np.concatenate([self.offsets[1:], breaks]), kind="stable")
        per_text = 1 + np.diff(np.searchsorted(breaks, self.offsets))
        return Spans(starts, ends, np.repeat(np.arange(self.n), per_text))

    def _runs(self, inside: np.ndarray) -> Spans:
        size = len(inside)
        before, after = np.empty(size, bool), np.empty(size, bool)
        if size:
            before[0] = after[-1] = False
            before[1:], after[:-1] = inside[:-1], inside[1:]
            cuts = self.offsets[(self.offsets > 0) & (self.offsets < size)]
            before[cuts] = False
            after[cuts - 1] = False
        starts = np.flatnonzero(inside & ~before)
        ends = np.flatnonzero(inside & ~after) + 1
        return Spans(starts, ends, np.searchsorted(self.offsets, starts, "right") - 1)


@dataclass
class Spans:
    """Byte ranges in a chunk, ascending, and the text each lies in."""

    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray

    def bounds(self, n: int) -> np.ndarray:
        """Index of the first span of each of ``n`` texts, and the end."""
        return np.searchsorted(self.text, np.arange(n + 1))


class RangeHash:
    """62-bit hashes of any ranges of an array, each in constant time: two polynomials modulo a
    prime, so ranges that differ are seldom equal, whatever they hold. One of them (31 bits) takes
    half the time and does where what it brings together is compared anyway."""

    def __init__(self, data: np.ndarray, seed: int = _BASE, polynomials: int = 2):
        values, size = data.astype(np.uint64) + np.uint64(1), len(data)
        wide = data.dtype.itemsize > 1 or size > 1 << 22  # sums would leave 64 bits
        self._size, self._parts = size, []
        for base in _bases(seed)[:polynomials]:
            power = _powers(base, size + 1)
            terms = values * power[:size]
            sums = np.zeros(size + 1, np.uint64)
            np.cumsum(_reduced(terms) if wide else terms, out=sums[1:])
            self._parts.append((sums, power, np.uint64(pow(base, -size, _PRIME))))

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        found = []
        for sums, power, back in self._parts:
            # Moved up to the end of the array, whose power is then taken off all alike.
            moved = _reduced(_reduced(sums[ends] - sums[starts]) * power[self._size - starts])
            found.append(_reduced(moved * back))
        return mix(found[0] if len(found) == 1 else (found[0] << np.uint64(31)) | found[1])


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The texts of an Arrow array in order; null counts as empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(texts))
        part = offsets[first : last + 1]
        yield Chunk(first, data[part[0] : part[-1]], part - part[0])
        first = last


def shingle_sets(chunk: Chunk, width: int = 5) -> list[np.ndarray]:
    """Per text, the sorted distinct hashes of its word shingles (lower-cased A-Z).

    A text of fewer words than ``width`` has its whole sequence as its one shingle; one
    without words has none.
    """
    low = chunk.lowered()
    words = low.words()
    hashed = low.hashes().of(words.starts, words.ends)
    bounds = words.bounds(chunk.n)
    rolled = _rolled(hashed, width)
    sets = []
    for first, last in zip(bounds[:-1], bounds[1:], strict=True):
        if last - first >= width:
            sets.append(np.unique(rolled[first : last - width + 1]))
        elif last > first:
            sets.append(mix(_rolled(hashed[first:last], last - first) + np.uint64(last - first)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def windows(hashed: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` successive values."""
    return _rolled(hashed, width)


def _rolled(hashed: np.ndarray, width: int) -> np.ndarray:
    count = max(0, len(hashed) - width + 1)
    total = np.zeros(count, np.uint64)
    factor = 1
    for i in range(width):
        factor = factor * 0xD1342543DE82EF95 % (1 << 64)
        total += hashed[i : i + count] * np.uint64(factor)
    return mix(total)
