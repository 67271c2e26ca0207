"""Vectors as short codes: for each part of a vector, the nearest entry of its codebook.

Components become integers, so results do not depend on the order of any sum. Nearest entries
are found by slices: the entries' coordinates are sorted in every dimension, and behind each
sorted coordinate stands the bit mask of all entries up to it. The distance to a guessed entry
is the radius; in every dimension the entries within it are the difference of two prefix masks,
and what all dimensions have in common are the candidates, of which none can be nearer than
found. Candidates alone are measured, exactly.

Every round reads all vectors, adds them up by part and entry inside each task, and brings no
more than the codebooks to the driver (parts x entries rows).

Awkward input: vectors that are NULL, empty, or hold NULL or non-finite components are left
out; shorter vectors and lengths that are no multiple of the parts are filled with zeros;
rows without vec_id are coded but begin no codebook before those with one; of equal vec_ids the
smaller vectors come first; with fewer vectors than entries the codebooks are as short. Sums and
distances are exact at any magnitude; an error that no long can hold is NULL, and so is the
error of its label. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staymark.llm.common import Kept, join_counted

PARTS = 8
# Entries of a codebook; a mask has 64 bits.
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
# Dimensions, those of the widest spread, that guess an entry each for the radius.
GUESSES = 2
_LIMB = 40
_LONG = (1 << 63) - 1
_FIELDS = "vec_id long, label string, embedding array<double>"


def usable() -> Column:
    """Whether a row's vector has components, all of them finite numbers."""

    def broken(x: Column) -> Column:
        return x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))

    vector = F.col("embedding").cast("array<double>")
    return F.coalesce((F.size(vector) > 0) & ~F.exists(vector, broken), F.lit(False))


def _vectors(embeddings: DataFrame) -> DataFrame:
    return embeddings.where(usable()).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("string").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )


def _whole(x: float) -> int:
    """floor(SCALE * x) of any finite x; beyond 2^53 it is an integer already."""
    return int(x) * SCALE if abs(x) > 2.0**53 else math.floor(x * SCALE)


def _small(largest: int, dimension: int) -> bool:
    """Whether squared distances of such integers stay within 64 bits."""
    return 4 * largest * largest * dimension < 1 << 62


def integers(vectors: pa.Array, dimension: int) -> np.ndarray:
    """The vectors as integers, filled with zeros: int64 where that is exact, else objects."""
    lengths = np.asarray(vectors.value_lengths())
    values = np.asarray(vectors.flatten())
    filled = np.zeros((len(lengths), dimension))
    filled[np.arange(dimension) < lengths[:, None]] = values
    largest = np.abs(values).max(initial=0.0)
    if largest < 2.0**40 and _small(int(largest * SCALE) + 1, dimension):
        return np.floor(filled * SCALE).astype(np.int64)
    return np.array([[_whole(x) for x in row] for row in filled.tolist()], object).reshape(filled.shape)


@dataclass
class Codebook:
    """Entries of one part, with their coordinates sorted and masked in every dimension."""

    entries: list[list[int]]

    def __post_init__(self) -> None:
        largest = max((abs(x) for e in self.entries for x in e), default=0)
        self.width = len(self.entries[0])
        self.exact = _small(largest, self.width * PARTS)
        self.table = np.array(self.entries, np.int64 if self.exact else object).reshape(-1, self.width)
        bits = np.uint64(1) << np.arange(len(self.table), dtype=np.uint64)
        self.order = [np.argsort(self.table[:, d], kind="stable") for d in range(self.width)]
        self.sorted = [self.table[order, d] for d, order in enumerate(self.order)]
        nothing = np.zeros(1, np.uint64)
        self.prefix = [np.concatenate([nothing, np.bitwise_or.accumulate(bits[order])]) for order in self.order]
        spread = [int(s[-1]) - int(s[0]) for s in self.sorted]
        self.widest = sorted(range(self.width), key=lambda d: (-spread[d], d))[:GUESSES]

    def _distances(self, values: np.ndarray, entry: np.ndarray | int) -> np.ndarray:
        apart = values - self.table[entry]
        return (apart * apart).sum(axis=1)

    def _radius(self, values: np.ndarray) -> np.ndarray:
        """A distance within which each row has an entry: that of the best guess."""
        best = None
        for d in self.widest:
            after = np.searchsorted(self.sorted[d], values[:, d]).clip(0, len(self.table) - 1)
            before = (after - 1).clip(0)
            nearer = values[:, d] - self.sorted[d][before] < self.sorted[d][after] - values[:, d]
            guess = self.order[d][np.where(nearer.astype(bool), before, after)]
            far = self._distances(values, guess)
            best = far if best is None else np.minimum(best, far)
        if values.dtype == object:
            return np.array([math.isqrt(x) for x in best], object)
        # One more than the root, which is rounded.
        return np.sqrt(best.astype(np.float64)).astype(np.int64) + 1

    def candidates(self, values: np.ndarray) -> np.ndarray:
        """A mask for each row, with the bits of all entries that may be its nearest."""
        radius = self._radius(values)
        mask = np.full(len(values), ~np.uint64(0))
        for d in range(self.width):
            low = np.searchsorted(self.sorted[d], values[:, d] - radius, "left")
            high = np.searchsorted(self.sorted[d], values[:, d] + radius, "right")
            mask &= self.prefix[d][high] ^ self.prefix[d][low]
        return mask

    def nearest(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry of each row, the lowest of equal ones, and its distance."""
        if not self.exact:
            values = values.astype(object)
        mask = self.candidates(values)
        code = np.full(len(values), -1)
        error = np.zeros(len(values), values.dtype)
        for entry in range(len(self.table)):
            rows = np.flatnonzero((mask >> np.uint64(entry)) & np.uint64(1))
            far = self._distances(values[rows], entry)
            closer = ((code[rows] < 0) | (far < error[rows])).astype(bool)
            code[rows[closer]], error[rows[closer]] = entry, far[closer]
        return code, error


@dataclass
class Codebooks:
    """One codebook for each part position of vectors of ``dimension`` (filled) components."""

    dimension: int
    books: list[Codebook]

    @classmethod
    def of(cls, vectors: list[list[int]], parts: int = PARTS) -> Codebooks:
        """Codebooks whose entries are the parts of some vectors."""
        width = len(vectors[0]) // parts
        return cls(len(vectors[0]), [Codebook([v[p * width : (p + 1) * width] for v in vectors]) for p in range(parts)])

    def coded(self, values: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """part, its values, codes and errors, for each part of whole vectors."""
        for part, book in enumerate(self.books):
            own = values[:, part * book.width : (part + 1) * book.width]
            yield part, own, *book.nearest(own)

    def sha256(self) -> str:
        """Of all components in decimal by part, entry and place."""
        every = ",".join(str(x) for book in self.books for entry in book.entries for x in entry)
        return hashlib.sha256(every.encode()).hexdigest()


def _limbs(value: int) -> list[int]:
    """``value`` as signed top and unsigned lower numbers of 40 bits, lowest first."""
    limbs = []
    while not -(1 << _LIMB) <= value < 1 << _LIMB:
        limbs.append(value & ((1 << _LIMB) - 1))
        value >>= _LIMB
    return [*limbs, value]


def _sums(vectors: DataFrame, codebooks: Codebooks) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """By part and entry: how many parts are assigned to it, and their sum.

    A task sends one row for each part and entry; sums are split into limbs, so that no sum
    over any number of tasks overflows.
    """
    shared = vectors.sparkSession.sparkContext.broadcast(codebooks)
    width = codebooks.books[0].width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list] = {}
        for batch in batches:
            for part, own, code, _ in shared.value.coded(integers(batch.column(0), codebooks.dimension)):
                for entry in np.unique(code).tolist():
                    chosen = own[code == entry]
                    at = held.setdefault((part, entry), [0, [0] * width])
                    at[0] += len(chosen)
                    at[1] = [a + int(b) for a, b in zip(at[1], chosen.sum(axis=0), strict=True)]
        rows = []
        for (part, entry), (count, total) in held.items():
            limbs = [_limbs(x) for x in total]
            for place in range(max(map(len, limbs))):
                rows.append((part, entry, place, count if place == 0 else 0, [x[place] if place < len(x) else 0 for x in limbs]))
        if rows:
            kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())]
            names = ["part", "entry", "limb", "parts", "sums"]
            columns = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names)

    partial = vectors.select("embedding").mapInArrow(run, "part int, entry int, limb int, parts long, sums array<long>")
    total = partial.groupBy("part", "entry", "limb").agg(
        F.sum("parts").alias("parts"), *[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)]
    )
    found: dict[tuple[int, int], tuple[int, list[int]]] = {}
    for row in total.collect():  # parts x entries x limbs
        count, sums = found.get((row["part"], row["entry"]), (0, [0] * width))
        more = [x + (row[f"s{i}"] << (_LIMB * row["limb"])) for i, x in enumerate(sums)]
        found[row["part"], row["entry"]] = (count + row["parts"], more)
    return found


def fit(vectors: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS, parts: int = PARTS) -> Codebooks | None:
    """Codebooks of ``vectors`` (see ``_vectors``) after some rounds; None without vectors."""
    size = vectors.agg(F.max(F.size("embedding")).alias("size")).first()["size"]
    if size is None:
        return None
    dimension = -(-size // parts) * parts
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).collect()
    began = pa.array([r["embedding"] for r in first], pa.list_(pa.float64()))
    codebooks = Codebooks.of([[int(x) for x in row] for row in integers(began, dimension)], parts)
    for _ in range(rounds):
        moved = _sums(vectors, codebooks)
        books = []
        for part, book in enumerate(codebooks.books):
            entries_now = [list(e) for e in book.entries]
            for entry in range(len(entries_now)):
                if (part, entry) in moved:
                    count, total = moved[part, entry]
                    entries_now[entry] = [x // count for x in total]
            books.append(Codebook(entries_now))
        codebooks = Codebooks(dimension, books)
    return codebooks


def encode(vectors: DataFrame, codebooks: Codebooks) -> DataFrame:
    """vec_id, label, code (two hex digits a part) and error of each of ``vectors``."""
    shared = vectors.sparkSession.sparkContext.broadcast(codebooks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, errors = [], 0
            for _, _, code, error in shared.value.coded(integers(batch.column(2), codebooks.dimension)):
                codes.append(code.astype(np.uint8))
                errors = errors + error
            digits = np.stack(codes, axis=1)
            shown = [digits[i].tobytes().hex() for i in range(len(digits))]
            held = [int(x) if x <= _LONG else None for x in errors.tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(shown, pa.string()), pa.array(held, pa.int64())],
                ["vec_id", "label", "code", "error"],
            )

    return vectors.mapInArrow(run, "vec_id long, label string, code string, error long")


def compress(embeddings: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every usable vector.

    Labels that hold a thousandth of the rows are looked up in a broadcast (there are at most
    a thousand of them), all others in a shuffle.
    """
    vectors, kept = _vectors(embeddings), Kept(embeddings.sparkSession)
    codebooks = fit(vectors)
    if codebooks is None:
        nothing = vectors.select("vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
        return nothing.withColumns({"label_error": F.col("error"), "codebooks_sha256": F.lit("")})
    coded = kept.write(encode(vectors, codebooks), "coded")
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    known = F.count("*") == F.count("error")
    summed = coded.groupBy("label").agg(
        F.count("*").alias("rows"),
        F.when(known & (total <= _LONG), total).cast("long").alias("label_error"),
    )
    by_label = kept.write(summed, "labels")
    return join_counted(coded, by_label, ["label"], "rows").select(
        "vec_id", "code", "error", "label_error", F.lit(codebooks.sha256()).alias("codebooks_sha256")
    )
