"""Removal of lines that repeat, or nearly repeat, an earlier line.

How many edits two lines may differ by follows the length of the shorter one: one for every
EVERY characters, MOST at most. Such lines are found by segments: a line is cut into one
more segment than it has edits, and whatever is as long or longer and within the distance
holds one of them unchanged, shifted by no more than the distance. So each line is listed
under its own segments, by its length and the segment's number, and probes the lists of
all lengths within reach with those of its substrings that may match there. A line has few own
keys but up to 265 probes, so probes are dropped where they are made unless a Bloom filter of
all own keys holds them. Lines of one list are then compared, see ``listed_links``; lines that
merely have a passage in common are mostly told apart by counts of their characters first.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staymark.llm.common import Kept, two_columns
from staymark.llm.edit_distance import within
from staymark.llm.listed_links import linked
from staymark.llm.texts import SECOND_BASE, Chunk, chunks, mix
from staymark.operators.sizing import broadcast_if_fits
from staymark.session import shuffles_deleted

EVERY = 32
MOST = 8
# Shorter lines (in characters) are compared for equality alone.
SHORTEST = 32


def allowed(length: np.ndarray, threshold: int | None) -> np.ndarray:
    """Edits between a line of that length and one as long or longer; by length, if None."""
    if threshold is None:
        return np.minimum(length // EVERY, MOST)
    return np.full_like(length, threshold)


def segments(length: np.ndarray, parts: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Start and length of each of ``parts`` segments, as even as can be, longer ones last."""
    short, longer = length // parts, length % parts
    made, start = [], np.zeros_like(length)
    for i in range(parts):
        size = short + (i >= parts - longer)
        made.append((start, size))
        start = start + size
    return made


@dataclass(frozen=True)
class Share:
    """Keys that are worked on together: those of segments of lines of ``first`` to ``last``
    characters and, if these are too many, every ``of``-th of them."""

    first: int = SHORTEST
    last: int = 1 << 31
    part: int = 0
    of: int = 1
    own_keys: int = 0

    def holds(self, keys: np.ndarray) -> np.ndarray:
        return keys % np.uint64(self.of) == np.uint64(self.part)


def line_keys(
    codes_hash,
    starts: np.ndarray,
    length: np.ndarray,
    threshold: int | None,
    probes: bool = True,
    share: Share = Share(),
) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """(which lines, a key of each, whether it is of the line's own segments).

    Probes do not repeat a line's own keys; without ``probes`` there are no others.

    ``starts`` and ``length`` of lines are in code points. The substrings probed are those
    for which the edits left and right of the segment can add up to those allowed.
    """

    def key(at, size, other, edits, i):
        salt = (other * (edits + 1) + i).astype(np.uint64) * np.uint64(0x9FB21C651E98DF25)
        return mix(codes_hash.of(at, at + size) ^ mix(salt))

    for edits in range(MOST + 1) if threshold is None else [threshold]:
        for shorter in range(edits + 1 if probes else 1):
            # The lines looked for are that much shorter, and theirs are the edits allowed.
            sought = length - shorter
            reach = (sought >= max(SHORTEST, share.first)) & (sought <= share.last)
            which = np.flatnonzero(reach & (allowed(sought, threshold) == edits))
            if not len(which):
                continue
            start_of, mine = starts[which], length[which]
            other = mine - shorter
            for i, (start, size) in enumerate(segments(other, edits + 1)):
                if not shorter:
                    yield which, key(start_of + start, size, other, edits, i), True
                # Shift s: s edits before the segment and shorter - s after it, at least.
                # Segment i has i segments before it that all differ, hence i edits or more
                # (else an earlier segment is shared), and edits - i at most after it.
                for shift in range(-edits, edits + 1) if probes else ():
                    if abs(shift) + abs(shorter - shift) > edits or not (shorter or shift):
                        continue
                    if abs(shift) > i or abs(shorter - shift) > edits - i:
                        continue
                    at = start + shift
                    fits = (at >= 0) & (at + size <= mine)
                    found = key((start_of + at)[fits], size[fits], other[fits], edits, i)
                    yield which[fits], found, False


# A line's signature counts its characters by code point modulo LETTERS, each count modulo 8 as
# four bits in which counts that differ by one differ in one bit. So a replacement turns two
# bits or fewer, and what puts a character in or takes one out turns one and changes the length.
LETTERS = 48
_COUNTS = np.array([0b0000, 0b0001, 0b0011, 0b0111, 0b1111, 0b1110, 0b1100, 0b1000], np.uint8)
_SIGNATURE = ("s0", "s1", "s2")


def signatures(codes: np.ndarray, starts: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Three words of bits of each line, given its start and length in ``codes``."""
    ends = np.cumsum(length)
    line = np.repeat(np.arange(len(starts)) * LETTERS, length)
    at = np.arange(len(line)) + np.repeat(starts - (ends - length), length)
    counts = np.bincount(line + codes[at] % np.uint32(LETTERS), minlength=len(starts) * LETTERS)
    held = _COUNTS[counts & 7].reshape(-1, LETTERS // 2, 2)
    return np.ascontiguousarray(held[:, :, 0] << np.uint8(4) | held[:, :, 1]).view(np.int64)


def _hashed(documents: DataFrame) -> DataFrame:
    return two_columns(documents).select("doc_id", F.xxhash64("text").alias("text_hash"), "text")


@dataclass
class _Lines:
    """The lines with a word of a chunk: text, number, hashes, start and length in characters,
    and where their bytes are."""

    text: np.ndarray
    number: np.ndarray
    low: np.ndarray
    high: np.ndarray
    at: np.ndarray
    length: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    @classmethod
    def of(cls, chunk: Chunk) -> _Lines:
        words, lines = chunk.words(), chunk.lines()
        filled = np.diff(np.searchsorted(words.starts, [lines.starts, lines.ends]), axis=0)[0] > 0
        first = np.searchsorted(lines.text, np.arange(chunk.n))
        number = np.arange(len(lines.text)) - first[lines.text]
        starts, ends, text = lines.starts[filled], lines.ends[filled], lines.text[filled]
        at = chunk.code_point_at(starts)
        length = chunk.code_point_at(ends) - at
        low = chunk.hashes().of(starts, ends)
        high = chunk.hashes(SECOND_BASE).of(starts, ends) ^ length.astype(np.uint64)
        return cls(text, number[filled], low, high, at, length, starts, ends)

    def distinct(self, shortest: int = SHORTEST) -> np.ndarray:
        """Which lines have that many characters or more, equal lines once."""
        long = np.flatnonzero(self.length >= shortest)
        long = long[np.lexsort((self.low[long], self.high[long]))]
        low, high = self.low[long], self.high[long]
        return np.sort(long[np.append(True, (low[1:] != low[:-1]) | (high[1:] != high[:-1]))[: len(long)]])

    def keys(
        self, chunk: Chunk, threshold: int | None, probes: bool = True, share: Share = Share()
    ) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
        """(which lines, a key of each, whether it is of their own segments), equal lines once."""
        long = self.distinct(max(SHORTEST, share.first))
        # What shares a key is compared, so one polynomial does.
        codes = Chunk(0, chunk.code_points(), chunk.offsets).hashes(polynomials=1)
        for which, keys, own in line_keys(codes, self.at[long], self.length[long], threshold, probes, share):
            if share.of > 1:
                held = share.holds(keys)
                which, keys = which[held], keys[held]
            yield long[which], keys, own


def _lines(documents: DataFrame) -> DataFrame:
    """One row per line with a word: document, number, hashes, characters, signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(2)):
                lines = _Lines.of(chunk)
                rows = pa.array(chunk.first + lines.text)
                compared = np.where(lines.length >= SHORTEST, lines.length, 0)
                signed = signatures(chunk.code_points(), lines.at, compared)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(rows),
                        batch.column(1).take(rows),
                        pa.array(lines.number, pa.int32()),
                        pa.array(lines.low.astype(np.int64)),
                        pa.array(lines.high.astype(np.int64)),
                        pa.array(lines.length, pa.int32()),
                        *[pa.array(signed[:, i]) for i in range(3)],
                    ],
                    names=["doc_id", "text_hash", "number", "low", "high", "size", *_SIGNATURE],
                )

    return _hashed(documents).mapInArrow(
        run,
        "doc_id long, text_hash long, number int, low long, high long, size int, s0 long, s1 long, s2 long",
    )


# Bits of the filter for each of the lines' own keys, and places that a key sets there.
FILTER_BITS = 8
_FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
# Bytes of the largest filter, which limits the own keys of a share; too few for any, and all
# probes are shuffled.
FILTER_BYTES = 16 << 20
# Bytes of one of Spark's bitmaps; the filter is a run of them. So many are passed on at once.
BITMAP = 4096
_BITMAPS = 256
# Shares are cut between lengths that differ by about a 256th of an octave or more.
_STEPS = 256


def _bits(keys: np.ndarray, factor: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Byte and bit of a place of each key in a filter of ``size`` bits, a power of two."""
    at = (keys * np.uint64(factor)) >> np.uint64(64 - (size.bit_length() - 1))
    return at >> np.uint64(3), (at & np.uint64(7)).astype(np.uint8)


def shares(counted: list[tuple[int, int, int]], most: int) -> list[Share]:
    """Shares of ``most`` own keys or fewer, given (least length, greatest, own keys) in order."""
    made: list[Share] = []
    for first, last, n in counted:
        before = made[-1] if made else None
        if before is not None and before.of == 1 and before.own_keys + n <= most:
            made[-1] = Share(before.first, last, own_keys=before.own_keys + n)
        else:
            of = -(-n // most)
            made += [Share(first, last, part, of, -(-n // of)) for part in range(of)]
    return made


def _shares(items: DataFrame, threshold: int | None) -> list[Share]:
    edits = f"least(size div {EVERY}, {MOST})" if threshold is None else str(threshold)
    counted = (
        items.where(F.col("size") >= SHORTEST)
        .groupBy(F.floor(F.log2("size") * _STEPS).alias("step"))
        .agg(F.min("size").alias("first"), F.max("size").alias("last"), F.sum(F.expr(f"{edits} + 1")).alias("n"))
        .orderBy("first")
        .toArrow()  # a few thousand rows
    )
    counted = list(zip(*(counted[c].to_pylist() for c in ("first", "last", "n")), strict=True))
    if FILTER_BYTES < BITMAP:
        return [Share(own_keys=sum(n for *_, n in counted))]
    return shares(counted, max(1, 8 * FILTER_BYTES // FILTER_BITS))


def _by_length(documents: DataFrame, cuts: np.ndarray) -> DataFrame:
    """text, piece: the lines of SHORTEST characters or more, those from one of the ``cuts``
    (lengths) to the next together; equal lines of a batch once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(0)):
                lines = _Lines.of(chunk)
                long = lines.distinct()
                if not len(long):
                    continue
                piece = np.searchsorted(cuts, lines.length[long], "right")
                order = np.argsort(piece, kind="stable")
                long, piece = long[order], piece[order]
                # Each line with a line break behind it.
                size = lines.ends[long] - lines.starts[long] + 1
                ends = np.cumsum(size)
                at = np.arange(ends[-1]) + np.repeat(lines.starts[long] - (ends - size), size)
                data = np.append(chunk.data, np.uint8(0))[at]
                data[ends - 1] = 0x0A
                last = np.flatnonzero(np.append(piece[1:] != piece[:-1], True))
                offsets = np.append(0, ends[last]).astype(np.int64)
                texts = pa.LargeStringArray.from_buffers(
                    len(last), pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())
                )
                columns = [texts.cast(pa.string()), pa.array(piece[last], pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, ["text", "piece"])

    texts = documents.select(F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "text string, piece int")


def _filter(documents: DataFrame, threshold: int | None, share: Share) -> np.ndarray | None:
    """A Bloom filter of a share's own keys as bytes; None if none may be so small."""
    size = max(8 * BITMAP, 1 << max(0, FILTER_BITS * share.own_keys - 1).bit_length())
    if FILTER_BYTES < BITMAP:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = np.zeros(size // 8, np.uint8)
            for chunk in chunks(batch.column(0)):
                for _, keys, _ in _Lines.of(chunk).keys(chunk, threshold, False, share):
                    for factor in _FACTORS:
                        byte, bit = _bits(keys, factor, size)
                        np.bitwise_or.at(held, byte, np.uint8(1) << bit)
            held = held.reshape(-1, BITMAP)
            some = np.flatnonzero(held.any(axis=1))
            for i in range(0, len(some), _BITMAPS):
                number = some[i : i + _BITMAPS]
                maps = pa.FixedSizeBinaryArray.from_buffers(
                    pa.binary(BITMAP), len(number), [None, pa.py_buffer(held[number].tobytes())]
                )
                yield pa.RecordBatch.from_arrays([pa.array(number), maps.cast(pa.binary())], ["number", "bits"])

    maps = documents.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "number long, bits binary")
    with shuffles_deleted(documents.sparkSession):
        found = maps.groupBy("number").agg(F.bitmap_or_agg("bits").alias("bits")).toArrow()  # the filter's size
    held = np.zeros((size // 8 // BITMAP, BITMAP), np.uint8)
    for number, bits in zip(found["number"].to_pylist(), found["bits"].to_pylist(), strict=True):
        held[number] = np.frombuffer(bits, np.uint8)
    return held.ravel()


def _keyed(
    documents: DataFrame, shared: Broadcast | None, threshold: int | None, share: Share = Share()
) -> DataFrame:
    """key, line (both hashes in one), own: each line under the keys of its own segments and, of
    those that it probes, under what the filter (if any) lets pass; of a share's keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None if shared is None else shared.value
        for batch in batches:
            for chunk in chunks(batch.column(0)):
                lines = _Lines.of(chunk)
                line = (lines.low ^ lines.high).astype(np.int64)
                made = []
                for which, keys, own in lines.keys(chunk, threshold, share=share):
                    for factor in _FACTORS if not own and held is not None else ():
                        byte, bit = _bits(keys, factor, 8 * len(held))
                        passed = np.flatnonzero(held[byte] >> bit & np.uint8(1))
                        which, keys = which[passed], keys[passed]
                    if len(which):
                        made.append((keys.astype(np.int64), line[which], np.full(len(which), own)))
                if made:
                    columns = [pa.array(np.concatenate(c)) for c in zip(*made, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, ["key", "line", "own"])

    texts = documents.select(F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "key long, line long, own boolean")


def _entries(documents: DataFrame, threshold: int | None, share: Share, kept: Kept, label: str) -> DataFrame:
    """key, line, own of a share's lists that hold a line by its own segment and another line."""
    held = _filter(documents, threshold, share)
    shared = None if held is None else documents.sparkSession.sparkContext.broadcast(held)
    # Keys are shuffled once and not stored: most of them are of no use.
    same = Window.partitionBy("key")
    seen = _keyed(documents, shared, threshold, share).select(
        "key", "line", "own", F.max("own").over(same).alias("some"),
        F.min("line").over(same).alias("lo"), F.max("line").over(same).alias("hi"),
    )
    listed = seen.where("some AND lo <> hi").groupBy("key", "line").agg(F.max("own").alias("own"))
    entries = kept.write(listed, label)
    if shared is not None:
        shared.destroy()
    return entries


def _lists(documents: DataFrame, items: DataFrame, threshold: int | None, kept: Kept) -> DataFrame:
    """key, item, first, own, about (length, signature) of the lists that hold a line by its own
    segment and another line."""
    made = _shares(items, threshold) or [Share()]
    if len(made) == 1:
        entries = [_entries(documents, threshold, made[0], kept, "entries")]
    else:
        # Who probes a share's lines may be longer by the edits allowed.
        reach = MOST if threshold is None else threshold
        cuts = np.unique([end for s in made for end in (s.first, s.last + reach + 1)])
        texts = kept.write_folders(_by_length(documents, cuts), "lengths", "piece")
        entries = []
        for number, share in enumerate(made):
            first, last = np.searchsorted(cuts, [share.first, share.last + reach], "right").tolist()
            of_share = texts.where(F.col("piece").between(first, last))
            entries.append(_entries(of_share, threshold, share, kept, f"entries-{number}"))
        kept.drop("lengths")
    line = F.col("low").bitwiseXOR(F.col("high")).alias("line")
    about = F.struct("size", *_SIGNATURE).alias("about")
    about = items.select(line, "item", F.col("place.doc_id").alias("first"), about)
    return reduce(DataFrame.unionByName, entries).join(about, "line").drop("line")


def _fits(threshold: int | None) -> str:
    """What holds for lengths and signatures of any two lines that are near."""
    most = f"least(least(x.about.size, y.about.size) div {EVERY}, {MOST})" if threshold is None else threshold
    turned = " + ".join(f"bit_count(x.about.{s} ^ y.about.{s})" for s in _SIGNATURE)
    longer = "abs(x.about.size - y.about.size)"
    return f"{longer} <= {most} AND {turned} + {longer} <= 2 * {most}"


def _texts_of(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """item and its line, for items with a place (text_hash, number)."""
    met = _hashed(documents).join(broadcast_if_fits(wanted), "text_hash")
    line = F.get(F.split("text", "\n", -1), F.col("number"))
    return met.select("item", line.alias("line")).groupBy("item").agg(F.min("line").alias("line"))


def _verified(pairs: DataFrame, lines: DataFrame, threshold: int | None) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            shorter = np.minimum(frame["x"].str.len(), frame["y"].str.len()).to_numpy(np.int64)
            edits = allowed(shorter, threshold).tolist()
            near = [within(x, y, k) for x, y, k in zip(frame["x"], frame["y"], edits, strict=True)]
            yield frame[near][["a", "b"]]

    both = pairs.join(lines.toDF("a", "x"), "a").join(lines.toDF("b", "y"), "b")
    return both.mapInPandas(run, "a long, b long")


def repeated_lines(
    documents: DataFrame, threshold: int | None = None, kept: Kept | None = None
) -> DataFrame:
    """doc_id, text_hash, number, near of every line to remove.

    Equal lines, and lines of SHORTEST characters or more within ``threshold`` edits (those
    that ``allowed`` gives for the shorter one's length, if None), are linked; of each component the line of the smallest (doc_id, number) stays. Rows without
    doc_id come last. Blank lines (ASCII white space only) are never removed. Rows that
    share a doc_id count as one document, so the same line number of such rows is not a
    repetition. ``near`` tells removed lines that equal no line that stays.
    """
    kept = kept or Kept(documents.sparkSession)
    lines = kept.write(_lines(documents), "lines")
    place = F.struct(F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("doc_id"), "number", "text_hash")
    # One item per distinct line: copies end here, aggregated before the shuffle.
    items = lines.groupBy("low", "high").agg(
        F.min(place).alias("place"),
        F.first("size").alias("size"),
        *[F.first(x).alias(x) for x in _SIGNATURE],
    )
    items = kept.write(items.withColumn("item", F.monotonically_increasing_id()), "items")
    listed = kept.write(_lists(documents, items, threshold, kept), "lists")
    kept.drop_others("lines", "items", "lists")

    def check(pairs: DataFrame) -> DataFrame:
        pairs = kept.write(pairs, "pairs")
        ends = pairs.select(F.explode(F.array("a", "b")).alias("item")).distinct()
        places = items.select("item", "place.text_hash", "place.number")
        found = kept.write(_texts_of(documents, ends.join(places, "item")), "texts")
        return _verified(pairs, found, threshold)

    # Of lines that are near, one holds an own segment of the other in its list.
    found = linked(listed, check, kept, _fits(threshold), lead="own")
    kept.drop_others("lines", "items", "components")
    grouped = items.join(found, items["item"] == found["node"], "left").select(
        "low", "high", "place", F.coalesce("component", "item").alias("component")
    )
    firsts = grouped.groupBy("component").agg(F.min("place").alias("stays"))
    judged = grouped.join(firsts, "component").select(
        "low", "high", "stays", (F.col("place") != F.col("stays")).alias("near")
    )
    same = (F.col("stays.doc_id") == F.coalesce("doc_id", F.lit((1 << 63) - 1))) & (
        F.col("stays.number") == F.col("number")
    )
    return (
        lines.select("doc_id", "text_hash", "number", "low", "high")
        .join(judged, ["low", "high"])
        .where(~same | (F.col("doc_id").isNull() & (F.col("stays.text_hash") != F.col("text_hash"))))
        .select("doc_id", "text_hash", "number", "near")
    )


def remove_repeated_lines(documents: DataFrame, threshold: int | None = None) -> DataFrame:
    """``documents`` with repeated lines taken out of their texts.

    Columns of the input stay (text_hash, drops and n_near are replaced, if it has them),
    with text changed and these added: n_lines (lines with a word), n_removed and n_near
    (of these, near but not equal to one that stays). What remains keeps its line breaks; a
    text without repeated lines stays as it is; null stays null with no lines. See
    ``repeated_lines`` for what is removed.
    """
    kept = Kept(documents.sparkSession)
    removed = repeated_lines(documents, threshold, kept)
    # A group is at most the lines of one document.
    drops = removed.groupBy("doc_id", "text_hash").agg(
        F.sort_array(F.collect_set("number")).alias("drops"), F.count_if("near").alias("n_near")
    )
    drops = kept.write(drops, "drops")
    kept.drop_others("drops")
    own = ("text_hash", "drops", "n_near", "n_lines", "n_removed")
    carried = documents.drop(*own)
    key = carried["doc_id"].cast("long").eqNullSafe(drops["doc_id"])
    joined = carried.join(
        drops, key & (F.xxhash64(carried["text"].cast("string")) == drops["text_hash"]), "left"
    ).select(carried["*"], "drops", "n_near")
    spot = carried.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(spot).to_pylist()
            drops = batch.column(batch.num_columns - 2).to_pylist()
            counted, changed, n_removed = [], [], []
            for text, drop in zip(texts, drops, strict=True):
                n_removed.append(len(drop or ()))
                if drop:
                    gone = set(drop)
                    text = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone)
                changed.append(text)
            for chunk in chunks(batch.column(spot)):
                words, lines = chunk.words(), chunk.lines()
                ends = np.searchsorted(words.starts, [lines.starts, lines.ends])
                counted.append(np.bincount(lines.text[ends[1] > ends[0]], minlength=chunk.n))
            columns = batch.columns[:-2]
            columns[spot] = pa.array(changed, pa.string())
            near = batch.column(batch.num_columns - 1).fill_null(0)
            columns += [pa.array(np.concatenate(counted)), pa.array(n_removed, pa.int64()), near]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    from pyspark.sql.pandas.types import to_arrow_schema

    shape = carried.withColumn("text", F.col("text").cast("string"))
    for name in ("n_lines", "n_removed", "n_near"):
        shape = shape.withColumn(name, F.lit(None).cast("long"))
    arrow = to_arrow_schema(shape.schema)
    joined = joined.withColumn("text", F.col("text").cast("string"))
    return joined.mapInArrow(run, shape.schema)
