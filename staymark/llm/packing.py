"""Best-fit packing of documents into token sequences, by matching large items.

Lengths are whole numbers up to the capacity, so how many pieces there are of each length
decides the packing. Spark counts the lengths; the driver packs the counts (at most one
number per length, whatever the size of the data) into blocks of equal sequences; and
each piece finds its place from its rank among the pieces of its length. The packing is
thus one over all data, though no task ever holds more than its own pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staymark.llm.byte_bpe import encoder, text_groups
from staymark.llm.common import Kept, two_columns

CAPACITY = 1024
END_ID = 2

_PIECES = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, slice int, place long"
)
_PACKED = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, "
    "sequence_id long, offset long"
)


@dataclass
class Block:
    """``bins`` sequences with the same contents: (length, how many of it in each)."""

    bins: int
    room: int
    contents: list[tuple[int, int]]

    def filled(self, bins: int, length: int, each: int) -> Block:
        return Block(bins, self.room - length * each, [*self.contents, (length, each)])


def match_large(counts: dict[int, int], capacity: int) -> list[Block]:
    """Sequences of the pieces over a third of the capacity, of which two at most fit.

    From the longest on, each is paired with the longest other that fits beside it.
    """
    left = {n: c for n, c in counts.items() if 3 * n > capacity and c > 0}
    blocks = []
    for n in sorted(left, reverse=True):
        while left.get(n):
            partner = max((m for m in left if m <= capacity - n and left[m]), default=None)
            if partner == n and left[n] == 1:
                partner = max((m for m in left if m < n and left[m]), default=None)
            if partner is None:
                bins, contents = left[n], [(n, 1)]
            elif partner == n:
                bins, contents = left[n] // 2, [(n, 2)]
            else:
                bins, contents = min(left[n], left[partner]), [(n, 1), (partner, 1)]
            for length, each in contents:
                left[length] -= bins * each
            blocks.append(Block(bins, capacity - sum(m * k for m, k in contents), contents))
    return blocks


def pack_counts(counts: dict[int, int], capacity: int = CAPACITY) -> list[Block]:
    """A packing of ``counts`` pieces of each length.

    The smaller pieces follow in descending length, each where the least room that
    suffices is left, in a new sequence only if there is none.
    """
    by_room: dict[int, list[Block]] = {}

    def put(block: Block) -> None:
        by_room.setdefault(block.room, []).append(block)

    for block in match_large(counts, capacity):
        put(block)
    for length in sorted((n for n, c in counts.items() if 3 * n <= capacity and c > 0), reverse=True):
        left = counts[length]
        rooms = sorted(room for room in by_room if room >= length)
        for room in [*rooms, None]:
            if room is None:
                waiting = [Block(-(-left // (capacity // length)), capacity, [])] if left else []
                room = capacity
            else:
                waiting = by_room.pop(room)
            each = room // length
            for block in waiting:
                full = min(block.bins, left // each)
                if full:
                    put(block.filled(full, length, each))
                    left -= full * each
                if full < block.bins and left:
                    put(block.filled(1, length, left))
                    full, left = full + 1, 0
                if full < block.bins:
                    put(Block(block.bins - full, block.room, block.contents))
    return [block for blocks in by_room.values() for block in blocks]


def places(blocks: list[Block]) -> pd.DataFrame:
    """For each length and run of ranks: first sequence, pieces in each, first offset."""
    rows, given, sequence = [], {}, 0
    for block in blocks:
        offset = 0
        for length, each in block.contents:
            first = given.get(length, 0)
            rows.append((length, first, sequence, each, offset))
            given[length] = first + block.bins * each
            offset += length * each
        sequence += block.bins
    frame = pd.DataFrame(rows, columns=["length", "first", "sequence", "each", "offset"])
    return frame.astype("int64").sort_values(["length", "first"], ignore_index=True)


def cut(total: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; only the first may be short."""
    first = total - capacity * (-(-total // capacity) - 1)
    return [(0, first), *((s, capacity) for s in range(first, total, capacity))]


def pieces(documents: DataFrame, tokenizer: str, capacity: int, end_id: int) -> DataFrame:
    """Pieces of all documents with checksums of their ids, numbered within each slice
    (task) and length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        encode = encoder(tokenizer)
        for batch in batches:
            keys, texts = (column.to_pylist() for column in batch.columns)
            for group in text_groups(texts):
                rows = []
                for i, ids in zip(group, encode([texts[i] or "" for i in group]), strict=True):
                    wide = np.append(ids.astype("<u4"), np.uint32(end_id))
                    for k, (start, length) in enumerate(cut(len(wide), capacity)):
                        crc = zlib.crc32(wide[start : start + length])
                        rows.append((keys[i], k, start, length, crc, part, int(seen[length])))
                        seen[length] += 1
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    names = [c.split()[0] for c in _PIECES.split(", ")]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
    return two_columns(documents).mapInArrow(run, _PIECES)


def pack(
    documents: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens.

    Documents are the ids of their text and ``end_id``; only those over the capacity are
    cut, and only their first piece may be shorter. One row per piece: doc_id, piece,
    start, length, ids_crc32, sequence_id, offset. Null and empty texts are one end id;
    rows that repeat, also with the same or a null doc_id, are packed each; a table
    without rows gives none. Other columns of the input are not read.
    """
    spark = documents.sparkSession
    kept = Kept(spark)
    cuts = kept.write(pieces(documents, tokenizer, capacity, end_id), "pieces")
    # A row for each task and length that occurs in it.
    held = cuts.groupBy("slice", "length").agg((F.max("place") + 1).alias("held"))
    before = Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    held = kept.write(
        held.withColumn("base", F.coalesce(F.sum("held").over(before), F.lit(0))), "held"
    )
    # At most ``capacity`` rows.
    counts = held.groupBy("length").agg(F.sum("held").alias("n")).collect()
    plan = places(pack_counts({r["length"]: r["n"] for r in counts}, capacity))
    step = np.int64(1 << 50)  # ranks stay below it
    search = plan["length"].to_numpy() * step + plan["first"].to_numpy()
    first, sequence, each, offset = (
        plan[c].to_numpy() for c in ("first", "sequence", "each", "offset")
    )

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            length, rank = frame["length"].to_numpy(), frame["rank"].to_numpy()
            row = np.searchsorted(search, length * step + rank, "right") - 1
            nth = rank - first[row]
            frame["sequence_id"] = sequence[row] + nth // each[row]
            frame["offset"] = offset[row] + nth % each[row] * length
            yield frame.drop(columns="rank")

    ranked = cuts.join(held.drop("held"), ["slice", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("place")).alias("rank")
    )
    return ranked.mapInPandas(place, _PACKED)
