"""Near-duplicate documents by bottom-k sketches of word shingles.

One hash function orders all shingles; a text's sketch is the K smallest hashes of its
set. Texts with the same set are one item from the start. Inverted lists of retained
values name items that may be similar:

- Two sets of similarity 0.75 share three quarters of their retained values on average,
  and OVERLAP or more but for a chance below 1e-10. The K least values are drawn from the
  union without return, so they scatter less where they are a good part of it, and more
  than OVERLAP are shared (``_overlap``). A union of less than K values is retained whole
  and has the exact bound; sets that may have either union take the lesser one.
  It suffices to list an item under its rarest values, all but as many as must be shared
  and one more: two similar items meet in one of these lists. Values of frequent passages
  are thereby hardly ever listed.
- The hub of a list is the item whose retained values are the most frequent ones: the copy
  with the fewest changes of its own is similar to the most others.
- Two items of a list whose sizes or signatures (a few bits of the same hashes) are too
  different for 0.75 are no pair.
- The sketch of the union of two sets estimates their similarity and drops most pairs.
- The rest is decided on the full sets of the whole texts.

Lists are worked off without taking all pairs, see ``listed_links``. Sketches are too small to
tell similarities little below 0.75 from it, and of many heavily edited copies of one text most
pairs have such. So the items that hub rounds on these lists leave undecided are listed
anew, each under the rarest shingles of its full set (``full_lists``): of two sets one of which
shares less than three quarters of its own with all others, no pair is made.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staymark.llm.common import Kept, two_columns
from staymark.llm.listed_links import linked
from staymark.llm.texts import chunks, shingle_sets
from staymark.operators.sizing import broadcast_if_fits

WIDTH = 5
PERCENT = 75
K = 96
OVERLAP = 42
# Bits of a signature: one for each of as many parts of the hash range, from the least
# hash there. Of sets of similarity 0.75 an eighth differ on average, and more than
# DIFFERENT but for a chance of about 2e-9. A bit differs only where a value belongs to one
# set alone, and at 0.75 those are a seventh of both sizes at most, an exact bound that
# tells short texts apart, whose signatures are mostly empty.
BITS = 192
DIFFERENT = 54
_SIGNATURE = ("s0", "s1", "s2")


def signature(hashes: np.ndarray) -> np.ndarray:
    """Three words of bits of a sorted set of hashes."""
    part = (hashes % np.uint64(BITS)).astype(np.int64)
    found, at = np.unique(part, return_index=True)  # the first, hence least, of each part
    bits = np.zeros(BITS, np.uint8)
    bits[found] = (hashes[at] // np.uint64(BITS)) & np.uint64(1)
    return np.packbits(bits).view(np.int64)


def sketches(documents: DataFrame) -> DataFrame:
    """doc_id, text_hash, n (size of the set), sketch and digest of the set per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(2)):
                sets = shingle_sets(chunk, WIDTH)
                held = [s[:K] >> np.uint64(1) for s in sets]  # as they sort when signed
                signed = np.stack([signature(s) for s in sets])
                ends = np.cumsum([0, *map(len, held)]).astype(np.int32)
                values = np.concatenate([*held, np.zeros(0, np.uint64)]).astype(np.int64)
                rows = slice(chunk.first, chunk.first + chunk.n)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[rows],
                        batch.column(1)[rows],
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(values)),
                        pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                        *[pa.array(signed[:, i]) for i in range(3)],
                    ],
                    names=["doc_id", "text_hash", "n", "sketch", "digest", *_SIGNATURE],
                )

    hashed = two_columns(documents).select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return hashed.mapInArrow(
        run,
        "doc_id long, text_hash long, n long, sketch array<long>, digest binary, s0 long, s1 long, s2 long",
    )


def _overlap(union: Column) -> Column:
    """Least number of the K least values of a union that two sets of similarity 0.75 share.

    The deviation allowed is that of draws with return, times the shrinkage of draws without.
    """
    mean = K * PERCENT // 100
    rest = F.greatest(union - K, F.lit(0)) / F.greatest(union - 1, F.lit(1))
    return F.floor(mean - (mean - OVERLAP) * F.sqrt(rest))


def lists(items: DataFrame) -> DataFrame:
    """key, item, first, about: each item under its rarest retained values that others have
    too."""
    held = items.select("item", F.col("n").alias("size"), F.explode("sketch").alias("key"))
    often = held.groupBy("key").agg(F.count("*").alias("often")).where("often > 1")
    shared = held.join(often, "key")
    # A group is at most the K values of one item.
    by_item = shared.groupBy("item", "size").agg(
        F.sort_array(F.collect_list(F.struct("often", "key"))).alias("shared"),
        F.sum("often").alias("frequent"),
    )
    retained = F.least("size", F.lit(K))
    # The union is at least as large as either set and at most 4/3 of it: whole with three
    # quarters of it shared, or K values of it.
    need = F.least(F.ceil(F.col("size") * PERCENT / 100), _overlap(F.col("size") * 100 / PERCENT))
    # Values nobody shares are the rarest and count among those listed.
    room = (retained - need + 1 - (retained - F.size("shared"))).cast("int")
    chosen = F.slice("shared", F.lit(1), F.greatest(room, F.lit(0)))
    central = -F.floor(F.col("frequent") / retained)
    listed = by_item.select(F.explode(chosen).alias("s"), "item", central.alias("first"))
    listed = listed.select("s.key", "item", "first")
    about = items.select("item", F.struct("n", *_SIGNATURE).alias("about"))
    return listed.join(about, "item")


_DIFFER = " + ".join(f"bit_count(x.about.{s} ^ y.about.{s})" for s in _SIGNATURE)
FITS = (
    "4 * least(x.about.n, y.about.n) >= 3 * greatest(x.about.n, y.about.n) "
    f"AND {_DIFFER} <= least({DIFFERENT}, (x.about.n + y.about.n) div 7)"
)
# A comparison of signatures is cheap beside the shuffles of a hub round.
PAIRS_PER_ENTRY = 512


def _estimated(pairs: DataFrame, items: DataFrame) -> DataFrame:
    """Pairs that the sketch of their union lets pass."""
    sketch = items.select("item", "sketch", "n")
    met = pairs.join(sketch.toDF("a", "sa", "na"), "a").join(sketch.toDF("b", "sb", "nb"), "b")
    union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, K)
    common = F.size(F.array_intersect(F.array_intersect("sa", "sb"), "union"))
    met = met.withColumn("union", union)
    # At 0.75 the union is at most 4/7 of both sizes together; a whole union tells exactly.
    most = F.floor((F.col("na") + F.col("nb")) * 100 / (100 + PERCENT))
    need = F.when(F.size("union") < K, F.size("union") * PERCENT / 100).otherwise(_overlap(most))
    return met.where(common >= need).select("a", "b")


# Of the shingles of two sets at 0.75, at least 3/7 of both sizes are shared: the one of a list,
# if it is the first that they share, and those that come after it in both.
FITS_FULLY = (
    "4 * least(x.about.n, y.about.n) >= 3 * greatest(x.about.n, y.about.n) "
    "AND 7 * (1 + least(x.about.n - x.about.at, y.about.n - y.about.at)) >= 3 * (x.about.n + y.about.n)"
)


def full_lists(texts: DataFrame) -> DataFrame:
    """key, item, first, about: each item under the rarest shingles of its full set, as many as
    two sets of similarity 0.75 may differ by and one more.

    ``texts`` has item and text. Shingles are in one order for all, by how many of these items
    hold them; the first one that two similar sets share is so early in both. The place in
    that order is part of about.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                items = batch.column(0)[chunk.first : chunk.first + chunk.n]
                for item, s in zip(items, shingle_sets(chunk, WIDTH), strict=True):
                    n = len(s)
                    yield pa.RecordBatch.from_arrays(
                        [pa.repeat(item, n), pa.repeat(pa.scalar(n, pa.int64()), n), pa.array(s.view(np.int64))],
                        names=["item", "n", "key"],
                    )

    held = texts.select("item", "text").mapInArrow(run, "item long, n long, key long")
    often = held.groupBy("key").agg(F.count("*").alias("often")).where("often > 1")
    mine = Window.partitionBy("item")
    # Those that no other item holds come first.
    place = F.col("n") - F.count("*").over(mine) + F.row_number().over(mine.orderBy("often", "key"))
    placed = held.join(often, "key").select("key", "item", "n", place.alias("at"))
    early = placed.where(f"at <= n - ceil({PERCENT} * n / 100) + 1")
    return early.select(
        "key", "item", F.xxhash64("item").alias("first"), F.struct("n", "at").alias("about")
    )


def _texts(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """item and a text with its set, for the items wanted."""
    hashed = two_columns(documents).select(F.xxhash64("text").alias("text_hash"), "text")
    met = hashed.join(broadcast_if_fits(wanted), "text_hash")
    return met.groupBy("item").agg(F.min("text").alias("text"))


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs whose full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left = (s for c in chunks(batch.column(2)) for s in shingle_sets(c, WIDTH))
            right = (s for c in chunks(batch.column(3)) for s in shingle_sets(c, WIDTH))
            same = []
            for x, y in zip(left, right, strict=True):
                both = len(np.intersect1d(x, y, assume_unique=True))
                same.append(100 * both >= PERCENT * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(same, pa.bool_()))

    a, b = texts.toDF("a", "ta"), texts.toDF("b", "tb")
    both = pairs.join(a, "a").join(b, "b").select("a", "b", "ta", "tb")
    return both.mapInArrow(run, "a long, b long")


def near_documents(documents: DataFrame) -> DataFrame:
    """Groups of near-duplicate documents: doc_id, n_shingles, component_id, kept.

    Documents are linked if the sets of their 5-word shingles (words separated by ASCII
    white space, A-Z lower-cased; a shorter text is one shingle) have a Jaccard similarity
    of at least 0.75. component_id is the smallest doc_id reachable by links, kept whether
    it is the document's own. Null, empty and blank texts have no shingle, are linked with
    nothing and kept. Rows that repeat have a row each. A row without doc_id takes part in
    links but names no group: where a group has no doc_id at all, component_id is null and
    all its rows are kept. Other columns of the input are not read.
    """
    kept = Kept(documents.sparkSession)
    rows = kept.write(sketches(documents), "sketches")
    # One item per distinct set: copies end here, aggregated before the shuffle.
    items = rows.where("n > 0").groupBy("digest").agg(
        F.min("doc_id").alias("first_id"),
        F.first("n").alias("n"),
        F.first("sketch").alias("sketch"),
        F.min("text_hash").alias("text_hash"),
        *[F.first(s).alias(s) for s in _SIGNATURE],
    )
    items = kept.write(items.withColumn("item", F.monotonically_increasing_id()), "items")
    listed = kept.write(lists(items), "lists")

    def texts_of(some: DataFrame) -> DataFrame:
        return kept.write(_texts(documents, some.join(items.select("item", "text_hash"), "item")), "texts")

    def check(pairs: DataFrame) -> DataFrame:
        passed = kept.write(_estimated(pairs, items), "passed")
        ends = passed.select("a").unionByName(passed.select(F.col("b").alias("a"))).distinct()
        return _verified(passed, texts_of(ends.withColumnRenamed("a", "item")))

    def narrow(undecided: DataFrame) -> tuple[DataFrame, str]:
        return full_lists(texts_of(undecided)), FITS_FULLY

    found = linked(listed, check, kept, FITS, PAIRS_PER_ENTRY, narrow)
    kept.drop_others("sketches", "items", "components")
    grouped = items.join(found, items["item"] == found["node"], "left").select(
        "digest", "first_id", F.coalesce("component", "item").alias("component")
    )
    firsts = grouped.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = grouped.join(firsts, "component").select("digest", "component_id", F.lit(True).alias("named"))
    joined = rows.select("doc_id", "n", "digest").join(named, "digest", "left")
    component = F.when(F.col("named"), F.col("component_id")).otherwise(F.col("doc_id"))
    return joined.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )
