"""Near-duplicate vectors by a forest of random-projection trees.

Every tree splits the vectors again and again by a random direction, at the median of a
sample; vectors near the border go to both sides, so near pairs are seldom torn apart.
Vectors of equal label that share a leaf of any tree are compared. A pair is counted in
the first leaf that both have and nowhere else, so counts need no list of pairs; and of
the links in a leaf only a spanning forest goes on, at most one row per vector.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staymark.llm.common import Kept
from staymark.llm.components import components

COSINE = 0.98
TREES = 8
# Vectors that a leaf holds on average, while the sample allows trees so deep.
LEAF = 512
# The trees are fitted on a sample of at most this many vectors and bytes.
SAMPLE = 1 << 16
SAMPLE_BYTES = 16 << 20
LEAST_IN_NODE = 16
# Distance from the border within which a vector goes to both sides, times the root of
# the dimension (a projection of a unit vector varies by one over that root).
SPILL = 0.08
# Vectors put into leaves at once: each comes out a dozen times.
PLACED_ROWS = 512
# Leaves are compared in blocks of about this many vectors.
BLOCK = 512
SEED = 20_240_601


@dataclass
class Forest:
    """Directions by tree and level, and borders by tree and node (NaN: a leaf).

    The children of node i are 2i + 1 and 2i + 2.
    """

    directions: np.ndarray
    borders: np.ndarray
    spill: float

    def leaves(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, code of a leaf) of all leaves each row of ``unit`` falls into."""
        rows, codes = [], []
        trees, nodes = self.borders.shape
        for tree in range(trees):
            row, node, level = np.arange(len(unit)), np.zeros(len(unit), np.int64), 0
            while len(row):
                border = self.borders[tree, node]
                done = np.isnan(border)
                rows.append(row[done])
                codes.append(tree * nodes + node[done])
                row, node, border = row[~done], node[~done], border[~done]
                if len(row):
                    at = (unit @ self.directions[tree, level])[row] - border
                    left, right = at <= self.spill, at > -self.spill
                    row = np.concatenate([row[left], row[right]])
                    node = np.concatenate([2 * node[left] + 1, 2 * node[right] + 2])
                level += 1
        return np.concatenate(rows), np.concatenate(codes)


def fit(sample: np.ndarray, total: int) -> Forest:
    """Trees over unit vectors of one dimension, for ``total`` vectors to be put in."""
    depth = int(np.ceil(np.log2(max(1, total / LEAF))))
    depth = min(depth, int(np.log2(max(1, len(sample) / LEAST_IN_NODE))))
    rng = np.random.default_rng(SEED)
    directions = rng.normal(size=(TREES, max(depth, 1), sample.shape[1]))
    directions /= np.linalg.norm(directions, axis=2, keepdims=True)
    borders = np.full((TREES, 2 ** (depth + 1) - 1), np.nan)
    for tree in range(TREES):
        node = np.zeros(len(sample), np.int64)
        for level in range(depth):
            at = sample @ directions[tree, level]
            frame = pd.Series(at).groupby(node)
            medians, sizes = frame.median(), frame.size()
            medians = medians[sizes >= LEAST_IN_NODE]
            borders[tree, medians.index] = medians
            border = borders[tree, node]
            inner = ~np.isnan(border)
            side = np.where(at <= border, 1, 2)
            node = np.where(inner, 2 * node + side, node)
            if not inner.any():
                break
    return Forest(directions, borders, SPILL / np.sqrt(sample.shape[1]))


def _scaled(vectors: pd.Series) -> np.ndarray:
    """Vectors times powers of two, which change no cosine, such that the largest component of
    each is near one and no square of it leaves the range of doubles."""
    stacked = np.stack(vectors.to_numpy()).astype(np.float64)
    exponents = np.frexp(np.abs(stacked).max(axis=1, keepdims=True))[1]
    return np.ldexp(stacked, -exponents)


def _unit(vectors: pd.Series) -> np.ndarray:
    scaled = _scaled(vectors)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _in_leaves(frame: pd.DataFrame, forests: dict[int, Forest]) -> Iterator[pd.DataFrame]:
    """The rows of ``frame`` once for each leaf, PLACED_ROWS of them at a time."""
    for size, of_size in frame.groupby(frame["embedding"].map(len)):
        for first in range(0, len(of_size), PLACED_ROWS):
            part = of_size.iloc[first : first + PLACED_ROWS]
            row, code = forests[size].leaves(_unit(part["embedding"]))
            order = np.lexsort([code, row])
            row, code = row[order], code[order]
            bounds = np.searchsorted(row, np.arange(len(part) + 1))
            every = [code[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            out = part.iloc[row].copy()
            out["label"] = out["label"].to_numpy(object)
            out["leaf"], out["size"] = code, size
            out["leaves"] = [every[r] for r in row]
            yield out


def _placed(items: DataFrame, forests: dict[int, Forest]) -> DataFrame:
    """A row for each item and leaf: leaf, item, and what a comparison needs."""
    shared = items.sparkSession.sparkContext.broadcast(forests)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield from _in_leaves(frame, shared.value)

    return items.select("item", "label", "copies", "embedding").mapInPandas(
        run,
        "item long, label string, copies long, embedding array<double>, leaf long, size int, "
        "leaves array<long>",
    )


def _compared(placed: DataFrame, cosine: float) -> DataFrame:
    """item, links found first in this leaf, and another item of its component there."""
    place = ["label", "size", "leaf"]
    counts = placed.groupBy(*place).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    blocked = placed.join(counts.where("blocks > 1"), place, "left").withColumn(
        "blocks", F.coalesce("blocks", F.lit(1))
    )
    blocked = blocked.withColumn("own", F.pmod(F.xxhash64("item"), F.col("blocks")).cast("int"))
    # Every two blocks of a leaf meet in one group, so no group is larger than two blocks.
    blocked = blocked.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    blocked = blocked.withColumn("one", F.least("own", "other")).withColumn(
        "two", F.greatest("own", "other")
    )

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("item", ignore_index=True)
        vectors = _scaled(frame["embedding"])
        norms = np.linalg.norm(vectors, axis=1)
        near = (vectors @ vectors.T) / np.outer(norms, norms) >= cosine
        own = frame["own"].to_numpy()
        if frame["one"].iloc[0] != frame["two"].iloc[0]:
            near &= own[:, None] != own[None, :]
        np.fill_diagonal(near, False)
        out = {"item": [], "links": [], "other_item": []}
        if near.any():
            here = frame["leaf"].iloc[0]
            lengths = frame["leaves"].map(len).to_numpy()
            codes = np.concatenate(frame["leaves"].to_numpy())
            rows = np.repeat(np.arange(len(frame)), lengths)
            earlier = codes < here
            _, column = np.unique(codes[earlier], return_inverse=True)
            held = np.zeros((len(frame), column.max(initial=-1) + 1), np.float32)
            held[rows[earlier], column] = 1
            near &= (held @ held.T) == 0
            links = near @ frame["copies"].to_numpy()
            label = np.arange(len(frame))
            while True:
                least = np.minimum(label, np.where(near, label[None, :], len(frame)).min(axis=1))
                least = least[least]
                if (least == label).all():
                    break
                label = least
            some = links > 0
            items = frame["item"].to_numpy()
            out = {"item": items[some], "links": links[some], "other_item": items[label[some]]}
        return pd.DataFrame(out)

    return blocked.groupBy(*place, "one", "two").applyInPandas(
        compare, "item long, links long, other_item long"
    )


def near_vectors(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of ``vectors``.

    Vectors of equal, non-null label and equal dimension are linked if the search finds
    them and their cosine is at least ``cosine``. n_links counts the other rows linked,
    component_id is the smallest vec_id reachable, kept whether it is the row's own. Rows
    whose label or vector is null, or whose vector is empty, zero or holds null or
    non-finite components, have no links and are kept. Equal vectors are one item that
    counts as often as it occurs. Rows without vec_id take part in links but name no
    component. Other columns of the input are not read.
    """
    spark = vectors.sparkSession
    kept = Kept(spark)
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("string").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    largest = F.lit(1.7976931348623157e308)
    sound = F.coalesce(
        F.col("label").isNotNull()
        & (F.size("embedding") > 0)
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= largest))
        & F.exists("embedding", lambda x: x != 0),
        F.lit(False),
    )
    items = rows.where(sound).groupBy("label", "embedding").agg(
        F.min("vec_id").alias("first_id"), F.count("*").alias("copies")
    )
    items = kept.write(items.withColumn("item", F.monotonically_increasing_id()), "items")
    hashed = items.select("embedding", F.size("embedding").alias("size"), F.xxhash64("embedding").alias("h"))
    forests = {}
    # One row per dimension that occurs.
    for row in items.groupBy(F.size("embedding").alias("size")).agg(F.count("*").alias("n")).collect():
        size, total = row["size"], row["n"]
        share = min(1.0, min(SAMPLE, SAMPLE_BYTES // (8 * size)) / total)
        drawn = hashed.where((F.col("size") == size) & (F.pmod("h", F.lit(1 << 30)) < int(share * (1 << 30))))
        sample = drawn.orderBy("h").select("embedding").toPandas()["embedding"]
        unit = _unit(sample) if len(sample) else np.zeros((0, size))
        forests[size] = fit(unit, total)
    placed = kept.write(_placed(items, forests), "placed")
    found = kept.write(_compared(placed, cosine), "found")
    kept.drop("placed")
    edges = found.select(F.col("item").alias("a"), F.col("other_item").alias("b"))
    joined = components(edges, kept)
    links = found.groupBy("item").agg(F.sum("links").alias("links"))
    grouped = (
        items.join(links, "item", "left")
        .join(joined, F.col("item") == F.col("node"), "left")
        .select(
            "label",
            "embedding",
            "first_id",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "item").alias("component"),
        )
    )
    firsts = grouped.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = grouped.join(firsts, "component").select("label", "embedding", "n_links", "component_id")
    linked = rows.where(sound).join(named, ["label", "embedding"])
    alone = rows.where(~sound).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    both = linked.select("vec_id", "n_links", "component_id").unionByName(alone)
    return both.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
