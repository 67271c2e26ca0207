"""Components of items that share a list, without all pairs of every list.

Inverted lists name, for each key, the items that hold it; items of one list may be
linked, and only a costly check can tell. What is wanted are the connected components
that all links of all lists make. So each list first has one item, its hub, checked
against the others, which settles most lists of copies: items that are then in one
component need no further check. What is left is settled by more such rounds or, where
few pairs are left, pair by pair. Before that, the items left may be listed anew, under keys
that bring fewer pairs together but would be too costly for all items. In the end every pair
that shares a list and fits has been checked or is known to lie in one component, so no
component is missed.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staymark.llm.common import Kept
from staymark.llm.components import components

# Rounds with one hub for each list, before all remaining pairs are taken.
ROUNDS = 3
# Below this many remaining pairs per remaining list entry, all pairs are taken at once.
PAIRS_PER_ENTRY = 32


Check = Callable[[DataFrame], DataFrame]


def linked(
    lists: DataFrame,
    check: Check,
    kept: Kept,
    fits: str = "true",
    pairs_per_entry: int = PAIRS_PER_ENTRY,
    narrow: Callable[[DataFrame], tuple[DataFrame, str]] | None = None,
    lead: str | None = None,
) -> DataFrame:
    """Components of the items of ``lists``: node, component (items without links lack).

    ``lists`` has the columns key, item (long), first (the least is the hub of the first
    round) and about, which ``fits`` may compare between the two sides of a pair as ``x``
    and ``y`` (a cheap necessary condition that saves checks). ``check`` gets pairs (a < b,
    long, distinct) and returns those that are linked. It must tell the same of a pair
    each time. Up to ``pairs_per_entry`` pairs that remain for each list entry, all are
    taken at once instead of another hub round: the more, the more of them ``fits`` drops.
    So they are, too, when a hub round did not settle half of what was left.

    Before that, ``narrow``, if given, gets the items (column item) that still fit one of
    another component, and returns lists and ``fits`` for them, in the same form; each linked
    pair of those items must share one of these lists and fit there. They have hub rounds of
    their own, and the pairs taken at once are theirs.

    ``lead``, if given, is a boolean column of ``lists``: each linked pair must share a list where
    it is true of one of the two. Pairs taken at once are then of such entries with any others.
    """
    found, open_ = _hub_rounds(lists, check, kept, fits, pairs_per_entry, None)
    if open_ is not None and narrow is not None:
        x, y = open_.alias("x"), open_.alias("y")
        met = F.expr(f"x.key = y.key AND x.item <> y.item AND x.label <> y.label AND ({fits})")
        lists, fits = narrow(kept.write(x.join(y, met, "left_semi").select("item").distinct(), "undecided"))
        found, open_ = _hub_rounds(kept.write(lists, "narrowed"), check, kept, fits, PAIRS_PER_ENTRY, found)
    if open_ is None:
        return found
    x, y = open_.alias("x"), open_.alias("y")
    once = "x.item < y.item"
    if lead is not None and narrow is None:
        x, once = open_.where(lead).alias("x"), f"(x.item < y.item OR NOT y.{lead})"
    met = x.join(y, "key").where(f"{once} AND x.label <> y.label AND ({fits})")
    fresh = kept.write(check(_pairs(met)).select("a", "b"), "links")
    return found if fresh.isEmpty() else _joined(found, fresh, kept)


def _hub_rounds(
    lists: DataFrame, check: Check, kept: Kept, fits: str, pairs_per_entry: int, found: DataFrame | None
) -> tuple[DataFrame, DataFrame | None]:
    """Components after the hub rounds, and the lists (with label) whose pairs are to be taken."""
    open_ = lists.withColumn("label", F.col("item")) if found is None else _open(lists, found, kept)
    left = None
    for turn in range(ROUNDS + 1):
        order = F.xxhash64("item", F.lit(turn)) if turn else F.col("first").cast("long")
        if turn or found is not None:
            # Pairs of different components in lists that have several.
            counts = open_.groupBy("key", "label").agg(F.count("*").alias("n")).groupBy("key")
            counts = counts.agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("same"))
            volume = counts.agg(
                F.sum((F.col("n") * F.col("n") - F.col("same")) / 2).alias("pairs"), F.sum("n").alias("entries")
            ).first()
            if not volume["entries"]:
                return found, None
            pairs, before = volume["pairs"], left
            if turn == ROUNDS or (turn and pairs <= pairs_per_entry * volume["entries"]):
                return found, open_
            if before is not None and 2 * pairs > before:
                return found, open_
            left = pairs
        best = F.min(F.struct(order.alias("order"), "item", "label", "about")).alias("hub")
        hubs = open_.groupBy("key").agg(best, F.count("*").alias("n"))
        x = hubs.where("n > 1").select("key", "hub.item", "hub.label", "hub.about").alias("x")
        met = x.join(open_.alias("y"), "key").where(f"x.item <> y.item AND x.label <> y.label AND ({fits})")
        fresh = kept.write(check(_pairs(met)).select("a", "b"), "links")
        if found is None or not fresh.isEmpty():
            found = _joined(found, fresh, kept)
            open_ = _open(open_.drop("label"), found, kept)
    return found, open_


def _pairs(met: DataFrame) -> DataFrame:
    return met.select(
        F.least("x.item", "y.item").alias("a"), F.greatest("x.item", "y.item").alias("b")
    ).distinct()


def _joined(found: DataFrame | None, fresh: DataFrame, kept: Kept) -> DataFrame:
    """Components with fresh links. What was found before takes part as stars."""
    known = [found.select(F.col("node").alias("a"), F.col("component").alias("b"))] if found is not None else []
    return components(reduce(DataFrame.unionByName, known, fresh), kept)


def _open(lists: DataFrame, found: DataFrame, kept: Kept) -> DataFrame:
    """Lists whose items are not all in one component, with the component as label."""
    known = lists.join(found, F.col("item") == F.col("node"), "left")
    known = known.withColumn("label", F.coalesce("component", "item")).drop("node", "component")
    mixed = known.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
    return kept.write(known.join(mixed.where("lo <> hi").select("key"), "key"), "open")
