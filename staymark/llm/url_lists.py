"""URL filtering by dated lists: each capture against the entries active when fetched.

Lists change over time: an entry is added, removed and perhaps added again. Its events
become intervals of validity, and a capture meets an entry if it was valid at the time of
the capture. Entries are hosts (which cover their subdomains) or host and path prefixes
(whole path segments); of the entries met, the longest decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
_PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)"


def host(url: Column) -> Column:
    """Host of a URL in lower case, null if there is none."""
    return F.lower(F.nullif(F.regexp_extract(url, _HOST, 1), F.lit("")))


def keys(url: Column) -> Column:
    """Every entry that would cover a URL: its host and parent domains, and its host with
    each leading part of its path."""
    labels = F.split(host(url), r"\.")
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    parts = F.filter(F.split(F.regexp_extract(url, _PATH, 1), "/"), lambda x: x != "")
    prefixes = F.when(
        F.size(parts) > 0,
        F.transform(
            F.sequence(F.lit(1), F.size(parts)),
            lambda i: F.concat_ws("/", host(url), F.array_join(F.slice(parts, F.lit(1), i), "/")),
        ),
    ).otherwise(F.expr("CAST(array() AS ARRAY<STRING>)"))
    return F.when(host(url).isNotNull(), F.array_distinct(F.concat(domains, prefixes)))


def intervals(events: DataFrame) -> DataFrame:
    """entry, verdict, valid_from, valid_to (exclusive, null: still valid).

    ``events`` has entry, day, verdict ('block' or 'allow', null where the entry is taken
    off the list). Of several events of an entry on a day the strictest counts: block, then
    allow, then removal. Events without entry or day are left out.
    """
    strict = F.when(F.col("verdict") == "block", 2).when(F.col("verdict") == "allow", 1).otherwise(0)
    # At most one row for an entry and day, however often an event repeats.
    daily = (
        events.where("entry IS NOT NULL AND day IS NOT NULL")
        .groupBy("entry", "day")
        .agg(F.max(strict).alias("rank"))
    )
    following = F.lead("day").over(Window.partitionBy("entry").orderBy("day"))
    return daily.withColumn("valid_to", following).where("rank > 0").select(
        "entry",
        F.when(F.col("rank") == 2, "block").otherwise("allow").alias("verdict"),
        F.col("day").alias("valid_from"),
        "valid_to",
    )


def judge(captures: DataFrame, events: DataFrame) -> DataFrame:
    """``captures`` (url, fetched, and any other columns) with entry, verdict, valid_from
    and kept.

    The first three tell the deciding entry, null if no entry covers the URL at that time;
    kept is false where it says block. Captures without URL, host or fetch time meet no
    entry. Repeated rows have a row each. Columns of these names in the input are replaced.
    """
    captures = captures.drop("entry", "verdict", "valid_from", "kept")
    # Each URL and time once: copies end before entries are looked up.
    asked = captures.select("url", "fetched").where("url IS NOT NULL AND fetched IS NOT NULL").distinct()
    looked = asked.select("url", "fetched", F.explode(keys(F.col("url"))).alias("entry"))
    valid = intervals(events)
    met = looked.join(valid, "entry").where(
        "valid_from <= fetched AND (valid_to IS NULL OR fetched < valid_to)"
    )
    # No two covering entries are of equal length but a domain and a path prefix; then the
    # text decides.
    choice = F.max(F.struct(F.char_length("entry").alias("size"), "entry", "verdict", "valid_from"))
    found = met.groupBy("url", "fetched").agg(choice.alias("chosen"))
    found = found.select("url", "fetched", "chosen.entry", "chosen.verdict", "chosen.valid_from")
    joined = captures.join(found, ["url", "fetched"], "left")
    kept = F.coalesce(F.col("verdict") != "block", F.lit(True)).alias("kept")
    return joined.select(*captures.columns, "entry", "verdict", "valid_from", kept)
