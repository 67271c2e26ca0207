"""Secrets in texts, by a trigram index and regular expressions, in DataFrame functions.

An inverted index holds, for each trigram that some rule asks for, the texts that contain
it. A rule's pattern yields a Boolean query over trigrams; intersecting the postings gives
the texts that can match, and only these are searched with the pattern. A pattern that
asks for no trigram is searched for in all texts.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staymark.llm.common import Kept, carried, uncarried
from staymark.llm.trigrams import required, trigrams
from staymark.operators.sizing import broadcast_if_fits

MASK = "[secret]"


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose ``group`` has at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The three base kinds, in their order.
BASE = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        12,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}"),  # runs of 16 or more are the same as long enough runs
)
MORE = (
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("code_host_long", r"github_pat_[A-Za-z0-9_]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("cloud", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("login_url", r"://[^\s/:@]+:[^\s/:@]{3,}@"),
)
RULES = (*BASE, *MORE)
# Matches of a text that are put in place at once.
BLOCK = 256


def _hashed(documents: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return documents.withColumn("text", text).withColumn("text_hash", F.xxhash64("text"))


def postings(documents: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """trigram, text_hash: for the trigrams that the rules ask for, the texts with them."""
    wanted = sorted({t for r in rules for c in required(r.pattern) for s in c for t in trigrams(s)})
    low = F.lower("text")
    found = F.array_compact(F.array(*[F.when(F.contains(low, F.lit(t)), F.lit(t)) for t in wanted]))
    return _hashed(documents.select("text")).select("text_hash", F.explode(found).alias("trigram"))


def candidates(index: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """text_hash and, as bits, the clauses whose trigrams its postings have.

    Equal hashes of different texts only make more candidates, which the patterns sort out.
    """
    terms, bit = [], 0
    for rule in rules:
        for clause in required(rule.pattern):
            for string in clause:
                grams = trigrams(string)
                terms += [(1 << bit, string, t, 1 << i, (1 << len(grams)) - 1) for i, t in enumerate(grams)]
            bit += 1
    spark = index.sparkSession
    asked = spark.createDataFrame(terms, "clause long, string string, trigram string, part long, all long")
    # The terms of the rules: as many rows as the patterns have trigrams.
    met = index.join(F.broadcast(asked), "trigram")
    strings = met.groupBy("text_hash", "clause", "string", "all").agg(F.bit_or("part").alias("parts"))
    whole = strings.where(F.col("parts") == F.col("all"))
    return whole.groupBy("text_hash").agg(F.bit_or("clause").alias("clauses"))


def _matches(rule: Rule, number: int) -> Column:
    """Sorted array of (start, number, end) of a rule's matches in ``text``.

    What lies between the matches and the matches themselves, in turn, tell their places.
    """
    length = F.char_length
    between = F.split("text", rule.pattern, -1)
    hits = F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(0))
    columns = [between.alias("between"), hits.alias("hit")]
    if rule.group:
        judged = F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(rule.group))
        columns.append(judged.alias("judged"))

    def step(made: Column, part: Column) -> Column:
        start = made["at"] + length(part["between"]).cast("long")
        end = start + length(part["hit"]).cast("long")
        span = F.struct(start.alias("start"), F.lit(number).alias("number"), end.alias("end"))
        good = length(part["judged" if rule.group else "hit"]) >= rule.least
        spans = F.when(good, F.concat(made["spans"], F.array(span))).otherwise(made["spans"])
        # What follows the last match has no match beside it.
        done = part["hit"].isNull()
        return F.struct(
            F.when(done, made["at"]).otherwise(end).alias("at"),
            F.when(done, made["spans"]).otherwise(spans).alias("spans"),
        )

    # Appending copies an array, so it is done in blocks, which are then moved to their place.
    first = F.struct(F.lit(0).cast("long").alias("at"), _no_spans().alias("spans"))

    def in_blocks(parts: Column) -> Column:
        firsts = F.sequence(F.lit(1), F.size(parts), F.lit(BLOCK))
        return F.transform(firsts, lambda at: F.aggregate(F.slice(parts, at, F.lit(BLOCK)), first, step))

    def moved(block: Column, at: Column) -> Column:
        return F.transform(
            block["spans"],
            lambda s: F.struct((s["start"] + at).alias("start"), s["number"].alias("number"), (s["end"] + at).alias("end")),
        )

    def in_place(blocks: Column) -> Column:
        nowhere = F.array(F.lit(0).cast("long"))
        places = F.aggregate(
            blocks, nowhere, lambda made, block: F.concat(made, F.array(F.element_at(made, -1) + block["at"]))
        )
        return F.flatten(F.zip_with(blocks, F.slice(places, F.lit(1), F.size(blocks)), moved))

    return _once(_once(F.arrays_zip(*columns), in_blocks), in_place)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of ``value``, which is computed once however often it is named there."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _no_spans() -> Column:
    return F.expr("CAST(array() AS ARRAY<STRUCT<start: BIGINT, number: INT, end: BIGINT>>)")


def scan(documents: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``documents`` with ``spans``: (start, number of the rule, end) of every secret.

    Places are in characters, the end exclusive; spans are sorted by start, then rule. A
    rule's matches are leftmost and do not overlap; those of different rules may. Null and
    empty texts have none, repeated rows have theirs each. text_hash, clauses and spans of
    the input are replaced; a null text reads as empty in the result.
    """
    kept = Kept(documents.sparkSession)
    documents = documents.drop("text_hash", "clauses", "spans")
    index = kept.write(postings(documents, rules), "postings")
    found = kept.write(candidates(index, rules), "candidates")
    kept.drop("postings")
    joined = _hashed(documents).join(broadcast_if_fits(found), "text_hash", "left")
    spans, bit = [], 0
    for number, rule in enumerate(rules):
        mask = 0
        for _ in required(rule.pattern):
            mask, bit = mask | 1 << bit, bit + 1
        may = F.rlike("text", F.lit(rule.pattern))
        if mask:
            may = (F.coalesce("clauses", F.lit(0)).bitwiseAND(F.lit(mask)) == mask) & may
        spans.append(F.when(may, _matches(rule, number)).otherwise(_no_spans()))
    return joined.withColumn("spans", F.array_sort(F.concat(*spans))).drop("text_hash", "clauses")


def _listed(spans: Column, rules: tuple[Rule, ...]) -> Column:
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    text = F.transform(
        spans, lambda s: F.concat_ws(":", F.get(kinds, s["number"]), s["start"].cast("string"), s["end"].cast("string"))
    )
    return F.array_join(text, ",")


def report(documents: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, counts of the base kinds, digest of their spans, and all spans as text."""
    scanned = scan(documents.select("doc_id", "text"), rules)

    def count(number: int) -> Column:
        found = F.size(F.filter("spans", lambda s: s["number"] == number))
        return found.cast("long").alias(f"n_{rules[number].kind}")

    base = F.filter("spans", lambda s: s["number"] < len(BASE))
    return scanned.select(
        "doc_id",
        *[count(i) for i in range(len(BASE))],
        F.sha2(_listed(base, rules), 256).alias("base_sha256"),
        _listed(F.col("spans"), rules).alias("spans"),
    )


def redact(documents: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``documents`` with every secret in ``text`` replaced by a mark.

    Overlapping spans have one mark. A null text stays null. Other columns stay as they
    are, whatever their names; repeated rows have a row each.
    """
    scanned = scan(carried(documents).withColumn("was_null", F.col("text").isNull()), rules)

    def step(made: Column, span: Column) -> Column:
        before = F.substring("text", (made["at"] + 1).cast("int"), (span["start"] - made["at"]).cast("int"))
        added = F.when(span["start"] >= made["at"], F.concat(made["out"], F.array(before, F.lit(MASK))))
        at = F.greatest(made["at"], span["end"])
        return F.struct(at.alias("at"), added.otherwise(made["out"]).alias("out"))

    first = F.struct(F.lit(0).cast("long").alias("at"), F.expr("CAST(array() AS ARRAY<STRING>)").alias("out"))
    rest = F.aggregate(
        "spans",
        first,
        step,
        lambda made: F.concat(
            F.array_join(made["out"], ""), F.substring(F.col("text"), (made["at"] + 1).cast("int"), F.char_length("text"))
        ),
    )
    text = F.when(~F.col("was_null"), F.when(F.size("spans") > 0, rest).otherwise(F.col("text")))
    columns = uncarried(documents.columns)
    return scanned.withColumn("text", text).select(*[c.alias(name) for name, c in columns.items()])
