r"""Conversations whose rows are missing, empty, repeated or misattributed, made whole again.

A conversation is its rows in order of turn, NULL first, then role, then the SHA-256 of the
text; NULL role and text read as one space. A row's first fault counts: ``blank`` (no
character but space and \x09-\x0D), ``duplicate`` (role and text of an earlier row),
``truncated`` (last other character not ``.``, ``!`` or ``?``). The repair is the cheapest list
of edits that gives legal roles (see ``edit_search``).

Rows are cut to a symbol each before they are gathered: copies are counted before the first
shuffle, ranges of (conversation, turn) spread a conversation of any length over tasks, and a
long one is searched in parts, by all states a part can begin and end in. Texts and edits then meet by
conversation and are worked off as a stream: its digest is sequential by its nature, so a
conversation's texts pass one task, which holds one batch of them and the edits.

Awkward input: rows with NULL conv_id are one conversation; NULL turns sort first and count in
no gap; equal rows are duplicates; a role's initial is its first character, and one that is
not s, u or a (an empty role has none) is never legal; a conversation without rows has
zeros and empty strings; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import os.path
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staymark.llm.common import Kept
from staymark.llm.edit_search import AFTER_KEEP, AFTER_NEXT, CLOSING, INSERT, NEXT_ROLE, START, cheapest, crossings

# Rows of a part, and of the longest conversation that is searched whole.
PART = 64
WHOLE = 512
# Result rows sent back at once.
_ROWS = 4096
_BLANKS = " \t\n\x0b\x0c\r"
_LEGAL_PAIRS = ("su", "ua", "au")
_ROLES = {"u": "user", "a": "assistant"}
_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def typed(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and copies (1), whatever else the table holds."""
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
        F.lit(1).alias("copies"),
    )


def damage(conversations: DataFrame) -> DataFrame:
    """Rows damaged by the checksum of ``conv_id:turn``: dropped, emptied, without sentence
    ends, doubled, or given to the user. NULL reads as one space in the checksum as well."""
    rows = typed(conversations)

    def shown(column: str):
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    text = (
        F.when(F.col("kind") == 1, "")
        .when(F.col("kind") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text"))
    )
    return (
        rows.withColumn("kind", kind)
        .where("kind <> 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
            text.alias("text"),
            F.when(F.col("kind") == 3, 2).otherwise(1).alias("copies"),
        )
    )


_ORDER = ("conv_id", "turn", "role", "digest")


def _digested(rows: DataFrame) -> DataFrame:
    return rows.withColumn("digest", F.unhex(F.sha2("text", 256)))


def _symbols(rows: DataFrame) -> DataFrame:
    """One row for equal rows: place in the order, fault, copies, whether it is the first."""
    told = F.rtrim("text", F.lit(_BLANKS))
    fault = F.when(F.length(told) == 0, "blank").when(~F.right(told, F.lit(1)).isin(".", "!", "?"), "cut")
    counted = (
        _digested(rows)
        .groupBy(*_ORDER, F.coalesce(fault, F.lit("")).alias("fault"))
        .agg(F.sum("copies").alias("copies"))
    )
    dated = F.col("turn").isNotNull()
    earliest = counted.groupBy("conv_id", "role", "digest").agg(
        F.min(F.struct(dated.alias("dated"), "turn")).alias("first")
    )
    # The turn is part of the key, so that a text said in many turns is not one join key.
    firsts = earliest.select(
        F.col("conv_id").alias("c"), F.col("first.turn").alias("t"), F.col("role").alias("r"), F.col("digest").alias("d")
    )
    same = [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(_ORDER, "ctrd", strict=True)]
    return counted.join(firsts, same, "left").select(*_ORDER, "fault", "copies", F.col("d").isNotNull().alias("first"))


class _Part:
    """Successive rows of one conversation, as symbols and counts."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.symbols, self.turns = conv_id, [], 0
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.first_initial = self.last_initial = self.first_turn = self.last_turn = None

    def add(self, turn: int | None, initial: str, fault: str, first: bool) -> None:
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        if self.symbols:
            self.illegal += (self.last_initial + initial) not in _LEGAL_PAIRS
        else:
            self.first_initial = initial
        self.last_initial = initial
        symbol = initial if initial in ("s", "u", "a") else "o"
        if fault == "blank":
            self.blank, symbol = self.blank + 1, "x"
        elif not first:
            self.duplicate, symbol = self.duplicate + 1, "x"
        elif fault == "cut":
            self.truncated, symbol = self.truncated + 1, symbol.upper()
        self.symbols.append(symbol)


_PART_FIELDS = (
    "symbols string, turns long, blank long, duplicate long, truncated long, illegal long, "
    "first_initial string, last_initial string, first_turn long, last_turn long"
)
_PART_NAMES = [f.split()[0] for f in _PART_FIELDS.split(", ")]


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == _ROWS:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


_TYPES = {"long": pa.int64(), "string": pa.string(), "int": pa.int32(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}


def _schema(fields: str) -> pa.Schema:
    return pa.schema([(name, _TYPES[kind]) for name, kind in (f.split() for f in fields.split(", "))])


def _parts(symbols: DataFrame) -> DataFrame:
    """Conversations in parts of at most ``PART`` rows, numbered by place in the order."""
    fields = f"conv_id long, place long, {_PART_FIELDS}"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        part, place = None, TaskContext.get().partitionId() << 33
        for batch in batches:
            for row in batch.to_pylist():
                for copy in range(row["copies"]):
                    if part and (part.conv_id != row["conv_id"] or len(part.symbols) == PART):
                        yield _told(part, place)
                        part, place = None, place + 1
                    part = part or _Part(row["conv_id"])
                    part.add(row["turn"], row["role"][:1], row["fault"], row["first"] and copy == 0)
        if part:
            yield _told(part, place)

    def _told(part: _Part, place: int) -> tuple:
        part.symbols = "".join(part.symbols)
        return (part.conv_id, place, *[getattr(part, name) for name in _PART_NAMES])

    ordered = symbols.repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER)
    return ordered.mapInArrow(lambda batches: _batches(cut(batches), _schema(fields)), fields)


_WAYS = "entries array<long>, targets array<long>, costs array<long>, edits array<string>"


def _searched(parts: DataFrame) -> DataFrame:
    """Parts of long conversations with all ways through them."""
    names = ["conv_id", "place", *_PART_NAMES]
    fields = f"conv_id long, place long, {_PART_FIELDS}, {_WAYS}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for row in batch.to_pylist():
                ways = [list(column) for column in zip(*crossings(row["symbols"]), strict=True)]
                yield (*[row[n] for n in names], *ways)

    return parts.mapInArrow(lambda batches: _batches(run(batches), _schema(fields)), fields)


class _Whole:
    """A conversation put together from its parts, in order."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.last, self.symbols = conv_id, None, []
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.first_turn = self.last_turn = None
        # Cheapest edits to each state, without what all of them begin with.
        self.ways: dict[int, tuple[int, str]] = {START: (0, "")}
        self.settled: list[str] = []

    def add(self, part: dict) -> None:
        for name in ("turns", "blank", "duplicate", "truncated", "illegal"):
            setattr(self, name, getattr(self, name) + part[name])
        if self.last is not None:
            self.illegal += (self.last + part["first_initial"]) not in _LEGAL_PAIRS
        self.last = part["last_initial"]
        if part["first_turn"] is not None:
            self.turns -= self.last_turn == part["first_turn"]
            self.first_turn = part["first_turn"] if self.first_turn is None else self.first_turn
            self.last_turn = part["last_turn"]
        if part["entries"] is None:
            self.symbols.append(part["symbols"])
        else:
            self._lead_on(zip(*[part[c] for c in ("entries", "targets", "costs", "edits")], strict=True))

    def _lead_on(self, ways: Iterator[tuple[int, int, int, str]]) -> None:
        reached: dict[int, tuple[int, str]] = {}
        for entry, target, cost, edits in ways:
            if entry in self.ways:
                before, path = self.ways[entry]
                way = (before + cost, path + edits)
                reached[target] = min(reached.get(target, way), way)
        shared = os.path.commonprefix([path for _, path in reached.values()])
        self.settled.append(shared)
        self.ways = {s: (cost, path[len(shared) :]) for s, (cost, path) in reached.items()}

    def told(self) -> tuple:
        if self.symbols:
            cost, audit = cheapest("".join(self.symbols))
        else:
            cost, rest = min((c + INSERT * len(CLOSING[s]), p + CLOSING[s]) for s, (c, p) in self.ways.items())
            audit = "".join(self.settled) + rest
        gaps = 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns
        return (self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit)


_AUDIT_FIELDS = "conv_id long, " + ", ".join(f"{c} long" for c in _COUNTS) + ", audit string"


def _put_together(parts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        whole = None
        for batch in batches:
            for part in batch.to_pylist():
                if whole is None or whole.conv_id != part["conv_id"]:
                    if whole:
                        yield whole.told()
                    whole = _Whole(part["conv_id"])
                whole.add(part)
        if whole:
            yield whole.told()

    ordered = parts.repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return ordered.mapInArrow(lambda batches: _batches(run(batches), _schema(_AUDIT_FIELDS)), _AUDIT_FIELDS)


def audits(rows: DataFrame, kept: Kept) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost and audit of each
    conversation in ``rows`` (conv_id, turn, role, text, copies). ``kept`` holds the tables
    written on the way, which the result reads."""
    symbols = kept.write(_symbols(rows), "symbols")
    parts = kept.write(_parts(symbols), "parts")
    kept.drop("symbols")
    sizes = parts.groupBy("conv_id").agg(F.sum(F.length("symbols")).alias("rows"))
    long = sizes.where(F.col("rows") > WHOLE).select(F.col("conv_id").alias("long_one"))
    same = F.col("conv_id").eqNullSafe(F.col("long_one"))
    searched = _searched(parts.join(long, same, "left_semi"))
    short = parts.join(long, same, "left_anti")
    return _put_together(short.unionByName(searched, allowMissingColumns=True))


class _Repaired:
    """The repaired rows of one conversation, from its edits and its rows in order."""

    def __init__(self, head: dict):
        self.head, self.edits, self.state = head, iter(head["audit"]), START

    def row(self, role: str, text: str, copies: int) -> Iterator[tuple[str, str]]:
        for _ in range(copies):
            edit = next(self.edits)
            while edit == "I":
                yield self._made(), ""
                edit = next(self.edits)
            if edit == "K":
                self.state = AFTER_KEEP[self.state, role[:1]]
                yield role, text
            elif edit == "R":
                yield self._made(), text

    def rest(self) -> Iterator[tuple[str, str]]:
        for _ in self.edits:
            yield self._made(), ""

    def _made(self) -> str:
        role = _ROLES[NEXT_ROLE[self.state]]
        self.state = AFTER_NEXT[self.state]
        return role


def _in_order(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """Each conversation's audit, then its rows in order; a conversation is in one partition
    and is read as a stream."""
    heads = audited.withColumn("kind", F.lit(0))
    bodies = _digested(rows).withColumn("kind", F.lit(1))
    both = heads.unionByName(bodies, allowMissingColumns=True)
    order = ["conv_id", "kind", *_ORDER[1:]]
    return both.repartition("conv_id").sortWithinPartitions(*order).drop("digest")


def repaired_rows(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, place (from 0), role, text."""
    fields = "conv_id long, place long, role string, text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        now, place = None, 0
        for batch in batches:
            for row in batch.to_pylist():
                if row["kind"] == 0:
                    made = now.rest() if now else ()
                else:
                    made = now.row(row["role"], row["text"], row["copies"])
                for role, text in made:
                    yield now.head["conv_id"], place, role, text
                    place += 1
                if row["kind"] == 0:
                    now, place = _Repaired(row), 0
        for role, text in now.rest() if now else ():
            yield now.head["conv_id"], place, role, text
            place += 1

    return _in_order(rows, audited).mapInArrow(lambda batches: _batches(run(batches), _schema(fields)), fields)


def repaired_digests(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """``audited`` with repaired_sha256: of the repaired ``role:text`` rows joined by newline."""
    fields = f"{_AUDIT_FIELDS}, repaired_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        now, digest, begun = None, None, False

        def absorb(made) -> None:
            nonlocal begun
            for role, text in made:
                digest.update(("\n" if begun else "").encode() + role.encode() + b":")
                digest.update(text.encode())
                begun = True

        def told() -> tuple:
            absorb(now.rest())
            return (*[now.head[c] for c in ("conv_id", *_COUNTS, "audit")], digest.hexdigest())

        for batch in batches:
            for row in batch.to_pylist():
                if row["kind"] == 0:
                    if now:
                        yield told()
                    now, digest, begun = _Repaired(row), hashlib.sha256(), False
                else:
                    absorb(now.row(row["role"], row["text"], row["copies"]))
        if now:
            yield told()

    return _in_order(rows, audited).mapInArrow(lambda batches: _batches(run(batches), _schema(fields)), fields)


def repair(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """What ``rows`` are in need of, one row for every conv_id of ``conversations``."""
    kept = Kept(conversations.sparkSession)
    found = audits(rows, kept).withColumnRenamed("conv_id", "found_id")
    every = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    whole = every.join(found, F.col("conv_id").eqNullSafe(F.col("found_id")), "left").drop("found_id")
    whole = whole.na.fill(0, list(_COUNTS)).na.fill("", ["audit"])
    audited = kept.write(whole, "audits")
    kept.drop("parts")
    return repaired_digests(rows, audited)
