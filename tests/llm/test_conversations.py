"""Repaired conversations against a plain search for the cheapest edits."""

from __future__ import annotations

import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from staymark.llm import conversations as C
from staymark.llm import edit_search
from staymark.llm.common import Kept, table
from staymark.llm.registry import queries

from .conftest import CLASHING

SCHEMA = "conv_id long, turn long, role string, text string"
LEGAL, PREFIX = re.compile(r"(s?(ua)+)?"), re.compile(r"(s?(ua)*u?)?")
SPACES = " \t\n\x0b\x0c\r"


def best_edits(rows):
    """Cheapest, then ASCII-least edits over (initial, must go, truncated), and what is kept.

    Looks at whole strings of roles only; knows no states and no bounds.
    """
    heap = [(0, "", 0, "", ())]
    while True:
        cost, edits, at, roles, made = heapq.heappop(heap)
        if at == len(rows) and LEGAL.fullmatch(roles):
            return cost, edits, made
        if not PREFIX.fullmatch(roles):
            continue
        for role in "ua":
            heapq.heappush(heap, (cost + 2, edits + "I", at, roles + role, (*made, (role, None))))
        if at == len(rows):
            continue
        initial, goes, truncated = rows[at]
        heapq.heappush(heap, (cost + 3, edits + "D", at + 1, roles, made))
        if not goes:
            heapq.heappush(heap, (cost + truncated, edits + "K", at + 1, roles + (initial or " "), (*made, ("", at))))
            for role in "ua":
                heapq.heappush(heap, (cost + 2 + truncated, edits + "R", at + 1, roles + role, (*made, (role, at))))


def expected(table_rows):
    """The query's rows, one conversation after another."""
    every = {r[0]: [] for r in table_rows}
    for conv, turn, role, text in table_rows:
        shown = [" " if v is None else str(v) for v in (conv, turn, role, text)]
        kind = zlib.crc32(f"{shown[0]}:{shown[1]}".encode()) % 20
        role, text = shown[2:]
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        every[conv] += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    for conv, rows in every.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        faults, seen = [], set()
        for _, role, text in rows:
            end = text.rstrip(SPACES)[-1:]
            faults.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end not in ".!?" else "")
            seen.add((role, text))
        turns = {t for t, _, _ in rows if t is not None}
        cost, edits, made = best_edits([(r[1][:1], f in ("blank", "duplicate"), f == "truncated") for r, f in zip(rows, faults, strict=True)])
        lines = [f"{ {'u': 'user', 'a': 'assistant'}.get(role) or rows[at][1]}:{'' if at is None else rows[at][2]}" for role, at in made]
        yield (
            conv,
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
            sum(x[1][:1] + y[1][:1] not in ("su", "ua", "au") for x, y in itertools.pairwise(rows)),
            cost,
            edits,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )


COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def found(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def invented(rng, n, longest=6):
    texts = ["Yes.", "No!", "Why?", "cut off", " ", "", "same text.", None, "one. two"]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "User"]
    rows = []
    for conv in range(n):
        for turn in range(rng.randrange(1, longest)):
            role = rng.choice(roles) if rng.random() < 0.4 else roles[turn % 2]
            shown = None if rng.random() < 0.05 else turn + rng.randrange(2) * (rng.random() < 0.2)
            rows.append((None if conv == 1 else conv, shown, role, rng.choice(texts) if rng.random() < 0.5 else f"t{turn}."))
    return rows


def test_search_agrees_with_plain_search():
    rng = random.Random(3)
    for n in range(6):
        for _ in range(60):
            symbols = "".join(rng.choice("suauaSUAox") for _ in range(n))
            rows = [(y.lower(), y == "x", y.isupper()) for y in symbols]
            assert edit_search.cheapest(symbols) == best_edits(rows)[:2]


@pytest.mark.parametrize("whole, part", [(512, 64), (2, 1), (3, 2)])
def test_repair_agrees_with_plain_search(spark, monkeypatch, whole, part):
    """Also where conversations are cut into parts, and parts lie in several partitions."""
    monkeypatch.setattr(C, "WHOLE", whole)
    monkeypatch.setattr(C, "PART", part)
    rows = invented(random.Random(whole), 60)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for name in (*CLASHING, "kind", "copies", "place", "digest", "fault"):
        df = df.withColumn(name, F.lit(-1))
    assert found(C.repair(df, C.damage(df))) == sorted(expected(rows), key=str)


def test_parts_and_whole_agree_on_long_conversations(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(7, i, rng.choice(["user", "assistant"]), f"{i}{rng.choice(['.', ''])}") for i in range(400)]
    rows += [(8, 5, "user", "the same row again.")] * 300
    df = spark.createDataFrame(rows, SCHEMA)
    whole = found(C.repair(df, C.damage(df)))
    monkeypatch.setattr(C, "WHOLE", 100)
    assert found(C.repair(df, C.damage(df))) == whole


def test_repaired_rows_are_legal(spark):
    rows = invented(random.Random(4), 40)
    df = spark.createDataFrame(rows, SCHEMA)
    damaged = C.damage(df)
    audited = C.audits(damaged, Kept(spark))
    by_conv = {}
    for r in sorted(C.repaired_rows(damaged, audited).collect(), key=lambda r: r.place):
        by_conv.setdefault(r.conv_id, []).append(r.role[:1])
    assert by_conv and all(LEGAL.fullmatch("".join(roles)) for roles in by_conv.values())


def test_awkward_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert found(C.repair(empty, C.damage(empty))) == []
    dropped = [n for n in range(200) if zlib.crc32(f"{n}:0".encode()) % 20 == 0][:1]
    rows = [(dropped[0], 0, "user", "gone.")] + [(None, None, None, None)] * 3 + [(10**6, 1, "assistant", "long. " * 300_000)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = found(C.repair(df, C.damage(df)))
    assert got == sorted(expected(rows), key=str)
    nothing = hashlib.sha256(b"").hexdigest()
    assert (dropped[0], 0, 0, 0, 0, 0, 0, "", nothing) in got


def test_query_agrees_on_the_smallest_table(spark):
    directory = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in table(spark, directory, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert found(queries()["op13_conversations"](spark, directory)) == sorted(expected(rows), key=str)
