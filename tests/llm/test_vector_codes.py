"""Vector codes against measuring every entry."""

from __future__ import annotations

import hashlib
import math
import random
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from staymark.llm import vector_codes as V
from staymark.llm.common import table
from staymark.llm.registry import queries

from .conftest import CLASHING

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows):
    """vec_id -> (code, error, label_error), and the digest of the codebooks."""
    kept = [(v, e, x) for v, e, x in rows if e and all(c is not None and math.isfinite(c) for c in e)]
    width = -(-max(len(e) for _, e, _ in kept) // 8)
    whole = [([math.floor(Fraction(c) * 4096) for c in e] + [0] * (8 * width - len(e)), v, x) for v, e, x in kept]
    whole.sort(key=lambda r: (r[1] is None, r[1] or 0, r[0]))
    cut = [[r[0][p * width : (p + 1) * width] for p in range(8)] for r in whole]
    books = [[c[p] for c in cut[:16]] for p in range(8)]

    def nearest(part, p):
        return min((sum((a - b) ** 2 for a, b in zip(part, entry, strict=True)), i) for i, entry in enumerate(books[p]))

    for _ in range(6):
        moved = []
        for p in range(8):
            members = defaultdict(list)
            for c in cut:
                members[nearest(c[p], p)[1]].append(c[p])
            moved.append([[sum(xs) // len(members[i]) for xs in zip(*members[i])] if i in members else e for i, e in enumerate(books[p])])
        books = moved
    found, by_label = [], defaultdict(int)
    for (_, v, label), c in zip(whole, cut, strict=True):
        near = [nearest(c[p], p) for p in range(8)]
        found.append([v, label, "".join(f"{i:02x}" for _, i in near), sum(d for d, _ in near)])
        by_label[label] += found[-1][3]
    told = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()

    def held(n):
        return n if n < 1 << 63 else None

    return sorted(((v, c, held(e), held(by_label[x]), told) for v, x, c, e in found), key=str)


def got(df):
    return sorted((tuple(r) for r in V.compress(df).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=str)


def vectors(rng, n, size, scale=1.0):
    return [[rng.gauss(0, scale) for _ in range(size)] for _ in range(n)]


def test_codes_agree_with_plain_ones(spark):
    rng = random.Random(1)
    rows = [(i * 3, v, rng.choice([1, 2, None])) for i, v in enumerate(vectors(rng, 200, 16))]
    rows += [(i, rows[0][1], 1) for i in range(1, 60, 3)]  # copies
    rows += [(5000, None, 1), (5001, [1.0, None] * 8, 1), (5002, [float("nan")] * 16, 1), (5003, [float("-inf")] * 16, 1), (5004, [], 1)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    for name in (*CLASHING, "code", "error", "rows", "label_error", "entry", "limb"):
        if name not in df.columns:
            df = df.withColumn(name, F.lit("-1"))
    assert got(df) == plain(rows)


@pytest.mark.parametrize("scale", [1e-200, 1e5, 1e12, 1e17, 1e200, 1e307])
def test_any_magnitude(spark, scale):
    rng = random.Random(2)
    rows = [(i, v, i % 2) for i, v in enumerate(vectors(rng, 40, 8, scale))]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert got(df) == plain(rows)


def test_awkward_tables(spark):
    assert got(spark.createDataFrame([], SCHEMA)) == []
    assert got(spark.createDataFrame([(1, None, 1)], SCHEMA)) == []
    rows = [(None, [0.1, 0.2, 0.3], None), (4, [0.5] * 11, 3), (4, [0.25] * 11, 3), (9, [1.0], None)]
    assert got(spark.createDataFrame(rows, SCHEMA)) == plain(rows)
    same = [(i, [1.0, 2.0, 3.0, 4.0] * 4, 1) for i in range(40)]
    assert got(spark.createDataFrame(same, SCHEMA)) == plain(same)


def test_masks_hold_every_entry_in_reach():
    rng = np.random.default_rng(5)
    for width in (1, 3, 8):
        book = V.Codebook(rng.integers(-50, 50, (64, width)).tolist())
        values = rng.integers(-60, 60, (300, width))
        far = ((values[:, None] - book.table[None]) ** 2).sum(axis=2)
        mask = book.candidates(values)
        inside = (mask[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)
        least = far.min(axis=1)
        assert (inside[far == least[:, None]] == 1).all()
        if width > 1:
            assert inside.mean() < 0.9  # entries are spared
        code, error = book.nearest(values)
        assert (code == far.argmin(axis=1)).all() and (error == least).all()


def test_limbs():
    for value in (0, -1, 5, -(1 << 40), (1 << 40), -(1 << 41) - 3, 10**50, -(10**50)):
        assert sum(x << (40 * i) for i, x in enumerate(V._limbs(value))) == value
        assert all(abs(x) <= 1 << 40 for x in V._limbs(value))


def test_integers_are_floors():
    batch = pa.array([[0.1, -0.1, 1e-9], [-1e-9, 2.0, 3.5]], pa.list_(pa.float64()))
    assert V.integers(batch, 4).tolist() == [[409, -410, 0, 0], [-1, 8192, 14336, 0]]


def test_query_agrees_on_the_smallest_table(spark):
    directory = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in table(spark, directory, "embeddings").select("vec_id", "embedding", "label").collect()]
    found = queries()["op11_vector_codes"](spark, directory).select("vec_id", "code", "error", "label_error", "codebooks_sha256")
    assert sorted((tuple(r) for r in found.collect()), key=str) == plain(rows)
