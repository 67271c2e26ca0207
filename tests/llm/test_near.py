"""Near documents, lines and vectors against comparing everything with everything."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from staymark.llm import listed_links, near_documents, near_lines, near_vectors, texts
from staymark.llm.common import Kept
from staymark.llm.components import components
from staymark.llm.edit_distance import within

from .conftest import AWKWARD


class Groups:
    def __init__(self, nodes):
        self.parent = {n: n for n in nodes}

    def find(self, x):
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, x, y):
        x, y = self.find(x), self.find(y)
        self.parent[max(x, y)] = min(x, y)


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def similar(x, y):
    both = len(x & y)
    return both > 0 and 100 * both >= 75 * (len(x) + len(y) - both)


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)]
    groups = Groups(range(500))
    for a, b in links:
        groups.join(a, b)
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.component for r in components(df, Kept(spark)).collect()}
    assert got == {n: groups.find(n) for a, b in links if a != b for n in (a, b)}
    assert components(df.limit(0), Kept(spark)).count() == 0


@pytest.mark.parametrize("rounds", [1, 4])
def test_lists_lose_no_component(spark, monkeypatch, rounds):
    """Links that no single item of a list shares, so that several rounds are needed."""
    monkeypatch.setattr(listed_links, "ROUNDS", rounds)
    rng = random.Random(rounds)
    entries = [(rng.randrange(12), i, 1) for i in range(150)]
    together = {(a[1], b[1]) for a in entries for b in entries if a[0] == b[0] and a[1] < b[1]}
    linked = {p for p in together if rng.random() < 0.08}
    links = spark.createDataFrame(sorted(linked), "a long, b long")
    lists = spark.createDataFrame(entries, "key long, item long, about long")
    lists = lists.withColumn("first", F.col("item"))
    found = listed_links.linked(lists, lambda pairs: pairs.join(links, ["a", "b"]), Kept(spark), pairs_per_entry=0)
    groups = Groups(range(150))
    for a, b in linked:
        groups.join(a, b)
    got = {r.node: r.component for r in found.collect()}
    assert [got.get(i, i) for i in range(150)] == [groups.find(i) for i in range(150)]


def near_copies(rng, n):
    """Texts of some words, copies of them with edits, and a passage that many share."""
    passage = " ".join(f"p{i}" for i in range(30))
    made = []
    for _ in range(n):
        if made and rng.random() < 0.6:
            words = rng.choice(made).split(" ")
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                words[rng.randrange(len(words))] = f"e{rng.randrange(99)}"
        else:
            words = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([1, 3, 4, 5, 6, 20, 60, 200, 700]))]
            if rng.random() < 0.5:
                words += passage.split(" ")
        made.append(" ".join(words))
    return made


@pytest.mark.parametrize("seed", [1, 2])
def test_near_documents(documents, seed):
    texts = near_copies(random.Random(seed), 250)
    groups, sets = Groups(range(250)), [shingles(t) for t in texts]
    for i in range(250):
        for j in range(i):
            if similar(sets[i], sets[j]):
                groups.join(i, j)
    got = {r.doc_id: r for r in near_documents.near_documents(documents(list(enumerate(texts)))).collect()}
    assert [got[i].component_id for i in range(250)] == [groups.find(i) for i in range(250)]
    assert [got[i].n_shingles for i in range(250)] == [len(s) for s in sets]
    assert all(got[i].kept == (groups.find(i) == i) for i in range(250))


def test_near_documents_about_as_long_as_a_sketch(documents):
    """Pairs by themselves, of 60 to 110 words: one and two edits, and tails cut or replaced."""
    rng, texts, linked = random.Random(4), [], []
    for n in range(60, 111):
        for edits, cut in [(1, 0), (2, 0), (2, 0), (0, n // 5), (0, n // 4), (0, -(n // 7)), (1, n // 9)]:
            words = [f"w{rng.randrange(10**6)}" for _ in range(n)]
            other = words[: n - cut] if cut >= 0 else [*words[:cut], *[f"t{i}" for i in range(-cut)]]
            for _ in range(edits):
                other[rng.randrange(len(other))] = f"e{rng.randrange(10**6)}"
            texts += [" ".join(words), " ".join(other)]
            linked.append(similar(*map(shingles, texts[-2:])))
    rows = near_documents.near_documents(documents(list(enumerate(texts)))).collect()
    got = {r.doc_id: r.component_id for r in rows}
    assert [got[2 * i + 1] == 2 * i for i in range(len(linked))] == linked
    assert 100 < sum(linked) < len(linked)


def test_heavily_edited_copies_are_not_paired_with_each_other(documents, monkeypatch):
    """Sketches let most pairs of such copies pass; few of them get as far as their texts."""
    rng, base = random.Random(6), [f"w{i}" for i in range(120)]
    texts = []
    for i in range(300):
        words = base[:]
        for _ in range(rng.choice([1, 2, 3, 4, 5, 7, 8])):
            words[rng.randrange(120)] = f"e{i} {rng.randrange(10**6)}"
        texts.append(" ".join(words))
    groups, sets = Groups(range(300)), [shingles(t) for t in texts]
    for i in range(300):
        for j in range(i):
            if similar(sets[i], sets[j]):
                groups.join(i, j)
    checked, verified = [], near_documents._verified

    def counting(pairs, read):
        checked.append(pairs.count())
        return verified(pairs, read)

    monkeypatch.setattr(near_documents, "_verified", counting)
    got = {r.doc_id: r.component_id for r in near_documents.near_documents(documents(list(enumerate(texts)))).collect()}
    assert [got[i] for i in range(300)] == [groups.find(i) for i in range(300)]
    assert 50 < len(set(got.values())) < 250
    assert sum(checked) < 10 * 300


def test_awkward_documents(documents):
    rows = near_documents.near_documents(documents(AWKWARD, extra=True)).collect()
    assert len(rows) == len(AWKWARD)
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append(r)
    assert all(r.component_id == key and r.kept for key in (1, 2, 3, 4, 5, 6, 7, 8) for r in by_id[key])
    assert [(r.component_id, r.kept) for r in by_id[9]] == [(4, False)]
    assert [(r.component_id, r.kept) for r in by_id[None]] == [(None, True)] * 2
    assert [r.n_shingles for r in by_id[1] + by_id[2] + by_id[3]] == [0, 0, 0]
    assert near_documents.near_documents(documents([])).count() == 0


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_edit_distance():
    rng = random.Random(3)
    for _ in range(2000):
        a = "".join(rng.choice("ab") for _ in range(rng.randrange(15)))
        b = list(a)
        for _ in range(rng.randrange(6)):
            i = rng.randrange(len(b) + 1)
            b[i : i + rng.randrange(2)] = rng.choice(["", "a", "c"])
        b = "".join(b)
        for most in range(4):
            assert within(a, b, most) == (distance(a, b) <= most)


def removed_lines(rows, threshold):
    lines = [
        (key, n, line)
        for key, text in rows
        for n, line in enumerate((text or "").split("\n"))
        if line.strip(" \t\n\v\f\r")
    ]
    texts = sorted({line for *_, line in lines})
    groups = Groups(texts)
    for i, x in enumerate(texts):
        for y in texts[:i]:
            if min(len(x), len(y)) >= near_lines.SHORTEST and within(x, y, threshold):
                groups.join(x, y)
    first = {}
    for key, n, line in sorted(lines):
        first.setdefault(groups.find(line), (key, n))
    return {(key, n) for key, n, line in lines if first[groups.find(line)] != (key, n)}


@pytest.mark.parametrize("threshold", [1, 2, 3])
def test_lines(documents, threshold):
    rng = random.Random(threshold)
    base = ["".join(rng.choice("abcdé ñ日") for _ in range(rng.randint(25, 60))) for _ in range(20)]

    def edited(line):
        line = list(line)
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
            i = rng.randrange(len(line))
            line[i : i + rng.randrange(2)] = rng.choice(["", "x", "é"])
        return "".join(line)

    rows = [
        (i, "\n".join(rng.choice(["", " ", "short", edited(rng.choice(base))]) for _ in range(rng.randrange(9))))
        for i in range(60)
    ]
    got = near_lines.repeated_lines(documents(rows), threshold).collect()
    assert {(r.doc_id, r.number) for r in got} == removed_lines(rows, threshold)


def test_lines_within_edits_that_follow_their_length(documents):
    rng = random.Random(7)

    def most(*lines):
        return min(near_lines.MOST, min(map(len, lines)) // near_lines.EVERY)

    base = ["".join(rng.choice("abcdé ñ日") for _ in range(n)) for n in [*range(30, 340, 10), 64, 96, 600]]
    lines = []
    for line in base:
        for edits in {0, 1, most(line), most(line) + 1, most(line) + 3}:
            other = list(line)
            for i in rng.sample(range(len(other)), edits):
                other[i] = rng.choice(["", "x", "xy", "é"])
            lines.append("".join(other))
        at = rng.randrange(len(line) - 8)
        lines.append(line[:at] + line[at + 8 :])  # a word dropped
    rng.shuffle(lines)
    groups = Groups(range(len(lines)))
    for i, x in enumerate(lines):
        for j, y in enumerate(lines[:i]):
            if x == y or (min(len(x), len(y)) >= near_lines.SHORTEST and within(x, y, most(x, y))):
                groups.join(i, j)
    got = near_lines.repeated_lines(documents(list(enumerate(lines)))).collect()
    assert {r.doc_id for r in got} == {i for i in range(len(lines)) if groups.find(i) != i}
    assert all(most(x) == k for x, k in (("x" * 32, 1), ("x" * 64, 2), ("x" * 999, 8)))


def test_awkward_lines(documents):
    source = documents([*AWKWARD, (10, "short\nshort\n\nother"), (None, "short")], extra=True)
    rows = near_lines.remove_repeated_lines(source).collect()
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append(r)
    assert len(rows) == len(AWKWARD) + 2
    assert set(source.columns) - {"text_hash", "drops"} <= set(rows[0].asDict())
    assert (by_id[1][0].text, by_id[1][0].n_lines) == (None, 0)
    assert (by_id[3][0].text, by_id[3][0].n_lines) == (AWKWARD[2][1], 0)
    assert [r.n_removed for r in by_id[4]] == [0, 0]
    assert [(r.text, r.n_removed) for r in by_id[9]] == [("", 2)]
    assert by_id[10][0].text == "short\n\nother"
    assert sorted(str(r.text) for r in by_id[None]) == ["", "None", AWKWARD[5][1]]
    assert near_lines.remove_repeated_lines(documents([])).count() == 0


def vectors_of(rng, n, size=16):
    made = []
    for _ in range(n):
        if made and rng.random() < 0.6:
            old = rng.choice(made)
            noise = rng.choice([0.0, 0.03, 0.06])
            made.append([x + rng.gauss(0, noise) for x in old])
        else:
            made.append([rng.gauss(0, 1) for _ in range(size)])
    return made


def cosine(x, y):
    return sum(a * b for a, b in zip(x, y, strict=True)) / math.hypot(*x) / math.hypot(*y)


def test_vectors(spark, monkeypatch):
    """Recall against all pairs; leaves and blocks are small, so that all paths are taken."""
    monkeypatch.setattr(near_vectors, "LEAF", 40)
    monkeypatch.setattr(near_vectors, "BLOCK", 25)
    rng = random.Random(5)
    made = vectors_of(rng, 500)
    labels = [rng.randrange(3) for _ in made]
    df = spark.createDataFrame(
        [(i, v, c) for i, (v, c) in enumerate(zip(made, labels, strict=True))],
        "vec_id long, embedding array<double>, label int",
    ).withColumn("item", F.lit(1))
    got = {r.vec_id: r for r in near_vectors.near_vectors(df).collect()}
    links, groups = [0] * 500, Groups(range(500))
    for i in range(500):
        for j in range(i):
            if labels[i] == labels[j] and cosine(made[i], made[j]) >= 0.98:
                links[i] += 1
                links[j] += 1
                groups.join(i, j)
    assert all(got[i].n_links <= links[i] for i in range(500))
    assert sum(got[i].n_links for i in range(500)) >= 0.95 * sum(links) > 100
    same = sum(got[i].component_id == groups.find(i) for i in range(500))
    assert same >= 490
    assert all(got[i].kept == (got[i].component_id == i) for i in range(500))


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None),
        (5, None, 1), (6, [], 1), (7, [0.0, 0.0], 1), (8, [nan, 1.0], 1), (9, [inf, 1.0], 1),
        (10, [None, 1.0], 1), (11, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.0], 1), (12, [1.0, 0.0], 1),
        (12, [1.0, 0.0], 1),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = sorted((tuple(r) for r in near_vectors.near_vectors(df).collect()), key=str)
    want = [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10, 11)]
    want += [(1, 4, 1, True), (2, 4, 1, False), (None, 4, 1, False), (12, 4, 1, False), (12, 4, 1, False)]
    assert got == sorted(want, key=str)
    assert near_vectors.near_vectors(df.limit(0)).count() == 0


def test_vectors_of_any_magnitude(spark):
    """Cosines do not depend on length, also where squares leave the range of doubles."""
    rows = [
        (1, [1e-200, 1e-200], 1), (2, [2e-200, 2e-200], 1), (3, [1e200, 1e200], 1), (4, [1e308, 1e308], 1),
        (5, [5e-324, 5e-324], 1), (6, [1.0, 1.0], 1), (7, [1e200, -1e200], 1), (8, [1e-200, -1e-200], 1),
        (9, [1e308, 1e-308], 1),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors.near_vectors(df).collect()}
    assert got == {i: (5, 1) for i in range(1, 7)} | {7: (1, 7), 8: (1, 7), 9: (0, 9)}


@pytest.mark.parametrize("bits, most", [(1, 32 << 20), (8, 0)])
def test_filter_of_own_keys_loses_no_line(documents, monkeypatch, bits, most):
    """Few bits let more probes pass, and no filter all of them; the lines found are the same."""
    rng = random.Random(bits)
    base = ["".join(rng.choice("abcdefg hij") for _ in range(rng.randrange(32, 300))) for _ in range(60)]
    lines = []
    for line in base:
        at = rng.randrange(len(line) - 2)
        lines += [line, line[:at] + "X" + line[at + rng.randrange(3) :]]
    df = documents(list(enumerate(lines)))
    want = sorted(map(tuple, near_lines.repeated_lines(df).collect()))
    assert len(want) >= 40
    monkeypatch.setattr(near_lines, "FILTER_BITS", bits)
    monkeypatch.setattr(near_lines, "FILTER_BYTES", most)
    assert sorted(map(tuple, near_lines.repeated_lines(df).collect())) == want


def test_probes_are_neither_stored_nor_made_for_the_filter(documents, monkeypatch):
    rng = random.Random(9)
    lines = ["".join(rng.choice("abcdefg hij") for _ in range(280)) for _ in range(40)]
    df = documents([(i, "\n".join(lines * 3)) for i in range(2)], partitions=1)
    keyed = near_lines._keyed(df, None, None).cache()
    assert keyed.distinct().count() == keyed.count() > 200 * len(lines)
    assert keyed.where("own").count() == 9 * len(lines)
    stored, write = [], Kept.write

    def counting(kept, rows, label):
        written = write(kept, rows, label)
        stored.append(written.count())
        return written

    monkeypatch.setattr(Kept, "write", counting)
    monkeypatch.setattr(near_lines, "FILTER_BYTES", 0)  # so that no probe is dropped before the shuffle
    assert near_lines.repeated_lines(df).count() == 5 * len(lines)
    assert max(stored) <= 6 * len(lines)
    chunk = next(near_lines.chunks(pa.array(["\n".join(lines * 3)])))
    made = list(near_lines._Lines.of(chunk).keys(chunk, None, probes=False))
    assert [(len(keys), own) for _, keys, own in made] == [(len(lines), True)] * 9


def test_powers_kept_are_no_larger_than_a_chunk_needs():
    """A worker keeps eight of them for as long as it lives."""
    chunk = next(near_lines.chunks(pa.array(["a b\n" * (texts.CHUNK_BYTES // 4)] * 2)))
    assert len(chunk.data) > texts.CHUNK_BYTES - 4
    assert all(power.nbytes <= 4 << 20 for _, power, _ in chunk.hashes()._parts)


def test_vectors_are_put_into_leaves_a_few_at_a_time():
    rng = np.random.default_rng(7)
    vectors = rng.normal(size=(1500, 8))
    forests = {8: near_vectors.fit(near_vectors._unit(pd.Series(list(vectors))), 100_000)}
    frame = pd.DataFrame({"item": range(1500), "label": "a", "copies": 1, "embedding": list(vectors)})
    made = list(near_vectors._in_leaves(frame, forests))
    assert max(out["item"].nunique() for out in made) <= near_vectors.PLACED_ROWS
    placed = pd.concat(made)
    row, code = forests[8].leaves(near_vectors._unit(frame["embedding"]))
    assert sorted(zip(placed["item"], placed["leaf"], strict=True)) == sorted(zip(row, code, strict=True))
    assert (placed["leaves"].map(len) == placed.groupby("item")["leaf"].transform("size")).all()


def test_lines_near_each_other_pass_by_their_signatures():
    """An edit turns two bits or fewer, or one where it changes the length."""
    rng = random.Random(11)
    lines = ["".join(rng.choice("abcdé ñ日𝄞") for _ in range(n)) for n in (32, 33, 64, 90, 300, 700)]
    codes = [np.array([ord(c) for c in line], np.uint32) for line in lines]

    def bits(line):
        return near_lines.signatures(np.array([ord(c) for c in line], np.uint32), np.array([0]), np.array([len(line)]))[0]

    starts = np.cumsum([0, *map(len, codes[:-1])])
    together = near_lines.signatures(np.concatenate(codes), starts, np.array(list(map(len, codes))))
    assert [bits(line).tolist() for line in lines] == together.tolist()
    for line in lines * 20:
        other, edits = list(line), rng.randrange(9)
        for _ in range(edits):
            at = rng.randrange(len(other))
            other[at : at + rng.randrange(2)] = rng.choice(["", "x", "é"])
        turned = sum(bin(int(w) & (1 << 64) - 1).count("1") for w in bits(line) ^ bits("".join(other)))
        assert turned + abs(len(line) - len(other)) <= 2 * edits
    assert near_lines.signatures(codes[0], np.zeros(0, np.int64), np.zeros(0, np.int64)).shape == (0, 3)


def test_lines_with_a_common_passage_alone_are_not_compared(documents, monkeypatch):
    """A hundred lines begin alike: their 4,950 pairs share a list, few of them are near."""
    rng = random.Random(12)
    lines = ["the same beginning of all lines " + "".join(rng.choices("abcdefghijkl mno", k=64)) for _ in range(100)]
    lines += [line[:-1] + "#" for line in lines[:10]]
    compared, verified = [], near_lines._verified

    def counting(pairs, *rest):
        compared.append(pairs.count())
        return verified(pairs, *rest)

    monkeypatch.setattr(near_lines, "_verified", counting)
    got = near_lines.repeated_lines(documents(list(enumerate(lines)))).collect()
    assert {r.doc_id for r in got} == set(range(100, 110))
    assert sum(compared) < 200


@pytest.mark.parametrize("sizes", [range(32, 300), range(280, 281)])
def test_keys_beyond_one_filter_are_made_in_shares(documents, monkeypatch, sizes):
    """Also where all lines are of one length; each share has a filter, so few probes pass."""
    rng = random.Random(len(sizes))
    lines = []
    for _ in range(60):
        line = "".join(rng.choice("abcdefg hij") for _ in range(rng.choice(sizes)))
        at = rng.randrange(len(line) - 2)
        lines += [line, line[:at] + "X" + line[at + rng.randrange(3) :]]
    df = documents(list(enumerate(lines + lines[:5])))
    want = sorted(map(tuple, near_lines.repeated_lines(df).collect()))
    assert len(want) >= 40
    made, keyed = [], near_lines._keyed

    def counting(source, held, *rest):
        rows = keyed(source, held, *rest)
        made.append((held is not None, rows.where("own").distinct().count(), rows.where("NOT own").count()))
        return rows

    monkeypatch.setattr(near_lines, "_keyed", counting)
    monkeypatch.setattr(near_lines, "FILTER_BITS", 256)
    monkeypatch.setattr(near_lines, "FILTER_BYTES", near_lines.BITMAP)
    assert sorted(map(tuple, near_lines.repeated_lines(df).collect())) == want
    assert all(filtered for filtered, *_ in made) and len(made) > 3
    long = [line for line in lines if len(line) >= near_lines.SHORTEST]
    own = sum(min(len(line) // near_lines.EVERY, near_lines.MOST) + 1 for line in long)
    assert sum(n for _, n, _ in made) == own
    assert max(n for _, n, _ in made) < own / 2
    assert sum(n for *_, n in made) < 3 * own


def test_shares_hold_all_own_keys_and_no_more_than_asked_for():
    counted = [(32, 40, 10), (41, 41, 15), (42, 60, 3), (61, 61, 100), (62, 70, 25), (71, 99, 1)]
    made = near_lines.shares(counted, 25)
    assert [(s.first, s.last) for s in made] == [(32, 41), (42, 60), *[(61, 61)] * 4, (62, 70), (71, 99)]
    assert [(s.part, s.of) for s in made[2:6]] == [(i, 4) for i in range(4)]
    assert all(s.own_keys <= 25 for s in made) and sum(s.own_keys for s in made) == 154
    keys = np.arange(1000, dtype=np.uint64)
    assert sorted(np.concatenate([keys[s.holds(keys)] for s in made[2:6]]).tolist()) == keys.tolist()


def test_entries_without_own_segment_are_not_paired_with_each_other(spark, monkeypatch):
    """What is left after the hub rounds; nor is a link between others lost."""
    monkeypatch.setattr(listed_links, "ROUNDS", 1)
    rng = random.Random(13)
    rows = [(key, item, item, 0, rng.random() < 0.2) for key in range(30) for item in rng.sample(range(60), 8)]
    lists = spark.createDataFrame(rows, "key long, item long, first long, about int, own boolean")
    led = {
        tuple(sorted((a[1], b[1]))) for a in rows for b in rows if a[0] == b[0] and a[1] != b[1] and (a[4] or b[4])
    }
    links = rng.sample(sorted(led), 40)
    table = spark.createDataFrame(links, "a long, b long")
    checked = []

    def check(pairs):
        checked.append({tuple(r) for r in pairs.collect()})
        return pairs.join(table, ["a", "b"])

    found = listed_links.linked(lists, check, Kept(spark), pairs_per_entry=1000, lead="own")
    groups = Groups(range(60))
    for a, b in links:
        groups.join(a, b)
    got = {r.node: r.component for r in found.collect()}
    assert all(got.get(i, i) == min(j for j in range(60) if groups.find(j) == groups.find(i)) for i in range(60))
    assert checked[-1] <= led and len(checked) == 2


def test_only_what_is_to_be_removed_is_kept_of_lines(documents, monkeypatch):
    made = []

    class Remembered(Kept):
        def __init__(self, spark):
            super().__init__(spark)
            made.append(self)

    monkeypatch.setattr(near_lines, "Kept", Remembered)
    line = "a line of words that is long enough to be compared with others"
    cleaned = near_lines.remove_repeated_lines(documents([(1, line), (2, line + "s"), (3, "b\nc")]))
    assert [set(kept.paths) for kept in made] == [{"drops"}]
    assert {r.doc_id: (r.n_removed, r.n_near) for r in cleaned.collect()} == {1: (0, 0), 2: (1, 1), 3: (0, 0)}
