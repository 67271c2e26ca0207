"""Each stage of the pipeline on what the one before it kept, against brute force."""

from __future__ import annotations

import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from staymark.llm import language, near_lines

from .test_near import Groups, removed_lines, shingles, similar

SECRET = re.compile(r"token = [a-z0-9]{16}")


def made(rng):
    """Documents of lines, near and exact copies, shared lines, and a few without words."""
    words = [f"w{i}ord" for i in range(800)]
    shared = [" ".join(rng.choice(words) for _ in range(9)) for _ in range(3)]
    rows = [(1, None), (2, ""), (3, "123 456 !!"), (4, "7\n\n8")]
    for i in range(5, 45):
        lines = [" ".join(rng.choice(words) for _ in range(12)) for _ in range(rng.choice([1, 4, 12]))]
        if rng.random() < 0.3:
            lines.insert(rng.randrange(len(lines) + 1), rng.choice(shared))
        if rng.random() < 0.3:
            lines.append("token = " + "".join(rng.choice("ghijk12345") for _ in range(16)))
        rows.append((i, "\n".join(lines)))
    for i in range(45, 60):
        # One line anew cut in other places, so that lines differ and shingles hardly do.
        text = rng.choice(rows[4:44])[1].replace("\n", " ").split(" ")
        cut = rng.randrange(len(text))
        rows.append((i, " ".join(text[:cut]) + "\n" + " ".join(text[cut:])))
    rows += [(60, rows[10][1]), (61, "x" * 30_000 + " end")]
    return [(*r, "en", "s", len(r[1] or "")) for r in rows]


def check_packing(rows, found):
    tokenizer = Tokenizer.from_file(corpus_pipeline.TOKENIZER)
    pieces, sequences = {}, {}
    for r in found:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(pieces) == {r.doc_id for r in rows}
    for r in rows:
        ids = np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4")
        mine = sorted(pieces[r.doc_id], key=lambda p: p.piece)
        assert [p.piece for p in mine] == list(range(len(mine)))
        assert [p.start for p in mine] == [sum(q.length for q in mine[:k]) for k in range(len(mine))]
        assert sum(p.length for p in mine) == len(ids)
        for p in mine:
            assert p.ids_crc32 == zlib.crc32(ids[p.start : p.start + p.length].tobytes())
    for places in sequences.values():
        places.sort()
        assert [at for at, _ in places] == [sum(n for _, n in places[:k]) for k in range(len(places))]
        assert sum(n for _, n in places) <= 1024


@pytest.mark.parametrize("extra", [False, True])
def test_stages(spark, documents, tmp_path, extra):
    docs = documents(made(random.Random(8)), extra=extra)
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    before = docs.collect()

    def step(name):
        nonlocal docs
        stages[name](spark, docs, str(tmp_path)).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        return sorted(docs.collect(), key=lambda r: r.doc_id)

    classify = language.Identifier(language.learn(docs))
    told = step("language")
    assert [r.doc_id for r in told] == sorted(r.doc_id for r in before if not classify(r.text)[2])
    assert not {1, 2, 3, 4} & {r.doc_id for r in told} and len(told) == 57
    assert docs.columns == columns

    gone = removed_lines([(r.doc_id, r.text) for r in told], 1)
    want = {}
    for r in told:
        lines = list(enumerate(r.text.split("\n")))
        left = [line for n, line in lines if (r.doc_id, n) not in gone]
        if any(line.strip() for line in left):
            want[r.doc_id] = "\n".join(left)
    single = step("lines")
    assert {r.doc_id: r.text for r in single} == want and gone
    assert 60 not in want and docs.columns == columns

    groups, sets = Groups(want), {key: shingles(t) for key, t in want.items()}
    for a in want:
        for b in want:
            if a < b and similar(sets[a], sets[b]):
                groups.join(a, b)
    apart = step("near_documents")
    assert [r.doc_id for r in apart] == [key for key in sorted(want) if groups.find(key) == key]
    assert len(apart) < len(want) and docs.columns == columns

    redacted = step("secrets")
    assert [(r.doc_id, r.text) for r in redacted] == [(r.doc_id, SECRET.sub("[secret]", r.text)) for r in apart]
    assert any("[secret]" in r.text for r in redacted)
    assert all(r.n_chars == len(r.text) for r in redacted) and docs.columns == columns

    check_packing(redacted, step("packing"))


def test_run_is_its_stages(spark, documents, tmp_path):
    docs = documents(made(random.Random(9)))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    whole = corpus_pipeline.run(spark, str(tmp_path))

    def content(df):
        return sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in df.collect())

    assert content(whole) == content(docs)


def test_empty(spark, documents, tmp_path):
    documents([]).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_line_stage_takes_near_lines(spark, documents, tmp_path):
    """Lines of up to 8 edits by length go, one edit more stays; documents left empty go too."""
    rng = random.Random(10)

    def line(size):
        return "".join(rng.choice("abcdefgh ijklmnop") for _ in range(size)).strip() + "z"

    def edited(text, edits):
        chars = list(text)
        for at in rng.sample(range(len(chars) - 1), edits):
            chars[at] = rng.choice("QRSTUV")
        return "".join(chars)

    rows, want = [], {}
    for n, size in enumerate((40, 70, 100, 140, 170, 200, 230, 260, 400)):
        text, own = line(size), line(90)
        most = min(len(text) // near_lines.EVERY, near_lines.MOST)
        far = edited(text, most + 1)
        key = 10 * n
        rows += [(key, f"{text}\nfirst {n}"), (key + 1, f"{edited(text, most)}\n{own}"), (key + 2, f"{far}\nlast {n}"),
                 (key + 3, edited(own, 1))]
        want |= {key: rows[-4][1], key + 1: own, key + 2: rows[-2][1]}
    stage = dict(corpus_pipeline.STAGES)["lines"]
    found = stage(spark, documents(rows), str(tmp_path)).collect()
    # Chains may join lines that are farther apart; here none are.
    assert {r.doc_id: r.text for r in found} == want
    assert all(r.n_chars == len(r.text) for r in found if r.doc_id % 10 == 1)


@pytest.mark.parametrize("stage", [stage for _, stage in corpus_pipeline.STAGES])
def test_texts_go_to_workers_in_small_batches(spark, documents, stage):
    """A worker keeps the memory of the largest batch that it met."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = documents([(i, "Some words of a text. " * 200) for i in range(2000)], partitions=1).cache()

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["size"])

    given = spark.conf.get(name)
    try:
        stage(spark, docs, "")
        largest = docs.mapInArrow(sizes, "size long").agg({"size": "max"}).first()[0]
    finally:
        spark.conf.set(name, given)
    assert largest < 4 << 20
