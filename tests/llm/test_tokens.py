"""Packing, token files and word BPE against the tokenizers library and plain Python."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from staymark.llm import packing, token_files, word_bpe
from staymark.llm.byte_bpe import ByteBpe, units
from staymark.llm.perfect_hash import PerfectHash, hash_keys
from staymark.sinks.locations import new_folder

from .conftest import AWKWARD

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def byte_tokenizer():
    return Tokenizer.from_file(BYTES)


@pytest.fixture(scope="module")
def word_tokenizer():
    return Tokenizer.from_file(WORDS)


ODD = ["", " ", "  a", "a  b", "a   b ", "a\n b", "a \n\n  b\t", "it's  'll x y　 z", "é́ \x1c q",
       "a <|endoftext|> b", "<|endoftext|>", "\r\n x", "x" * 500 + " y"]


def test_units_encode_like_the_whole_text(byte_tokenizer):
    rng = random.Random(4)
    made = ["".join(rng.choice("ab '.1é\n\t   ") for _ in range(rng.randrange(40))) for _ in range(400)]
    texts = ODD + made
    encode = ByteBpe(BYTES, remembered=50)
    got = [ids.tolist() for ids in encode(texts)]
    assert got == [e.ids for e in byte_tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert ["".join(units(t)) for t in texts] == texts


def test_packing(documents, byte_tokenizer):
    rows = packing.pack(documents(AWKWARD, extra=True), BYTES).collect()
    ids = [
        np.array(byte_tokenizer.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        for _, t in AWKWARD
    ]
    want = Counter()
    for (key, _), x in zip(AWKWARD, ids, strict=True):
        for k, (s, n) in enumerate(packing.cut(len(x), 1024)):
            want[key, k, s, n, zlib.crc32(x[s : s + n])] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    ends = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 1024
    assert len(ends) <= -(-sum(map(len, ids)) // 1024) + 1
    assert packing.pack(documents([]), BYTES).count() == 0


def test_cut():
    assert packing.cut(5, 4) == [(0, 1), (1, 4)]
    assert packing.cut(8, 4) == [(0, 4), (4, 4)]
    assert packing.cut(1, 4) == [(0, 1)]


@pytest.mark.parametrize("seed", range(20))
def test_plan_places_everything_once(seed):
    rng, capacity = random.Random(seed), 60
    counts = Counter(rng.choice([rng.randint(1, 60), rng.randint(1, 12), 60]) for _ in range(rng.randrange(400)))
    blocks = packing.pack_counts(dict(counts), capacity)
    placed = Counter()
    for block in blocks:
        used = sum(n * k for n, k in block.contents)
        assert block.bins > 0 and used == capacity - block.room <= capacity
        assert sum(k for n, k in block.contents if 3 * n > capacity) <= 2
        for n, k in block.contents:
            placed[n] += block.bins * k
    assert placed == counts
    # Never worse than best fit over the pieces one by one, in descending order.
    rooms = []
    for n in sorted(counts.elements(), reverse=True):
        fits = [i for i, room in enumerate(rooms) if room >= n]
        if fits:
            rooms[min(fits, key=lambda i: rooms[i])] -= n
        else:
            rooms.append(capacity - n)
    assert sum(b.bins for b in blocks) <= len(rooms) + 1


def test_large_items_are_matched_optimally():
    blocks = packing.match_large({60: 1, 35: 3, 25: 3, 30: 3}, 60)
    assert sum(b.bins for b in blocks) == 1 + 3 + 2


def test_perfect_hash():
    keys = [str(i) for i in range(5000)]
    hashes = hash_keys(keys)
    made = PerfectHash.of(hashes)
    read, end = PerfectHash.from_bytes(made.to_bytes() + b"rest")
    assert end == len(made.to_bytes())
    assert sorted(read.find(hashes)) == list(range(5000))
    others = read.find(hash_keys([f"no{i}" for i in range(5000)]))
    assert (others >= 0).sum() <= 1
    assert len(PerfectHash.of(hashes[:0]).find(hashes)) == 5000
    with pytest.raises(ValueError):
        PerfectHash.of(np.concatenate([hashes[:3], hashes[:3]]))


def test_token_files(spark, documents, byte_tokenizer):
    folder = new_folder(spark, "tokens")
    places = token_files.write(documents(AWKWARD, extra=True), folder, BYTES)
    rows = token_files.read_all(places, folder, "<u2").collect()
    want, start = [], 0
    order = sorted(AWKWARD, key=lambda r: (r[0] is not None, r[0] or 0))
    sums = Counter()
    for key, text in order:
        ids = np.array(byte_tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        want.append((key, len(ids)))
        sums[key, len(ids), zlib.crc32(ids)] += 1
        start += len(ids)
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == sums
    ordered = sorted(rows, key=lambda r: r.start)
    assert [r.doc_id for r in ordered] == [k for k, _ in want]
    assert [r.start for r in ordered] == list(np.cumsum([0] + [r.n_tokens for r in ordered])[:-1])
    # Access by key: present, absent, and a further row of a key.
    asked = spark.createDataFrame([("8",), ("4",), ("77",)], "key string")
    found = {r.key: r for r in token_files.find(asked, folder, token_files.LEAST_PARTS).collect()}
    assert set(found) == {"8", "4"}
    ids = token_files.read_ids(folder, found["8"].shard, found["8"].at, found["8"].n, "<u2")
    assert ids.tolist() == byte_tokenizer.encode(AWKWARD[10][1], add_special_tokens=False).ids + [2]
    empty = new_folder(spark, "tokens")
    assert token_files.read_all(token_files.write(documents([]), empty, BYTES), empty, "<u2").count() == 0


def test_word_bpe(documents, word_tokenizer):
    rows = word_bpe.encode_decode(documents(AWKWARD, extra=True), WORDS, leaf=4096).collect()
    want = Counter()
    for key, text in AWKWARD:
        ids = word_tokenizer.encode(text or "", add_special_tokens=False).ids
        decoded = word_tokenizer.decode(ids, skip_special_tokens=False)
        want[
            key,
            len(ids),
            hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(decoded.encode()).hexdigest(),
        ] += 1
    assert Counter(tuple(r) for r in rows) == want
    assert word_bpe.encode_decode(documents([]), WORDS).count() == 0


@pytest.mark.parametrize("leaf", [3, 4, 7, 16, 64])
def test_joined_halves_are_the_whole(word_tokenizer, leaf):
    made, rng = word_bpe.WordBpe(WORDS, leaf=leaf, window=1), random.Random(leaf)
    alphabets = ["abcdefghijklmnopqrstuvwxyz", "ab", "a", "the", "theéÀ!'s12", "的一是不了人", "İſK"]
    for _ in range(150):
        alphabet = rng.choice(alphabets)
        unit = "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 300)))
        assert made.encode(unit) == word_tokenizer.encode(unit, add_special_tokens=False).ids


def test_leaves():
    text = " ".join(["word"] * 1000) + "x" * 300
    leaves = word_bpe.cut_leaves(text, 100)
    assert "".join(leaves) == text
    assert sum(len(leaf) > 100 for leaf in leaves) <= 1


def test_odd_texts_in_words(documents, word_tokenizer):
    rows = word_bpe.encode_decode(documents(list(enumerate(ODD))), WORDS).collect()
    got = {r.doc_id: r.ids_sha256 for r in rows}
    for key, text in enumerate(ODD):
        ids = word_tokenizer.encode(text, add_special_tokens=False).ids
        assert got[key] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), text


def test_halves_of_one_long_word_are_leaves_of_any_task(spark, documents, word_tokenizer):
    """Words of a million characters, between and inside other text: encoded in parts by
    several tasks, joined to what the library makes of the whole."""
    rng = random.Random(11)
    word = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(1_000_000))
    rows = [
        (1, word),
        (2, "some words, " + word[:300_000] + "123..." + word[300_000:500_000] + " and more"),
        (3, "日本" * 60_000 + "é" * 70_000),
        (4, "x" * 200_000 + "<|endoftext|>" + "y" * 10),
        (5, ("word. " * 30_000) + word[:90_000] + "İ" * 70_000),
    ]
    made = word_bpe.WordBpe(WORDS)
    leaves = list(made.leaves(word))
    assert len(leaves) == 16 and {kind for kind, _, _ in leaves} == {"piece", "last"}
    got = {r.doc_id: tuple(r)[1:] for r in word_bpe.encode_decode(documents(rows), WORDS).collect()}
    for key, text in rows:
        ids = word_tokenizer.encode(text, add_special_tokens=False).ids
        decoded = word_tokenizer.decode(ids, skip_special_tokens=False)
        digests = [hashlib.sha256(t.encode()).hexdigest() for t in (" ".join(map(str, ids)), decoded)]
        assert got[key] == (len(ids), *digests), key
