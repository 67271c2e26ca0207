"""Encoding and decoding with a word-level BPE file, by tree concatenation.

The tokenizer drops white space and never looks across it. So a text is cut at white
space, and each distinct unit goes through the tokenizers library. A long text is cut in
halves, and these again, down to leaves that tasks encode in parallel; the leaves' ids are
then put together in order.

A unit without white space can be longer than a leaf. It is normalised and cut into words
as the tokenizer does; a word over the leaf's size is cut in halves of halves anywhere, which
are leaves for any task as well. Encoded halves A and B are joined by encoding a window of the last ids of A and the first of B
again, and a larger one until its first id is that of A at its place and its last id that
of B. Then every two neighbours in the joined ids are neighbours in some whole encoding.
BPE merges by rank, and what crosses a border between two ids first would also cross it
where only these two are encoded, so ids whose neighbours all agree are those of the
whole word.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staymark.llm.byte_bpe import text_groups
from staymark.llm.common import Kept, two_columns

# Characters of a leaf. Longer texts are cut over tasks, longer words in halves.
LEAF = 65_536
# Ids on each side of a join in its first window.
WINDOW = 4
# Distinct units remembered per Python worker; as many again of those remembered before.
REMEMBERED_UNITS = 300_000
LONG_UNIT = 200

_SPACE = re.compile(r"[ \t\n\v\f\r]+")
_SPACES = np.zeros(256, bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True
_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True


def cut_leaves(text: str, leaf: int) -> list[str]:
    """``text`` in halves of halves, cut at white space near the middle where there is some.

    A part longer than a leaf remains only where there is no white space in its middle half.
    """
    if len(text) <= leaf:
        return [text]
    middle = len(text) // 2
    at = _SPACE.search(text, middle, middle + len(text) // 4)
    if at is None:
        before = list(_SPACE.finditer(text, len(text) // 4, middle))
        at = before[-1] if before else None
    if at is None:
        return [text]
    return [*cut_leaves(text[: at.start()], leaf), *cut_leaves(text[at.start() :], leaf)]


def halves(word: str, leaf: int) -> list[tuple[str, bool]]:
    """``word`` in halves of halves of at most ``leaf`` characters, and which ends it."""

    def cut(text: str) -> list[str]:
        if len(text) <= leaf:
            return [text]
        return [*cut(text[: len(text) // 2]), *cut(text[len(text) // 2 :])]

    pieces = cut(word)
    return [(piece, i == len(pieces) - 1) for i, piece in enumerate(pieces)]


class WordBpe:
    """Encoder and decoder of one tokenizer file."""

    def __init__(self, path: str, leaf: int = LEAF, window: int = WINDOW):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._whole = Tokenizer.from_file(path)
        self._whole.no_truncation()
        self._whole.no_padding()
        # For parts of a word: no cutting, and the end mark only on its last part.
        spec = json.loads(self._whole.to_str())
        self._end = spec["model"].get("end_of_word_suffix") or ""
        self._special = re.compile(
            "|".join(re.escape(t["content"]) for t in spec["added_tokens"]) or r"(?!)"
        )
        spec |= {"normalizer": None, "pre_tokenizer": None, "added_tokens": [], "post_processor": None}
        self._last = Tokenizer.from_str(json.dumps(spec))
        spec["model"]["end_of_word_suffix"] = None
        self._inner = Tokenizer.from_str(json.dumps(spec))
        self._leaf, self._window = leaf, window
        self._known: dict[str, tuple[int, str, str]] = {}
        self._before: dict[str, tuple[int, str, str]] = {}

    def encode(self, unit: str) -> list[int]:
        """Ids of a text without white space to cut it at."""
        if len(unit) <= self._leaf or self._special.search(unit):
            return self._whole.encode(unit, add_special_tokens=False).ids
        normal = self._whole.normalizer.normalize_str(unit) if self._whole.normalizer else unit
        ids: list[int] = []
        for word, _ in self._whole.pre_tokenizer.pre_tokenize_str(normal):
            ids += [i for i, _ in self._tree(word, True)]
        return ids

    def _part(self, word: str, last: bool) -> list[tuple[int, int]]:
        """(id, length in symbols) of a part of a word; ``last``: it ends the word."""
        encoding = (self._last if last else self._inner).encode(word, add_special_tokens=False)
        lengths = [len(t) for t in encoding.tokens]
        if last and self._end:
            lengths[-1] -= len(self._end)
        return list(zip(encoding.ids, lengths, strict=True))

    def _tree(self, word: str, last: bool) -> list[tuple[int, int]]:
        pieces = [self._part(p, last and i) for p, i in halves(word, self._leaf)]
        return self.merged([p for p, _ in halves(word, self._leaf)], pieces, last)

    def merged(
        self, texts: list[str], pieces: list[list[tuple[int, int]]], last: bool
    ) -> list[tuple[int, int]]:
        """Ids of a word from those of its parts, joined in pairs, and these again."""
        if len(pieces) == 1:
            return pieces[0]
        half = len(pieces) // 2
        left = self.merged(texts[:half], pieces[:half], False)
        right = self.merged(texts[half:], pieces[half:], last)
        return self.join("".join(texts), sum(map(len, texts[:half])), left, right, last)

    def leaves(self, text: str) -> Iterator[tuple[str, int, str]]:
        """kind, number of the word and content of the leaves of a long text: ``text`` that
        can be encoded by itself, normalised ``words`` with spaces between, and ``piece``
        or ``last`` piece of a word."""
        number = 0
        for part in cut_leaves(text, self._leaf):
            if len(part) <= self._leaf:
                yield "text", 0, part
                continue
            for unit in filter(None, _SPACE.split(part)):
                if len(unit) <= self._leaf or self._special.search(unit):
                    yield "text", 0, unit
                    continue
                normal = self._whole.normalizer.normalize_str(unit) if self._whole.normalizer else unit
                held: list[str] = []
                for word, _ in self._whole.pre_tokenizer.pre_tokenize_str(normal):
                    if held and sum(map(len, held)) + len(word) > self._leaf:
                        yield "words", 0, " ".join(held)
                        held = []
                    if len(word) <= self._leaf:
                        held.append(word)
                        continue
                    number += 1
                    for piece, last in halves(word, self._leaf):
                        yield "last" if last else "piece", number, piece
                if held:
                    yield "words", 0, " ".join(held)

    def leaf(self, kind: str, content: str) -> list[tuple[int, int]]:
        """(id, length in symbols) of a leaf of normalised words."""
        if kind == "words":
            return [x for word in content.split(" ") for x in self._part(word, True)]
        return self._part(content, kind == "last")

    def decoded(self, ids: list[int]) -> str:
        return self._whole.decode(ids, skip_special_tokens=False)

    def join(
        self,
        word: str,
        middle: int,
        left: list[tuple[int, int]],
        right: list[tuple[int, int]],
        last: bool,
    ) -> list[tuple[int, int]]:
        """Ids of ``word`` from those of its part before ``middle`` and of the rest."""
        size = self._window
        while True:
            a, b = min(size, len(left)), min(size, len(right))
            start = middle - sum(n for _, n in left[len(left) - a :])
            end = middle + sum(n for _, n in right[:b])
            window = self._part(word[start:end], last and b == len(right))
            agree_left = a == len(left) or window[0] == left[-a]
            agree_right = b == len(right) or window[-1] == right[b - 1]
            if agree_left and agree_right:
                return [*left[: len(left) - a], *window, *right[b:]]
            size *= 2

    def _units(self, units: list[str]) -> list[tuple[int, str, str]]:
        """Of distinct units: the number of ids, the ids in decimal, and their decoding."""
        # Units used lately stay when others are forgotten.
        if len(self._known) > REMEMBERED_UNITS:
            self._known, self._before = {}, self._known
        known, before = self._known, self._before
        fresh = [unit for unit in units if unit not in known]
        new = [unit for unit in fresh if unit not in before]
        short = [unit for unit in new if len(unit) <= self._leaf]
        long = [unit for unit in new if len(unit) > self._leaf]
        encoded = [e.ids for e in self._whole.encode_batch_fast(short, add_special_tokens=False)]
        encoded += [self.encode(unit) for unit in long]
        decoded = self._whole.decode_batch(encoded, skip_special_tokens=False)
        for unit, ids, text in zip(short + long, encoded, decoded, strict=True):
            known[unit] = (len(ids), " ".join(map(str, ids)), text)
        for unit in fresh:
            if unit not in known:
                known[unit] = before[unit]
        found = [known[unit] for unit in units]
        for unit in fresh:
            if len(unit) > LONG_UNIT:
                del known[unit]
        return found

    def __call__(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """Of each text: the number of ids, the ids in decimal, and their decoding."""
        raw = [text.encode() for text in texts]
        data = np.frombuffer(b"".join(raw), np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw], dtype=np.int64)])
        starts, compact, ends = _cut_units(data, offsets)
        cut = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(compact)]
        ).dictionary_encode()
        found = self._units([unit.decode() for unit in cut.dictionary.to_pylist()])
        which = cut.indices.to_numpy()
        numbers = np.array([n for n, _, _ in found], np.int64)
        bounds = np.searchsorted(starts, offsets)
        if (numbers == 0).any():  # units that are normalised away
            some = numbers[which] > 0
            bounds = np.concatenate([[0], np.cumsum(some)])[bounds]
            which = which[some]
        ids, decoded = (np.array([f[i] for f in found], object)[which].tolist() for i in (1, 2))
        until = np.concatenate([[0], np.cumsum(numbers[which])])[bounds]
        return [
            (int(until[i + 1] - until[i]), " ".join(ids[a:b]), " ".join(decoded[a:b]))
            for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True))
        ]


def _cut_units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where units of texts begin, their bytes in a row, and where each ends there.

    A unit ends at ASCII white space, and between an ASCII letter and a dot or comma, where the
    tokenizer's pattern always cuts.
    """
    inside = ~_SPACES[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | (_LETTERS[data[:-1]] & ((data[1:] == 0x2E) | (data[1:] == 0x2C)))
    firsts = offsets[:-1][np.diff(offsets) > 0]
    starts[firsts] = inside[firsts]
    places = np.concatenate([[0], np.cumsum(inside)])
    at = np.flatnonzero(starts)
    return at, data[inside], np.append(places[at], places[-1])


_encoders: dict[tuple[str, int], WordBpe] = {}


def encoder(path: str, leaf: int) -> WordBpe:
    if (path, leaf) not in _encoders:
        _encoders[path, leaf] = WordBpe(path, leaf)
    return _encoders[path, leaf]


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def encode_decode(documents: DataFrame, tokenizer: str, leaf: int = LEAF) -> DataFrame:
    """Encode every whole text, decode the ids, and return digests of both.

    One row per input row: doc_id, n_tokens, ids_sha256 (of the decimal ids joined by
    spaces), decoded_sha256. Null and empty texts have no ids; repeated rows and rows
    without doc_id have a row each. Other columns of the input are not read.
    """
    kept = Kept(documents.sparkSession)
    done_schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    first_schema = done_schema + ", row long, leaf int, kind string, word int, part string"

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        """Encode texts of one leaf; hand on the leaves of the others."""
        encode, row = encoder(tokenizer, leaf), TaskContext.get().partitionId() << 40
        names = [c.split()[0] for c in first_schema.split(", ")]
        for frame in batches:
            keys, texts = frame["doc_id"], [t or "" for t in frame["text"].where(frame["text"].notna(), "")]
            for group in text_groups(texts):
                short = [i for i in group if len(texts[i]) <= leaf]
                rows = []
                for i, (n, ids, text) in zip(short, encode([texts[i] for i in short]), strict=True):
                    rows.append((keys[i], n, _digest(ids), _digest(text), None, None, None, None, None))
                for i in group:
                    if len(texts[i]) > leaf:
                        parts = enumerate(encode.leaves(texts[i]))
                        rows += [(keys[i], None, None, None, row, k, *part) for k, part in parts]
                        row += 1
                made = pd.DataFrame(rows, columns=names)
                yield made.astype(dict.fromkeys(("doc_id", "n_tokens", "row", "leaf", "word"), "Int64"))

    def leaves(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Encode leaves: ids and lengths as numbers joined by spaces. Pieces keep their
        text, which joining them needs."""
        encode = encoder(tokenizer, leaf)
        for frame in frames:
            whole_texts = frame["kind"] == "text"
            told = iter(encode(frame["part"][whole_texts].tolist()))
            out = []
            for kind, part in zip(frame["kind"], frame["part"], strict=True):
                if kind == "text":
                    out.append((next(told)[1], "", ""))
                else:
                    both = encode.leaf(kind, part)
                    sizes = " ".join(str(n) for _, n in both) if kind != "words" else ""
                    out.append((" ".join(str(i) for i, _ in both), sizes, "" if kind == "words" else part))
            made = frame[["doc_id", "row", "leaf", "kind", "word"]].copy()
            for i, name in enumerate(("ids", "sizes", "part")):
                made[name] = [o[i] for o in out]
            yield made

    def whole(frame: pd.DataFrame) -> pd.DataFrame:
        """One document: its leaves in order. No larger than the document's own row."""
        encode, ids, held = encoder(tokenizer, leaf), [], []
        for row in frame.sort_values("leaf").itertuples():
            numbers = [int(i) for i in row.ids.split(" ") if i]
            if row.kind in ("piece", "last"):
                held.append((row.part, list(zip(numbers, map(int, row.sizes.split(" ")), strict=True))))
                if row.kind == "last":
                    ids += [i for i, _ in encode.merged([p for p, _ in held], [x for _, x in held], True)]
                    held = []
            else:
                ids += numbers
        return pd.DataFrame(
            {
                "doc_id": frame["doc_id"].iloc[:1].astype("Int64"),
                "n_tokens": [len(ids)],
                "ids_sha256": [_digest(" ".join(map(str, ids)))],
                "decoded_sha256": [_digest(encode.decoded(ids))],
            }
        )

    once = kept.write(two_columns(documents).mapInPandas(first, first_schema), "first")
    # Leaves are dealt out evenly, whatever document they are of.
    apart = once.where("part IS NOT NULL").select("doc_id", "row", "leaf", "kind", "word", "part")
    apart = apart.repartition("row", "leaf")
    encoded = apart.mapInPandas(
        leaves, "doc_id long, row long, leaf int, kind string, word int, ids string, sizes string, part string"
    )
    joined = encoded.groupBy("row").applyInPandas(whole, done_schema)
    return once.where("part IS NULL").select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").unionByName(joined)
