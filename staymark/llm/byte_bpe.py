"""Ids of whole texts from a byte-level BPE tokenizer file, by distinct units.

The tokenizer first cuts a text by a pattern: runs of letters, of digits and of other
characters, each with a space before it, and white space. So a new piece always begins at
a space or line break between two characters that are not white space, after such a line
break, and at a dot or comma after a letter, and what is left of there does not change
what is right of it. Texts are cut at these places all at once, as bytes; each distinct unit
goes through the tokenizers library once, and the ids are gathered again; the result is
that of encoding the whole text. Texts with white space beyond ASCII are encoded whole.
A file with another pattern or a normalizer is refused.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
import pyarrow as pa

# Distinct units remembered per Python worker, about 150 bytes each; twice as many with those
# remembered before.
REMEMBERED_UNITS = 400_000
# A unit over this many bytes is not remembered.
LONG_UNIT = 200

# White space of the tokenizer's pattern that is not one of the bytes 09 to 0D or 20.
_WIDE_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_AFTER_LATIN = "\u0250"

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True


def _printable() -> dict[int, int]:
    """How byte-level vocabularies write each byte: as itself if it is printable Latin-1,
    else as one of the characters from U+0100 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: b for b in shown} | {b: 0x100 + i for i, b in enumerate(hidden)}


_PRINTABLE = _printable()


def unit_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where units of texts begin, which encode independently; ``offsets`` are those of the
    texts in ``data`` and the end."""
    size = len(data)
    if not size:
        return np.zeros(0, np.int64)
    space = _SPACE[data]
    lonely = space.copy()  # between two characters of the same text that are not white space
    lonely[1:] &= ~space[:-1]
    lonely[:-1] &= ~space[1:]
    firsts = offsets[:-1][np.diff(offsets) > 0]
    lonely[firsts] = False
    lonely[offsets[1:][np.diff(offsets) > 0] - 1] = False
    line_break = lonely & (data == 0x0A)
    starts = lonely & (data == 0x20) | line_break
    starts[1:] |= line_break[:-1]
    starts[1:] |= _LETTER[data[:-1]] & ((data[1:] == 0x2E) | (data[1:] == 0x2C))
    starts[firsts] = True
    return np.flatnonzero(starts)


def _has_wide_space(text: str) -> bool:
    return _WIDE_SPACE.search(text) is not None


def units(text: str) -> list[str]:
    """Parts of ``text`` that encode independently; together they are ``text``."""
    if not text or _has_wide_space(text):
        return [text]
    raw = text.encode()
    starts = unit_starts(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    return [raw[a:b].decode() for a, b in zip(starts, [*starts[1:], len(raw)], strict=True)]


class ByteBpe:
    """Encoder of one tokenizer file; ids come in the smallest type that holds them."""

    def __init__(self, path: str, remembered: int = REMEMBERED_UNITS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            declared = json.load(file)
        cut = declared["pre_tokenizer"] or {}
        known = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
        if not known or declared["normalizer"] is not None:
            raise ValueError(f"{path} does not cut texts by the byte-level pattern alone")
        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        self._model = self._tokenizer.model
        self._dtype = np.dtype(id_type(self._tokenizer.get_vocab_size()))
        self._known: dict[bytes, bytes] = {}
        self._before: dict[bytes, bytes] = {}
        self._remembered = remembered

    def _encoded(self, units: list[bytes]) -> list[bytes]:
        """Ids of units. Letters alone are one piece of the pattern, so the model gets
        them as they are, its bytes in the printable form of the vocabulary."""
        found: list = [None] * len(units)
        others = []
        for i, unit in enumerate(units):
            text = unit.decode()
            word = text[1:] if text[0] == " " else text
            if word.isalpha() and max(word) < _AFTER_LATIN:
                found[i] = [token.id for token in self._model.tokenize(unit.decode("latin-1").translate(_PRINTABLE))]
            else:
                others.append((i, text))
        encoded = self._tokenizer.encode_batch_fast([text for _, text in others], add_special_tokens=False)
        for (i, _), one in zip(others, encoded, strict=True):
            found[i] = one.ids
        return [np.fromiter(ids, self._dtype, len(ids)).tobytes() for ids in found]

    def _units(self, units: list[bytes]) -> list[bytes]:
        """Ids of distinct units, from memory where they are in it."""
        # Units used lately stay when others are forgotten.
        if len(self._known) > self._remembered:
            self._known, self._before = {}, self._known
        known, before = self._known, self._before
        fresh = [unit for unit in units if unit not in known]
        new = [unit for unit in fresh if unit not in before]
        made = dict(zip(new, self._encoded(new), strict=True))
        for unit in fresh:
            known[unit] = made[unit] if unit in made else before[unit]
        found = [known[unit] for unit in units]
        for unit in fresh:
            if len(unit) > LONG_UNIT:
                del known[unit]
        return found

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        wide = {i for i, text in enumerate(texts) if _has_wide_space(text)}
        raw = [b"" if i in wide else text.encode() for i, text in enumerate(texts)]
        data = np.frombuffer(b"".join(raw), np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw], dtype=np.int64)])
        starts = unit_starts(data, offsets)
        # The units are the text itself, so Arrow finds the distinct ones where they are.
        ends = np.append(starts, len(data))
        cut = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(data)]
        ).dictionary_encode()
        which = cut.indices.to_numpy()
        ids = self._units(cut.dictionary.to_pylist())
        sizes = np.array([len(i) for i in ids], np.int64) // self._dtype.itemsize
        flat = np.frombuffer(b"".join(ids), self._dtype)
        places = np.cumsum(sizes) - sizes
        counts = sizes[which]
        until = np.concatenate([[0], np.cumsum(counts)])
        # From where each id comes: the place of its unit, and how far it is into it.
        every = np.repeat(places[which] - until[:-1], counts) + np.arange(until[-1])
        gathered = flat[every]
        bounds = until[np.searchsorted(starts, offsets)]
        made = [gathered[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        for i in wide:
            found = self._tokenizer.encode(texts[i], add_special_tokens=False).ids
            made[i] = np.array(found, self._dtype)
        return made


def id_type(vocabulary: int) -> str:
    """Smallest unsigned little-endian type for the ids of a vocabulary."""
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


_encoders: dict[str, ByteBpe] = {}


def encoder(path: str) -> ByteBpe:
    """This worker's encoder for a file: workers are reused, so its memory pays off."""
    if path not in _encoders:
        _encoders[path] = ByteBpe(path)
    return _encoders[path]


def text_groups(texts: list[str | None], limit: int = 2 << 20):
    """Indexes of successive texts, about ``limit`` characters at a time; null is empty."""
    group, size = [], 0
    for i, text in enumerate(texts):
        group.append(i)
        size += len(text or "")
        if size >= limit:
            yield group
            group, size = [], 0
    if group:
        yield group
