"""Language identification by compression.

Per language, whole sample texts are dealt into a few raw-content zstandard dictionaries. A
text is compressed with each; the language whose dictionaries leave the fewest bytes is
the answer. Where the runner-up needs hardly more, the answer is marked as rejected.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staymark.llm.common import two_columns

UNKNOWN = "und"
# Bounds of what is learned: texts per language, bytes of one text, bytes of all languages
# together, and, per language, dictionaries and bytes of one dictionary. Of a longer
# text a passage of PASSAGE characters may be learned from.
SAMPLE_TEXTS = 400
SAMPLE_BYTES = 20_000
SAMPLE_TOTAL = 64 << 20
PASSAGE = SAMPLE_BYTES // 4
DICTIONARIES = 2
DICTIONARY_BYTES = 128 * 1024
LEVEL = 3
# A text is rejected if the runner-up needs less than this share more bytes.
MARGIN = 0.002
# Texts longer than this are compressed as parts; the sizes add up.
PART_BYTES = 96 * 1024

_LETTER = re.compile(r"[^\W\d_]")
_OTHER = re.compile(r"[\W\d_]+")

Model = dict[str, list[bytes]]


def learn(documents: DataFrame) -> Model:
    """Dictionaries from rows with text and lang: a bounded sample of each language.

    The sample are the texts with the smallest hashes, so it does not depend on order or
    partitions, and copies of a text count once. Texts of up to SAMPLE_BYTES come first; where
    a language has too few of them, passages of longer ones follow, from a place that the hash
    draws. The texts read by the driver are bounded by SAMPLE_TEXTS for each language
    and SAMPLE_TOTAL for all.
    """
    spare = F.char_length("text") - PASSAGE + 1
    place = F.pmod("h", F.greatest(spare, F.lit(1))).cast("int") + 1
    known = (
        documents.select("text", "lang", F.xxhash64("text").alias("h"))
        .where(F.col("lang").isNotNull() & (F.octet_length("text") > 0))
        .withColumn("long", F.octet_length("text") > SAMPLE_BYTES)
        .withColumn("text", F.when(F.col("long"), F.substring("text", place, F.lit(PASSAGE))).otherwise(F.col("text")))
    )
    counted = known.groupBy("lang", "long").agg(F.approx_count_distinct("h").alias("n")).collect()
    if not counted:
        return {}
    languages = sorted({r["lang"] for r in counted})
    most = max(1, min(SAMPLE_TEXTS, SAMPLE_TOTAL // (2 * SAMPLE_BYTES * len(languages))))
    short = {r["lang"]: r["n"] for r in counted if not r["long"]}
    # Twice as many hashes as wanted lie below the limit, whatever the size of a language.
    limits = {
        f"{'true' if r['long'] else 'false'} {r['lang']}": -(1 << 63)
        if r["long"] and short.get(r["lang"], 0) >= 2 * most
        else (1 << 63) - 1
        if r["n"] <= 2 * most
        else int((2.0 * most / r["n"] * 2 - 1) * (1 << 63))
        for r in counted
    }
    limit = F.create_map(*[F.lit(x) for name in sorted(limits) for x in (name, limits[name])])
    name = F.concat_ws(" ", F.col("long").cast("string"), "lang")
    drawn = known.where(F.col("h") <= limit[name])
    rows = drawn.groupBy("lang", "long", "h").agg(F.min("text").alias("text")).collect()
    texts: dict[str, list[tuple[bool, int, str]]] = {lang: [] for lang in languages}
    for row in rows:
        texts[row["lang"]].append((row["long"], row["h"], row["text"]))
    return {lang: dictionaries(t for _, _, t in sorted(texts[lang])[:most]) for lang in languages}


def dictionaries(texts: Iterator[str]) -> list[bytes]:
    """Whole texts dealt to dictionaries in turn, each filled up to its bound."""
    filled = [b""] * DICTIONARIES
    for i, text in enumerate(texts):
        raw, k = plain(text).encode(errors="replace") + b"\n", i % DICTIONARIES
        if len(filled[k]) + len(raw) <= DICTIONARY_BYTES:
            filled[k] += raw
    return [d for d in filled if d]


def plain(text: str) -> str:
    """The letters of a text in lower case, with a space for each run of others."""
    return _OTHER.sub(" ", text.lower())


def has_letter(text: str) -> bool:
    """Whether any character is a letter; numbers that are words' characters are none."""
    return any(found[0].isalpha() for found in _LETTER.finditer(text))


class Identifier:
    """Language of texts, by the dictionaries of a model."""

    def __init__(self, model: Model):
        self.languages = sorted(model)
        self._compressors = [[self._compressor(d) for d in model[lang]] for lang in self.languages]

    @staticmethod
    def _compressor(content: bytes) -> zstandard.ZstdCompressor:
        dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        dictionary.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(
            dict_data=dictionary, write_checksum=False, write_content_size=False, write_dict_id=False
        )

    def sizes(self, text: str) -> np.ndarray:
        """Mean compressed bytes per language."""
        raw = plain(text).encode(errors="replace")
        parts = [raw[i : i + PART_BYTES] for i in range(0, len(raw), PART_BYTES)]
        return np.array(
            [
                sum(len(c.compress(part)) for c in compressors for part in parts) / len(compressors)
                for compressors in self._compressors
            ]
        )

    def __call__(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score from 0 to 1, rejected)."""
        if not text or not self.languages or not has_letter(text):
            return UNKNOWN, 0.0, True
        sizes = self.sizes(text)
        order = np.argsort(sizes, kind="stable")
        best = sizes[order[0]]
        # Bytes are log likelihoods; the score is what share they give the best.
        score = 1 / sum(math.exp(min(0.0, best - size)) for size in sizes)
        narrow = len(order) > 1 and sizes[order[1]] - best < MARGIN * best
        return self.languages[order[0]], float(score), bool(narrow)


# A worker outlives many jobs; it keeps the compressors of the last one alone.
@lru_cache(maxsize=1)
def _identifier(key: tuple) -> Identifier:
    return Identifier({lang: list(contents) for lang, contents in key})


def identify(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score and rejected of every whole text.

    A null, empty or letterless text is ``und`` with score 0, and rejected; so is every
    text if the model is empty. Repeated rows and rows without doc_id have a row each.
    Columns of the input other than doc_id and text are not read.
    """
    # Size bounded by the sample: languages x DICTIONARIES x DICTIONARY_BYTES.
    shared = documents.sparkSession.sparkContext.broadcast(
        tuple((lang, tuple(contents)) for lang, contents in sorted(model.items()))
    )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        classify = _identifier(shared.value)
        for frame in frames:
            texts = frame["text"].where(frame["text"].notna(), None)
            made = pd.DataFrame([classify(t) for t in texts], columns=["lang_pred", "score", "rejected"])
            made.insert(0, "doc_id", frame["doc_id"].astype("Int64").to_numpy())
            yield made

    return two_columns(documents).mapInPandas(
        run, "doc_id long, lang_pred string, score double, rejected boolean"
    )


def identified(documents: DataFrame, model: Model) -> DataFrame:
    """The rows of ``documents`` whose text is not rejected, with all their columns."""
    shared = documents.sparkSession.sparkContext.broadcast(
        tuple((lang, tuple(contents)) for lang, contents in sorted(model.items()))
    )
    spot = documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classify = _identifier(shared.value)
        for batch in batches:
            rejected = (classify(text.as_py())[2] for text in batch.column(spot))
            yield batch.filter(pa.array([not r for r in rejected], pa.bool_()))

    return documents.mapInArrow(run, documents.schema)


def held_out():
    """Whether a document is kept from learning, by its doc_id alone."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
