"""Quality by the likelihood ratio of two multinomials over hashed n-grams.

One multinomial is that of trusted texts, the other that of the whole corpus. A text's
score is the mean, over its n-grams, of the log of their ratio, so that length does not
matter. Every text is judged against one threshold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staymark.llm.common import two_columns
from staymark.llm.texts import Chunk, chunks, mix, windows
from staymark.operators.sizing import BROADCAST_BYTES, fits_broadcast
from staymark.sinks.locations import staged

# Bytes of an n-gram; hash buckets; weight added to each bucket of either multinomial.
GRAM = 3
BUCKETS = 1 << 16
SMOOTHING = 1.0
# Scores are compared with thresholds of this grid.
GRID = 0.005
# How much a lost trusted text weighs against a kept text that is toxic or of low quality.
TRUST = 20
LEAST_WORDS = 20
REPEATED_WINDOW = 8
SYMBOLS = b"#*$%&|<>"  # fixed value

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True


def grams(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each n-gram of each text of a chunk, and where each text's begin.

    A text shorter than an n-gram has none.
    """
    data = chunk.data.astype(np.uint64)
    count = max(0, len(data) - GRAM + 1)
    packed = np.zeros(count, np.uint64)
    for i in range(GRAM):
        packed = (packed << np.uint64(8)) | data[i : i + count]
    buckets = (mix(packed) % np.uint64(BUCKETS)).astype(np.int64)
    whole = np.ones(count, bool)
    for cut in chunk.offsets[1:-1]:
        whole[max(0, cut - GRAM + 1) : cut] = False
    before = np.concatenate([[0], np.cumsum(whole)])
    return buckets[whole], before[np.minimum(chunk.offsets, count)]


def counts(texts: DataFrame, column: str) -> DataFrame:
    """bucket and how many n-grams of all texts fall into it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        total = np.zeros(BUCKETS, np.int64)
        for frame in batches:
            for chunk in chunks(pa.array(frame["text"], pa.string(), from_pandas=True)):
                total += np.bincount(grams(chunk)[0], minlength=BUCKETS)
        found = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": found, column: total[found]})

    part = texts.select("text").mapInPandas(run, f"bucket long, {column} long")
    return part.groupBy("bucket").agg(F.sum(column).alias(column))


@dataclass
class Model:
    """Log ratio of trusted to corpus probability per bucket, and the least score kept."""

    ratios: np.ndarray
    threshold: float


def _ratios(trusted: np.ndarray, corpus: np.ndarray) -> np.ndarray:
    def logs(n: np.ndarray) -> np.ndarray:
        return np.log(n + SMOOTHING) - np.log(n.sum() + SMOOTHING * BUCKETS)

    return logs(trusted) - logs(corpus)


def trust(labels: DataFrame) -> DataFrame:
    """doc_id and trusted (neither of low quality nor toxic) of every labelled document.
    A document with both labels counts as of low quality.
    """
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
    toxic = F.coalesce(F.col("toxic"), F.lit(0)) != 0 if "toxic" in labels.columns else F.lit(False)
    return known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        ((F.min("quality") == 1) & ~F.bool_or(toxic)).alias("trusted"),
    )


def fit(documents: DataFrame, labels: DataFrame, *, broadcast_bytes: int = BROADCAST_BYTES) -> Model:
    """Multinomials over all documents and over the labelled trusted ones, and the
    threshold on the grid with the least weighted errors on the labelled ones (in the
    middle, if several have).

    Every label counts. Where they are measured to fit, they are broadcast; else texts and
    labels are shuffled to meet, once, and the labelled texts are written.
    """
    texts, known = two_columns(documents), trust(labels)
    if fits_broadcast(known, broadcast_bytes):
        return _fitted(texts, texts.join(F.broadcast(known), "doc_id"))
    with staged(texts.join(known.hint("shuffle_hash"), "doc_id"), "labelled") as labelled:
        return _fitted(texts, labelled)


def _fitted(texts: DataFrame, labelled: DataFrame) -> Model:
    both = {"corpus": texts, "trusted": labelled.where("trusted")}
    found = {}
    for name, frame in both.items():
        found[name] = np.zeros(BUCKETS)
        for row in counts(frame, name).collect():  # at most BUCKETS rows
            found[name][row["bucket"]] = row[name]
    model = Model(_ratios(found["trusted"], found["corpus"]), -np.inf)
    if not found["trusted"].any():
        return model  # nothing is trusted: nothing to compare with
    judged = judge(labelled.select("doc_id", "text", "trusted"), model, "trusted")
    binned = judged.where("NOT base_failed").groupBy(F.round(F.col("score") / GRID).alias("bin"))
    # Scores are bounded by the log ratios, so the bins are as well.
    rows = binned.agg(
        F.count_if("trusted").alias("good"), F.count_if(~F.col("trusted")).alias("bad")
    ).collect()
    if not any(r["bad"] for r in rows):
        return model
    bins = np.array(sorted((int(r["bin"]), r["good"], r["bad"]) for r in rows), np.int64)
    at, lowest = bins[:, 0], int(bins[0, 0])
    # By the first bin kept, up to none: the good ones below it, the bad ones from it on.
    first = np.searchsorted(at, np.arange(lowest, at[-1] + 2))
    good, bad = np.cumsum(np.vstack([[0, 0], bins[:, 1:]]), axis=0).T
    errors = (TRUST * good[first] + bad[-1] - bad[first]).tolist()
    least = min(errors)
    best = [lowest + i for i, e in enumerate(errors) if e == least]
    run = [b for i, b in enumerate(best) if b - best[0] == i]  # first stretch of them
    model.threshold = (run[len(run) // 2] - 0.5) * GRID
    return model


def _base(chunk: Chunk) -> pd.DataFrame:
    """The counts per text that the base rules use."""
    n, data = chunk.n, chunk.data
    words, lines, hashes = chunk.words(), chunk.lines(), chunk.hashes()
    bounds = words.bounds(n)

    def total(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return sums[ends] - sums[starts]

    code_points = total((data & 0xC0) != 0x80, words.starts, words.ends)
    starts, ends = chunk.offsets[:-1], chunk.offsets[1:]
    # Lines with a word, by hash and length.
    word_at = np.zeros(len(data), bool)
    word_at[words.starts] = True
    filled = total(word_at, lines.starts, lines.ends) > 0
    line_hash = hashes.of(lines.starts, lines.ends) + (lines.ends - lines.starts).astype(np.uint64)
    word_hash = hashes.of(words.starts, words.ends)
    duplicate_lines, repeated = np.zeros(n, np.int64), np.zeros(n, np.int64)
    line_bounds = lines.bounds(n)
    for i in range(n):
        own = slice(line_bounds[i], line_bounds[i + 1])
        mine = line_hash[own][filled[own]]
        duplicate_lines[i] = len(mine) - len(np.unique(mine))
        mine = word_hash[bounds[i] : bounds[i + 1]]
        if len(mine) > REPEATED_WINDOW:
            _, back, often = np.unique(
                windows(mine, REPEATED_WINDOW), return_inverse=True, return_counts=True
            )
            twice = np.flatnonzero(often[back] > 1)
            change = np.zeros(len(mine) + 1, np.int64)
            np.add.at(change, twice, 1)
            np.add.at(change, twice + REPEATED_WINDOW, -1)
            repeated[i] = np.count_nonzero(np.cumsum(change[:-1]))
    return pd.DataFrame(
        {
            "n_words": np.diff(bounds),
            "word_chars": np.bincount(words.text, code_points, n).astype(np.int64),
            "n_symbols": total(_SYMBOL[data], starts, ends),
            "n_dup_lines": duplicate_lines,
            "n_repeat_words": repeated,
        }
    )


def judge(documents: DataFrame, model: Model, *more: str) -> DataFrame:
    """Counts, base rules, score and verdict of every whole text.

    Columns: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, score, kept (and those named in ``more``). A null text counts as empty,
    has score 0 and fails the base rules. Repeated rows and rows without doc_id have a row
    each. Other columns of the input are not read.
    """
    shared = documents.sparkSession.sparkContext.broadcast((model.ratios, model.threshold))
    source = two_columns(documents, *more)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ratios, threshold = shared.value
        for frame in frames:
            made = []
            for chunk in chunks(pa.array(frame["text"], pa.string(), from_pandas=True)):
                buckets, bounds = grams(chunk)
                base = _base(chunk)
                # Each text by itself, so its score does not depend on its neighbours.
                base["score"] = [
                    float(np.sum(ratios[buckets[a:b]]) / (b - a)) if b > a else 0.0
                    for a, b in zip(bounds[:-1], bounds[1:], strict=True)
                ]
                made.append(base)
            out = pd.concat(made, ignore_index=True)
            out["base_failed"] = (out["n_words"] < LEAST_WORDS) | (
                100 * out["n_repeat_words"] > 30 * out["n_words"]
            )
            out["kept"] = ~out["base_failed"] & (out["score"] >= threshold)
            for name in ("doc_id", *more):
                out[name] = frame[name].to_numpy()
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    kinds = dict(source.dtypes)
    schema = (
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
        "n_repeat_words long, base_failed boolean, score double, kept boolean"
    )
    return source.mapInPandas(run, ", ".join([schema, *[f"{c} {kinds[c]}" for c in more]]))
