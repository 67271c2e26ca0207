"""Token ids of documents in raw binary files, with a perfect-hash index by key.

A folder of token files holds

- ``ids/shard-N.bin``: the ids of successive documents in ascending doc_id order (null
  first), each document ended by the end id, as little-endian unsigned integers of two
  bytes if the vocabulary allows it, else four; nothing else, so a shard can be mapped
  into memory as one array;
- ``index/part-N.bin``: for the keys whose hash belongs to part N, a minimal perfect hash
  and, in its order, one record per key: shard, position there, length, and the ids of all
  documents before it;
- ``places``: a Parquet table with the key and record of every document.

A key is the doc_id as text. Further rows of the same doc_id (and rows without one) have
the key ``doc_id#shard.row``. Files are written under another name and renamed when
complete, so a task that is repeated leaves one whole file.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staymark.llm.byte_bpe import encoder, text_groups
from staymark.llm.common import two_columns
from staymark.llm.perfect_hash import PerfectHash, hash_keys

END_ID = 2
# Keys in one part of the index; there are at least LEAST_PARTS, to spread the work.
KEYS_PER_PART = 1 << 16
LEAST_PARTS = 64
_RECORD = np.dtype([("shard", "<u4"), ("at", "<u8"), ("n", "<u8"), ("start", "<u8")])


def _put(folder: str, name: str, blocks: Iterator[bytes]) -> None:
    """Write a file in the shared folder, whole or not at all."""
    store, root = fs.FileSystem.from_uri(folder)
    path = f"{root}/{name}"
    store.create_dir(path.rpartition("/")[0], recursive=True)
    trial = f"{path}.{uuid.uuid4().hex}"
    with store.open_output_stream(trial) as out:
        for block in blocks:
            out.write(block)
    store.move(trial, path)


def _open(folder: str, name: str) -> pa.NativeFile:
    store, root = fs.FileSystem.from_uri(folder)
    return store.open_input_file(f"{root}/{name}")


def _shard(n: int) -> str:
    return f"ids/shard-{n:08d}.bin"


def _part(n: int) -> str:
    return f"index/part-{n:08d}.bin"


def _write_shards(documents: DataFrame, folder: str, tokenizer: str, end_id: int) -> DataFrame:
    """Write the ids; one row per document with its place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, encode, at, row = TaskContext.get().partitionId(), encoder(tokenizer), 0, 0
        told: list[pa.RecordBatch] = []

        def payload() -> Iterator[bytes]:
            nonlocal at, row
            for batch in batches:
                keys, texts = batch.column(0), batch.column(1).to_pylist()
                lengths = []
                for group in text_groups(texts):
                    for ids in encode([texts[i] or "" for i in group]):
                        lengths.append(len(ids) + 1)
                        yield ids.tobytes() + ids.dtype.type(end_id).tobytes()
                n = np.array(lengths, np.int64)
                columns = [keys, np.full(len(n), shard), row + np.arange(len(n)), at + np.cumsum(n) - n, n]
                told.append(pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names))
                at, row = at + int(n.sum()), row + len(n)

        first = next(batches, None)
        if first is not None:
            batches = chain([first], batches)
            _put(folder, _shard(shard), payload())
            yield from told

    names = ["doc_id", "shard", "row", "at", "n"]
    # The row's place in the input breaks ties, so rows that share an id spread too.
    placed = two_columns(documents).withColumn("tie", F.monotonically_increasing_id())
    ordered = placed.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    schema = ", ".join(f"{name} long" for name in names)
    return ordered.select("doc_id", "text").mapInArrow(run, schema)


def write(documents: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Write ids, index and places of all documents; returns the table of places.

    Columns: doc_id, key, shard, at, n, start. Null and empty texts have the end id alone;
    repeated rows and rows without doc_id are written each; a table without rows writes no
    shard. Other columns of the input are not read.
    """
    spark = documents.sparkSession
    _write_shards(documents, folder, tokenizer, end_id).write.parquet(f"{folder}/written")
    written = spark.read.parquet(f"{folder}/written")
    # One row per shard; the window over them is as long as the list of files.
    shards = written.groupBy("shard").agg(F.sum("n").alias("held"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = shards.select("shard", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("base"))
    firsts = (
        written.where("doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min(F.struct("shard", "row")).alias("first"))
    )
    further = F.concat_ws("#", F.col("doc_id").cast("string"), F.concat_ws(".", "shard", "row"))
    places = (
        written.join(bases, "shard")
        .join(firsts, "doc_id", "left")
        .select(
            "doc_id",
            F.when(F.struct("shard", "row") == F.col("first"), F.col("doc_id").cast("string"))
            .otherwise(F.when(F.col("doc_id").isNull(), F.concat(F.lit("#"), further)).otherwise(further))
            .alias("key"),
            "shard",
            "at",
            "n",
            (F.col("base") + F.col("at")).alias("start"),
        )
    )
    places.write.parquet(f"{folder}/places")
    places = spark.read.parquet(f"{folder}/places")
    _write_index(places, folder)
    return places


def _parts(places: DataFrame) -> int:
    return max(LEAST_PARTS, -(-places.count() // KEYS_PER_PART))


def _part_of(parts: int):
    return F.pmod(F.xxhash64("key"), F.lit(parts)).cast("int").alias("part")


def _write_index(places: DataFrame, folder: str) -> None:
    """One file per part of the keys; a part is bounded, for keys do not repeat."""

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        hashes = hash_keys(frame["key"].tolist())
        index = PerfectHash.of(hashes)
        records = np.zeros(len(frame), _RECORD)
        number = index.find(hashes)
        for name in _RECORD.names:
            records[name][number] = frame[name].to_numpy()
        part = int(frame["part"].iloc[0])
        _put(folder, _part(part), iter([index.to_bytes(), records.tobytes()]))
        return pd.DataFrame({"part": [part], "keys": [len(frame)]})

    parts = _parts(places)
    built = places.select("key", "shard", "at", "n", "start", _part_of(parts)).groupBy("part")
    built.applyInPandas(build, "part int, keys long").write.parquet(f"{folder}/parts")


def find(keys: DataFrame, folder: str, parts: int) -> DataFrame:
    """Look keys up in the index: key, shard, at, n, start of those that it holds."""

    def look(frame: pd.DataFrame) -> pd.DataFrame:
        try:
            with _open(folder, _part(int(frame["part"].iloc[0]))) as file:
                block = file.read()
        except FileNotFoundError:  # no key belongs to this part
            return pd.DataFrame({c: pd.Series(dtype=object) for c in ("key", *_RECORD.names)})
        index, end = PerfectHash.from_bytes(block)
        number = index.find(hash_keys(frame["key"].tolist()))
        records = np.frombuffer(block, _RECORD, offset=end)[number[number >= 0]]
        found = {"key": pd.Series(frame["key"].to_numpy(object)[number >= 0], dtype=object)}
        return pd.DataFrame(found | {c: records[c].astype("int64") for c in _RECORD.names})

    grouped = keys.select("key", _part_of(parts)).groupBy("part")
    return grouped.applyInPandas(look, "key string, shard long, at long, n long, start long")


def read_ids(folder: str, shard: int, at: int, n: int, dtype: str) -> np.ndarray:
    """The ids of one document, read from its place."""
    with _open(folder, _shard(shard)) as file:
        width = np.dtype(dtype).itemsize
        file.seek(at * width)
        return np.frombuffer(file.read(n * width), dtype)


def checksums(found: DataFrame, folder: str, dtype: str) -> DataFrame:
    """Read the ids of looked-up keys from their shards: key, start, n_tokens, ids_crc32."""

    def read(frame: pd.DataFrame) -> pd.DataFrame:
        width = np.dtype(dtype).itemsize
        frame = frame.sort_values("at", ignore_index=True)
        sums = []
        with _open(folder, _shard(int(frame["shard"].iloc[0]))) as file:
            for at, n in zip(frame["at"], frame["n"], strict=True):
                file.seek(at * width)
                ids = np.frombuffer(file.read(n * width), dtype)
                sums.append(zlib.crc32(ids.astype("<u4")))
        return pd.DataFrame(
            {"key": frame["key"].astype(object), "start": frame["start"], "n_tokens": frame["n"], "ids_crc32": sums}
        )

    return found.groupBy("shard").applyInPandas(
        read, "key string, start long, n_tokens long, ids_crc32 long"
    )


def read_all(places: DataFrame, folder: str, dtype: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document: each key is looked up in
    the index and its ids are read from the shard it names."""
    found = find(places.select("key"), folder, _parts(places))
    return checksums(found, folder, dtype).join(places.select("key", "doc_id"), "key").drop("key")
