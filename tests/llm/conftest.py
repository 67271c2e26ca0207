from __future__ import annotations

import pytest
from pyspark.sql import functions as F

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use for columns of their own.
CLASHING = (
    "text_hash key item size component label n length leaf spans drops carried own probes number "
    "piece start sequence_id offset slice place row part ids held base hub digest sketch a b"
).split()


@pytest.fixture(scope="session")
def documents(spark):
    """A table of documents from (doc_id, text) or full rows, with clashing extra columns."""

    def build(rows, partitions=3, extra=False):
        full = [tuple(r) + ("en", "s", None)[len(r) - 2 :] if len(r) < 5 else tuple(r) for r in rows]
        df = spark.createDataFrame(full, DOCUMENTS)
        df = df.repartition(partitions) if rows else df
        for name in CLASHING if extra else ():
            df = df.withColumn(name, F.lit(-1))
        return df

    return build


LONG = "many words in one very long text that goes on and on " * 4000
AWKWARD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "one line of words that is a little longer than the rest\nand another"),
    (4, "one line of words that is a little longer than the rest\nand another"),
    (None, "a row without a key has words as well, and they are these"),
    (None, None),
    (5, LONG),
    (6, "x" * 70_000),
    (7, "日本語の文章。" * 9_000),
    (8, "token = 'abcdefghijklmnop1234' and é"),
    (9, "one line of words that is a little longer than the rest\nand another"),
]
