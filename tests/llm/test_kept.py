"""Tables that operators write meanwhile."""

from __future__ import annotations

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from staymark.llm import near_documents
from staymark.llm.common import Kept
from staymark.session import shuffles_deleted

SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def left_of_shuffles(spark, before):
    """Files that are still there after a while."""
    for _ in range(50):
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.2)
    return left


def shuffle_files(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for d in blocks.localDirsString() for f in Path(d).rglob("shuffle_*")}


@pytest.mark.parametrize("write", [
    lambda kept, df: kept.write(df, "some"),
    lambda kept, df: kept.write_folders(df.withColumn("part", F.col("k") % 3), "some", "part").drop("part"),
    lambda kept, df: kept.write_bucketed(df, "some", "k"),
])
def test_shuffle_files_go_once_a_table_is_written(spark, write):
    df = spark.range(50_000).groupBy((F.col("id") % 10_000).alias("k")).agg(F.count("*").alias("n"))
    before, given = shuffle_files(spark), spark.conf.get(SETTING, None)
    written = write(Kept(spark), df)
    assert not left_of_shuffles(spark, before)
    assert spark.conf.get(SETTING, None) == given
    assert {tuple(r) for r in written.select("k", "n").collect()} == {(k, 5) for k in range(10_000)}


def test_setting_is_put_back_after_a_failure(spark):
    given = spark.conf.get(SETTING, None)
    with pytest.raises(ValueError), shuffles_deleted(spark):
        assert spark.conf.get(SETTING) == "true"
        raise ValueError
    assert spark.conf.get(SETTING, None) == given


def test_pipeline_leaves_no_shuffle_files(spark, documents, tmp_path, monkeypatch):
    documents([(i, f"text {i % 7}") for i in range(500)]).write.parquet(str(tmp_path / "documents.parquet"))

    def once(session, docs, directory):
        return docs.groupBy("text").agg(F.min("doc_id").alias("doc_id"))

    monkeypatch.setattr(corpus_pipeline, "STAGES", [("once", once), ("again", once)])
    before = shuffle_files(spark)
    made = corpus_pipeline.run(spark, str(tmp_path))
    assert not left_of_shuffles(spark, before)
    assert {r.doc_id for r in made.collect()} == set(range(7))


def test_tables_of_near_documents_go_once_components_are_known(documents, monkeypatch):
    made = []

    class Remembered(Kept):
        def __init__(self, spark):
            super().__init__(spark)
            made.append(self)

    monkeypatch.setattr(near_documents, "Kept", Remembered)
    text = " ".join(f"word{i}" for i in range(60))
    found = near_documents.near_documents(documents([(1, text), (2, text + " more"), (3, "something else")]))
    assert [set(kept.paths) for kept in made] == [{"sketches", "items", "components"}]
    assert {r.doc_id: r.component_id for r in found.collect()} == {1: 1, 2: 1, 3: 3}
