"""Rows keep their identity when the executors, and with them the file splits, change."""

from __future__ import annotations

import os
import sys
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from shoplens.llm import common, exact_dedup, sentencepiece_scan, simhash  # noqa: E402

SF001 = "/root/testdata/sf0.001"
BEFORE = {"spark.sql.leafNodeDefaultParallelism": "2", "spark.sql.files.openCostInBytes": "64k"}
AFTER = {"spark.sql.leafNodeDefaultParallelism": "60", "spark.sql.files.openCostInBytes": "1k"}


@contextmanager
def _conf(spark, values):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    """Several files of unequal sizes, rows repeated, a column of the name the operators use inside."""
    path = str(tmp_path_factory.mktemp("identity"))
    d = spark.read.parquet(f"{SF001}/documents.parquet")
    d = d.unionByName(d.filter("doc_id % 3 = 0")).withColumn("_row_uid", F.concat(F.lit("user "), "doc_id"))
    d.repartitionByRange(9, F.col("doc_id") * F.col("doc_id")).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _changed(spark, docs, build, columns):
    """The rows when the plan is built on few cores and run on many."""
    with _conf(spark, BEFORE):
        few = docs.rdd.getNumPartitions()
        out = build(docs)
    with _conf(spark, AFTER):
        assert docs.select("*").rdd.getNumPartitions() != few
        return sorted(tuple(map(str, r)) for r in out.select(*columns).collect())


def _texts(docs):
    return {r.doc_id: (r.text or "") for r in docs.collect()}


def _lower(text):
    return "".join(c.lower() if c.isascii() else c for c in text)


@pytest.mark.parametrize("hashed", [exact_dedup.chunk_hash, lambda c: F.lit(7).cast("long")])
def test_exact_dedup_keeps_one_of_each_text(spark, docs, hashed):
    got = _changed(spark, docs, lambda d: exact_dedup.keep_one(d, hashed=hashed), ["doc_id", "_row_uid"])
    most = {}
    for i, t in _texts(docs).items():
        most[_lower(t)] = max(i, most.get(_lower(t), -1))
    assert got == sorted((str(i), f"user {i}") for i in most.values())


def test_simhash_keeps_one_of_each_component(spark, docs):
    got = _changed(spark, docs, simhash.keep_one, ["doc_id", "_row_uid"])
    want = {r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert got == sorted((str(i), f"user {i}") for i in want)


def test_encoding_loses_no_document(spark, docs):
    got = _changed(spark, docs, lambda d: sentencepiece_scan.encode(d, chunk=256), ["doc_id", "text_crc32"])
    want = docs.select("doc_id", F.crc32(F.coalesce("text", F.lit("")).cast("binary"))).collect()
    assert got == sorted(tuple(map(str, r)) for r in want)


def test_pipeline_gives_the_same_rows(spark, docs, tmp_path):
    folder = str(tmp_path)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{SF001}/labels.parquet").write.parquet(f"{folder}/labels.parquet")

    def rows(build_conf, run_conf):
        with _conf(spark, build_conf):
            out = corpus_pipeline.run(spark, folder)
        with _conf(spark, run_conf):
            return sorted(tuple(r) for r in out.select("doc_id", "piece", "start", "length", "ids_crc32").collect())

    assert rows(BEFORE, AFTER) == rows(AFTER, AFTER) != []


def test_rows_of_other_inputs_are_written_once(spark, docs):
    made = common.with_row_id(docs.filter("doc_id >= 0").union(docs), "_id")
    assert made.select("_id").distinct().count() == made.count() == 2 * docs.count()
    named = docs.withColumn("_metadata", F.lit(1))
    assert common.with_row_id(named, "_id").select("_id").distinct().count() == docs.count()
    assert common.free_name(docs, "_row_uid") == "_row_uid_" and common.free_name(docs, "new") == "new"
