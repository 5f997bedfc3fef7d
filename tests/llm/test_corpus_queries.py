"""The registered corpus queries and the pipeline over the small tables."""

from __future__ import annotations

import os

import duckdb
import pytest

import corpus_pipeline
from txsieve.llm import quality, setsketch
from txsieve.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for file in os.listdir(sf_dir):
        connection.execute(f"create view {file.removesuffix('.parquet')} as select * from '{sf_dir}/{file}'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(name, spark, duck, sf_dir):
    result = QUERIES[name](spark, sf_dir)
    cursor = duck.execute(ORACLES[name])
    names = [column[0] for column in cursor.description]
    assert sorted(names) == sorted(result.columns)
    want = sorted(map(repr, cursor.fetchall()))
    assert sorted(repr(tuple(row)) for row in result.select(*names).collect()) == want


def test_one_query_per_operator():
    assert sorted({int(name[2:].split("_")[0]) for name in QUERIES}) == list(range(1, 14))


def test_pipeline(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before, names = docs, []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(k))
        stage(spark, before, sf_dir).write.parquet(path)
        after = spark.read.parquet(path)
        names.append(name)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert after.columns == docs.columns
        if name == "quality_rules":
            kept = quality.quality_rules(docs).where("kept").count()
            assert after.count() == kept
        if name == "near_dedup":
            ids = {r["doc_id"] for r in setsketch.near_duplicates(before).where("kept").collect()}
            assert sorted(r["doc_id"] for r in after.collect()) == sorted(ids)
        before = after
    assert names == ["quality_rules", "language_id", "near_dedup", "source_mixing", "packing"]
    assert {r["doc_id"] for r in before.collect()} <= {r["doc_id"] for r in docs.collect()}
