"""The registered queries on the smallest tables, and the pipeline stage by stage."""

import os
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from checks import compare
from mediasignal.llm import quality, queries
from mediasignal.session import staged
from tests.llm.test_dedup import plain_components, plain_fingerprint

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, monkeypatch, name):
    monkeypatch.setattr(compare, "QUERIES", queries.QUERIES)
    monkeypatch.setattr(compare, "ORACLE", queries.ORACLE)
    state, note, rows, _ = compare.compare(spark, compare.duck(SF), SF, name)
    assert state == ("OK" if name in queries.ORACLE else "ROWS") and rows, note


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(staged(stage(spark, frames[-1], SF), name))
    good, exact, near, mixed, pieces = frames[1:]
    for frame in frames[1:5]:
        assert frame.dtypes == docs.dtypes and frame.exceptAll(docs).isEmpty()
    rejected = {r.doc_id for r in docs.join(good, "doc_id", "left_anti").collect()}
    scores = quality.quality_scores(docs, quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet")))
    assert rejected == {r.doc_id for r in scores.where("predicted = 0").collect()}
    key = lambda t: re.sub("[\x20\x09-\x0D]+", " ", t or "")
    first = {}
    for r in sorted(good.collect(), key=lambda r: r.doc_id):
        first.setdefault(key(r.text), r.doc_id)
    assert {r.doc_id for r in exact.collect()} == set(first.values())
    rows = exact.select("doc_id", "text").collect()
    roots = plain_components([plain_fingerprint(r.text) for r in rows])
    best = {}
    for r, root in zip(rows, roots):
        best[root] = min(best.get(root, r.doc_id), r.doc_id)
    assert {r.doc_id for r in near.collect()} == set(best.values())
    words = lambda df: sum(len((r.text or "").split()) for r in df.collect())
    assert 0.7 * words(near) <= words(mixed) <= 0.95 * words(near)
    assert {r.doc_id for r in pieces.collect()} == {r.doc_id for r in mixed.collect()}
    whole = pieces.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("m"))
    assert whole.where("n <> m").isEmpty()


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).columns[:3] == ["doc_id", "start", "length"]
