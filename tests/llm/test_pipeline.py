"""The pipeline, stage by stage, on small and odd tables."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from daybook.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not mounted")


def test_every_operator_has_a_query():
    assert {k.split("_")[0] for k in QUERIES} == {*(f"op{n}" for n in range(1, 14)), "pipeline"}


def test_stages_keep_columns_and_bear_odd_rows(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    names = ("kept", "_digest", "_id", "_row", "n_words", "removed", "log_weight", "items", "_key")
    docs = docs.limit(40).withColumns({n: F.lit(n) for n in names})
    null = docs.limit(1).withColumns({"text": F.lit(None).cast("string"), "doc_id": F.lit(None).cast("long")})
    docs = docs.unionByName(docs.limit(3)).unionByName(null)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_DIR)
        assert out.columns == docs.columns, name
        assert {r.kept for r in out.select("kept").collect()} == {"kept"}
        assert stage(spark, docs.limit(0), SF_DIR).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).count() == 44


def test_run(spark):
    out = corpus_pipeline.run(spark, SF_DIR).toPandas()
    assert 0 < len(out) < 200 and out.doc_id.is_unique and (out.n_tokens == out.ids.map(len)).all()


def test_passages_of_more_than_fifty_words_go(spark):
    rng = random.Random(7)
    new = lambda n: [f"{rng.choice('abcdefgé')}{rng.randrange(10**6)}"[: rng.randint(2, 5)] + rng.choice(["", "", "", ","]) for _ in range(n)]
    texts, want = [], []
    for size in (50, 51, 52, 55, 60):
        passage = " ".join(new(size)).rstrip(",")
        for _ in range(2):
            before, after = " ".join(new(30)) + f" q{len(texts)}q ", f" r{len(texts)}r " + " ".join(new(20))
            texts.append(before + passage + after)
            want.append(texts[-1] if size == 50 else before + after)
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    out = {r.doc_id: r for r in corpus_pipeline.drop_passages(spark, docs, SF_DIR).collect()}
    assert [out[i].text for i in range(len(texts))] == want
    assert all(r.n_chars == len(r.text) for r in out.values())
