"""Registered queries against DuckDB, and the pipeline stage by stage, on the driver tables."""

from __future__ import annotations

import os
import re
from collections import Counter

import pytest
from oracle_compare import connect, differences
from pyspark.sql import functions as F

import corpus_pipeline
from stratalake.llm import quality_fm
from stratalake.llm.common import table
from stratalake.llm.queries import ORACLES, QUERIES, vocabulary

SF_DIR = os.environ.get("LLM_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not here")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    assert differences(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLES[name]) == []


def test_every_operator_is_registered_once():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_a_row_for_each_document(spark, name):
    rows = QUERIES[name](spark, SF_DIR).select("doc_id").collect()
    assert Counter(r[0] for r in rows) == Counter(r[0] for r in table(spark, SF_DIR, "documents").select("doc_id").collect())


def test_stages_take_effect(spark):
    docs = table(spark, SF_DIR, "documents")
    columns = docs.columns
    kept = docs
    counts = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before, kept = kept, stage(spark, kept, SF_DIR)
        kept = kept.cache()
        counts.append(kept.count())
        if i < 4:
            assert kept.columns == columns
            assert kept.select("doc_id", "text").exceptAll(before.select("doc_id", "text")).count() == 0 or i == 3
    assert counts[0] < docs.count() and counts[1] < counts[0] and counts[2] <= counts[1] and counts[4] == counts[3]
    assert Counter(r[0] for r in kept.select("doc_id").collect()).most_common(1)[0][1] <= 2


def test_classifier_keeps_good_documents(spark):
    docs, labels = table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels")
    kept = corpus_pipeline.quality_stage(spark, docs, SF_DIR).select("doc_id")
    good = labels.filter("quality = 1").select("doc_id")
    assert good.join(kept, "doc_id", "left_anti").count() <= 0.02 * good.count()
    machine = quality_fm.fit(docs, labels, F.lit(True))
    assert quality_fm.quality(docs, machine).filter("predicted = 1").count() == kept.count()


def test_pipeline_runs(spark):
    out = corpus_pipeline.run(spark, SF_DIR)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and out.count() > 0
    assert vocabulary().endswith(".json")
