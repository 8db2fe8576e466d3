"""Every stage of the pipeline on rows that it must not stumble over: nothing at all, nulls, long texts, repeated rows,
and columns whose names the operators use inside."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from stratalake.llm.common import NULL_ID, keyed, public_id

LONG = "alpha beta gamma delta " * 9000
KINDS = "doc_id long, text string, lang string, source string, n_chars long, _id int, _hash string, level int, words int"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables of a few rows, with clashing columns, and a folder like it whose documents are none."""
    out = {}
    words = [f"{a}{b}" for a in ("ta", "mo", "ri", "se") for b in ("ka", "no", "pi", "du", "we")]
    plain = [" ".join(words[(7 * i + k * k) % 20] for k in range(60)) + "." for i in range(40)]
    poor = ["#|@ " * 40 + str(i) for i in range(20)]
    rows = [(i, t, "en", "s" if i % 3 else None, len(t)) for i, t in enumerate([*plain, *poor])]
    rows += [(None, plain[0], "en", "s", 1), (None, None, None, None, None), (100, None, "en", "s", 0), (101, "", "en", "t", 0)]
    rows += [(102, LONG, "en", "t", 1), (103, LONG + "tail", "en", "t", 1), (7, plain[7], "en", "s", 2), (7, plain[7], "en", "s", 2)]
    labels = [(i, int(i < 40), int(i % 4 == 0), "x", 1.0) for i in range(60)] + [(None, 1, 1, "x", 1.0), (3, None, None, "x", 1.0)]
    benchmark = [("a", " ".join(words[:15]), 1, "x"), (None, None, 1, "x"), ("b", "", 1, "x"), ("a", " ".join(words[:15]), 1, "x")]
    for name, documents in (("some", rows), ("none", [])):
        path = str(tmp_path_factory.mktemp(name))
        docs = spark.createDataFrame([(*r, 1, "x", 2, 3) for r in documents], KINDS)
        docs.write.parquet(f"{path}/documents.parquet")
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string, score double").write.parquet(f"{path}/labels.parquet")
        spark.createDataFrame(benchmark, "item_id string, text string, doc_id int, words string").write.parquet(f"{path}/benchmark.parquet")
        out[name] = path
    return out


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
@pytest.mark.parametrize("kind", ["some", "none"])
def test_stage_alone(spark, folder, name, kind):
    path, stage = folder[kind], dict(corpus_pipeline.STAGES)[name]
    docs = spark.read.parquet(f"{path}/documents.parquet")
    out = stage(spark, docs, path)
    rows = out.collect()
    if name != "tokens":
        assert out.columns == docs.columns
        given = {(r["doc_id"], r["text"]) for r in docs.collect()}
        assert {(r["doc_id"], r["text"]) for r in rows} <= given
    if kind == "none":
        assert rows == []
    elif name == "tokens":
        assert len(rows) == docs.count()
    else:
        ids = {r["doc_id"] for r in rows}
        assert ids & set(range(40)), name
        assert name == "mixing" or 102 in ids or name == "quality"


@pytest.mark.parametrize("kind", ["some", "none"])
def test_whole_pipeline(spark, folder, kind):
    rows = corpus_pipeline.run(spark, folder[kind]).collect()
    assert (len(rows) > 0) == (kind == "some")


def test_ids_come_back(frame):
    df = keyed(frame([(0, "a"), (-5, "b"), (None, "c"), (NULL_ID - 1, "d")])).select("_id", public_id().alias("doc_id"))
    assert {tuple(r) for r in df.collect()} == {(0, 0), (-5, -5), (NULL_ID, None), (NULL_ID - 1, NULL_ID - 1)}
    assert df.filter(F.col("_id").isNull()).count() == 0
