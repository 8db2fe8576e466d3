from __future__ import annotations

import hashlib
import random
import re

import pytest

from stratalake.llm import decontam

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def expected(docs, items, window=13):
    out = []
    for i, text in docs:
        doc, hit, names = words(text), set(), set()
        for name, item in items:
            item = words(item)
            n = min(window, len(item))
            spans = {tuple(item[k : k + n]) for k in range(len(item) - n + 1)} if n else set()
            for k in range(len(doc) - n + 1 if n else 0):
                if tuple(doc[k : k + n]) in spans:
                    hit |= set(range(k, k + n))
                    names.add("" if name is None else str(name))
        sha = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((i, len(doc), len(hit), len(names), sha, bool(hit) and 20 * len(hit) >= len(doc)))
    return sorted(out, key=str)


COLUMNS = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def found(docs, items, **options):
    return sorted((tuple(r[c] for c in COLUMNS) for r in decontam.contamination(docs, items, **options).collect()), key=str)


@pytest.fixture(scope="module")
def few_words(spark):
    """Documents and items over a small vocabulary, so that windows overlap, repeat and share anchors."""
    rng = random.Random(4)
    vocabulary = ["the", "of", "Élan", "x1", "rare", "the", "The", "and"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(k, text(n)) for k, n in enumerate([30, 13, 14, 5, 1, 20, 16])] + [(7, "the the the the"), (8, None), (9, "?!"), (9, "of rare"), (None, "x1 x1")]
    docs = [(k, text(rng.randrange(40))) for k in range(20)]
    docs += [(50 + k, text(9) + ", " + t.upper() + "; " + text(11)) for k, t in items[:6]]
    docs += [(99, None), (99, ""), (None, items[0][1]), (3, docs[3][1]), (3, items[1][1])]
    return docs, items


@pytest.mark.parametrize("window", [4, 13])
@pytest.mark.parametrize("block", [200_000, 3])
def test_hits_equal_brute_force(spark, few_words, window, block):
    docs, items = few_words
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert found(*frames, window=window, block=block) == expected(docs, items, window)


def test_awkward_documents(awkward, spark):
    items = [(1, "alpha beta gamma delta alpha beta gamma delta alpha beta gamma delta alpha"), (2, "another line")]
    df = spark.createDataFrame(items, "item_id int, text string")
    docs = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    assert found(awkward, df) == expected(docs, items)
    kept = decontam.without_contaminated(awkward, df)
    assert kept.columns == awkward.columns
    clean = sum(not r[-1] for r in expected(docs, items))
    assert kept.count() == clean


def test_empty_tables(nothing, awkward, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, "some text")], "item_id long, text string")
    assert found(nothing, one) == []
    assert {r[2] for r in found(awkward, none)} == {0}


def test_proximity_finds_words_in_another_order(spark):
    docs = spark.createDataFrame([(1, "one two zebra four x three"), (2, "zebra one y y y y y two three four")], "doc_id long, text string")
    items = spark.createDataFrame([(5, "one two three four zebra")], "item_id long, text string")
    index = decontam.index_for(docs, items, window=13, reach=8)
    near = decontam.proximity_matches(index, 4).select("_id", "item_id", "start").collect()
    assert [tuple(r) for r in near] == [(1, "5", 0)]
    assert decontam.proximity_matches(index, 8).count() == 1 + 0 * len(near)
    assert decontam.phrase_matches(index).count() == 0


def test_no_python_in_the_plan(awkward, spark):
    items = spark.createDataFrame([(1, "alpha beta")], "item_id int, text string")
    plan = decontam.contamination(awkward, items)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
