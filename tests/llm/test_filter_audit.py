from __future__ import annotations

import re
from collections import defaultdict
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratalake.llm import filter_audit

COLUMNS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def brute(docs, labels):
    """(part, order, step) to counts, document by document. ``docs``: (id, text, part); ``labels``: (id, good, toxic)."""
    parts = defaultdict(list)
    for i, text, part in docs:
        t = text or ""
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", t) if w]
        fails = ""
        fails += "A" * (len(words) < 100)
        fails += "B" * (100 * len(set(words)) < 80 * len(words))
        fails += "C" * (100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t))
        fails += "D" * any(c in "#$%&*|" for c in t)
        fails += "E" * any((u or "") == t and j is not None and (i is None or j < i) for j, u, _ in docs)
        good = any(j == i and g == 1 for j, g, _ in labels) and i is not None
        toxic = any(j == i and x == 1 for j, _, x in labels) and i is not None
        parts[part or ""].append((fails, good, toxic))
    out = {}
    for part, rows in parts.items():
        shapley = defaultdict(int)
        for order in map("".join, permutations("ABCDE")):
            left = rows
            for step, f in enumerate(order, 1):
                here = [r for r in left if f in r[0]]
                left = [r for r in left if f not in r[0]]
                shapley[f] += len(here)
                out[part, order, step] = {
                    "kept": len(left),
                    "removed": len(here),
                    "redundant": sum(f in r[0] for r in rows) - len(here),
                    "unique_fails": sum(r[0] == f for r in rows),
                    "good_lost": sum(r[1] for r in here),
                    "toxic_lost": sum(r[2] for r in here),
                }
        for order in map("".join, permutations("ABCDE")):
            for step, f in enumerate(order, 1):
                out[part, order, step]["shapley"] = shapley[f]
    return out


def audited(spark, docs, labels):
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string").withColumns(
        {"mask": F.lit("x"), "part": F.lit(3), "n": F.lit(5), "digest": F.lit("y"), "quality": F.lit(1)}
    )
    given = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("text", F.lit("z"))
    rows = filter_audit.filter_audit(d, given).collect()
    found = {(r["part"], r["filter_order"], r["step"]): {c: r[c] for c in COLUMNS} for r in rows}
    assert len(found) == len(rows)
    return found


LONG = " ".join(f"word{i}" for i in range(300))
DOCS = [
    (1, LONG, "en"), (2, LONG, "en"), (2, LONG, "en"), (3, LONG, "de"), (None, LONG, "en"), (None, LONG, None),
    (4, None, "en"), (5, "", "en"), (None, "", "de"), (6, "ABC def", ""), (7, "a # b", None), (8, "a b " * 90, "fr"),
    (9, "ÉCOLE É\U0001f600 Ab c\x1cd", "fr"), (10, "HELLO " * 120 + "|", "fr"), (None, "only here " * 60, "fr"),
    (11, "\t\n \x0b", "de"), (12, LONG * 300, "de"), (1, "a # b", "en"),
]
LABELS = [(1, 1, 0), (2, 0, 1), (2, 1, 0), (4, None, 1), (6, 1, None), (None, 1, 1), (99, 1, 1), (9, 2, 0), (10, 1, 1)]


def test_equal_to_counting_documents(spark):
    assert audited(spark, DOCS, LABELS) == brute(DOCS, LABELS)


def test_no_documents_and_no_labels(spark):
    assert audited(spark, [], LABELS) == {}
    assert audited(spark, DOCS[:7], []) == brute(DOCS[:7], [])


def test_a_text_that_a_third_of_rows_have(spark):
    docs = [(i, "same text" if i % 3 == 0 else f"text {i} #", "en" if i % 2 else "de") for i in range(1200)]
    labels = [(i, i % 2, int(i % 5 == 0)) for i in range(0, 1200, 4)]
    assert audited(spark, docs, labels) == brute(docs, labels)
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    given = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    cells = filter_audit.weighted_failures(d, given).groupBy("part", "mask").count()
    assert cells.count() <= 2 * 32


def test_removal_steps_are_the_first_failing_position():
    masks = np.arange(16)
    steps = filter_audit.removal_steps(masks, "wxyz")
    for j, order in enumerate(filter_audit.orders("wxyz")):
        for m in masks:
            failing = [i for i, f in enumerate(order) if m >> "wxyz".index(f) & 1]
            assert steps[m, j] == min(failing, default=4)


@pytest.mark.parametrize("letters", ["", "AA", "ABCDEFG"])
def test_letters_are_checked(spark, letters):
    weighted = spark.createDataFrame([("p", 1, 2)], "part string, mask int, n long")
    with pytest.raises(ValueError):
        filter_audit.audit(weighted, letters)


def test_general_filters(spark):
    weighted = spark.createDataFrame([("p", 0, 5), ("p", 3, 2), ("p", 3, 1), ("p", 1, 4), (None, 2, 1)], "part string, mask int, n long")
    rows = {(r["part"], r["filter_order"], r["step"]): r for r in filter_audit.audit(weighted, "xy").collect()}
    assert len(rows) == 8
    r = rows["p", "yx", 2]
    assert (r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["shapley"]) == (5, 4, 3, 4, 11)
    assert rows[None, "xy", 2]["removed"] == 1
