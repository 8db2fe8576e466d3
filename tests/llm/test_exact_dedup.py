from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from stratalake.llm.exact_dedup import block_identities, exact_groups
from stratalake.llm.common import keyed, repeated

SPACE = re.compile(r"[\x20\x09-\x0d]")


def expected(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[SPACE.sub("", t or "")].append((-len(t or ""), i is None, i or 0, i))
    out = Counter()
    for text, members in groups.items():
        best = min(members)[3]
        for k, (_, _, _, i) in enumerate(sorted(members, key=lambda m: m[:3])):
            out[(i, best, len(members), k == 0, hashlib.sha256(text.encode()).hexdigest())] += 1
    return out


def found(df, **options):
    return Counter(tuple(r) for r in exact_groups(df, **options).collect())


@pytest.mark.parametrize("block", [3, 64, 16_384])
def test_groups_equal_brute_force(awkward, block):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    if block == 3:
        rows = [(i, t) for i, t in rows if len(t or "") < 200]
    df = awkward.filter("length(text) < 200 OR text IS NULL") if block == 3 else awkward
    assert found(df, block=block) == expected(rows)


def test_equal_signatures_of_different_blocks_are_told_apart(frame):
    rows = [(i, t) for i, t in enumerate(["abcdef", "abcxyz", "abcdef ", "xyzabc", "abc", "xyz", "xyz xyz", "qrs"])]
    assert found(frame(rows), block=3, signature=lambda b: F.length(b).cast("long")) == expected(rows)


def test_rows_that_repeat_thousands_of_times(spark, frame):
    """A third of the rows are one row without an id; they come back one by one, by way of many tasks."""
    rows = [(None, "")] * 9000 + [(i, f"text {i}") for i in range(40)] + [(None, " \n")] * 3
    assert found(frame(rows)) == expected(rows)
    many = spark.createDataFrame([(1, 1_000_000), (2, 1), (3, 0)], "k long, n long")
    out = repeated(many, "n", "nth", most=1000)
    assert out.groupBy("k").agg(F.count("*"), F.min("nth"), F.max("nth"), F.count_distinct("nth")).sort("k").collect() == [
        (1, 1_000_000, 0, 999_999, 1_000_000), (2, 1, 0, 0, 1)
    ]


def test_empty_table(nothing):
    assert exact_groups(nothing).collect() == []


def test_identity_is_level_and_name(frame):
    same = frame([(1, "abcabcabc"), (2, "abcabcabc"), (3, "abcabcabd"), (4, "abcabc")])
    got = {r["_id"]: (r["level"], r["name"]) for r in block_identities(keyed(same), block=2).collect()}
    assert got[1] == got[2] and len(set(got.values())) == 3
