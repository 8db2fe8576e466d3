from __future__ import annotations

from collections import Counter, defaultdict

import pytest

from stratalake.llm.line_dedup import _merge, line_key, without_repeated_lines

import numpy as np


def expected(rows, least=10):
    order = lambda i: (i is None, i or 0)
    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(line_key(line)) >= least:
                holders[line_key(line)].add(i)
    out = Counter()
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(holders.get(line_key(x), ())) < 2 or min(holders[line_key(x)], key=order) == i]
        out[(i, "\n".join(kept), len(lines), len(lines) - len(kept))] += 1
    return out


def found(df, **options):
    return Counter(tuple(r) for r in without_repeated_lines(df, **options).collect())


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
def test_lines_equal_brute_force(awkward, broadcast_bytes):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    assert found(awkward, broadcast_bytes=broadcast_bytes) == expected(rows)


def test_hot_line_over_many_documents(frame):
    rows = [(i, f"document number {i}\n  The Same Line in all \nend {i % 3}") for i in range(400)]
    assert found(frame(rows).repartition(7)) == expected(rows)


def test_empty_table(nothing):
    assert without_repeated_lines(nothing).collect() == []


def test_key_strips_ascii_space_and_lowers_ascii_only():
    assert line_key("\t ÉCOLE A  ") == "École a ".replace("É", "É") and line_key(" Ab ") == "ab"


def test_bits_met_twice_are_kept():
    word = np.array([5, 5, 9, 5])
    once = np.array([1, 3, 4, 8], np.uint64)
    w, a, b = _merge(word, once, np.array([0, 0, 4, 0], np.uint64))
    assert w.tolist() == [5, 9] and a.tolist() == [11, 4] and b.tolist() == [1, 4]
