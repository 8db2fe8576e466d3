from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from stratalake.llm import simhash
from stratalake.llm.components import components


def plain_fingerprint(text, words=3):
    parts = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    for space in "\t\n\v\f\r":
        parts = parts.replace(space, " ")
    parts = [p for p in parts.split(" ") if p]
    shingles = [" ".join(parts[i : i + words]) for i in range(len(parts) - words + 1)] or ([" ".join(parts)] if parts else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(pairs, nodes):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    return {n: find(n) for n in nodes}


def test_fingerprint_equals_definition():
    rng = random.Random(5)
    texts = ["", " \t", "One", "One two", "one TWO three", "É Ö ß\x1c a b \x0b c"]
    texts += [" ".join(rng.choice(["a", "B", "ccc", "É", "dd."]) for _ in range(rng.randrange(40))) for _ in range(60)]
    for t in texts:
        assert simhash.fingerprint(t) == plain_fingerprint(t), t


@pytest.mark.parametrize("piece", [8192, 16])
@pytest.mark.parametrize("distance", [1, 3, 5])
def test_components_equal_brute_force(spark, distance, piece):
    """Random fingerprints, chains of near ones, and a dense cluster whose buckets are split into pieces."""
    rng = random.Random(distance)
    prints = [rng.getrandbits(64) for _ in range(300)] + [0, 7]
    for _ in range(200):
        prints.append(prints[-1] ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    centre = rng.getrandbits(64)
    prints += [centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(150)]
    prints += prints[:5]
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    rows = [(i, p) for i, p in enumerate(signed)]
    got = {r["fp"]: r["component"] for r in simhash.near_components(spark.createDataFrame(rows, "_id long, fp long"), distance, piece).collect()}
    pairs = [(i, j) for i in range(len(prints)) for j in range(i) if bin(prints[i] ^ prints[j]).count("1") <= distance]
    want = roots(pairs, range(len(prints)))
    assert [got[p] for p in signed] == [want[i] for i in range(len(prints))]


def test_thresholds_add_up():
    histogram = np.random.default_rng(0).integers(0, 9, (8, 256))
    histogram[:, 0] += 3000 - histogram.sum(axis=1)
    plan = simhash.Pigeonhole(histogram, 5)
    t = plan.thresholds(np.random.default_rng(1).integers(0, 1 << 62, 50))
    assert (t.sum(axis=1) == 5 - len(plan.parts) + 1).all() and (t >= -1).all()


def test_awkward_rows_have_a_result_each(awkward):
    rows = simhash.near_duplicates(awkward).collect()
    assert len(rows) == awkward.count()
    for r in rows:
        assert r["component"] <= r["_id"]
    zero = {r["component"] for r in rows if r["fp"] == 0}
    assert zero == {2}


def test_one_of_each_keeps_columns_and_one_row(awkward):
    kept = simhash.one_of_each(awkward)
    assert kept.columns == awkward.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == len(set(ids)) and 3 not in ids and 2 in ids


def test_only_texts_chain_not_ids(frame):
    """Rows without an id, or with the same one, are like other documents each for itself."""
    rng = random.Random(3)
    one, two, three, four, five, six = (" ".join(f"w{rng.randrange(10_000)}" for _ in range(100)) for _ in range(6))
    rows = [(5, one), (9, two), (None, one.upper()), (None, two.upper()), (None, three), (None, four), (None, None)]
    rows += [(11, five), (12, six), (10, five.upper()), (10, six.upper())]
    kept = [(r["doc_id"], r["text"]) for r in simhash.one_of_each(frame(rows)).collect()]
    assert {(5, one), (9, two), (None, three), (None, four), (None, None)} <= set(kept)
    # One row of id 10 stays and replaces the document that it is like; the other one replaces none.
    ten = [t for i, t in kept if i == 10]
    assert ten == [five.upper()] and (12, six) in kept or ten == [six.upper()] and (11, five) in kept
    assert len(kept) == 7


def test_one_of_each_group_stays_as_by_brute_force(spark, frame):
    """A hot text that a third of the rows have, near copies of it, chains and unlike texts; rows of one id too."""
    rng = random.Random(11)
    base = [f"w{rng.randrange(10_000)}" for _ in range(300)]
    rows = [(3 * i, " ".join(base)) for i in range(150)]
    for i in range(150):
        text = list(base)
        text[rng.randrange(300)] = f"x{i}"
        rows.append((3 * i + 1, " ".join(text)))
    rows += [(3 * i + 2, " ".join(f"w{rng.randrange(10_000)}" for _ in range(rng.randrange(40)))) for i in range(150)]
    rng.shuffle(rows)
    prints = {i: plain_fingerprint(t) for i, t in rows}
    pairs = [(i, j) for i in prints for j in prints if i < j and bin(prints[i] ^ prints[j]).count("1") <= 3]
    want = set(roots(pairs, prints).values())
    kept = [r["doc_id"] for r in simhash.one_of_each(frame(rows), piece=64).collect()]
    assert sorted(kept) == sorted(want) and len(want) > 100


def test_components_of_chains_and_stars(spark):
    rng = random.Random(2)
    pairs = [(i, i + 1) for i in range(60)] + [(100, k) for k in range(101, 160)] + [(7, 7)]
    pairs = [p if rng.random() < 0.5 else p[::-1] for p in pairs]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = roots(pairs, {n for p in pairs for n in p})
    assert got == {n: r for n, r in want.items() if n != r}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_empty_table(nothing):
    assert simhash.near_duplicates(nothing).collect() == [] and simhash.one_of_each(nothing).collect() == []
