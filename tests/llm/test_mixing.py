from __future__ import annotations

from collections import Counter, defaultdict

import pytest

from stratalake.llm import mixing
from stratalake.llm.queries import QUERIES


def test_awkward_rows_have_a_result_each(awkward):
    rows = mixing.mix(awkward).collect()
    assert len(rows) == awkward.count()
    assert all(r["taken"] <= 2 * r["size"] for r in rows)
    assert {r["doc_id"]: r["taken"] for r in rows if r["size"] == 0} == {2: 0, 3: 0, 4: 0, None: 0}


def test_targets_stop_at_the_cap_and_add_up(frame):
    df = frame([(i, "w " * (5 + i % 7), f"s{i % 3}") for i in range(600)] + [(1000 + i, "tiny text", None) for i in range(5)])
    rows = mixing.mix(df).collect()
    size, taken, target = defaultdict(int), defaultdict(int), {}
    for r in rows:
        size[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert sum(target.values()) == pytest.approx(1.5 * sum(size.values()))
    for s in size:
        assert target[s] <= 2 * size[s] + 1e-9
        assert abs(taken[s] - target[s]) <= 6  # half of the largest document
    assert target["s0"] == 2 * size["s0"] and target[None] == 2 * size[None]
    assert target["s2"] == pytest.approx(2 * target["s1"])


def test_schedule_is_inverted(spark, frame):
    """Documents of one word: positions follow the cumulative weight of a schedule with a pause."""
    df = frame([(i, "w", "a") for i in range(1000)])
    knots = [(0.0, 1.0), (0.25, 1.0), (0.2500001, 0.0), (0.75, 0.0), (0.7500001, 1.0), (1.0, 3.0)]
    schedule = spark.createDataFrame([("a", knots)], "source string, knots array<struct<t: double, w: double>>")
    rows = mixing.mix(df, scale=1.0, schedule=schedule).collect()
    positions = sorted(p for r in rows for p in r["positions"])
    assert len(positions) == 1000
    assert sum(p <= 0.2501 for p in positions) == pytest.approx(1000 * 0.25 / 0.75, abs=3)
    assert not [p for p in positions if 0.2502 < p < 0.7499]
    half = 0.75 + 0.25 * (-1 + (1 + 4 * 0.5 / 0.25 * 0.25) ** 0.5)  # a rising weight is later than the middle
    assert half > 0.75 and positions[-1] <= 1


def test_order_and_copies(frame):
    df = frame([(i, "w " * 10, f"s{i % 2}") for i in range(100)] + [(7, "w " * 10, "s1")])
    mixed = mixing.mix(df)
    order = mixing.training_order(mixed).collect()
    assert [r["position"] for r in order] == sorted(r["position"] for r in order)
    want = Counter()
    for r in mixed.collect():
        want[r["doc_id"]] += len(r["positions"])
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    assert Counter(r["doc_id"] for r in out.collect()) == +want


def test_reruns_agree(awkward):
    once, again = (sorted(map(str, mixing.mix(df).collect())) for df in (awkward, awkward.repartition(5)))
    assert once == again


def test_empty_table(nothing):
    assert mixing.mix(nothing).collect() == [] and mixing.mixed_documents(nothing).collect() == []


def test_rows_without_an_id_and_rows_that_repeat(frame):
    """A third of the rows are one row without an id: counted one by one, taken as often as other rows, and the hash
    that orders a source spreads rows without an id."""
    same = [(None, "same words here")] * 9000
    df = frame(same + [(None, f"words of row {i}") for i in range(3000)] + [(i, f"of document {i} words") for i in range(3000)])
    rows = mixing.mix(df).collect()
    assert len(rows) == 15_000
    total = sum(r["size"] for r in rows)
    assert total == rows[0]["source_size"] and abs(sum(r["taken"] for r in rows) - rows[0]["target"]) <= 4
    # Times are those of one row after the other: no two copies begin at the same place.
    positions = [p for r in rows for p in r["positions"]]
    assert len(set(positions)) == len(positions)
    out = Counter(r["text"] for r in mixing.mixed_documents(df).collect())
    want = Counter()
    for r in rows:
        if r["size"] == 3:
            want["same words here"] += len(r["positions"])
    assert out["same words here"] == want["same words here"] > 9000
    assert sum(out.values()) == len(positions)


def test_mixed_documents_on_awkward_rows(awkward):
    out = mixing.mixed_documents(awkward)
    assert out.columns == awkward.columns
    want = Counter()
    for r in mixing.mix(awkward).collect():
        want[r["doc_id"]] += len(r["positions"])
    assert Counter(r["doc_id"] for r in out.collect()) == +want


@pytest.fixture
def many(frame):
    """Three sources, rows that repeat, and rows that the mix does not take."""
    rows = [(i, "w " * (1 + i % 7), f"s{i % 3}") for i in range(500)] + [(None, "w w", None)] * 300
    return frame(rows + [(i, "", "s0") for i in range(20)])


def test_places_number_the_copies_by_time(many):
    rows = mixing.mix(many).collect()
    assert len(rows) == 820 and all(len(r["places"]) == len(r["positions"]) for r in rows)
    copies = sorted((place, at) for r in rows for place, at in zip(r["places"], r["positions"], strict=True))
    assert [place for place, _ in copies] == list(range(len(copies))) and len(copies) > 820
    assert [at for _, at in copies] == sorted(at for _, at in copies)
    assert [at for _, at in copies] == [r["position"] for r in mixing.training_order(mixing.mix(many)).collect()]


def test_the_query_reads_the_sorted_copies(spark, many, tmp_path, monkeypatch):
    """What the range sort does not return is in no row of the query."""
    many.write.parquet(f"{tmp_path}/documents.parquet")
    sort, query = mixing.training_order, QUERIES["op2_mixing"]
    whole = query(spark, str(tmp_path)).collect()
    monkeypatch.setattr(mixing, "training_order", lambda *args: sort(*args).filter("position < 0.5"))
    half = query(spark, str(tmp_path)).collect()
    assert len(half) == len(whole) == 820
    assert sum(r["taken"] for r in half) < sum(r["taken"] for r in whole)
    first = Counter(r["first_position"] for r in whole if r["first_position"] is not None and r["first_position"] < 0.5)
    assert first and Counter(r["first_position"] for r in half if r["first_position"] is not None) == first


def test_places_over_tasks_without_rows(spark):
    numbers = spark.range(1000).repartitionByRange(7, "id").sortWithinPartitions("id").filter("id < 100 OR id > 700")
    found = mixing._numbered(numbers).sort("id").collect()
    assert [r["place"] for r in found] == list(range(399)) and found[100]["id"] == 701
