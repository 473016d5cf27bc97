import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskframe.llm import queries, sharding
from tests.conftest import DATA
from tests.llm.helpers import docs_table


def plain_best_fit(sizes, capacity):
    rooms, bins = [], [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        fits = [(room, b) for b, room in enumerate(rooms) if room >= sizes[i]]
        if fits:
            b = min(fits)[1]
        else:
            b = len(rooms)
            rooms.append(capacity)
        rooms[b] -= sizes[i]
        bins[i] = b
    return bins, len(rooms)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=80), st.integers(50, 120))
def test_tree_packs_as_a_plain_scan_does(sizes, capacity):
    assert sharding.best_fit_decreasing(sizes, capacity) == plain_best_fit(sizes, capacity)


def test_packing_is_tight():
    bins, capacity = sharding.pack_into([7, 5, 5, 4, 3, 3, 3], 3)
    assert capacity == 10 and max(bins) == 2
    with pytest.raises(ValueError):
        sharding.best_fit_decreasing([5], 4)
    assert sharding.pack_into([], 4) == ([], 0)


def placed(spark, texts, ids=None, shards=4, **more):
    return sharding.shard_documents(docs_table(spark, texts, ids), shards, **more).collect()


@pytest.mark.parametrize("units", [4096, 8])
def test_groups_stay_whole_slots_have_no_gaps_and_shards_are_even(spark, units):
    texts = [f"text {i} " + "x" * (i * 37 % 400) for i in range(600)] + ["same text"] * 90 + [None, "", None]
    rows = placed(spark, texts, units=units)
    assert sorted(r["doc_id"] for r in rows) == list(range(len(texts)))
    where = {}
    for r in rows:
        text = texts[r["doc_id"]] or ""
        assert r["size"] == len(text.encode()) + 8 and r["text_crc32"] == zlib.crc32(text.encode())
        assert where.setdefault(text, r["shard"]) == r["shard"]
    loads = Counter()
    for shard in range(4):
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots)))
        loads[shard] = sum(r["size"] for r in rows if r["shard"] == shard)
    bound = 1.02 if units == 4096 else 1.35
    assert max(loads.values()) <= bound * sum(loads.values()) / 4


def test_a_huge_group_odd_ids_and_an_empty_table(spark):
    rows = placed(spark, ["big " * 100] * 50 + ["a", "b", "a"], [None, 1, 1] + list(range(50)))
    assert len({r["shard"] for r in rows if r["size"] > 100}) == 1 and len(rows) == 53
    assert placed(spark, []) == []


def test_query(spark):
    rows = queries.op9_sharding(spark, DATA).collect()
    assert {r["shard"] for r in rows} <= set(range(24)) and {r["law"] for r in rows} == {"bytes"}
    loads = Counter()
    for r in rows:
        loads[r["shard"]] += r["size"]
    assert len(rows) == spark.read.parquet(f"{DATA}/documents.parquet").count()
    largest = max(Counter((r["size"], r["text_crc32"]) for r in rows).items(), key=lambda kv: kv[0][0] * kv[1])
    assert max(loads.values()) <= max(1.05 * sum(loads.values()) / 24, largest[0][0] * largest[1])


def test_query_keeps_long_slots(spark):
    assert dict(queries.op9_sharding(spark, DATA).dtypes)["slot"] == "bigint"
