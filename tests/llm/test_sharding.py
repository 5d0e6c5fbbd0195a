from __future__ import annotations

import random
import zlib
from collections import defaultdict

import pytest

from casebook.llm import sharding
from tests.llm.frames import documents, edge_documents, empty


def checked(rows, found, shards):
    """Every row once, equal texts together, slots without gaps; returns the bytes of the shards."""
    assert len(found) == len(rows)
    sizes, slots, homes = defaultdict(int), defaultdict(list), defaultdict(set)
    texts = dict(rows)
    for r in found:
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(data) + 8, zlib.crc32(data), "bytes")
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
        homes[data].add(r.shard)
    assert all(len(h) == 1 for h in homes.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(sizes) <= set(range(shards))
    return [sizes[s] for s in range(shards)]


@pytest.mark.parametrize("shards", [1, 2, 5, 24])
def test_shards_are_balanced(spark, shards):
    random.seed(shards)
    rows = [(i, "".join(random.choice("abcd é") for _ in range(random.randrange(60)))) for i in range(1500)]
    sizes = checked(rows, sharding.shard(documents(spark, rows), shards).collect(), shards)
    assert max(sizes) - min(sizes) < 600


def test_a_hot_value_and_a_hot_text(spark):
    rows = [(i, "same text") for i in range(600)] + [(1000 + i, f"own {i:04d}") for i in range(1200)]
    sizes = checked(rows, sharding.shard(documents(spark, rows), 6).collect(), 6)
    assert sizes[0] == 600 * 17
    assert max(sizes[1:]) - min(sizes[1:]) < 100


def test_cells_number_like_one(spark, monkeypatch):
    monkeypatch.setattr(sharding, "CELL_ROWS", 7)
    rows = [(i, f"text {i}") for i in range(300)]
    checked(rows, sharding.shard(documents(spark, rows), 3).collect(), 3)


def test_edge_rows(spark):
    found = sharding.shard(edge_documents(spark), 4).collect()
    assert len(found) == 14
    assert {r.size for r in found if r.doc_id in (0, 1)} == {8}
    slots = defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard(empty(edge_documents(spark)), 4).count() == 0
    assert sharding.shard(documents(spark, [(1, "one")]), 24).count() == 1


def test_query(spark):
    rows = sharding.op10_sharding(spark, "/root/testdata/sf0.001").collect()
    assert {r.shard for r in rows} == set(range(24)) and {r.grown_shard for r in rows} == {None}


def test_keys_may_be_text(spark):
    df = spark.createDataFrame([(f"d-{i}", f"words {i} " * (1 + i % 9), "s", "en") for i in range(200)] + [(None, "x", None, None)], "doc_id string, text string, source string, lang string")
    found = sharding.shard(df, shards=5).collect()
    assert len(found) == 201 and {r.shard for r in found} == set(range(5))
    sizes = [sum(r["size"] for r in found if r.shard == s) for s in range(5)]
    assert max(sizes) < 1.5 * min(sizes)
