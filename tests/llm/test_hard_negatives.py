from __future__ import annotations

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from casebook.llm import hard_negatives
from casebook.llm.common import ENTRIES, Scratch

ROW = "vec_id long, label int, vector array<long>"


def expected(rows, step=10, positives=5, negatives=10, window=(30, 90)):
    """Rows ``(key, label, vector)``, all whole."""
    found = []
    pad = max((len(v) for _, _, v in rows), default=0)
    rows = [(k, label, np.array(v + [0] * (pad - len(v)), object)) for k, label, v in rows]
    for at, (key, label, vector) in enumerate(rows):
        if key % step:
            continue
        others = [(-int(vector @ v) if pad else 0, k, i, other) for i, (k, other, v) in enumerate(rows) if i != at]
        same = sorted(o for o in others if o[3] == label)[:positives]
        rest = sorted(o for o in others if o[3] != label)
        for score, positive, _, _ in same:
            fits = [o for o in rest if window[0] * -score <= 100 * -o[0] <= window[1] * -score][:negatives]
            found += [(key, positive, rank, o[1], -score, -o[0]) for rank, o in enumerate(fits, 1)]
    return found


def mined(spark, rows, step=10, **options):
    df = spark.createDataFrame(rows, ROW).repartition(3)
    return sorted(map(tuple, hard_negatives.mine(df, F.col("vec_id") % step == 0, **options).collect()))


def clustered(seed, many, dims, spread=4, groups=6):
    random.seed(seed)
    centres = [[random.randrange(-40, 40) for _ in range(dims)] for _ in range(groups)]
    return [(i, random.randrange(3), [c + random.randrange(-spread, spread + 1) for c in random.choice(centres)]) for i in range(many)]


@pytest.fixture
def small(monkeypatch):
    """Sizes that give many cells, parts, chunks, blocks and rounds."""
    for name, value in {"CELL_ROWS": 4, "CHUNK_ROWS": 5, "PART_ROWS": 10, "BLOCK_ANCHORS": 3, "FIRST_CELLS": 2, "GROWTH": 3}.items():
        monkeypatch.setattr(hard_negatives, name, value)


@pytest.mark.parametrize("dims, spread", [(8, 3), (2, 60), (5, 1)])
def test_agrees_with_brute_force(spark, small, dims, spread):
    rows = clustered(dims, 260, dims, spread)
    assert mined(spark, rows) == sorted(expected(rows))


def test_ties_copies_and_hot_vectors(spark, small):
    rows = clustered(7, 120, 4)
    rows += [(200 + i, i % 2, [9, 9, 9, 9]) for i in range(80)]
    rows += [(300, 1, [9, 9, 9, 9])] * 2 + [(301, 5, [0, 0, 0, 0]), (310, 9, [1, 2, 3, 4])]
    assert mined(spark, rows) == sorted(expected(rows))
    assert mined(spark, rows, positives=1, negatives=3, window=(50, 100)) == sorted(expected(rows, 10, 1, 3, (50, 100)))


def test_large_numbers_and_short_vectors(spark):
    random.seed(1)
    rows = [(i, i % 2, [random.randrange(-(10**7), 10**7) for _ in range(random.randrange(0, 5))]) for i in range(80)]
    assert mined(spark, rows) == sorted(expected(rows))
    assert mined(spark, [(10, 1, []), (1, 1, []), (2, 2, [])]) == [(10, 1, 1, 2, 0, 0)]


def test_visits_fall_and_cover_all_cells():
    rng = np.random.default_rng(3)
    books = rng.normal(size=(5, 3)), rng.normal(size=(4, 3))
    index = hard_negatives.Index(books, (rng.random(5), rng.random(4)), {c: 1 for c in range(20) if c != 7}, 6, "<i2", "float32")
    vector = np.array([1, -2, 3, 0, 1, 1])
    cells = list(hard_negatives.visits(index, vector, -math.inf))
    assert sorted(cells) == [c for c in range(20) if c != 7]

    def most(cell):
        halves = zip(books, index.radii, (vector[:3], vector[3:]), divmod(cell, 4))
        return sum(book[i] @ half + np.linalg.norm(half) * radius[i] for book, radius, half, i in halves)

    bounds = [most(c) for c in cells]
    assert bounds == sorted(bounds, reverse=True)
    assert list(hard_negatives.visits(index, vector, bounds[4])) == cells[:5]
    assert list(hard_negatives.visits(index, vector, math.inf)) == []


def test_few_cells_are_visited_where_rows_cluster(spark, small, monkeypatch):
    random.seed(5)
    rows = [(i, 0 if i < 400 else 1, [1000 * (g == i % 20) + random.randrange(20) for g in range(20)]) for i in range(800)]
    met = []
    scored = hard_negatives._scored
    monkeypatch.setattr(hard_negatives, "_scored", lambda df, *rest: met.append(df.select(F.sum(F.size("anchors") * F.size("rows"))).first()[0]) or scored(df, *rest))
    assert mined(spark, rows, 100) == sorted(expected(rows, 100))
    assert sum(met) < 0.8 * 2 * 8 * len(rows)


def test_rows_that_take_no_part(spark):
    nan, inf = math.nan, math.inf
    rows = [(10, 1, [1.0, 1.0]), (1, 1, [1.0, 0.9]), (2, 2, [0.5, 0.5]), (3, None, [0.5, 0.5]), (4, 2, None), (5, 2, [0.5, None]), (6, 2, [nan, 0.5])]
    rows += [(7, 2, [0.5, inf]), (8, 2, [-inf, 0.5]), (None, 2, [0.5, 0.5]), (20, None, [1.0, 1.0])]
    df = spark.createDataFrame([(*r, 0, "x") for r in rows], "vec_id long, label int, embedding array<float>, row long, KEY string")
    df = df.withColumn("vector", hard_negatives.scaled(F.col("embedding")))
    found = hard_negatives.mine(df, F.col("vec_id") % 10 == 0).collect()
    assert sorted(map(tuple, found)) == [(10, 1, 1, 2, 256 * 256 + 256 * 230, 2 * 256 * 128)]


def test_components_are_rounded_down(spark):
    df = spark.createDataFrame([([0.1, -0.1, 1 / 256, -1 / 512, 0.0],)], "e array<float>")
    assert df.select(hard_negatives.scaled(F.col("e"))).first()[0] == [25, -26, 1, -1, 0]


def test_empty_table(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, 1, [1, 2])]) == []


def test_keys_and_labels_may_be_text(spark):
    df = spark.createDataFrame([("a", "u", [2, 2]), ("b", "u", [2, 1]), ("c", "v", [1, 1])], "vec_id string, label string, vector array<long>")
    found = hard_negatives.mine(df, F.col("vec_id") == "a").collect()
    assert [tuple(r) for r in found] == [("a", "b", 1, "c", 6, 4)]


def test_every_row_is_indexed(spark, small):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(clustered(2, 200, 6))], "row long, key long, label int, vector array<long>")
    index, chunks = hard_negatives.build(Scratch(spark, "test"), df)
    rows = chunks.collect()
    assert sorted(k for r in rows for k in r["keys"]) == list(range(200))
    assert max(len(r["keys"]) for r in rows) <= hard_negatives.CHUNK_ROWS
    assert all(r.part < index.parts[r.cell] for r in rows)


def test_query_agrees_with_sql_on_a_larger_table(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    answer = con.execute(ENTRIES["op12_hard_negatives"].sql).fetchall()
    found = hard_negatives.op12_hard_negatives(spark, sf)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, found.collect())) == sorted(answer)
