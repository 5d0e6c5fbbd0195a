from __future__ import annotations

import random
import re
from itertools import combinations

import numpy as np
import pytest

from casebook.llm import ngram_join
from casebook.llm.common import Scratch, components, key_filter, may_hold, without
from tests.llm.frames import documents, edge_documents, empty

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    take = min(size, len(words))
    return frozenset(tuple(words[i : i + take]) for i in range(len(words) - take + 1)) if words else frozenset()


class Union(dict):
    def find(self, x):
        while self.setdefault(x, x) != x:
            x = self[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self[max(a, b)] = min(a, b)


def expected(rows, size, num, den):
    sets = {k: shingle_set(t, size) for k, t in rows}
    union = Union()
    for a, b in combinations(sets, 2):
        if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
            union.join(a, b)
    return {k: (len(s), union.find(k)) for k, s in sets.items()}


def near_copies(seed, families=14):
    random.seed(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(families):
        base = [random.choice(vocabulary) for _ in range(random.randrange(3, 150))]
        for _ in range(random.randrange(1, 22)):
            copy = list(base)
            for _ in range(random.randrange(0, 1 + len(copy) // 20)):
                at = random.randrange(len(copy))
                copy[at : at + 1] = random.choice([[], [random.choice(vocabulary)], [copy[at], random.choice(vocabulary)]])
            texts.append(random.choice([" ", "\n", " \t"]).join(copy))
    texts += [None, "", " \n", "a", "A", "a b", "a  b", "b a", "x y z", "X y\nz", "é É"]
    rows = list(enumerate(texts))
    random.shuffle(rows)
    return rows


@pytest.mark.parametrize(("size", "num", "den"), [(3, 90, 100), (5, 80, 100), (1, 50, 100)])
def test_all_links_are_found(spark, size, num, den):
    rows = near_copies(size)
    df = documents(spark, rows).repartition(3)
    found = ngram_join.near_duplicates(df, words=size, similarity=(num, den))
    want = expected(rows, size, num, den)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()} == want
    kept = ngram_join.deduplicate(df, words=size, similarity=(num, den))
    assert {r.doc_id for r in kept.collect()} == {c for _, c in want.values()}


def test_a_large_group_of_near_copies_and_a_common_passage(spark):
    """One group holds most rows; other rows share a passage with it and are not similar."""
    random.seed(5)
    base = [f"b{i}" for i in range(200)]
    rows = []
    for k in range(260):
        copy = list(base)
        copy[random.randrange(200)] = f"e{k}"
        rows.append((k, " ".join(copy)))
    for k in range(260, 330):
        rows.append((k, " ".join(base[:60] + [f"r{k}x{j}" for j in range(60)])))
    want = expected(rows, 3, 90, 100)
    found = ngram_join.near_duplicates(documents(spark, rows))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()} == want


def test_edge_rows_and_empty_table(spark):
    found = ngram_join.near_duplicates(edge_documents(spark)).collect()
    assert len(found) == 14
    assert {r.component_id for r in found if r.doc_id in (3, 4, 5)} == {3}
    assert [r.component_id for r in found if r.doc_id in (0, 1, 2)] == [0, 1, 2] or {r.component_id for r in found if r.doc_id in (0, 1, 2)} == {0, 1, 2}
    assert len(ngram_join.deduplicate(edge_documents(spark)).collect()) == 10
    assert ngram_join.near_duplicates(empty(edge_documents(spark))).count() == 0
    assert ngram_join.deduplicate(empty(edge_documents(spark))).count() == 0


def test_long_text_is_hashed_in_parts(monkeypatch):
    text = "one two  three\nfour " * 50
    whole = ngram_join.word_hashes(text)
    monkeypatch.setattr(ngram_join, "PART_BYTES", 7)
    assert np.array_equal(whole, ngram_join.word_hashes(text))


def test_pair_overlap_is_exact(spark):
    from pyspark.sql import functions as F

    pairs = [(a, b) for a in range(1, 60) for b in range(1, 60)]
    df = spark.createDataFrame(pairs, "a long, b long")
    for num, den in ((90, 100), (80, 100)):
        found = df.select("a", "b", ngram_join.pair_overlap(F.col("a"), F.col("b"), num, den).alias("o")).collect()
        assert all(r.o == -(-(r.a + r.b) * num // (num + den)) for r in found)


def test_components(spark):
    random.seed(2)
    edges = [(random.randrange(900), random.randrange(900)) for _ in range(400)] + [(i, i + 1) for i in range(2000, 2060)]
    edges += [(5000, i) for i in range(5001, 5200)]
    union = Union()
    for a, b in edges:
        union.join(a, b)
    found = components(Scratch(spark, "test"), spark.createDataFrame(edges, "a long, b long"), "c")
    got = {r.id: r.component for r in found.collect()}
    assert {x: got.get(x, x) for x in union} == {x: union.find(x) for x in union}


def test_key_filter_lets_all_keys_pass(spark):
    scratch = Scratch(spark, "test")
    keys = scratch.store(spark.range(0, 5000, 3).withColumnRenamed("id", "row_id"), "keys")
    rows = spark.range(5000).withColumnRenamed("id", "row_id")
    held = key_filter(scratch, keys, "row_id", "bits")
    passed = {r.row_id for r in may_hold(rows, "row_id", held).collect()}
    assert passed >= set(range(0, 5000, 3)) and len(passed) < 2000
    assert sorted(r.row_id for r in without(rows, "row_id", keys, held).collect()) == [i for i in range(5000) if i % 3]
