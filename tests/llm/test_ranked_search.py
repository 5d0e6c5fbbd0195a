from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from casebook.llm import ranked_search
from tests.llm.frames import documents, edge_documents, empty

TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERMS.findall((text or "").translate(LOWER))


def expected(docs, items, k=10):
    bags = [(key, Counter(terms(text))) for key, text in docs]
    bags = [(key, bag, sum(bag.values())) for key, bag in bags if bag]
    n, total = len(bags), sum(size for _, _, size in bags)
    df = Counter(t for _, bag, _ in bags for t in bag)
    found = []
    for item, text in items:
        asked, scores = Counter(terms(text)), []
        for key, bag, size in bags:
            m = 100 - 75 + (75 * size * n) // total
            weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) for t in asked if t in bag}
            score = sum(asked[t] * w * ((1000000000 * bag[t]) // (1000 * bag[t] + 8 * m)) for t, w in weight.items())
            if score > 0:
                scores.append((-score, key is None, key or 0, key))
        found += [(item, rank, row[3], -row[0]) for rank, row in enumerate(sorted(scores)[:k], 1)]
    return found


def as_sorted(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def items_frame(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def random_rows(seed, many):
    random.seed(seed)
    vocabulary = [f"w{int(random.paretovariate(0.6))}" for _ in range(300)]
    text = lambda most: random.choice([" ", "-", ", "]).join(random.choices(vocabulary, k=random.randrange(most)))
    docs = [(k, text(60)) for k in range(many)]
    docs += [(many + k, docs[k % 7][1]) for k in range(many // 3)]
    return docs, [(i, text(25)) for i in range(30)]


def test_terms_are_split_as_stated():
    texts = [None, "", " .. ", "Ab-c1_é É\x7fx　y", "a\nA", "ÀÉ", "x" * 100000]
    found = [[t for t in row if t] for row in ranked_search.split(pa.array(texts)).to_pylist()]
    assert found == [terms(t) for t in texts]
    sliced = pa.array(["zero", "One two", None]).slice(1)
    assert [[t for t in row if t] for row in ranked_search.split(sliced).to_pylist()] == [["one", "two"], []]


@pytest.mark.parametrize("k", [1, 3, 10, 1000])
def test_a_shard_gives_the_best_of_all(k):
    random.seed(k)
    for _ in range(60):
        docs = random.randrange(1, 80)
        rows = [sorted(random.sample(range(12), random.randrange(1, 12))) for _ in range(docs)]
        flat = np.array([t for row in rows for t in row])
        counts = np.array([random.choice([1, 1, 2, 9]) for _ in flat])
        sizes = np.array([len(r) for r in rows])
        lengths = np.array([random.randrange(12, 60) for _ in rows])
        weights = np.array([random.choice([0, 1, 5, 900, 5000]) for _ in range(14)])
        shard = ranked_search.Shard(lengths, sizes, flat, counts, weights, (docs, int(lengths.sum())))
        item = [(t, random.choice([1, 2])) for t in random.sample(range(14), random.randrange(0, 8))]
        at, scores = 0, []
        for i, row in enumerate(rows):
            bag = dict(zip(row, counts[at : at + len(row)].tolist()))
            m = 25 + 75 * int(lengths[i]) * docs // int(lengths.sum())
            scores.append(sum(n * int(weights[t]) * (10**9 * bag[t] // (1000 * bag[t] + 8 * m)) for t, n in item if t in bag))
            at += len(row)
        best = sorted((-s, i) for i, s in enumerate(scores) if s > 0)[:k]
        found, values = shard.best(item, k)
        assert list(zip((-values).tolist(), found.tolist())) == best


@pytest.mark.parametrize("options", [{}, {"shard_postings": 1}, {"shard_postings": 60, "slice_bytes": 200}, {"k": 3}])
def test_search_agrees_with_brute_force(spark, options):
    docs, items = random_rows(5, 150)
    found = ranked_search.search(documents(spark, docs).repartition(5), items_frame(spark, items), **options)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert as_sorted(found.collect()) == as_sorted(expected(docs, items, options.get("k", 10)))


def test_ties_repeats_and_items_without_rows(spark):
    docs = [(k, "same words here") for k in range(30, 0, -1)] + [(99, "other thing"), (98, None), (97, "?!")]
    items = [(1, "words words"), (1, "thing"), (2, "words words"), (3, None), (4, ""), (5, "absent"), (None, "other")]
    found = ranked_search.search(documents(spark, docs).repartition(4), items_frame(spark, items)).collect()
    assert as_sorted(found) == as_sorted(expected(docs, items))
    assert [r.doc_id for r in sorted(found, key=lambda r: r.rank) if r.item_id == 2] == list(range(1, 11))


def test_edge_rows(spark):
    df = edge_documents(spark)
    docs = [(r[0], r[1]) for r in df.collect()]
    items = [(1, "one short line"), (2, "key of the"), (3, "é"), (4, "12345 texts")]
    extra = spark.createDataFrame([(*r, 7, "x") for r in items], "item_id long, text string, rank long, doc_id string")
    assert as_sorted(ranked_search.search(df, extra).collect()) == as_sorted(expected(docs, items))


def test_empty_tables(spark):
    docs, items = documents(spark, [(1, "a b")]), items_frame(spark, [(1, "a")])
    assert ranked_search.search(empty(docs), items).collect() == []
    assert ranked_search.search(docs, empty(items)).collect() == []
    assert ranked_search.search(docs, items_frame(spark, [(1, None), (2, "..")])).collect() == []


def test_no_shuffle_before_the_best(spark):
    docs = documents(spark, [(1, "a b")])
    shared = spark.sparkContext.broadcast(["a"])
    rows = ranked_search.tallies(docs.select(docs.doc_id.alias("key"), "text"), shared)
    plan = ranked_search._ranked_in_tasks(rows, shared, 10, 100)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_keys_may_be_text(spark):
    docs = spark.createDataFrame([("b", "x y"), ("a", "x y"), ("c", "z")], "doc_id string, text string")
    found = ranked_search.search(docs, items_frame(spark, [(1, "x")])).collect()
    assert [(r.doc_id, r.rank) for r in sorted(found, key=lambda r: r.rank)] == [("a", 1), ("b", 2)]
