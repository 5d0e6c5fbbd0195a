from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import pytest

from casebook.llm import exact_dedup
from tests.llm.frames import by_key, documents, edge_documents, empty

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(rows):
    groups = defaultdict(list)
    for key, text in rows:
        groups[(text or "").translate(UPPER)].append(key)
    return {k: (max(keys), len(keys), k == max(keys), hashlib.sha256(t.encode()).hexdigest()) for t, keys in groups.items() for k in keys}


@pytest.mark.parametrize("block", [1, 3, 64])
def test_naming_agrees_with_brute_force(spark, block):
    random.seed(block)
    texts = ["".join(random.choice("abAé") for _ in range(random.randrange(9))) for _ in range(150)]
    texts += ["ab" * n for n in range(20)] + ["AB" * 7, "x" * 5000, "x" * 5000, "x" * 4999 + "y", None, ""]
    rows = list(enumerate(texts))
    found = exact_dedup.groups(documents(spark, rows), block=block)
    assert {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in found.collect()} == expected(rows)


def test_edge_rows(spark):
    found = exact_dedup.groups(edge_documents(spark)).collect()
    assert len(found) == 14
    assert sorted((r.doc_id, r.kept) for r in found if r.group_size == 5) == [(3, False), (3, False), (4, False), (4, False), (5, True)]
    assert [(r.keep_id, r.kept) for r in found if r.doc_id is None] == [(None, True)]
    kept = exact_dedup.deduplicate(edge_documents(spark))
    assert kept.columns == edge_documents(spark).columns
    assert sorted(r[0] for r in kept.collect() if r[0] is not None) == [1, 2, 5, 6, 7, 8, 9, 40]


def test_repeated_rows_leave_one(spark):
    df = documents(spark, [(1, "same"), (1, "same"), (1, "Same")])
    assert exact_dedup.deduplicate(df).count() == 1
    assert sorted(r.kept for r in exact_dedup.groups(df).collect()) == [False, False, True]


def test_empty_table(spark):
    df = empty(edge_documents(spark))
    assert exact_dedup.groups(df).count() == 0
    assert exact_dedup.deduplicate(df).count() == 0


def test_no_python_in_the_plan(spark):
    plan = exact_dedup.groups(documents(spark, [(1, "a"), (2, "A")]))._jdf.queryExecution().toString()
    assert not [w for w in ("Python", "Pandas", "Arrow") if w in plan]
    assert by_key(exact_dedup.groups(documents(spark, [(1, "a"), (2, "A")])))[1]["keep_id"] == 2
