from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from casebook.llm import decontaminate
from tests.llm.frames import documents, edge_documents, empty

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def expected(text, items, window):
    own, hit, found = words(text), set(), set()
    for item, item_text in items:
        other = words(item_text)
        size = min(window, len(other))
        for s in range(len(other) - size + 1 if size else 0):
            for at in range(len(own) - size + 1):
                if own[at : at + size] == other[s : s + size]:
                    hit |= set(range(at, at + size))
                    found.add(item)
    return len(own), hit, sorted(found)


def inside(spans):
    return {w for start, end in spans for w in range(start, end)}


@pytest.mark.parametrize("window", [1, 3, 5])
def test_shards_agree_with_brute_force(window):
    random.seed(window)
    for _ in range(60):
        letters = random.choice(["ab", "abcde", "abcdefghijklmnop"])
        text = lambda most: " ".join(random.choice(letters) for _ in range(random.randrange(most)))
        items = [(str(i), text(9)) for i in range(4)]
        docs = [text(50) for _ in range(6)]
        docs += docs[:2]
        windows = decontaminate.Windows(items, window)
        found = decontaminate.search_shard([decontaminate.symbols_of(d, windows.number) for d in docs], windows)
        for number, doc in enumerate(docs):
            spans, names = found.get(number, ([], []))
            _, hit, items_found = expected(doc, items, window)
            assert (inside(spans), names) == (hit, items_found)


def test_index_answers_like_plain_search():
    rng = np.random.default_rng(3)
    text = np.append(rng.integers(1, 5, 400), 0)
    index = decontaminate.FmIndex(text)
    for symbol in range(6):
        at = np.arange(len(text) + 1)
        order = decontaminate.suffix_array(text)
        last = text[order - 1]
        assert index.rank(np.full(len(at), symbol), at).tolist() == [int((last[:i] == symbol).sum()) for i in at]
    assert index.locate(np.arange(len(text))).tolist() == decontaminate.suffix_array(text).tolist()
    suffixes = sorted(range(len(text)), key=lambda i: text[i:].tolist())
    assert decontaminate.suffix_array(text).tolist() == suffixes


@pytest.mark.parametrize("slice_words", [1 << 20, 3])
def test_documents_and_slices(spark, slice_words):
    random.seed(9)
    make = lambda n: " ".join(f"W{random.randrange(40)}" for _ in range(n))
    items = [(i, make(random.randrange(4, 30))) for i in range(8)] + [(8, None), (9, ""), (10, "w1 w2")]
    rows = [(k, make(60)) for k in range(20)]
    rows += [(100 + i, f"{make(5)}, {t}! {make(3)}") for i, t in items if t] + [(200, None), (201, "--")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.with_hits(decontaminate.find(documents(spark, rows), bench, window=6, slice_words=slice_words, shard_words=100))
    got = {r.doc_id: r for r in found.collect()}
    assert len(got) == len(rows)
    for key, text in rows:
        n, hit, names = expected(text, [(str(i), t) for i, t in items], 6)
        assert (got[key].n_words, inside(got[key].spans), got[key].items, got[key].n_hit) == (n, hit, names, len(hit))
        assert got[key].contaminated == (len(hit) > 0 and 20 * len(hit) >= n)


def test_long_text_is_split(monkeypatch):
    numbers = {b"a": 2, b"bc": 3}
    text = "A bc, x a bc " * 40
    whole = decontaminate.symbols_of(text, numbers)
    monkeypatch.setattr(decontaminate, "PART_BYTES", 5)
    assert np.array_equal(whole, decontaminate.symbols_of(text, numbers))


def test_edge_rows_and_empty_tables(spark):
    bench = spark.createDataFrame([(None, "one short line"), (2, None), (3, "one short line")], "item_id long, text string")
    found = decontaminate.find(edge_documents(spark), bench)
    assert found.count() == 14
    assert decontaminate.clean(edge_documents(spark), bench).columns == edge_documents(spark).columns
    assert decontaminate.clean(edge_documents(spark), bench).count() == 9
    assert decontaminate.find(edge_documents(spark), empty(bench)).where("size(items) > 0").count() == 0
    assert decontaminate.find(empty(edge_documents(spark)), bench).count() == 0


def test_digest_of_no_item(spark):
    row = decontaminate.op8_decontamination(spark, "/root/testdata/sf0.001").where("n_items = 0").first()
    assert row.items_sha256 == hashlib.sha256(b"").hexdigest()
    assert not row.contaminated


def test_one_slice_is_fetched_at_a_time(spark):
    items = [(i, " ".join(f"w{i}x{k}" for k in range(40))) for i in range(30)]
    jobs = lambda: len(spark.sparkContext.statusTracker().getJobIdsForGroup("slices"))
    spark.sparkContext.setJobGroup("slices", "slices")
    try:
        count, parts = decontaminate.slices(spark.createDataFrame(items, "item_id long, text string"), "item_id", "text", 6, 50)
        before = jobs()
        first = next(parts)
        one = jobs() - before
        rest = list(parts)
        assert count > 10 and len(rest) == count - 1
        assert 1 <= one < jobs() - before - one
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert sorted(first + [r for part in rest for r in part]) == sorted((str(i), t) for i, t in items)


def test_long_items_are_cut_into_the_same_windows(spark):
    text = ", ".join(f"Wé{k}" for k in range(1000)) + "!"
    bench = spark.createDataFrame([("long", text), ("none", "")], "item_id string, text string")
    count, parts = decontaminate.slices(bench, "item_id", "text", 6, 20)
    found = [t for part in parts for _, t in part]
    windows = lambda words: {tuple(words[i : i + 6]) for i in range(len(words) - 5)}
    assert count > 10 and max(len(decontaminate.words_of(t)) for t in found) <= 20
    assert set().union(*(windows(decontaminate.words_of(t)) for t in found)) == windows(decontaminate.words_of(text))
    assert all(len(decontaminate.words_of(t)) >= 6 for t in found if t)


def test_copies_of_an_item_are_fetched_once(spark):
    items = spark.createDataFrame([(1, "one two three")] * 500 + [(2, "one two three"), (3, None)], "item_id long, text string")
    count, parts = decontaminate.slices(items, "item_id", "text", 13, 1 << 20)
    assert count == 1 and list(parts) == [[("1", "one two three"), ("2", "one two three")]]
    found = decontaminate.find(documents(spark, [(1, "zero one two three four")]), items).first()
    assert found["items"] == ["1", "2"]
