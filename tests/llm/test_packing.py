from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from casebook.llm import packing
from tests.llm.frames import documents, edge_documents, empty

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))


@pytest.fixture(scope="module")
def encoder():
    return packing.Encoder(*map(public_tokenizers.path, (packing.TOKENIZER, packing.RANKS)))


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [packing.END_ID]


def test_encoder_gives_the_ids_of_the_tokenizer(tokenizer, encoder):
    points = [c for c in range(0x3100) if not 0xD800 <= c < 0xE000] + list(range(0x3100, 0x110000, 1009))
    texts = [f"a{chr(c)}b {chr(c)}1  {chr(c)} x{chr(c)}{chr(c)}'{chr(c)}s" for c in points if not 0xD800 <= c < 0xE000]
    random.seed(1)
    parts = ["a", " ", "  ", "\n", "'s", "<|endoftext|>", "\x1c", "é", "1", "日", ".", " "]
    texts += ["".join(random.choice(parts) for _ in range(random.randrange(12))) for _ in range(3000)]
    for text, found in zip(texts, tokenizer.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(encoder(text), "<u4").tolist() == found.ids, repr(text)


@pytest.mark.parametrize("capacity", [1, 8, 64])
def test_groups_are_full_and_whole(capacity):
    random.seed(capacity)
    for _ in range(40):
        lengths = [random.randrange(1, 4 * capacity) for _ in range(random.randrange(1, 80))]
        sequences = packing.balance(lengths, capacity, 1.0, 0.01)
        sizes = [sum(n for _, _, n in s) for s in sequences]
        assert all(n == capacity or n & (n - 1) == 0 for n in sizes) and 0 not in sizes
        pieces = sorted(p for s in sequences for p in s)
        reached = defaultdict(int)
        for doc, start, n in pieces:
            assert start == reached[doc] and n > 0
            reached[doc] += n
        assert [reached[d] for d in range(len(lengths))] == lengths


def test_costs_are_balanced():
    random.seed(3)
    lengths = [random.randrange(20, 400) for _ in range(4000)]
    cost = [sum(n + n * n / 1024 for _, _, n in s) for s in packing.balance(lengths, 2048, 1.0, 1 / 1024)][:-12]
    assert max(cost) < 1.25 * sum(cost) / len(cost)


def test_pieces_read_back(spark, tokenizer):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = packing.pack(docs, with_ids=True, group_tokens=20_000).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length
        pieces[r.doc_id].append((r.start, r.ids, r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length))
    for key, text in texts.items():
        found = [i for _, ids, _ in sorted(pieces[key]) for i in ids]
        assert found == ids_of(tokenizer, text)
        assert {n for _, _, n in pieces[key]} == {len(found)}
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    padding = sum(0 if s & (s - 1) == 0 else packing.CAPACITY - s for s in (sum(n for _, n in p) for p in sequences.values()))
    assert padding == 0


def test_edge_rows_and_empty_table(spark, tokenizer):
    rows = packing.pack(edge_documents(spark)).collect()
    assert sum(r.length for r in rows) == sum(len(ids_of(tokenizer, r[1])) for r in edge_documents(spark).collect())
    assert [r.length for r in rows if r.doc_id == 0] == [1]
    assert packing.pack(empty(edge_documents(spark))).count() == 0
    assert packing.pack(documents(spark, [(1, "one text")]), ranks=None, tokenizer=public_tokenizers.path(packing.TOKENIZER)).count() >= 1


LONG_RUNS = [" " * 2_000_000, "\n" * 2_000_000, " \n" * 1_000_000, "words" + "\n\t" * 1_000_000, " " * 2_000_000 + "words"]


@pytest.mark.parametrize("text", LONG_RUNS, ids=["spaces", "line feeds", "both", "at the end", "at the start"])
def test_long_runs_of_white_space(tokenizer, encoder, text):
    assert np.array_equal(np.frombuffer(encoder(text), "<u4"), tokenizer.encode(text, add_special_tokens=False).ids)


def test_documents_of_white_space_are_packed(spark, tokenizer):
    rows = packing.pack(documents(spark, list(enumerate(["one text", *LONG_RUNS[:3]])))).collect()
    lengths = defaultdict(int)
    for r in rows:
        lengths[r.doc_id] += r.length
    assert lengths == {k: len(ids_of(tokenizer, t)) for k, t in enumerate(["one text", *LONG_RUNS[:3]])}
