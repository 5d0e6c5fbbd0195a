from __future__ import annotations

import glob
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from casebook.llm import token_files
from tests.llm.frames import documents, edge_documents, empty

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path(token_files.TOKENIZER))


@pytest.fixture(scope="module")
def encoder():
    return token_files.Encoder(public_tokenizers.path(token_files.TOKENIZER), token_files.END_ID)


def expected(tokenizer, rows):
    """Rows ``(key, text)`` in order, by the tokenizer alone."""
    found, start = [], 0
    for key, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [token_files.END_ID]
        found.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return found


def read_back(spark, df, path, **options):
    token_files.write(df, path, **options)
    rows = token_files.read(spark, path).collect()
    return sorted((tuple(r) for r in rows), key=lambda r: r[1])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), min_size=1, max_size=300), st.sampled_from([0.0, 0.5, 0.9, 0.95, 1.0]))
def test_blocks_round_trip(values, percentile):
    values = np.array(values, np.uint32)
    blocks = token_files.packed(values.reshape(1, -1), percentile) + token_files.packed(np.stack([values, values[::-1]]), percentile)
    back = token_files.unpacked([memoryview(b) for b in blocks])
    assert back.tolist() == [*values.tolist(), *values.tolist(), *values[::-1].tolist()]


def test_exceptions_keep_blocks_narrow():
    values = np.array([[5] * 1000 + [2**31] * 24], np.uint32)
    assert len(token_files.packed(values, 0.95)[0]) < 200
    assert len(token_files.packed(values, 1.0)[0]) > 3900


def test_a_file_gives_any_range():
    random.seed(2)
    ids = np.array([random.choice([3, 40, 49000]) for _ in range(5000)], np.uint32)
    content = token_files.file_bytes(pa.array([7, None]), np.array([4000, 1000]), ids, 3, 1, 256, 0.9) + b"\n"
    file = token_files.File(content)
    assert (file.partition, file.number, file.documents, file.length) == (3, 1, 2, 5000)
    assert file.table.to_pydict() == {"key": [7, None], "n_tokens": [4000, 1000]}
    for _ in range(200):
        start, end = sorted(random.randrange(5001) for _ in range(2))
        assert file.ids(start, end).tolist() == ids[start:end].tolist()
    with pytest.raises(ValueError):
        token_files.File(content[:-1])


def test_encoder_gives_the_ids_of_the_tokenizer(tokenizer, encoder):
    points = [c for c in range(0x3100) if not 0xD800 <= c < 0xE000] + list(range(0x3100, 0x110000, 1009))
    texts = [f"a{chr(c)}b {chr(c)}1  {chr(c)} x{chr(c)}{chr(c)}'{chr(c)}s\t{chr(c)}" for c in points if not 0xD800 <= c < 0xE000]
    random.seed(1)
    parts = ["a", "B", "É", " ", "  ", "\n", "'s", "'S", "<|endoftext|>", "<|ENDOFTEXT|>", "<", "|", "\x0b", "\x1c", "é", "é", "̸", "1", "日", ".", "</w>", "　", None]
    texts += [None if (p := random.choices(parts, k=random.randrange(12)))[:1] == [None] else "".join(x or "" for x in p) for _ in range(6000)]
    ids, counts = encoder(pa.array(texts, pa.string()))
    ends = np.cumsum(counts)
    assert encoder.by_piece and encoder.plain is not encoder.tokenizer
    for text, end, n, found in zip(texts, ends, counts, tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)):
        assert ids[end - n : end].tolist() == found.ids + [token_files.END_ID], repr(text)


def test_other_tokenizers_get_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder = token_files.Encoder(path, 7)
    texts = ["Two  words", None, "x"]
    ids, counts = encoder(pa.array(texts))
    whole = [Tokenizer.from_file(path).encode(t or "", add_special_tokens=False).ids + [7] for t in texts]
    assert not encoder.by_piece
    assert ids.tolist() == [i for w in whole for i in w] and counts.tolist() == [len(w) for w in whole]


@pytest.mark.parametrize("file_ids", [1, 50, 1 << 21])
def test_files_agree_with_brute_force(spark, run_dir, tokenizer, file_ids):
    random.seed(file_ids)
    rows = [(k, " ".join(random.choices(["Über", "the", "pack,", "12", "\n"], k=random.randrange(40)))) for k in random.sample(range(-500, 500), 90)]
    rows += [(600, None), (601, ""), (602, "long words " * 20000)]
    df = documents(spark, rows).repartition(7)
    assert read_back(spark, df, run_dir, file_ids=file_ids, block=64) == expected(tokenizer, sorted(rows))
    files = [token_files.File(open(f, "rb").read()) for f in sorted(glob.glob(f"{run_dir}/part-*")) if open(f, "rb").read(1)]
    assert sum(f.documents for f in files) == len(rows)
    assert all(f.length - f.table.column("n_tokens")[-1].as_py() < file_ids for f in files)


def test_ids_are_read_back(spark, run_dir, tokenizer):
    rows = [(2, "second text"), (1, "First, then."), (3, None)]
    token_files.write(documents(spark, rows), run_dir)
    found = {r.key: r.ids for r in token_files.read(spark, run_dir, with_ids=True).collect()}
    assert found == {k: tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for k, t in rows}


def test_edge_rows(spark, run_dir, tokenizer):
    df = edge_documents(spark)
    found = read_back(spark, df, run_dir)
    assert len(found) == df.count()
    assert found[0][0] is None and [r[0] for r in found[1:]] == sorted(r[0] for r in found[1:])
    assert [a[1] + a[2] for a in found[:-1]] == [b[1] for b in found[1:]]
    texts = [(r[0], r[1]) for r in df.collect()]
    single = sorted((k, n, crc) for k, _, n, crc in expected(tokenizer, texts) if k is not None)
    assert sorted((k, n, crc) for k, _, n, crc in found if k is not None) == single


def test_many_rows_of_one_key(spark, run_dir, tokenizer):
    rows = [(5, "equal rows")] * 300 + [(5, f"row {i}") for i in range(300)] + [(4, "before"), (6, "after")]
    found = read_back(spark, documents(spark, rows).repartition(8), run_dir)
    assert (found[0][0], found[-1][0], len(found)) == (4, 6, len(rows))
    total = sum(r[2] for r in expected(tokenizer, rows))
    assert found[-1][1] + found[-1][2] == total


def test_empty_table(spark, run_dir):
    assert read_back(spark, empty(edge_documents(spark)), run_dir) == []


def test_keys_may_be_text(spark, run_dir):
    df = spark.createDataFrame([("b", "x"), ("a", "y"), (None, "z")], "doc_id string, text string")
    token_files.write(df, run_dir)
    found = token_files.read(spark, run_dir, df.schema["doc_id"].dataType).collect()
    assert [r.key for r in sorted(found, key=lambda r: r.start)] == [None, "a", "b"]


def test_query_covers_the_table(spark, tokenizer):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    found = token_files.op11_token_files(spark, SF)
    assert found.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(tuple(r) for r in found.collect()) == sorted(expected(tokenizer, sorted(rows)))
