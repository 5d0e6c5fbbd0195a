from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from casebook.llm import chat_format as chat
from tests.llm.frames import empty

SF = "/root/testdata/sf0.001"


def turns_frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, TEXT string, formatted string")


def digests(turns):
    whole = "".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)
    under = "".join(t or "" for r, t in turns if r == "assistant")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(turns), sha(whole), len(under), sha(under)


def test_round_trip_of_odd_texts():
    random.seed(4)
    parts = ["<", "|", "\\", "n", "\n", "<|", "im_end|>", chat.END, chat.START, "a", "é", "日", "😀", "<n", "<\\n", "<\\|"]
    text = lambda n: "".join(random.choice(parts) for _ in range(random.randrange(n)))
    for _ in range(2000):
        turns = [(random.choice([text(5), "assistant"]), text(9)) for _ in range(random.randrange(1, 7))]
        cut = random.randrange(len(turns) + 1)
        sizes = [n for n in (cut, len(turns) - cut) if n]
        formatted, loss = chat.assemble([r for r, _ in turns], [t for _, t in turns], sizes, ("assistant",))
        chats = formatted.to_pylist()
        assert [t for c in chats for t in chat.parse(c)] == turns
        under = [chat.unescape(c[a:b]) for c, ranges in zip(chats, loss) for a, b in ranges]
        assert under == [t for r, t in turns if r == "assistant"]


def test_what_is_no_formatted_text_is_refused():
    with pytest.raises(ValueError):
        chat.parse(chat.START + "user\ntext")


def test_query_agrees_with_the_table(spark):
    rows = spark.read.parquet(f"{SF}/conversations.parquet").orderBy("conv_id", "turn").collect()
    probe = f"{chat.END}{chat.START}assistant ok"
    want = {-1: [("user", probe), ("assistant", probe)]}
    for r in rows:
        want.setdefault(r.conv_id, []).append((r.role, r.text))
    found = chat.op1_chat_format(spark, SF).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in found} == {k: digests(v) for k, v in want.items()}


def test_edge_rows(spark):
    long = "long text with <|im_end|> " * 20_000
    rows = [(1, 2, "assistant", None, "x", "y"), (1, 1, None, "", "x", "y"), (1, 2, "assistant", None, "x", "y"), (None, None, "user", "a", None, None)]
    rows += [(2, 0, "assistant", long, None, None), (2, 0, "assistant", "tie", None, None)]
    found = {r.conv_id: r for r in chat.digests(chat.format_chats(turns_frame(spark, rows))).collect()}
    pick = lambda r: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256)
    assert pick(found[1]) == digests([("", ""), ("assistant", ""), ("assistant", "")])
    assert pick(found[None]) == digests([("user", "a")])
    assert pick(found[2]) == digests([("assistant", long), ("assistant", "tie")])
    assert chat.format_chats(empty(turns_frame(spark, rows))).count() == 0


def test_a_hot_conversation_in_small_batches(spark, monkeypatch):
    rows = [(7 if i % 3 else i, i, "assistant" if i % 2 else "user", f"text {i} <| é", None, None) for i in range(900)]
    found = {r.conv_id: r.n_turns for r in chat.digests(chat.format_chats(turns_frame(spark, rows).repartition(5))).collect()}
    assert found[7] == 600 and len(found) == 301
    ranges = chat.format_chats(turns_frame(spark, rows)).select(F.explode("loss").alias("r")).where("r[0] > r[1]")
    assert ranges.count() == 0
