"""Packing documents into training sequences of balanced attention cost.

A piece of n tokens costs ``linear * n + quadratic * n * n``, as attention stays inside a document. Per
group of documents, full sequences are cut from documents longer than one; the rest is taken by falling
cost, each to the sequence of lowest cost that has room for it. What then fits nowhere whole is cut over
the remaining room. A group's sequences have together exactly as much room as the group has tokens: all
are full but the last few, which are powers of two, so that nothing is padded.

* Groups are made of the documents of a task as they come, ``group_tokens`` at a time: no shuffle, and
  memory for one group and the longest document. A hot source is rows like any others.
* Null text is empty: the document is its end token alone. Repeated rows and repeated keys are documents
  of their own. Extra columns do not matter. An empty table gives no piece.
* Equal costs: the document that came first, the sequence opened first.
* ``sequence_id`` holds the task's number in its upper bits; write the result before using it twice.
"""

from __future__ import annotations

import base64
import heapq
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from casebook.llm.common import narrow, query, table, text_batches

TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
CAPACITY = 2048
END_ID = 1
LINEAR_COST = 1.0
QUADRATIC_COST = 1.0 / 1024  # of a token pair, against a token
GROUP_TOKENS = 1 << 22


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit integers.

    ``path`` is a file for ``tokenizers``. With ``ranks``, the same vocabulary as a rank file, texts are
    encoded by ``tiktoken``, which gives the same ids several times as fast (tests compare both on all
    code points); texts that hold a special token always go through ``tokenizers``, and so do those that
    ``tiktoken`` refuses: its pattern runs out of stack on runs of about a million characters of white space.
    """

    def __init__(self, path: str, ranks: str | None = None):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.fast = None
        if ranks:
            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})

    def __call__(self, text: str) -> bytes:
        if self.fast and not any(s in text for s in self.special):
            try:
                return np.asarray(self.fast.encode_to_numpy(text, allowed_special=set(), disallowed_special=()), "<u4").tobytes()
            except ValueError:
                pass
        return np.asarray(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4").tobytes()


def rooms(tokens: int, capacity: int) -> list[int]:
    """Sizes of sequences that hold exactly ``tokens``: full ones, then powers of two."""
    left = tokens % capacity
    return [capacity] * (tokens // capacity) + [1 << b for b in reversed(range(left.bit_length())) if left >> b & 1]


def balance(lengths: list[int], capacity: int, linear: float, quadratic: float) -> list[list[tuple[int, int, int]]]:
    """Pieces ``(document, start, length)`` of each sequence of one group."""
    sequences: list[list[tuple[int, int, int]]] = []
    rest = []
    for doc, n in enumerate(lengths):
        for start in range(0, n - n % capacity, capacity):
            sequences.append([(doc, start, capacity)])
        if n % capacity:
            rest.append((n % capacity, doc, n - n % capacity))
    sizes = rooms(sum(n for n, _, _ in rest), capacity)
    base = len(sequences)
    sequences += [[] for _ in sizes]
    # sequences by the room they have left, cheapest first in each; lowest[r] is the cheapest with room r
    heaps: list[list[tuple[float, int]]] = [[] for _ in range(capacity + 1)]
    lowest = np.full(capacity + 1, np.inf)
    for i, size in enumerate(sizes):
        heaps[size].append((0.0, i))
        lowest[size] = 0.0

    def put(room: int, doc: int, start: int, n: int) -> None:
        cost, i = heapq.heappop(heaps[room])
        lowest[room] = heaps[room][0][0] if heaps[room] else np.inf
        sequences[base + i].append((doc, start, n))
        if room > n:
            cost += linear * n + quadratic * n * n
            heapq.heappush(heaps[room - n], (cost, i))
            lowest[room - n] = heaps[room - n][0][0]

    spread = []
    for n, doc, start in sorted(rest, key=lambda r: -r[0]):  # falling length is falling cost
        room = n + int(lowest[n:].argmin())
        if lowest[room] < np.inf:
            put(room, doc, start, n)
        else:
            spread.append((n, doc, start))
    widest = capacity
    for n, doc, start in spread:
        while n:
            while not heaps[widest]:
                widest -= 1
            take = min(n, widest)
            put(widest, doc, start, take)
            n, start = n - take, start + take
            widest = capacity if take < widest else widest
    return sequences


def pack(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    tokenizer: str | None = None,
    ranks: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    linear: float = LINEAR_COST,
    quadratic: float = QUADRATIC_COST,
    group_tokens: int = GROUP_TOKENS,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: ``key, start, length, ids_crc32, doc_tokens, sequence_id, offset`` and, if asked for, ``ids``.

    ``tokenizer`` and ``ranks`` are files that every executor can read; by default those of the installed package.
    """
    text_batches(docs.sparkSession)
    source = narrow(docs, key, text).toDF("key", "text")
    key_type = source.schema["key"].dataType.simpleString()

    def run(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = Encoder(tokenizer, ranks) if tokenizer else Encoder(*map(public_tokenizers.path, (TOKENIZER, RANKS)))
        sequence = TaskContext.get().partitionId() << 36
        end = np.array([end_id], "<u4").tobytes()
        names = ["key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids

        def emit(keys, ids):
            nonlocal sequence
            rows: list[list] = [[] for _ in names]
            for pieces in balance([len(b) // 4 for b in ids], capacity, linear, quadratic):
                offset = 0
                for doc, start, n in pieces:
                    part = ids[doc][4 * start : 4 * (start + n)]
                    values = [keys[doc], start, n, zlib.crc32(part), len(ids[doc]) // 4, sequence, offset]
                    for column, value in zip(rows, values + [np.frombuffer(part, "<u4").tolist()] * with_ids):
                        column.append(value)
                    offset += n
                sequence += 1
                if len(rows[0]) >= 50_000:
                    yield record(rows)
                    rows = [[] for _ in names]
            yield record(rows)

        def record(rows):
            types = [key_arrow, *[pa.int64()] * 6, pa.list_(pa.int32())]
            return pa.RecordBatch.from_arrays([pa.array(r, t) for r, t in zip(rows, types)], names=names)

        keys, ids, held = [], [], 0
        key_arrow = pa.int64()
        for whole in batches:
            key_arrow = whole.schema.field(0).type
            for offset in range(0, whole.num_rows, 256):
                batch = whole.slice(offset, 256)
                for k, b in zip(batch.column(0).to_pylist(), map(encoder, [t or "" for t in batch.column(1).to_pylist()])):
                    keys.append(k)
                    ids.append(b + end)
                    held += len(b) // 4 + 1
                    if held >= group_tokens:
                        yield from emit(keys, ids)
                        keys, ids, held = [], [], 0
        if keys:
            yield from emit(keys, ids)

    fields = f"key {key_type}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return source.mapInArrow(run, fields + (", ids array<int>" if with_ids else "")).withColumnRenamed("key", key)


@query("op6_packing")
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
