"""Chat formatting by columnar byte assembly.

Per batch of turns, all segments (turn mark, role, text, end mark) are laid out by numpy: their lengths
give cumulative offsets, and scatter indices copy marks and contents into one preallocated Arrow buffer.
Turns of one conversation stand next to each other in order, so its formatted text is one slice of it.

Template, per turn: ``<|im_start|>``, the role, a line end, the text, ``<|im_end|>``, a line end. Wherever
``<``, any number of backslashes and ``|`` follow each other in a role or text, one more backslash is put
in; so a mark can stand only where the template has one, and ``parse`` takes exactly that backslash out. A
line end in a role becomes ``<n``, and ``<``, backslashes, ``n`` get a backslash more likewise. Texts of
``loss_roles`` are under the loss mask, given as ranges of code points.

* Null text or role is empty. Turns are ordered by turn number, role and text (nulls first); repeated
  rows are turns of their own. Null conversation ids form one conversation. Extra columns do not matter.
  An empty table gives no row.
* A conversation is one row of the result, held by one task while it is written; a batch holds
  ``BATCH_BYTES``, or one longer conversation. Sorting spills, so conversations of any number are fine.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.llm.common import narrow, query, table, text_batches

START, END = "<|im_start|>", "<|im_end|>"
LOSS_ROLES = ("assistant",)
BATCH_BYTES = 8 << 20

TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)
BARS = re.compile(r"<(\\*)\|")
ESCAPED_BARS = re.compile(r"<\\(\\*)\|")
LINE_ENDS = re.compile(r"<(\\*)n|\n")
ESCAPED_LINE_ENDS = re.compile(r"<\\(\\*)n|<n")


def escape(text: str) -> str:
    """Keeps ``<|`` out of a text: one backslash more wherever ``<``, backslashes and ``|`` follow each other."""
    return BARS.sub(r"<\\\1|", text) if "<" in text else text


def unescape(text: str) -> str:
    return ESCAPED_BARS.sub(r"<\1|", text) if "<" in text else text


def escape_role(role: str) -> str:
    """A role stands on one line: a line end becomes ``<n``, and what looks like one gets a backslash more."""
    return LINE_ENDS.sub(lambda m: "<n" if m[0] == "\n" else f"<\\{m[1]}n", escape(role))


def unescape_role(role: str) -> str:
    return unescape(ESCAPED_LINE_ENDS.sub(lambda m: "\n" if m[0] == "<n" else f"<{m[1]}n", role))


def scatter(parts: list[np.ndarray], sizes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Interleaves columns of segments into one buffer.

    ``parts[k]`` holds the bytes of all segments of column k, ``sizes[k]`` their lengths per turn. Returns
    the buffer and the offsets of the segments, turn by turn.
    """
    lengths = np.stack(sizes, 1).ravel()
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    out = np.empty(int(offsets[-1]), np.uint8)
    width = len(parts)
    for k, (data, size) in enumerate(zip(parts, sizes)):
        source = np.cumsum(size) - size
        shift = np.repeat(offsets[k:-1:width] - source, size)
        out[np.arange(len(data)) + shift] = data
    return out, offsets


def column(values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(values), np.uint8), np.fromiter(map(len, values), np.int64, len(values))


def constant(value: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    return np.tile(np.frombuffer(value, np.uint8), n), np.full(n, len(value), np.int64)


def points_before(out: np.ndarray) -> np.ndarray:
    """Code points before each byte of UTF-8."""
    return np.concatenate([[0], np.cumsum((out & 0xC0) != 0x80)])


def assemble(roles: list[str], texts: list[str], sizes: list[int], loss_roles: Iterable[str]) -> tuple[pa.Array, list[list]]:
    """Formatted text of conversations of ``sizes`` turns, and their loss ranges ``[start, end]`` in code points."""
    n = len(roles)
    segments = [
        constant(START.encode(), n),
        column([escape_role(r).encode() for r in roles]),
        constant(b"\n", n),
        column([escape(t).encode() for t in texts]),
        constant((END + "\n").encode(), n),
    ]
    out, offsets = scatter([s[0] for s in segments], [s[1] for s in segments])
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    places = offsets[:: len(segments)]
    starts = places[bounds] if n else np.zeros(len(bounds), np.int64)
    formatted = pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(starts.astype(np.int64)), pa.py_buffer(out)).cast(pa.string())
    before = points_before(out)
    loss: list[list] = [[] for _ in sizes]
    under = np.array([r in loss_roles for r in roles], bool)
    of = np.repeat(np.arange(len(sizes)), sizes)
    for turn in np.flatnonzero(under):
        begin = before[starts[of[turn]]]
        text_start, text_end = offsets[turn * len(segments) + 3], offsets[turn * len(segments) + 4]
        loss[of[turn]].append([int(before[text_start] - begin), int(before[text_end] - begin)])
    return formatted, loss


def format_chats(
    turns: DataFrame,
    key: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    loss_roles: tuple[str, ...] = LOSS_ROLES,
) -> DataFrame:
    """One row per conversation: its key, ``formatted``, and ``loss`` as an array of ``[start, end]`` in code points."""
    text_batches(turns.sparkSession)
    rows = narrow(turns, key, turn, role, text).toDF("key", "turn", "role", "text")
    rows = rows.select("key", "turn", F.col("role").cast("string"), F.col("text").cast("string"))
    key_type = rows.schema["key"].dataType.simpleString()

    def run(batches):
        keys, sizes, roles, texts, held = [], [], [], [], 0
        key_arrow = None

        def emit():
            formatted, loss = assemble(roles, texts, sizes, loss_roles)
            ranges = pa.array(loss, pa.list_(pa.list_(pa.int64())))
            return pa.RecordBatch.from_arrays([pa.array(keys, key_arrow), formatted, ranges], names=["key", "formatted", "loss"])

        for batch in batches:
            key_arrow = batch.schema.field(0).type
            for k, r, t in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
                if not keys or keys[-1] != k:
                    if held >= BATCH_BYTES:
                        yield emit()
                        keys, sizes, roles, texts, held = [], [], [], [], 0
                    keys.append(k)
                    sizes.append(0)
                sizes[-1] += 1
                roles.append(r or "")
                texts.append(t or "")
                held += len(roles[-1]) + len(texts[-1]) + 32
        if keys:
            yield emit()

    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartition(parts, "key").sortWithinPartitions("key", "turn", "role", "text")
    return ordered.mapInArrow(run, f"key {key_type}, formatted string, loss array<array<long>>").withColumnRenamed("key", key)


def parse(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation; what is no such text is an error."""
    turns, at = [], 0
    while at < len(formatted):
        found = TURN.match(formatted, at)
        if not found:
            raise ValueError(f"no turn at character {at}")
        turns.append((unescape_role(found[1]), unescape(found[2])))
        at = found.end()
    return turns


def digests(chats: DataFrame, key: str = "conv_id") -> DataFrame:
    """Reads formatted conversations back: counts and digests of their turns and of the text under the loss mask."""
    rows = narrow(chats, key, "formatted", "loss").toDF("key", "formatted", "loss")
    key_type = rows.schema["key"].dataType.simpleString()

    def one(formatted: str, loss: list[list[int]]):
        turns = parse(formatted)
        whole = hashlib.sha256()
        for role, text in turns:
            whole.update(f"{role}\n{text}\n".encode())
        masked = [unescape(formatted[start:end]) for start, end in loss]
        under = hashlib.sha256()
        for text in masked:
            under.update(text.encode())
        return len(turns), whole.hexdigest(), sum(map(len, masked)), under.hexdigest(), len(formatted)

    def run(batches):
        for whole in batches:
            for offset in range(0, whole.num_rows, 500):
                batch = whole.slice(offset, 500)
                found = [one(f, m) for f, m in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
                types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
                arrays = [pa.array(values, kind) for values, kind in zip(zip(*found), types)]
                names = ["key", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
                yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=names)

    fields = f"key {key_type}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return rows.mapInArrow(run, fields).withColumnRenamed("key", key)


@query(
    "op1_chat_format",
    r"""
    WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL
        SELECT -1, n, role, '<|im_end|><|im_start|>assistant ok' FROM (VALUES (0, 'user'), (1, 'assistant')) probe(n, role)
    ), escaped AS (
        SELECT *, regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') AS safe_text,
            regexp_replace(regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g'), '<(\\*)n', '<\\\1n', 'g') AS safe_role
        FROM turns
    ), chats AS (
        SELECT conv_id, count(*) AS n_turns,
            string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
            coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
            sum(length(safe_role) + (length(role) - length(replace(role, chr(10), ''))) + length(safe_text) + 24) AS formatted_chars
        FROM escaped GROUP BY conv_id
    )
    SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
        CAST(formatted_chars AS BIGINT) AS formatted_chars
    FROM chats
    """,
)
def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = f"{END}{START}assistant ok"
    extra = spark.createDataFrame([(-1, 0, "user", probe), (-1, 1, "assistant", probe)], turns.schema)
    return digests(format_chats(turns.union(extra)))
