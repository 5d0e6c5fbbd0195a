"""Multi-line CSV files too large for one task.

A line end is inside a field exactly when an odd number of quotes precedes it. The file is read as lines, in blocks of
``spark.sql.files.maxPartitionBytes``, twice:

1. A survey counts the quotes of each block, and splits it under both assumptions, that it starts outside and that it
   starts inside a field: the end of a record that began earlier, and the beginning of one that goes on. The counts of
   the blocks before then tell which assumption holds. The survey is stored, in the shared folder.
2. Each task parses the whole records of its blocks, as Arrow batches.

Records that cross the end of a block are put together from the survey and parsed by Spark. Pieces of more than
``PIECE_BYTES`` are left out of the survey, as the wrong assumption may take a whole block for one field; those that are
needed after all are read once more, under both assumptions and whole.

Counting is right only if every quote opens, closes or is doubled in a quoted field, so that is checked for all
quotes, as are stray line ends: any other file is an error and never yields other rows.
"""

from __future__ import annotations

import csv
import io
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.csv as pacsv
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casebook.session import shared_dir
from casebook.sources.landing import CSV_DIALECT, Layout, landing_layouts, united

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of the package

PIECE_BYTES = 1 << 16
OUT_OF_PLACE = "a quote or line end is out of place in "
QUOTE, COMMA, FEED, RETURN = b'",\n\r'


def scan_large(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str] | None = None,
    source_file: bool = True,
    layouts: Sequence[Layout] | None = None,
) -> DataFrame:
    """The rows of ``scan_landing``, with many tasks per file. The survey runs at once, the rest when rows are asked for.

    Takes uncompressed files in which every quote is part of a quoted field, with LF or
    CRLF line ends. Any other file is an error, never other rows.
    """
    layouts = landing_layouts(spark, paths) if layouts is None else layouts
    return united(spark, layouts, lambda layout: _scan(spark, layout), columns, source_file)


def _lines(spark: SparkSession, layout: Layout) -> DataFrame:
    """Lines in file order within a block."""
    text = spark.read.text(list(layout.files), lineSep=layout.line_end)
    place = F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("block")
    return text.select(*place, F.col("value").cast("binary"))


def _key(file: str, block: str) -> Column:
    """A short name for a block, for rows to carry; odd for the first block of a file."""
    return F.xxhash64(file, block).bitwiseAND(F.lit(-2)).bitwiseOR((F.col(block) == 0).cast("long"))


@dataclass(frozen=True)
class Blocks:
    """Keys in order, with the file of each, and whether it starts inside a field."""

    keys: np.ndarray
    file: np.ndarray
    opened: np.ndarray
    names: list[str]

    def find(self, key: int) -> tuple[str, bool, int]:
        at = int(np.searchsorted(self.keys, key))
        return self.names[self.file[at]], bool(key & 1), int(self.opened[at])


def _scan(spark: SparkSession, layout: Layout) -> DataFrame:
    lines = _lines(spark, layout)
    path = shared_dir(spark, "csv-survey")
    lines.mapInArrow(_survey(layout.line_end, PIECE_BYTES), SURVEY).write.parquet(path)
    blocks = _blocks(spark.read.schema(SURVEY).parquet(path))
    # a dozen bytes for each block of 128 MB
    table = blocks.select(_key("source_file", "block").alias("key"), "source_file", "opened").toArrow().sort_by("key")
    keys, files = table.column("key").to_numpy(), table.column("source_file").combine_chunks().dictionary_encode()
    if len(np.unique(keys)) < len(keys):
        raise RuntimeError("two blocks have the same key; read with another spark.sql.files.maxPartitionBytes")
    opened = table.column("opened").to_numpy().astype(np.int8)
    shared = spark.sparkContext.broadcast((keys, files.indices.to_numpy(), opened, files.dictionary.to_pylist()))

    schema = T.StructType([*layout.schema().fields, T.StructField("source_file", T.StringType())])
    keyed = lines.select(_key("source_file", "block").alias("block"), "value")
    whole = keyed.mapInArrow(_parse(layout, shared), schema)
    return whole.unionAll(_crossing(spark, layout, lines, blocks).select(*[f"`{name}`" for name in whole.columns]))


def _crossing(spark: SparkSession, layout: Layout, lines: DataFrame, blocks: DataFrame) -> DataFrame:
    """The records that cross the end of a block, parsed by Spark."""
    pieces = blocks.select("source_file", "block", F.inline("pieces"))
    if not blocks.where(F.exists("pieces", lambda p: p["text"].isNull())).isEmpty():
        again = lines.mapInArrow(_survey(layout.line_end, None), SURVEY)
        opened = blocks.select("source_file", "block", "opened")
        right = again.join(opened, ["source_file", "block"]).withColumn("pieces", F.get("assumed", F.col("opened").cast("int")))
        pieces = right.select("source_file", "block", F.inline("pieces"))
    position = Window.partitionBy("source_file").orderBy("block", "place")
    numbered = pieces.withColumn("whole", F.count_if(~F.col("is_head")).over(position))
    parts = F.transform(F.sort_array(F.collect_list(F.struct("block", "place", "text"))), lambda p: p["text"].cast("string"))
    joined = numbered.groupBy("source_file", "whole").agg(
        F.array_join(parts, layout.line_end).alias("record"), F.max("is_header").alias("is_header")
    )
    content = _in_dialect(F.col("record"), layout.line_end)
    if layout.line_end != "\n":  # the scan of whole files reads the file's own line end as a line feed
        content = F.replace(content, F.lit(layout.line_end), F.lit("\n"))
    ddl = ", ".join(f"`{name}` STRING" for name in layout.columns)
    row = F.from_csv("content", ddl, {**CSV_DIALECT, "multiLine": "true"}).alias("row")
    rows = joined.where("not is_header").withColumn("content", content).where("content <> ''")
    return rows.select(row, "source_file").select("row.*", "source_file")


def _in_dialect(record: Column, line_end: str) -> Column:
    """The record, or an error if it is not made of quoted fields and fields without quotes and line ends.

    Doubled quotes go first, then whole quoted fields; nothing that is left may be a quote or line end.
    Inside quotes the file's own line end may stand, or, if that is CRLF, single line feeds instead.
    """
    bare = F.regexp_replace(F.replace(record, F.lit('""'), F.lit("")), r'(\A|,)"[^"]*"(?=,|\z)', "$1")
    mixed = record.contains("\r") if line_end == "\n" else record.rlike(r"\r(?!\n)") | record.rlike(r"(?s)\r\n.*(?<!\r)\n|(?<!\r)\n.*\r\n")
    message = F.concat(F.lit(OUT_OF_PLACE), "source_file", F.lit(" in the record: "), F.left(record, F.lit(200)))
    return F.when(bare.rlike(r'["\r\n]') | mixed, F.raise_error(message)).otherwise(record)


PIECE = "place int, text binary, is_head boolean, is_header boolean"
SURVEY = f"source_file string, block long, quotes long, assumed array<array<struct<{PIECE}>>>"


def _blocks(survey: DataFrame) -> DataFrame:
    """Per block: ``opened``, 1 if it starts inside a field, else 0, and its ``pieces`` under the right assumption."""
    earlier = Window.partitionBy("source_file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("quotes").over(earlier), F.lit(0))
    in_all = F.sum("quotes").over(Window.partitionBy("source_file"))
    unpaired = F.raise_error(F.concat(F.lit("quotes do not pair up in "), "source_file"))
    opened = F.when(in_all % 2 == 1, unpaired).otherwise(before % 2)
    return survey.withColumn("opened", opened).withColumn("pieces", F.get("assumed", F.col("opened").cast("int")))


def _segments(batches) -> Iterator[tuple]:
    """Runs of lines of one block: what tells the block, and the lines."""
    for batch in batches:
        if not batch.num_rows:
            continue
        names = batch.columns[:-1]
        change = np.zeros(batch.num_rows - 1, bool)
        for column in names:
            values = column.dictionary_encode().indices if pa.types.is_string(column.type) else column
            change |= np.diff(values.to_numpy(zero_copy_only=False)) != 0
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            yield *[column[start].as_py() for column in names], batch.column("value").slice(start, end - start)


def _view(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of the lines."""
    _, offsets, data = lines.buffers()
    offsets = np.frombuffer(offsets, np.int32, len(lines) + 1, 4 * lines.offset).astype(np.int64)
    data = np.frombuffer(data, np.uint8, offsets[-1] - offsets[0], offsets[0]) if data is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], data


def _quotes_until(lines: pa.Array) -> np.ndarray:
    """The number of quotes up to the end of each line."""
    offsets, data = _view(lines)
    return np.searchsorted(np.flatnonzero(data == QUOTE), offsets[1:])


def _joined(lines: list[bytes], line_end: str) -> bytes:
    return line_end.encode().join(lines)


class _Split:
    """Head and tail of a block under one assumption about its start."""

    def __init__(self, opened: int, first_block: bool, line_end: str, limit: int | None):
        self.opened, self.line_end, self.limit = opened, line_end, limit
        self.in_head, self.head, self.tail = opened == 1, [], []
        self.size, self.header_seen = 0, not first_block

    def _hold(self, kept: list, lines: pa.Array) -> None:
        for line in lines.to_pylist() if self.limit is None or self.size <= self.limit else ():
            kept.append(line)
            self.size += len(line) + 1

    def add(self, lines: pa.Array, until: np.ndarray, before: int) -> None:
        """``until`` counts quotes to the end of each line, ``before`` those of earlier lines of the block."""
        ends = np.flatnonzero((until + before + self.opened) % 2 == 0)
        start = last = 0
        if self.in_head:
            start = int(ends[0]) + 1 if len(ends) else len(lines)
            self._hold(self.head, lines.slice(0, start))
            if not len(ends):
                return
            self.in_head, self.size = False, 0
        if len(ends):  # all up to there are whole records
            last = int(ends[-1]) + 1
            if not self.header_seen:
                self.header_seen = any(v.strip() for v in (*self.tail, *lines.slice(start, last - start).to_pylist()))
            self.tail, self.size = [], 0
        self._hold(self.tail, lines.slice(max(start, last)))

    def pieces(self) -> list[dict]:
        found = []
        if self.opened:
            text = None if self.in_head and self._too_long() else _joined(self.head, self.line_end)
            found.append({"place": 0, "text": text, "is_head": True, "is_header": False})
        if self.tail:
            text = None if self._too_long() else _joined(self.tail, self.line_end)
            found.append({"place": 1, "text": text, "is_head": False, "is_header": not self.header_seen})
        return found

    def _too_long(self) -> bool:
        return self.limit is not None and self.size > self.limit


def _survey(line_end: str, limit: int | None):
    def run(batches):
        def row():
            values = [[file], [block], [quotes], [[s.pieces() for s in splits]]]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types)], names=["source_file", "block", "quotes", "assumed"])

        piece = pa.struct([("place", pa.int32()), ("text", pa.binary()), ("is_head", pa.bool_()), ("is_header", pa.bool_())])
        types = [pa.string(), pa.int64(), pa.int64(), pa.list_(pa.list_(piece))]
        file = block = None
        for *here, lines in _segments(batches):
            if [file, block] != here:
                if file is not None:
                    yield row()
                (file, block), quotes = here, 0
                splits = [_Split(opened, block == 0, line_end, limit) for opened in (0, 1)]
            until = _quotes_until(lines)
            for split in splits:
                split.add(lines, until, quotes)
            quotes += int(until[-1])
        if file is not None:
            yield row()

    return run


def _check(lines: pa.Array, text: np.ndarray, line_end: str, file: str) -> None:
    """An error unless all quotes of whole records open, close or are doubled, and no line end is out of place."""

    def stray(at: int):
        start = bytes(text[:at]).rfind(b"\n") + 1
        raise ValueError(f"{OUT_OF_PLACE}{file} in the record: {bytes(text[start : start + 200]).decode(errors='replace')}")

    places = np.flatnonzero(text == QUOTE)
    opening, closing = places[0::2], places[1::2]
    before = np.where(opening > 0, text[np.maximum(opening - 1, 0)], FEED)
    after = text[closing + 1]
    for at, beside in ((opening, before), (closing, after)):
        bad = np.flatnonzero((beside != COMMA) & (beside != FEED) & (beside != QUOTE))
        if len(bad):
            stray(int(at[bad[0]]))
    returns = np.flatnonzero(text == RETURN)
    if len(returns):
        stray(int(returns[0]))
    if line_end != "\n":  # single line feeds may stand in a quoted field, if the record has no other line end
        offsets, _ = _view(lines)
        ends = offsets[1:] + np.arange(len(lines))
        feeds = np.setdiff1d(np.flatnonzero(text == FEED), ends)
        inside = np.searchsorted(places, feeds) % 2 == 1
        line = np.searchsorted(ends, feeds)
        closed = np.searchsorted(places, ends) % 2 == 0  # lines that end a record
        alone = closed[line] & np.where(line > 0, closed[np.maximum(line - 1, 0)], True)
        bad = np.flatnonzero(~(inside & alone))
        if len(bad):
            stray(int(feeds[bad[0]]))


def _parse(layout: Layout, shared):
    """Rows of the records that lie in one block as a whole."""
    count, line_end, names = len(layout.columns), layout.line_end, list(layout.columns)
    fields = [f"c{i}" for i in range(count)]

    def rows(lines: pa.Array, file: str):
        """``lines`` are whole records."""
        joined = pa.ListArray.from_arrays(pa.array([0, len(lines)], pa.int32()), lines)
        text = pc.binary_join(joined, b"\n")[0].as_py() + b"\n"
        _check(lines, np.frombuffer(text, np.uint8), line_end, file)
        if not text.strip(b"\n"):
            return
        odd = []
        table = pacsv.read_csv(
            pa.BufferReader(text),
            read_options=pacsv.ReadOptions(column_names=fields, use_threads=False, block_size=len(text) + 1),
            parse_options=pacsv.ParseOptions(newlines_in_values=True, invalid_row_handler=lambda row: odd.append(row.text) or "skip"),
            convert_options=pacsv.ConvertOptions(
                column_types={f: pa.string() for f in fields},
                null_values=[""],
                strings_can_be_null=True,
                quoted_strings_can_be_null=True,
                check_utf8=False,
            ),
        )
        batches = table.to_batches()
        if odd:  # records with more or fewer fields
            found = [next(csv.reader(io.StringIO(record, newline=""))) for record in odd]
            found = [[value or None for value in (r + [""] * count)[:count]] for r in found]
            batches.append(pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*found)], names=fields))
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.repeat(pa.scalar(file), batch.num_rows)], names=[*names, "source_file"])

    def run(batches):
        here, held, blocks = None, [], Blocks(*shared.value)
        for block, lines in _segments(batches):
            if here != block:
                here, held = block, []
                file, header, opened = blocks.find(block)
                parity = opened
            after = (_quotes_until(lines) + parity) % 2
            parity = int(after[-1])
            ends = np.flatnonzero(after == 0)
            if not len(ends):
                if not opened:
                    held.append(lines)
                continue
            first, last = 0, int(ends[-1]) + 1
            if opened:  # the end of a record that began before the block
                opened, first = 0, int(ends[0]) + 1
            rest = lines.slice(last)
            records = pa.concat_arrays([*held, lines.slice(first, last - first)])
            held = [rest] if len(rest) else []
            if header:
                whole = _quotes_until(records) % 2 == 0
                blank = np.array([not v.as_py().strip() for v in records])
                at = np.flatnonzero(whole & (np.cumsum(~blank) > 0))
                if not len(at):
                    continue
                header, records = False, records.slice(int(at[0]) + 1)
            if len(records):
                yield from rows(records, file)

    return run
