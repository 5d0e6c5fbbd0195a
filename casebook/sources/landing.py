"""Landing zone: delimited text read without guessing, plus where each row came from."""

from __future__ import annotations

import csv
import io
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casebook.sources.contract import MissingColumnsError

# Quoted fields may hold line ends, a quote is written as two quotes,
# short or long records are kept, and no type is inferred.
CSV_DIALECT = {"quote": '"', "escape": '"', "mode": "PERMISSIVE"}

# A header must end within so many characters. Files up to this size are read whole by tasks for their headers.
HEADER_CHARACTERS = 1 << 20
SMALL_FILE = 4 << 20
COMPRESSED = r"\.(gz|bz2|zst|xz|lz4|snappy|deflate|zip)$"
HEADERS_AT_ONCE = 16

# The first record after empty lines: text and quoted fields up to a line end outside of quotes. Never backtracks.
FIRST_RECORD = r"\A\uFEFF?(?:[ \t\r]*+\n)*+((?:[^\"\n]++|\"[^\"]*+\")++)"
NO_RECORD = r"\A\uFEFF?\s*+\z"


class HeaderError(ValueError):
    pass


@dataclass(frozen=True)
class Layout:
    """Files that share one header and kind of line end. ``example`` is one of them."""

    columns: tuple[str, ...]
    files: tuple[str, ...]
    line_end: str = "\n"
    example: str = ""

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(name, T.StringType()) for name in self.columns])


def landing_layouts(spark: SparkSession, paths: str | Sequence[str]) -> list[Layout]:
    """The headers of all files, with the files of each. Empty files have none.

    Tasks read the first records of small files, and group them: the driver sees a row per distinct header. If all
    files have the same, its layout holds ``paths`` as they were given; file names are fetched only to tell several
    layouts apart. Of large and of compressed files the driver reads the first record alone.
    """
    given = [paths] if isinstance(paths, str) else list(paths)
    is_small = (F.col("_metadata.file_size") <= SMALL_FILE) & ~F.lower("_metadata.file_name").rlike(COMPRESSED)
    small = spark.read.text(given, wholetext=True).where(is_small)
    small = small.select(_first_record("value").alias("record"), F.col("_metadata.file_path").alias("file")).where("record is not null")
    groups = small.groupBy("record").agg(F.min("file").alias("example")).collect()
    found: dict[tuple[tuple[str, ...], str], str] = {}
    of_record = {}
    for record, example in groups:
        of_record[record] = _columns(record, example)
        found[of_record[record]] = min(found.get(of_record[record], example), example)

    listed = spark.read.format("binaryFile").load(given).select("path", "length")
    others = listed.where((F.col("length") > SMALL_FILE) | F.lower("path").rlike(COMPRESSED)).select("path")
    names = sorted(r.path for r in others.collect())
    with ThreadPoolExecutor(HEADERS_AT_ONCE) as pool:
        read = [(name, of) for name, of in zip(names, pool.map(lambda name: _header(spark, name), names)) if of]
    for name, of in read:
        found[of] = min(found.get(of, name), name)

    if len(found) <= 1:
        return [Layout(columns, tuple(given), line_end, unquote(example)) for (columns, line_end), example in found.items()]
    files: dict[tuple[tuple[str, ...], str], list[str]] = {of: [] for of in found}
    for name, of in read + [(unquote(r.file), of_record[r.record]) for r in small.collect()]:
        files[of].append(name)
    ordered = sorted(files.items(), key=lambda item: min(item[1]))
    return [Layout(columns, tuple(sorted(names)), line_end, min(names)) for (columns, line_end), names in ordered]


def _first_record(text: str) -> Column:
    """The first record of a text, or NULL if it has none; an error if it does not end within HEADER_CHARACTERS."""
    head = F.left(F.col(text), F.lit(HEADER_CHARACTERS))
    record = F.regexp_extract(head, FIRST_RECORD, 1)
    rest = F.substr(head, F.length(F.regexp_extract(head, FIRST_RECORD, 0)) + 1)
    ends = rest.startswith("\n") | ((F.length(rest) == 0) & (F.length(text) <= HEADER_CHARACTERS))
    message = F.concat(F.lit(NO_HEADER), F.col("_metadata.file_path"))
    return F.when(head.rlike(NO_RECORD) & (F.length(text) <= HEADER_CHARACTERS), None).when(ends & (record != ""), record).otherwise(F.raise_error(message))


NO_HEADER = f"no header record ends within the first {HEADER_CHARACTERS} characters of "


def _columns(record: str, file: str) -> tuple[tuple[str, ...], str]:
    """Column names in a header record, and what ends its line."""
    line_end = "\r\n" if record.endswith("\r") or "\r\n" in record else "\n"
    names = next(csv.reader(io.StringIO(record.strip("\r\n"), newline="")), [])
    names = tuple(name or f"_c{i}" for i, name in enumerate(names))
    if len(set(names)) < len(names):
        raise ValueError(f"a column name occurs twice in the header of {file}")
    return names, line_end


def _header(spark: SparkSession, file: str) -> tuple[tuple[str, ...], str] | None:
    """The same of one file, of which no more than the first record is read; None if it has no record."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(file)
    stream = path.getFileSystem(conf).open(path)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
    lines = jvm.org.apache.hadoop.util.LineReader(codec.createInputStream(stream) if codec else stream, b"\n")
    line, parts, size, quotes = jvm.org.apache.hadoop.io.Text(), [], 0, 0
    try:
        while (taken := lines.readLine(line, HEADER_CHARACTERS, HEADER_CHARACTERS)) > 0:
            text, size = line.toString(), size + taken
            if size > HEADER_CHARACTERS or taken > line.getLength() + 1:
                raise HeaderError(NO_HEADER + file)
            if not parts:
                text = text.removeprefix("\ufeff")
            if parts or text.strip():
                parts.append(text)
                quotes += text.count('"')
                if quotes % 2 == 0:
                    return _columns("\n".join(parts), file)
    finally:
        lines.close()
    if parts:
        raise HeaderError(NO_HEADER + file)
    return None


def require_in_files(layouts: Sequence[Layout], required: Sequence[str]) -> None:
    """The column contract, for every file."""
    for layout in layouts:
        missing = [name for name in required if name not in layout.columns]
        if missing:
            raise MissingColumnsError(missing, layout.example)


def scan_landing(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str] | None = None,
    multi_line: bool = True,
    source_file: bool = False,
    layouts: Sequence[Layout] | None = None,
) -> DataFrame:
    """CSV with header, every field a string; files with other headers are united by name.

    Spark reads a file of multi-line records in one task. That suits many files of
    moderate size; for a file of many gigabytes see ``large_csv.scan_large``.
    ``multi_line=False`` splits files as well, and is right only for sources whose
    fields hold no line ends. ``columns`` picks columns that every file must have; without
    it, a column that a file lacks is NULL there. ``layouts`` are those of the paths, if they have been read already.
    """
    options = {"header": True, "enforceSchema": False, "multiLine": multi_line, **CSV_DIALECT}
    reader = spark.read.options(**options)

    def scan(layout: Layout) -> DataFrame:
        return reader.schema(layout.schema()).csv(list(layout.files)).withColumn("source_file", F.col("_metadata.file_path"))

    return united(spark, landing_layouts(spark, paths) if layouts is None else layouts, scan, columns, source_file)


def united(spark: SparkSession, layouts: Sequence[Layout], scan, columns: Sequence[str] | None, source_file: bool) -> DataFrame:
    """One frame of all layouts, each read by ``scan``, which adds ``source_file``."""
    if columns:
        require_in_files(layouts, columns)
    names = list(columns or dict.fromkeys(name for layout in layouts for name in layout.columns))
    if source_file and "source_file" in names:
        raise ValueError("the files have a column source_file of their own")
    frames = []
    for layout in layouts:
        rows = scan(layout)
        frames.append(rows.select(*[_named(name, layout) for name in names], *["source_file"] * source_file))
    if not frames:
        fields = [T.StructField(name, T.StringType()) for name in [*names, *["source_file"] * source_file]]
        return spark.createDataFrame([], T.StructType(fields))
    result = frames[0]
    for frame in frames[1:]:
        result = result.union(frame)
    return result


def _named(name: str, layout: Layout) -> Column:
    return F.col(f"`{name}`") if name in layout.columns else F.lit(None).cast("string").alias(name)


def with_lineage(scan: DataFrame, loaded_at: Column | None = None, source: Column | None = None) -> DataFrame:
    """Adds when the row was loaded and from which file.

    Takes a scan with ``source_file``, or any frame if ``source`` says which column names the file.
    """
    return scan.withColumns(
        {
            "ingestion_timestamp": F.current_timestamp() if loaded_at is None else loaded_at,
            "source_file": F.col("source_file") if source is None else source,
        }
    )


def extract_range(df: DataFrame, column: str, first, last) -> DataFrame:
    """All rows with ``first <= column <= last``."""
    return df.filter(F.col(column).between(first, last))
