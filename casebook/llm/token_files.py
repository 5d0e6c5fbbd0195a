"""Token-id files: patched frame-of-reference blocks, written in key order by the tasks of one Spark job.

Documents are dealt by ranges of their key and sorted in each task; a task encodes them and cuts its ids into
files of about ``file_ids`` ids, always between documents. A file holds, in little-endian numbers::

    header       HEAD: magic, format, block size, bytes of the table, documents, ids, partition, file of the partition
    documents    an Arrow stream of (key, ids of the document, its end id included), in order
    index        an unsigned 64-bit offset for each block, and one for the end, counted from the first block
    blocks       base, count, exceptions, width; then the packed values, positions of exceptions, their upper parts
    one byte     a line feed, the end mark

A block subtracts its smallest id, and packs the differences with the bits that ``percentile`` of them need.
What does not fit is an exception: its lower bits are packed, its upper bits listed. The index gives a block's
place without reading others, so ids can be fetched at random (``File.ids``).

* Files are rows of bytes that Spark's text writer stores, one file for each: any file system that Spark writes to
  will do, and tasks that are run again leave one copy. A task holds the ids of one file and one batch of texts; a
  text is held whole. Keys that many rows share are dealt out by their texts, and equal rows by their place.
* Equal white-space separated pieces of a batch are encoded once. The tokenizer must drop white space and never join
  what it separates, which ``splits_at_spaces`` checks for the file at hand; otherwise whole texts are encoded.
* Null text is empty: the document is its end id alone. A null key comes first. Repeated rows are documents of their
  own, rows of one key are ordered by a hash of their text. Extra columns do not matter. An empty table has files
  without documents, and reads as an empty table.
"""

from __future__ import annotations

import itertools
import json
import math
import re
import struct
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casebook.llm.common import Scratch, narrow, query, table, text_batches

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
BLOCK = 1024
PERCENTILE = 0.95
FILE_IDS = 1 << 21

MAGIC = b"PFRB"
HEAD = "<4sIIQQQQQ"
BLOCK_HEAD = "<IHHB"
WORD_END = "</w>"
LETTERS_FIRST = r"(?s)^(?P<word>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<rest>(?:[!-/:-@\[-`{-~].*)?)$"


def packed(values: np.ndarray, percentile: float = PERCENTILE) -> list[bytes]:
    """One block for each row of ``values``, unsigned 32-bit integers; rows have 1 to 65,535 of them."""
    base = values.min(1)
    above = values - base[:, None]
    place = max(0, math.ceil(percentile * values.shape[1]) - 1)
    least = np.partition(above, place, axis=1)[:, place]
    width = np.ceil(np.log2(least + 1.0)).astype(np.int64)  # exact below 2^32
    upper = (above.astype(np.uint64) >> width[:, None].astype(np.uint64)).astype("<u4")
    bodies: list[bytes] = [b""] * len(values)
    for bits in np.unique(width[width > 0]).tolist():
        rows = np.flatnonzero(width == bits)
        plain = np.unpackbits(above[rows].astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, count=bits, bitorder="little")
        for row, body in zip(rows.tolist(), np.packbits(plain.reshape(len(rows), -1), axis=1, bitorder="little")):
            bodies[row] = body.tobytes()
    where, odd = np.nonzero(upper)
    bounds = np.searchsorted(where, np.arange(len(values) + 1)).tolist()
    odd, rest = odd.astype("<u2"), upper[where, odd]
    found = []
    for row, (low, bits, body) in enumerate(zip(base.tolist(), width.tolist(), bodies)):
        start, end = bounds[row], bounds[row + 1]
        head = struct.pack(BLOCK_HEAD, low, values.shape[1], end - start, bits)
        found.append(b"".join((head, body, odd[start:end].tobytes(), rest[start:end].tobytes())))
    return found


def unpacked(blocks: list[memoryview]) -> np.ndarray:
    """The values of blocks, one after the other."""
    heads = [struct.unpack_from(BLOCK_HEAD, b) for b in blocks]
    ends = np.cumsum([0] + [h[1] for h in heads])
    values = np.zeros(ends[-1], np.uint32)
    alike: dict[tuple[int, int], list[int]] = {}
    for number, (_, count, _, width) in enumerate(heads):
        alike.setdefault((count, width), []).append(number)
    start = struct.calcsize(BLOCK_HEAD)
    for (count, width), numbers in alike.items():
        size = -(-count * width // 8)
        if width:
            body = np.frombuffer(b"".join(blocks[n][start : start + size] for n in numbers), np.uint8).reshape(len(numbers), size)
            bits = np.unpackbits(body, axis=1, count=count * width, bitorder="little").reshape(-1, width)
            low = np.zeros((len(bits), 4), np.uint8)
            low[:, : -(-width // 8)] = np.packbits(bits, axis=1, bitorder="little")
            low = low.view("<u4").reshape(len(numbers), count)
        for at, n in enumerate(numbers):
            base, _, odd, _ = heads[n]
            part = values[ends[n] : ends[n + 1]]
            if width:
                part[:] = low[at]
            if odd:
                places = np.frombuffer(blocks[n], "<u2", odd, start + size)
                part[places] |= (np.frombuffer(blocks[n], "<u4", odd, start + size + 2 * odd).astype(np.uint64) << np.uint64(width)).astype(np.uint32)
            part += np.uint32(base)
    return values


def file_bytes(keys: pa.Array, counts: np.ndarray, ids: np.ndarray, partition: int, number: int, block: int, percentile: float) -> bytes:
    """One file, without the end mark."""
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_arrays([keys, pa.array(counts, pa.int64())], names=["key", "n_tokens"])
    with pa.ipc.new_stream(sink, batch.schema) as stream:
        stream.write_batch(batch)
    documents = sink.getvalue().to_pybytes()
    whole = len(ids) - len(ids) % block
    blocks = packed(ids[:whole].reshape(-1, block), percentile) if whole else []
    blocks += packed(ids[whole:].reshape(1, -1), percentile) if whole < len(ids) else []
    index = np.concatenate([[0], np.cumsum([len(b) for b in blocks])]).astype("<u8")
    head = struct.pack(HEAD, MAGIC, 1, block, len(documents), len(keys), len(ids), partition, number)
    return b"".join([head, documents, index.tobytes(), *blocks])


class File:
    """Reads one file: ``partition`` and ``number`` order the files, ``table`` lists keys and counts."""

    def __init__(self, content: bytes | memoryview):
        self.data = memoryview(content)
        magic, version, self.block, documents, self.documents, self.length, self.partition, self.number = struct.unpack_from(HEAD, content)
        if magic != MAGIC or version != 1 or self.data[-1:] != b"\n":
            raise ValueError("this is no whole file of token ids")
        at = struct.calcsize(HEAD) + documents
        self.table = pa.ipc.open_stream(self.data[struct.calcsize(HEAD) : at]).read_all().combine_chunks()
        blocks = -(-self.length // self.block)
        self.index = np.frombuffer(content, "<u8", blocks + 1, at)
        self.first = at + self.index.nbytes

    def ids(self, start: int = 0, end: int | None = None) -> np.ndarray:
        """The ids from ``start`` to ``end``; only blocks that hold some are unpacked."""
        end = self.length if end is None else min(end, self.length)
        if start >= end:
            return np.zeros(0, np.uint32)
        first, last = start // self.block, (end - 1) // self.block
        places = (self.index[first : last + 2].astype(np.int64) + self.first).tolist()
        values = unpacked([self.data[a:b] for a, b in zip(places, places[1:])])
        return values[start - first * self.block : end - first * self.block]


def splits_at_spaces(tokenizer) -> bool:
    """Whether the tokenizer drops ASCII white space and takes what it separates apart, by its own description."""
    if tokenizer.pre_tokenizer is None or getattr(tokenizer.model, "end_of_word_suffix", None) != WORD_END:
        return False
    added = tokenizer.get_added_tokens_decoder().values()
    free = not any(t.single_word or t.lstrip or t.rstrip or re.search(r"\s", t.content) for t in added)
    steps = json.loads(tokenizer.pre_tokenizer.__getstate__()).get("pretokenizers") or [{}]
    drops = steps[0].get("type") == "Split" and steps[0]["invert"] and steps[0]["behavior"] == "Removed"
    return bool(free and drops) and [p for p, _ in tokenizer.pre_tokenizer.pre_tokenize_str(" a\t\n b\r\x0b\x0cc ")] == ["a", "b", "c"]


def of_plain_words(tokenizer):
    """The same tokenizer for lower-case Latin letters and single spaces alone: these need no normalising and no pattern.

    That holds where the description has only steps that leave such words as they are; else it is ``tokenizer`` itself.
    """
    from tokenizers import Tokenizer, pre_tokenizers

    normal = json.loads(tokenizer.normalizer.__getstate__()) if tokenizer.normalizer else {}
    steps = json.loads(tokenizer.pre_tokenizer.__getstate__())["pretokenizers"]
    harmless = {n["type"] for n in normal.get("normalizers", [normal] if normal else [])} <= {"NFC", "Lowercase", "Replace"}
    spaces = all(n.get("pattern") == {"Regex": "\\s+"} and n.get("content") == " " for n in normal.get("normalizers", []) if n["type"] == "Replace")
    bytewise = [s["type"] for s in steps] == ["Split", "ByteLevel"] and not steps[1]["add_prefix_space"] and not steps[1]["use_regex"]
    if not (harmless and spaces and bytewise):
        return tokenizer
    plain = Tokenizer(tokenizer.model)
    parts = [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
    plain.pre_tokenizer = pre_tokenizers.Sequence(parts)
    return plain


class Encoder:
    """Ids of the documents of a batch of texts, ``end_id`` after each, as one array, and the count of each.

    White space parts a text into pieces, and equal ones are encoded once. A piece that begins with letters followed by
    an ASCII character that is none is two units, as the tokenizer starts anew there. The units that are
    letters alone are encoded as one text, in which the ids of each end with one of a word's end.
    """

    def __init__(self, path: str, end_id: int):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.end_id = end_id
        self.by_piece = splits_at_spaces(self.tokenizer)
        self.plain = of_plain_words(self.tokenizer) if self.by_piece else self.tokenizer
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.is_end = np.zeros(max(vocabulary.values()) + 1, bool)
        self.is_end[[i for word, i in vocabulary.items() if word.endswith(WORD_END)]] = True

    def whole(self, texts: list[str], tokenizer=None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and the count of each."""
        ids = [e.ids for e in (tokenizer or self.tokenizer).encode_batch_fast(texts, add_special_tokens=False)]
        return np.fromiter(itertools.chain.from_iterable(ids), np.uint32), np.fromiter(map(len, ids), np.int64, len(ids))

    def words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        ids, _ = self.whole([" ".join(words.to_pylist())], self.plain)
        ends = np.flatnonzero(self.is_end[ids]) + 1
        if len(ends) != len(words):
            raise AssertionError("words and word ends differ in number")
        return ids, np.diff(ends, prepend=0)

    def units(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each piece the numbers of its two units; the ids of all units, and the count of each. The last unit is the end id."""
        plain = pc.invert(pc.match_substring(pieces, "<|"))  # of special tokens
        parts = pc.extract_regex(pc.if_else(plain, pieces, None), LETTERS_FIRST)
        word, rest = (pc.struct_field(parts, name) for name in ("word", "rest"))
        word = pc.utf8_lower(pc.if_else(parts.is_valid(), word, None)).dictionary_encode()
        rest = pc.if_else(parts.is_valid(), rest, pieces).dictionary_encode()
        word_ids, word_sizes = self.words(word.dictionary)
        rest_ids, rest_sizes = self.whole(rest.dictionary.to_pylist())
        sizes = np.concatenate([word_sizes, rest_sizes, [0, 1]])  # no word, and the end
        ids = np.concatenate([word_ids, rest_ids, np.array([self.end_id], np.uint32)])
        first = pc.fill_null(word.indices, len(sizes) - 2).to_numpy(zero_copy_only=False)
        second = rest.indices.to_numpy(zero_copy_only=False) + len(word_sizes)
        return np.stack([first, second], 1).astype(np.int64), ids, sizes

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        if self.by_piece:
            split = pc.ascii_split_whitespace(texts)
            pieces = split.flatten().dictionary_encode()
            units, flat, size = self.units(pieces.dictionary)
            order = units[pieces.indices.to_numpy(zero_copy_only=False)].ravel()
            offsets = 2 * (split.offsets.to_numpy().astype(np.int64) - split.offsets[0].as_py())
        else:
            flat, size = self.whole(texts.to_pylist())
            flat, size = np.append(flat, np.uint32(self.end_id)), np.append(size, 1)
            order, offsets = np.arange(len(texts)), np.arange(len(texts) + 1)
        order = np.insert(order, offsets[1:], len(size) - 1)  # the end id follows the last unit of each text
        offsets = offsets + np.arange(len(offsets))
        first = np.cumsum(size) - size
        sizes = size[order]
        ends = np.cumsum(sizes)
        ids = flat[np.repeat(first[order] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]
        return ids, np.diff(np.concatenate([[0], ends])[offsets])


def write(
    docs: DataFrame,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    tokenizer: str | None = None,
    end_id: int = END_ID,
    block: int = BLOCK,
    percentile: float = PERCENTILE,
    file_ids: int = FILE_IDS,
) -> None:
    """Encodes ``docs`` and writes them in ascending order of ``key`` below ``path``, which is overwritten.

    ``tokenizer`` is a file that every executor can read; by default that of the installed package.
    """
    text_batches(docs.sparkSession)
    source = narrow(docs, key, text).toDF("key", "text")
    source = source.select("key", "text", F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("row"))
    ordered = source.repartitionByRange("key", "tie", "row").sortWithinPartitions("key", "tie", "row").select("key", "text")

    def run(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = Encoder(tokenizer or public_tokenizers.path(TOKENIZER), end_id)
        partition, number = TaskContext.get().partitionId(), 0
        keys, counts, ids, held = [], [], [], 0

        def close():
            parts = file_bytes(pa.concat_arrays(keys), np.concatenate(counts), np.concatenate(ids), partition, number, block, percentile)
            return pa.RecordBatch.from_arrays([pa.array([parts], pa.binary())], names=["content"])

        for batch in batches:
            if not batch.num_rows:
                continue
            found, size = encoder(batch.column(1))
            ends = np.cumsum(size)
            start = done = 0  # rows and ids that are in files or held
            while start < batch.num_rows:
                end = min(int(np.searchsorted(ends, done + file_ids - held)) + 1, batch.num_rows)
                upto = int(ends[end - 1])
                keys.append(batch.column(0).slice(start, end - start))
                counts.append(size[start:end])
                ids.append(found[done:upto])
                held += upto - done
                start, done = end, upto
                if held >= file_ids:
                    yield close()
                    number, keys, counts, ids, held = number + 1, [], [], [], 0
        if keys:
            yield close()

    files = ordered.mapInArrow(run, "content binary").select(F.col("content").cast("string"))
    files.write.mode("overwrite").option("maxRecordsPerFile", 1).text(path)


def _running(df: DataFrame, by: str, value: str, order: str) -> DataFrame:
    """``before``: the sum of ``value`` in earlier rows of the same ``by``."""
    earlier = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("before", F.coalesce(F.sum(value).over(earlier), F.lit(0)))


def read(spark: SparkSession, path: str, key_type: T.DataType = T.LongType(), with_ids: bool = False, scratch: Scratch | None = None) -> DataFrame:
    """One row per document, read from the files: ``key, start, n_tokens, ids_crc32`` and, if asked for, ``ids``.

    ``start`` counts the ids of all documents before it, in all files. Every file is read once; the sums of
    files are added up per partition, of partitions in groups of 1,024, and of groups, so that no task sees them all.
    """
    scratch = scratch or Scratch(spark, "token-files")
    ids_field = [T.StructField("ids", T.ArrayType(T.LongType(), False))] * with_ids
    names = ("partition", "number", "local", "n_tokens", "ids_crc32")
    schema = T.StructType([T.StructField("key", key_type), *[T.StructField(n, T.LongType()) for n in names], *ids_field])

    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                file = File(memoryview(content.as_buffer()))
                ids = file.ids().astype("<u4")
                counts = file.table.column("n_tokens").to_numpy()
                local = np.cumsum(counts) - counts
                crc = [zlib.crc32(ids[a : a + n]) for a, n in zip(local.tolist(), counts.tolist())]
                same = [np.full(len(crc), n, np.int64) for n in (file.partition, file.number)]
                arrays = [file.table.column("key").combine_chunks(), *map(pa.array, [*same, local, counts]), pa.array(crc, pa.int64())]
                if with_ids:
                    offsets = pa.array(np.append(local, len(ids)), pa.int32())
                    arrays.append(pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int64())))
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    contents = spark.read.format("binaryFile").load(path).where("length > 0").select("content")
    rows = scratch.store(contents.mapInArrow(run, schema), "documents")
    files = rows.groupBy("partition", "number").agg(F.sum("n_tokens").alias("ids"))
    files = scratch.store(files.withColumn("band", F.expr("partition div 1024")), "files")
    parts = files.groupBy("band", "partition").agg(F.sum("ids").alias("ids"))
    bands = parts.groupBy("band").agg(F.sum("ids").alias("ids"), F.lit(0).alias("all"))
    in_file = _running(files, "partition", "ids", "number").select("partition", "number", "band", F.col("before").alias("in_partition"))
    in_band = _running(parts, "band", "ids", "partition").select("partition", F.col("before").alias("in_band"))
    in_all = _running(bands, "all", "ids", "band").select("band", F.col("before").alias("in_all"))
    base = in_file.join(in_band, "partition").join(in_all, "band")
    base = base.select("partition", "number", F.expr("in_partition + in_band + in_all").alias("base"))
    start = (F.col("base") + F.col("local")).alias("start")
    return rows.join(base, ["partition", "number"]).select("key", start, "n_tokens", "ids_crc32", *["ids"] * with_ids)


@query("op11_token_files")
def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scratch = Scratch(spark, "op11")
    write(docs, scratch.path("files"))
    return read(spark, scratch.path("files"), docs.schema["doc_id"].dataType, scratch=scratch).withColumnRenamed("key", "doc_id")
