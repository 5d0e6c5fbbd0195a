"""Benchmark decontamination with an FM-index per training shard.

A task cuts its documents into shards of about ``shard_words`` words and builds an FM-index of each:
suffix array by doubling, Burrows-Wheeler transform in a wavelet matrix, every ``SAMPLE``-th text
position. All windows of the benchmark are searched backward at once; occurrences are located by steps
to the next sampled position, and their word ranges are merged into spans to remove.

* Words: after lower-casing A-Z, runs of characters other than ASCII non-alphanumerics.
  A window is ``window`` consecutive words of an item; an item of fewer words is one window.
* Only words that the benchmark has can be part of a window. A run of such words shorter than every
  window is left out of the index; between runs stands a symbol that no window has.
* The benchmark's windows go to the tasks as arrays. A benchmark of more than ``SLICE_WORDS`` words is
  searched slice by slice, each of about that size, and the spans of the slices are merged per document.
  The driver fetches, sends and forgets one slice after the other; longer items are cut into pieces that share
  all but one word of a window.
* Null or empty text: no words, nothing hit. Null items and items without words have no window; equal
  items are all reported. Repeated rows are documents of their own; extra columns do not matter. An empty
  benchmark hits nothing; empty documents give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.llm.common import Scratch, flat, narrow, place, query, table, text_batches

WINDOW = 13
SHARD_WORDS = 1 << 20
SLICE_WORDS = 1 << 20  # a slice is at most some 50 MB in a task
SAMPLE = 8
PART_BYTES = 1 << 20
BREAK = 1  # stands between runs; 0 ends the text, benchmark words start at 2

WORD_BYTES = bytes(b for b in range(256) if b >= 128 or chr(b).isalnum())
WORD_ENDS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # the same, as a pattern
TO_WORDS = bytes((b + 32 if 65 <= b <= 90 else b) if b in WORD_BYTES else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(TO_WORDS).split()


def symbols_of(text: str | None, number: dict[bytes, int]) -> np.ndarray:
    """The number of each word, 0 where the benchmark does not have it; a long text is split in parts."""
    data = (text or "").encode().translate(TO_WORDS)
    parts, start = [], 0
    while start < len(data):
        end = data.find(b" ", start + PART_BYTES)
        end = len(data) if end < 0 else end
        words = data[start:end].split()
        parts.append(np.fromiter(map(number.get, words, repeat(0)), np.int32, len(words)))
        start = end
    return np.concatenate(parts) if parts else np.zeros(0, np.int32)


class Windows:
    """The distinct windows of some items as rows of word numbers, right-aligned, and the items of each."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.number: dict[bytes, int] = {}
        rows: dict[tuple[int, ...], list[str]] = {}
        for item, text in items:
            numbers = [self.number.setdefault(w, len(self.number) + 2) for w in words_of(text)]
            size = min(window, len(numbers))
            for start in range(len(numbers) - size + 1 if size else 0):
                owners = rows.setdefault(tuple(numbers[start : start + size]), [])
                if not owners or owners[-1] != item:
                    owners.append(item)
        self.owners = list(rows.values())
        self.size = np.array([len(r) for r in rows], np.int64)
        self.words = np.zeros((len(rows), window), np.int64)
        for i, row in enumerate(rows):
            self.words[i, window - len(row) :] = row
        self.shortest = int(self.size.min()) if rows else 0


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Start positions in suffix order; ``text`` ends with its only 0."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    step = 1
    while True:
        following = np.zeros(n, np.int64)
        following[: n - step] = rank[step:] + 1
        key = rank * (n + 1) + following
        order = np.argsort(key)
        ordered = key[order]
        place_ = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]]))
        rank = np.empty(n, np.int64)
        rank[order] = place_
        step *= 2
        if place_[-1] == n - 1 or step >= n:
            return order


class Bits:
    """A bit row with counts of ones before any place."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(ones) - ones

    def ones(self, at: np.ndarray) -> np.ndarray:
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[at >> 6] + np.bitwise_count(self.words[at >> 6] & mask).astype(np.int64)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)


class FmIndex:
    def __init__(self, text: np.ndarray):
        n = len(text)
        order = suffix_array(text)
        last = text[order - 1]
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=int(text.max()) + 1))])
        self.n = n
        self.levels: list[tuple[int, Bits, int]] = []
        row = last.copy()
        for level in reversed(range(max(1, int(text.max()).bit_length()))):
            bit = (row >> level) & 1
            zeros = int(n - bit.sum())
            self.levels.append((level, Bits(bit.astype(np.uint8)), zeros))
            row = np.concatenate([row[bit == 0], row[bit == 1]])
        sampled = order % SAMPLE == 0
        self.sampled = Bits(sampled.astype(np.uint8))
        self.positions = order[sampled]

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place of the transformed text."""
        begin = np.zeros_like(at)
        for level, bits, zeros in self.levels:
            one = (symbol >> level) & 1 == 1
            b, a = bits.ones(begin), bits.ones(at)
            begin = np.where(one, zeros + b, begin - b)
            at = np.where(one, zeros + a, at - a)
        return at - begin

    def symbol(self, at: np.ndarray) -> np.ndarray:
        found = np.zeros_like(at)
        for _, bits, zeros in self.levels:
            one = bits.get(at).astype(np.int64)
            found = found * 2 + one
            ones = bits.ones(at)
            at = np.where(one == 1, zeros + ones, at - ones)
        return found

    def search(self, windows: Windows) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of suffixes that start with each window: first place, and place after the last."""
        low = np.zeros(len(windows.size), np.int64)
        high = np.full(len(windows.size), self.n, np.int64)
        for column in reversed(range(windows.words.shape[1])):
            symbol = windows.words[:, column]
            live = np.flatnonzero((symbol > 0) & (low < high))
            s = symbol[live]
            known = s < len(self.starts) - 1
            low[live[~known]] = high[live[~known]] = 0
            live, s = live[known], s[known]
            low[live] = self.starts[s] + self.rank(s, low[live])
            high[live] = self.starts[s] + self.rank(s, high[live])
        return low, high

    def locate(self, at: np.ndarray) -> np.ndarray:
        """Text positions of suffixes."""
        at = at.copy()
        found = np.full(len(at), -1, np.int64)
        steps = 0
        open_ = np.arange(len(at))
        while len(open_):
            here = self.sampled.get(at[open_]) == 1
            done = open_[here]
            found[done] = self.positions[self.sampled.ones(at[done])] + steps
            open_ = open_[~here]
            symbol = self.symbol(at[open_])
            at[open_] = self.starts[symbol] + self.rank(symbol, at[open_])
            steps += 1
        return found


def merged(start: np.ndarray, end: np.ndarray) -> list[list[int]]:
    """Union of half-open ranges."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    first = np.flatnonzero(np.concatenate([[True], start[1:] > end[:-1]])) if len(start) else np.zeros(0, int)
    last = np.append(first[1:], len(start)) - 1 if len(start) else first
    return np.stack([start[first], end[last]], 1).tolist()


def search_shard(texts: list[np.ndarray], windows: Windows) -> dict[int, tuple[list[list[int]], list[str]]]:
    """Per document, given as word numbers, with a hit: merged word ranges, and the items found."""
    size = np.array([len(t) for t in texts], np.int64)
    total = int(size.sum())
    if not windows.shortest or not total:
        return {}
    symbols = np.concatenate(texts).astype(np.int64)
    doc = np.repeat(np.arange(len(texts)), size)
    inside = symbols > 0
    begins = inside & ~np.concatenate([[False], inside[:-1] & (doc[1:] == doc[:-1])])
    run = np.cumsum(begins)
    long_enough = np.bincount(run[inside], minlength=int(run[-1]) + 1) >= windows.shortest
    at = np.flatnonzero(inside & long_enough[run])
    if not len(at):
        return {}
    new_run = np.flatnonzero(np.diff(run[at]))  # places before a new run
    text = np.append(np.insert(symbols[at], new_run + 1, BREAK), 0)
    where = np.append(np.insert(at, new_run + 1, -1), -1)
    index = FmIndex(text)
    low, high = index.search(windows)
    hit = np.flatnonzero(low < high)
    many = high[hit] - low[hit]
    window = np.repeat(hit, many)
    place_ = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many) + low[window]
    start = where[index.locate(place_)]
    end = start + windows.size[window]
    of = doc[start]
    base = np.cumsum(size) - size
    found = {}
    order = np.argsort(of, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(of[order])) + 1):
        if len(part):
            d = int(of[part[0]])
            items = sorted({i for w in set(window[part].tolist()) for i in windows.owners[w]})
            found[d] = (merged(start[part] - base[d], end[part] - base[d]), items)
    return found


RESULT = "n_words long, spans array<array<int>>, items array<string>"


def scan(rows: DataFrame, shared, window: int, shard_words: int) -> DataFrame:
    """``rows``: columns to keep, then the text. The text is replaced by the columns of RESULT."""
    text_batches(rows.sparkSession)
    kept = rows.schema.fields[:-1]

    def run(batches):
        windows = Windows(shared.value, window)

        def emit(held, texts):
            found = search_shard(texts, windows)
            columns = pa.Table.from_batches(held).combine_chunks().to_batches()[0].columns if kept else []
            none = ([], [])
            return pa.RecordBatch.from_arrays(
                [
                    *columns,
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([found.get(i, none)[0] for i in range(len(texts))], pa.list_(pa.list_(pa.int32()))),
                    pa.array([found.get(i, none)[1] for i in range(len(texts))], pa.list_(pa.string())),
                ],
                names=[f.name for f in kept] + ["n_words", "spans", "items"],
            )

        held, texts, words = [], [], 0
        for whole in batches:
            for offset in range(0, whole.num_rows, 256):
                batch = whole.slice(offset, 256)
                part = [symbols_of(t, windows.number) for t in batch.column(batch.num_columns - 1).to_pylist()]
                held.append(batch.select(list(range(batch.num_columns - 1))))
                texts += part
                words += sum(map(len, part))
                if words >= shard_words:
                    yield emit(held, texts)
                    held, texts, words = [], [], 0
        if texts:
            yield emit(held, texts)

    return rows.mapInArrow(run, ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [RESULT]))


def cut(items: DataFrame, window: int, words: int) -> DataFrame:
    """``items`` with texts of more than ``words`` words cut into pieces that have the same windows together."""
    size = max(words, 2 * window)
    every = F.array_remove(F.split(F.col("text"), WORD_ENDS), "")
    pieces = F.transform(F.sequence(F.lit(1), F.size("words") - window + 1, F.lit(size - window + 1)), lambda at: F.array_join(F.slice("words", at, size), " "))
    long = items.where(F.length("text") > size).withColumn("words", every)
    pieces = F.when(F.size("words") > size, pieces).otherwise(F.array("text"))
    return items.where(F.length("text") <= size).union(long.select("item", F.explode(pieces).alias("text")))


def slices(benchmark: DataFrame, item: str, text: str, window: int, slice_words: int) -> tuple[int, Iterator[list[tuple[str, str]]]]:
    """The number of slices, and the items in lists of bounded size. Each list is fetched when it is asked for."""
    items = narrow(benchmark, item, text).toDF("item", "text").where("text is not null")
    items = items.select(F.coalesce(F.col("item").cast("string"), F.lit("")).alias("item"), F.col("text").cast("string").alias("text"))
    items = cut(items.distinct(), window, slice_words)  # copies of an item are one
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    count = max(1, -(-total // (4 * slice_words)))
    if count > 1:  # every slice reads them
        items = Scratch(benchmark.sparkSession, "decontaminate-items").store(items, "items")
    parts = (items.where(F.pmod(F.xxhash64("item", "text"), F.lit(count)) == i) for i in range(count))
    return count, (sorted((r[0], r[1]) for r in part.collect()) for part in parts)


def find(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    shard_words: int = SHARD_WORDS,
    slice_words: int = SLICE_WORDS,
) -> DataFrame:
    """``docs`` with its columns, ``n_words``, the merged word ranges ``spans`` to remove and the ``items`` found.

    The names of the three new columns must be free.
    """
    spark = docs.sparkSession
    own = flat(docs)
    t = F.col(place(docs, text)).cast("string").alias("_text")
    names = [*docs.columns, "n_words", "spans", "items"]
    count, parts = slices(benchmark, item, item_text, window, slice_words)
    if count == 1:
        return scan(own.select("*", t), spark.sparkContext.broadcast(next(parts)), window, shard_words).toDF(*names)
    scratch = Scratch(spark, "decontaminate")
    rows = scratch.store(own.withColumn("row_id", F.monotonically_increasing_id()), "rows")
    for number in range(count):
        shared = spark.sparkContext.broadcast(next(parts))  # the driver holds no other slice
        found = scan(rows.select("row_id", t), shared, window, shard_words)
        scratch.store(found.where("size(items) > 0"), f"part={number}")
        shared.destroy()
    merge = F.udf(lambda spans: merged(*np.array(sorted(s for part in spans for s in part)).T), "array<array<int>>")
    hits = spark.read.schema(f"row_id long, {RESULT}").parquet(scratch.base + "/part=*").groupBy("row_id")
    hits = hits.agg(F.collect_list("spans").alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    hits = hits.select("row_id", merge("spans").alias("spans"), "items")
    none = scan(rows.select("row_id", t), spark.sparkContext.broadcast([]), window, shard_words).select("row_id", "n_words")
    empty = [F.coalesce(c, F.array().cast(k)).alias(c) for c, k in (("spans", "array<array<int>>"), ("items", "array<string>"))]
    joined = rows.join(none, "row_id").join(hits, "row_id", "left")
    return joined.select(*own.columns, "n_words", *empty).toDF(*names)


def with_hits(found: DataFrame) -> DataFrame:
    """Adds ``n_hit``, the words inside spans, and ``contaminated``: at least a twentieth of all words."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + F.get(s, F.lit(1)) - F.get(s, F.lit(0)))
    return found.withColumn("n_hit", hit).withColumn("contaminated", F.expr("n_hit > 0 and 20 * n_hit >= n_words"))


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated."""
    names = docs.columns
    found = with_hits(find(flat(docs), benchmark, **{**options, "text": place(docs, options.get("text", "text"))}))
    return found.where("not contaminated").select(*flat(docs).columns).toDF(*names)


WORDS_SQL = r"""list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"""


@query(
    "op8_decontamination",
    f"""
    WITH docs AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
    tests AS (SELECT CAST(item_id AS VARCHAR) AS item, {WORDS_SQL} AS w FROM benchmark),
    sized AS (SELECT item, w, least(13, len(w)) AS size FROM tests WHERE len(w) > 0),
    starts AS (SELECT item, w, size, unnest(range(1, len(w) - size + 2)) AS pos FROM sized),
    windows AS (SELECT DISTINCT item, size, list_slice(w, pos, pos + size - 1) AS words FROM starts),
    sizes AS (SELECT DISTINCT size FROM windows),
    places AS (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS pos FROM docs, sizes),
    hits AS (SELECT p.doc_id, p.pos, p.size, x.item FROM places p JOIN windows x
        ON p.size = x.size AND list_slice(p.w, p.pos, p.pos + p.size - 1) = x.words),
    covered AS (SELECT doc_id, count(DISTINCT word) AS n_hit
        FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS word FROM hits) GROUP BY doc_id),
    found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
    SELECT d.doc_id, len(d.w) AS n_words, coalesce(c.n_hit, 0) AS n_hit, coalesce(f.n_items, 0) AS n_items,
        sha256(coalesce(f.items, '')) AS items_sha256,
        coalesce(c.n_hit, 0) > 0 AND 20 * coalesce(c.n_hit, 0) >= len(d.w) AS contaminated
    FROM docs d LEFT JOIN covered c ON c.doc_id = d.doc_id LEFT JOIN found f ON f.doc_id = d.doc_id
    """,
)
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = with_hits(find(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )
