"""What several operators share: stored intermediate tables, row ids, and bounded filters."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.session import shared_dir

Query = Callable[[SparkSession, str], DataFrame]

BATCH_BYTES = "8m"
ROWS_PER_TASK = 250_000  # of narrow tables
FEWEST_WORDS, FILTER_WORDS = 1 << 14, 1 << 20  # of 64 bits in a key filter: 16 MB at most, whatever the input


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        if name in ENTRIES:
            raise ValueError(f"query {name} is registered twice")
        ENTRIES[name] = Entry(run, sql)
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_batches(spark: SparkSession) -> None:
    """Batches of BATCH_BYTES between Spark and Python: whole texts make the usual 64 MB heavy on a task's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


_scopes: list[list[Scratch]] = []


@contextmanager
def temporary() -> Iterator[None]:
    """Removes the tables of every ``Scratch`` made inside, at the end and on errors. What is to last must be stored by one made outside."""
    _scopes.append([])
    try:
        yield
    finally:
        for scratch in _scopes.pop():
            scratch.remove()


class Scratch:
    """Tables written to the shared folder, so that later steps neither compute nor number rows anew.

    They stay until ``remove`` is called, or the ``temporary`` block ends that they were made in.
    """

    def __init__(self, spark: SparkSession, label: str):
        text_batches(spark)
        self.spark = spark
        self.base = shared_dir(spark, label)
        if _scopes:
            _scopes[-1].append(self)
        self._schemas: dict[str, object] = {}

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def store(self, df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
        """Writes ``df`` and reads it back; rows keep what was written even if executors are lost.

        Give ``rows``, the most there can be, for narrow tables that are cheap to compute: they
        are then written by no more tasks, and into no more files, than so many rows need.
        """
        if rows is not None:
            df = df.coalesce(max(1, -(-rows // ROWS_PER_TASK)))
        df.write.mode("overwrite").option("compression", "zstd").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        """Deletes tables that nothing reads any more."""
        for name in names:
            self._delete(self.path(name))

    def remove(self) -> None:
        """Deletes all tables, and the folder made for them."""
        self._delete(self.base.rpartition("/")[0])

    def _delete(self, place: str) -> None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def flat(df: DataFrame) -> DataFrame:
    """``df`` with the columns ``c0, c1, ...``, so that no name of its own can clash with an operator's."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def place(df: DataFrame, name: str) -> str:
    """The name that ``flat`` gives to the column spelled exactly ``name``, or else in another case."""
    names = df.columns
    if name not in names:
        names = [c.lower() for c in names]
        name = name.lower()
    return f"c{names.index(name)}"


def narrow(df: DataFrame, *names: str) -> DataFrame:
    """The named columns alone, whatever the others are called."""
    return flat(df).select(*[F.col(place(df, n)).alias(n) for n in names])


def lower_ascii(text: Column) -> Column:
    """Lower case for A-Z only; null becomes empty."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    value = F.coalesce(text, F.lit(""))
    ascii_only = F.octet_length(value) == F.char_length(value)  # these are lowered byte by byte, with next to no garbage
    return F.when(ascii_only, F.lower(value)).otherwise(F.translate(value, upper, upper.lower()))


@dataclass(frozen=True)
class KeyFilter:
    """Rows ``(word, bits)`` of a bit map of keys: at most ``words`` of them, so small enough to broadcast."""

    bits: DataFrame
    words: int


def key_filter(scratch: Scratch, keys: DataFrame, column: str, name: str) -> KeyFilter:
    """A filter over the stored ``keys``: eight bits for each key, but no more than FILTER_WORDS words.

    Keys that are in always pass; of others one in eight does, and more of them if the keys
    are too many for the map. So an exact join follows, which then has less to do.
    """
    words = FEWEST_WORDS
    total = keys.count()
    wanted = total / 8
    while words < wanted and words < FILTER_WORDS:
        words *= 2
    bit = F.pmod(F.xxhash64(column), F.lit(words * 64))
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("bit") % 64).cast("int"))
    by_word = keys.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).cast("int").alias("word"))
    return KeyFilter(scratch.store(by_word.agg(F.bit_or(mask).alias("bits")), name, min(total, words)), words)


def _flagged(df: DataFrame, column: str, keys: KeyFilter) -> DataFrame:
    bit = F.pmod(F.xxhash64(column), F.lit(keys.words * 64))
    renamed = keys.bits.select(F.col("word").alias("_filter_word"), F.col("bits").alias("_filter_bits"))
    joined = df.join(F.broadcast(renamed), F.shiftright(bit, 6).cast("int") == F.col("_filter_word"), "left")
    held = F.call_function("shiftright", F.col("_filter_bits"), (bit % 64).cast("int")).bitwiseAND(F.lit(1)) == 1
    return joined.withColumn("_held", F.coalesce(held, F.lit(False))).drop("_filter_word", "_filter_bits")


def may_hold(df: DataFrame, column: str, keys: KeyFilter) -> DataFrame:
    """The rows of ``df`` whose key may be among ``keys``; no shuffle of ``df``."""
    return _flagged(df, column, keys).where("_held").drop("_held")


def without(df: DataFrame, column: str, dropped: DataFrame, keys: KeyFilter) -> DataFrame:
    """The rows of ``df`` whose key is not in ``dropped``. Only rows that the filter ``keys`` of ``dropped`` holds are shuffled."""
    flagged = _flagged(df, column, keys)
    sure = flagged.where("not _held").drop("_held")
    return sure.union(flagged.where("_held").drop("_held").join(dropped.select(column), column, "left_anti").select(sure.columns))


def components(scratch: Scratch, edges: DataFrame, name: str) -> DataFrame:
    """Connected components of ``edges (a, b)``: rows ``(id, component)`` with the smallest id of each.

    Alternating star contraction: each round joins every node to the smallest of its neighbours,
    first for larger neighbours and then for smaller ones. Rounds grow with the logarithm of the
    longest path; all work is joins and combined minima, so a hub costs a row per edge.
    """
    current = scratch.store(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        f"{name}-0",
    )
    total = current.count()  # contraction never adds edges
    if not total:
        return current.select(F.col("a").alias("id"), F.col("b").alias("component"))
    digest = None
    for step in range(1, 200):
        both = current.union(current.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        down = large.where("a > b")
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        hung = down.join(least, "a").where("b <> m").select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b"))
        following = scratch.store(hung.union(least.select("a", F.col("m").alias("b"))).distinct(), f"{name}-{step}", total)
        scratch.drop(f"{name}-{step - 1}")
        summary = following.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(summary) == digest:
            break
        digest, current = tuple(summary), following
    return following.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
        following.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    )
