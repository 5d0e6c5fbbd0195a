"""Exact de-duplication by block naming, in DataFrame operations only.

A normalised text is cut into blocks of ``block`` bytes. Distinct blocks are sorted and numbered; then
adjacent names are paired, distinct pairs are sorted and numbered, and so on, until a document has one
name. Names stand for exact content, so equal ``(round, name)`` means equal text: no hash decides.

Only what can be equal is moved. A block whose 64-bit hash occurs once in the corpus occurs once, so it
needs no number: its document has no twin. Documents without such a block go through the naming, and
their text is found by a broadcast filter of fixed size instead of a shuffle of all texts.

* Equal: the same bytes after lower-casing A-Z. Null text counts as empty; empty texts are one group.
* The row with the largest key stays; a null key is smaller than any other, and of rows with equal keys
  one stays. Repeated rows are documents of their own. Extra columns do not matter, whatever their names;
  ``deduplicate`` keeps them. An empty table gives an empty result.
* A document of n blocks takes ``ceil(log2(n))`` rounds; each round handles only documents not yet named.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.llm.common import Scratch, flat, key_filter, lower_ascii, may_hold, narrow, place, query, table, without

BLOCK_BYTES = 2048
NO_NAME = -1  # the right half of an odd pair


def numbered(scratch: Scratch, values: DataFrame, by: list[str], name: str, rows: int | None = None) -> DataFrame:
    """The distinct rows of ``values``, sorted in each partition of a shuffle, with an integer each; stored once."""
    ordered = values.distinct().sortWithinPartitions(*by)
    return scratch.store(ordered.withColumn("name", F.monotonically_increasing_id()), name, rows)


def named(scratch: Scratch, rows: DataFrame) -> DataFrame:
    """``rows (row_id, pos, parts, block)`` to ``(row_id, round, name)``: one name per document.

    ``parts`` is the number of names that the document still has.
    """
    names = numbered(scratch, rows.select("block"), ["block"], "blocks")
    level = scratch.store(rows.join(names, "block").select("row_id", "pos", "parts", "name"), "level-0")
    result, step = None, 0
    while True:
        done = level.where("parts = 1").select("row_id", F.lit(step).alias("round"), "name")
        result = done if result is None else result.union(done)
        left = level.where("parts > 1")
        total = left.count()
        if not total:
            return result
        value = F.col("name")
        pairs = left.groupBy("row_id", F.shiftright("pos", 1).alias("pos")).agg(
            F.shiftright(F.first("parts") + 1, 1).alias("parts"),
            F.max(F.when(F.col("pos") % 2 == 0, value)).alias("left"),
            F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, value)), F.lit(NO_NAME)).alias("right"),
        )
        pairs = scratch.store(pairs, f"pairs-{step}", total)
        names = numbered(scratch, pairs.select("left", "right"), ["left", "right"], f"names-{step}", total)
        step += 1
        level = scratch.store(pairs.join(names, ["left", "right"]).select("row_id", "pos", "parts", "name"), f"level-{step}", total)
        scratch.drop(f"pairs-{step - 1}", f"names-{step - 1}")


def classified(scratch: Scratch, rows: DataFrame, key: str, text: str, block: int) -> tuple[DataFrame, DataFrame]:
    """For stored ``rows`` with a ``row_id``: hashes and SHA-256 per row, and the rows that share their text."""
    norm = F.col("norm")
    starts = F.sequence(F.lit(0), F.greatest(F.ceil(F.length(norm) / block) - 1, F.lit(0)).cast("int"))
    blocks = F.transform(starts, lambda i: F.substring(norm, i * block + 1, F.lit(block)))
    texts = rows.select("row_id", lower_ascii(F.col(f"`{text}`").cast("string")).cast("binary").alias("norm"))
    hashed = scratch.store(
        texts.select("row_id", F.sha2(norm, 256).alias("text_sha256"), F.transform(blocks, lambda b: F.xxhash64(b)).alias("hashes")),
        "hashed",
    )
    each = hashed.select("row_id", F.explode("hashes").alias("hash"))
    lonely = each.groupBy("hash").agg(F.count("*").alias("n"), F.min("row_id").alias("row_id")).where("n = 1").select("row_id")
    twins = scratch.store(hashed.select("row_id").join(lonely, "row_id", "left_anti"), "twins")

    near = may_hold(texts, "row_id", key_filter(scratch, twins, "row_id", "twin-bits"))
    parts = F.greatest(F.ceil(F.length(norm) / block), F.lit(1)).cast("int")
    whole = F.transform(starts, lambda i: F.struct(i.alias("pos"), parts.alias("parts"), F.substring(norm, i * block + 1, F.lit(block)).alias("block")))
    cut = near.join(twins, "row_id").select("row_id", F.explode(whole).alias("b")).select("row_id", "b.*")
    cut = scratch.store(cut, "cut")
    members = named(scratch, cut).join(rows.select("row_id", F.col(f"`{key}`").alias("_key")), "row_id")
    group = members.groupBy("round", "name").agg(
        F.count("*").alias("group_size"),
        F.max(F.struct(F.col("_key").isNotNull().alias("known"), F.col("_key").alias("key"), "row_id")).alias("best"),
    )
    found = scratch.store(
        members.select("row_id", "round", "name")
        .join(group.where("group_size > 1"), ["round", "name"])
        .select("row_id", F.col("best.key").alias("keep_id"), F.col("best.row_id").alias("keep_row"), "group_size"),
        "found",
    )
    scratch.drop("cut", "twins", "blocks")
    return hashed.select("row_id", "text_sha256"), found


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text", block: int = BLOCK_BYTES) -> DataFrame:
    """Per row of ``docs``: its key, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``."""
    scratch = Scratch(docs.sparkSession, "exact-dedup")
    rows = scratch.store(narrow(docs, key, text).withColumn("row_id", F.monotonically_increasing_id()), "rows")
    shas, found = classified(scratch, rows, key, text, block)
    return (
        rows.select("row_id", F.col(f"`{key}`").alias("_key"))
        .join(shas, "row_id")
        .join(found, "row_id", "left")
        .select(
            F.col("_key").alias(key),
            F.when(F.col("keep_row").isNull(), F.col("_key")).otherwise(F.col("keep_id")).alias("keep_id"),
            F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
            (F.coalesce("keep_row", "row_id") == F.col("row_id")).alias("kept"),
            "text_sha256",
        )
    )


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", block: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    scratch = Scratch(docs.sparkSession, "exact-dedup")
    rows = scratch.store(flat(docs).withColumn("row_id", F.monotonically_increasing_id()), "rows")
    _, found = classified(scratch, rows, place(docs, key), place(docs, text), block)
    dropped = scratch.store(found.where("keep_row <> row_id").select("row_id"), "dropped")
    return without(rows, "row_id", dropped, key_filter(scratch, dropped, "row_id", "dropped-bits")).drop("row_id").toDF(*docs.columns)


@query(
    "op5_exact_dedup",
    """
    WITH rows AS (
        SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
        FROM documents
    ), groups AS (
        SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM rows GROUP BY norm
    )
    SELECT r.doc_id, g.keep_id, g.group_size, r.doc_id = g.keep_id AS kept, sha256(r.norm) AS text_sha256
    FROM rows r JOIN groups g ON r.norm = g.norm
    """,
)
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups(table(spark, sf_dir, "documents"))
