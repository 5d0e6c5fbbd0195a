"""Ranked lexical search: term at a time over inverted lists, with a limit on accumulators.

A task turns its documents into inverted lists of the terms that the items have. Per item it takes the lists rarest
term first and adds up integer scores in accumulators. Once the most that the remaining lists could add is below the
kth best partial score, a document not met so far cannot come in: no accumulators are created any more, those that
cannot reach the kth best are given up, and the others are updated exactly, by looking them up in the lists. The best
``k`` of each shard are then ranked together.

* Terms: runs of characters other than ASCII non-alphanumerics, A-Z lower-cased. Scores are those of ``weight`` and
  ``impacts``: 64-bit integers but for one logarithm.
* Texts are read once and kept as counts of the items' terms (``tallies``); numbers of documents and terms, and the
  documents that hold a term, are counted over all of them. Items with equal texts are searched once.
* Items go to the tasks in slices of about ``slice_bytes`` of text, a list and its vocabulary at a time; one item is
  never cut. A shard has about ``shard_postings`` entries of lists, and at least one whole document.
* Equal scores are ranked by ascending key, null keys last; repeated rows are documents of their own, and repeated
  items are ranked each. Documents without terms are not counted; null or empty texts have none. Items without terms,
  or whose terms no document has, get no row. Extra columns do not matter. Empty tables give an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casebook.llm.common import Scratch, narrow, query, table
from casebook.llm.decontaminate import TO_WORDS, WORDS_SQL, words_of

BEST = 10
SLICE_BYTES = 1 << 22
SHARD_POSTINGS = 1 << 21


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def impacts(weights: np.ndarray, counts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return weights * ((1_000_000_000 * counts) // (1000 * counts + 8 * lengths))


def split(texts: pa.Array) -> pa.ListArray:
    """Lists of the terms of each text; empty strings may stand among them."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset)
    start, end = int(offsets[0]), int(offsets[-1])
    data = texts.buffers()[2][start:end].to_pybytes().translate(TO_WORDS) if end > start else b""
    return pc.ascii_split_whitespace(pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(offsets - start), pa.py_buffer(data)))


def tally(texts: pa.Array, vocabulary: pa.Array) -> tuple[np.ndarray, pa.ListArray, pa.ListArray]:
    """Per text: the number of its terms, the places in ``vocabulary`` of those that are in it, ascending, and their counts."""
    lists = split(texts)
    offsets = lists.offsets.to_numpy()
    terms = lists.flatten()
    filled = np.concatenate([[0], np.cumsum(pc.greater(pc.binary_length(terms), 0).to_numpy(zero_copy_only=False))])
    lengths = np.diff(filled[offsets - offsets[0]])
    found = pc.fill_null(pc.index_in(terms, value_set=vocabulary), -1).to_numpy(zero_copy_only=False)
    held = np.flatnonzero(found >= 0)
    owner = np.repeat(np.arange(len(texts)), np.diff(offsets))[held]
    pairs, counts = np.unique(owner * np.int64(len(vocabulary)) + found[held], return_counts=True)
    bounds = np.searchsorted(pairs, np.arange(len(texts) + 1) * np.int64(len(vocabulary)))
    lists_of = lambda values: pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, pa.int64()))
    return lengths, lists_of(pairs % max(1, len(vocabulary))), lists_of(counts)


class Shard:
    """Inverted lists of some documents, given in the order of their keys."""

    def __init__(self, lengths: np.ndarray, sizes: np.ndarray, terms: np.ndarray, counts: np.ndarray, weights: np.ndarray, total: tuple[int, int]):
        documents, words = total
        longs = np.array([25 + 75 * n * documents // words for n in lengths.tolist()], np.int64)
        owner = np.repeat(np.arange(len(lengths)), sizes)
        order = np.argsort(terms, kind="stable")
        self.documents = len(lengths)
        self.owner = owner[order]
        self.impact = impacts(weights[terms], counts, longs[owner])[order]
        self.terms, self.first = np.unique(terms[order], return_index=True)
        self.end = np.append(self.first[1:], len(terms))
        self.most = np.maximum.reduceat(self.impact, self.first) if len(terms) else np.zeros(0, np.int64)

    def best(self, item: list[tuple[int, int]], k: int) -> tuple[np.ndarray, np.ndarray]:
        """The best documents for ``(term, repeats)``, rarest first, and their scores above 0."""
        places = np.searchsorted(self.terms, [t for t, _ in item])
        lists = [(p, times) for p, (t, times) in zip(places.tolist(), item) if p < len(self.terms) and self.terms[p] == t]
        rest = np.zeros(len(lists) + 1, np.int64)  # the most that the lists from here on can add
        rest[:-1] = np.cumsum([self.most[p] * times for p, times in reversed(lists)], dtype=np.int64)[::-1] if lists else 0
        scores = np.zeros(self.documents, np.int64)
        survivors = None
        for at, (p, times) in enumerate(lists):
            docs, impact = self.owner[self.first[p] : self.end[p]], self.impact[self.first[p] : self.end[p]]
            if survivors is None and rest[at] <= rest[0] - rest[at]:  # else no partial score can be above the rest
                kth = np.partition(scores, -k)[-k] if self.documents > k else 0
                if rest[at] < kth:
                    survivors = np.flatnonzero(scores)
            elif survivors is not None:
                kth = np.partition(scores[survivors], -k)[-k]
            if survivors is None:
                scores[docs] += times * impact
                continue
            survivors = survivors[scores[survivors] + rest[at] >= kth]  # at least k of them
            place = np.minimum(np.searchsorted(docs, survivors), len(docs) - 1)
            met = docs[place] == survivors
            scores[survivors[met]] += times * impact[place[met]]
        among = np.flatnonzero(scores) if survivors is None else survivors
        among = among[np.lexsort((among, -scores[among]))][:k]
        return among, scores[among]


def _slices(texts: DataFrame, slice_bytes: int) -> Iterator[list[tuple[int, str]]]:
    """Lists of ``(text_id, text)``, each fetched when it is asked for."""
    total = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    count = max(1, -(-total // slice_bytes))
    for number in range(count):
        part = texts.where(F.pmod(F.xxhash64("text"), F.lit(count)) == number)
        if rows := part.collect():
            yield sorted((r.text_id, r.text) for r in rows)


def tallies(docs: DataFrame, shared) -> DataFrame:
    """``key, n_terms, terms, counts`` of each document of ``docs (key, text)`` for the broadcast vocabulary."""
    names = ["key", "n_terms", "terms", "counts"]
    longs = T.ArrayType(T.LongType(), False)
    schema = T.StructType([T.StructField(n, t) for n, t in zip(names, [docs.schema["key"].dataType, T.LongType(), longs, longs])])

    def run(batches):
        vocabulary = pa.array(shared.value, pa.large_string())
        for batch in batches:
            if batch.num_rows:
                lengths, terms, counts = tally(batch.column(1), vocabulary)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lengths, pa.int64()), terms, counts], names=names)

    return docs.mapInArrow(run, schema)


def _ranked_in_tasks(rows: DataFrame, shared, k: int, shard_postings: int) -> DataFrame:
    """``text_id, key, score``: the best of each shard of the tallied documents ``rows``."""
    names = ["text_id", "key", "score"]
    schema = T.StructType([T.StructField(n, t) for n, t in zip(names, [T.LongType(), rows.schema["key"].dataType, T.LongType()])])

    def run(batches):
        items, weights, total = shared.value
        parts, held = [], 0

        def ranked():
            rows = pa.Table.from_batches(parts).combine_chunks()
            rows = rows.take(pc.sort_indices(rows, [("key", "ascending")], null_placement="at_end")).combine_chunks()
            lists = rows.column("terms").combine_chunks(), rows.column("counts").combine_chunks()
            sizes = np.diff(lists[0].offsets.to_numpy())
            shard = Shard(rows.column("n_terms").to_numpy(), sizes, *[x.flatten().to_numpy() for x in lists], weights, total)
            found = [(text_id, *shard.best(item, k)) for text_id, item in items]
            ids = np.repeat([t for t, _, _ in found], [len(d) for _, d, _ in found])
            docs = np.concatenate([d for _, d, _ in found])
            keys = rows.column("key").take(pa.array(docs, pa.int64())).combine_chunks()
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), keys, pa.array(np.concatenate([s for _, _, s in found]))], names=names)

        for batch in batches:
            start = 0
            ends = np.cumsum(pc.list_value_length(batch.column("terms")).to_numpy(zero_copy_only=False))
            while start < batch.num_rows:
                done = int(ends[start - 1]) if start else 0
                end = min(int(np.searchsorted(ends, done + shard_postings - held)) + 1, batch.num_rows)
                parts.append(batch.slice(start, end - start))
                held += int(ends[end - 1]) - done
                start = end
                if held >= shard_postings:
                    yield ranked()
                    parts, held = [], 0
        if parts:
            yield ranked()

    return rows.mapInArrow(run, schema)


def search(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    k: int = BEST,
    slice_bytes: int = SLICE_BYTES,
    shard_postings: int = SHARD_POSTINGS,
) -> DataFrame:
    """One row per item and rank: ``item, rank, key, score``, named as the columns they come from."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "ranked-search")
    docs = narrow(docs, key, text).select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    wanted = narrow(items, item, item_text).select(F.col(item).alias("item"), F.col(item_text).cast("string").alias("text"))
    wanted = scratch.store(wanted.where("text is not null").withColumn("item_row", F.monotonically_increasing_id()), "items")
    texts = scratch.store(wanted.select("text").distinct().withColumn("text_id", F.monotonically_increasing_id()), "texts")
    bests = []
    for number, part in enumerate(_slices(texts, slice_bytes)):
        bags = [(text_id, Counter(words_of(body))) for text_id, body in part]
        vocabulary = sorted({term for _, bag in bags for term in bag})
        shared = spark.sparkContext.broadcast([t.decode() for t in vocabulary])
        rows = scratch.store(tallies(docs, shared), f"tallies-{number}")
        total = rows.agg(F.count_if(F.col("n_terms") > 0), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
        held_by = dict(rows.select(F.explode("terms").alias("term")).groupBy("term").count().collect())  # one number a term of the slice
        place = {term: i for i, term in enumerate(vocabulary)}
        weights = np.array([weight(total[0], held_by.get(i, 0)) for i in range(len(vocabulary))], np.int64)
        lists = [(text_id, sorted(((place[t], n) for t, n in bag.items()), key=lambda p: (held_by.get(p[0], 0), p[0]))) for text_id, bag in bags]
        told = spark.sparkContext.broadcast((lists, weights, tuple(total)))
        bests.append(scratch.store(_ranked_in_tasks(rows.where("size(terms) > 0"), told, k, shard_postings), f"best-{number}"))
        scratch.drop(f"tallies-{number}")
        shared.destroy()
        told.destroy()
    if not bests:
        bests = [docs.limit(0).select(F.lit(0).cast("long").alias("text_id"), "key", F.lit(0).cast("long").alias("score"))]
    best = bests[0]
    for more in bests[1:]:
        best = best.union(more)
    order = Window.partitionBy("text_id").orderBy(F.desc("score"), F.col("key").asc_nulls_last())
    top = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    ranked = wanted.join(texts, "text").select("item", "text_id").join(top, "text_id")
    return ranked.select("item", "rank", "key", "score").toDF(item, "rank", key, "score")


@query(
    "op13_ranked_search",
    f"""
    WITH docs AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
    tests AS (SELECT item_id, {WORDS_SQL} AS w FROM benchmark),
    totals AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM docs WHERE len(w) > 0),
    words AS (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM docs),
    tf AS (SELECT doc_id, n, term, count(*) AS tf FROM words GROUP BY doc_id, n, term),
    df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
    asked AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(w) AS term FROM tests) GROUP BY item_id, term),
    weighed AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w FROM df, totals),
    scored AS (SELECT a.item_id, t.doc_id,
        CAST(sum(a.times * g.w * ((1000000000 * t.tf) // (1000 * t.tf + 8 * (25 + (75 * t.n * n_docs) // n_terms)))) AS BIGINT) AS score
        FROM asked a JOIN tf t ON t.term = a.term JOIN weighed g ON g.term = a.term, totals GROUP BY a.item_id, t.doc_id)
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
    FROM scored WHERE score > 0 QUALIFY rank <= 10
    """,
)
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
