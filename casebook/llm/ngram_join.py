"""Near-duplicate join on word shingles: Jaccard similarity with adaptive multi-match prefixes.

All pairs of texts with ``den * |A & B| >= num * |A | B|`` are found and joined to components.

1. Shingles are hashed to 64 bits and counted over the whole corpus in ``2**bits`` counters. From these
   come a fixed-size map of shingles that may repeat, and the most frequent ones with their counts.
2. A document's shingles are put in one global order, rare before frequent. If two documents are
   similar, their first ``n - o + l`` shingles (``o``: the overlap that the sizes ask for) share at least ``l``.
   Documents with equal sets become one; shingles that occur once are never moved.
3. The lengths of the lists a document's prefix meets give its estimated cost for each ``l`` up to
   ``MOST_MATCHES``; the cheapest is taken, and a pair must then share so many prefix shingles.
4. Each document is first verified against pivots of its lists, in STAR_ROUNDS rounds. What is linked is
   contracted, so a group of near copies costs rows per member. Only pairs between components are left:
   per list, members outside its largest component meet the others. A pair goes on if the parities of both
   sets, 1,024 bits each, allow so few differing shingles; then matches are counted, and sets compared.

* Words: after lower-casing A-Z, runs of anything but space and 0x09-0x0D. Texts with fewer words than a
  shingle have one shingle, the whole sequence; null texts and texts without words have none and are
  linked with nothing. Equal sets are linked. Repeated rows are documents of their own; extra columns do
  not matter. An empty table gives an empty result.
* Component ids are the smallest keys; null keys are passed over while any other is there.
* Hashes of shingles stand for shingles: two of one pair's n shingles collide with odds of n * n / 2**65.
"""

from __future__ import annotations

import math
from itertools import starmap

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.llm.common import Scratch, components, flat, key_filter, may_hold, narrow, place, query, table, without

SHINGLE_WORDS = 3
SIMILARITY = (90, 100)
MOST_MATCHES = 4
VERIFY_COST = 0.02  # of one shingle of a candidate, against one list entry
MOST_BITS = 28  # of the counters: a map of 32 MB at most
MOST_FREQUENT = 1 << 21  # shingles whose counts are told to all tasks: 16 MB at most
PARITY_BITS = 1024
STAR_ROUNDS = 1  # of linking documents to pivots, before pairs are formed
FLUSH = 1 << 22
DOCUMENTS_PER_TASK = 100_000  # whose counters one task sums up at most, as long as there are counters enough
PART_BYTES = 1 << 20

TO_WORDS = bytes((b + 32 if 65 <= b <= 90 else 32 if 9 <= b <= 13 else b) for b in range(256))


def word_hashes(text: str | None) -> np.ndarray:
    data = (text or "").encode().translate(TO_WORDS)
    parts, start = [], 0
    while start < len(data):
        end = data.find(b" ", start + PART_BYTES)
        end = len(data) if end < 0 else end
        words = data[start:end].split()
        parts.append(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)))
        start = end
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``size`` words."""
    words = word_hashes(text)
    if not len(words):
        return words
    take = min(size, len(words))
    a, b = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
    count = len(words) - take + 1
    mixed = np.full(count, take, np.uint64) * a
    for i in range(take):
        mixed = (mixed ^ (mixed >> np.uint64(29))) * b + words[i : i + count] * a
    mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed * a)


def own_overlap(n, num: int, den: int):
    """The least overlap of a set of ``n`` with any similar set."""
    return -(-n * num // den)


def count_shingles(scratch: Scratch, rows: DataFrame, words: int, bits: int, expected: int) -> DataFrame:
    """Per block of 65,536 counters: the sum, a bit for each counter over one, and counters of 8 or more."""

    def local(batches):
        held, size = [], 0

        def emit():
            buckets = np.sort(np.concatenate(held)) >> np.uint64(64 - bits)
            blocks = buckets >> np.uint64(16)
            cut = np.flatnonzero(np.diff(blocks, prepend=np.uint64(1 << 40)))
            low = (buckets & np.uint64(0xFFFF)).astype("<u2")
            parts = [low[s:e].tobytes() for s, e in zip(cut, np.append(cut[1:], len(low)))]
            return pa.record_batch({"block": pa.array(blocks[cut].astype(np.int32)), "low": pa.array(parts, pa.binary())})

        for batch in batches:
            for text in batch.column(0):
                found = shingles(text.as_py(), words)
                held.append(found)
                size += len(found)
                if size >= FLUSH:
                    yield emit()
                    held, size = [], 0
        if size:
            yield emit()

    def total(batches):
        def done(block, counts):
            high = np.flatnonzero(counts >= 8)
            repeats = np.packbits(counts > 1, bitorder="little").tobytes()
            return [block, int(counts.sum()), repeats, high.astype("<u2").tobytes(), counts[high].astype("<u4").tobytes()]

        names = ["block", "total", "repeats", "high", "counts"]
        types = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        record = lambda row: pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=names)
        current, counts = None, None
        for batch in batches:
            for block, low in zip(batch.column(0).to_pylist(), batch.column(1)):
                if block != current:
                    if current is not None:
                        yield record(done(current, counts))
                    current, counts = block, np.zeros(1 << 16, np.int64)
                counts += np.bincount(np.frombuffer(low.as_buffer(), "<u2"), minlength=1 << 16)
        if current is not None:
            yield record(done(current, counts))

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(parts, min(1 << (bits - 16), expected // DOCUMENTS_PER_TASK))
    lists = rows.select("text").mapInArrow(local, "block int, low binary")
    summed = lists.repartition(parts, "block").sortWithinPartitions("block")
    return scratch.store(summed.mapInArrow(total, "block int, total long, repeats binary, high binary, counts binary"), "counts")


def frequencies(counts: DataFrame, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The map of repeated counters, and the most frequent ones with their counts: all of bounded size."""
    total = counts.agg(F.sum("total")).first()[0] or 0
    least = max(8, math.ceil(total / MOST_FREQUENT))

    def select(batches):
        for batch in batches:
            high = [np.frombuffer(v, "<u2") for v in batch.column("high").to_pylist()]
            number = [np.frombuffer(v, "<u4") for v in batch.column("counts").to_pylist()]
            keep = [n >= least for n in number]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("block"),
                    batch.column("repeats"),
                    pa.array([h[k].tobytes() for h, k in zip(high, keep)], pa.binary()),
                    pa.array([n[k].tobytes() for n, k in zip(number, keep)], pa.binary()),
                ],
                names=["block", "repeats", "high", "counts"],
            )

    repeats = np.zeros((1 << bits) // 8, np.uint8)
    high, number = [np.zeros(0, np.uint32)], [np.zeros(0, np.uint32)]
    for row in counts.mapInArrow(select, "block int, repeats binary, high binary, counts binary").orderBy("block").toLocalIterator():
        repeats[row.block << 13 : (row.block + 1) << 13] = np.frombuffer(row.repeats, np.uint8)
        high.append(np.frombuffer(row.high, "<u2").astype(np.uint32) + np.uint32(row.block << 16))
        number.append(np.frombuffer(row.counts, "<u4"))
    return repeats, np.concatenate(high), np.concatenate(number)


def prefixes(rows: DataFrame, words: int, num: int, den: int, bits: int, shared) -> DataFrame:
    """Per document: the size and digest of its set, and the shingles of its prefix that may repeat, with their places."""

    def run(batches):
        repeats, high, number = shared.value
        shift = np.uint64(64 - bits)

        def prefix(found):
            bucket = (found >> shift).astype(np.int64)
            may_repeat = (repeats[bucket >> 3] >> (bucket & 7)) & 1
            count = 1 + may_repeat.astype(np.int64)
            if len(high):
                at = np.minimum(np.searchsorted(high, bucket), len(high) - 1)
                count = np.where(high[at] == bucket, number[at], count)
            n = len(found)
            length = min(n, n - own_overlap(n, num, den) + MOST_MATCHES)
            order = np.argsort(count, kind="stable")[:length]  # hashes ascend, so ties are in order of hash
            places = np.flatnonzero(may_repeat[order])
            return n, xxhash.xxh3_128_digest(found.tobytes()), found[order[places]].astype(np.int64), places

        for whole in batches:
            for offset in range(0, whole.num_rows, 2000):
                batch = whole.slice(offset, 2000)
                sets = [shingles(t, words) for t in batch.column(1).to_pylist()]
                n, digest, tokens, places = zip(*map(prefix, sets))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array(n, pa.int64()),
                        pa.array(digest, pa.binary()),
                        pa.array(tokens, pa.list_(pa.int64())),
                        pa.array(places, pa.list_(pa.int32())),
                    ],
                    names=["row_id", "n", "digest", "tokens", "places"],
                )

    return rows.select("row_id", "text").mapInArrow(run, "row_id long, n long, digest binary, tokens array<long>, places array<int>")


def parities(found: np.ndarray) -> np.ndarray:
    """Of how many shingles fall in each of PARITY_BITS classes, as bits. Two sets differ in at least as many shingles as bits."""
    odd = np.bincount((found >> np.uint64(20)).astype(np.int64) % PARITY_BITS, minlength=PARITY_BITS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def sets_of(rows: DataFrame, words: int) -> DataFrame:
    def run(batches):
        for whole in batches:
            for offset in range(0, whole.num_rows, 1000):
                batch = whole.slice(offset, 1000)
                found = [shingles(t, words) for t in batch.column(1).to_pylist()]
                items = pa.array([s.tobytes() for s in found], pa.binary())
                bits = pa.array([parities(s) for s in found], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column(0), items, bits], names=["id", "items", "bits"])

    return rows.select("row_id", "text").mapInArrow(run, "id long, items binary, bits array<long>")


def verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The similar ones of ``pairs (a, b)``."""

    def similar(x: bytes, y: bytes) -> bool:
        x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        both = np.sort(np.concatenate([x, y]), kind="stable")
        return (den + num) * int((both[1:] == both[:-1]).sum()) >= num * (len(x) + len(y))

    def run(batches):
        for whole in batches:
            for offset in range(0, whole.num_rows, 500):
                batch = whole.slice(offset, 500)
                keep = list(starmap(similar, zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())))
                yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("id").alias("a"), F.col("items").alias("a_items"))
    right = sets.select(F.col("id").alias("b"), F.col("items").alias("b_items"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "a_items", "b_items").mapInArrow(run, "a long, b long")


def pair_overlap(n: Column, m: Column, num: int, den: int) -> Column:
    """The least overlap of two similar sets of these sizes."""
    return F.ceil((n + m) * num / F.lit(float(den + num)) - F.lit(1e-9))


def may_match(x: str, y: str, num: int, den: int) -> Column:
    """Whether a shingle at these places counts for the pair, given the matches asked of both."""
    c = lambda side, name: F.col(f"{side}.{name}")
    need = pair_overlap(c(x, "n"), c(y, "n"), num, den)
    matches = F.greatest(c(x, "matches"), c(y, "matches"))
    return (
        (c(x, "n") * den >= c(y, "n") * num)
        & (c(y, "n") * den >= c(x, "n") * num)
        & (c(x, "place") < c(x, "n") - need + matches)
        & (c(y, "place") < c(y, "n") - need + matches)
    )


def may_be_similar(x: str, y: str, num: int, den: int) -> Column:
    """False where the parities show more differing shingles than a similar pair of these sizes can have."""
    n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
    differ = [F.bit_count(F.col(f"{x}.bits")[i].bitwiseXOR(F.col(f"{y}.bits")[i])) for i in range(PARITY_BITS // 64)]
    return sum(differ[1:], differ[0]) <= n + m - 2 * pair_overlap(n, m, num, den)


def with_matches(lists: DataFrame, num: int, den: int) -> DataFrame:
    """Adds ``matches``, how many shared prefix shingles are asked for, the cheapest number by the document's lists,
    and ``weight``, the other entries of those lists: high for the documents in the middle of a group of near copies,
    as they have the fewest rare shingles of their own.
    """
    own = F.ceil(F.col("n") * num / F.lit(float(den)) - F.lit(1e-9))
    meets = [F.sum(F.when(F.col("place") < F.col("n") - own + k, F.col("df") - 1).otherwise(0)) for k in range(1, MOST_MATCHES + 1)]
    costs = [meet * (1 + VERIFY_COST * F.first("n") / k) for k, meet in enumerate(meets, 1)]
    best = F.array_position(F.array(*costs), F.least(*costs)).cast("int").alias("matches")
    return lists.join(lists.groupBy("id").agg(best, meets[-1].alias("weight")), "id")


def star_pairs(grouped: DataFrame, turn: int, num: int, den: int) -> DataFrame:
    """For each document of lists with several components, a partner per kind of pivot: ``a, b``.

    A list's pivots are the heaviest member of its largest component, and one that a hash picks there.
    A document outside that component takes the pivots that most of its lists offer.
    """
    sizes = grouped.groupBy("token", "component").agg(
        F.count("*").alias("members"),
        F.max(F.struct("weight", "id", "n", "place")).alias("heavy"),
        F.max(F.struct(F.xxhash64("id", F.lit(turn)).alias("weight"), "id", "n", "place")).alias("any"),
    )
    largest = F.struct("members", "heavy.weight", "component")
    main = sizes.groupBy("token").agg(
        F.count("*").alias("groups"), F.max_by(F.struct("component", "heavy", "any"), largest).alias("main"), F.max("any").alias("some")
    )
    main = main.where("groups > 1").select("token", "main", "some")
    outside = grouped.join(main, "token").where("component <> main.component")
    pairs = None
    for pivot in ("main.heavy", "main.any", "some"):
        met = outside.select(F.struct("id", "n", "place", "matches").alias("x"), F.struct(f"{pivot}.id", f"{pivot}.n", f"{pivot}.place", "matches").alias("y"))
        met = met.where(F.col("x.id") != F.col("y.id")).where(may_match("x", "y", num, den))
        met = met.groupBy(F.col("x.id").alias("x"), F.col("y.id").alias("y")).agg(F.count("*").alias("shared"))
        best = met.groupBy("x").agg(F.max(F.struct("shared", "y"))["y"].alias("y"))
        pairs = best if pairs is None else pairs.union(best)
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def links(scratch: Scratch, rows: DataFrame, words: int, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """For stored ``rows (row_id, text)``: each row's set size and class, and the component of each linked class.

    A class is the smallest ``row_id`` of the rows with its set.
    """
    spark = rows.sparkSession
    expected = rows.count()
    bits = min(MOST_BITS, max(18, math.ceil(math.log2(expected + 1)) + 10))
    counts = count_shingles(scratch, rows, words, bits, expected)
    shared = spark.sparkContext.broadcast(frequencies(counts, bits))
    documents = scratch.store(prefixes(rows, words, num, den, bits, shared), "documents")
    shared.destroy()

    # stored apart, so that the join can split the rows of a hot set
    classes = scratch.store(documents.where("n > 0").groupBy("digest").agg(F.min("row_id").alias("id")), "sets-seen", expected)
    classed = documents.select("row_id", "n", "digest").join(classes, "digest", "left").select("row_id", "n", "id")
    classed = scratch.store(classed, "classes", expected)
    first = classed.where("row_id = id").select("row_id")
    entries = (
        documents.where("size(tokens) > 0")
        .join(first, "row_id")
        .select(F.col("row_id").alias("id"), "n", F.explode(F.arrays_zip("tokens", "places")).alias("e"))
        .select("id", "n", F.col("e.tokens").alias("token"), F.col("e.places").alias("place"))
    )
    shared_tokens = entries.groupBy("token").agg(F.count("*").alias("df"))
    lists = scratch.store(entries.join(shared_tokens.where("df > 1"), "token"), "lists")
    size = lists.count()
    lists = scratch.store(with_matches(lists, num, den), "lists-with-matches", size)
    scratch.drop("counts", "documents", "lists")

    live = lists.select("id").distinct()
    ids = scratch.store(live.select(F.col("id").alias("row_id")), "live", size)
    near = may_hold(rows, "row_id", key_filter(scratch, ids, "row_id", "live-bits"))
    sets = scratch.store(sets_of(near, words), "sets")

    linked = scratch.store(spark.createDataFrame([], "a long, b long"), "no-links")
    tried = linked
    grouped = lists.withColumn("component", F.col("id"))
    for turn in range(STAR_ROUNDS):
        star = scratch.store(star_pairs(grouped, turn, num, den).join(tried, ["a", "b"], "left_anti"), f"star-{turn}", 2 * size)
        tried = tried.union(star)
        linked = linked.union(scratch.store(verified(star, sets, num, den), f"star-links-{turn}"))
        joined = components(scratch, linked, f"star-components-{turn}")
        grouped = lists.join(joined, "id", "left").withColumn("component", F.coalesce("component", "id"))
        grouped = scratch.store(grouped, f"grouped-{turn}", size)

    per_list = grouped.groupBy("token", "component").agg(F.count("*").alias("members"))
    main = per_list.groupBy("token").agg(F.count("*").alias("groups"), F.max_by("component", F.struct("members", "component")).alias("main"))
    mixed = grouped.drop("weight", "df").join(main.where("groups > 1").select("token", "main"), "token").join(sets.select("id", "bits"), "id")
    mixed = scratch.store(mixed, "mixed")
    x, y = mixed.where("component <> main").alias("x"), mixed.alias("y")
    once = (F.col("y.component") == F.col("y.main")) | (F.col("x.id") < F.col("y.id"))
    across = F.col("x.component") != F.col("y.component")
    need = pair_overlap(F.col("x.n"), F.col("y.n"), num, den)
    crossing = (
        x.join(y, (F.col("x.token") == F.col("y.token")) & across & once & may_match("x", "y", num, den) & may_be_similar("x", "y", num, den))
        .select(
            F.least("x.id", "y.id").alias("a"),
            F.greatest("x.id", "y.id").alias("b"),
            F.least(F.greatest("x.matches", "y.matches"), need).alias("asked"),
        )
        .groupBy("a", "b")
        .agg(F.count("*").alias("shared"), F.first("asked").alias("asked"))
        .where("shared >= asked")
        .select("a", "b")
        .join(tried, ["a", "b"], "left_anti")
    )
    crossing = scratch.store(crossing, "crossing")
    more = scratch.store(verified(crossing, sets, num, den), "crossing-links")
    scratch.drop("sets", "lists-with-matches", "mixed", *[f"grouped-{turn}" for turn in range(STAR_ROUNDS)])
    return classed, components(scratch, linked.union(more), "components")


def groups(scratch: Scratch, rows: DataFrame, key: str, text: str, words: int, similarity: tuple[int, int]) -> DataFrame:
    """Per row: ``row_id, n_shingles``, and ``component``, a ``row_id``."""
    num, den = similarity
    texts = rows.select("row_id", F.col(text).cast("string").alias("text"))
    classed, joined = links(scratch, texts, words, num, den)
    found = classed.join(joined, "id", "left")
    return found.select("row_id", F.col("n").alias("n_shingles"), F.coalesce("component", "id", "row_id").alias("component"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS, similarity: tuple[int, int] = SIMILARITY) -> DataFrame:
    """Per row of ``docs``: its key, ``n_shingles`` and ``component_id``."""
    scratch = Scratch(docs.sparkSession, "ngram-join")
    rows = scratch.store(narrow(docs, key, text).toDF("key", "text").withColumn("row_id", F.monotonically_increasing_id()), "rows")
    found = groups(scratch, rows, "key", "text", words, similarity).join(rows.select("row_id", "key"), "row_id")
    found = scratch.store(found, "found")
    # stored apart, so that the join can split the rows of a hot component
    least = scratch.store(found.groupBy("component").agg(F.min("key").alias("component_id")), "least")
    return found.join(least, "component").select(F.col("key").alias(key), "n_shingles", "component_id")


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS, similarity: tuple[int, int] = SIMILARITY) -> DataFrame:
    """``docs`` with one row of each component, that of the smallest key; all columns are kept."""
    scratch = Scratch(docs.sparkSession, "ngram-join")
    rows = scratch.store(flat(docs).withColumn("row_id", F.monotonically_increasing_id()), "rows")
    key_column = F.col(place(docs, key))
    found = groups(scratch, rows, place(docs, key), place(docs, text), words, similarity)
    found = scratch.store(found.join(rows.select("row_id", key_column.alias("key")), "row_id"), "found")
    order = F.struct(F.col("key").isNull().alias("unknown"), "key", "row_id")
    keep = found.groupBy("component").agg(F.min(order)["row_id"].alias("keep"))
    dropped = scratch.store(found.join(keep, "component").where("row_id <> keep").select("row_id"), "dropped")
    return without(rows, "row_id", dropped, key_filter(scratch, dropped, "row_id", "dropped-bits")).drop("row_id").toDF(*docs.columns)


@query(
    "op2_ngram_join",
    r"""
    WITH RECURSIVE words AS (
        SELECT doc_id, list_filter(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
        FROM documents
    ), sets AS (
        SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [w] ELSE list_distinct(list_transform(
            range(1, len(w) - 1), lambda i: [w[i], w[i + 1], w[i + 2]])) END AS shingles
        FROM words
    ), kinds AS (
        SELECT min(doc_id) AS kind, list_sort(shingles) AS shingles, len(shingles) AS n FROM sets WHERE len(shingles) > 0 GROUP BY 2, 3
    ), items AS (
        SELECT kind, n, unnest(shingles) AS shingle FROM kinds
    ), links AS (
        SELECT a.kind AS a, b.kind AS b FROM items a JOIN items b ON a.shingle = b.shingle AND a.kind < b.kind
            AND 10 * a.n >= 9 * b.n AND 10 * b.n >= 9 * a.n
        GROUP BY a.kind, b.kind, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
    ), edges AS (
        SELECT a, b FROM links UNION ALL SELECT b, a FROM links
    ), reached AS (
        SELECT kind AS origin, kind AS found FROM kinds
        UNION SELECT r.origin, e.b FROM reached r JOIN edges e ON r.found = e.a
    ), parts AS (
        SELECT origin, min(found) AS component FROM reached GROUP BY origin
    )
    SELECT s.doc_id, CAST(len(s.shingles) AS BIGINT) AS n_shingles, coalesce(p.component, s.doc_id) AS component_id
    FROM sets s LEFT JOIN kinds k ON list_sort(s.shingles) = k.shingles LEFT JOIN parts p ON p.origin = k.kind
    """,
)
def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
