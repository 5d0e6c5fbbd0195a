"""Hard negatives by an inverted multi-index over integer vectors.

Vectors are halved, and each half has a codebook; a row lies in the cell of its two nearest entries. For an anchor,
no row of a cell can score more than the sum over both halves of ``anchor * entry + |anchor| * radius``, the radius
being the greatest distance of any row to that entry. A heap visits the cells in falling order of that sum (the
multi-sequence of both halves), in rounds of growing numbers of cells. Rows of the visited cells are scored exactly.
An anchor is done when the next sum is below all that it still looks for: first its ``positives`` best rows of the same
label, then, for each of them, the ``negatives`` best rows of other labels in a window of scores below the positive's.

* The codebooks are fitted on at most ``CODEBOOK_ROWS`` rows, and have at most ``MOST_ENTRIES`` entries; they only
  decide which rows lie together. All rows are indexed, radii cover all rows, results are exact (recall 1).
* Rows lie in stored chunks by cell and part of a cell, so a cell with much of the table is many parts. Anchors go to
  the parts that they visit, in blocks, and meet them in a join. The best of each chunk are ranked per anchor.
* Scores are exact: floating-point products are used only where all sums are integers that they can hold. Ranges are
  compared as doubles, so exactly for scores up to 2^53.
* Rows with a null key, label, vector or component, or a component that is not finite, take no part. Shorter vectors
  count as ended by zeros. Higher scores come first, then smaller keys. Repeated rows are rows of their own, and so are
  rows that share a key; a row is no positive of itself. A window of a negative positive score is empty.
  Extra columns do not matter. Empty tables give an empty result.
"""

from __future__ import annotations

import dataclasses
import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casebook.llm.common import Scratch, narrow, query, table

CODEBOOK_ROWS = 4096
MOST_ENTRIES = 256
CELL_ROWS = 2048  # wanted rows of a cell, until the codebooks are full
CHUNK_ROWS = 2048
PART_ROWS = 16 * CHUNK_ROWS
BLOCK_ANCHORS = 256
FIRST_CELLS, GROWTH = 4, 8  # cells visited in the first round, and how many times as many after each later one

LONG = T.LongType()


@dataclass(frozen=True)
class Index:
    """What tasks need to know: ``entries`` and ``radii`` per half, parts of each cell that has rows, and number formats."""

    entries: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray]
    parts: dict[int, int]
    dims: int
    stored: str
    exact: str

    def halves(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return vectors[..., : self.dims // 2].astype(float), vectors[..., self.dims // 2 :].astype(float)


def matrix(lists: pa.Array, dims: int) -> np.ndarray:
    """Rows of integers, ended by zeros up to ``dims``."""
    size = np.diff(lists.offsets.to_numpy())
    values = np.zeros((len(size), dims), np.int64)
    values[np.arange(dims) < size[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return values


def codebook(points: np.ndarray, entries: int, rounds: int = 10) -> np.ndarray:
    """Entries by Lloyd's rounds, from evenly spaced distinct points."""
    if not len(points):
        return np.zeros((1, points.shape[1]))
    distinct = np.unique(points, axis=0)
    found = distinct[np.linspace(0, len(distinct) - 1, min(entries, len(distinct))).astype(int)].astype(float)
    for _ in range(rounds):
        nearest = distances(points, found).argmin(1)
        for i in range(len(found)):
            if (mine := nearest == i).any():
                found[i] = points[mine].mean(0)
    return found


def distances(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    return np.stack([np.sqrt(((points - e) ** 2).sum(1)) for e in entries], 1)


def visits(index: Index, vector: np.ndarray, threshold: float, ceiling: float = math.inf) -> Iterator[int]:
    """Cells with rows in falling order of what they can score, down to ``threshold``; not those in which every row scores more than ``ceiling``."""
    most, least = [], []
    for entries, radii, half in zip(index.entries, index.radii, index.halves(vector)):
        middle, reach = entries @ half, np.linalg.norm(half) * radii
        room = reach + 1e-9 * (np.abs(middle) + reach) + 1e-9  # for rounding
        most.append(middle + room)
        least.append(middle - room)
    order = [np.argsort(-m, kind="stable") for m in most]
    ranked = [m[o].tolist() for m, o in zip(most, order)]
    heap = [(-ranked[0][0] - ranked[1][0], 0, 0)]
    width = len(index.entries[1])
    while heap:
        bound, a, b = heapq.heappop(heap)
        if -bound < threshold:
            return
        if b + 1 < len(ranked[1]):
            heapq.heappush(heap, (-ranked[0][a] - ranked[1][b + 1], a, b + 1))
        if b == 0 and a + 1 < len(ranked[0]):
            heapq.heappush(heap, (-ranked[0][a + 1] - ranked[1][0], a + 1, 0))
        i, j = int(order[0][a]), int(order[1][b])
        if i * width + j in index.parts and least[0][i] + least[1][j] <= ceiling:
            yield i * width + j


def _lists(values: np.ndarray | pa.Array, sizes: list[int]) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), values if isinstance(values, pa.Array) else pa.array(values))


def build(scratch: Scratch, rows: DataFrame) -> tuple[Index, DataFrame]:
    """The index over ``rows (row, key, label, vector)`` and its chunks."""
    size, dims, largest = rows.agg(
        F.count(F.lit(1)),
        F.max(F.size("vector")),
        F.max(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))),
    ).first()
    dims, largest = max(2, dims or 0), (largest or 0) * (1 + 1e-9)
    exact = next((kind for bits, kind in ((24, "float32"), (53, "float64"), (63, "int64")) if largest < 2**bits), "object")
    stored = next(kind for bits, kind in ((30, "<i2"), (62, "<i4"), (2000, "<i8")) if largest < 2**bits)
    sample = rows.orderBy(F.xxhash64("row"), "row").limit(CODEBOOK_ROWS).select("vector").collect()
    points = np.zeros((len(sample), dims), np.int64)
    for i, (vector,) in enumerate(sample):
        points[i, : len(vector)] = vector
    entries = min(MOST_ENTRIES, max(1, math.ceil(math.sqrt(size / CELL_ROWS))))
    books = tuple(codebook(half.astype(float), entries) for half in (points[:, : dims // 2], points[:, dims // 2 :]))
    plain = Index(books, (np.zeros(0), np.zeros(0)), {}, dims, stored, exact)

    def assign(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            near = [distances(half, book) for half, book in zip(plain.halves(matrix(batch.column("vector"), dims)), books)]
            at = [d.argmin(1) for d in near]
            found = [pa.array(at[0] * len(books[1]) + at[1], pa.int64()), *[pa.array(d.min(1)) for d in near]]
            yield pa.RecordBatch.from_arrays([*batch.columns, *found], names=[*batch.schema.names, "cell", "first", "second"])

    doubles = [T.StructField(n, T.DoubleType()) for n in ("first", "second")]
    schema = T.StructType([*rows.schema.fields, T.StructField("cell", LONG), *doubles])
    assigned = scratch.store(rows.mapInArrow(assign, schema), "assigned")
    # one row per cell, of which there are no more than pairs of entries
    cells = assigned.groupBy("cell").agg(F.count(F.lit(1)).alias("size"), F.max("first"), F.max("second")).collect()
    radii = [np.zeros(len(book)) for book in books]
    for cell, _, first, second in cells:
        for half, (place, radius) in enumerate(((cell // len(books[1]), first), (cell % len(books[1]), second))):
            radii[half][place] = max(radii[half][place], radius)
    index = Index(books, tuple(radii), {c[0]: -(-c[1] // PART_ROWS) for c in cells}, dims, stored, exact)

    spark = rows.sparkSession
    parts = spark.createDataFrame(list(index.parts.items()), "cell long, parts int")
    placed = assigned.drop("first", "second").join(F.broadcast(parts), "cell")
    placed = placed.withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")).cast("long"))
    placed = placed.repartition("cell", "part").sortWithinPartitions("cell", "part", "key", "row")
    placed = placed.select("cell", "part", "row", "key", "label", "vector")

    def pack(batches):
        def chunk(rows):
            rows = pa.Table.from_batches(rows).combine_chunks()
            values = matrix(rows.column("vector").combine_chunks(), dims).astype(stored).tobytes()
            columns = [rows.column(c).slice(0, 1).combine_chunks() for c in ("cell", "part")]
            columns += [_lists(rows.column(c).combine_chunks(), [rows.num_rows]) for c in ("row", "key", "label")]
            return pa.RecordBatch.from_arrays([*columns, pa.array([values], pa.binary())], names=chunk_schema.names)

        held, count, here = [], 0, None
        for batch in batches:
            where = np.stack([batch.column(i).to_numpy() for i in range(2)], 1)
            cuts = np.flatnonzero((where[1:] != where[:-1]).any(1)) + 1
            for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                while start < end:
                    if held and (count == CHUNK_ROWS or here != tuple(where[start])):
                        yield chunk(held)
                        held, count = [], 0
                    here, upto = tuple(where[start]), min(end, start + CHUNK_ROWS - count)
                    held.append(batch.slice(start, upto - start))
                    count, start = count + upto - start, upto
        if held:
            yield chunk(held)

    of = {f.name: T.ArrayType(f.dataType) for f in rows.schema.fields}
    fields = [("cell", LONG), ("part", LONG), ("rows", T.ArrayType(LONG)), ("keys", of["key"]), ("labels", of["label"]), ("vectors", T.BinaryType())]
    chunk_schema = T.StructType([T.StructField(n, t) for n, t in fields])
    return index, scratch.store(placed.mapInArrow(pack, chunk_schema), "chunks")


def _planned(anchors: DataFrame, shared, skip: int, upto: int, goals: int) -> DataFrame:
    """Blocks of anchors for the parts of the cells that each visits as its ``skip + 1``-th to ``upto``-th.

    ``anchors`` has ``row, label, vector`` and ``goals`` many ``lows`` and ``highs``: scores that are still looked for.
    """
    label_type = anchors.schema["label"].dataType
    fields = [("cell", LONG), ("part", LONG), ("anchors", T.ArrayType(LONG)), ("anchor_labels", T.ArrayType(label_type))]
    fields += [("anchor_vectors", T.BinaryType()), ("lows", T.ArrayType(T.DoubleType())), ("highs", T.ArrayType(T.DoubleType()))]
    schema = T.StructType([T.StructField(n, t) for n, t in fields])

    def run(batches):
        index = Index(*shared.value)
        for whole in batches:
            for start in range(0, whole.num_rows, 4 * BLOCK_ANCHORS):
                batch = whole.slice(start, 4 * BLOCK_ANCHORS)
                vectors = matrix(batch.column("vector"), index.dims)
                lows, highs = (np.array(batch.column(c).to_pylist(), float).reshape(-1, goals) for c in ("lows", "highs"))
                visitors: dict[int, list[int]] = {}
                for at, vector in enumerate(vectors):
                    open_ = lows[at] <= highs[at]
                    if open_.any():
                        ways = visits(index, vector, lows[at][open_].min(), highs[at][open_].max())
                        for number, cell in enumerate(ways):
                            if number >= upto:
                                break
                            if number >= skip:
                                visitors.setdefault(cell, []).append(at)
                for cell, mine in visitors.items():
                    for first in range(0, len(mine), BLOCK_ANCHORS):
                        some = np.array(mine[first : first + BLOCK_ANCHORS])
                        parts = index.parts[cell]
                        once = [_lists(batch.column(c).take(pa.array(some)), [len(some)]) for c in ("row", "label")]
                        once.append(pa.array([vectors[some].astype(index.stored).tobytes()], pa.binary()))
                        once += [_lists(v[some].ravel(), [v[some].size]) for v in (lows, highs)]
                        columns = [pa.array([cell] * parts, pa.int64()), pa.array(range(parts), pa.int64())]
                        columns += [pa.concat_arrays([c] * parts) for c in once]
                        yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return anchors.mapInArrow(run, schema)


def _scored(met: DataFrame, shared, goals: int, best: int, same: bool) -> DataFrame:
    """``anchor, goal, row, key, score``: the ``best`` rows of each chunk for each goal of an anchor, of the same or of other labels."""
    key_type = met.schema["keys"].dataType.elementType
    fields = [("anchor", LONG), ("goal", LONG), ("row", LONG), ("key", key_type), ("score", LONG)]
    schema = T.StructType([T.StructField(n, t) for n, t in fields])

    def pair(index, row):
        numbers = pa.concat_arrays([row["anchor_labels"].values, row["labels"].values]).dictionary_encode().indices.to_numpy()
        anchors = row["anchors"].values.to_numpy()
        rows = row["rows"].values.to_numpy()
        a, b = (np.frombuffer(row[c].as_buffer(), index.stored).reshape(-1, index.dims).astype(index.exact) for c in ("anchor_vectors", "vectors"))
        lows, highs = (row[c].values.to_numpy().reshape(-1, goals) for c in ("lows", "highs"))
        kept, total = [], a @ b.T
        is_same = numbers[: len(a), None] == numbers[None, len(a) :]
        for at, scores in enumerate(total):
            open_ = np.flatnonzero(lows[at] <= highs[at])
            fits = (is_same[at] == same) & (scores >= lows[at][open_].min()) & (scores <= highs[at][open_].max())
            if same:
                fits &= rows != anchors[at]
            found = np.flatnonzero(fits)
            if not len(found):
                continue
            found = found[np.argsort(-scores[found], kind="stable")]  # rows of a chunk are in the order of their keys
            falling = -scores[found]
            for goal in open_:
                first = int(np.searchsorted(falling, -highs[at][goal], "left"))
                last = min(first + best, int(np.searchsorted(falling, -lows[at][goal], "right")))
                if first < last:
                    kept.append((at, goal, found[first:last]))
        if not kept:
            return None
        sizes = [len(f) for _, _, f in kept]
        owners, chosen = np.repeat([k[0] for k in kept], sizes), np.concatenate([k[2] for k in kept])
        columns = [pa.array(anchors[owners]), pa.array(np.repeat([k[1] for k in kept], sizes).astype(np.int64)), pa.array(rows[chosen])]
        scores = pa.array([int(s) for s in total[owners, chosen]], pa.int64())
        return pa.RecordBatch.from_arrays([*columns, row["keys"].values.take(pa.array(chosen)), scores], names=schema.names)

    def run(batches):
        index = Index(*shared.value)
        for batch in batches:
            for number in range(batch.num_rows):
                row = {name: column[number] for name, column in zip(batch.schema.names, batch.columns)}
                if (out := pair(index, row)) is not None:
                    yield out

    return met.mapInArrow(run, schema)


def _best(found: DataFrame, best: int) -> DataFrame:
    order = Window.partitionBy("anchor", "goal").orderBy(F.desc("score"), "key", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)


def _search(scratch: Scratch, label: str, index: Index, shared, chunks: DataFrame, anchors: DataFrame, goals: int, best: int, same: bool) -> DataFrame:
    """``anchor, goal, row, key, score, rank``: the ``best`` rows for each goal, whose cells are visited until none can matter.

    ``anchors`` has ``row, label, vector, lows, highs``. A goal is a range of scores; it closes from below
    as soon as ``best`` rows are known: what scores less than the last of them is no longer looked for.
    """
    total, number, seen, found = len(index.parts), 0, 0, None
    while seen < total:
        upto, state = FIRST_CELLS * GROWTH**number, anchors
        if found is not None:
            full = found.groupBy("anchor", "goal").agg(F.count(F.lit(1)).alias("n"), F.min("score").cast("double").alias("least"))
            known = full.where(F.col("n") >= best).groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("goal", "least"))).alias("least"))
            state = anchors.join(known.withColumnRenamed("anchor", "row"), "row", "left")
            raised = F.transform("lows", lambda low, i: F.greatest(low, F.col("least")[i.cast("long")]))
            state = state.withColumn("lows", raised).select(*anchors.columns)
        blocks = scratch.store(_planned(state, shared, seen, upto, goals), f"{label}-blocks-{number}")
        if blocks.isEmpty():
            break
        met = blocks.join(chunks, ["cell", "part"])
        more = _scored(met, shared, goals, best, same)
        if found is not None:
            more = more.union(found.select(more.columns))
        found = scratch.store(_best(more, best), f"{label}-found-{number}")
        scratch.drop(f"{label}-blocks-{number}", *[f"{label}-found-{number - 1}"] * (number > 0))
        number, seen = number + 1, upto
    if found is None:
        key_type = chunks.schema["keys"].dataType.elementType.simpleString()
        found = chunks.sparkSession.createDataFrame([], f"anchor long, goal long, row long, key {key_type}, score long, rank int")
    return found


def mine(
    rows: DataFrame,
    is_anchor: Column,
    key: str = "vec_id",
    label: str = "label",
    vector: str = "vector",
    positives: int = 5,
    negatives: int = 10,
    window: tuple[int, int] = (30, 90),
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the anchors among ``rows``.

    ``vector`` holds arrays of integers. ``is_anchor`` is a condition on the key column. A negative scores at
    least and at most the given hundredths of its positive.
    """
    scratch = Scratch(rows.sparkSession, "hard-negatives")
    source = narrow(rows, key, label, vector)
    flagged = source.select(is_anchor.alias("is_anchor"), F.col(key).alias("key"), F.col(label).alias("label"), F.col(vector).cast("array<bigint>").alias("vector"))
    whole = F.col("key").isNotNull() & F.col("label").isNotNull() & F.forall("vector", lambda x: x.isNotNull())
    flagged = scratch.store(flagged.where(whole).withColumn("row", F.monotonically_increasing_id()), "rows")
    index, chunks = build(scratch, flagged.select("row", "key", "label", "vector"))
    shared = rows.sparkSession.sparkContext.broadcast(dataclasses.astuple(index))
    anchors = flagged.where("is_anchor").select("row", "key", "label", "vector")

    def goals(low: Column, high: Column) -> list[Column]:
        return [low.cast("array<double>").alias("lows"), high.cast("array<double>").alias("highs")]

    open_ = goals(F.array(F.lit(-math.inf)), F.array(F.lit(math.inf)))
    near = _search(scratch, "positive", index, shared, chunks, anchors.select("row", "label", "vector", *open_), 1, positives, True)
    near = near.select("anchor", (F.col("rank") - 1).cast("long").alias("goal"), F.col("key").alias("positive_id"), F.col("score").alias("positive_score"))
    low = F.ceil(F.col("positive_score").cast("decimal(38,0)") * window[0] / 100)
    high = F.floor(F.col("positive_score").cast("decimal(38,0)") * window[1] / 100)
    ranges = near.withColumns({"low": low.cast("double"), "high": high.cast("double")})
    by_goal = F.sort_array(F.collect_list(F.struct("goal", "low", "high")))
    ranges = ranges.groupBy("anchor").agg(by_goal.alias("goals")).withColumnRenamed("anchor", "row")

    def filled(name: str, missing: float) -> Column:
        given = F.col(f"goals.{name}")
        return F.concat(given, F.array_repeat(F.lit(missing), F.lit(positives) - F.size(given)))

    asked = anchors.join(ranges, "row").select("row", "label", "vector", *goals(filled("low", math.inf), filled("high", -math.inf)))
    asked = scratch.store(asked, "windows")
    far = _search(scratch, "negative", index, shared, chunks, asked, positives, negatives, False)
    far = far.select("anchor", "goal", "rank", F.col("key").alias("negative_id"), F.col("score").alias("negative_score"))
    named = anchors.select(F.col("row").alias("anchor"), F.col("key").alias("anchor_id"))
    result = far.join(near, ["anchor", "goal"]).join(named, "anchor")
    return result.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def scaled(vector: Column) -> Column:
    """Each component times 256, rounded down; null for vectors with a null or non-finite component."""
    whole = F.forall(vector, lambda x: F.coalesce(F.abs(x) < F.lit(math.inf), F.lit(False)))
    return F.when(whole, F.transform(vector, lambda x: F.floor(256 * x.cast("double"))))


@query(
    "op12_hard_negatives",
    """
    WITH rows AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
    scored AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
        CAST(list_sum(list_transform(range(1, 1 + len(a.v)), lambda i: a.v[i] * b.v[i])) AS BIGINT) AS score
        FROM rows a JOIN rows b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
    near AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
    hard AS (SELECT n.anchor_id, n.positive_id, s.other_id AS negative_id, n.positive_score, s.score AS negative_score,
        CAST(row_number() OVER (PARTITION BY n.anchor_id, n.positive_id ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank
        FROM near n JOIN scored s ON s.anchor_id = n.anchor_id AND NOT s.same
        AND 30 * n.positive_score <= 100 * s.score AND 100 * s.score <= 90 * n.positive_score)
    SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM hard WHERE rank <= 10
    """,
)
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.select("vec_id", label.alias("label"), scaled(F.col("embedding")).alias("vector"))
    return mine(rows, F.col("vec_id") % 100 == 0)
