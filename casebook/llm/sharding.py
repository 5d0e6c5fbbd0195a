"""K-d tree sharding: nodes are split at weighted medians along their widest metadata dimension.

Equal texts form one unit with the bytes of all its rows as weight. A node that is to become k shards is
split so that its lower part gets ``k // 2`` of the k shares of its bytes. The dimension is the one in which the
node's values spread most, relative to the whole table. The median is found by histograms: one pass counts
the weights of all nodes' bins, the bin that holds the median is cut into bins again, until it is one unit
or weighs too little to matter. Only bin sums and node ranges reach the driver, at most
``BINS`` rows per open node.

* Dimensions: text length (log scale), the smallest key, and the named metadata columns (by a hash of their
  values). Units with the same value are told apart by a hash of the text, so a hot value can be split;
  equal texts never are.
* Law ``bytes``: shard sizes are near equal, up to one unit per split. A unit above a shard's share gets a
  shard to itself first. Null text has no bytes and goes with empty texts.
* Rows are numbered in each shard without gaps: cells of a bounded number of rows are numbered by
  themselves and get the rows before them as offset. Repeated rows are rows of their own with slots of
  their own. Extra columns do not matter. An empty table gives an empty result; more shards than units
  leave shards empty.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casebook.llm.common import Scratch, flat, place, query, table

SHARDS = 24
ROW_BYTES = 8  # counted for each row besides its text
BINS = 2048
TOLERANCE = 1e-4  # of a shard's bytes: a median is not sought closer
CELL_ROWS = 100_000
VALUE_BITS = 31  # of a dimension's value in a place; as many tell equal values apart


@dataclass
class Node:
    """A part of the units that becomes ``shards`` shards, the first of which is ``first``."""

    first: int
    shards: int
    low: int = 0
    high: int = 0
    dimension: int = 0
    below: int = 0  # weight under ``low``
    target: float = 0.0

    @property
    def width(self) -> int:
        """Of the bins that the range from ``low`` to ``high`` is cut into."""
        return max(1, -(-(self.high - self.low) // BINS))


def scaled(value: Column, low: float, high: float) -> Column:
    """A value of the table's range as an integer of VALUE_BITS bits."""
    share = (value.cast("double") - F.lit(float(low))) / F.lit(float(max(high - low, 1e-9)))
    return F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0)) * F.lit(float((1 << VALUE_BITS) - 1))


def units_of(scratch: Scratch, rows: DataFrame, metadata: list[str]) -> DataFrame:
    """Distinct texts with their weight and a place in every dimension, as 62-bit integers."""
    hashed = [F.min(F.pmod(F.xxhash64(F.col(m).cast("string")), F.lit(1 << VALUE_BITS))).cast("double").alias(m) for m in metadata]
    key = F.col("key").cast("double")
    if not isinstance(rows.schema["key"].dataType, T.NumericType):  # such keys have no distance but that of their hashes
        key = F.pmod(F.xxhash64(F.col("key").cast("string")), F.lit(1 << VALUE_BITS)).cast("double")
    units = rows.groupBy("unit").agg(
        F.sum("size").alias("weight"),
        F.log2(F.max("size")).alias("v0"),
        F.min(F.coalesce(key, F.lit(0.0))).alias("v1"),
        *hashed,
    )
    units = scratch.store(units, "unit-values")
    values = ["v0", "v1", *metadata]
    ends = units.agg(*[e(v).alias(f"{e.__name__}_{v}") for v in values for e in (F.min, F.max)]).first()
    tie = F.shiftrightunsigned(F.xxhash64("unit"), 64 - VALUE_BITS)
    places = [
        (scaled(F.col(v), ends[f"min_{v}"] or 0, ends[f"max_{v}"] or 0).cast("long") * (1 << VALUE_BITS) + tie).alias(f"p{i}")
        for i, v in enumerate(values)
    ]
    return scratch.store(units.select("unit", "weight", *places, F.lit(0).alias("node")), "units")


def choose(column: str, nodes: list[Node], value) -> Column:
    """``value(node)`` for the row's node."""
    found = F.lit(None)
    for number, node in enumerate(nodes):
        found = F.when(F.col(column) == number, value(node)).otherwise(found)
    return found


def medians(units: DataFrame, nodes: list[Node], dimensions: int) -> None:
    """Sets ``dimension`` and ``low`` of all nodes that are to be split: places below ``low`` go to the lower part."""
    stats = units.groupBy("node").agg(
        F.sum("weight").alias("weight"), *[e(f"p{d}").alias(f"{n}{d}") for d in range(dimensions) for n, e in (("l", F.min), ("h", F.max))]
    )
    found = {r["node"]: r for r in stats.collect()}  # one row per node, fewer than there are shards
    seeking = {}
    for number, node in enumerate(nodes):
        if node.shards < 2 or number not in found:
            continue
        row = found[number]
        node.dimension = max(range(dimensions), key=lambda d: (row[f"h{d}"] - row[f"l{d}"], -d))
        node.low, node.high = row[f"l{node.dimension}"], row[f"h{node.dimension}"] + 1
        node.below, node.target = 0, row["weight"] * (node.shards // 2) / node.shards
        seeking[number] = TOLERANCE * row["weight"] / node.shards
    while seeking:
        at = choose("node", nodes, lambda n: F.col(f"p{n.dimension}"))
        low, width = choose("node", nodes, lambda n: F.lit(n.low)), choose("node", nodes, lambda n: F.lit(n.width))
        inside = (at >= low) & (at < choose("node", nodes, lambda n: F.lit(n.high)))
        number_of_bin = F.floor((at - low).cast("decimal(20,0)") / width).cast("long")
        live = units.where(F.col("node").isin(list(seeking))).where(inside).select("node", number_of_bin.alias("bin"), "weight")
        bins: dict[int, list[tuple[int, int]]] = {}
        for r in live.groupBy("node", "bin").agg(F.sum("weight").alias("weight")).collect():  # BINS rows per node
            bins.setdefault(r["node"], []).append((r["bin"], r["weight"]))
        for number in list(seeking):
            node, below = nodes[number], nodes[number].below
            for place_, weight in sorted(bins[number]):
                if below + weight > node.target:
                    break
                below += weight
            begin = node.low + place_ * node.width
            final = node.width == 1 or weight <= seeking[number]
            node.low, node.high, node.below = begin, min(begin + node.width, node.high), below
            if final:
                if below + weight - node.target < node.target - below:  # nearer with that bin in the lower part
                    node.low = node.high
                del seeking[number]


def giants(units: DataFrame, shards: int) -> list[str]:
    """Units that weigh at least a shard's share of what is left beside heavier ones: fewer than there are shards."""
    left = units.agg(F.sum("weight")).first()[0] or 0
    found = []
    for r in units.select("unit", "weight").orderBy(F.desc("weight"), "unit").limit(shards - 1).collect():
        if r["weight"] * (shards - len(found)) < left:
            break
        found.append(r["unit"])
        left -= r["weight"]
    return found


def assigned(scratch: Scratch, units: DataFrame, shards: int, dimensions: int) -> DataFrame:
    """``unit, shard`` after all splits. Units too heavy for any split get the first shards to themselves."""
    alone = giants(units, shards)
    single = units.where(F.col("unit").isin(alone)).select("unit", (F.array_position(F.array(*map(F.lit, alone)), F.col("unit")) - 1).cast("int").alias("shard"))
    if alone:
        units = units.where(~F.col("unit").isin(alone))
    nodes = [Node(len(alone), shards - len(alone))]
    step = 0
    while any(n.shards > 1 for n in nodes):
        medians(units, nodes, dimensions)
        following: list[Node] = []
        number = F.lit(0)
        for i, node in enumerate(nodes):
            lower = node.shards // 2
            parts = [Node(node.first, node.shards)] if not lower else [Node(node.first, lower), Node(node.first + lower, node.shards - lower)]
            own = F.lit(len(following))
            if lower:
                own = F.when(F.col(f"p{node.dimension}") < node.low, own).otherwise(own + 1)
            number = F.when(F.col("node") == i, own).otherwise(number)
            following += parts
        step += 1
        units = scratch.store(units.withColumn("node", number), f"units-{step}")
        if step > 1:
            scratch.drop(f"units-{step - 1}")
        nodes = following
    split = units.select("unit", choose("node", nodes, lambda n: F.lit(n.first)).cast("int").alias("shard"))
    return split.union(single) if alone else split


def slots(scratch: Scratch, placed: DataFrame) -> DataFrame:
    """Adds ``slot``: the row's number in its shard, gapless from 0. ``placed`` has ``row_id`` and ``shard``."""
    cells = max(1, placed.count() // CELL_ROWS)
    placed = placed.withColumn("cell", F.pmod(F.xxhash64("row_id"), F.lit(cells)))
    sizes = placed.groupBy("shard", "cell").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("shard", "cell", F.coalesce(before, F.lit(0)).alias("offset"))
    rank = F.row_number().over(Window.partitionBy("shard", "cell").orderBy("row_id")) - 1
    return placed.withColumn("rank", rank).join(offsets, ["shard", "cell"]).withColumn("slot", F.col("rank") + F.col("offset")).drop("cell", "rank", "offset")


def shard(docs: DataFrame, shards: int = SHARDS, key: str = "doc_id", text: str = "text", metadata: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """Per row of ``docs``: key, ``size``, ``text_crc32``, ``law``, ``shard`` and ``slot``."""
    scratch = Scratch(docs.sparkSession, "sharding")
    source = flat(docs)
    value = F.col(place(docs, text)).cast("string")
    data = value.cast("binary")
    extra = [F.col(place(docs, m)).alias(f"m{i}") for i, m in enumerate(metadata)]
    rows = source.select(
        F.col(place(docs, key)).alias("key"),
        (F.coalesce(F.octet_length(value), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(F.coalesce(data, F.lit("").cast("binary"))).alias("text_crc32"),
        F.sha2(F.coalesce(data, F.lit("").cast("binary")), 256).alias("unit"),
        *extra,
    )
    rows = scratch.store(rows.withColumn("row_id", F.monotonically_increasing_id()), "rows")
    names = [f"m{i}" for i in range(len(metadata))]
    units = units_of(scratch, rows, names)
    found = scratch.store(assigned(scratch, units, shards, 2 + len(names)), "assigned")
    placed = rows.select("row_id", "key", "size", "text_crc32", "unit").join(found, "unit").drop("unit")
    numbered = slots(scratch, scratch.store(placed, "placed"))
    return numbered.select(F.col("key").alias(key), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"))


@query("op10_sharding")
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents")).withColumn("grown_shard", F.lit(None).cast("int"))
