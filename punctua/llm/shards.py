"""Sharding by a hierarchical weighted hash tree.

A document descends from the root over regions and racks to a shard. At each level every child
draws ``-ln(u) / weight`` with ``u`` hashed from the document's id, the child's path and nothing
else; the least draw wins. A child's share is its weight's share of its parent, and raising one
weight moves documents only into that child's subtree. New shards come as regions of their own,
so growing by one shard moves documents into that shard alone. The law is ``key``: the id and the
tree decide, whatever other rows there are.

A null id is an id like any other; rows of one id share a shard. A null text has no bytes. Slots
number the rows of a shard without gaps.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctua.llm.shared import keep, unused

SHARDS = 24
# Consecutive rows of one input partition that are numbered together.
BLOCK = 65_536


@dataclass(frozen=True)
class Tree:
    """Weights of shards by region and rack; shards are numbered in this order."""

    regions: tuple[tuple[tuple[float, ...], ...], ...]

    def grown(self, weight: float = 1.0) -> Tree:
        """One more shard, as a new region."""
        return Tree((*self.regions, ((weight,),)))

    def reweighted(self, region: int, rack: int, shard: int, weight: float) -> Tree:
        regions = [[list(r) for r in reg] for reg in self.regions]
        regions[region][rack][shard] = weight
        return Tree(tuple(tuple(tuple(r) for r in reg) for reg in regions))


def even_tree(shards: int = SHARDS, per_rack: int = 4, racks: int = 2) -> Tree:
    """Shards of weight 1 in racks and regions of the given sizes; the last may be smaller."""
    all_racks = [(1.0,) * min(per_rack, shards - at) for at in range(0, shards, per_rack)]
    return Tree(tuple(
        tuple(all_racks[at : at + racks]) for at in range(0, len(all_racks), racks)
    ))


def _draw(key: Column, level: str, path: Column, child: int, weight: Column) -> Column:
    hashed = F.xxhash64(F.lit(level), path, F.lit(child), F.coalesce(key, F.lit(0)), key.isNull())
    uniform = (F.shiftrightunsigned(hashed, 11).cast("double") + 0.5) / F.lit(2.0**53)
    return F.when(weight > 0, F.struct((-F.log(uniform) / weight).alias("draw"),
                                       F.lit(child).alias("child")))


def _choose(key: Column, level: str, path: Column, weights: list[list[float]]) -> Column:
    """Winning child, with the children's weights looked up by the number of the parent."""
    width = max(map(len, weights))
    padded = [[float(w) for w in row] + [0.0] * (width - len(row)) for row in weights]
    draws = []
    for child in range(width):
        column = F.array(*[F.lit(row[child]) for row in padded])
        draws.append(_draw(key, level, path, child, F.element_at(column, path + 1)))
    return F.array_min(F.array_compact(F.array(*draws)))["child"]


def place(frame: DataFrame, tree: Tree, key: str, name: str) -> DataFrame:
    """Adds the shard of each row as column ``name``. No shuffle."""
    racks = [rack for region in tree.regions for rack in region]
    rack_heads = [sum(len(r) for r in tree.regions[:i]) for i in range(len(tree.regions))]
    shard_heads = [sum(map(len, racks[:i])) for i in range(len(racks))]

    def head(heads: list[int], at: str) -> Column:
        return F.element_at(F.array(*map(F.lit, heads)), F.col(at) + 1)

    id_ = F.col(key).cast("long")
    at_region, at_rack = unused(frame, "_region"), unused(frame, "_rack")
    chosen = frame.withColumn(at_region, _choose(
        id_, "region", F.lit(0), [[sum(map(sum, region)) for region in tree.regions]]
    )).withColumn(at_rack, head(rack_heads, at_region) + _choose(
        id_, "rack", F.col(at_region), [[sum(rack) for rack in reg] for reg in tree.regions]
    )).withColumn(name, head(shard_heads, at_rack) + _choose(
        id_, "shard", F.col(at_rack), [list(rack) for rack in racks]
    ))
    return chosen.drop(at_region, at_rack)


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``size`` (UTF-8 bytes and 8 more), ``text_crc32`` of the text."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
    )


def assign(rows: DataFrame, tree: Tree, key: str = "doc_id") -> DataFrame:
    """Adds ``shard``, ``slot`` (gapless per shard) and ``grown_shard`` to narrow ``rows``.

    Rows are written once with their shard and a block of at most ``BLOCK`` rows; each block
    numbers its own rows of a shard, raised by the totals of the blocks before.
    """
    rows = rows.drop("shard", "slot", "grown_shard")
    placed = place(place(rows, tree, key, "shard"), tree.grown(), key, "grown_shard")
    number = F.monotonically_increasing_id()
    stored = keep(
        placed.withColumn("_row", number).withColumn("_block", F.floor(F.col("_row") / BLOCK)),
        "shards",
    )
    before = Window.partitionBy("shard").orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1)
    heads = stored.groupBy("shard", "_block").agg(F.count("*").alias("_n")).select(
        "shard", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_head"))
    inside = Window.partitionBy("shard", "_block").orderBy("_row")
    numbered = stored.withColumn("_rank", F.row_number().over(inside) - 1)
    return numbered.join(heads, ["shard", "_block"]).withColumn(
        "slot", (F.col("_head") + F.col("_rank")).cast("long")
    ).drop("_row", "_block", "_rank", "_head")


def write_shards(docs: DataFrame, tree: Tree, path: str, key: str = "doc_id") -> None:
    """Writes ``docs`` in folders ``shard=N`` under ``path``; each task writes its own rows."""
    place(docs.drop("shard"), tree, key, "shard").write.partitionBy("shard").parquet(path)


def op3_sharding(spark, sf_dir: str) -> DataFrame:
    """All documents on 24 shards, and with one more."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return assign(measured(docs), even_tree(SHARDS)).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"),
        F.col("shard").cast("int").alias("shard"), "slot",
        F.col("grown_shard").cast("int").alias("grown_shard"),
    )
