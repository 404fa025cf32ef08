"""Chat logs: snapshots that a longer log contains are collapsed, the rest is rendered.

A conversation that was logged again and again as it grew leaves snapshots, each a prefix of the
next. The turns of each conversation get rolling prefix hashes: the sum, over the turns so far, of
hashes of position, role and text, in two independent 64-bit parts. A conversation whose last
hash is an inner prefix hash of another is dropped by an anti-join; of equal conversations the one
with the least id stays. What remains is rendered. DataFrame functions only.

Turns are ordered by turn number (null first), then role and text; positions count them, so gaps do
not matter. Rows that repeat a turn exactly count once. Rows without conv_id are one conversation, of
id null; a null role or text is a value of its own and renders as nothing. All rows are sorted once
in ordered ranges, whatever conversation they belong to, and numbered by the ranges' totals. A
conversation is then cut into blocks of ``BLOCK`` rows, which are summed on their own and raised by
the totals of the blocks before; a rendering has a row for each block. Ordinary ones are one block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctua.llm.shared import keep

BLOCK = 1024
_ID = ["none", "conv"]


def _turns(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("conv_id").isNull().alias("none"),
        F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("conv"),
        F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("text"),
    )


def _before(table: DataFrame, part: str, sums: list[str]) -> DataFrame:
    """Totals of the earlier parts of a conversation, one small row for each part."""
    over = Window.partitionBy(*_ID).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return table.select(*_ID, part, *[
        F.coalesce(F.sum(name).over(over), F.lit(0)).alias(f"{name}_before") for name in sums])


def places(rows: DataFrame) -> DataFrame:
    """Stored ``(none, conv, place, block, role, text)``: the distinct turns, numbered from 1.

    A range's rows are numbered by the sort's task as they are written: no conversation is
    gathered, and a conversation has one small row for each range it reaches into.
    """
    order = [*_ID, "turn", "role", "text"]
    ranged = _turns(rows).distinct().repartitionByRange(*order).sortWithinPartitions(*order)
    row = F.monotonically_increasing_id()
    stored = keep(
        ranged.withColumn("row", row).withColumn("range", F.shiftright("row", 33)), "turns")
    runs = stored.groupBy(*_ID, "range").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    heads = keep(
        runs.join(_before(runs, "range", ["n"]), [*_ID, "range"])
        .select(*_ID, "range", (F.col("n_before") + 1 - F.col("first")).alias("raise")), "heads")
    return keep(
        stored.join(heads, [*_ID, "range"]).withColumn("place", F.col("row") + F.col("raise"))
        .select(*_ID, "place", F.floor((F.col("place") - 1) / BLOCK).alias("block"),
                "role", "text"), "places",
    )


def prefixes(placed: DataFrame) -> DataFrame:
    """Stored ``(none, conv, place, p1, p2)``: prefix hashes of every conversation at each turn."""
    content = [F.coalesce("role", F.lit("")), F.col("role").isNull(),
               F.coalesce("text", F.lit("")), F.col("text").isNull()]
    hashed = keep(placed.select(
        *_ID, "block", "place", F.xxhash64("place", *content).cast("decimal(38,0)").alias("h1"),
        F.xxhash64(F.lit("second"), "place", *content).cast("decimal(38,0)").alias("h2"),
    ), "hashed")
    totals = hashed.groupBy(*_ID, "block").agg(F.sum("h1").alias("h1"), F.sum("h2").alias("h2"))
    upto = Window.partitionBy(*_ID, "block").orderBy("place").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return keep(
        hashed.withColumns({"s1": F.sum("h1").over(upto), "s2": F.sum("h2").over(upto)})
        .join(_before(totals, "block", ["h1", "h2"]), [*_ID, "block"])
        .select(*_ID, "place", (F.col("s1") + F.col("h1_before")).alias("p1"),
                (F.col("s2") + F.col("h2_before")).alias("p2")), "prefixes",
    )


def maximal(placed: DataFrame) -> DataFrame:
    """``(none, conv, n_turns)`` of the conversations that no other one contains as a prefix."""
    hashes = prefixes(placed)
    ends = hashes.groupBy(*_ID).agg(F.max(F.struct("place", "p1", "p2")).alias("last"))
    inner = (
        hashes.join(ends, _ID).where(F.col("place") < F.col("last.place"))
        .select("place", "p1", "p2").distinct()
    )
    distinct = ends.groupBy("last.place", "last.p1", "last.p2").agg(
        F.min(F.struct(*_ID)).alias("first"))
    return distinct.join(inner, ["place", "p1", "p2"], "left_anti").select(
        "first.none", "first.conv", F.col("place").alias("n_turns"))


def _line(turn: Column) -> Column:
    return F.concat(F.lit("<|"), F.coalesce(turn["role"], F.lit("")), F.lit("|>\n"),
                    F.coalesce(turn["text"], F.lit("")), F.lit("<|end|>\n"))


def render(rows: DataFrame) -> DataFrame:
    """``(conv_id, part, n_turns, text)`` of the maximal conversations, a row for each block."""
    placed = places(rows)
    chosen = keep(maximal(placed), "maximal")
    parts = placed.join(chosen, _ID).groupBy(*_ID, "block", "n_turns").agg(
        F.array_sort(F.collect_list(F.struct("place", "role", "text"))).alias("turns"))
    return parts.select(
        F.when(~F.col("none"), F.col("conv")).alias("conv_id"),
        F.col("block").cast("long").alias("part"), "n_turns",
        F.array_join(F.transform("turns", _line), "").alias("text"),
    )


def op8_chat_formatting(spark, sf_dir: str) -> DataFrame:
    """All conversations."""
    return render(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


SQL = """
WITH turns AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
logs AS (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn, role, text) AS said,
         string_agg('<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10), ''
                    ORDER BY turn, role, text) AS body
  FROM turns GROUP BY conv_id
), inner_parts AS (
  SELECT DISTINCT list_slice(said, 1, i) AS said
  FROM (SELECT said, unnest(range(1, len(said))) AS i FROM logs)
), firsts AS (SELECT min(conv_id) AS conv_id FROM logs GROUP BY said)
SELECT conv_id, CAST(0 AS BIGINT) AS part, CAST(len(said) AS BIGINT) AS n_turns, body AS text
FROM logs JOIN firsts USING (conv_id)
WHERE NOT EXISTS (SELECT 1 FROM inner_parts WHERE inner_parts.said = logs.said)
"""
