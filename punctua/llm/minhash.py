"""Near-duplicate documents by MinHash with sequential Bayesian verification.

1. Every document becomes the set of its distinct word shingles. Documents with equal sets are
   one class; only classes are compared, so exact copies cost nothing more.
2. Bands of the MinHash signature give buckets of candidates. A bucket is never turned into
   pairs. Each class points to the most connected class among those it shares a bucket with;
   followed to their ends, the pointers form groups around the most connected classes. Buckets
   whose classes belong to several groups are taken as further groups.
3. Within a group, cut into blocks of bounded size, signatures are compared in batches: after
   each batch a pair is dropped when, under a uniform prior, the posterior probability of a
   similarity at or over the threshold is below ``miss``. Survivors are verified on full sets.
   Pairs that already hang together need no test; a task returns a spanning forest only.
4. Connected components of these links give the result.

With 32 bands of 4 the chance that a pair of similarity 0.8 shares no bucket is 5e-8. Sets
hold 64-bit hashes of shingles. A null text, or one without words, has an empty set and links
with nothing; fewer words than a shingle count as one shingle. Repeated rows and ids are rows of
their own with equal sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctua.llm import words as W
from punctua.llm.components import components
from punctua.llm.shared import keep

BANDS, ROWS = 32, 4
BATCH = 16
MISS = 1e-8
# A block of a group holds about this many classes and shingles.
BLOCK_CLASSES, BLOCK_SHINGLES = 1024, 500_000

_SEEDS = np.random.Generator(np.random.PCG64(7)).integers(
    0, 2**64, BANDS * ROWS, np.uint64
) | np.uint64(1)


def signatures(flat: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """MinHash signatures (rows of 32-bit values) of non-empty sets laid end to end."""
    out = np.empty((len(bounds) - 1, len(_SEEDS)), np.uint32)
    for begin in range(0, len(bounds) - 1, 256):
        end = min(begin + 256, len(bounds) - 1)
        part = flat[bounds[begin] : bounds[end]]
        heads = bounds[begin:end] - bounds[begin]
        for number, seed in enumerate(_SEEDS):
            value = part * seed
            value ^= value >> np.uint64(32)
            value *= np.uint64(0xFF51AFD7ED558CCD)
            value >>= np.uint64(32)
            out[begin:end, number] = np.minimum.reduceat(value, heads)
    return out


def least_agreements(threshold: float, miss: float) -> list[int]:
    """Agreements needed after each batch for a pair to stay.

    With a uniform prior the posterior after s agreements of m is Beta(s + 1, m - s + 1), and
    its mass at or over t is the chance of at most s successes in m + 1 draws of chance t.
    """
    needed = []
    for m in range(BATCH, len(_SEEDS) + 1, BATCH):
        mass, s = 0.0, -1
        while mass < miss:
            s += 1
            mass += comb(m + 1, s) * threshold**s * (1 - threshold) ** (m + 1 - s)
        needed.append(s)
    return needed


def sketches(docs: DataFrame, shingle: int, row_id: str | None = None) -> DataFrame:
    """Per document: row, doc_id, n, key1, key2 (of its set) and band keys.

    ``row`` is the unique column ``row_id``, or a number of its own once this is stored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for part in W.slices(batch, "text"):
                flat, bounds = W.shingle_hashes(
                    W.split_words(part.column("text"), W.NOT_SPACE), shingle
                )
                sizes = np.diff(bounds)
                first, second = set_keys(flat, bounds)
                full = np.flatnonzero(sizes)
                signs = signatures(flat, np.append(bounds[full], len(flat)))
                bands = np.zeros((len(full), BANDS), np.uint64)
                for at in range(ROWS):
                    bands = W.mix(bands * np.uint64(31) + signs[:, at::ROWS])
                bands = W.mix(bands + np.arange(BANDS, dtype=np.uint64))
                stops = np.zeros(len(sizes) + 1, np.int32)
                stops[1:] = np.cumsum(sizes > 0) * BANDS
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("row") if row_id else pa.array(
                            np.arange(row, row + len(sizes))),
                        part.column("doc_id"),
                        pa.array(sizes.astype(np.int64)),
                        pa.array(first.view(np.int64)), pa.array(second.view(np.int64)),
                        pa.ListArray.from_arrays(
                            pa.array(stops), pa.array(bands.reshape(-1).view(np.int64))
                        ),
                    ],
                    ["row", "doc_id", "n", "key1", "key2", "bands"],
                )
                row += len(sizes)

    own = [F.col(row_id).alias("row")] if row_id else []
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *own)
    return narrow.mapInArrow(
        run, "row long, doc_id long, n long, key1 long, key2 long, bands array<long>"
    )


def set_keys(flat: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit digests of each set."""
    keys = []
    for salt in (0x51, 0xA3):
        sums = np.zeros(len(flat) + 1, np.uint64)
        np.cumsum(W.mix(flat + np.uint64(salt)), out=sums[1:])
        keys.append(W.mix(sums[bounds[1:]] - sums[bounds[:-1]] + np.diff(bounds).astype(np.uint64)))
    return keys[0], keys[1]


def shingle_sets(docs: DataFrame, shingle: int) -> DataFrame:
    """``(key1, key2, shingles)`` per document with words; shingles as sorted 64-bit binary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "text"):
                flat, bounds = W.shingle_hashes(
                    W.split_words(part.column("text"), W.NOT_SPACE), shingle
                )
                first, second = set_keys(flat, bounds)
                sets = pa.BinaryArray.from_buffers(
                    pa.binary(), len(bounds) - 1,
                    [None, pa.py_buffer((bounds * 8).astype(np.int32)), pa.py_buffer(flat)],
                )
                made = pa.RecordBatch.from_arrays(
                    [pa.array(first.view(np.int64)), pa.array(second.view(np.int64)), sets],
                    ["key1", "key2", "shingles"],
                )
                yield made.filter(pa.array(np.diff(bounds) > 0))

    return docs.select("text").mapInArrow(run, "key1 long, key2 long, shingles binary")


def _groups(buckets: DataFrame) -> DataFrame:
    """``(task, node, root)`` from buckets ``(bucket, node)`` of at least two classes.

    Every two classes of one bucket meet in a task.
    """
    sized = buckets.join(buckets.groupBy("bucket").agg(F.count("*").alias("size")), "bucket")
    score = sized.groupBy("node").agg(F.sum("size").alias("score"))
    scored = keep(buckets.join(score, "node"), "buckets")
    leader = scored.groupBy("bucket").agg(F.max(F.struct("score", "node")).alias("leader"))
    roots = keep(
        scored.join(leader, "bucket").groupBy("node").agg(F.max("leader").alias("l"))
        .select("node", F.col("l.node").alias("root")), "roots",
    )
    while True:
        jump = roots.select(F.col("node").alias("root"), F.col("root").alias("far"))
        moved = keep(
            roots.join(jump, "root").select(
                "node", F.col("far").alias("root"), (F.col("far") != F.col("root")).alias("moved")
            ), "roots",
        )
        roots = moved.drop("moved")
        if moved.where("moved").isEmpty():
            break
    placed = keep(scored.select("bucket", "node").join(roots, "node"), "placed")
    own = F.xxhash64("node").cast("decimal(38,0)")
    mixed = (
        placed.groupBy("bucket").agg(
            F.min("root").alias("low"), F.max("root").alias("high"),
            F.count("*").alias("size"), F.sum(own).alias("print"),
        )
        .where("low < high").groupBy("size", "print").agg(F.min("bucket").alias("bucket"))
    )
    return (
        placed.join(mixed.select("bucket"), "bucket")
        .select(F.lit(1).alias("kind"), F.col("bucket").alias("task"), "node", "root")
        .unionByName(roots.select(F.lit(0).alias("kind"), F.col("root").alias("task"),
                                  "node", "root"))
    )


def _blocks(members: DataFrame) -> DataFrame:
    """Copies each member to the tasks of its block with every other block of its group."""
    sizes = members.groupBy("kind", "task").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK_CLASSES),
                   F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks")
    )
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    return (
        members.join(sizes, ["kind", "task"]).withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
        .drop("other", "blocks", "n", "_id")
    )


def linked(sets: list[np.ndarray], roots: np.ndarray, sides: np.ndarray, same_root: bool,
           percent: int, needed: list[int], first: int) -> list[tuple[int, int]]:
    """Spanning links among sets; pairs of one side, or of one root, may be left out.

    ``first`` is compared before the others. Of two sides only pairs across them are needed.
    """
    size = len(sets)
    lengths = np.array(list(map(len, sets)), np.int64)
    flat = np.concatenate(sets)
    bounds = np.concatenate(([0], np.cumsum(lengths)))
    signs = signatures(flat, bounds)
    order = np.argsort(np.where(np.arange(size) == first, 0, 1), kind="stable")
    label, two_sides, links = np.arange(size), len(set(sides.tolist())) > 1, []
    for step, one in enumerate(order):
        rest = order[step + 1 :]
        wanted = label[rest] != label[one]
        if two_sides and step:
            wanted &= sides[rest] != sides[one]
        if not same_root:
            wanted &= roots[rest] != roots[one]
        short = np.minimum(lengths[rest], lengths[one])
        wanted &= 100 * short >= percent * np.maximum(lengths[rest], lengths[one])
        rest = rest[wanted]
        agreed = np.zeros(len(rest), np.int64)
        for batch, least in enumerate(needed):
            if not len(rest):
                break
            span = slice(batch * BATCH, (batch + 1) * BATCH)
            agreed += (signs[rest, span] == signs[one, span]).sum(axis=1)
            rest, agreed = rest[agreed >= least], agreed[agreed >= least]
        if not len(rest):
            continue
        inside = lengths[rest]
        stops = np.cumsum(inside)
        at = np.repeat(bounds[rest] - (stops - inside), inside) + np.arange(stops[-1])
        mine, others = sets[one], flat[at]
        place = np.minimum(np.searchsorted(mine, others), len(mine) - 1)
        common = np.add.reduceat((mine[place] == others).astype(np.int64), stops - inside)
        near = rest[100 * common >= percent * (lengths[rest] + lengths[one] - common)]
        met, where = np.unique(label[near], return_index=True)
        links += [(int(one), int(near[w])) for w in where]
        label[np.isin(label, met)] = label[one]
    return links


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80,
                    miss: float = MISS, row_id: str | None = None) -> DataFrame:
    """One row per document: row, doc_id, n_shingles, component_id, kept_row.

    ``component_id`` is the smallest doc_id of the documents it hangs together with, itself
    included; ``kept_row`` marks one row of each such component. ``docs`` needs doc_id and text;
    ``row_id`` may name a column of unique longs to tell its rows apart.
    """
    sketch = keep(sketches(docs, shingle, row_id), "sketches")
    full = sketch.where("n > 0")
    classes = keep(
        full.groupBy("key1", "key2").agg(
            F.min("row").alias("node"), F.min("doc_id").alias("doc_id"), F.max("n").alias("n"),
            F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first"),
        ), "classes",
    )
    rows = full.select("row", "bands").join(
        classes.select(F.col("node").alias("row")), "row"
    ).select(F.explode("bands").alias("bucket"), F.col("row").alias("node"))
    shared = rows.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    buckets = keep(rows.join(shared.select("bucket"), "bucket"), "shared")

    members = keep(
        _groups(buckets).join(
            classes.select("node", "n", "key1", "key2", F.col("doc_id").alias("_id")), "node"
        ), "members",
    )
    ids = keep(members.select("_id").distinct(), "wanted")
    texts = docs.select(F.col("doc_id").cast("long").alias("_own"), "text").join(
        ids, F.col("_own").eqNullSafe(F.col("_id")), "left_semi"
    )
    sets = shingle_sets(texts, shingle).dropDuplicates(["key1", "key2"])
    needed = least_agreements(percent / 100, miss)

    def compare(table: pa.Table) -> pa.Table:
        node = table.column("node").to_numpy()
        root = table.column("root").to_numpy()
        pairs = linked(
            [np.frombuffer(b, np.uint64) for b in table.column("shingles").to_pylist()],
            root, table.column("block").to_numpy(), table.column("kind")[0].as_py() == 0,
            percent, needed, int(np.argmax(node == root)),
        )
        ends = np.array(pairs, np.int64).reshape(-1, 2)
        return pa.table({"a": node[ends[:, 0]], "b": node[ends[:, 1]]})

    links = (
        _blocks(members).join(sets, ["key1", "key2"])
        .groupBy("kind", "task", "low", "high").applyInArrow(compare, "a long, b long")
    )
    found = components(keep(links, "found"))
    joined = classes.join(found, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    heads = joined.groupBy("component").agg(F.min("first").alias("head"))
    named = joined.select("key1", "key2", "component").join(heads, "component").select(
        "key1", "key2", F.col("head.doc_id").alias("_least"), F.col("head.row").alias("_row")
    )
    return sketch.drop("bands").join(named, ["key1", "key2"], "left").select(
        "row", "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("_least")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(F.col("n") > 0, F.col("_row") == F.col("row")).otherwise(True).alias("kept_row"),
    )


def op4_near_duplicates(spark, sf_dir: str) -> DataFrame:
    """All documents, four-word shingles, similarity 0.8 or more."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs, shingle=4).select(
        "doc_id", "n_shingles", "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )
