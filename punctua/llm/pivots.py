"""Near-duplicate vectors by a pivot-permutation index.

Each vector is described by its ``NEAREST`` nearest of at most ``PIVOTS`` reference points, in
order. Inverted lists hold the vectors of each label and pivot. Within a list, two vectors that
share at least ``SHARED`` pivots are candidates and are verified by their cosine in double
precision. A pair met in several lists counts in that of its first shared pivot only; a list of
more than ``PARTED`` blocks is parted further by the second shared pivot.

Vectors are compared only under equal, non-null labels and equal lengths. A vector that is null,
empty, zero, or holds null or non-finite numbers links with nothing; numbers may have any size. Equal vectors are one class;
a list is cut into blocks, and a task returns sums and a spanning forest, never its pairs.

The reference points are drawn from the ``SAMPLE`` vectors of least hashed content, such that no
two are closer than ``APART``; every vector is indexed, whatever its length: one without a
reference point of its length goes to a list of its own kind, which is compared in full.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctua.llm.components import components
from punctua.llm.shared import keep

PIVOTS, NEAREST, SHARED = 256, 8, 2
SAMPLE, APART = 2048, 0.8
BLOCK = 1024
# Blocks from which a list is parted.
PARTED = 8
# Stands for no second pivot.
NO_SECOND = -2
COSINE = 0.98


def vectors(rows: DataFrame) -> DataFrame:
    """Stored rows with a number of their own and two hashes of label and vector, if valid."""
    # Whether all numbers are known and finite and not all of them 0, whatever their size.
    sizes = F.transform("embedding", lambda x: F.abs(x.cast("double")))
    largest = F.array_max(sizes)  # NaN is the largest of all
    valid = F.coalesce(
        (largest > 0) & (largest < float("inf")) & ~F.isnan(largest)
        & ~F.exists("embedding", lambda x: x.isNull()), F.lit(False))
    content = [F.col("label"), F.col("embedding")]
    return keep(
        rows.select(
            F.col("vec_id").cast("long").alias("vec_id"), F.col("label"),
            F.col("embedding").cast("array<double>").alias("embedding"),
            (valid & F.col("label").isNotNull()).alias("valid"),
        ).withColumns({
            "row": F.monotonically_increasing_id(),
            "key1": F.when(F.col("valid"), F.xxhash64(*content)),
            "key2": F.when(F.col("valid"), F.xxhash64(F.lit(17), *content)),
        }), "vectors",
    )


def unit(numbers: list) -> np.ndarray:
    """A vector of length 1; scaled by its largest number first, or squares leave the doubles."""
    vector = np.array(numbers, np.float64)
    largest = np.abs(vector).max()
    # Two steps, since the inverse of a very small number is infinite.
    power = np.ldexp(vector, -int(np.frexp(largest)[1]))
    return power / np.linalg.norm(power)


def choose_pivots(classes: DataFrame, count: int = PIVOTS) -> dict[int, np.ndarray]:
    """Unit reference points by vector length, from a bounded sample fixed by its content."""
    sample = classes.select("embedding").orderBy("key1", "key2").limit(SAMPLE).collect()
    kept: dict[int, list] = {}
    for (numbers,) in sample:
        vector = unit(numbers)
        near = kept.setdefault(len(vector), [])
        if len(near) < count and not (near and (np.array(near) @ vector).max() >= APART):
            near.append(vector)
    return {size: np.array(points) for size, points in kept.items()}


def describe(classes: DataFrame, pivots: dict[int, np.ndarray], nearest: int) -> DataFrame:
    """``(node, label, size, vector, near)``: ``near`` lists pivot numbers, nearest first."""
    shared = classes.sparkSession.sparkContext.broadcast(pivots)
    label = classes.schema["label"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("embedding")
            near, packed = [], []
            for numbers in lists.to_pylist():
                vector = unit(numbers)
                points = shared.value.get(len(vector))
                order = [-1] if points is None else np.argsort(
                    -(points @ vector), kind="stable")[:nearest].tolist()
                near.append(order)
                packed.append(vector.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("label"), batch.column("size"),
                 pa.array(packed, pa.binary()), pa.array(near, pa.list_(pa.int32()))],
                ["node", "label", "size", "vector", "near"],
            )

    return classes.select("node", "label", "size", "embedding").mapInArrow(
        run, f"node long, label {label}, size long, vector binary, near array<int>"
    )


def _compare(pivot: int, second: int | None, near: list, vectors: list, sizes: np.ndarray,
             blocks: np.ndarray, across: bool, cosine: float, shared: int
             ) -> tuple[np.ndarray, list]:
    """Per vector the linked others of this task, weighted by class size; a spanning forest.

    A pair belongs to the list of its first shared pivot, or of its first two where that list is
    parted by a ``second``. ``across`` leaves out the pairs within a block, which have a task of
    their own.
    """
    count = len(vectors)
    names, place = np.unique(np.concatenate(near), return_inverse=True)
    marks = np.zeros((count, len(names)), np.float32)
    marks[np.repeat(np.arange(count), list(map(len, near))), place] = 1
    points = np.stack([np.frombuffer(v, np.float64) for v in vectors])
    least = min(shared, *map(len, near))
    earlier = names < pivot
    if second is not None:
        earlier |= (names > pivot) & (names < second)
    alike = (marks @ marks.T >= least) & (marks[:, earlier] @ marks[:, earlier].T == 0)
    if across:
        alike &= blocks[:, None] != blocks[None, :]
    np.fill_diagonal(alike, False)
    linked = alike & (points @ points.T >= cosine)
    sums = linked @ sizes
    forest, label = [], np.arange(count)
    for one in np.flatnonzero(linked.any(axis=1)):
        others = np.flatnonzero(linked[one])
        met, where = np.unique(label[others], return_index=True)
        new = met != label[one]
        forest += [(int(one), int(others[w])) for w in where[new]]
        label[np.isin(label, met)] = label[one]
    return sums, forest


def near_vectors(rows: DataFrame, cosine: float = COSINE, pivots: int = PIVOTS,
                 nearest: int = NEAREST, shared: int = SHARED) -> DataFrame:
    """One row per vector: row, vec_id, n_links, component_id, kept_row.

    ``rows`` needs vec_id, label and embedding. ``n_links`` counts the rows linked directly,
    equal ones included; ``component_id`` is the smallest vec_id reached; ``kept_row`` marks one
    row of each component.
    """
    stored = vectors(rows)
    first = F.struct(F.col("vec_id").isNull(), "vec_id", "row")
    found = stored.where("valid").groupBy("key1", "key2").agg(
        F.min("row").alias("node"), F.count("*").alias("size"), F.min(first).alias("first")
    )
    content = stored.select(F.col("row").alias("node"), "label", "embedding")
    classes = keep(found.join(content, "node"), "classes")
    described = keep(describe(classes, choose_pivots(classes, pivots), nearest), "described")

    lists = described.withColumns({
        "pivot": F.explode("near"), "width": F.octet_length("vector"),
    })
    # A long list is parted by the second shared pivot: every pair that counts has one, a later
    # number than the first, so nothing is lost and fewer vectors meet. A vector then goes to a list
    # for each later pivot it has, up to seven, instead of a task for each block.
    key = ["label", "width", "pivot"]
    long = lists.groupBy(*key).agg(
        (F.count("*") > PARTED * BLOCK).alias("long"))
    later = F.when(
        F.col("long") & (F.size("near") > 1) & F.lit(shared > 1),
        F.filter("near", lambda other: other > F.col("pivot")),
    ).otherwise(F.array(F.lit(None).cast("int")))
    lists = lists.join(long, key).withColumn("second", F.explode(later)).drop("long")
    key = [*key, "second"]
    lists = lists.withColumn("second", F.coalesce("second", F.lit(NO_SECOND)))
    lengths = lists.groupBy(*key).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    parts = lists.join(lengths, key).withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    ).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumns(
        {"low": F.least("block", "other"), "high": F.greatest("block", "other")}
    ).select(*key, "low", "high", "block", "node", "size", "vector", "near")

    def task(table: pa.Table) -> pa.Table:
        node = table.column("node").to_numpy()
        second = table.column("second")[0].as_py()
        sums, forest = _compare(
            table.column("pivot")[0].as_py(), None if second == NO_SECOND else second,
            table.column("near").to_pylist(),
            table.column("vector").to_pylist(), table.column("size").to_numpy(),
            table.column("block").to_numpy(),
            table.column("low")[0].as_py() != table.column("high")[0].as_py(), cosine, shared,
        )
        some = np.flatnonzero(sums)
        ends = np.array(forest, np.int64).reshape(-1, 2)
        return pa.table({
            "a": np.concatenate((node[some], node[ends[:, 0]])),
            "b": pa.array(np.concatenate((np.zeros(len(some), np.int64), node[ends[:, 1]])),
                          mask=np.arange(len(some) + len(ends)) < len(some)),
            "n": np.concatenate((sums[some], np.zeros(len(ends), np.int64))),
        })

    results = keep(
        parts.groupBy(*key, "low", "high").applyInArrow(task, "a long, b long, n long"), "linked"
    )
    links = components(results.where("b is not null"))
    counts = results.where("b is null").groupBy(F.col("a").alias("node")).agg(
        F.sum("n").alias("n"))
    joined = (
        classes.select("key1", "key2", "node", "size", "first")
        .join(counts, "node", "left").join(links, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    heads = joined.groupBy("component").agg(F.min("first").alias("head"))
    named = joined.join(heads, "component").select(
        "key1", "key2", F.col("head.vec_id").alias("_least"), F.col("head.row").alias("_row"),
        (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("_n"),
    )
    return stored.join(named, ["key1", "key2"], "left").select(
        "row", "vec_id", F.coalesce("_n", F.lit(0)).alias("n_links"),
        F.when(F.col("valid"), F.col("_least")).otherwise(F.col("vec_id")).alias("component_id"),
        F.when(F.col("valid"), F.col("_row") == F.col("row")).otherwise(True).alias("kept_row"),
    )


def op7_near_vectors(spark, sf_dir: str) -> DataFrame:
    """All vectors, cosine 0.98 or more within a label."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return near_vectors(rows).select(
        "vec_id", "n_links", "component_id",
        F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )
