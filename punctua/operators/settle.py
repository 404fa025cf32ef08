"""Materialise intermediate results where every executor can reach them, and check sizes."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows up to which a table of a few short columns is handled by one task.
SMALL_ROWS = 1_000_000
# Rows and bytes up to which a lookup table is broadcast to every executor.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
# Rows that come to the driver at once.
GATHERED_ROWS = 10_000

# Paths given out in the innermost block of :func:`intermediates`.
_given: ContextVar[list[str] | None] = ContextVar("given", default=None)


def shared_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``, which all executors must reach."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    """Unused path in the shared folder."""
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if (given := _given.get()) is not None:
        given.append(path)
    return path


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """Delete, at the end of the block, the tables stored in the shared folder within it.

    For work whose results are written elsewhere before the block ends. Paths asked for
    before the block stay, as do those of other threads but for :func:`side_by_side`.
    """
    token = _given.set([])
    try:
        yield
    finally:
        paths = _given.get()
        _given.reset(token)
        for path in paths:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def side_by_side(spark: SparkSession, works: Sequence[Callable[[], None]]) -> None:
    """Run independent pieces of work at once, each in a thread of its own.

    All of them end before this returns; the first failure, in their order, is raised. Tables stored
    by them belong to the block of :func:`intermediates` around this call.
    """
    with ThreadPoolExecutor(max(1, len(works))) as pool:
        running = [
            pool.submit(copy_context().run, inheritable_thread_target(spark)(work)) for work in works]
    for one in running:
        one.result()


def settle(frame: DataFrame) -> DataFrame:
    """Compute a small result once and keep it in the shared folder.

    It survives lost executors, and later plans start from it.
    """
    shared_folder(frame.sparkSession)
    return frame.checkpoint(eager=True)


def store(frame: DataFrame) -> DataFrame:
    """Like :func:`settle` for results that grow with the data: a Parquet table.

    Later plans read only the columns they need and see its true size.
    """
    spark = frame.sparkSession
    path = fresh_path(spark, "stored")
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def gather(frame: DataFrame, rows: int = GATHERED_ROWS) -> DataFrame:
    """Compute a result once: up to ``rows`` rows become a local frame, a larger one is stored.

    For results that are small unless there are very many groups; both ways give the same rows.
    """
    found = frame.limit(rows + 1).collect()
    if len(found) > rows:
        return store(frame)
    return frame.sparkSession.createDataFrame(found, frame.schema)


def is_small(kept: DataFrame, rows: int = SMALL_ROWS) -> bool:
    """Whether a settled or stored frame has at most ``rows`` rows."""
    return kept.count() <= rows


def fits_broadcast(
    kept: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES
) -> bool:
    """Whether a settled or stored frame has at most ``rows`` rows and about ``size`` bytes."""
    text = F.to_json(F.struct(*[F.col(f"`{name}`") for name in kept.columns]))
    found = kept.limit(rows + 1).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length(text)).alias("bytes")).first()
    return found.rows <= rows and (found.bytes or 0) <= size
