"""Tables kept by a hash of their key on disk: later joins and windows on it need no shuffle.

A bucketed table is a Parquet folder with the bucket in each file's name, so that any reader can use
it as a plain table. Its number of buckets is declared when it is read by key. A key that holds a
large part of the rows is spread over the tasks that write; where such tables are joined its rows go
a way of their own, so that no task reads all of them.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctua.operators.joins import HEAVY_ROWS, HEAVY_SHARE, key_counts
from punctua.operators.settle import fresh_path


def bucket_count(spark: SparkSession) -> int:
    """Buckets of new tables: one for each task of a shuffle."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bucket_of(key: str, buckets: int) -> Column:
    """The bucket in which Spark's writer puts a row."""
    return F.pmod(F.hash(key), F.lit(buckets))


def frequent_keys(
    frame: DataFrame, key: str, share: float = HEAVY_SHARE, at_least: int = HEAVY_ROWS
) -> list:
    """Keys that hold so many rows that they should go a way of their own; there are few."""
    return [value for value, _ in key_counts(frame, key, share, at_least)]


def spread_by_key(
    frame: DataFrame, key: str, buckets: int, heavy: Sequence = ()
) -> DataFrame:
    """Hash repartition by key: a key's rows are in the partition of its bucket.

    Rows without a key and those of ``heavy`` keys are spread over all partitions instead.
    """
    own = bucket_of(key, buckets)
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in frame.columns]) + F.spark_partition_id(),
                  F.lit(buckets)).cast("int")
    loose = F.col(key).isNull()
    if heavy:
        loose = loose | F.col(key).isin(list(heavy))
    return frame.repartitionById(buckets, F.when(loose, salt).otherwise(own).cast("int"))


def write_buckets(
    frame: DataFrame,
    path: str,
    key: str,
    buckets: int,
    sort_by: Sequence[str] = (),
    mode: str = "overwrite",
) -> None:
    """Write rows in files by bucket of ``key``, each sorted.

    Each task writes one file for every bucket that it holds rows of, so rows come by key already:
    from :func:`spread_by_key`, or from a table of as many buckets.
    """
    spark, name = frame.sparkSession, _name()
    (
        frame.write.mode(mode).bucketBy(buckets, key).sortBy(*(sort_by or [key]))
        .option("path", path).format("parquet").saveAsTable(name)
    )
    spark.sql(f"DROP TABLE {name}")  # the name only; the files are no managed table


def read_buckets(
    spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int
) -> DataFrame:
    """A table of :func:`write_buckets`, known to the planner as clustered by key."""
    name = _name()
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet "
              f"CLUSTERED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'")
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return table


def store_buckets(
    frame: DataFrame, key: str, buckets: int | None = None, heavy: Sequence = ()
) -> DataFrame:
    """Store rows by key in the shared folder, by one shuffle, and read them back by key."""
    spark = frame.sparkSession
    count = buckets or bucket_count(spark)
    path = fresh_path(spark, "buckets")
    write_buckets(spread_by_key(frame, key, count, heavy), path, key, count)
    return read_buckets(spark, path, frame.schema, key, count)


def _name() -> str:
    return f"by_key_{uuid.uuid4().hex}"


def join_buckets(
    facts: DataFrame, lookup: DataFrame, key: str, how: str = "inner", heavy: Sequence = ()
) -> DataFrame:
    """Inner or left join with a table in buckets; ``facts`` in as many are not shuffled, others once.

    ``lookup`` holds each key once. Rows of ``heavy`` keys and, in a left join, those without a key
    meet the few lookup rows of these keys by broadcast: at most one for each heavy key. They
    are read as any other rows, so the planner may split their files.
    """
    loose = F.col(key).isin(list(heavy)) if heavy else F.lit(False)
    light = facts.where(F.col(key).isNotNull() & ~loose).hint("merge").join(
        lookup.hint("merge"), key, how)
    parts = [light]
    rest = [loose] if heavy else []
    if how == "left":
        rest.append(F.col(key).isNull())
    if rest:
        few = lookup.where(loose)
        parts.append(facts.where(reduce(or_, rest)).join(F.broadcast(few), key, how))
    return reduce(DataFrame.unionByName, parts)


# Found once for each count: they depend on nothing else.
_range_keys: dict[int, list[int]] = {}


def range_keys(spark: SparkSession, count: int) -> list[int]:
    """For each of ``count`` buckets an integer that falls in it, so that ranges can be kept apart."""
    found: dict[int, int] = {}
    size = 16 * count
    while count not in _range_keys:
        numbers = spark.range(size).select(F.col("id").cast("int").alias("k"))
        for row in numbers.select("k", bucket_of("k", count).alias("bucket")).collect():
            found.setdefault(row.bucket, row.k)
        if len(found) == count:
            _range_keys[count] = [found[bucket] for bucket in range(count)]
        size *= 4
    return _range_keys[count]
