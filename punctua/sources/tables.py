"""CSV and Parquet tables, SQL over views, and saved models."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctua.functions.columns import is_complete
from punctua.operators.settle import store

Parameters = Mapping[str, object]


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header line under a declared schema; unreadable fields become null."""
    return spark.read.schema(schema).csv(path, header=True, enforceSchema=False)


BROKEN = "_broken_line"


@dataclass(frozen=True)
class Checked:
    """Rows of a text table that fit its schema, and ``(line, reason)`` of those that do not."""

    rows: DataFrame
    rejects: DataFrame


def read_csv_checked(spark: SparkSession, path: str, schema: T.StructType) -> Checked:
    """CSV under a declared schema, with the lines that do not fit kept apart.

    The text is read once and stored. The reason is ``columns`` for a wrong number of fields, else the
    name of the first field that is no value of its type.
    """
    declared = T.StructType([*schema.fields, T.StructField(BROKEN, T.StringType())])
    read = store(
        spark.read.schema(declared).option("columnNameOfCorruptRecord", BROKEN)
        .csv(path, header=True, enforceSchema=False, mode="PERMISSIVE"))
    broken = read.where(F.col(BROKEN).isNotNull()).select(F.col(BROKEN).alias("line"))
    # One field more than declared shows a line that has too many.
    texts = T.StructType([
        *[T.StructField(f"f{i}", T.StringType()) for i in range(len(schema.fields) + 1)]])
    fields = broken.withColumn("f", F.from_csv("line", texts.simpleString()[7:-1].replace(":", " ")))
    reason = F.when(
        F.col(f"f.f{len(schema.fields)}").isNotNull()
        | (F.size(F.split("line", ",")) < len(schema.fields)), "columns")
    for i, field in enumerate(schema.fields):
        value = F.col(f"f.f{i}")
        unread = value.isNotNull() & value.try_cast(field.dataType).isNull()
        reason = reason.when(unread, field.name)
    rejects = fields.select("line", reason.otherwise("other").alias("reason"))
    return Checked(read.where(F.col(BROKEN).isNull()).drop(BROKEN), rejects)


def read_table(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    drop_null: bool = False,
) -> DataFrame:
    """Parquet table, or only some of its columns; ``drop_null`` keeps complete rows.

    Of a published table it is the current version.
    """
    table = spark.read.parquet(current_version(spark, path))
    if columns is not None:
        table = table.select(*columns)
    return table.where(is_complete(table, table.columns)) if drop_null else table


def register_views(frames: Mapping[str, DataFrame]) -> None:
    """Make frames known to SQL under the given names."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)


def run_sql(spark: SparkSession, text: str, parameters: Parameters | None = None) -> DataFrame:
    """SQL with ``:name`` binds; values are bound, never pasted into the text."""
    return spark.sql(text, args=dict(parameters or {}))


# The small file that names the current version of a published table.
POINTER = "_current"


def _files(spark: SparkSession, path: str):
    """The file system of a path, whatever store it is in, and the path for it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def current_version(spark: SparkSession, path: str) -> str:
    """Folder of the current version of a published table, or ``path`` itself of any other."""
    files, pointer = _files(spark, f"{path}/{POINTER}")
    if not files.exists(pointer):
        return path
    stream = files.open(pointer)
    try:
        name = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return f"{path}/{name}"


def publish(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Replace a table that readers may be using.

    ``write`` fills a fresh version folder. Only when it is done does the pointer file change, by a
    rename. A failed or killed write leaves the table as it was, and a reader keeps the version
    it has opened: the one before stays until the next is published, older ones go.
    """
    old = current_version(spark, path)
    name = f"v-{uuid.uuid4().hex}"
    write(f"{path}/{name}")
    files, fresh = _files(spark, f"{path}/{POINTER}-{name}")
    stream = files.create(fresh, True)
    stream.write(name.encode())
    stream.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fresh.toUri(), spark._jsc.hadoopConfiguration())
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context.rename(fresh, _files(spark, f"{path}/{POINTER}")[1], options)
    for found in files.listStatus(_files(spark, path)[1]):
        place = found.getPath()
        if place.getName().startswith("v-") and place.getName() not in (name, old.split("/")[-1]):
            files.delete(place, True)


def write_table(
    frame: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    in_ranges: bool = False,
) -> None:
    """Publish a Parquet table in place of the one at ``path``.

    ``partition_by`` gives later readers partition pruning. ``cluster_by`` sorts the rows into
    ranges of these columns, so that filters on them skip files and row groups; ranges also
    split a value that holds many rows when a further column follows it. Rows whose partitions
    are such ranges already, ``in_ranges``, are written as they lie.
    """
    if cluster_by and not in_ranges:
        frame = frame.repartitionByRange(*cluster_by)
    if cluster_by:
        frame = frame.sortWithinPartitions(*cluster_by)
    publish(frame.sparkSession, path,
            lambda version: frame.write.partitionBy(*partition_by).parquet(version))


def write_csv(frame: DataFrame, path: str) -> None:
    """Replace a CSV table with a header line."""
    frame.write.mode("overwrite").csv(path, header=True)


def save_model(model: PipelineModel, path: str) -> None:
    """Replace a saved model."""
    model.write().overwrite().save(path)


def load_model(spark: SparkSession, path: str) -> PipelineModel | None:
    """Saved model, or None when there is none at ``path``."""
    try:
        spark.read.text(f"{path}/metadata").limit(0).collect()
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return PipelineModel.load(path)
