"""Tables between the steps of an operator, kept where every executor can reach them."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctua.operators.settle import fresh_path


def keep(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame as Parquet to the shared folder and read it back."""
    path = fresh_path(frame.sparkSession, name)
    frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def documents(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def map_beside(docs: DataFrame, text: str, function: Callable, added: Sequence[T.StructField],
               more: Sequence[str] = ()) -> DataFrame:
    """All columns of ``docs``, followed by the columns ``added`` that an Arrow function makes.

    The function gets batches with the columns ``text`` and those named in ``more`` (``m0``, ...),
    and returns, for each slice of them, the rows of that slice and the arrays of the added columns.
    Columns travel under names of their own, so any name of the input is safe; those named like an
    added column are replaced.
    """
    new = {field.name for field in added}
    names = [name for name in docs.columns if name not in new]
    kinds = {field.name: field.dataType for field in docs.schema}
    numbered = [f"c{i}" for i in range(len(names))]
    carried = docs.select(
        *[F.col(quoted(name)).alias(c) for name, c in zip(names, numbered)],
        *[F.col(quoted(name)).alias(f"m{i}") for i, name in enumerate(more)],
        F.col(quoted(text)).cast("string").alias("text"),
    )
    results = [f"r{i}" for i in range(len(added))]
    schema = T.StructType([
        *[T.StructField(c, kinds[name]) for name, c in zip(names, numbered)],
        *[T.StructField(r, field.dataType) for r, field in zip(results, added)],
    ])

    def run(batches):
        import pyarrow as pa

        for rows, arrays in function(batches):
            yield pa.RecordBatch.from_arrays(
                [*[rows.column(c) for c in numbered], *arrays], [*numbered, *results])

    return carried.mapInArrow(run, schema).toDF(*names, *[field.name for field in added])


def unused(frame: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of the frame has, whatever the case."""
    taken = {column.lower() for column in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
