"""A training corpus from raw documents: select, clean, deduplicate, decontaminate, tokenize.

Each stage takes (spark, docs, sf_dir) and returns a frame, which ``run`` writes as Parquet to the
shared folder and reads back for the next one. All but the last keep the columns of documents,
further ones included, whatever their names; the last replaces ``ids``, ``n_tokens`` and ``restored``.
Null or repeated ids and texts are rows like any other; doc_id is a number.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctua.llm import bpe, lines, minhash, postings, quality
from punctua.llm.shared import keep, quoted, unused


def _without(docs: DataFrame, find: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """``docs`` without the rows whose number ``find`` returns as column ``row``.

    Rows are stored with their number first, so that it stays the same whenever a task runs again.
    The numbers found are stored as well: few are broadcast, many are joined. ``find`` gets the
    stored rows and the name of the number, which no column of ``docs`` has.
    """
    number = unused(docs, "_row")
    stored = keep(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    gone = keep(find(stored, number).select(F.col("row").alias(number)), "gone")
    left = stored.join(gone, number, "left_anti")
    return left.select(*[F.col(quoted(name)) for name in docs.columns])


def select_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the selection keeps; labels come from the labels table."""
    return quality.selected(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the boilerplate lines of their source; none of them goes.

    Copies count as one document, or they would lose their text before one of them is kept.
    """
    # Under names of their own, so that columns named like the results stay as they are.
    own = [f"c{i}" for i in range(len(docs.columns))]
    place = dict(zip(docs.columns, own))
    cleaned = lines.drop_boilerplate(
        docs.toDF(*own), F.col(place["source"]), F.col(place["text"]), fold_copies=True)
    kind = docs.schema["n_chars"].dataType
    return cleaned.withColumns({
        place["text"]: F.col("text_kept"),
        place["n_chars"]: F.when(F.col("n_dropped") == 0, F.col(place["n_chars"]))
        .otherwise(F.char_length("text_kept")).cast(kind),
    }).select(*own).toDF(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of the least doc_id."""
    return _without(docs, lambda stored, number: minhash.near_duplicates(
        stored, shingle=5, row_id=number).where(~F.col("kept_row")))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _without(docs, lambda stored, number: postings.decontaminate(
        stored.select(F.col(number).alias("doc_id"), "text"), items
    ).where("contaminated").select(F.col("doc_id").alias("row")))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ``ids``, ``n_tokens``, and whether decoding gives back the text."""
    return bpe.encode_checked(docs, bpe.default_ranks())


STAGES = [
    ("quality", select_quality),
    ("lines", drop_lines),
    ("near_copies", drop_near_copies),
    ("benchmark", drop_contaminated),
    ("tokens", tokenize),
]

# Hash sketches, sampling noise and tokens have no plain SQL; tests check each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), name)
    return docs
