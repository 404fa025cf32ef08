"""Ranked lexical search by dense blocked matrix products.

A set of items (queries) is ranked against all documents. Items go in passes of bounded size; a pass
reads the documents once and stores, per block of documents, how often each holds the terms of
the pass. Counts over all documents then give every term an integer weight, and blocks are
scored tile by tile: the weights of some items over the compact vocabulary of just these items,
times the impacts of some documents over the same terms, as one float64 product. Weights and
impacts are whole numbers, and vocabulary tiles are cut so that no partial sum reaches 2**53: every
product is exact in any order of addition, and tiles add up in 64-bit integers.

Each task keeps the best ``k`` of each item over its blocks: all scores at or over the worst kept
one are looked at, so ties at the edge are settled by doc_id whatever the tile. Lists of the
tasks meet in two rounds, first by item and one of ``SALTS`` groups of tasks.

Terms are maximal runs of ASCII letters, digits and all characters that are not ASCII, A-Z lowered,
compared by 64-bit hashes. A null text has no terms. Each row of the items is an item, each row of
the documents a document: repeated ones are ranked repeatedly. A null doc_id comes before others
of its score. Other columns of both tables play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from punctua.llm import words as W
from punctua.llm.shared import keep

BEST = 50
# Bytes of item texts, and items, that one pass over the documents serves.
PASS_BYTES, PASS_ITEMS = 4 << 20, 1024
# Items, terms and documents of one product.
ITEM_TILE, TERM_TILE, DOCUMENT_TILE = 64, 4096, 1024
# Every impact is below this, and every partial sum stays below the last.
IMPACT_BOUND, EXACT = 1_000_000, 2**53
SALTS = 64

BLOCK = (
    "ids array<long>, sizes binary, counts binary, terms binary, times binary, "
    "n_docs long, n_terms long, holding array<long>"
)


@dataclass
class Items:
    """Items of one pass: their rows, and per item its different terms as numbers in ``terms``."""

    rows: np.ndarray
    terms: np.ndarray
    of: list[np.ndarray]

    @classmethod
    def read(cls, rows: list, texts: list) -> Items:
        found = W.split_words(pa.array(texts, pa.string()), W.ALPHANUMERIC)
        terms, numbers = np.unique(found.hashes, return_inverse=True)
        of = [np.unique(numbers[a:b]) for a, b in zip(found.bounds, found.bounds[1:])]
        return cls(np.array(rows, np.int64), terms, of)


def _counted(terms: np.ndarray):
    """Task function: blocks of documents with the terms they hold, and the task's totals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_docs = n_terms = 0
        holding = np.zeros(len(terms), np.int64)
        names = [field.split()[0] for field in BLOCK.split(", ")]
        kinds = [pa.list_(pa.int64()), *[pa.binary()] * 4, pa.int64(), pa.int64(),
                 pa.list_(pa.int64())]

        def row(*values) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [v if isinstance(v, pa.Array) else pa.array([v], kind)
                 for v, kind in zip(values, kinds)], names)

        for batch in batches:
            for part in W.slices(batch, "text"):
                found = W.split_words(part.column("text"), W.ALPHANUMERIC)
                sizes = np.diff(found.bounds)
                n_docs += int((sizes > 0).sum())
                n_terms += len(found.hashes)
                if not len(terms):
                    continue
                owner = np.repeat(np.arange(len(sizes)), sizes)
                place = np.minimum(np.searchsorted(terms, found.hashes), len(terms) - 1)
                met = terms[place] == found.hashes
                pairs, times = np.unique(
                    owner[met] * len(terms) + place[met], return_counts=True)
                documents, numbers = np.divmod(pairs, len(terms))
                holding += np.bincount(numbers, minlength=len(terms))
                here, counts = np.unique(documents, return_counts=True)
                for a in range(0, len(here), DOCUMENT_TILE):
                    some = here[a : a + DOCUMENT_TILE]
                    first, last = np.searchsorted(documents, [some[0], some[-1] + 1])
                    ids = part.column("doc_id").take(pa.array(some))
                    yield row(
                        pa.ListArray.from_arrays(pa.array([0, len(some)], pa.int32()), ids),
                        *[values.astype("<i4").tobytes() for values in (
                            sizes[some], counts[a : a + DOCUMENT_TILE], numbers[first:last],
                            times[first:last])], None, None, None)
        yield row(None, None, None, None, None, n_docs, n_terms, holding)

    return run


def mean_lengths(sizes: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """50 + (50 * size * n_docs) div n_terms, in 64 bits also where the product needs more."""
    if not len(sizes):
        return sizes.astype(np.int64)
    if int(sizes.max()) * 50 * n_docs < 2**63:
        return 50 + 50 * sizes.astype(np.int64) * n_docs // n_terms
    return np.array([50 + 50 * int(n) * n_docs // n_terms for n in sizes], np.int64)


def weights(holding: np.ndarray, n_docs: int) -> np.ndarray:
    """Weight of a term by the documents that hold it; at least 0, since they are among all."""
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(n) + 1)))
                     for n in holding], np.int64)


@dataclass
class Tile:
    """Items of a tile (numbers in the pass) and vocabulary tiles: terms, and a dense matrix each."""

    items: np.ndarray
    parts: list[tuple[np.ndarray, np.ndarray]]


def tiles(items: Items, weight: np.ndarray) -> list[Tile]:
    """Items by ``ITEM_TILE``, each with the compact vocabulary of its own items.

    A vocabulary tile ends before an item's weights in it could add up to an inexact sum.
    """
    made = []
    for begin in range(0, len(items.of), ITEM_TILE):
        some = items.of[begin : begin + ITEM_TILE]
        vocabulary = np.unique(np.concatenate(some)) if some else np.zeros(0, np.int64)
        vocabulary = vocabulary[weight[vocabulary] > 0]
        bound = np.cumsum(weight[vocabulary] * IMPACT_BOUND) if len(vocabulary) else vocabulary
        parts, first = [], 0
        while first < len(vocabulary):
            used = bound[first - 1] if first else 0
            last = int(np.searchsorted(bound, used + EXACT - 1, "right"))
            last = min(first + TERM_TILE, max(last, first + 1), len(vocabulary))
            terms = vocabulary[first:last]
            dense = np.zeros((len(some), len(terms)))
            for number, own in enumerate(some):
                mine = own[np.isin(own, terms)]
                dense[number, np.searchsorted(terms, mine)] = weight[mine]
            parts.append((terms, dense))
            first = last
        made.append(Tile(np.arange(begin, begin + len(some)), parts))
    return made


class Top:
    """The best documents of each item so far: scores, and ids with a mark for null ones."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.lists = [np.zeros((3, 0), np.int64) for _ in range(items)]
        self.worst = np.ones(items, np.int64)

    def add(self, items: np.ndarray, scores: np.ndarray, known: np.ndarray, ids: np.ndarray) -> None:
        """Scores (items x documents); those below 1 never count."""
        enough = scores >= self.worst[items][:, None]
        for row in np.flatnonzero(enough.any(1)):
            item, here = items[row], np.flatnonzero(enough[row])
            both = np.concatenate(
                (self.lists[item], np.stack((scores[row, here], known[here], ids[here]))), 1)
            order = np.lexsort((both[2], both[1], -both[0]))[: self.k]
            self.lists[item] = both[:, order]
            if len(order) == self.k:
                self.worst[item] = both[0, order[-1]]


def _scored(items: Items, weight: np.ndarray, n_docs: int, n_terms: int, k: int):
    """Task function: the best documents of each item over the task's blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top, made = Top(len(items.of), k), tiles(items, weight)
        for batch in batches:
            for row in range(batch.num_rows):
                ids = batch.column("ids").slice(row, 1).flatten()
                known = np.asarray(ids.is_valid()).astype(np.int64)
                ids = ids.fill_null(0).to_numpy()
                sizes, counts, terms, times = (
                    np.frombuffer(batch.column(name)[row].as_buffer(), "<i4")
                    for name in ("sizes", "counts", "terms", "times"))
                owner = np.repeat(np.arange(len(ids)), counts)
                length = 20 * mean_lengths(sizes, n_docs, n_terms)
                often = times.astype(np.int64)
                impact = 10**9 * often // (1000 * often + length[owner])
                for tile in made:
                    total = np.zeros((len(tile.items), len(ids)), np.int64)
                    for vocabulary, dense in tile.parts:
                        column = np.full(len(weight), -1, np.int32)
                        column[vocabulary] = np.arange(len(vocabulary))
                        at = column[terms]
                        met = at >= 0
                        impacts = np.zeros((len(ids), len(vocabulary)))
                        impacts[owner[met], at[met]] = impact[met]
                        total += (dense @ impacts.T).astype(np.int64)
                    top.add(tile.items, total, known, ids)
        for row, best in zip(items.rows, top.lists):
            if best.shape[1]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(best.shape[1], row)), pa.array(best[0]),
                     pa.array(best[2], mask=best[1] == 0)], ["row", "score", "doc_id"])

    return run


def _rank_pass(docs: DataFrame, items: Items, k: int) -> DataFrame:
    """``(row, rank, doc_id, score)`` of the items of one pass."""
    blocks = keep(docs.mapInArrow(_counted(items.terms), BLOCK), "blocks")
    totals = blocks.where(F.col("n_docs").isNotNull())
    sums = totals.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    n_docs, n_terms = sums[0] or 0, sums[1] or 0
    holding = np.zeros(len(items.terms), np.int64)
    for term, n in (
        totals.select(F.posexplode("holding").alias("term", "n")).groupBy("term")
        .agg(F.sum("n").alias("n")).toLocalIterator()
    ):
        holding[term] = n
    found = blocks.where(F.col("ids").isNotNull()).select(
        "ids", "sizes", "counts", "terms", "times"
    ).mapInArrow(
        _scored(items, weights(holding, n_docs), n_docs, n_terms, k),
        "row long, score long, doc_id long",
    ).withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    best = [F.desc("score"), F.asc_nulls_first("doc_id")]
    for keys in (["row", "salt"], ["row"]):
        over = Window.partitionBy(*keys).orderBy(*best)
        found = found.withColumn("rank", F.row_number().over(over)).where(F.col("rank") <= k)
    return found.select("row", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = BEST, pass_bytes: int = PASS_BYTES,
           pass_items: int = PASS_ITEMS) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` highest-scoring documents of each item.

    Scores are above 0 and sum, over the item's different terms, the weight of the term times its
    impact in the document. ``docs`` has doc_id (cast to long) and text, ``items`` item_id and text.
    The items of a pass are held by the driver and every task: at most about ``pass_bytes``, or one
    larger item, and about ``pass_items`` rows, by a hash of their row numbers.
    """
    numbered = keep(
        items.select(
            "item_id", F.col("text").cast("string").alias("text"),
            F.monotonically_increasing_id().alias("row")), "items")
    rows, size = numbered.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    passes = max(1, -(-rows // pass_items), -(-(size or 0) // pass_bytes))
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                         F.col("text").cast("string").alias("text"))
    results = []
    for number in range(passes):
        some = numbered.where(F.pmod(F.xxhash64("row"), F.lit(passes)) == number)
        held = some.select("row", "text").orderBy("row").collect()
        read = Items.read([r["row"] for r in held], [r["text"] for r in held])
        results.append(_rank_pass(narrow, read, k))
    ranked = reduce(DataFrame.unionByName, results)
    return numbered.select("row", "item_id").join(ranked, "row").select(
        "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def op12_lexical_search(spark, sf_dir: str) -> DataFrame:
    """All documents ranked for every benchmark item."""
    return search(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                  spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_TERMS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

SQL = f"""
WITH words AS (
  SELECT r, doc_id, unnest(terms) AS term FROM (
    SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS terms FROM documents)
), asked AS (
  SELECT DISTINCT i, item_id, unnest(terms) AS term FROM (
    SELECT row_number() OVER () AS i, item_id, {_TERMS} AS terms FROM benchmark)
), sizes AS (SELECT r, count(*) AS n FROM words GROUP BY r),
whole AS (SELECT count(*) AS nn, sum(n)::BIGINT AS l FROM sizes),
times AS (SELECT r, doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
weight AS (
  SELECT term, floor(1000 * ln((2 * any_value(nn) + 2) / (2 * count(*) + 1)))::BIGINT AS w
  FROM times, whole GROUP BY term
), scores AS (
  SELECT i, item_id, r, doc_id, sum(
    w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * nn) // l))))::BIGINT AS score
  FROM asked JOIN times USING (term) JOIN weight USING (term) JOIN sizes USING (r), whole
  GROUP BY ALL
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS FIRST) AS rank
  FROM scores WHERE score > 0
)
SELECT item_id, rank::INT AS rank, doc_id, score FROM placed WHERE rank <= {BEST}
"""
