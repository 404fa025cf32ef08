"""Benchmark decontamination by a distributed positional inverted index.

The index is partitioned by document, as search engines shard theirs: each row is a block of
whole documents with, for every term in it, the sorted list of its word positions. A phrase is
looked up from its rarest term: the positions of that term, shifted to the phrase start, are
intersected with the shifted lists of the other terms in order of rarity. No term, phrase or
document is gathered across blocks, so frequent terms cost each block only its own share.

Terms are 64-bit word hashes. Words are runs of letters, digits and non-ASCII characters with
A-Z lowered. A document or item whose text is null has no words; repeated items count once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctua.llm import words as W
from punctua.llm.shared import keep

WINDOW = 10
# Text of test items searched at once; more items take further passes over the index. Their windows
# take about 15 times as many bytes, on the driver and in every task.
PASS_BYTES = 4 << 20
# Candidate positions intersected at once.
CANDIDATES = 1 << 20

INDEX = (
    "block long, ids array<long>, n_words array<int>, terms binary, counts binary, "
    "positions binary"
)


def build_index(docs: DataFrame) -> DataFrame:
    """Blocks of postings of all terms of ``docs`` (doc_id, text); other columns are ignored."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in W.slices(batch, "text"):
                found = W.split_words(part.column("text"), W.ALPHANUMERIC)
                order = np.argsort(found.hashes, kind="stable")
                terms, counts = np.unique(found.hashes[order], return_counts=True)
                gaps = np.diff(order, prepend=0)
                heads = np.cumsum(counts)[:-1]
                gaps[heads] = order[heads]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number]),
                        pa.array([part.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                        pa.array([np.diff(found.bounds)], pa.list_(pa.int32())),
                        pa.array([terms.tobytes()], pa.binary()),
                        pa.array([counts.astype("<u4").tobytes()], pa.binary()),
                        pa.array([gaps.astype("<u4").tobytes()], pa.binary()),
                    ],
                    ["block", "ids", "n_words", "terms", "counts", "positions"],
                )
                number += 1

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return narrow.mapInArrow(blocks, INDEX)


@dataclass
class Phrases:
    """Phrases of one length: a row of term hashes each, and the item of each."""

    terms: np.ndarray
    items: np.ndarray


def phrases_of(ids: list, texts: list, window: int) -> tuple[list[str], list[Phrases]]:
    """Distinct item names, and all windows of the items grouped by their length.

    Windows are rows of numbers, 8 bytes for each of their words and the item.
    """
    names = sorted({"" if i is None else str(i) for i in ids})
    place = {name: number for number, name in enumerate(names)}
    items = np.array([place["" if i is None else str(i)] for i in ids], np.uint64)
    found = W.split_words(pa.array(texts, pa.large_string()), W.ALPHANUMERIC)
    counts = np.diff(found.bounds)
    owner = np.repeat(np.arange(len(counts)), counts)
    left = np.repeat(found.bounds[1:], counts) - np.arange(len(owner))
    groups = []
    for length in np.unique(np.minimum(counts, window)):
        if not length:
            continue
        # All windows of items long enough; shorter items have the whole of them as one.
        fits = (left >= length) & (np.minimum(counts, window) == length)[owner]
        starts = np.flatnonzero(fits)
        rows = np.empty((len(starts), int(length) + 1), np.uint64)
        for step in range(int(length)):
            rows[:, step] = found.hashes[starts + step]
        rows[:, -1] = items[owner[starts]]
        rows = np.unique(rows, axis=0)
        groups.append(Phrases(rows[:, :-1].copy(), rows[:, -1].astype(np.int64)))
    return names, groups


class Block:
    """One block of the index, opened for search."""

    def __init__(self, n_words: np.ndarray, terms: bytes, counts: bytes, positions: bytes):
        self.bounds = np.concatenate(([0], np.cumsum(n_words, dtype=np.int64)))
        self.terms = np.frombuffer(terms, "<u8")
        self.counts = np.frombuffer(counts, "<u4").astype(np.int64)
        self.heads = np.cumsum(self.counts) - self.counts
        gaps = np.frombuffer(positions, "<u4").astype(np.int64)
        summed = np.cumsum(gaps)
        before = summed[self.heads] - gaps[self.heads]
        self.positions = summed - np.repeat(before, self.counts)
        owner = np.repeat(np.arange(len(self.terms), dtype=np.int64), self.counts)
        # Sorted, as terms and the positions of each are.
        self.keys = (owner << 32) | self.positions

    def lookup(self, terms: np.ndarray) -> np.ndarray:
        """Number of each term in this block, -1 where it does not occur."""
        if not len(self.terms):
            return np.full(terms.shape, -1, np.int64)
        place = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[place] == terms, place, -1)

    def occurrences(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All positions of the given terms, and the row of ``numbers`` of each."""
        counts = self.counts[numbers]
        rows = np.repeat(np.arange(len(numbers)), counts)
        inside = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)
        return self.positions[self.heads[numbers][rows] + inside], rows

    def contains(self, numbers: np.ndarray, positions: np.ndarray) -> np.ndarray:
        keys = (numbers << 32) | positions
        place = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return self.keys[place] == keys

    def document(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bounds, positions, "right") - 1

    def _runs(self, numbers: np.ndarray) -> Iterator[slice]:
        """Cut rows so that the postings of each run's first terms stay bounded."""
        totals = np.cumsum(self.counts[numbers])
        begin = 0
        while begin < len(numbers):
            base = totals[begin] - self.counts[numbers[begin]]
            end = int(np.searchsorted(totals, base + CANDIDATES, "right"))
            yield slice(begin, end := max(end, begin + 1))
            begin = end

    def exact(self, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
        """Start of every occurrence of a phrase within one document, and its item."""
        length = phrases.terms.shape[1]
        vocabulary, place = np.unique(phrases.terms, return_inverse=True)
        numbers = self.lookup(vocabulary)[place].reshape(phrases.terms.shape)
        there = (numbers >= 0).all(axis=1)
        numbers, items = numbers[there], phrases.items[there]
        rarity = np.argsort(self.counts[numbers], axis=1, kind="stable")
        numbers = np.take_along_axis(numbers, rarity, axis=1)
        starts, owners = [], []
        for run in self._runs(numbers[:, 0]) if len(numbers) else ():
            at, rows = self.occurrences(numbers[run, 0])
            at = at - rarity[run][rows, 0]
            rows = rows[at >= 0]
            at = at[at >= 0]
            for step in range(1, length):
                both = self.contains(
                    numbers[run][rows, step], at + rarity[run][rows, step]
                )
                at, rows = at[both], rows[both]
            whole = at + length <= self.bounds[1:][self.document(at)]
            starts.append(at[whole])
            owners.append(items[run][rows[whole]])
        if not starts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(starts), np.concatenate(owners)

    def near(self, terms: np.ndarray, distance: int) -> np.ndarray:
        """Positions of the first term with all others within ``distance`` in its document."""
        numbers = self.lookup(terms)
        if not len(numbers) or (numbers < 0).any():
            return np.zeros(0, np.int64)
        at, _ = self.occurrences(numbers[:1])
        for number in numbers[1:]:
            owner = self.document(at)
            low = np.maximum(at - distance, self.bounds[owner])
            high = np.minimum(at + distance, self.bounds[owner + 1] - 1)
            first = np.searchsorted(self.keys, (number << 32) | low)
            last = np.searchsorted(self.keys, (number << 32) | high, "right")
            at = at[last > first]
        return at


def _passes(items: DataFrame, limit: int) -> Iterator[tuple[list, list]]:
    """Item ids and texts in parts of bounded size."""
    spread = items.select("item_id", "text").where(F.col("text").isNotNull()).distinct()
    size = spread.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = -(-size // limit) or 1
    spread = spread.withColumn("_part", F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)))
    for part in range(parts):
        rows = spread.where(F.col("_part") == part).collect()
        yield [row["item_id"] for row in rows], [row["text"] for row in rows]


def _open(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list, Block]]:
    for batch in batches:
        for row in range(batch.num_rows):
            block, ids, n_words, *lists = (column[row].as_py() for column in batch.columns)
            yield block, ids, Block(np.array(n_words, np.int64), *lists)


HITS = "block long, place int, hits array<struct<start:long,stop:long>>, items array<string>"


def _covered(starts: np.ndarray, stops: np.ndarray, bounds: np.ndarray) -> tuple:
    """Unions of the spans, cut at the bounds of documents."""
    depth = np.zeros(bounds[-1] + 1, np.int32)
    np.add.at(depth, starts, 1)
    np.add.at(depth, stops, -1)
    inside = np.cumsum(depth)[:-1] > 0
    opens, closes = inside.copy(), np.zeros(len(inside) + 1, bool)
    opens[1:] &= ~inside[:-1]
    closes[1:] = inside
    closes[:-1] &= ~inside
    heads = bounds[:-1][bounds[:-1] < len(inside)]
    opens[heads] = inside[heads]
    inner = heads[heads > 0]
    closes[inner] = inside[inner - 1]
    return np.flatnonzero(opens), np.flatnonzero(closes)


def phrase_hits(index: DataFrame, items: DataFrame, window: int = WINDOW,
                pass_bytes: int = PASS_BYTES) -> DataFrame:
    """Per document with exact matches: its hit word ranges and the items (``HITS``)."""
    spark = index.sparkSession
    found = None
    for ids, texts in _passes(items, pass_bytes):
        shared = spark.sparkContext.broadcast(phrases_of(ids, texts, window))

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            names, groups = shared.value
            for number, _, block in _open(batches):
                starts, stops, owners = [], [], []
                for group in groups:
                    at, item = block.exact(group)
                    starts.append(at)
                    stops.append(at + group.terms.shape[1])
                    owners.append(item)
                if not sum(map(len, starts)):
                    continue
                starts, stops = np.concatenate(starts), np.concatenate(stops)
                owners = np.concatenate(owners)
                opens, closes = _covered(starts, stops, block.bounds)
                pairs = np.unique(block.document(starts) * len(names) + owners)
                places, heads = np.unique(pairs // len(names), return_index=True)
                lists = np.split(pairs % len(names), heads[1:])
                bounds = np.searchsorted(block.document(opens), [*places, len(block.bounds)])
                rows = [
                    {
                        "block": number, "place": int(place),
                        "hits": [
                            {"start": int(a), "stop": int(b)}
                            for a, b in zip(opens[low:high], closes[low:high])
                        ],
                        "items": [names[i] for i in own],
                    }
                    for place, own, low, high in zip(places, lists, bounds, bounds[1:])
                ]
                yield pa.RecordBatch.from_pylist(rows, HITS_ARROW)

        part = index.mapInArrow(search, HITS)
        found = part if found is None else found.unionByName(keep(part, "hits"))
        if found is part:
            found = keep(part, "hits")
    return found


HITS_ARROW = pa.schema([
    ("block", pa.int64()), ("place", pa.int32()),
    ("hits", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
    ("items", pa.list_(pa.string())),
])


def _union_size(ranges: Column) -> Column:
    """Words covered by ranges given in any order."""
    start = F.struct(F.lit(0).cast("long").alias("size"), F.lit(0).cast("long").alias("upto"))
    return F.aggregate(
        F.array_sort(ranges), start,
        lambda state, span: F.struct(
            (state["size"] + F.greatest(
                F.lit(0).cast("long"), span["stop"] - F.greatest(span["start"], state["upto"])
            )).alias("size"),
            F.greatest(state["upto"], span["stop"]).alias("upto"),
        ),
        lambda state: state["size"],
    )


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW,
                  pass_bytes: int = PASS_BYTES) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, items (sorted names), contaminated.

    Other columns of the tables are ignored, whatever their names.

    A window is ``window`` consecutive words of an item, or a shorter item as a whole. Words of
    a document inside any occurrence of a window are hit. The benchmark may have any size: it
    is broadcast in parts of ``pass_bytes``. Copies of a row give a row each.
    """
    index = keep(build_index(docs), "postings")
    return _located(index, items, window, pass_bytes).drop("block", "place")


def _located(index: DataFrame, items: DataFrame, window: int, pass_bytes: int) -> DataFrame:
    """Rows of :func:`decontaminate` with the place of each document in the index."""
    found = phrase_hits(index, items, window, pass_bytes)
    merged = found.groupBy("block", "place").agg(
        _union_size(F.flatten(F.collect_list("hits"))).alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    all_docs = index.select(
        "block", F.posexplode(F.arrays_zip("ids", "n_words")).alias("place", "doc")
    ).select("block", "place", F.col("doc.ids").alias("doc_id"),
             F.col("doc.n_words").cast("long").alias("n_words"))
    return all_docs.join(merged, ["block", "place"], "left").select(
        "block", "place", "doc_id", "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def _term_counts(index: DataFrame, terms: np.ndarray) -> dict[int, int]:
    """Occurrences over the whole index of those of the given terms that it holds."""
    shared = index.sparkSession.sparkContext.broadcast(terms)
    form = pa.schema([("term", pa.int64()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(len(shared.value), np.int64)
        for _, _, block in _open(batches):
            numbers = block.lookup(shared.value)
            there = numbers >= 0
            sums[there] += block.counts[numbers[there]]
        held = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(shared.value[held].view(np.int64)), pa.array(sums[held])], schema=form)

    rows = index.mapInArrow(count, "term long, n long").groupBy("term").agg(
        F.sum("n").alias("n")).collect()
    return {row["term"] % 2**64: row["n"] for row in rows}


NEAR = "block long, place int, doc_id long, item string, position long"
NEAR_ARROW = pa.schema([("block", pa.int64()), ("place", pa.int32()), ("doc_id", pa.int64()),
                        ("item", pa.string()), ("position", pa.int64())])


def proximity_hits(index: DataFrame, items: DataFrame, distance: int = 20, rarest: int = 3,
                   pass_bytes: int = PASS_BYTES) -> DataFrame:
    """Places where the ``rarest`` rarest terms of an item stand within ``distance`` words.

    Rows (block, place, doc_id, item, position): the document's place in the index, and the word
    position of the rarest term in it. Rarity is that of the whole index, however it is cut; terms of
    an item that it does not hold are left out.
    """
    spark = index.sparkSession
    found = None
    for ids, texts in _passes(items, pass_bytes):
        split = W.split_words(pa.array(texts, pa.large_string()), W.ALPHANUMERIC)
        counts = _term_counts(index, np.unique(split.hashes))
        terms = [
            np.array(sorted((t for t in set(split.hashes[a:b].tolist()) if t in counts),
                            key=lambda t: (counts[t], t))[:rarest], np.uint64)
            for a, b in zip(split.bounds, split.bounds[1:])
        ]
        shared = spark.sparkContext.broadcast((["" if i is None else str(i) for i in ids], terms))

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            names, queries = shared.value
            for number, doc_ids, block in _open(batches):
                rows = []
                for name, query in zip(names, queries):
                    for at in block.near(query, distance):
                        place = int(block.document(at))
                        rows.append({"block": number, "place": place, "doc_id": doc_ids[place],
                                     "item": name, "position": int(at - block.bounds[place])})
                yield pa.RecordBatch.from_pylist(rows, NEAR_ARROW)

        part = index.mapInArrow(search, NEAR)
        found = keep(part, "near") if found is None else found.unionByName(keep(part, "near"))
    return found.distinct()


def op9_decontamination(spark, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items; ``n_near`` counts items met by proximity.

    One index serves the exact phrases and the proximity search.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    index = keep(build_index(docs), "postings")
    near = proximity_hits(index, items).groupBy("block", "place").agg(
        F.count_distinct("item").alias("n_near"))
    found = _located(index, items, WINDOW, PASS_BYTES).join(near, ["block", "place"], "left")
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
    )
