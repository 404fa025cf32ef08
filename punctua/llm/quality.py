"""Quality selection by importance resampling, and a filter by the same models.

Two generative models over hashed n-grams, one of target text (labelled good and not toxic) and
one of all raw text, give each document a log importance weight: the sum of the log ratios of its
distinct n-grams. Gumbel noise is added to the weights and the k largest keys are the sample.

N-grams are words, word pairs, word beginnings, runs of punctuation, the share of the text each such
run has, and the share of tokens that repeat the one before. Counts are numbers of documents, so
that copies within a text do not count. Raw counts cover all documents. To the target count and the
expected one ``PRIOR`` documents times the root of the target's number are added.

A sample of a large share of the raw text leaves most of what the target does not hold in it. The
filter decides: it multiplies each ratio by the probability that its bucket has different shares
in target and labelled bad documents, from their counts and the share ``DIFFERENT`` of such buckets
assumed before. Texts of more than ``USUAL`` n-grams have that sum scaled to as many, or chance would
add up in them; the sum of ratios over one is scaled to ``GAINS`` n-grams: the target is part of
the raw text, so these are small and many, and would let long texts outweigh what speaks against
them.

The target is a bounded sample of ``LABELS`` labelled rows, those of least hash; one in four of
them is held out and sets k: the number of documents at or over the filter weight that best parts
held-out good ones from bad ones. Without labels of both kinds all documents are selected.

A null text is an empty one. A document with several labels is good only if all are; a null label
counts for nothing. Rows that tie with the k-th key are all selected. Repeated rows get equal keys.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctua.llm import words as W
from punctua.llm.shared import keep, map_beside, unused

# The first buckets are those of words and beginnings, then come word pairs. The last are those
# of shares, so that no frequent word falls in with them.
WORDS = 1 << 20
SHAPES = 1 << 14
BUCKETS = 2 * WORDS + SHAPES
CHUNK = 1 << 12
# Distinct n-grams from which a sum of losses or gains is scaled down to as many.
USUAL, GAINS = 1000, 100
# Bytes of the word beginnings that are n-grams too.
PREFIX = 5
LABELS = 200_000
HELD_OUT = 4
PRIOR, DIFFERENT = 0.01, 0.01
TEMPERATURE = 0.1
# Weights are counted in steps of this size between these ends to find the cut.
STEP, ENDS = 0.05, 1000.0

_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_WORD = W.NOT_SPACE & ~_PUNCTUATION
_LOW = np.uint64(WORDS - 1)
_ROW = BUCKETS.bit_length()
_PAIR = np.uint64(0xD6E8FEB86659FD93)
GOOD, BAD, FIT = 1, 2, 3


def ngrams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of each text and the row of each, ordered by row."""
    words, marks = W.split_words(column, _WORD), W.split_words(column, _PUNCTUATION)
    long = words.stops - words.starts >= PREFIX
    data, _ = W.text_bytes(column)
    heads = W.hash_spans(W.LOWER[data], words.starts[long], words.starts[long] + PREFIX)
    starts = np.concatenate((words.starts, marks.starts))
    order = np.argsort(starts, kind="stable")
    hashes = np.concatenate((words.hashes, marks.hashes))[order]
    bounds = words.bounds + marks.bounds
    sizes = np.diff(bounds)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    share = np.bincount(owner, same, len(sizes)) / np.maximum(sizes, 1)
    level = np.minimum(12, np.floor(-np.log2(np.maximum(share, 2.0**-12)))).astype(np.int64)
    # How much of the text each run of punctuation is.
    count = np.diff(marks.bounds)
    pairs, often = np.unique(
        np.rec.fromarrays((np.repeat(np.arange(len(count)), count), marks.hashes)),
        return_counts=True,
    )
    rate = np.floor(-np.log2(often / sizes[pairs.f0])).astype(np.uint64)
    span = np.uint64(SHAPES - 13)
    words_of = np.repeat(np.arange(len(sizes)), np.diff(words.bounds))
    follows = words_of[1:] == words_of[:-1]
    twos = W.mix(words.hashes[:-1] * _PAIR + words.hashes[1:])[follows]
    buckets = np.concatenate((
        (hashes & _LOW).astype(np.int64),
        (W.mix(heads + np.uint64(PREFIX)) & _LOW).astype(np.int64),
        WORDS + (twos & _LOW).astype(np.int64),
        BUCKETS - 1 - level,
        BUCKETS - SHAPES + (W.mix(pairs.f1 + rate) % span).astype(np.int64),
    ))
    rows = np.concatenate((
        owner, words_of[long], words_of[1:][follows], np.arange(len(sizes)), pairs.f0))
    keys = np.sort((rows << _ROW) | buckets)
    keys = keys[np.concatenate(([True], keys[1:] != keys[:-1]))] if len(keys) else keys
    return keys & ((1 << _ROW) - 1), keys >> _ROW


@dataclass
class Labels:
    """A bounded sample of labelled ids, sorted, with their kind."""

    ids: np.ndarray
    kinds: np.ndarray

    def of(self, column: pa.Array) -> np.ndarray:
        ids = column.to_numpy(zero_copy_only=False)
        if column.null_count or not len(self.ids):
            known = np.array([-1 if i is None else i for i in column.to_pylist()], np.int64)
            present = np.array([i is not None for i in column.to_pylist()], bool)
        else:
            known, present = ids.astype(np.int64), np.ones(len(ids), bool)
        if not len(self.ids):
            return np.zeros(len(known), np.int8)
        place = np.minimum(np.searchsorted(self.ids, known), len(self.ids) - 1)
        return np.where(present & (self.ids[place] == known), self.kinds[place], 0)


def sample_labels(labels: DataFrame, limit: int = LABELS) -> Labels:
    """At most ``limit`` labelled ids, those of least hash."""
    known = labels.where("doc_id is not null and quality is not null").groupBy(
        F.col("doc_id").cast("long").alias("doc_id")
    ).agg(F.min((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).alias("good"))
    rows = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit).select(
        "doc_id", "good", (F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(HELD_OUT)) == 0)
        .alias("held")
    ).toArrow().sort_by("doc_id")
    good = np.array(rows.column("good").to_pylist(), bool)
    held = np.array(rows.column("held").to_pylist(), bool)
    kinds = np.where(good, np.where(held, GOOD, FIT), BAD).astype(np.int8)
    return Labels(np.array(rows.column("doc_id").to_pylist(), np.int64), kinds)


def count_ngrams(docs: DataFrame, labels: Labels) -> tuple[np.ndarray, np.ndarray]:
    """Documents per bucket, and documents, of three kinds: raw, target, and labelled bad.

    Every task sends its own totals, cut into ranges of buckets; ranges are added up as they
    stream in. What arrives here is three numbers per bucket.
    """
    shared = docs.sparkSession.sparkContext.broadcast(labels)
    form = "chunk int, place binary, counts binary"

    def rows(counts: np.ndarray, chunks: list[int]) -> Iterator[pa.RecordBatch]:
        for number, chunk in enumerate(chunks):
            part = counts[:, number * CHUNK : (number + 1) * CHUNK]
            place = np.flatnonzero(part[0])
            if len(place):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk], pa.int32()), pa.array([place.astype("<u2").tobytes()]),
                     pa.array([part[:, place].astype("<i8").tobytes()])],
                    ["chunk", "place", "counts"])

    def opened(place: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
        return (np.frombuffer(place, "<u2").astype(np.int64),
                np.frombuffer(counts, "<i8").reshape(3, -1))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The place after the buckets counts the documents themselves.
        counts = np.zeros((3, BUCKETS + CHUNK), np.int64)
        for batch in batches:
            for part in W.slices(batch, "text"):
                kinds = shared.value.of(part.column("doc_id"))
                buckets, owner = ngrams(part.column("text"))
                counts[0, :BUCKETS] += np.bincount(buckets, minlength=BUCKETS)
                counts[0, BUCKETS] += len(kinds)
                for row, mark in ((1, kinds == FIT), (2, kinds == BAD)):
                    counts[row, :BUCKETS] += np.bincount(
                        buckets[mark[owner]], minlength=BUCKETS)
                    counts[row, BUCKETS] += mark.sum()
        yield from rows(counts, list(range(BUCKETS // CHUNK + 1)))

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, *packed in zip(*(c.to_pylist() for c in batch.columns)):
                place, counts = opened(*packed)
                sums.setdefault(chunk, np.zeros((3, CHUNK), np.int64))[:, place] += counts
        for chunk, held in sums.items():
            yield from rows(held, [chunk])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    summed = narrow.mapInArrow(partial, form).repartition("chunk").mapInArrow(total, form)
    all_counts = np.zeros((3, BUCKETS + CHUNK), np.int64)
    for row in summed.collect():  # a range may come in several parts
        place, counts = opened(row["place"], row["counts"])
        all_counts[:, row["chunk"] * CHUNK + place] += counts
    return all_counts[:, :BUCKETS], all_counts[:, BUCKETS]


def _log_factorial(values: np.ndarray) -> np.ndarray:
    distinct, place = np.unique(values, return_inverse=True)
    return np.array([math.lgamma(v + 1) for v in distinct.tolist()])[place]


def evidence(counts: np.ndarray, documents: np.ndarray) -> np.ndarray:
    """Probability that target and labelled bad documents hold a bucket at different rates.

    The odds of any split of its labelled documents against the split of all, times the odds
    assumed before; a bucket without labelled documents keeps ``DIFFERENT``.
    """
    _, target, bad = counts
    both = documents[1] + documents[2]
    share = min(max(documents[1] / max(both, 1), 1e-9), 1 - 1e-9)
    odds = (
        _log_factorial(target) + _log_factorial(bad) - _log_factorial(target + bad + 1)
        - target * math.log(share) - bad * math.log1p(-share)
        + math.log(DIFFERENT / (1 - DIFFERENT))
    )
    return 1 / (1 + np.exp(-np.clip(odds, -700, 700)))


def model_ratios(counts: np.ndarray, documents: np.ndarray) -> np.ndarray:
    """Log ratio of the target model to the raw model for each bucket, smoothed by ``PRIOR``."""
    raw, target, _ = counts.astype(np.float64)
    expected = raw * (documents[1] / max(documents[0], 1))
    prior = PRIOR * math.sqrt(max(documents[1], 1))
    return np.log((target + prior) / (expected + prior)).astype(np.float32)


def log_ratios(counts: np.ndarray, documents: np.ndarray) -> np.ndarray:
    """:func:`model_ratios` times the evidence of each bucket."""
    return (evidence(counts, documents) * model_ratios(counts, documents)).astype(np.float32)


@dataclass(frozen=True)
class Weighed:
    """Documents with three more columns, under names that none of theirs had."""

    frame: DataFrame
    ratio: str
    filter: str
    kind: str


def weigh(docs: DataFrame, ratios: np.ndarray, labels: Labels,
          models: np.ndarray | None = None) -> Weighed:
    """All columns of ``docs`` with both weights and the kind of label (0 if none).

    The importance weight adds up the log ratios of ``models`` over the distinct n-grams (0 without
    them); the filter weight those of ``ratios``, scaled for long texts. doc_id is cast to long.
    """
    shared = docs.sparkSession.sparkContext.broadcast((ratios, labels, models))
    names = [unused(docs, name) for name in ("_ratio_weight", "_log_weight", "_label_kind")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[pa.Array]]]:
        table, known, plain = shared.value
        for batch in batches:
            for part in W.slices(batch, "text"):
                buckets, owner = ngrams(part.column("text"))
                values = table[buckets].astype(np.float64)
                sizes = np.bincount(owner, minlength=part.num_rows)
                losses = np.bincount(owner, np.minimum(values, 0), part.num_rows)
                gains = np.bincount(owner, values, part.num_rows) - losses
                sums = (losses * (USUAL / np.maximum(USUAL, sizes))
                        + gains * (GAINS / np.maximum(GAINS, sizes)))
                whole = np.zeros(part.num_rows) if plain is None else np.bincount(
                    owner, plain[buckets].astype(np.float64), part.num_rows)
                kinds = known.of(part.column("m0").cast(pa.int64()))
                yield part, [pa.array(whole), pa.array(sums), pa.array(kinds.astype(np.int8))]

    added = [T.StructField(names[0], T.DoubleType()), T.StructField(names[1], T.DoubleType()),
             T.StructField(names[2], T.ByteType())]
    return Weighed(map_beside(docs, "text", run, added, ["doc_id"]), *names)


def best_cut(weighed: DataFrame) -> float:
    """Weight that parts held-out good from bad documents with the fewest errors of each."""
    bins = weighed.where(F.col("label_kind").isin(GOOD, BAD)).groupBy(
        F.floor(F.greatest(F.lit(-ENDS), F.least(F.lit(ENDS), F.col("log_weight"))) / STEP)
        .alias("bin"), "label_kind",
    ).count().collect()
    edges = sorted({row["bin"] for row in bins})
    counts = {(row["bin"], row["label_kind"]): row["count"] for row in bins}
    totals = [sum(c for (_, k), c in counts.items() if k == kind) for kind in (GOOD, BAD)]
    if not all(totals):
        return -np.inf
    best, cut, lost, caught = 1.0, -np.inf, 0, 0
    for edge, after in zip(edges, [*edges[1:], edges[-1] + 1]):
        lost += counts.get((edge, GOOD), 0)
        caught += counts.get((edge, BAD), 0)
        errors = lost / totals[0] + 1 - caught / totals[1]
        if errors < best:  # the cut lies in the middle of the gap
            best, cut = errors, (edge + 1 + after) / 2 * STEP
    return cut


def _key(weight: Column, temperature: float) -> Column:
    """Weight over temperature plus Gumbel noise hashed from id and text.

    As a non-negative integer of 62 bits, in steps far below the noise, to be counted by digits.
    """
    noise = F.shiftrightunsigned(
        F.xxhash64(F.lit("gumbel"), F.col("doc_id").cast("long"), "text"), 11)
    uniform = (noise.cast("double") + 0.5) / F.lit(2.0**53)
    end = F.lit(2.0**19)
    key = F.greatest(-end, F.least(end, weight / temperature)) - F.log(-F.log(uniform))
    return F.round((key + 2.0**20) * 2.0**40).cast("long")


def kth_largest(keys: DataFrame, key: str, k: int) -> int | None:
    """The k-th largest of non-negative integers, by counting 16 bits at a time."""
    prefix, left = None, k
    for shift in (48, 32, 16, 0):
        part = F.shiftright(key, shift)
        rows = keys if prefix is None else keys.where(F.shiftright(key, shift + 16) == prefix)
        counts = rows.groupBy(part.alias("part")).count().collect()
        for row in sorted(counts, key=lambda r: -r["part"]):
            if left <= row["count"]:
                prefix = row["part"]
                break
            left -= row["count"]
        else:
            return None
    return prefix


@dataclass
class Selection:
    """A fitted selection: weights and keys of the documents, the ratios, and the last keys taken.

    ``least`` is the filter's key of the last document kept, ``drawn`` the importance key of the
    last one sampled.
    """

    weighed: DataFrame
    ratios: np.ndarray
    labels: Labels
    temperature: float
    least: int | None
    drawn: int | None

    def kept(self, key: Column) -> Column:
        return F.lit(False) if self.least is None else key >= self.least

    def sampled(self, key: Column) -> Column:
        return F.lit(False) if self.drawn is None else key >= self.drawn


def select(docs: DataFrame, labels: DataFrame, k: int | None = None,
           temperature: float = TEMPERATURE, limit: int = LABELS) -> Selection:
    """Weigh ``docs`` (doc_id, text), filter them and sample them.

    The filter keeps the ``k`` documents of greatest filter key; by default those at or over the best
    cut. The sample takes as many by Gumbel top-k of the importance weights, at temperature 1.
    """
    known = sample_labels(labels, limit)
    counts, documents = count_ngrams(docs, known)
    ratios = log_ratios(counts, documents)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    made = weigh(narrow, ratios, known, model_ratios(counts, documents))
    weighed = keep(
        made.frame.select(
            "doc_id", F.col(made.filter).alias("log_weight"),
            F.col(made.kind).alias("label_kind"),
            _key(F.col(made.filter), temperature).alias("key"),
            F.col(made.ratio).alias("ratio_weight"),
            _key(F.col(made.ratio), 1.0).alias("ratio_key"),
        ), "weighed",
    )
    if k is None:
        cut = best_cut(weighed)
        k = weighed.where(F.col("log_weight") >= F.lit(float(cut))).count()
    least, drawn = (kth_largest(weighed.select(key), key, k) if k else None
                    for key in ("key", "ratio_key"))
    return Selection(weighed.drop("label_kind"), ratios, known, temperature, least, drawn)


def selected(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that the filter keeps, all columns unchanged, whatever their names.

    Weights are computed again from the texts rather than joined: no text is shuffled.
    """
    made = select(docs, labels, **options)
    weighed = weigh(docs, made.ratios, made.labels)
    key = _key(F.col(weighed.filter), made.temperature)
    return weighed.frame.where(made.kept(key)).drop(weighed.ratio, weighed.filter, weighed.kind)


def op5_quality(spark, sf_dir: str) -> DataFrame:
    """All documents: importance weight and Gumbel key, whether the filter keeps it, and the sample.

    ``log_weight`` and ``key`` are those of the two models; ``sampled`` marks the k greatest keys, k
    being the number of documents that the filter keeps. ``kept`` is the filter's verdict by
    ``filter_weight``.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    made = select(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return made.weighed.select(
        "doc_id", F.col("ratio_weight").alias("log_weight"), F.col("ratio_key").alias("key"),
        made.kept(F.col("key")).alias("kept"), made.sampled(F.col("ratio_key")).alias("sampled"),
        F.col("log_weight").alias("filter_weight"),
    )
