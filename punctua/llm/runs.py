"""Periodic runs of words, found on an enhanced suffix array.

A run is a stretch of words with smallest period q that no neighbouring word extends. The last
square of a run (two copies of q words, at its end) is a branching tandem repeat: the
suffixes p and p + q share exactly q words. In a suffix array these are told apart by one LCP
boundary of depth q, so the search goes over the boundaries: each parts an LCP interval into two
halves, every suffix i of the smaller half asks the inverse array whether i + q or i - q lies in the
other half, and each hit is one branching square. Rotating it to the left as long as the
words agree gives the run; squares of the same end inside a run already found are its multiples.

All documents of a slice share one suffix array, sorted by prefix doubling: the first key mixes a
word's hash with its document, so no two documents ever share a prefix. There are no tree
nodes, only arrays: ranks, suffixes, LCP, and the nearest smaller boundaries on both sides.

Only runs of ``length >= max(least, exponent * q)`` are wanted, so an interval of fewer than
``exponent`` suffixes, or deeper than the document's words over ``exponent``, is not asked.

Words are maximal runs without white space, compared by 64-bit hashes, letter case kept. A null text
has no words and no runs. All columns of the input stay, those named like a result column are
replaced; every row is worked on alone, so repeated or null ids do not matter. A document is
never cut: one of n words takes about 100 + 4 log2(n) bytes a word in its task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctua.llm import words as W
from punctua.llm.shared import map_beside

LEAST, EXPONENT = 6, 4
# Suffixes asked at once.
ASKED = 1 << 20
# Words compared at once when a square is first rotated.
STEP = 64


@dataclass
class Suffixes:
    """Suffix array, its inverse, and the words that neighbours share (LCP, 0 first)."""

    order: np.ndarray
    rank: np.ndarray
    lcp: np.ndarray


def suffix_array(words: np.ndarray, bounds: np.ndarray) -> Suffixes:
    """Of all documents laid end to end; ``words`` differ between documents.

    Ranks after each doubling are kept while some suffixes are still tied: neighbours that part
    in round k share 2**(k-1) words and less than 2**k, and the rest is read off the ranks
    of earlier rounds from the longest step down.
    """
    n = len(words)
    order = np.argsort(words).astype(np.int32)
    ranked = words[order]
    heads = np.ones(n, bool)
    heads[1:] = ranked[1:] != ranked[:-1]
    # The round in which a suffix parted from its neighbour before.
    parted = np.where(heads, 0, -1).astype(np.int16)
    rank = np.empty(n + 1, np.int32)
    places = np.maximum.accumulate(np.where(heads, np.arange(n, dtype=np.int32), 0))
    rank[order] = places
    rank[n] = -1
    ends = np.repeat(bounds[1:], np.diff(bounds)).astype(np.int32)
    levels, step, number = [], 1, 0
    # Places of the array whose suffix is still tied with a neighbour.
    open_ = np.flatnonzero(_tied(heads))
    while len(open_):
        levels.append(rank.copy())
        number += 1
        who = order[open_]
        after = who + step
        second = np.where(after < ends[who], rank[np.minimum(after, n)] + 1, 0)
        key = (rank[who].astype(np.int64) << 32) | second
        by = np.argsort(key)
        who, key = who[by], key[by]
        order[open_] = who
        fresh = np.ones(len(key), bool)
        fresh[1:] = key[1:] != key[:-1]
        new = open_[fresh]
        parted[new[parted[new] < 0]] = number
        rank[who] = np.maximum.accumulate(np.where(fresh, open_, 0))
        open_ = open_[_tied(fresh)]
        step *= 2
    lcp = np.zeros(n, np.int32)
    for number in range(1, len(levels) + 1):
        at = np.flatnonzero(parted == number)
        left, right = order[at - 1], order[at]
        shared = np.full(len(at), 1 << (number - 1), np.int32)
        for level in range(number - 2, -1, -1):
            ranks = levels[level]
            same = (ranks[np.minimum(left + shared, n)] == ranks[np.minimum(right + shared, n)])
            shared += same.astype(np.int32) << level
        lcp[at] = shared
    return Suffixes(order, rank[:n], lcp)


def _tied(heads: np.ndarray) -> np.ndarray:
    """Places whose group has more than one member, ``heads`` marking the first of each."""
    last = np.ones(len(heads), bool)
    last[:-1] = heads[1:]
    return ~(heads & last)


def nearest_smaller(values: np.ndarray, at: np.ndarray, equal: bool, right: bool) -> np.ndarray:
    """For each place of ``at`` the nearest place on one side with a smaller value.

    With ``equal`` an equal value counts as well. Without one: -1, or the length on the right.
    A tree of minima is climbed until a sibling on that side holds such a value, and
    descended again; all places move together.
    """
    if right:
        turned = nearest_smaller(values[::-1], len(values) - 1 - at, equal, False)
        return len(values) - 1 - turned
    width = 1 << max(1, int(len(values) - 1).bit_length())
    floor = np.full(width, np.iinfo(np.int32).max, np.int32)
    floor[: len(values)] = values
    tree = [floor]
    while len(tree[-1]) > 1:
        tree.append(np.minimum(tree[-1][::2], tree[-1][1::2]))
    limit = values[at].astype(np.int64) + (1 if equal else 0)
    found = np.full(len(at), -1, np.int64)
    node, moving = at.astype(np.int64), np.arange(len(at))
    turns: list[tuple[np.ndarray, np.ndarray]] = []
    for level in tree[:-1]:
        odd = node & 1 == 1
        here = odd & (level[node - 1] < limit[moving])
        turns.append((moving[here], node[here] - 1))
        node, moving = node[~here] >> 1, moving[~here]
        if not len(moving):
            break
    who, node = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for level in range(len(turns) - 1, -1, -1):
        who = np.concatenate((who, turns[level][0]))
        node = np.concatenate((node, turns[level][1]))
        if level:
            below = tree[level - 1]
            node = 2 * node + (below[2 * node + 1] < limit[who])
    found[who] = node
    return found


def branching_squares(made: Suffixes, bounds: np.ndarray,
                      exponent: int = EXPONENT) -> tuple[np.ndarray, np.ndarray]:
    """Starts and periods of the squares whose two copies are not followed alike."""
    order, rank, lcp = made.order, made.rank, made.lcp
    n = len(order)
    longest = np.repeat(np.diff(bounds) // exponent, np.diff(bounds)).astype(np.int32)
    at = np.flatnonzero((lcp > 0) & (lcp <= longest[order]))
    # Boundary k parts [low, k) from [k, high); ties are parted from the left.
    low = nearest_smaller(lcp, at, False, False)
    high = nearest_smaller(lcp, at, True, True)
    # An interval's width is bounded by places of smaller LCP on both sides.
    whole = nearest_smaller(lcp, at, False, True)
    wide = whole - low >= exponent
    at, low, high = at[wide], low[wide], high[wide]
    depth = lcp[at].astype(np.int64)
    left = at - low <= high - at
    begin, size = np.where(left, low, at), np.where(left, at - low, high - at)
    other, stop = np.where(left, at, low), np.where(left, high, at)
    starts, periods = [], []
    cuts = np.concatenate(([0], np.cumsum(size)))
    first = 0
    while first < len(at):
        last = max(first + 1, int(np.searchsorted(cuts, cuts[first] + ASKED, "right")) - 1)
        sizes = size[first:last]
        inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        suffix = order[np.repeat(begin[first:last], sizes) + inside].astype(np.int64)
        q = np.repeat(depth[first:last], sizes)
        lo, hi = np.repeat(other[first:last], sizes), np.repeat(stop[first:last], sizes)
        for sign in (1, -1):
            to = suffix + sign * q
            real = np.flatnonzero((to >= 0) & (to < n))
            met = rank[to[real]]
            hit = real[(met >= lo[real]) & (met < hi[real])]
            starts.append(np.minimum(suffix[hit], to[hit]))
            periods.append(q[hit])
        first = last
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(starts), np.concatenate(periods)


def _rotated(words: np.ndarray, start: int, period: int, first: int) -> int:
    """Least start to which the square at ``start`` can be rotated, not before ``first``."""
    step = STEP
    while start > first:
        size = min(step, start - first)
        differ = np.flatnonzero(
            words[start - size : start] != words[start - size + period : start + period])
        if len(differ):
            return start - size + int(differ[-1]) + 1
        start, step = start - size, 2 * step
    return start


@dataclass
class Runs:
    """Runs in word numbers of the slice, by start and period, and the bounds of each document."""

    starts: np.ndarray
    stops: np.ndarray
    periods: np.ndarray
    bounds: np.ndarray


def find_runs(words: np.ndarray, bounds: np.ndarray, least: int = LEAST,
              exponent: int = EXPONENT) -> Runs:
    """Runs of length ``max(least, exponent * period)`` or more, ``exponent`` at least 2."""
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    own = W.mix(words ^ W.mix(owner.astype(np.uint64) + np.uint64(1)))
    starts, periods = branching_squares(suffix_array(own, bounds), bounds, exponent)
    first = bounds[owner[starts]] if len(starts) else starts
    # Words that a long enough run must have before its last square.
    need = np.maximum(exponent * periods, least) - 2 * periods
    far = starts - need
    able = far >= first
    starts, periods, first, far = starts[able], periods[able], first[able], far[able]
    able = own[far] == own[far + periods]
    starts, periods, first = starts[able], periods[able], first[able]
    order = np.lexsort((periods, starts + 2 * periods))
    starts, periods, first = starts[order], periods[order], first[order]
    found = []
    while len(starts):
        # The shortest period of each end; longer ones inside its run are its multiples.
        ends = starts + 2 * periods
        fresh = np.ones(len(ends), bool)
        fresh[1:] = ends[1:] != ends[:-1]
        group = np.cumsum(fresh) - 1
        begun = np.array([_rotated(own, int(s), int(q), int(f)) for s, q, f in zip(
            starts[fresh], periods[fresh], first[fresh])], np.int64)
        found.append(np.stack((begun, ends[fresh], periods[fresh])))
        left = ~fresh & (starts < begun[group])
        starts, periods, first = starts[left], periods[left], first[left]
    begun, ends, periods = np.concatenate(found, 1) if found else np.zeros((3, 0), np.int64)
    long = ends - begun >= np.maximum(exponent * periods, least)
    begun, ends, periods = begun[long], ends[long], periods[long]
    order = np.lexsort((periods, begun))
    begun, ends, periods = begun[order], ends[order], periods[order]
    return Runs(begun, ends, periods, np.searchsorted(begun, bounds))


def collapsed(count: int, runs: Runs) -> np.ndarray:
    """Which of ``count`` words stay: those that no run holds after its first period."""
    change = np.zeros(count + 1, np.int64)
    np.add.at(change, runs.starts + runs.periods, 1)
    np.add.at(change, runs.stops, -1)
    return np.cumsum(change[:-1]) == 0


def _joined(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, bounds: np.ndarray,
            kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the kept words with a space after each, and the bounds of each document in them."""
    sizes = (stops - starts)[kept] + 1
    after = np.concatenate(([0], np.cumsum(sizes)))
    inside = np.zeros(len(data) + 1, np.int8)
    inside[starts[kept]] = 1
    inside[stops[kept]] -= 1
    # A word's closing place, one past its last byte, becomes the space; words never touch there.
    mask = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    out = np.full(after[-1], 32, np.uint8)
    hole = np.ones(after[-1], bool)
    hole[after[1:] - 1] = False
    out[hole] = data[mask]
    places = np.concatenate(([0], np.cumsum(kept)))
    return out, after[places[bounds]]


RUN = [T.StructField(name, T.LongType()) for name in ("start", "length", "period")]


def _find(text_out: bool, least: int, exponent: int):
    """Task function of :func:`periodic_runs`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[pa.Array]]]:
        for batch in batches:
            for part in W.slices(batch, "text"):
                data, at = W.text_bytes(part.column("text"))
                starts, stops = W.word_spans(data, at, W.NOT_SPACE)
                bounds = np.searchsorted(starts, at)
                found = find_runs(W.hash_spans(data, starts, stops), bounds, least, exponent)
                out, places = _joined(data, starts, stops, bounds, collapsed(len(starts), found))
                # Without the space after the last word.
                ends = np.maximum(places[1:] - 1, places[:-1])
                heads = np.repeat(bounds[:-1], np.diff(found.bounds))
                counts = np.diff(bounds), np.diff(found.bounds)
                runs = pa.ListArray.from_arrays(
                    pa.array(found.bounds.astype(np.int32)),
                    pa.StructArray.from_arrays(
                        [pa.array(found.starts - heads), pa.array(found.stops - found.starts),
                         pa.array(found.periods)], [f.name for f in RUN]))
                view = memoryview(out)
                pieces = [bytes(view[a:b]) for a, b in zip(places, ends)]
                result = pa.array(pieces, pa.binary()).cast(pa.string()) if text_out else pa.array(
                    [hashlib.sha256(piece).hexdigest() for piece in pieces], pa.string())
                yield part, [pa.array(counts[0]), runs, result]

    return run


def periodic_runs(docs: DataFrame, text: str = "text", digest: bool = False, least: int = LEAST,
                  exponent: int = EXPONENT) -> DataFrame:
    """All columns of ``docs`` with ``n_words``, ``runs`` and ``collapsed``. No shuffle.

    ``runs`` lists (start, length, period) in words, by start, then period. ``collapsed`` is the text
    of the words that no run holds after its first period, joined by one space, or with
    ``digest`` the SHA-256 of it in hexadecimal.
    """
    added = [
        T.StructField("n_words", T.LongType()),
        T.StructField("runs", T.ArrayType(T.StructType(RUN))),
        T.StructField("collapsed", T.StringType()),
    ]
    return map_beside(docs, text, _find(not digest, least, exponent), added)


def planted(doc_id: Column, text: Column) -> Column:
    """``text``, for a tenth of the ids (by CRC-32) with its words repeated from some word on.

    With h the CRC-32 of the decimal id and g = floor(h / 10), texts of h % 10 = 0 and n > 0 words keep
    the first a = g % n words and repeat the next 1 + floor((n - a) / (3 + g % 8)) up to n words. A
    null id repeats nothing.
    """
    words = F.split(F.trim(text, F.lit(" \t\n\x0b\x0c\r")), r"[\x20\x09-\x0D]+")
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    n = F.size(words)
    a = (g % n).cast("int")
    times = (g % 8 + 3).cast("int")
    p = (1 + F.floor((n - a) / times)).cast("int")
    cycle = F.flatten(F.array_repeat(F.slice(words, a + 1, p), times))
    repeated = F.slice(F.concat(F.slice(words, F.lit(1), a), cycle), F.lit(1), n)
    hit = (h % 10 == 0) & F.rlike(text, F.lit(r"[^\x20\x09-\x0D]"))
    return F.when(hit, F.array_join(repeated, " ")).otherwise(text)


def op13_periodic_runs(spark, sf_dir: str) -> DataFrame:
    """Runs of all documents, a tenth of which get runs planted, and their best one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id", planted(F.col("doc_id"), F.col("text")).alias("text"))
    found = periodic_runs(docs, digest=True)
    lines = F.transform("runs", lambda r: F.concat_ws(
        ",", r["start"], r["length"], r["period"]))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n")))
    # Greater exponent first, compared without rounding; runs come by start and period.
    best = F.aggregate("runs", F.element_at("runs", 1), lambda top, r: F.when(
        r["length"] * top["period"] > top["length"] * r["period"], r).otherwise(top))
    return (
        found.withColumn("best", F.when(F.size("runs") > 0, best))
        .select(
            "doc_id", F.size("runs").cast("long").alias("n_runs"),
            F.col("best.start").alias("start"), F.col("best.length").alias("length"),
            F.col("best.period").alias("period"),
            F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long")
            .alias("exponent_milli"),
            F.sha2(F.coalesce(listed, F.lit("")).cast("binary"), 256).alias("runs_sha256"),
            F.col("collapsed").alias("collapsed_sha256"),
        )
    )
