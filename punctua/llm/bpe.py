"""Byte-level BPE encoding and decoding without regular expressions.

Texts become arrays of codepoint classes. Each class, with what follows it, is a transition
function of a small automaton; functions compose associatively, so the state before every
codepoint comes from a scan over composed functions, and with it every piece boundary. Equal
pieces are merged once and kept in a bounded cache. Token byte offsets are kept with the ids.

The boundaries are those of the pattern
``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``.
A null text is an empty one. Columns named like the results are replaced.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from punctua.llm import words as W

# Pieces kept with their ids in each task's process.
CACHE_PIECES = 400_000
# Bytes from which a piece is merged on its own with a heap, and not cached.
LONG_PIECE = 64
NO_RANK = np.int64(2**62)
# Characters handled by one step of the scan are its input divided by this.
SCAN_STEPS = 512

# Classes of a codepoint with what follows it in its document.
LETTER, NUMBER, OTHER, LAST_SPACE, LAST_WHITE, INNER_WHITE, SHORT, LONG = range(8)
# States after a codepoint: in a run, after a space that joins the next run, at a fresh start,
# with one or two letters of a contraction to come, inside white space.
IN_LETTER, IN_NUMBER, IN_OTHER, JOIN, FRESH, ONE_MORE, TWO_MORE, IN_WHITE = range(8)


def _step(state: int, kind: int) -> tuple[int, bool]:
    """Next state, and whether a piece starts at this codepoint."""
    if state == ONE_MORE:
        return FRESH, False
    if state == TWO_MORE:
        return ONE_MORE, False
    if kind == LAST_SPACE:
        return JOIN, True
    if kind == LAST_WHITE:
        return FRESH, True
    if kind == INNER_WHITE:
        return IN_WHITE, state != IN_WHITE
    if kind in (SHORT, LONG) and state not in (IN_OTHER, JOIN):
        return (ONE_MORE if kind == SHORT else TWO_MORE), True
    run = kind if kind in (LETTER, NUMBER) else OTHER
    return run, state not in (run, JOIN)


class Automaton:
    """Transition functions of all classes, closed under composition.

    Classes from 8 on are the same classes at the start of a document: constant functions.
    """

    def __init__(self) -> None:
        pairs = [[_step(s if kind < 8 else FRESH, kind % 8) for s in range(8)]
                 for kind in range(16)]
        self.next = np.array([[p[0] for p in row] for row in pairs], np.uint8)
        self.opens = np.array([[p[1] for p in row] for row in pairs], bool)
        functions = [tuple(row) for row in self.next.tolist()]
        functions.append(tuple(range(8)))
        number = {f: i for i, f in reversed(list(enumerate(functions)))}
        for first in functions:  # grows while it runs, until nothing new appears
            for second in functions[:16]:
                both = tuple(second[s] for s in first)
                if both not in number:
                    number[both] = len(functions)
                    functions.append(both)
        self.identity = 16
        self.apply = np.array(functions, np.uint8)
        self.then = np.array(
            [[number[tuple(g[s] for s in f)] for g in functions] for f in functions], np.uint16
        )

    def boundaries(self, kinds: np.ndarray) -> np.ndarray:
        """Whether a piece starts at each codepoint."""
        size = len(kinds)
        rows = -(-size // SCAN_STEPS) or 1
        grid = np.full(rows * SCAN_STEPS, 255, np.uint8)
        grid[:size] = kinds
        grid = np.ascontiguousarray(grid.reshape(rows, SCAN_STEPS).T)
        real = np.where(grid == 255, self.identity, grid)
        total = np.full(rows, self.identity, np.uint16)
        for line in real:
            total = self.then[total, line]
        shift = 1
        while shift < rows:  # inclusive scan of the rows' functions
            joined = self.then[total[:-shift], total[shift:]]
            total = np.concatenate((total[:shift], joined))
            shift *= 2
        state = np.full(rows, FRESH, np.uint8)
        state[1:] = self.apply[total[:-1], FRESH]
        opens = np.zeros(grid.shape, bool)
        grid[grid == 255] = 0
        for at, line in enumerate(grid):
            opens[at] = self.opens[line, state]
            state = self.next[line, state]
        return opens.T.reshape(-1)[:size]


@lru_cache(maxsize=1)
def automaton() -> Automaton:
    return Automaton()


@lru_cache(maxsize=1)
def codepoint_kinds() -> np.ndarray:
    """LETTER, NUMBER, OTHER or LAST_WHITE for every codepoint."""
    kinds = np.full(0x110000, OTHER, np.uint8)
    low = "".join(map(chr, range(0xD800)))
    high = "".join(map(chr, range(0xE000, 0x110000)))
    for text, shift in ((low, 0), (high, 0xE000)):
        for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER),
                              (r"\p{White_Space}+", LAST_WHITE)):
            for run in regex.finditer(pattern, text):
                kinds[run.start() + shift : run.end() + shift] = kind
    return kinds


def classes(points: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Automaton class of each codepoint; ``heads`` are the first of each document."""
    kinds = codepoint_kinds()[points]
    size = len(points)
    first = np.zeros(size + 3, bool)
    first[heads] = True
    first[size:] = True
    white = kinds == LAST_WHITE
    ahead = np.zeros(size, bool)
    ahead[:-1] = ~white[1:]
    ahead &= ~first[1 : size + 1]
    out = kinds.copy()
    out[white & ~ahead] = INNER_WHITE
    out[white & ahead & (points == 32)] = LAST_SPACE
    marks = np.flatnonzero(points == 39)
    padded = np.concatenate((points, np.zeros(2, points.dtype)))
    one, two = padded[marks + 1], padded[marks + 2]
    near, far = ~first[marks + 1], ~first[marks + 2]
    out[marks[near & np.isin(one, [ord(c) for c in "stmd"])]] = SHORT
    pairs = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e"))
    pairs |= (one == ord("l")) & (two == ord("l"))
    out[marks[near & far & pairs]] = LONG
    out[heads] += 8
    return out


def piece_starts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Byte positions where pieces start in the concatenated UTF-8 texts."""
    if not len(data):
        return np.zeros(0, np.int64)
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    filled = bounds[:-1][bounds[1:] > bounds[:-1]]
    heads = np.searchsorted(lead, filled)
    return lead[automaton().boundaries(classes(points, heads))]


class Ranks:
    """A vocabulary of merge ranks, with a bounded cache of merged pieces."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            parts = [line.split() for line in lines if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in parts}
        size = max(self.ranks.values()) + 1
        tokens = [b""] * size
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.heads = np.cumsum(self.lengths) - self.lengths
        self.single = {t: int(r).to_bytes(4, "little") for t, r in self.ranks.items()}
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        splits = sorted(
            ((self.ranks[a] << 32) | self.ranks[b], rank)
            for token, rank in self.ranks.items() for at in range(1, len(token))
            if (a := token[:at]) in self.ranks and (b := token[at:]) in self.ranks
        )
        self.pairs, self.pair_ranks = np.array(splits, np.int64).reshape(-1, 2).T.copy()
        self.fresh: dict[bytes, bytes] = {}
        self.aged: dict[bytes, bytes] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Merge the adjacent pair of least rank, the leftmost first, until none is left."""
        ranks = self.ranks
        if piece in ranks:
            return [ranks[piece]]
        size = len(piece)
        stop = list(range(1, size + 1))  # end of the part that starts here
        back = list(range(-1, size - 1))  # start of the part before
        heap = [
            (rank, i, i + 2) for i in range(size - 1)
            if (rank := ranks.get(piece[i : i + 2])) is not None
        ]
        heapq.heapify(heap)
        while heap:
            _, left, end = heapq.heappop(heap)
            middle = stop[left]
            if middle < 0 or middle >= size or stop[middle] != end:
                continue  # one of the two parts has changed since
            stop[left], stop[middle] = end, -1
            if end < size:
                back[end] = left
                if (rank := ranks.get(piece[left : stop[end]])) is not None:
                    heapq.heappush(heap, (rank, left, stop[end]))
            if (before := back[left]) >= 0:
                if (rank := ranks.get(piece[before:end])) is not None:
                    heapq.heappush(heap, (rank, before, end))
        out, at = [], 0
        while at < size:
            out.append(ranks[piece[at : stop[at]]])
            at = stop[at]
        return out

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of tokens joined, ``NO_RANK`` where they do not merge."""
        keys = (left << 32) | right
        place = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
        return np.where(self.pairs[place] == keys, self.pair_ranks[place], NO_RANK)

    def merge_all(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of many short pieces, merged side by side: one pair of each per round."""
        data = np.frombuffer(b"".join(pieces), np.uint8)
        sizes = np.array(list(map(len, pieces)), np.int64)
        token, owner = self.byte_ids[data], np.repeat(np.arange(len(pieces)), sizes)
        rank = np.full(len(token), NO_RANK)
        inner = np.flatnonzero(owner[:-1] == owner[1:])
        rank[inner] = self.rank_of(token[inner], token[inner + 1])
        done_tokens, done_owners = [], []
        while len(token):
            heads = np.flatnonzero(np.diff(owner, prepend=-1))
            least = np.minimum.reduceat(rank, heads)
            sizes = np.diff(np.append(heads, len(token)))
            open_ = np.repeat(least < NO_RANK, sizes)
            if not open_.all():
                done_tokens.append(token[~open_])
                done_owners.append(owner[~open_])
                token, owner, rank = token[open_], owner[open_], rank[open_]
                sizes, least = sizes[least < NO_RANK], least[least < NO_RANK]
                if not len(token):
                    break
            at = np.flatnonzero(rank == np.repeat(least, sizes))
            at = at[np.diff(owner[at], prepend=-1) != 0]  # the leftmost of each piece
            token[at] = least
            alive = np.ones(len(token), bool)
            alive[at + 1] = False
            token, owner, rank = token[alive], owner[alive], rank[alive]
            at = at - np.arange(len(at))
            rank[at] = NO_RANK
            right = at[at + 1 < len(token)]
            right = right[owner[right] == owner[right + 1]]
            rank[right] = self.rank_of(token[right], token[right + 1])
            left = at[at > 0] - 1
            left = left[owner[left] == owner[left + 1]]
            rank[left] = self.rank_of(token[left], token[left + 1])
        owner = np.concatenate(done_owners)
        order = np.argsort(owner, kind="stable")
        packed = np.concatenate(done_tokens)[order].astype("<u4").tobytes()
        stops = (np.cumsum(np.bincount(owner, minlength=len(pieces))) * 4).tolist()
        return [packed[a:b] for a, b in zip([0, *stops], stops)]

    def packed(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of distinct pieces as bytes, from the cache if they are there."""
        found = list(map(self.fresh.get, pieces))
        missing = [i for i, ids in enumerate(found) if ids is None]
        short = []
        for i in missing:
            piece = pieces[i]
            found[i] = self.aged.get(piece) or self.single.get(piece)
            if found[i] is None:
                if len(piece) > LONG_PIECE:
                    found[i] = np.array(self.merge(piece), "<u4").tobytes()
                else:
                    short.append(i)
        if short:
            for i, ids in zip(short, self.merge_all([pieces[i] for i in short])):
                found[i] = ids
        for i in missing:
            if len(self.fresh) >= CACHE_PIECES // 2:
                self.aged, self.fresh = self.fresh, {}
            if len(pieces[i]) <= LONG_PIECE:
                self.fresh[pieces[i]] = found[i]
        return found

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a string column, and the bounds of each row in them."""
        data, bounds = W.text_bytes(column)
        starts = piece_starts(data, bounds)
        ends = np.append(starts, len(data)).astype(np.int32)
        pieces = pa.BinaryArray.from_buffers(
            pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(data)]
        ).dictionary_encode()
        packed = self.packed(pieces.dictionary.to_pylist())
        known = np.frombuffer(b"".join(packed), "<u4")
        counts = np.array(list(map(len, packed)), np.int64) // 4
        index = pieces.indices.to_numpy()
        heads = np.cumsum(counts) - counts
        sizes = counts[index]
        stops = np.cumsum(sizes)
        ids = known[np.repeat(heads[index] - (stops - sizes), sizes) + np.arange(sizes.sum())]
        upto = np.concatenate(([0], stops))
        return ids, upto[np.searchsorted(starts, bounds)]

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all ids, and the bounds in them at the given places of ``ids``."""
        sizes = self.lengths[ids]
        stops = np.cumsum(sizes)
        total = int(stops[-1]) if len(stops) else 0
        data = self.bytes[np.repeat(self.heads[ids] - (stops - sizes), sizes) + np.arange(total)]
        return data, np.concatenate(([0], stops))[bounds]


@lru_cache(maxsize=2)
def ranks(path: str) -> Ranks:
    return Ranks(path)


def _with(batch: pa.RecordBatch, names: list[str], arrays: list[pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [*batch.columns, *arrays], [*batch.schema.names, *names]
    )


def _schema(docs: DataFrame, added: str) -> T.StructType:
    return T.StructType([*docs.schema.fields, *T.StructType.fromDDL(added).fields])


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Adds ``ids`` (array of int) and ``offsets``, the byte where each token starts."""
    docs = docs.drop("ids", "offsets")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = ranks(path)
        for batch in batches:
            for part in W.slices(batch, text):
                ids, bounds = own.encode(part.column(text))
                sizes = own.lengths[ids]
                ends = np.concatenate(([0], np.cumsum(sizes)))
                offsets = ends[:-1] - np.repeat(ends[bounds[:-1]], np.diff(bounds))
                place = pa.array(bounds.astype(np.int32))
                yield _with(part, ["ids", "offsets"], [
                    pa.ListArray.from_arrays(place, pa.array(x.astype(np.int32)))
                    for x in (ids, offsets)
                ])

    return docs.mapInArrow(run, _schema(docs, "ids array<int>, offsets array<int>"))


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Adds ``decoded``: the bytes of ``ids``; null ids give null."""
    encoded = encoded.drop("decoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = ranks(path)
        for batch in batches:
            lists = batch.column("ids")
            ids = lists.flatten().to_numpy(zero_copy_only=False)
            sizes = lists.value_lengths().fill_null(0).to_numpy()
            data, bounds = own.decode(ids, np.concatenate(([0], np.cumsum(sizes))))
            whole, absent = data.tobytes(), lists.is_null().to_pylist()
            out = [None if gone else whole[a:b]
                   for a, b, gone in zip(bounds, bounds[1:], absent)]
            yield _with(batch, ["decoded"], [pa.array(out, pa.binary())])

    return encoded.mapInArrow(run, _schema(encoded, "decoded binary"))


def round_trip(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Encode and decode in one pass: adds n_tokens, ids_sha256 and decoded_sha256.

    The digests are those of the ids as little-endian 32-bit integers and of the decoded bytes.
    """
    docs = docs.drop("n_tokens", "ids_sha256", "decoded_sha256")

    def digests(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
        view = memoryview(np.ascontiguousarray(data)).cast("B") if len(data) else b""
        return pa.array(
            [hashlib.sha256(view[a:b]).hexdigest() for a, b in zip(bounds, bounds[1:])],
            pa.string(),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = ranks(path)
        for batch in batches:
            for part in W.slices(batch, text):
                ids, bounds = own.encode(part.column(text))
                decoded = own.decode(ids, bounds)
                yield _with(part, ["n_tokens", "ids_sha256", "decoded_sha256"], [
                    pa.array(np.diff(bounds).astype(np.int64)),
                    digests(ids.astype("<u4"), bounds * 4), digests(*decoded),
                ])

    return docs.mapInArrow(
        run, _schema(docs, "n_tokens long, ids_sha256 string, decoded_sha256 string")
    )


def encode_checked(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Encode, and decode again in the same pass: adds ids, n_tokens and restored.

    ``restored`` tells whether the decoded bytes are those of the text.
    """
    docs = docs.drop("ids", "n_tokens", "restored")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = ranks(path)
        for batch in batches:
            for part in W.slices(batch, text):
                ids, bounds = own.encode(part.column(text))
                data, places = own.decode(ids, bounds)
                source, wanted = W.text_bytes(part.column(text))
                whole, given = data.tobytes(), source.tobytes()
                same = [whole[a:b] == given[c:d] for a, b, c, d in
                        zip(places, places[1:], wanted, wanted[1:])]
                yield _with(part, ["ids", "n_tokens", "restored"], [
                    pa.ListArray.from_arrays(
                        pa.array(bounds.astype(np.int32)), pa.array(ids.astype(np.int32))),
                    pa.array(np.diff(bounds).astype(np.int64)), pa.array(same),
                ])

    return docs.mapInArrow(run, _schema(docs, "ids array<int>, n_tokens long, restored boolean"))


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def op2_byte_bpe(spark, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return round_trip(docs, default_ranks()).drop("text")
