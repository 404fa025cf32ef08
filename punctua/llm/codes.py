"""Token ids in directly addressable codes.

An id is cut into chunks of ``CHUNK_BITS`` bits, lowest first. Level k holds the k-th chunk of
every id that has one; a bitmap per level tells which ids go on, and a rank directory (ones before
every ``RANK_BITS`` bits) says where in the next level an id goes on. Any token is read
from one chunk per level, without decoding its neighbours.

The file format is a Parquet table with one row per segment, a run of whole documents in
ascending doc_id order: its documents and their places, and per level chunks, bitmap and ranks.
Segments hold about ``SEGMENT_TOKENS`` tokens, or one longer document. A null doc_id comes first;
documents of one id stand next to each other, ordered by a hash of
their text. A null text is an empty one.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from punctua.llm import words as W
from punctua.operators.settle import fresh_path, settle

CHUNK_BITS = 8
RANK_BITS = 512
SEGMENT_TOKENS = 65_536
END = 1
# Bytes of text that one task codes.
PART_BYTES = 24 << 20

SEGMENT = (
    "part int, segment int, offset long, ids array<long>, places array<int>, n_tokens long, "
    "chunks array<binary>, bitmaps array<binary>, ranks array<binary>"
)
_ONES = np.array([bin(b).count("1") for b in range(256)], np.uint8)


@dataclass
class Codes:
    """Chunks, continuation bitmap and rank directory of each level."""

    chunks: list[np.ndarray]
    bitmaps: list[np.ndarray]
    ranks: list[np.ndarray]

    @classmethod
    def of(cls, ids: np.ndarray) -> Codes:
        out, rest = cls([], [], []), ids.astype(np.uint32)
        while True:
            out.chunks.append((rest & ((1 << CHUNK_BITS) - 1)).astype(np.uint8))
            rest = rest >> CHUNK_BITS
            goes_on = rest > 0
            bits = np.packbits(goes_on, bitorder="little")
            per_block = np.add.reduceat(
                _ONES[bits].astype(np.uint32), np.arange(0, len(bits), RANK_BITS // 8)
            ) if len(bits) else np.zeros(0, np.uint32)
            out.bitmaps.append(bits)
            out.ranks.append((np.cumsum(per_block) - per_block).astype(np.uint32))
            rest = rest[goes_on]
            if not len(rest):
                return out

    def get(self, places: np.ndarray) -> np.ndarray:
        """Ids at any places; each is read on its own, whatever the length of the codes."""
        out, active = np.zeros(len(places), np.uint32), np.arange(len(places))
        places = places.astype(np.int64)
        inside = np.arange(RANK_BITS // 8)
        for level, chunks in enumerate(self.chunks):
            out[active] |= chunks[places].astype(np.uint32) << np.uint32(CHUNK_BITS * level)
            bits = self.bitmaps[level]
            on = (bits[places >> 3] >> (places & 7).astype(np.uint8)) & 1 > 0
            active, places = active[on], places[on]
            if not len(active):
                break
            # Ones before a place: the directory, whole bytes of its block, and its own byte.
            block, byte = places // RANK_BITS, places >> 3
            head = block * (RANK_BITS // 8)
            whole = bits[np.minimum(head[:, None] + inside, len(bits) - 1)]
            ones = np.where(inside < (byte - head)[:, None], _ONES[whole], 0).sum(1, dtype=np.int64)
            low = bits[byte] & ((1 << (places & 7)) - 1).astype(np.uint8)
            places = self.ranks[level][block] + ones + _ONES[low]
        return out

    def all(self) -> np.ndarray:
        """All ids in order, level by level."""
        out = self.chunks[-1].astype(np.uint32)
        for chunks, bits in zip(self.chunks[-2::-1], self.bitmaps[-2::-1]):
            on = np.unpackbits(bits, count=len(chunks), bitorder="little").view(bool)
            ids = chunks.astype(np.uint32)
            ids[on] |= out << np.uint32(CHUNK_BITS)
            out = ids
        return out


@lru_cache(maxsize=2)
def tokenizer(path: str):
    # Tasks already use all cores; threads of the library would only contend.
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def _letter_model(path: str):
    """The library's BPE model alone, without its own cache of words: ours is larger."""
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path).model
    model._resize_cache(0)
    return model


# Lower-case letters of ASCII and U+00DF to U+00FF: normal form and lower-casing leave them alone, and
# the tokenizer cuts nowhere between them, so only the merges of its model are left to do.
_LETTERS = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+").fullmatch


def _byte_letters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary.

    Printable characters of Latin-1 stand for their own byte, U+0100 and following for the others in
    order.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in shown]
    return {byte: chr(0x100 + i) for i, byte in enumerate(others)}


_BYTE_LETTERS = _byte_letters()


def coded_words(path: str, words: list[str]) -> list[list[int]]:
    """Ids of each word; words of letters alone go straight to the library's model."""
    model, coded, others = _letter_model(path), [], []
    for place, word in enumerate(words):
        if _LETTERS(word):
            if not word.isascii():
                word = word.encode().decode("latin-1").translate(_BYTE_LETTERS)
            coded.append([token.id for token in model.tokenize(word)])
        else:
            coded.append(None)
            others.append(place)
    whole = tokenizer(path).encode_batch_fast([words[i] for i in others], add_special_tokens=False)
    for place, code in zip(others, whole):
        coded[place] = code.ids
    return coded


class WordCache:
    """Ids of a text from the ids of its words, each tokenized once while it is kept.

    The tokenizer cuts at white space, and between letters and marks, and looks at nothing across
    these cuts, so a text's ids are those of its pieces in order.
    """

    LIMIT = 800_000

    def __init__(self, path: str):
        self.path = path
        self.fresh: dict[str, bytes] = {}
        self.aged: dict[str, bytes] = {}

    def packed(self, words: list[str]) -> list[bytes]:
        found = list(map(self.fresh.get, words))
        keys = [word for word, ids in zip(words, found) if ids is None]
        known = list(map(self.aged.get, keys))
        unknown = [key for key, ids in zip(keys, known) if ids is None]
        coded = coded_words(self.path, unknown)
        packed = np.fromiter(chain.from_iterable(coded), "<u4").tobytes()
        stops = [4 * n for n in accumulate(map(len, coded))]
        fresh = iter([packed[a:b] for a, b in zip([0, *stops], stops)])
        known = [next(fresh) if ids is None else ids for ids in known]
        if len(self.fresh) + len(keys) > self.LIMIT // 2:
            self.aged, self.fresh = self.fresh, {}
        self.fresh.update((k, v) for k, v in zip(keys, known) if len(k) <= 64)
        missing = iter(known)
        return [next(missing) if ids is None else ids for ids in found]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and the bounds of each text in them."""
        data, bounds = W.text_bytes(column)
        starts, ends = _pieces(data, bounds)
        sizes = ends - starts
        spans = data[W.NOT_SPACE[data]]
        # The vocabulary has no case. ASCII words are lowered here to be met again, unless they
        # may hold a special token; elsewhere lowering before composition could differ.
        stops = np.cumsum(sizes)
        odd = np.concatenate(([0], np.cumsum((spans >= 128) | (spans == 60))))
        plain = odd[stops] == odd[stops - sizes]
        spans = pa.array(np.where(np.repeat(plain, sizes), W.LOWER[spans], spans))
        offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
        words = pa.StringArray.from_buffers(
            len(sizes), pa.py_buffer(offsets), spans.buffers()[1]
        ).dictionary_encode()
        # No word holds a line feed, so the different ones become strings in one step.
        different = words.dictionary
        listed = pa.ListArray.from_arrays(pa.array([0, len(different)], pa.int32()), different)
        packed = self.packed(
            pc.binary_join(listed, "\n")[0].as_py().split("\n") if len(different) else [])
        known = np.frombuffer(b"".join(packed), "<u4")
        counts = np.fromiter(map(len, packed), np.int32, len(packed)) // 4
        index = words.indices.to_numpy()
        heads, inner = (np.cumsum(counts, dtype=np.int32) - counts)[index], counts[index]
        stops = np.cumsum(inner, dtype=np.int32)
        total = stops[-1] if len(stops) else 0
        ids = known[np.repeat(heads - (stops - inner), inner) + np.arange(total, dtype=np.int32)]
        return ids, np.concatenate(([0], stops))[np.searchsorted(starts, bounds)]


_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
# Marks that compose with nothing and are part of no special token.
_MARK = np.zeros(256, bool)
_MARK[np.frombuffer(b",.!;:?#*$%&()\"", np.uint8)] = True


def _pieces(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans between white space, cut where a letter (ASCII, or U+00C0 to U+00FF) meets a mark.

    The tokenizer cuts there too, whatever surrounds them.
    """
    starts, stops = W.word_spans(data, bounds, W.NOT_SPACE)
    high = np.zeros(len(data), bool)  # the second byte of such a letter
    high[1:] = (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    ends = _LETTER[data] | high
    begins = _LETTER[data]
    begins[:-1] |= high[1:]
    marks = _MARK[data]
    cuts = np.zeros(len(data) + 1, bool)
    cuts[1:-1] = (ends[:-1] & marks[1:]) | (marks[:-1] & begins[1:])
    opens, closes = cuts.copy(), cuts
    opens[starts] = True
    closes[stops] = True
    return np.flatnonzero(opens), np.flatnonzero(closes)


def write(docs: DataFrame, path: str, vocabulary: str, end: int = END) -> None:
    """Writes the ids of ``docs`` (doc_id, text) in ascending doc_id order to ``path``.

    One range shuffle of the texts into tasks of about ``PART_BYTES``, counted first; every task codes
    the documents of its range in order. Rows of one id, null included, are parted by content.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, part, segment = WordCache(vocabulary), TaskContext.get().partitionId(), 0
        names, ids, held, offset = [], [], 0, 0

        def row() -> pa.RecordBatch:
            nonlocal segment, offset
            sizes = np.array(list(map(len, ids)), np.int64)
            codes = Codes.of(np.concatenate(ids))
            segment, offset = segment + 1, offset + int(sizes.sum())
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()), pa.array([segment - 1], pa.int32()),
                    pa.array([offset - int(sizes.sum())]),
                    pa.array([names], pa.list_(pa.int64())),
                    pa.array([np.concatenate(([0], np.cumsum(sizes)))], pa.list_(pa.int32())),
                    pa.array([int(sizes.sum())]),
                    *[pa.array([[x.tobytes() for x in level]], pa.list_(pa.binary()))
                      for level in (codes.chunks, codes.bitmaps, codes.ranks)],
                ],
                ["part", "segment", "offset", "ids", "places", "n_tokens", "chunks", "bitmaps", "ranks"],
            )

        for batch in batches:
            for piece in W.slices(batch, "text"):
                made, bounds = cache.encode(piece.column("text"))
                for name, a, b in zip(piece.column("doc_id").to_pylist(), bounds, bounds[1:]):
                    if names and held + b - a >= SEGMENT_TOKENS:
                        yield row()
                        names, ids, held = [], [], 0
                    names.append(name)
                    ids.append(np.append(made[a:b], np.uint32(end)))
                    held += b - a + 1
        if names:
            yield row()

    whole = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = whole.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # Rows of one id are parted and ordered by content, and equal rows by their place.
    order = ["doc_id", "mark", "at"]
    ordered = (
        whole.withColumns({"mark": F.xxhash64("text"), "at": F.monotonically_increasing_id()})
        .repartitionByRange(max(1, -(-size // PART_BYTES)), *order)
        .sortWithinPartitions(*order).select("doc_id", "text")
    )
    ordered.mapInArrow(run, SEGMENT).write.parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Segments with ``start``, the tokens of all segments before.

    Only the totals of the writing tasks, one small row each, are summed in one place and
    broadcast.
    """
    segments = spark.read.schema(SEGMENT).parquet(path)
    sums = segments.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    over = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    heads = settle(sums.select("part", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("head")))
    return segments.join(F.broadcast(heads), "part").withColumn(
        "start", F.col("head") + F.col("offset")).drop("head", "offset")


def _opened(batch: pa.RecordBatch, row: int) -> Codes:
    levels = [batch.column(name)[row].as_py() for name in ("chunks", "bitmaps", "ranks")]
    kinds = (np.uint8, np.uint8, np.uint32)
    return Codes(*[[np.frombuffer(x, k) for x in level] for level, k in zip(levels, kinds)])


def tokens_at(segments: DataFrame, places: DataFrame) -> DataFrame:
    """``(place, token)`` for global token numbers ``places(place)``, by random access.

    Places outside the file give no row. Each segment is opened once for all its places.
    """
    width = SEGMENT_TOKENS
    span = F.explode(F.sequence(F.floor(F.col("start") / width),
                                F.floor((F.col("start") + F.col("n_tokens") - 1) / width)))
    cells = segments.select("part", "segment", "start", "n_tokens", span.alias("cell"))
    asked = places.select("place").distinct().withColumn("cell", F.floor(F.col("place") / width))
    met = asked.join(cells, "cell").where(
        (F.col("place") >= F.col("start")) & (F.col("place") < F.col("start") + F.col("n_tokens"))
    )
    lists = met.groupBy("part", "segment").agg(F.collect_set("place").alias("asked"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                wanted = np.array(batch.column("asked")[row].as_py(), np.int64)
                got = _opened(batch, row).get(wanted - batch.column("start")[row].as_py())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(wanted), pa.array(got.astype(np.int64))], ["place", "token"])

    return segments.join(lists, ["part", "segment"]).mapInArrow(run, "place long, token long")


def digests(segments: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, read from the segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                places = np.array(batch.column("places")[row].as_py(), np.int64)
                ids = _opened(batch, row).all()
                view = memoryview(ids.astype("<u4")).cast("B")
                start = batch.column("start")[row].as_py()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(batch.column("ids")[row].as_py(), pa.int64()),
                        pa.array(places[:-1] + start), pa.array(np.diff(places)),
                        pa.array([zlib.crc32(view[4 * a : 4 * b])
                                  for a, b in zip(places, places[1:])], pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return segments.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op6_token_codes(spark, sf_dir: str) -> DataFrame:
    """Every document written in coded form and read back."""
    path = fresh_path(spark, "tokens")
    write(spark.read.parquet(f"{sf_dir}/documents.parquet"), path, default_vocabulary())
    return digests(read(spark, path))
