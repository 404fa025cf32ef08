"""Words and their 64-bit hashes over Arrow text, many documents at a time.

Texts are handled as UTF-8 bytes: all separators used here are ASCII, so no decoding is needed.
Hashes are polynomials over random byte values modulo 2**64, finished by a bit mixer; they
are the same in every task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Bytes of text handled at once; longer single documents are handled alone.
SLICE_BYTES = 4 << 20
# Bytes hashed at once.
HASH_BYTES = 1 << 20

_GENERATOR = np.random.Generator(np.random.PCG64(20240229))
_BYTE_VALUES = _GENERATOR.integers(0, 2**64, 256, np.uint64)
_BASE = 0x9E3779B97F4A7C13
_INVERSE = pow(_BASE, -1, 2**64)


def byte_class(low_high: list[tuple[int, int]]) -> np.ndarray:
    """Table of 256 flags, False for the bytes in the given closed ranges."""
    table = np.ones(256, bool)
    for low, high in low_high:
        table[low : high + 1] = False
    return table


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
# Everything but white space, and letters and digits with all that is not ASCII.
NOT_SPACE = byte_class([(0x20, 0x20), (0x09, 0x0D)])
ALPHANUMERIC = byte_class([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly; a bijection."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values ^= values >> np.uint64(33)
    values *= np.uint64(0xC4CEB9FE1A85EC53)
    values ^= values >> np.uint64(33)
    return values


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of whole documents of about ``limit`` bytes."""
    bounds = text_bytes(batch.column(text))[1]
    begin = 0
    while begin < batch.num_rows:
        end = int(np.searchsorted(bounds, bounds[begin] + limit, "right")) - 1
        end = min(max(end, begin + 1), batch.num_rows)
        yield batch.slice(begin, end - begin)
        begin = end


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the bounds of each row in them; null is empty."""
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, bounds, data = column.buffers()
    if bounds is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    bounds = np.frombuffer(bounds, kind)[column.offset : column.offset + len(column) + 1]
    bounds = bounds.astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


@dataclass
class Words:
    """Words of many documents: byte spans, hashes, and the bounds of each document in them."""

    starts: np.ndarray
    stops: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray


def split_words(column: pa.Array, inside: np.ndarray) -> Words:
    """Maximal runs of ``inside`` bytes, A-Z lowered, per row of a string column."""
    data, bounds = text_bytes(column)
    data = LOWER[data]
    starts, stops = word_spans(data, bounds, inside)
    return Words(starts, stops, hash_spans(data, starts, stops), np.searchsorted(starts, bounds))


def word_spans(
    data: np.ndarray, bounds: np.ndarray, inside: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of ``inside`` bytes that cross no bound."""
    size = len(data)
    mask = inside[data]
    opens = mask.copy()
    opens[1:] &= ~mask[:-1]
    closes = np.zeros(size + 1, bool)
    closes[1:] = mask
    closes[:size] &= ~mask
    heads = bounds[:-1][bounds[:-1] < size]
    opens[heads] = mask[heads]
    inner = heads[heads > 0]
    closes[inner] = mask[inner - 1]
    return np.flatnonzero(opens), np.flatnonzero(closes)


def _powers(base: int, size: int) -> np.ndarray:
    powers = np.full(size, base, np.uint64)
    powers[0] = 1
    return np.multiply.accumulate(powers)


_CACHED: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def hash_spans(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each span; spans are in order and do not overlap."""
    hashes = np.empty(len(starts), np.uint64)
    if HASH_BYTES not in _CACHED:
        _CACHED[HASH_BYTES] = _powers(_BASE, HASH_BYTES), _powers(_INVERSE, HASH_BYTES)
    begin = 0
    while begin < len(starts):
        end = int(np.searchsorted(stops, starts[begin] + HASH_BYTES, "right"))
        end = max(end, begin + 1)
        first, last = starts[begin], stops[end - 1]
        if last - first > HASH_BYTES:
            up, down = _powers(_BASE, last - first), np.ones(1, np.uint64)
        else:
            up, down = _CACHED[HASH_BYTES]
        sums = np.zeros(last - first + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[data[first:last]] * up[: last - first], out=sums[1:])
        here = starts[begin:end] - first
        hashes[begin:end] = (sums[stops[begin:end] - first] - sums[here]) * down[here]
        begin = end
    return mix(hashes ^ (stops - starts).astype(np.uint64))


def shingle_hashes(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of ``size`` consecutive words per document, and their bounds.

    A document of fewer words has its whole sequence as one; one without words has none.
    """
    hashes, bounds = words.hashes, words.bounds
    counts = np.diff(bounds)
    factor = np.uint64(0xD6E8FEB86659FD93)
    rolled = hashes.copy()
    for step in range(1, min(size, len(hashes))):
        rolled[: len(hashes) - step] = rolled[: len(hashes) - step] * factor + mix(
            hashes[step:] + np.uint64(step)
        )
    rolled = mix(rolled)
    owner = np.repeat(np.arange(len(counts)), counts)
    whole = np.arange(len(hashes)) + size <= bounds[1:][owner]
    short = np.flatnonzero((counts > 0) & (counts < size))
    for document in short:
        value = np.uint64(counts[document])
        for word in hashes[bounds[document] : bounds[document + 1]]:
            value = mix(np.array([value], np.uint64) * factor + word)[0]
        rolled[bounds[document]] = value
        whole[bounds[document]] = True
    rolled, owner = rolled[whole], owner[whole]
    order = np.lexsort((rolled, owner))
    rolled = rolled[order]
    fresh = np.ones(len(rolled), bool)
    fresh[1:] = (rolled[1:] != rolled[:-1]) | (owner[1:] != owner[:-1])
    return rolled[fresh], np.searchsorted(owner[fresh], np.arange(len(counts) + 1))
