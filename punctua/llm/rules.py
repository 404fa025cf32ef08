"""Quality rules as a short-circuit cascade, ordered by rejection per cost.

Every document gets the base counts of its whole text. The verdict is a conjunction of rules, so
their order changes what a run costs and never what it returns. A sample of documents is put through
every rule first, where it lies: each task times its rules and counts which sets of rules reject
its documents. The order is then built step by step: next comes the rule that rejects most of the
sample's documents still left, per second it takes. In the run each rule sees only
the documents that all rules before it left.

Words are maximal runs without white space, letter case kept; lines are cut at line feeds. A
null text has no words and no lines, and fails like an empty one. All columns of the input stay,
those named like a result column are replaced; rows are never joined, so repeated or null ids do
not matter.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctua.llm import words as W
from punctua.llm.shared import map_beside, quoted

# Documents that the order is estimated on: about so many, drawn evenly over all.
SAMPLE_ROWS = 4096
SAMPLE_SEED = 20240229
MIN_WORDS, WINDOW, MAX_REPEAT_PERCENT = 10, 5, 20

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

_SYMBOL = np.zeros(256, bool)
_SYMBOL[np.frombuffer(b"#*$%&|<>", np.uint8)] = True
_UPPER, _LETTER, _DIGIT = (np.zeros(256, bool) for _ in range(3))
_UPPER[65:91] = True
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_DIGIT[48:58] = True
_WORDLIKE = _LETTER.copy()
_WORDLIKE[128:] = True
_FACTOR = np.uint64(0xD6E8FEB86659FD93)


def _per_row(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many flags are set between each two bounds."""
    return np.diff(np.searchsorted(np.flatnonzero(flags), bounds))


class Texts:
    """Some documents: bytes, word spans and base counts, with the bounds of each document."""

    def __init__(self, data, bounds, starts, stops, counts):
        self.data, self.bounds = data, bounds
        self.starts, self.stops = starts, stops
        self.counts = counts
        self.first = np.searchsorted(starts, bounds)
        self._hashes = None

    def __len__(self) -> int:
        return len(self.bounds) - 1

    @classmethod
    def of(cls, column: pa.Array) -> Texts:
        data, bounds = W.text_bytes(column)
        starts, stops = W.word_spans(data, bounds, W.NOT_SPACE)
        texts = cls(data, bounds, starts, stops, {})
        texts.counts = _counted(texts)
        return texts

    @property
    def hashes(self) -> np.ndarray:
        if self._hashes is None:
            self._hashes = W.hash_spans(self.data, self.starts, self.stops)
        return self._hashes

    def owners(self) -> np.ndarray:
        """The document of each word."""
        return np.repeat(np.arange(len(self)), np.diff(self.first))

    def pick(self, chosen: np.ndarray) -> Texts:
        """The documents marked in ``chosen``."""
        sizes, counts = np.diff(self.bounds), np.diff(self.first)
        data = self.data[np.repeat(chosen, sizes)]
        bounds = np.concatenate(([0], np.cumsum(sizes[chosen])))
        moved = np.repeat(self.bounds[:-1][chosen] - bounds[:-1], counts[chosen])
        words = np.repeat(chosen, counts)
        picked = Texts(data, bounds, self.starts[words] - moved, self.stops[words] - moved,
                       {name: values[chosen] for name, values in self.counts.items()})
        if self._hashes is not None:
            picked._hashes = self._hashes[words]
        return picked


def _lines(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of the lines that hold a word, and the document of each."""
    data, bounds = texts.data, texts.bounds
    cuts = np.unique(np.concatenate((np.flatnonzero(data == 10) + 1, bounds)))
    begins, ends = cuts[:-1], cuts[1:].copy()
    ends -= data[ends - 1] == 10
    owner = np.searchsorted(bounds, begins, "right") - 1
    held = np.searchsorted(texts.starts, ends) > np.searchsorted(texts.starts, begins)
    return begins[held], ends[held], owner[held]


def _repeated_words(texts: Texts) -> np.ndarray:
    """Per document, its words in windows of ``WINDOW`` words that stand in it twice or more."""
    hashes, owner = texts.hashes, texts.owners()
    size = len(hashes) - WINDOW + 1
    if size <= 0:
        return np.zeros(len(texts), np.int64)
    rolled = W.mix(owner[:size].astype(np.uint64) + np.uint64(1))
    for step in range(WINDOW):
        rolled = rolled * _FACTOR + hashes[step : step + size]
    inside = np.flatnonzero(owner[:size] == owner[WINDOW - 1 :])
    rolled = W.mix(rolled[inside])
    order = np.argsort(rolled)
    ranked = rolled[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(len(ranked), bool)
    twice[1:] |= same
    twice[:-1] |= same
    covered = np.zeros(len(hashes), bool)
    starts = inside[order[twice]]
    for step in range(WINDOW):
        covered[starts + step] = True
    return _per_row(covered, texts.first)


def _counted(texts: Texts) -> dict[str, np.ndarray]:
    data, bounds = texts.data, texts.bounds
    n_words = np.diff(texts.first)
    chars = W.NOT_SPACE[data] & ((data & 0xC0) != 0x80)
    begins, ends, owner = _lines(texts)
    n_lines = np.bincount(owner, minlength=len(texts)).astype(np.int64)
    lines = W.hash_spans(data, begins, ends) ^ W.mix(owner.astype(np.uint64) + np.uint64(1))
    order = np.argsort(lines)
    again = lines[order][1:] == lines[order][:-1]
    dup_lines = np.bincount(owner[order[1:][again]], minlength=len(texts)).astype(np.int64)
    return {
        "n_words": n_words, "word_chars": _per_row(chars, bounds),
        "n_symbols": _per_row(_SYMBOL[data], bounds), "n_dup_lines": dup_lines,
        "n_repeat_words": _repeated_words(texts), "_lines": n_lines,
    }


@dataclass(frozen=True)
class Rule:
    """A named test; ``rejects`` tells for each of some documents whether it fails."""

    name: str
    rejects: Callable[[Texts], np.ndarray]


def _symbols(texts: Texts) -> np.ndarray:
    return 10 * texts.counts["n_symbols"] > texts.counts["n_words"]


def _same_lines(texts: Texts) -> np.ndarray:
    """Over half of at least four lines are equal to an earlier one."""
    lines = texts.counts["_lines"]
    return (lines >= 4) & (2 * texts.counts["n_dup_lines"] > lines)


def _word_length(texts: Texts) -> np.ndarray:
    chars, words = texts.counts["word_chars"], texts.counts["n_words"]
    return (chars < 2 * words) | (chars > 20 * words)


def _capitals(texts: Texts) -> np.ndarray:
    upper = _per_row(_UPPER[texts.data], texts.bounds)
    return 2 * upper > _per_row(_LETTER[texts.data], texts.bounds)


def _digits(texts: Texts) -> np.ndarray:
    return 2 * _per_row(_DIGIT[texts.data], texts.bounds) > texts.counts["word_chars"]


def _unlettered(texts: Texts) -> np.ndarray:
    """Under 60 % of the words hold a letter, or any character that is not ASCII."""
    lettered = np.flatnonzero(_WORDLIKE[texts.data])
    holds = np.searchsorted(lettered, texts.stops) > np.searchsorted(lettered, texts.starts)
    return 100 * _per_row(holds, texts.first) < 60 * texts.counts["n_words"]


def _shouts(texts: Texts) -> np.ndarray:
    """Over 30 % of the words end in an exclamation mark."""
    loud = texts.data[texts.stops - 1] == 33
    return 10 * _per_row(loud, texts.first) > 3 * texts.counts["n_words"]


def _long_words(texts: Texts) -> np.ndarray:
    """A word of over 1,000 bytes."""
    return _per_row(texts.stops - texts.starts > 1000, texts.first) > 0


def _bullets(texts: Texts) -> np.ndarray:
    """Over 90 % of at least five lines begin with ``-`` or ``*``."""
    begins, _, owner = _lines(texts)
    at = texts.starts[np.searchsorted(texts.starts, begins)]
    marked = np.isin(texts.data[at], np.frombuffer(b"-*", np.uint8))
    count = np.bincount(owner[marked], minlength=len(texts))
    return (texts.counts["_lines"] >= 5) & (10 * count > 9 * texts.counts["_lines"])


def _one_pair(texts: Texts) -> np.ndarray:
    """One pair of neighbouring words makes up over 20 % of at least 20 pairs."""
    hashes, owner = texts.hashes, texts.owners()
    if len(hashes) < 2:
        return np.zeros(len(texts), bool)
    inside = np.flatnonzero(owner[1:] == owner[:-1])
    pairs = W.mix(hashes[:-1] * _FACTOR + hashes[1:])[inside]
    owner = owner[inside]
    order = np.argsort(pairs ^ W.mix(owner.astype(np.uint64) + np.uint64(1)))
    pairs, owner = pairs[order], owner[order]
    fresh = np.ones(len(pairs), bool)
    fresh[1:] = (pairs[1:] != pairs[:-1]) | (owner[1:] != owner[:-1])
    heads = np.flatnonzero(fresh)
    most = np.zeros(len(texts), np.int64)
    np.maximum.at(most, owner[heads], np.diff(np.append(heads, len(pairs))))
    pairs_of = np.maximum(texts.counts["n_words"] - 1, 0)
    return (pairs_of >= 20) & (5 * most > pairs_of)


def _stutter(texts: Texts) -> np.ndarray:
    """Over 40 % of at least 10 pairs of neighbouring words are twice the same word."""
    hashes, owner = texts.hashes, texts.owners()
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    pairs_of = texts.counts["n_words"] - 1
    return (pairs_of >= 10) & (10 * _per_row(same, texts.first) > 4 * pairs_of)


RULES = [
    Rule("bullets", _bullets), Rule("capitals", _capitals), Rule("digits", _digits),
    Rule("long_words", _long_words), Rule("one_pair", _one_pair),
    Rule("same_lines", _same_lines), Rule("shouts", _shouts), Rule("stutter", _stutter),
    Rule("symbols", _symbols), Rule("unlettered", _unlettered), Rule("word_length", _word_length),
]


def base_failed(counts: dict[str, np.ndarray]) -> np.ndarray:
    """Too few words, or too many in repeated windows."""
    words = counts["n_words"]
    return (words < MIN_WORDS) | (100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * words)


def _measure(rules: Sequence[Rule]):
    """Task function: seconds per rule (``kind`` rule) and documents per set of failed rules."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seconds, sets = np.zeros(len(rules)), {}
        for batch in batches:
            for part in W.slices(batch, "text"):
                texts = Texts.of(part.column("text"))
                texts = texts.pick(~base_failed(texts.counts))
                if not len(texts):
                    continue
                failed = np.zeros(len(texts), np.int64)
                for number, rule in enumerate(rules):
                    texts._hashes = None  # each rule pays for what it uses
                    began = time.perf_counter()
                    failed |= rule.rejects(texts).astype(np.int64) << number
                    seconds[number] += time.perf_counter() - began
                for value, n in zip(*np.unique(failed, return_counts=True)):
                    sets[int(value)] = sets.get(int(value), 0) + int(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(["rule"] * len(rules) + ["set"] * len(sets)),
             pa.array([*range(len(rules)), *sets], pa.int64()),
             pa.array([*seconds, *map(float, sets.values())], pa.float64())],
            ["kind", "number", "amount"])

    return run


def best_order(seconds: Sequence[float], sets: dict[int, float]) -> list[int]:
    """Rule numbers by rejection per cost, each counted on what the rules before it leave.

    ``sets`` counts documents by the bits of the rules they fail. Ties go to the cheaper rule.
    """
    left, order = dict(sets), []
    while len(order) < len(seconds):
        gains = {
            rule: sum(n for bits, n in left.items() if bits >> rule & 1)
            for rule in range(len(seconds)) if rule not in order
        }
        best = max(gains, key=lambda r: (gains[r] / max(seconds[r], 1e-9), -seconds[r], -r))
        order.append(best)
        left = {bits: n for bits, n in left.items() if not bits >> best & 1}
    return order


def estimate(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text",
             sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """``rules`` in the order in which a cascade is cheapest on a sample of ``docs``.

    One pass draws each document with the same chance, ``sample_rows`` over all rows. A task returns
    a row per rule and per set of failed rules, of which there are at most
    ``2 ** len(rules)`` whatever the input; their sums go to the driver.
    """
    share = min(1.0, sample_rows / max(1, docs.count()))
    narrow = docs.select(F.col(quoted(text)).cast("string").alias("text"))
    found = (
        narrow.sample(withReplacement=False, fraction=share, seed=SAMPLE_SEED)
        .mapInArrow(_measure(rules), "kind string, number long, amount double")
        .groupBy("kind", "number").agg(F.sum("amount").alias("amount")).collect()
    )
    seconds = [0.0] * len(rules)
    for row in found:
        if row["kind"] == "rule":
            seconds[row["number"]] = row["amount"]
    sets = {row["number"]: row["amount"] for row in found if row["kind"] == "set"}
    return [rules[number] for number in best_order(seconds, sets)]


def _cascade(rules: Sequence[Rule]):
    """Task function: base counts of every row, and the verdict of rules in the given order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[pa.Array]]]:
        for batch in batches:
            for part in W.slices(batch, "text"):
                texts = Texts.of(part.column("text"))
                counts = texts.counts
                failed = base_failed(counts)
                alive = np.flatnonzero(~failed)
                left = texts.pick(~failed)
                for rule in rules:
                    if not len(left):
                        break
                    rejected = rule.rejects(left)
                    if rejected.any():
                        alive, left = alive[~rejected], left.pick(~rejected)
                kept = np.zeros(part.num_rows, bool)
                kept[alive] = True
                yield part, [*[pa.array(counts[name].astype(np.int64)) for name in COUNTS],
                             pa.array(failed), pa.array(kept)]

    return run


def judge(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text",
          sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """All columns of ``docs`` with the base counts, ``base_failed`` and ``kept``. No shuffle.

    A document is kept if it passes the base rules and no rule of the cascade rejects it.
    """
    added = [
        *[T.StructField(name, T.LongType()) for name in COUNTS],
        T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType()),
    ]
    return map_beside(docs, text, _cascade(estimate(docs, rules, text, sample_rows)), added)


def op11_quality_rules(spark, sf_dir: str) -> DataFrame:
    """All documents: base counts, base verdict, and the verdict of the whole cascade."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return judge(docs).select("doc_id", *COUNTS, "base_failed", "kept")


SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS body FROM documents
), lists AS (
  SELECT r, regexp_extract_all(body, '[^\\x20\\x09-\\x0D]+') AS words FROM d
), w AS (
  SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM lists
), nexts AS (
  SELECT *, lead(word) OVER here AS w2, lead(word, 2) OVER here AS w3,
         lead(word, 3) OVER here AS w4, lead(word, 4) OVER here AS w5
  FROM w WINDOW here AS (PARTITION BY r ORDER BY i)
), counted AS (
  SELECT *, w5 IS NOT NULL AND count(*) OVER (PARTITION BY r, word, w2, w3, w4, w5) > 1 AS twice,
         count(*) OVER (PARTITION BY r, word, w2) AS of_pair
  FROM nexts
), covered AS (
  SELECT *, max(twice::INT) OVER (
    PARTITION BY r ORDER BY i ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS again FROM counted
), by_words AS (
  SELECT r, count(*) AS n_words, sum(length(word)) AS word_chars, sum(again) AS n_repeat_words,
         max(of_pair) FILTER (w2 IS NOT NULL) AS top_pair, count(*) FILTER (word = w2) AS same,
         count(*) FILTER (regexp_matches(word, '[A-Za-z]|[^\\x00-\\x7F]')) AS lettered,
         count(*) FILTER (word LIKE '%!') AS loud, max(strlen(word)) AS longest
  FROM covered GROUP BY r
), lines AS (
  SELECT r, unnest(string_split(body, chr(10))) AS line FROM d
), by_lines AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines,
         count(*) FILTER (regexp_matches(line, '^[\\x20\\x09-\\x0D]*[-*]')) AS bullets
  FROM lines WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY r
), facts AS (
  SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
         length(body) - length(translate(body, '#*$%&|<>', '')) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         coalesce(n_lines, 0) AS n_lines, coalesce(bullets, 0) AS bullets,
         coalesce(top_pair, 0) AS top_pair, coalesce(same, 0) AS same,
         coalesce(lettered, 0) AS lettered, coalesce(loud, 0) AS loud,
         coalesce(longest, 0) AS longest,
         length(regexp_replace(body, '[^A-Z]', '', 'g')) AS upper,
         length(regexp_replace(body, '[^A-Za-z]', '', 'g')) AS letters,
         length(regexp_replace(body, '[^0-9]', '', 'g')) AS digits
  FROM d LEFT JOIN by_words USING (r) LEFT JOIN by_lines USING (r)
), judged AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words
           AS base_failed
  FROM facts
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
       n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT (base_failed
         OR (n_lines >= 5 AND 10 * bullets > 9 * n_lines)
         OR 2 * upper > letters
         OR 2 * digits > word_chars
         OR longest > 1000
         OR (n_words > 20 AND 5 * top_pair > n_words - 1)
         OR (n_lines >= 4 AND 2 * n_dup_lines > n_lines)
         OR 10 * loud > 3 * n_words
         OR (n_words > 10 AND 10 * same > 4 * (n_words - 1))
         OR 10 * n_symbols > n_words
         OR 100 * lettered < 60 * n_words
         OR word_chars < 2 * n_words OR word_chars > 20 * n_words) AS kept
FROM judged
"""
