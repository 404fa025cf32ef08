"""Periodic runs against plain Python that tries every period."""

import hashlib
import random
import re
import time
import zlib
from fractions import Fraction

import numpy as np
import pytest

import helpers as H
from punctua.llm import runs as R
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def smallest_period(words):
    return next(q for q in range(1, len(words) + 1)
                if all(words[i] == words[i + q] for i in range(len(words) - q)))


def brute(words, least=6, exponent=4):
    """Every maximal stretch of every period whose smallest period it is."""
    found, n = [], len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i < n - q and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            if length >= max(least, exponent * q) and smallest_period(words[start : i + q]) == q:
                found.append((start, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def kept_words(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return [w for i, w in enumerate(words) if i not in gone]


def sample_words():
    dice = random.Random(13)
    out = [[], ["a"], ["a"] * 5, ["a"] * 6, ["a"] * 300, list("ab") * 3, list("ab") * 4,
           list("abc") * 3 + ["a", "b"], list("aabaab") * 9, list("abaab") * 8 + list("ab") * 7]
    for _ in range(600):
        letters = "abcd"[: dice.choice([1, 2, 2, 3, 4])]
        out.append([dice.choice(letters) for _ in range(dice.randrange(60))])
    for _ in range(300):  # repeated pieces, one after another
        words = []
        for _ in range(dice.randrange(1, 5)):
            piece = [dice.choice("abc") for _ in range(dice.randrange(1, 7))]
            words += piece * dice.randrange(1, 9) + piece[: dice.randrange(3)]
        out.append(words)
    a, b = ["a"], ["a", "b"]  # Fibonacci words: many nested runs
    for _ in range(10):
        a, b = b, b + a
    return out + [b, list("ab") * 150 + ["c"] + list("ab") * 150]


@pytest.mark.parametrize("least,exponent", [(6, 4), (2, 2), (1, 3), (9, 2)])
def test_runs_equal_brute_force(least, exponent):
    documents = sample_words()
    flat = [w for words in documents for w in words]
    hashes = np.array([zlib.crc32(w.encode()) + 1 for w in flat], np.uint64)
    bounds = np.cumsum([0, *map(len, documents)])
    made = R.find_runs(hashes, bounds, least, exponent)
    for i, words in enumerate(documents):
        part = slice(made.bounds[i], made.bounds[i + 1])
        got = [(int(s - bounds[i]), int(e - s), int(q)) for s, e, q in zip(
            made.starts[part], made.stops[part], made.periods[part])]
        assert got == brute(words, least, exponent), words


def test_suffix_array_and_lcp():
    documents = sample_words()[:200]
    flat = [f"{i} {w}" for i, words in enumerate(documents) for w in words]
    bounds = np.cumsum([0, *map(len, documents)])
    keys = {w: k for k, w in enumerate(sorted(set(flat)))}
    words = np.array([keys[w] for w in flat], np.uint64)
    made = R.suffix_array(words, bounds)
    ends = np.repeat(bounds[1:], np.diff(bounds))
    suffixes = [tuple(words[i : ends[i]].tolist()) for i in range(len(words))]
    assert made.order.tolist() == sorted(range(len(words)), key=suffixes.__getitem__)
    assert made.rank[made.order].tolist() == list(range(len(words)))
    for k in range(1, len(words)):
        a, b = suffixes[made.order[k - 1]], suffixes[made.order[k]]
        shared = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert made.lcp[k] == shared


def test_nearest_smaller():
    dice = np.random.Generator(np.random.PCG64(1))
    for size in (1, 2, 7, 64, 333):
        values = dice.integers(0, 9, size).astype(np.int32)
        at = np.arange(size)
        for equal in (False, True):
            fits = (lambda a, b: a <= b) if equal else (lambda a, b: a < b)
            left = [next((j for j in range(i - 1, -1, -1) if fits(values[j], values[i])), -1)
                    for i in at]
            right = [next((j for j in range(i + 1, size) if fits(values[j], values[i])), size)
                     for i in at]
            assert R.nearest_smaller(values, at, equal, False).tolist() == left
            assert R.nearest_smaller(values, at, equal, True).tolist() == right


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def row_of(doc_id, text):
    words = planted(doc_id, WORD.findall(text or "")) if doc_id is not None else WORD.findall(text or "")
    runs = brute(words)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    return (len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256(listed.encode()).hexdigest(),
            hashlib.sha256(" ".join(kept_words(words, runs)).encode()).hexdigest())


def test_query_equals_brute_force(spark, tmp_path):
    dice = random.Random(5)
    texts = [" ".join(words) for words in sample_words()[::9]]
    texts += ["".join(dice.choice(["été", "a", "A", "\x1c", "ß!", " ", " ", "\n", "\t "])
                      for _ in range(dice.randrange(200))) for _ in range(250)]
    texts += [None, "", " \n", " lead and trail \r\n", "w " * 2_000, "q" * 40_000]
    ids = [*range(len(texts) - 2), None, 3]  # a null id and a repeated one
    H.documents(spark, texts, ids).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    found = R.op13_periodic_runs(spark, str(tmp_path))
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
             "collapsed_sha256"]
    assert found.columns == names
    key = lambda row: tuple((x is not None, x) for x in row)
    got = sorted((tuple(row) for row in found.collect()), key=key)
    wanted = sorted(((i, *row_of(i, text)) for i, text in zip(ids, texts)), key=key)
    assert got == wanted
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 and row_of(i, t)[0]
               for i, t in zip(ids, texts) if i is not None)


def test_columns_and_empty_tables(spark):
    docs = H.documents(spark, ["x y " * 5 + "z", None]).withColumns(
        {"runs": F.lit("mine"), "a.b": F.lit(1), "r0": F.lit(2), "at": F.struct(F.lit(3).alias("c d"))})
    out = R.periodic_runs(docs)
    assert out.columns == [*H_COLUMNS, "a.b", "r0", "at", "n_words", "runs", "collapsed"]
    rows = {r["doc_id"]: r for r in out.collect()}
    assert [tuple(r) for r in rows[0]["runs"]] == [(0, 10, 2)]
    assert rows[0]["collapsed"] == "x y z" and rows[1]["collapsed"] == "" and rows[1]["runs"] == []
    assert R.periodic_runs(docs.limit(0)).count() == 0


H_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.mark.parametrize("kind", ["same", "pair", "nested", "plain"])
def test_long_documents_take_linear_time(kind):
    def seconds(size):
        words = {"same": np.zeros(size), "pair": np.arange(size) % 2,
                 "nested": np.arange(size) // 7 % 3, "plain": np.arange(size)}[kind]
        began = time.perf_counter()
        R.find_runs(W_mix(words.astype(np.uint64)), np.array([0, size]))
        return time.perf_counter() - began

    seconds(1000)
    small, large = seconds(150_000), seconds(300_000)
    assert large < 3.5 * small + 0.2


def W_mix(values):
    from punctua.llm import words as W

    return W.mix(values + np.uint64(1))
