"""Token codes: random access, words straight through the model, ranges of a hot id."""

import random
import time
import zlib

import numpy as np
import pytest

import helpers as H
from punctua.llm import codes as C
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def vocabulary():
    return C.default_vocabulary()


@pytest.mark.parametrize("size", [0, 1, 7, 511, 512, 513, 5000])
@pytest.mark.parametrize("top", [1, 200, 70_000, 2**32])
def test_codes_give_back_all_and_any(size, top):
    dice = np.random.Generator(np.random.PCG64(size + top))
    ids = dice.integers(0, top, size).astype(np.uint32)
    made = C.Codes.of(ids)
    assert made.all().tolist() == ids.tolist()
    places = dice.permutation(size)
    assert made.get(places).tolist() == ids[places].tolist()
    assert made.get(np.zeros(0, np.int64)).tolist() == []


def test_one_token_costs_the_same_in_long_codes():
    def seconds(size):
        made = C.Codes.of(np.arange(size, dtype=np.uint32) % 49_000)
        place = np.array([size - 3])
        made.get(place)
        began = time.perf_counter()
        for _ in range(300):
            made.get(place)
        return time.perf_counter() - began

    assert seconds(4_000_000) < 4 * seconds(60_000) + 0.05


def test_words_equal_the_whole_tokenizer(vocabulary):
    dice = random.Random(6)
    letters = "abcdeéèßüñøÿöaestr'0.!-" + "ÀÉ×÷Āłж中̈"
    words = ["".join(dice.choice(letters) for _ in range(dice.randrange(1, 12))) for _ in range(4000)]
    words += ["a", "ß", "ÿ", "ö", "straße", "öffentlich", "don't", "x" * 300]
    whole = C.tokenizer(vocabulary).encode_batch(words, add_special_tokens=False)
    assert C.coded_words(vocabulary, words) == [code.ids for code in whole]
    assert C.coded_words(vocabulary, []) == []


def test_hot_id_is_spread_and_read_back(spark, tmp_path, vocabulary, monkeypatch):
    monkeypatch.setattr(C, "PART_BYTES", 4000)
    texts = [f"words of document number {i} and some more" for i in range(900)]
    texts += ["one text for all"] * 300 + [None, ""]
    ids = [None if i % 3 else i for i in range(900)] + [None] * 300 + [5, 5]
    docs = H.documents(spark, texts, ids).withColumns({"mark": F.lit("mine"), "at": F.lit(1)})
    C.write(docs, str(tmp_path / "codes"), vocabulary)
    segments = C.read(spark, str(tmp_path / "codes"))
    sizes = [r["n"] for r in segments.groupBy("part").agg(F.sum(F.size("ids")).alias("n")).collect()]
    assert len(sizes) > 5 and max(sizes) < 4 * sum(sizes) / len(sizes)
    rows = sorted(C.digests(segments).collect(), key=lambda r: r["start"])
    names = [r["doc_id"] for r in rows]
    assert names == sorted(names, key=lambda i: (i is not None, i or 0)) and len(names) == len(texts)
    token = C.tokenizer(vocabulary)
    crcs = [zlib.crc32(np.array([*token.encode(t or "", add_special_tokens=False).ids, C.END], "<u4")
                       .tobytes()) for t in texts]
    assert sorted(r["ids_crc32"] for r in rows) == sorted(crcs)
    ends = [0, *np.cumsum([r["n_tokens"] for r in rows]).tolist()]
    assert [r["start"] for r in rows] == ends[:-1]
