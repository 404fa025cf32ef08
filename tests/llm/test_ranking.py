"""Ranked search against plain Python and SQL."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

import compare
import helpers as H
from punctua.llm import ranking as R
from pyspark.sql import functions as F

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(H.lowered(text))


def brute(docs, items, k):
    counts = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    n_docs = sum(1 for _, c in counts if c)
    n_terms = sum(sum(c.values()) for _, c in counts)
    df = Counter(term for _, c in counts for term in c)
    out = []
    for item_id, text in items:
        found = []
        for doc_id, c in counts:
            score = 0
            for term in set(terms(text)) & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                m = 50 + 50 * sum(c.values()) * n_docs // n_terms
                score += w * (10**9 * c[term] // (1000 * c[term] + 20 * m))
            if score:
                found.append((-score, doc_id is not None, doc_id or 0, doc_id))
        for rank, (score, _, _, doc_id) in enumerate(sorted(found, key=lambda f: f[:3])[:k], 1):
            out.append((item_id, rank, doc_id, -score))
    return sorted(out, key=repr)


def tables():
    dice = random.Random(12)
    vocabulary = ["the", "The", "été", "a1", "B", "ß-ö", "中", "_x", "rare", "z" * 30, "one", "two"]
    texts = [" ".join(dice.choice(vocabulary) for _ in range(dice.randrange(40))) for _ in range(150)]
    texts += ["the same text"] * 70  # ties beyond the edge of a list
    texts += [None, "", " .,!", "rare " * 3_000, "q" * 20_000, "only here"]
    docs = list(zip([*range(len(texts) - 3), 7, None, None], texts))
    dice.shuffle(docs)
    items = [(i, " ".join(dice.choice(vocabulary) for _ in range(dice.randrange(9)))) for i in range(20)]
    items += [(20, None), (21, ""), (22, "nowhere"), (23, "the same text"), (23, "the same text"),
              (None, "rare only"), (24, "the THE the")]
    return docs, items


@pytest.mark.parametrize("k,pass_items,pass_bytes,tile", [
    (50, 1024, 1 << 20, (64, 4096, 1024)), (3, 5, 1 << 20, (2, 3, 16)), (50, 1024, 40, (64, 4, 7))])
def test_equals_brute_force(spark, monkeypatch, k, pass_items, pass_bytes, tile):
    docs, items = tables()
    monkeypatch.setattr(R, "ITEM_TILE", tile[0])
    monkeypatch.setattr(R, "TERM_TILE", tile[1])
    monkeypatch.setattr(R, "DOCUMENT_TILE", tile[2])
    found = R.search(
        spark.createDataFrame(docs, "doc_id int, text string").repartition(4)
        .withColumns({"row": F.lit(1), "score": F.lit("mine"), "a.b": F.lit(0)}),
        spark.createDataFrame(items, "item_id long, text string").withColumn("rank", F.lit(0)),
        k, pass_bytes, pass_items)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute(docs, items, k)


def test_query_equals_sql(spark, tmp_path):
    docs, items = tables()
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(
        f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet")
    base = duckdb.connect()
    for name in ("documents", "benchmark"):
        base.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    found = R.op12_lexical_search(spark, str(tmp_path))
    assert compare.differences(found, base, R.SQL) == []


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert R.search(docs.limit(0), items).count() == 0
    assert R.search(docs, items.limit(0)).count() == 0
    assert R.search(docs.withColumn("text", F.lit(None).cast("string")), items).count() == 0


def test_tiles_keep_every_partial_sum_exact(monkeypatch):
    monkeypatch.setattr(R, "EXACT", 10 * R.IMPACT_BOUND)
    items = R.Items(np.arange(2), np.arange(9, dtype=np.uint64), [np.arange(9), np.array([1, 8])])
    weight = np.array([4, 4, 4, 0, 9, 1, 1, 12, 3])
    tile, = R.tiles(items, weight)
    assert [terms.tolist() for terms, _ in tile.parts] == [[0, 1], [2], [4], [5, 6], [7], [8]]
    for terms, dense in tile.parts:
        assert dense[0].tolist() == weight[terms].tolist()
        assert dense[1].tolist() == [weight[t] if t in (1, 8) else 0 for t in terms]


def test_lengths_beyond_64_bits():
    sizes = np.array([3, 5_000_000], np.int32)
    n_docs, n_terms = 10**11, 10**14
    assert R.mean_lengths(sizes, n_docs, n_terms).tolist() == [
        50 + 50 * int(n) * n_docs // n_terms for n in sizes]
