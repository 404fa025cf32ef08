"""Time, memory and odd numbers: personal data in long texts, windows of items, vectors of any size."""

import random
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest

import helpers as H
from punctua.llm import bpe, pii, pivots, postings, quality, shards
from punctua.llm import words as W
from pyspark.sql import functions as F


@pytest.mark.parametrize("piece", [
    "a.b@site.org ", "one two three four five ", "ｘ@site.org ", "a (at) site dot org ", "8.8.8.8 "])
def test_personal_data_in_long_texts_takes_linear_time(piece):
    def seconds(size):
        text = piece * (size // len(piece)) + "ｅ＠site.org"
        began = time.perf_counter()
        pii.spans_of(text)
        return time.perf_counter() - began

    seconds(1000)
    assert seconds(400_000) < 2.5 * seconds(200_000) + 0.3


class Plain:
    """A rewritten text that keeps the source of every character."""

    def __init__(self, text):
        self.text, self.spans = text, [(i, i + 1) for i in range(len(text))]

    def edit(self, edits):
        spans, parts, upto = [], [], 0
        for a, b, new in edits:
            parts += [self.text[upto:a], new]
            spans += self.spans[upto:a] + [(self.spans[a][0], self.spans[b - 1][1])] * len(new)
            upto = b
        self.text = "".join([*parts, self.text[upto:]])
        self.spans = spans + self.spans[upto:]


def test_rewritten_texts_keep_their_sources():
    dice = random.Random(10)
    for _ in range(400):
        text = "".join(dice.choice("abc") for _ in range(dice.randrange(1, 40)))
        view, plain = pii.Rewritten(text), Plain(text)
        for _ in range(dice.randrange(4)):
            edits, at = [], 0
            while at < len(view.text) and dice.random() < 0.7:
                at += dice.randrange(4)
                end = min(at + dice.randrange(1, 4), len(view.text))
                if at < end:
                    edits.append((at, end, "xyz"[: dice.randrange(4)]))
                    at = end
            view.edit(iter(edits))
            plain.edit(edits)
        assert view.text == plain.text
        for a in range(len(view.text)):
            for b in range(a + 1, len(view.text) + 1):
                assert view.source((a, b)) == (plain.spans[a][0], plain.spans[b - 1][1])


def test_windows_of_items():
    texts = ["a b c d e", "a b", "", None, "a b c d e", "c d e f", "x", "a b c"]
    ids = [1, 2, 3, 4, 5, None, 1, 1]
    names, groups = postings.phrases_of(ids, texts, 3)
    assert names == ["", "1", "2", "3", "4", "5"]
    hashes = {w: h for w, h in zip("abcdefx", W.split_words(
        pa.array(["a b c d e f x"]), W.ALPHANUMERIC).hashes.tolist())}
    wanted = set()
    for item, text in zip(ids, texts):
        words = (text or "").split()
        size = min(3, len(words))
        wanted |= {("" if item is None else str(item), *(hashes[w] for w in words[i : i + size]))
                   for i in range(len(words) - size + 1) if size}
    got = [(names[item], *row) for g in groups for row, item in zip(g.terms.tolist(), g.items)]
    assert sorted(got) == sorted(wanted) and len(got) == len(set(got))


def test_proximity_is_in_the_rows_of_the_query(spark, tmp_path):
    words = [f"w{i}" for i in range(40)]
    texts = [" ".join(words), " ".join(words[:12][::-1]), "w1 " + "z " * 60 + "w2 w3", None]
    H.documents(spark, texts, [3, 3, 5, None]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, " ".join(words[:12])), (2, "nowhere else"), (2, "nowhere else")],
                          "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = postings.op9_decontamination(spark, str(tmp_path)).collect()
    assert sorted((r["n_words"], r["n_items"], r["n_near"]) for r in rows) == [
        (0, 0, 0), (12, 0, 1), (40, 1, 1), (63, 0, 0)]


def cosine_links(rows):
    links = {}
    for i, a, la in rows:
        for j, b, lb in rows:
            if i == j or la is None or la != lb or not usable(a) or not usable(b) or len(a) != len(b):
                continue
            x, y = (np.array(v) / np.abs(v).max() for v in (a, b))
            if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.98:
                links.setdefault(i, set()).add(j)
    return links


def usable(vector):
    return vector is not None and None not in vector and np.isfinite(vector).all() and any(vector)


@pytest.mark.parametrize("block", [1024, 8])
def test_vectors_of_any_size_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(pivots, "BLOCK", block)
    monkeypatch.setattr(pivots, "PARTED", 1)
    dice = np.random.Generator(np.random.PCG64(7))
    base = dice.normal(size=(25, 4))
    rows = []
    for i in range(300):
        size = 10.0 ** dice.integers(-300, 301)
        vector = (base[i % 25] + 0.03 * dice.normal(size=4)) * size
        rows.append((i, vector.tolist(), "ab"[i % 2]))
    rows += [(300, [1e200, 1e200], "a"), (301, [1e200, 1.01e200], "a"), (302, [1e-200, 0.0], "a"),
             (303, [2e-200, 0.0], "a"), (304, [5e-324, 5e-324], "a"), (305, [0.0, 0.0], "a"),
             (306, [1.0, None], "a"), (307, [float("nan"), 1.0], "a"), (308, [float("inf"), 1.0], "a"),
             (309, None, "a"), (310, [1.0, 1.0], None), (311, [], "a"), (312, [3e300, 3e300], "a"),
             (313, [3e300, 3e300], "a")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    frame = frame.withColumns({"near": F.lit(0), "second": F.lit("mine"), "pivot": F.lit(1)})
    found = {r["vec_id"]: r for r in pivots.near_vectors(frame.repartition(3)).collect()}
    links = cosine_links(rows)
    met = sum(found[i]["n_links"] for i in found)
    wanted = sum(map(len, links.values()))
    assert len(found) == len(rows) and met >= 0.9 * wanted
    assert all(found[i]["n_links"] <= len(links.get(i, ())) for i in found)
    assert found[300]["n_links"] >= 3 and found[302]["n_links"] == 1
    assert {i for i in (305, 306, 307, 308, 309, 310, 311) if found[i]["n_links"]} == set()


def test_parted_lists_find_what_whole_lists_find(spark, monkeypatch):
    dice = np.random.Generator(np.random.PCG64(9))
    base = dice.normal(size=(6, 16))
    rows = [(i, (base[i % 6] + 0.04 * dice.normal(size=16)).tolist(), "a") for i in range(240)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    results = []
    monkeypatch.setattr(pivots, "PARTED", 1)
    for block in (1024, 16):
        monkeypatch.setattr(pivots, "BLOCK", block)
        found = pivots.near_vectors(frame, pivots=32).collect()
        results.append(sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in found))
    assert results[0] == results[1] and sum(r[1] for r in results[0]) > 1000


def test_importance_weights_and_their_sample_equal_brute_force(spark, tmp_path):
    dice = random.Random(5)
    texts = [" ".join(f"w{min(dice.randrange(90), dice.randrange(90))}" for _ in range(dice.randrange(30)))
             for _ in range(300)] + [None, "", "w1 w2", "w1 w2"]
    docs = H.documents(spark, texts, [*range(302), 302, 302])
    labels = spark.createDataFrame([(i, int(i % 3 > 0), int(i % 7 == 0)) for i in range(0, 300, 2)],
                                   "doc_id long, quality int, toxic int")
    made = quality.select(docs, labels, k=50)
    known = quality.sample_labels(labels)
    kinds = dict(zip(known.ids.tolist(), known.kinds.tolist()))
    grams = [set(quality.ngrams(pa.array([t], pa.string()))[0].tolist()) for t in texts]
    ids = [*range(302), 302, 302]
    target = [g for i, g in zip(ids, grams) if kinds.get(i) == quality.FIT]
    prior = quality.PRIOR * len(target) ** 0.5
    ratio = {}
    for gram in set().union(*grams):
        expected = sum(gram in g for g in grams) * len(target) / len(grams)
        ratio[gram] = np.log((sum(gram in g for g in target) + prior) / (expected + prior))
    wanted = sorted((i, round(sum(ratio[x] for x in g), 3)) for i, g in zip(ids, grams))
    rows = made.weighed.withColumn("sampled", made.sampled(F.col("ratio_key"))).collect()
    got = sorted((r["doc_id"], round(r["ratio_weight"], 3)) for r in rows)
    assert [i for i, _ in got] == [i for i, _ in wanted]
    assert [w for _, w in got] == pytest.approx([w for _, w in wanted], abs=0.01)
    # The noise is that of the hash, and the sample the 50 greatest keys, equal ones included.
    noise = {(r["doc_id"], r["text"]): (r["h"] % 2**64 >> 11) for r in docs.select(
        "doc_id", "text", F.xxhash64(F.lit("gumbel"), "doc_id", "text").alias("h")).collect()}
    weights = {i: w for i, w in zip(ids, (sum(ratio[x] for x in g) for g in grams))}
    keys = {r["doc_id"]: r["ratio_key"] / 2.0**40 - 2.0**20 for r in rows}
    for (i, _), h in noise.items():
        assert keys[i] == pytest.approx(weights[i] - np.log(-np.log((h + 0.5) / 2.0**53)), abs=0.01)
    ranked = sorted((r["ratio_key"] for r in rows), reverse=True)
    assert [r["sampled"] for r in rows] == [r["ratio_key"] >= ranked[49] for r in rows]


def test_ties_at_the_last_key_are_all_selected(spark):
    docs = H.documents(spark, ["same text"] * 6 + ["other words"] * 3, [1] * 6 + [2] * 3)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    made = quality.select(docs, labels, k=2)
    counts = made.weighed.where(made.kept(F.col("key"))).groupBy("doc_id").count().collect()
    assert [r["count"] for r in counts] in ([6], [3])


def test_columns_of_internal_names_stay(spark):
    odd = {"_log_weight": F.lit("mine"), "_label_kind": F.lit("own"), "_ratio_weight": F.lit(1),
           "a.b": F.lit(2), "at": F.struct(F.lit(3).alias("c d")), "_region": F.lit(4),
           "_rack": F.lit(5), "_row": F.lit(6), "_RACK_": F.lit(7)}
    docs = H.documents(spark, ["x y", "x z", None]).withColumns(odd)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    kept = quality.selected(docs, labels)
    assert kept.columns == docs.columns and sorted(map(str, kept.collect())) == sorted(map(str, docs.collect()))
    placed = shards.place(docs, shards.even_tree(4), "doc_id", "shard")
    assert placed.columns == [*docs.columns, "shard"] and placed.first()["_region"] == 4
    coded = bpe.encode_checked(docs.drop("a.b"), bpe.default_ranks()).first()
    assert coded["at"]["c d"] == 3 and coded["restored"]


def test_sizes_checksums_and_draws_of_shards(spark, tmp_path):
    texts = [f"text {i} é" * (i % 5) for i in range(400)] + [None]
    H.documents(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r["doc_id"]: r for r in shards.op3_sharding(spark, str(tmp_path)).collect()}
    slots = {}
    for i, text in enumerate(texts):
        data = (text or "").encode()
        assert (rows[i]["size"], rows[i]["text_crc32"]) == (len(data) + 8, zlib.crc32(data))
        assert 0 <= rows[i]["shard"] < 24 and rows[i]["law"] == "key"
        assert rows[i]["grown_shard"] in (rows[i]["shard"], 24)
        slots.setdefault(rows[i]["shard"], []).append(rows[i]["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    moved = sum(r["grown_shard"] == 24 for r in rows.values())
    assert 3 <= moved <= 40 and max(map(len, slots.values())) <= 40
