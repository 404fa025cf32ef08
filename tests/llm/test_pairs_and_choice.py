"""Near copies, vectors, shards, selection and the pipeline against brute force."""

import math
import os
import random

import numpy as np
import pytest

import corpus_pipeline
import helpers as H
from punctua.llm import minhash, pivots, quality, shards
from pyspark.sql import functions as F

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def near_texts(seed):
    dice, texts = random.Random(seed), [None, "", "a b", "A b", "b a", "x", "x" * 20_000]
    for _ in range(12):
        base = [str(dice.randrange(10**6)) for _ in range(dice.randrange(20, 120))]
        for _ in range(dice.randrange(1, 9)):
            copy = list(base)
            for _ in range(dice.randrange(6)):
                copy[dice.randrange(len(copy))] = str(dice.randrange(10**6))
            texts += [" ".join(copy)] * dice.randrange(1, 3)
    return texts


@pytest.mark.parametrize("size,block", [(4, 1024), (5, 8)])
def test_near_copies_equal_brute_force(spark, monkeypatch, size, block):
    monkeypatch.setattr(minhash, "BLOCK_CLASSES", block)
    texts = near_texts(size)
    sets = [H.shingles(t, size) for t in texts]
    links = [(i, j) for i in range(len(texts)) for j in range(i)
             if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) > 0]
    wanted = H.components(range(len(texts)), links)
    found = minhash.near_duplicates(H.documents(spark, texts), size).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == wanted
    assert {r["doc_id"]: r["n_shingles"] for r in found} == {i: len(s) for i, s in enumerate(sets)}
    assert {r["doc_id"] for r in found if r["kept_row"]} == {i for i, c in wanted.items() if i == c}


def test_near_copies_with_null_and_repeated_ids(spark):
    docs = H.documents(spark, ["a b c", "a b c", "a b c", "d"], ids=[None, 5, 5, None])
    found = minhash.near_duplicates(docs, 2).collect()
    assert sorted((r["component_id"] or -1, r["kept_row"]) for r in found) == [
        (-1, True), (5, False), (5, False), (5, True)]
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_posterior_bound_keeps_similar_pairs():
    needed = minhash.least_agreements(0.8, 1e-8)
    assert needed == sorted(needed) and needed[-1] < 0.8 * 128
    draws = np.random.default_rng(0).random((20_000, 128)) < 0.8
    counts = np.cumsum(draws, axis=1)[:, minhash.BATCH - 1 :: minhash.BATCH]
    assert (counts >= needed).all()


def vector_rows(seed):
    dice, rows = np.random.default_rng(seed), []
    for label in (0, 1):
        for base in dice.normal(size=(15, 16)):
            for _ in range(dice.integers(1, 6)):
                rows.append((len(rows), (base + dice.normal(size=16) * 0.12).tolist(), label))
    rows += [(len(rows) + i, rows[i][1], rows[i][2]) for i in range(5)]
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [None] * 16, [float("inf")] * 16, [1.0, 2.0], [2.0, 4.0]]
    rows += [(len(rows) + i, v, 0) for i, v in enumerate(odd)] + [(len(rows) + 50, rows[0][1], None)]
    return rows


@pytest.mark.parametrize("block", [1024, 4])
def test_near_vectors_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(pivots, "BLOCK", block)
    rows = vector_rows(1)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")

    def linked(a, b):
        x, y = a[1], b[1]
        if a[2] is None or a[2] != b[2] or not x or not y or len(x) != len(y):
            return False
        if None in x or None in y or not all(map(math.isfinite, x + y)):
            return False
        norm = math.sqrt(sum(v * v for v in x)) * math.sqrt(sum(v * v for v in y))
        return norm > 0 and sum(p * q for p, q in zip(x, y)) / norm >= 0.98

    links = [(a[0], b[0]) for a in rows for b in rows if b[0] < a[0] and linked(a, b)]
    wanted = H.components([r[0] for r in rows], links)
    found = {r["vec_id"]: r for r in pivots.near_vectors(frame, pivots=16, nearest=4, shared=1).collect()}
    assert len(found) == len(rows) and len(links) > 30
    pairs = sum(found[i]["n_links"] for i in found)
    assert pairs >= 0.9 * 2 * len(links) and pairs <= 2 * len(links)
    same = sum(found[i]["component_id"] == c for i, c in wanted.items())
    assert same >= 0.95 * len(rows)
    for i in (r[0] for r in rows[-9:-3]):
        assert found[i]["n_links"] == 0 and found[i]["component_id"] == i
    assert pivots.near_vectors(frame.limit(0)).count() == 0


def test_recall_of_the_registered_parameters(spark):
    dice, points, labels = np.random.default_rng(9), [], []
    for number in range(500):
        base = dice.normal(size=64)
        for _ in range(dice.integers(1, 6)):
            points.append(base + dice.normal(size=64) * dice.choice([0.05, 0.1, 0.12]))
            labels.append(number % 2)
    points, labels = np.array(points), np.array(labels)
    units = points / np.linalg.norm(points, axis=1)[:, None]
    linked = (units @ units.T >= pivots.COSINE) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(linked, False)
    frame = spark.createDataFrame(
        [(i, v, int(n)) for i, (v, n) in enumerate(zip(points.tolist(), labels))],
        "vec_id long, embedding array<double>, label int")
    found = {r["vec_id"]: r["n_links"] for r in pivots.near_vectors(frame).collect()}
    recall = sum(found.values()) / linked.sum()
    print(f"{len(points)} vectors, {linked.sum() // 2} links, recall {recall:.4f}")
    assert all(found[i] <= n for i, n in enumerate(linked.sum(axis=1).tolist()))
    assert linked.sum() > 1000 and recall >= 0.9


def test_shards_are_gapless_and_grow_into_the_new_one(spark):
    docs = H.documents(spark, ["é" * (i % 7) if i % 5 else None for i in range(3000)],
                       ids=[i if i % 100 else None for i in range(3000)])
    rows = shards.assign(shards.measured(docs), shards.even_tree(24)).collect()
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 24)
    assert len(rows) == 3000 and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) == set(range(24)) and 60 < sum(r["grown_shard"] == 24 for r in rows) < 190
    assert len({r["shard"] for r in rows if r["doc_id"] is None}) == 1
    assert shards.assign(shards.measured(docs.limit(0)), shards.even_tree(24)).count() == 0


def test_weight_moves_rows_into_its_subtree_only(spark):
    tree = shards.even_tree(24)
    frame = spark.range(4000)
    heavier = tree.reweighted(1, 0, 2, 3.0)  # region 1, its first rack, shard 10
    both = shards.place(shards.place(frame, tree, "id", "old"), heavier, "id", "new").collect()
    moved = [r for r in both if r["old"] != r["new"]]
    assert moved and all(8 <= r["new"] < 16 for r in moved)
    share = sum(r["new"] == 10 for r in both) / 4000
    assert 2 / 26 < share < 4 / 26


def labelled(spark):
    dice = random.Random(5)
    rows, labels = [], []
    for i in range(1200):
        words = [f"w{dice.randrange(300)}" for _ in range(dice.randrange(20, 60))]
        bad = i % 5 == 0
        if bad:
            words[3] = words[9] = f"insult{dice.randrange(4)}"
        rows.append((i, " ".join(words)))
        if i % 2 == 0:
            labels.append((i, int(not (bad and i % 3)), int(bad and i % 3 == 0)))
    texts = [t for _, t in rows] + [None, ""]
    return H.documents(spark, texts), spark.createDataFrame(
        labels, "doc_id long, quality int, toxic int")


def test_selection_parts_good_from_bad(spark):
    docs, labels = labelled(spark)
    kept = {r["doc_id"] for r in quality.selected(docs, labels).collect()}
    bad = set(range(0, 1200, 5))
    assert len(kept & bad) <= 0.05 * len(bad) and len(set(range(1200)) - bad - kept) <= 20
    assert {1200, 1201} <= kept


def test_selection_takes_k_and_all_without_labels(spark):
    docs, labels = labelled(spark)
    made = quality.select(docs, labels, k=100)
    rows = made.weighed.withColumn("kept", made.kept(F.col("key"))).collect()
    assert sum(r["kept"] for r in rows) == 100
    assert min(r["key"] for r in rows if r["kept"]) > max(r["key"] for r in rows if not r["kept"])
    assert quality.selected(docs, labels.limit(0)).count() == docs.count()
    assert quality.selected(docs.limit(0), labels).count() == 0


def test_every_bucket_weighs_by_its_evidence():
    # Of a rare word: expected count 2, never in the target, in six labelled bad documents.
    counts = np.array([[8, 2, 1000, 0, 900], [0, 0, 250, 0, 270], [6, 0, 60, 0, 10]])
    rare, unlabelled, even, none, good = quality.log_ratios(counts, np.array([4000, 1000, 240]))
    assert rare < -1 and -0.1 < unlabelled < 0 and even == none == 0 and good > 0.1


def test_rare_bad_words_and_word_pairs_are_found(spark):
    dice = random.Random(6)
    rows, labels = [], []
    for i in range(1600):
        words = [f"w{dice.randrange(300)}" for _ in range(30)]
        if i % 100 == 0:
            words[4] = "grosero"
        elif i % 10 == 5:
            words[7:9] = ["you", "there"]
        else:
            words[5], words[20] = "you", "there"
        rows.append(" ".join(words))
        if i % 8 < 5:
            labels.append((i, 1, int(i % 100 == 0 or i % 10 == 5)))
    kept = {r["doc_id"] for r in quality.selected(H.documents(spark, rows), spark.createDataFrame(
        labels, "doc_id long, quality int, toxic int")).collect()}
    rare, pairs = set(range(0, 1600, 100)), set(range(5, 1600, 10))
    assert len(kept & rare) <= 3 and len(kept & pairs) <= 0.1 * len(pairs)
    assert len(kept) >= 0.9 * (1600 - len(rare) - len(pairs))


def test_counts_of_ngrams_are_those_of_documents(spark):
    docs, labels = labelled(spark)
    counts, documents = quality.count_ngrams(docs, quality.sample_labels(labels))
    wanted = np.zeros(quality.BUCKETS, np.int64)
    import pyarrow as pa
    for row in docs.collect():
        wanted[quality.ngrams(pa.array([row["text"]], pa.string()))[0]] += 1
    assert (counts[0] == wanted).all() and documents[0] == 1202


def test_copies_keep_their_text_until_one_is_kept(spark):
    copy = " ".join(f"word{i}" for i in range(40)) + "\nsecond line of the copies"
    texts = ["menu\n" + copy] * 6 + [f"menu\nown {i} " + "x y z " * i for i in range(9)] + [None, None]
    cleaned = corpus_pipeline.keep(
        corpus_pipeline.drop_lines(spark, H.documents(spark, texts), ""), "cleaned")
    assert {r["text"] for r in cleaned.where("doc_id < 6").collect()} == {copy}
    assert cleaned.where("text like '%menu%'").isEmpty() and cleaned.count() == len(texts)
    assert cleaned.where("text is null").count() == 2
    kept = corpus_pipeline.drop_near_copies(spark, cleaned, "").where("doc_id < 6").collect()
    assert [(r["doc_id"], r["text"]) for r in kept] == [(0, copy)]


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the given tables")
def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    names, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES:
        made = corpus_pipeline.keep(stage(spark, docs, FOLDER), name)
        if name != "tokens":
            assert made.columns == names
        after = made.count()
        assert after == before if name in ("lines", "tokens") else after <= before
        if name == "near_copies":
            sets = [H.shingles(r["text"], 5) for r in made.collect()]
            assert not [1 for i, a in enumerate(sets) for b in sets[:i]
                        if a and 100 * len(a & b) >= 80 * len(a | b)]
        docs, before = made, after
    assert docs.where("not restored or n_tokens <> size(ids)").isEmpty()
    assert docs.where("n_chars <> char_length(text)").isEmpty()


@pytest.mark.parametrize("empty", [False, True])
def test_pipeline_on_odd_tables(spark, tmp_path, empty):
    """Null and repeated ids, null and empty texts, columns of internal names, and empty tables."""
    dice = random.Random(8)
    texts = [" ".join(f"w{dice.randrange(400)}" for _ in range(30)) for _ in range(60)]
    texts += [texts[0], texts[1] + " more", None, "", "", "one two three four five six seven eight nine ten"]
    ids = [*range(60), 60, None, None, 3, 3, 61]
    odd = {"_row": F.lit("mine"), "text_kept": F.lit("t"), "n_dropped": F.lit(-1), "_log_weight": F.lit(0),
           "row": F.lit(5), "block": F.lit("b"), "c0": F.lit("c")}
    docs = H.documents(spark, texts, ids).withColumns(odd)
    tables = {
        "documents": docs, "labels": spark.createDataFrame([], "doc_id long, quality int, toxic int"),
        "benchmark": spark.createDataFrame(
            [(1, "one two three four five six seven eight nine ten")], "item_id long, text string"),
    }
    for name, table in tables.items():
        (table.limit(0) if empty else table).write.parquet(f"{tmp_path}/{name}.parquet")
    made = corpus_pipeline.run(spark, str(tmp_path))
    assert made.columns == [*docs.columns, "ids", "n_tokens", "restored"]
    rows = made.collect()
    if empty:
        assert rows == []
        return
    assert {tuple(r[name] for name in odd) for r in rows} == {("mine", "t", -1, 0, 5, "b", "c")}
    found = sorted(((r["doc_id"], r["text"]) for r in rows), key=repr)
    # The copy of document 0 and the near copy of 1 go, and the document that is a benchmark item.
    assert found == sorted(list(zip(range(60), texts)) + [(None, None), (3, ""), (3, "")], key=repr)
    assert all(r["restored"] for r in rows)
