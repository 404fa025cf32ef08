"""Frames and plain-Python counterparts for the training-data operators."""

from __future__ import annotations

import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def lowered(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def documents(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, DOCS)


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def components(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    return {n: find(n) for n in nodes}
