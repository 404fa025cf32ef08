"""Page texts against plain Python, time on odd pages, and columns of any name."""

import re
import time

import pytest

from punctua.llm import lines as L
from pyspark.sql import functions as F


def plain_text(html):
    text = re.sub(r"(?is)<(?:script[^<>]*>.*?(?:</script>|\Z)|style[^<>]*>.*?(?:</style>|\Z)"
                  r"|!--.*?(?:-->|\Z))", " ", html)
    text = re.sub(f"(?i)</?(?:{L.BLOCK_TAGS})(?:[ /][^<>]*)?>", "\n", text)
    text = re.sub("<[^<>]*>", "", text)
    for name, char in L.ENTITIES:
        text = text.replace(name, char)
    return re.sub("[ \t\r]*\n[ \t\r\n]*", "\n", text).strip(" ")


PAGES = [
    "", " ", "a", "  a \t", "\n", " \n a \n\n b\t\r\n", "a\n \t\n", "\n\n\n", "\t\n a", "a\n b \n c\t",
    "<p>a</p><br/>b<b>c</b> &amp;lt; &nbsp;&#39;x&#39;",
    "x<script>if (a < b) {}</script>y<style >p{}</style>z<!-- no <p> -->w",
    "x<SCRIPT src='a'>never closed <p>text</p>", "x<!-- never closed <p>text</p>", "1 < 2 <i>and</i> 3 > 2",
    "<div class='a'>one</div>\n  <div>two</div>", "a <script", "a <p", "<<p>>", "</script>a",
]


def test_page_text_equals_plain_python(spark):
    frame = spark.createDataFrame([(i, p) for i, p in enumerate([*PAGES, None])], "i int, html string")
    found = {r["i"]: r["t"] for r in frame.select("i", L.page_text(F.col("html")).alias("t")).collect()}
    assert found.pop(len(PAGES)) is None
    assert found == {i: plain_text(p) for i, p in enumerate(PAGES)}


@pytest.mark.parametrize("piece", [" ", "<!--", "<", "<script>", "<script", "\n ", "&amp;", "<p>", "</style"])
def test_long_pages_take_linear_time(spark, piece):
    def seconds(size):
        frame = spark.createDataFrame([(piece * (size // len(piece)) + "x",)], "html string")
        began = time.perf_counter()
        frame.select(L.page_text(F.col("html"))).collect()
        return time.perf_counter() - began

    seconds(1000)
    small, large = seconds(500_000), seconds(1_000_000)
    assert large < 2.5 * small + 0.5


def test_columns_of_every_internal_name(spark):
    names = ["_host", "_lines", "_hits", "_kept", "_marks", "_at", "_text", "c0", "c1", "_page", "a.b",
             "text_kept"]
    rows = [(i, "s", "same line\nown " + str(i), *[name + str(i) for name in names]) for i in range(8)]
    frame = spark.createDataFrame(rows, ["id", "source", "text", *names])
    out = L.drop_boilerplate(frame, F.col("source"), F.col("text"), ratio=0.5)
    assert out.columns == ["id", "source", "text", *names[:-1], "text_kept", "n_lines", "n_dropped"]
    for row in out.collect():
        i = row["id"]
        assert [row[name] for name in names[:-1]] == [name + str(i) for name in names[:-1]]
        assert (row["text_kept"], row["n_lines"], row["n_dropped"]) == (f"own {i}", 2, 1)
    assert L.drop_boilerplate(frame.limit(0), F.col("source"), F.col("text")).count() == 0
