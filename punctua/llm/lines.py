"""Boilerplate lines by site-relative frequency, in DataFrame functions only.

Per host, the pages that contain a line are divided by all pages of the host; a line over
``ratio`` of them (and on at least ``min_pages``) is boilerplate of that host and is dropped from
its pages. Blank lines are never counted or dropped. Lines are compared without outer spaces, by
64-bit hashes; within one host these meet only by a chance of about 1e-13.

A host has fewer boilerplate lines than its mean page has lines, times ``1 / ratio``, however many
pages it has: so these lists are gathered per host and met with whole pages, and no line is
shuffled twice. A null host is a host
of its own; a null text stays null and counts as a page.

With ``fold_copies`` pages of equal text count as one page of their host, so that copies do not
make their own text boilerplate; dropping copies is left to a later step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctua.llm.shared import keep, quoted

RATIO, MIN_PAGES = 0.05, 3

# Elements of a page that end a line, and those whose content is no text.
BLOCK_TAGS = "p|div|li|ul|ol|tr|table|h[1-6]|br|nav|article|section|header|footer|title|body|head"
NO_TEXT = "script|style"


# What is no text: the elements above with their content, and comments. One that is never closed
# runs to the end of the page, as in a browser, so no pattern looks at a character twice.
HIDDEN = "(?is)<(?:" + "|".join(
    [*[f"{tag}[^<>]*>.*?(?:</{tag}>|\\z)" for tag in NO_TEXT.split("|")], "!--.*?(?:-->|\\z)"]) + ")"
BLOCK = f"(?i)</?(?:{BLOCK_TAGS})(?:[ /][^<>]*)?>"
ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
            ("&amp;", "&")]


def _tidy(text: Column) -> Column:
    """White space around line feeds goes, and with it blank lines; the first and last line stay.

    Line by line, since a pattern would try every space of a long run. The outer function only
    names the lines, so that the text is made once.
    """
    spaces = F.lit(" \t\r")

    def joined(lines: Column) -> Column:
        count = F.size(lines)
        inner = F.filter(
            F.transform(F.slice(lines, 2, F.greatest(count - 2, F.lit(0))),
                        lambda line: F.trim(line, spaces)),
            lambda line: line != "")
        first = F.rtrim(F.element_at(lines, 1), spaces)
        last = F.ltrim(F.element_at(lines, -1), spaces)
        several = F.array_join(F.concat(F.array(first), inner, F.array(last)), "\n")
        return F.when(count > 1, several).otherwise(F.element_at(lines, 1))

    return F.element_at(F.transform(F.array(F.split(text, "\n")), joined), 1)


def page_text(html: Column) -> Column:
    """Text lines of a page: block elements end lines, other tags go, entities are read.

    A tag holds no ``<``. Every step is linear in the page, whatever it holds.
    """
    text = F.regexp_replace(html, HIDDEN, " ")
    text = F.regexp_replace(text, BLOCK, "\n")
    text = F.regexp_replace(text, "<[^<>]*>", "")
    for name, char in ENTITIES:
        text = F.replace(text, F.lit(name), F.lit(char))
    return F.trim(_tidy(text))


def host_of(url: Column) -> Column:
    """Lower-case host of a URL without user, port and ``www.``; null if there is none."""
    host = F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.nullif(F.regexp_replace(F.lower(host), r"^www\.", ""), F.lit(""))


def _mark(line: Column) -> Column:
    return F.xxhash64(F.trim(line))


def boilerplate(pages: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES,
                fold_copies: bool = False) -> DataFrame:
    """``(_host, _marks)``: hashes of the boilerplate lines of each host that has any.

    ``pages`` has ``_host`` and ``_lines``. Each page counts a line once; partial counts are made
    before the shuffle, so a line on every page is one row per task. To fold copies, the lines'
    hashes are stored with one of the whole page; copies meet by host and page, one row per task.
    """
    marks = F.array_distinct(F.transform(F.filter("_lines", lambda x: F.trim(x) != ""), _mark))
    marked = pages.select("_host", marks.alias("_lines_of"), *([
        F.xxhash64("_lines", F.col("_lines").isNull()).alias("_page")] if fold_copies else []))
    if fold_copies:
        marked = keep(marked, "marked")
        totals = marked.select("_host", "_page").distinct()
        marked = marked.groupBy("_host", "_page").agg(F.first("_lines_of").alias("_lines_of"))
    else:
        totals = marked
    totals = totals.groupBy("_host").agg(F.count("*").alias("_pages"))
    counts = (
        marked.select("_host", F.explode("_lines_of").alias("_mark"))
        .groupBy("_host", "_mark").agg(F.count("*").alias("_n")).where(F.col("_n") >= min_pages)
    )
    same = F.col("c._host").eqNullSafe(F.col("t._host"))
    return (
        counts.alias("c").join(totals.alias("t"), same)
        .where(F.col("_n") > F.lit(ratio) * F.col("_pages"))
        .groupBy("c._host").agg(F.collect_set("_mark").alias("_marks"))
    )


def drop_boilerplate(pages: DataFrame, host: Column, text: Column, ratio: float = RATIO,
                     min_pages: int = MIN_PAGES, fold_copies: bool = False) -> DataFrame:
    """All columns of ``pages`` with ``text_kept``, ``n_lines`` and ``n_dropped``.

    Columns of these three names are replaced, all others stay, whatever their names.

    The lists are stored first, so that the planner sees their true size: a small table of them is
    broadcast, a larger one is joined by host with skewed hosts split.
    """
    pages = pages.drop("text_kept", "n_lines", "n_dropped")
    # The caller's columns travel under names of their own, so that any name of theirs is safe.
    own = [f"c{i}" for i in range(len(pages.columns))]
    cut = pages.select(
        *[F.col(quoted(name)).alias(c) for name, c in zip(pages.columns, own)],
        host.alias("_host"), text.alias("_text"), F.split(text, "\n").alias("_lines"))
    found = keep(
        boilerplate(cut.select("_host", "_lines"), ratio, min_pages, fold_copies), "boilerplate"
    ).withColumnRenamed("_host", "_at")
    joined = cut.join(found, F.col("_host").eqNullSafe(F.col("_at")), "left")
    # Most pages hold none of the marks: one set operation tells, and they stay as they are.
    hits = F.array_intersect(F.transform("_lines", _mark), F.coalesce(
        "_marks", F.array().cast("array<bigint>")))
    kept = F.filter("_lines", lambda x: (F.trim(x) == "") | ~F.array_contains("_hits", _mark(x)))
    none = F.coalesce(F.size("_hits"), F.lit(0)) == 0
    return (
        joined.withColumn("_hits", hits)
        .withColumn("_kept", F.when(none, F.col("_lines")).otherwise(kept))
        .select(
            *own,
            F.when(none, F.col("_text")).otherwise(F.array_join("_kept", "\n")),
            F.coalesce(F.size("_lines"), F.lit(0)).cast("long"),
            F.coalesce(F.size("_lines") - F.size("_kept"), F.lit(0)).cast("long"),
        ).toDF(*pages.columns, "text_kept", "n_lines", "n_dropped")
    )


def op1_line_dedup(spark, sf_dir: str) -> DataFrame:
    """All pages, their lines and hosts taken from html and url."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    # The texts are stored: they are read to count lines and again to drop them.
    lined = keep(pages.select("page_id", host_of(F.col("url")).alias("host"),
                              page_text(F.col("html")).alias("lines")), "lined")
    return drop_boilerplate(lined, F.col("host"), F.col("lines")).select(
        "page_id", "host", F.col("text_kept").alias("text"), "n_lines", "n_dropped"
    )


def _sql() -> str:
    text = f"regexp_replace(html, '{HIDDEN}', ' ', 'g')"
    text = f"regexp_replace({text}, '{BLOCK}', chr(10), 'g')"
    text = f"regexp_replace({text}, '<[^<>]*>', '', 'g')"
    for name, char in ENTITIES:
        text = f"replace({text}, '{name}', '{char.replace(chr(39), chr(39) * 2)}')"
    text = f"trim(regexp_replace({text}, '[ \\t\\r]*\\n[ \\t\\r\\n]*', chr(10), 'g'))"
    host = r"regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)"
    return f"""
WITH cut AS (
  SELECT row_number() OVER () AS r, page_id,
         nullif(regexp_replace(lower({host}), '^www\\.', ''), '') AS host, {text} AS body
  FROM pages
), lines AS (
  SELECT r, host, unnest(string_split(body, chr(10))) AS line,
         generate_subscripts(string_split(body, chr(10)), 1) AS place FROM cut
), totals AS (SELECT host, count(*) AS pages FROM cut GROUP BY host),
counts AS (
  SELECT host, trim(line) AS line, count(DISTINCT r) AS n FROM lines
  WHERE trim(line) <> '' GROUP BY 1, 2
), dropped AS (
  SELECT c.host, c.line FROM counts c JOIN totals t ON c.host IS NOT DISTINCT FROM t.host
  WHERE c.n >= {MIN_PAGES} AND c.n > {RATIO} * t.pages
), marked AS (
  SELECT l.r, l.line, l.place, d.line IS NOT NULL AS gone
  FROM lines l LEFT JOIN dropped d ON l.host IS NOT DISTINCT FROM d.host AND trim(l.line) = d.line
), joined AS (
  SELECT r, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
         coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '') AS text
  FROM marked GROUP BY r
)
SELECT page_id, host, j.text, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped
FROM cut LEFT JOIN joined j USING (r)
"""


SQL = _sql()
