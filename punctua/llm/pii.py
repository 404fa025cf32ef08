"""Personal data in plain and in disguised form, with spans in source characters.

Plain identifiers are found in the text itself. Then transducers rewrite the text: look-alike
characters to ASCII, spelled digits to digits, at/dot disguises to ``@`` and ``.``. Each keeps,
for every character it writes, the source characters it stands for; identifiers found in the
rewritten text are mapped back and added unless a plain span of their kind holds them.

Spans are in code points, the end exclusive. A null text is an empty one and has none. All
searches are linear in the text: a run is entered once, whatever its length.
"""

from __future__ import annotations

import io
import re
import unicodedata
from array import array
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctua.llm import words as W

KINDS = ["email", "ip", "card", "phone"]

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

Span = tuple[int, int]


def emails(text: str) -> list[Span]:
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > free and (text[begin - 1] in "._%+-" or (
            text[begin - 1].isascii() and text[begin - 1].isalnum()
        )):
            begin -= 1
        domain = _DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            free = domain.end()
            found.append((begin, free))
        at = text.find("@", max(at + 1, free))
    return found


def addresses(text: str) -> list[Span]:
    return [
        m.span() for m in _IP.finditer(text)
        if all(len(p) <= 3 and int(p or 0) <= 255
               for p in (part.lstrip("0") for part in m.group().split(".")))
    ]


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    doubled = [2 * v - 9 * (v > 4) for v in values[1::2]]
    return (sum(values[::2]) + sum(doubled)) % 10 == 0


def cards(text: str) -> list[Span]:
    return [
        m.span() for m in _CARD.finditer(text)
        if 14 <= len(d := _digits(m.group())) <= 19 and luhn(d)
    ]


def phones(text: str) -> list[Span]:
    return [m.span() for m in _PHONE.finditer(text) if 10 <= len(_digits(m.group())) <= 15]


FINDERS: dict[str, Callable[[str], list[Span]]] = {
    "email": emails, "ip": addresses, "card": cards, "phone": phones,
}


class Rewritten:
    """A text with the source span of each of its characters.

    Only edits take room: the text is a row of stretches, given by their first places. A straight
    stretch stands for source characters one by one, any other as a whole for one source span.
    """

    def __init__(self, text: str):
        self.text = text
        self.at, self.begin, self.end = (array("q", [0]) for _ in range(3))
        self.straight = array("b", [1])

    def edit(self, edits: Iterable[tuple[int, int, str]]) -> None:
        """Replace spans, given in order; every new character stands for its whole span."""
        made = Rewritten("")
        for kept in (made.at, made.begin, made.end, made.straight):
            kept.pop()
        out, written, upto, stretch = io.StringIO(), 0, 0, 0

        def add(begin: int, end: int, straight: int, text: str) -> None:
            nonlocal written
            made.at.append(written)
            made.begin.append(begin)
            made.end.append(end)
            made.straight.append(straight)
            written += len(text)
            out.write(text)

        def copy(a: int, b: int) -> None:
            nonlocal stretch
            while a < b:
                while stretch + 1 < len(self.at) and self.at[stretch + 1] <= a:
                    stretch += 1
                stop = min(b, self.at[stretch + 1]) if stretch + 1 < len(self.at) else b
                straight = self.straight[stretch]
                begin = self.begin[stretch] + (a - self.at[stretch] if straight else 0)
                add(begin, self.end[stretch], straight, self.text[a:stop])
                a = stop

        for begin, end, new in edits:
            copy(upto, begin)
            if new:
                add(*self.source((begin, end)), 0, new)
            upto = end
        if upto:
            copy(upto, len(self.text))
            self.text = out.getvalue()
            self.at, self.begin, self.end, self.straight = (
                made.at, made.begin, made.end, made.straight)

    def source(self, span: Span) -> Span:
        first = bisect_right(self.at, span[0]) - 1
        last = bisect_right(self.at, span[1] - 1) - 1
        begin = self.begin[first] + (span[0] - self.at[first]) * self.straight[first]
        if self.straight[last]:
            return begin, self.begin[last] + span[1] - self.at[last]
        return begin, self.end[last]


# Letters of other scripts drawn like Latin ones, and what they look like.
LOOK_ALIKES = dict(zip(
    "АВЕКМНОРСТХаеорсухіјѕԁһԛԝΑΒΕΖΗΙΚΜΝΟΡΤΥΧοναıɡ",
    "ABEKMHOPCTXaeopcyxijsdhqwABEZHIKMNOPTYXovaig",
    strict=True,
))
DROPPED = "\u200b\u200c\u200d\u2060\ufeff\u00ad"
DASHES = "\u2010\u2011\u2012\u2013\u2014\u2015\u2212"
DOTS = "\u2024\u3002\uff61\u00b7"


@lru_cache(maxsize=1)
def look_alikes() -> tuple[dict[str, str], re.Pattern]:
    """ASCII form of every look-alike, wide, styled or foreign digit character."""
    table = dict(LOOK_ALIKES)
    table |= dict.fromkeys(DROPPED, "") | dict.fromkeys(DASHES, "-") | dict.fromkeys(DOTS, ".")
    for code in range(0x80, 0x110000):
        char = chr(code)
        kind = unicodedata.category(char)
        if kind == "Zs":
            table[char] = " "
        elif kind == "Nd":
            table[char] = str(unicodedata.digit(char))
        elif unicodedata.decomposition(char).startswith(("<wide>", "<font>", "<small>")):
            plain = unicodedata.normalize("NFKC", char)
            if len(plain) == 1 and plain.isascii():
                table[char] = plain
    return table, re.compile("[" + re.escape("".join(table)) + "]")


def plain_letters(view: Rewritten) -> None:
    table, pattern = look_alikes()
    view.edit((m.start(), m.end(), table[m.group()]) for m in pattern.finditer(view.text))


DIGIT_WORDS = ["zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine"]
_ONE_DIGIT = "(?:" + "|".join(DIGIT_WORDS) + ")"
_SPELLED = re.compile(
    rf"(?<![^\W_])(?:(plus)[ \t-]+)?({_ONE_DIGIT}(?:(?:[ \t-]+|[ \t]+(?:dot|point)[ \t]+)"
    rf"{_ONE_DIGIT})+)(?![^\W_])", re.IGNORECASE,
)
_WORD = re.compile(r"[A-Za-z]+")


def spelled_digits(view: Rewritten) -> None:
    """Runs of at least three digit words become digits, with the dots between them."""
    edits = []
    for run in _SPELLED.finditer(view.text):
        names = list(_WORD.finditer(view.text, *run.span()))
        values = [
            "+" if (w := m.group().lower()) == "plus" else
            str(DIGIT_WORDS.index(w)) if w in DIGIT_WORDS else "." for m in names
        ]
        if sum(v.isdigit() for v in values) < 3:
            continue
        for place, (name, value) in enumerate(zip(names, values)):
            if place:
                edits.append((names[place - 1].end(), name.start(), ""))
            edits.append((*name.span(), value))
    view.edit(edits)


_BRACKETED = re.compile(
    r"(?<![ \t])[ \t]*(?:\([ \t]*(at|dot|@|\.)[ \t]*\)|\[[ \t]*(at|dot|@|\.)[ \t]*\]"
    r"|\{[ \t]*(at|dot|@|\.)[ \t]*\}|<[ \t]*(at|dot|@|\.)[ \t]*>)[ \t]*", re.IGNORECASE,
)
_PART = r"[A-Za-z0-9-]+"
_WORDED = re.compile(
    rf"(?<=[A-Za-z0-9_])([ \t]+at[ \t]+){_PART}((?:(?:[ \t]+dot[ \t]+|\.){_PART})*"
    rf"[ \t]+dot[ \t]+[A-Za-z]{{2,}})(?![^\W_])", re.IGNORECASE,
)
_DOT = re.compile(r"[ \t]+dot[ \t]+", re.IGNORECASE)


def at_and_dot(view: Rewritten) -> None:
    """``(at)``, ``[dot]`` and the like; bare words only as ``name at host dot com``."""
    view.edit(
        (m.start(), m.end(), "@" if m.group(m.lastindex).lower() in ("at", "@") else ".")
        for m in _BRACKETED.finditer(view.text)
    )
    edits = []
    for m in _WORDED.finditer(view.text):
        edits.append((*m.span(1), "@"))
        edits += [(*d.span(), ".") for d in _DOT.finditer(view.text, *m.span(2))]
    view.edit(edits)


TRANSDUCERS = [plain_letters, spelled_digits, at_and_dot]


def disguised(text: str, plain: dict[str, list[Span]]) -> list[tuple[str, int, int]]:
    """Spans found only after rewriting the text."""
    view = Rewritten(text)
    for rewrite in TRANSDUCERS:
        rewrite(view)
    if view.text == text:
        return []
    added = []
    for kind, find in FINDERS.items():
        # Plain spans come in order and apart, so only the last that begins before may hold another.
        heads = [a for a, _ in plain[kind]]
        for span in find(view.text):
            begin, end = view.source(span)
            before = bisect_right(heads, begin) - 1
            if before < 0 or plain[kind][before][1] < end:
                added.append((kind, begin, end))
    return added


# Every match of the spelled-digit and worded patterns holds one of these between ASCII separators.
_TELLING = [*DIGIT_WORDS, "dot", "point"]
_TELLING_HASHES = W.hash_spans(
    np.frombuffer("".join(_TELLING).encode(), np.uint8),
    *(lambda n: (np.cumsum(n) - n, np.cumsum(n)))(np.array(list(map(len, _TELLING)))),
)


class Suspects:
    """Which documents of a batch may hold anything, from a few passes over all bytes."""

    def __init__(self, column: pa.Array):
        data, bounds = W.text_bytes(column)
        self.bounds = bounds
        digit = (data >= 48) & (data <= 57)
        after = np.append(digit[1:], False)
        before = np.concatenate(([False], digit[:-1]))[: len(data)]
        self.email = self._any(data == 64)
        self.ip = self._any((data == 46) & before & after)
        totals = np.concatenate(([0], np.cumsum(digit)))
        self.card = totals[bounds[1:]] - totals[bounds[:-1]] >= 14
        self.phone = self._any((data == 43) & after)
        # Two-byte Latin letters are never look-alikes, but for the no-break space and such.
        lead = data >= 0xC4
        lead |= data == 0xC2
        self.odd = self._any(lead)
        opening = np.isin(data, np.frombuffer(b"([{<", np.uint8))
        self.odd |= self._any(opening)
        words = W.split_words(column, W.ALPHANUMERIC)
        sums = np.concatenate(([0], np.cumsum(np.isin(words.hashes, _TELLING_HASHES))))
        self.odd |= sums[words.bounds[1:]] > sums[words.bounds[:-1]]

    def _any(self, mark: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(mark)))
        return sums[self.bounds[1:]] > sums[self.bounds[:-1]]


def spans_of(text: str, only: dict[str, bool] | None = None, odd: bool = True) -> list[tuple]:
    """All spans of a text as (kind, start, end, plain), by start, then kind."""
    plain = {
        kind: find(text) if only is None or only[kind] else []
        for kind, find in FINDERS.items()
    }
    rows = [(kind, a, b, True) for kind, spans in plain.items() for a, b in spans]
    if odd:
        rows += [(*span, False) for span in disguised(text, plain)]
    return sorted(rows, key=lambda r: (r[1], KINDS.index(r[0]), r[2]))


SPANS = "array<struct<kind:string,start:int,end:int,plain:boolean>>"
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                             ("plain", pa.bool_())]))


def find_pii(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``spans`` of every document; ``plain`` marks those of the text itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "text"):
                column, rows = part.column("text"), [[]] * part.num_rows
                suspects = Suspects(column)
                kinds = np.array([getattr(suspects, k) for k in KINDS])
                for row in np.flatnonzero(kinds.any(axis=0) | suspects.odd):
                    only = dict(zip(KINDS, kinds[:, row].tolist()))
                    rows[row] = [
                        dict(zip(("kind", "start", "end", "plain"), span))
                        for span in spans_of(column[row].as_py() or "", only, suspects.odd[row])
                    ]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(rows, _ARROW)], ["doc_id", "spans"]
                )

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return narrow.mapInArrow(run, f"doc_id long, spans {SPANS}")


def _equals(value: str) -> Callable:
    return lambda item: item == value


def op10_pii(spark, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    found = find_pii(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    base = F.filter("spans", lambda s: s["plain"])

    def text(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    return found.select(
        "doc_id",
        *[F.size(F.filter(base["kind"], _equals(kind))).cast("long").alias(f"n_{kind}")
          for kind in KINDS],
        F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"),
    )
