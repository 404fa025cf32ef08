"""Line dedup, BPE, decontamination, personal data and token codes against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

import helpers as H
from punctua.llm import bpe, chats, codes, lines, pii, postings
from punctua.llm import words as W
from pyspark.sql import functions as F

ODD_TEXTS = [None, "", " ", "a", "A b", "x" * 30_000, " " * 20_000, "é́ ß\x1c\n\t'S 's",
             "word " * 5_000, "same", "same", "\n\n\n", "12 34,56"]


def test_words_and_hashes():
    dice = random.Random(1)
    texts = ["".join(dice.choice("aB c\té,1\n") for _ in range(dice.randrange(30))) for _ in range(500)]
    texts[3] = None
    found = W.split_words(pa.array(texts, pa.string()), W.NOT_SPACE)
    seen = {}
    for i, text in enumerate(texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", H.lowered(text))
        hashes = found.hashes[found.bounds[i] : found.bounds[i + 1]].tolist()
        assert len(words) == len(hashes)
        for word, value in zip(words, hashes):
            assert seen.setdefault(word, value) == value
    assert len(set(seen.values())) == len(seen)
    long = "q" * (W.HASH_BYTES + 5)
    twice = W.split_words(pa.array([f"a {long} b", f"{long}"]), W.NOT_SPACE)
    assert twice.hashes[1] == twice.hashes[3]


def test_shingles_of_short_and_empty_documents():
    words = W.split_words(pa.array(["", "a", "a b", "a b a b a b", None, "b a"]), W.NOT_SPACE)
    flat, bounds = W.shingle_hashes(words, 3)
    assert np.diff(bounds).tolist() == [0, 1, 1, 2, 0, 1]
    assert len(W.shingle_hashes(W.split_words(pa.array(["a b"]), W.NOT_SPACE), 9)[0]) == 1


@pytest.fixture(scope="module")
def plain_bpe():
    import public_tokenizers
    import tiktoken

    own = bpe.ranks(bpe.default_ranks())
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN,
                             mergeable_ranks=own.ranks, special_tokens={})


def test_bpe_equals_tiktoken(plain_bpe):
    dice = random.Random(2)
    letters = list("aeslmtdrv''''  \n\t12.!?- é\x1c\x85中३²🙂")
    texts = ODD_TEXTS + ["".join(dice.choice(letters) for _ in range(dice.randrange(40)))
                         for _ in range(3000)]
    own = bpe.ranks(bpe.default_ranks())
    ids, bounds = own.encode(pa.array(texts, pa.string()))
    data, places = own.decode(ids, bounds)
    for i, text in enumerate(texts):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == plain_bpe.encode_ordinary(text or "")
        assert data[places[i] : places[i + 1]].tobytes().decode() == (text or "")


def test_bpe_frames_keep_other_columns(spark, plain_bpe):
    path = bpe.default_ranks()
    docs = H.documents(spark, ODD_TEXTS).withColumn("ids", F.lit("mine"))
    coded = bpe.decode(bpe.encode(docs, path), path).collect()
    for row in coded:
        assert row["decoded"].decode() == (row["text"] or "")
        assert row["ids"] == plain_bpe.encode_ordinary(row["text"] or "")
        tokens = [plain_bpe.decode_single_token_bytes(i) for i in row["ids"]]
        assert row["offsets"] == [sum(map(len, tokens[:k])) for k in range(len(tokens))] \
            if len(tokens) < 100 else True
    digests = {r["doc_id"]: r for r in bpe.round_trip(docs, path).collect()}
    for row in coded:
        packed = np.array(row["ids"], "<u4").tobytes()
        assert digests[row["doc_id"]]["ids_sha256"] == hashlib.sha256(packed).hexdigest()
        assert digests[row["doc_id"]]["n_tokens"] == len(row["ids"])
    assert all(r["restored"] for r in bpe.encode_checked(docs, path).collect())
    assert bpe.encode(docs.limit(0), path).count() == 0


def contaminated(texts, items, window):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    phrases = {}
    for item, text in items:
        words = pattern.findall(H.lowered(text))
        size = min(window, len(words))
        for at in range(len(words) - size + 1 if size else 0):
            phrases.setdefault(tuple(words[at : at + size]), set()).add("" if item is None else str(item))
    out = []
    for text in texts:
        words, hit, found = pattern.findall(H.lowered(text)), set(), set()
        for phrase, names in phrases.items():
            for at in range(len(words) - len(phrase) + 1):
                if tuple(words[at : at + len(phrase)]) == phrase:
                    hit |= set(range(at, at + len(phrase)))
                    found |= names
        out.append((len(words), len(hit), sorted(found)))
    return out


@pytest.mark.parametrize("pass_bytes", [1 << 20, 60])
def test_decontamination_equals_brute_force(spark, pass_bytes):
    dice = random.Random(3)
    texts = ODD_TEXTS + [" ".join(dice.choice("a b c The é".split()) for _ in range(dice.randrange(25)))
                         for _ in range(120)]
    items = [(i, " ".join(dice.choice("a b c the É é".split()) for _ in range(dice.randrange(9))))
             for i in range(12)] + [(None, "a b c a"), (50, None), (51, ""), (3, "a, b-c"), (3, "a, b-c")]
    wanted = contaminated(texts, items, 4)
    got = postings.decontaminate(
        H.documents(spark, texts), spark.createDataFrame(items, "item_id long, text string"),
        window=4, pass_bytes=pass_bytes)
    rows = {r["doc_id"]: r for r in got.collect()}
    assert [(rows[i]["n_words"], rows[i]["n_hit"], rows[i]["items"]) for i in range(len(texts))] == wanted
    assert all(rows[i]["contaminated"] == bool(w[1]) for i, w in enumerate(wanted))


def test_decontamination_of_empty_tables_and_repeated_rows(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = H.documents(spark, ["a b", "a b", None], ids=[7, 7, None])
    assert [r["n_hit"] for r in postings.decontaminate(docs, none).collect()] == [0, 0, 0]
    some = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert sorted(r["n_hit"] for r in postings.decontaminate(docs, some).collect()) == [0, 2, 2]
    assert postings.decontaminate(docs.limit(0), some).count() == 0


def test_proximity(spark):
    docs = H.documents(spark, ["x rare y common z", "rare " + "w " * 30 + "common", "common"])
    index = postings.keep(postings.build_index(docs), "index")
    items = spark.createDataFrame([(1, "rare common")], "item_id long, text string")
    found = postings.proximity_hits(index, items, distance=5, rarest=2).collect()
    assert [(r["doc_id"], r["item"]) for r in found] == [(0, "1")]


@pytest.mark.parametrize("parts", [1, 5])
def test_proximity_does_not_depend_on_blocks(spark, parts):
    texts = ["rare x mid y common", "common " * 9 + "other", "mid common", "other " * 9 + "last",
             "rare " + "w " * 30 + "mid common"]
    docs = H.documents(spark, texts).repartitionByRange(parts, "doc_id")
    index = postings.keep(postings.build_index(docs), "index")
    items = spark.createDataFrame(
        [(1, "rare mid common other last"), (2, "rare mid common nowhere"), (3, "nowhere")],
        "item_id long, text string")
    found = postings.proximity_hits(index, items, distance=5).collect()
    # Item 1: last stands alone. Item 2: a term the documents do not hold does not matter.
    assert [(r["doc_id"], r["item"], r["position"]) for r in found] == [(0, "2", 0)]


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_spans(text):
    rows = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            fits = {
                "email": True, "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else 0,
                "card": 14 <= len(digits) <= 19 and pii.luhn(digits), "phone": 10 <= len(digits) <= 15,
            }[kind]
            if fits:
                rows.append((kind, *m.span()))
    return sorted(rows, key=lambda r: (r[1], pii.KINDS.index(r[0])))


def test_plain_identifiers_equal_the_patterns(spark):
    dice = random.Random(4)
    texts = ODD_TEXTS + ["".join(dice.choice(letters) for _ in range(dice.randrange(60)))
                         for letters in ("a@.b-_", "12.3.0255", "+1 2(3)4-5.", "4 1-1é@.+a")
                         for _ in range(500)] + ["é 4111 1111 1111 1111, a.b@c.de +1 (988) 555-2485"]
    got = {r["doc_id"]: r["spans"] for r in pii.find_pii(H.documents(spark, texts)).collect()}
    for i, text in enumerate(texts):
        plain = [(s["kind"], s["start"], s["end"]) for s in got[i] if s["plain"]]
        assert plain == base_spans(text)


@pytest.mark.parametrize("text,kind,part", [
    ("mail jоhn.smith＠exаmple․com now", "email", "jоhn.smith＠exаmple․com"),
    ("ask john (at) example [dot] com.", "email", "john (at) example [dot] com"),
    ("jane at mail dot example dot org!", "email", "jane at mail dot example dot org"),
    ("is one nine two dot one six eight dot one dot two zero ok", "ip",
     "one nine two dot one six eight dot one dot two zero"),
    ("pay ４１１１ １１１１ １１１１ １１１１", "card", "４１１１ １１１１ １１１１ １１１１"),
    ("plus one two three four five six seven eight nine zero one", "phone",
     "plus one two three four five six seven eight nine zero one"),
])
def test_disguised_identifiers_map_back(text, kind, part):
    assert [(k, text[a:b], plain) for k, a, b, plain in pii.spans_of(text)] == [(kind, part, False)]


def test_the_filter_loses_no_disguised_identifier(spark):
    texts = [
        "eight point eight point eight point eight", "is One point one Point one point one ok",
        "×one dot two dot three dot four×", "call plus one two-three four five six seven eight nine zero one",
        "mail jоhn.smith＠exаmple․com now", "ask john (at) example [dot] com.",
        "jane at mail dot example dot org!", "pay ４１１１ １１１１ １１１１ １１１１",
        "is one nine two dot one six eight dot one dot two zero ok",
    ]
    found = {r["doc_id"]: r["spans"] for r in pii.find_pii(H.documents(spark, texts)).collect()}
    for i, text in enumerate(texts):
        wanted = pii.spans_of(text)
        assert wanted and [tuple(s) for s in found[i]] == wanted


def test_prose_has_no_disguised_identifiers():
    for text in ("look at this dot", "one or two (at) most", "see <dot>", "at three dot four"):
        assert pii.spans_of(text) == []


def test_token_codes_give_every_token_back(spark, tmp_path):
    texts = ODD_TEXTS + ["<|endoftext|> H̱ É, é! 's", "A,b;c"]
    docs = H.documents(spark, texts, ids=[*range(len(texts) - 1, 0, -1), None])
    path = str(tmp_path / "codes")
    codes.write(docs, path, codes.default_vocabulary())
    segments = codes.read(spark, path)
    tokenizer = codes.tokenizer(codes.default_vocabulary())
    order = sorted(range(len(texts)), key=lambda i: -i)
    start, everything = 0, []
    rows = sorted(codes.digests(segments).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == [None, *range(1, len(texts))]
    for row, i in zip(rows, order):
        ids = [*tokenizer.encode(texts[i] or "", add_special_tokens=False).ids, codes.END]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (start, len(ids), crc)
        start += len(ids)
        everything += ids
    asked = spark.createDataFrame([(p,) for p in (0, 1, start - 1, start, start // 2, 1)], "place long")
    got = {r["place"]: r["token"] for r in codes.tokens_at(segments, asked).collect()}
    assert got == {p: everything[p] for p in (0, 1, start - 1, start // 2)}


def test_codes_of_wide_ids():
    ids = np.concatenate(([0, 255, 256, 65_535, 65_536, 2**24], np.arange(0, 200_000, 37)))
    made = codes.Codes.of(ids)
    places = np.random.default_rng(0).permutation(len(ids))
    assert (made.get(places) == ids[places]).all() and len(made.chunks) == 4


PAGES = "page_id long, host string, body string, n_lines string"


def test_boilerplate_lines(spark):
    rows = [(i, "h", f"top\nown {i}\n top \n\nmenu {i % 2}", "x") for i in range(40)]
    rows += [(100 + i, None, "top\nz" if i else None, "x") for i in range(3)] + [(200, "one", "a\nb", "x")]
    found = {r["page_id"]: r for r in lines.drop_boilerplate(
        spark.createDataFrame(rows, PAGES), F.col("host"), F.col("body"), 0.6, 2).collect()}
    assert found[7]["text_kept"] == "own 7\n\nmenu 1" and found[7]["n_dropped"] == 2
    assert found[100]["text_kept"] is None and found[100]["n_lines"] == 0
    assert found[101]["text_kept"] == "" and found[200]["text_kept"] == "a\nb"
    assert len(found) == len(rows)
    empty = spark.createDataFrame([], PAGES)
    assert lines.drop_boilerplate(empty, F.col("host"), F.col("body")).count() == 0


def test_page_text_and_host(spark):
    html = "<head><title>T &amp; U</title><style>p{}</style></head><p class='a'>one <b>two</b><br>three</p><!-- c -->"
    row = spark.createDataFrame([(html, "HTTPS://me@WWW.Site.org:80/p?q#f"), (None, "no url")],
                                "html string, url string").select(
        lines.page_text(F.col("html")).alias("text"), lines.host_of(F.col("url")).alias("host")).collect()
    assert row[0]["text"] == "\nT & U\none two\nthree".strip("\n") or "one two\nthree" in row[0]["text"]
    assert row[0]["host"] == "site.org" and row[1]["text"] is None and row[1]["host"] is None


def test_chats_keep_maximal_conversations(spark):
    talk = [("user", "a"), ("bot", "b"), ("user", None), ("bot", "d")]
    rows = [(c, t, *talk[t]) for c, n in ((1, 2), (2, 4), (3, 4), (4, 1)) for t in range(n)]
    rows += [(5, 0, "user", "a"), (5, 1, "bot", "other"), (5, 1, "bot", "other"), (None, 7, None, "lost")]
    rows += [(6, t, "u", str(t)) for t in range(3000)] + [(7, t, "u", str(t)) for t in range(1500)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = chats.render(frame).collect()
    assert sorted({r["conv_id"] for r in found if r["conv_id"] is not None}) == [2, 5, 6]
    assert [r["text"] for r in found if r["conv_id"] is None] == ["<||>\nlost<|end|>\n"]
    two = next(r for r in found if r["conv_id"] == 2)
    assert two["n_turns"] == 4 and two["text"].startswith("<|user|>\na<|end|>\n<|bot|>\nb<|end|>\n<|user|>\n<|end|>")
    six = sorted((r["part"], r["text"]) for r in found if r["conv_id"] == 6)
    assert "".join(t for _, t in six) == "".join(f"<|u|>\n{t}<|end|>\n" for t in range(3000))
    assert chats.render(frame.limit(0)).count() == 0


def test_chats_cut_a_large_conversation_by_rows(spark):
    def line(text):
        return f"<|u|>\n{text}<|end|>\n"

    said = [(t, f"{t} {i:05d}") for t in (None, *range(8)) for i in range(500)]
    rows = [(None, t, "u", x) for t, x in said] + [(1, None, "u", f"{i:05d}") for i in range(2500)]
    rows += [(2, None, "u", f"{i:05d}") for i in range(1300)] + [(3, 0, "u", "one")] * 5000
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {}
    for r in sorted(chats.render(frame).collect(), key=lambda r: r["part"]):
        assert 0 < r["text"].count("<|end|>") <= chats.BLOCK
        found.setdefault((r["conv_id"], r["n_turns"]), []).append((r["part"], r["text"]))
    assert set(found) == {(None, 4500), (1, 2500), (3, 1)}
    assert all([p for p, _ in parts] == list(range(len(parts))) for parts in found.values())
    texts = {key[0]: "".join(t for _, t in parts) for key, parts in found.items()}
    assert texts[None] == "".join(line(x) for _, x in said)
    assert texts[1] == "".join(line(f"{i:05d}") for i in range(2500)) and texts[3] == line("one")
