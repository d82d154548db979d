"""Operators on single texts and pages: 2, 4, 5 and 8, against brute-force versions."""

import hashlib
import os
import random
import re
import time
import zlib

import numpy as np
import public_tokenizers as tokenizers
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from parley.llm import bpe, lineblock, pieces, tokenfiles, winnow, words
from parley.llm.common import text_blocks
from parley.session import scratch_path

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, n_words int, ids string, shard string, `__t` int"


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def odd_texts():
    rnd = random.Random(5)
    bits = [" ", "  ", "\n", "\t", " ", "　", " ", "a", "B", "é", "ß", "1", "٣", "'s", "'ll", "!", "--", "…", "x́", "中", "文字", "😀", "\x85", "\x1c", "\x00", " the", "'", "\r\n"]
    out = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 40))) for _ in range(300)]
    return out + ["", None, "a" * 700, "ab" * 400 + " é" * 300, "<|endoftext|>", " ".join(["x" * 90] * 3), "word " * 60_000, "same", "same"]


def rows(spark, texts):
    return spark.createDataFrame([(i if i != 3 else None, t, 1, "x", "y", 2) for i, t in enumerate(texts)], SCHEMA)


def test_words_match_the_pattern():
    texts = odd_texts()
    for first, end, data, offsets in text_blocks(pa.array(texts, pa.string()), 5000):
        w = words.Words(data, offsets)
        for i in range(end - first):
            assert [x.decode() for x in w.list(int(w.at[i]), int(w.at[i + 1]))] == words_of(texts[first + i])


# ---------------------------------------------------------------- 2: decontamination
def contaminated(text, items):
    """(n_hit, item ids) by comparing every window."""
    doc, hit, ids = words_of(text), set(), set()
    for item_id, item in items:
        item = words_of(item)
        n = min(10, len(item))
        windows = {tuple(item[i : i + n]) for i in range(len(item) - n + 1)} if n else set()
        for i in range(len(doc) - n + 1):
            if windows and tuple(doc[i : i + n]) in windows:
                hit.update(range(i, i + n))
                ids.add("" if item_id is None else str(item_id))
    return len(hit), sorted(ids)


@pytest.mark.parametrize("index_bytes", [winnow.INDEX_BYTES, 400])
def test_decontaminate_equals_brute_force(spark, index_bytes):
    rnd = random.Random(1)
    vocab = ["a", "b", "É", "c9", "d"]
    make = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    items = [(i, make(rnd.randint(1, 30))) for i in range(25)] + [(3, make(12)), (None, make(11)), (90, None), (91, ""), (92, "?!"), (93, "x " * 40)]
    texts = [make(rnd.randint(0, 80)) for _ in range(60)] + [None, "", "!!", "x " * 500, items[4][1].upper(), make(20_000)]
    texts += [make(5) + ", " + (items[k][1] or "").replace(" ", "\n") + "." for k in range(10)] + texts[:2]
    docs = rows(spark, texts)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = winnow.decontaminate(docs, bench, index_bytes=index_bytes).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_hit, tuple(r.item_ids)) for r in got) == sorted(
        (i == 3, 0 if i == 3 else i, len(words_of(t)), *(lambda x: (x[0], tuple(x[1])))(contaminated(t, items))) for i, t in enumerate(texts))
    assert all(r.n_items == len(r.item_ids) for r in got)
    left = winnow.clean_documents(docs, bench)
    assert left.schema == docs.schema and left.count() == sum(not r.n_hit for r in got)


def test_decontaminate_empty_tables(spark):
    docs, bench = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "item_id long, text string")
    assert winnow.decontaminate(docs, bench).count() == 0
    assert [(r.n_words, r.n_hit) for r in winnow.decontaminate(rows(spark, ["a b"]), bench).collect()] == [(2, 0)]


def test_winnowing_guarantees_a_shared_print():
    rnd = random.Random(2)
    for _ in range(200):
        shared = [rnd.choice("abcdef") for _ in range(winnow.SPAN)]
        texts = [" ".join([rnd.choice("abcdef") for _ in range(rnd.randint(0, 30))] + shared + [rnd.choice("abcdef") for _ in range(rnd.randint(0, 30))]) for _ in range(2)]
        prints = []
        for t in texts:
            raw = t.encode()
            prints.append(set(winnow.fingerprints(words.Words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)])), winnow.SPAN, winnow.GRAM)[1].tolist()))
        assert prints[0] & prints[1]


# ---------------------------------------------------------------- 4: byte-level BPE
RANKS = tokenizers.path("byte_bpe_50k.tiktoken")


def reference_encoding():
    return tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


def test_encode_decode_equals_library(spark):
    texts, want = odd_texts(), reference_encoding()
    got = bpe.encode_decode(rows(spark, texts), RANKS, tokenizers.PATTERN).collect()
    own = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256, tuple(r.ids)) for r in got}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        ids = want.encode_ordinary(t or "")
        assert (None if i == 3 else i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest(), tuple(ids)) in own
    assert bpe.encode_decode(spark.createDataFrame([], SCHEMA), RANKS, tokenizers.PATTERN).count() == 0


def test_long_words_merge_like_short_ones():
    ranks = bpe.Ranks(bpe.read_ranks(RANKS))
    rnd = random.Random(7)
    for n in (2, 5, 40, 64):
        for _ in range(30):
            w = "".join(rnd.choice("aeiostThnre") for _ in range(n)).encode()
            if w not in ranks.ranks:
                assert ranks.encode([w])[0] == ranks._long(w).tobytes()


def test_pieces_without_a_table_and_with_a_full_one(monkeypatch):
    monkeypatch.setattr(pieces, "TABLE_PIECES", 10)
    want = reference_encoding()
    encoder = bpe.Encoder(bpe.read_ranks(RANKS), tokenizers.PATTERN)
    texts = [t or "" for t in odd_texts()[:200]]
    for first, end, data, offsets in text_blocks(pa.array(texts), 500):
        ids, at = encoder.pieces.block(data, offsets)
        for i in range(first, end):
            assert ids[at[i - first] : at[i - first + 1]].tolist() == want.encode_ordinary(texts[i])


# ---------------------------------------------------------------- 8: token files
def test_token_files_round_trip(spark):
    path = tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    texts = odd_texts()
    docs = spark.createDataFrame([(1000 - i, x, 1, "x", "y", 2) for i, x in enumerate(texts)], SCHEMA)
    folder = scratch_path(spark, "token-test")
    manifest = tokenfiles.write_tokens(docs, path, folder, end_id=2)
    got = {r.doc_id: r for r in tokenfiles.read_tokens(manifest).collect()}
    start = 0
    for place, (i, x) in enumerate(sorted((1000 - i, x) for i, x in enumerate(texts))):
        ids = t.encode(x or "", add_special_tokens=False).ids + [2]
        assert (got[i].place, got[i].start, got[i].n_tokens, got[i].ids_crc32) == (place, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert len(got) == len(texts)
    local = folder.removeprefix("file://").removeprefix("file:")
    kinds = {f.rpartition(".")[2] for f in os.listdir(local) if not f.endswith(".crc")}
    assert kinds == {"bin", "idx", "doc"}
    assert sum(os.path.getsize(f"{local}/{f}") for f in os.listdir(local) if f.endswith(".bin")) == 2 * start


def test_token_files_ties_nulls_and_empty_tables(spark):
    path = tokenizers.path("byte_bpe_50k.json")
    docs = spark.createDataFrame([(None, "n", 1, "", "", 1), (5, "b", 1, "", "", 1), (5, "b", 1, "", "", 1), (5, None, 1, "", "", 1)], SCHEMA)
    got = tokenfiles.read_tokens(tokenfiles.write_tokens(docs, path, scratch_path(spark, "token-test"), 2)).orderBy("place").collect()
    assert [r.doc_id for r in got] == [None, 5, 5, 5] and sorted(r.n_tokens for r in got) == [1, 2, 2, 2]
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1]]
    empty = tokenfiles.write_tokens(spark.createDataFrame([], SCHEMA), path, scratch_path(spark, "token-test"), 2)
    assert empty.count() == 0 and tokenfiles.read_tokens(empty).count() == 0


# ---------------------------------------------------------------- 5: main text
PAGE = """<!DOCTYPE html><html><head><title>T</title><meta x><body class="has-sidebar"><header class="site-header"><h1>Site</h1><nav>menu</nav></header>
<div class="cookie-notice"><p>We use cookies</p></div><div id="wrap" class="page"><aside class="sidebar">side<p>x</aside><main><article class="post"><header><h2>Title &amp; more</h2></header><p>One&nbsp;two
 three<br>four<p>Five <b>si</b>x<div class="ad">buy <div>this</div></div><ul><li>a<li>b</ul><form><input><label>mail</label></form><script>if (a < b) "</p>"</script>
<section id="comments"><article class="comment"><p>reader says</p></article></section></article></main><div class="related"><p>rel</div></div><footer><p>foot</footer>"""


@pytest.mark.parametrize("html, want", [
    (PAGE, "Title & more\n\nOne two three four\n\nFive six\n\na\n\nb"),
    (PAGE.replace("article", "section").replace("main", "div"), None),
    (None, ""), ("", ""), ("plain &lt; text", "plain < text"), ("<p>a<!-- no end", "a"), ("<article><p>cut o", "cut o"),
    ("<article><p>a</article><p>out", "a"), ("<form><article><p>a</article></form>", "a"),
    ("<div>top</div><div role=main><p>a</div><div>end</div>", "a"),
    ("<article><p>a<div class='reader-comments'><p>b</div><p class=notice>c<p>d</article>", "a\n\nd"),
    ("<nav><a href='/'>x</a></nav><p>" + "long words " * 20 + "<p>s", "long words " * 19 + "long words\n\ns"),
])
def test_main_text(html, want):
    got = lineblock.main_text(html)
    if want is not None:
        assert got == want
    else:
        assert "cookies" not in got and "reader" not in got and "menu" not in got


@pytest.mark.parametrize("html, want", [
    ("<h2 id='related-work'>a</h2><p>b", "a\n\nb"), ("<section id='social-impact'><p>a</section><p>b", "a\n\nb"),
    ("<section id='discussion'><h2>a</h2></section><p>b", "a\n\nb"), ("<h3 id=search>a</h3><p class='alert-levels'>b", "a\n\nb"),
    ("<section class='related-posts'><p>a</section><p>b", "b"), ("<section id='social-share'><p>a</section><p>b", "b"),
    ("<section id='comments'><p>a</section><p class=notice>c<p>b", "b"), ("<div class='related-box'><p>a</div><p>b", "b"),
])
def test_slugs_of_an_article_are_not_its_surroundings(html, want):
    assert lineblock.main_text(f"<article>{html}</article>") == want
    assert lineblock.main_text(f"<div class='page-with-sidebar'><p>{'long words ' * 20}</p></div>") == " ".join(["long words"] * 20)


@pytest.mark.parametrize("html, want", [
    ("<div class='social-impact'><p>a</div><p>b", "a\n\nb"), ("<div id='search-methods'>a</div><p>b", "a\n\nb"),
    ("<ul class='related-work'><li>a</ul><p>b", "a\n\nb"), ("<table class='menu-prices'><tr><td>a</table><p>b", "a\n\nb"),
    ("<figure class='banner-year'>a</figure><p>b", "a\n\nb"), ("<div class='fb-comments'>a</div><p>b", "b"),
    ("<div class='ad-728x90'>a</div><p>b", "b"), ("<div class='comments-section'>a</div><div id='comment-12'>c</div><p>b", "b"),
    ("<ul class='social-share'><li>a</ul><p>b", "b"), ("<div class='newsletter-cta'>a</div><p>b", "b"), ("<div class='alert alert-info'>a</div><p>b", "b"),
])
def test_slugs_of_wrappers_are_judged_by_their_last_word(html, want):
    assert lineblock.main_text(f"<article>{html}</article>") == want


LONG = ["long words of the article " * 8 + str(i) for i in range(8)]
ADVERT = "<div class='advert'><p>buy<p>this<p>now</div>"


@pytest.mark.parametrize("before, inner, after", [
    ("", ADVERT, ["closing one", "closing two"]), ("", "", ["the end"]),
    ("<div><a href=/>home</a></div><div><a href=/a>about</a></div><div><a href=/b>contact</a></div>", ADVERT * 2, ["x", "y"]),
    ("<p>Site</p><ul><li><a>a</a><li><a>b</a><li><a>c</a></ul>", "", ["closing"]),
])
@pytest.mark.parametrize("wrapper", ["<div>{}</div>", "<table><tr><td><div class='page-with-sidebar'>{}</div></table>", "<div><div class='entry-header'><h1>Title</h1></div><div>{}</div></div>"])
def test_pages_without_article_lose_no_text_by_size(before, inner, after, wrapper):
    """Inner adverts, lines of links, short openings and closings, at any size."""
    links = "<p><a>a line that is one link</a></p>"
    body = wrapper.format("<p>by a<p>on a day<p>" + "<p>".join(LONG) + inner + links * 4 + "".join(f"<p>{x}" for x in after))
    want = ["by a", "on a day", *LONG, *["a line that is one link"] * 4, *after]
    if "Title" in wrapper:
        want = ["Title", *want]
    got = lineblock.main_text(f"<body>{before}{body}<ul><li><a>x</a><li><a>y</a><li><a>z</a></ul><p>(c) me</body>")
    assert got == "\n\n".join(want)


@pytest.mark.parametrize("html", ["<div>" * 40_000 + "text", "<b>" * 40_000 + "text", "<b>" * 20_000 + "<div>x</div>" * 20_000, "<ul>" + "<b>" * 20_000 + "<li>x</li>" * 20_000, "<div>x" * 40_000, "<form>" * 20_000 + "<article>x" * 20_000, "<article>" + "<p><b>x" * 40_000])
def test_unclosed_elements_take_linear_time(html):
    start = time.process_time()
    assert lineblock.main_text(html)
    assert time.process_time() - start < 2


@pytest.mark.parametrize("raw", ["<svg class='icon'/>", "<math/>", "<canvas />", "<object data=x />", "<svg><svg>x</svg>y</svg>", "<object>x<object>y</object>z</object>", "<svg>", "<svg><svg/>x</svg>"])
def test_raw_elements_end_where_they_end(raw):
    assert lineblock.main_text(f"<article><p>a {raw} b</p><p>c</article>") == "a b\n\nc"
    assert lineblock.main_text(f"<article><p>a {raw} b</p><svg>i</svg><p>c</article>") == "a b\n\nc" or raw == "<svg>"


def test_extract_keeps_every_row(spark):
    long = "<article>" + "<p>word &amp; word</p>" * 30_000 + "</article>"
    pages = spark.createDataFrame([(1, "u", PAGE, 3), (1, "u", PAGE, 3), (None, None, None, 4), (2, "v", long, 5)], "page_id long, url string, html string, n_chars int")
    got = lineblock.extract(pages).orderBy("page_id").collect()
    assert [r.page_id for r in got] == [None, 1, 1, 2] and got[0].text == "" and got[1] == got[2]
    assert got[3].text == "\n\n".join(["word & word"] * 30_000) and all(r.n_chars == len(r.text) for r in got)
    assert lineblock.extract(pages.limit(0)).count() == 0


def test_surge_and_dive():
    assert lineblock.stretches([0, 5, 9, 0, 7, 0, 0, 0, 4, 0], 10) == [(1, 5)]
    assert lineblock.stretches([3, 0, 0, 0, 30], 10) == [(4, 5)]
    assert lineblock.stretches([], 1) == []
