"""WARC round trips and broken archives, min-cut extraction, packing and its tokenizer."""

import gzip
import itertools
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from spendwatch.llm import html as H
from spendwatch.llm import warc as W
from spendwatch.llm.packing import Limits, byte_bpe, pack_documents

from .conftest import duck_over, rows_of, sql_rows

PAGES = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType())])
ODD_PAGES = [
    (1, "http://a/\r\nX: y", "<p>same</p>"), (2, None, "<p>same</p>"), (3, "http://b/é", None), (4, "u", ""),
    (5, "u", "é" * 200_000), (6, "u", "\r\n\r\nWARC/1.1\r\n"), (None, "u", "<p>same</p>"), (None, None, "alone"), (2, None, "<p>same</p>"),
]


@pytest.mark.parametrize("rows", [ODD_PAGES, []], ids=["odd", "empty"])
def test_warc_round_trip(spark, rows):
    pages = spark.createDataFrame(rows, PAGES)
    names, want = sql_rows(duck_over(pages=pages), W.warc_sql())
    got = W.warc_round_trip(pages)
    if any(r[0] is None for r in rows):  # an id-less page without a group is a response, too
        assert sum(r["page_id"] is None for r in got.collect()) == 2
    assert sorted(got.columns) == names and rows_of(got) == want


def test_warc_archives_are_plain_gzip_with_a_member_a_record(spark):
    pages = spark.createDataFrame(ODD_PAGES, PAGES).coalesce(1)
    path = W.write_warc(pages, archive_bytes=300)
    files = [bytes(r["content"]) for r in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect()]
    assert len(files) > 1  # an archive closes when it is full
    records = [m for f in files for m in W.members(f) if m]
    assert len(records) == len(ODD_PAGES)
    assert sorted(b"".join(gzip.decompress(f) for f in files)) == sorted(b"".join(records))
    back = {r["page_id"]: r["payload"] for r in W.read_warc(spark, path, with_payload=True).collect() if r["record_type"] == "response"}
    assert bytes(back[5]) == ("é" * 200_000).encode() and bytes(back[6]) == b"\r\n\r\nWARC/1.1\r\n"


def test_small_payloads_are_all_responses(spark):
    got = W.warc_round_trip(spark.createDataFrame(ODD_PAGES, PAGES), min_dedup_bytes=12).collect()
    assert all(r["record_type"] == "response" for r in got)


def test_broken_records_are_refused():
    good = W.build_record(1, "u", b"payload", None)
    assert W.parse_record(good)["payload"] == b"payload"
    shorter = re.sub(rb"Content-Length: (\d+)\r\n\r\nHTTP", lambda m: b"Content-Length: %d\r\n\r\nHTTP" % (int(m[1]) - 1), good)
    assert shorter != good
    for bad in (good.replace(b"payload", b"pay1oad"), good[:-3], shorter, b"junk"):
        with pytest.raises((W.WarcError, KeyError, ValueError)):
            W.parse_record(bad)
    with pytest.raises(W.WarcError):
        list(W.members(W.member(good)[:-9]))


def _cut_cost(unary, edges, side):
    cost = sum(u for u, s in zip(unary, side) if u > 0 and not s) + sum(-u for u, s in zip(unary, side) if u < 0 and s)
    return cost + sum(c for a, b, c in edges if side[a] != side[b])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(-9, 9), min_size=1, max_size=7), st.data())
def test_min_cut_is_least(unary, data):
    n = len(unary)
    edges = [(a, b, data.draw(st.integers(1, 6))) for a in range(n) for b in range(a + 1, n) if data.draw(st.booleans())]
    best = min(_cut_cost(unary, edges, s) for s in itertools.product([False, True], repeat=n))
    assert _cut_cost(unary, edges, H.min_cut(unary, edges)) == best


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a = "<p>no</p>";</script><style>p{}</style></head><body class="sidebar">
<header><h2>Site name</h2><nav><ul><li><a href="/">Home</a></li><li>About</li></ul></nav></header>
<div class="cookie-notice"><p>We use cookies to make this site work for you, please accept them all now.</p></div>
<div class="layout has-sidebar"><article><header class="entry-header"><h1>A &amp; B</h1></header><p>First   paragraph
with <b>bold</b> and&nbsp;<a href="x">a link</a> in it.<br>Next line.<p>Second paragraph, never closed.
<div class="ad"><p>Buy this advert now, it is a very good advert for you.</p></div><ul><li>One item of the text</li><li>Two &lt;3</li></ul>
<!-- <p>comment</p> --><form><label>Mail</label><input><button>Send</button></form></article>
<aside><p>Other stories that you may like to read on this site today.</p></aside>
<section id="comments"><div class="comment"><p>I liked this story a lot, thank you for it.</p></div></section></div>
<footer>&copy; Example</footer></body></html>"""


def test_main_text_of_a_page():
    want = ["A & B", "First paragraph with bold and a link in it. Next line.", "Second paragraph, never closed.", "One item of the text", "Two <3"]
    assert H.main_text(PAGE).split("\n\n") == want


@pytest.mark.parametrize("html", [None, "", "plain < text & more", "<p", "<p>a</div></p></b>", "<!--", "<script>", "<a href='x>y", "<p>" * 3000 + "deep"])
def test_odd_markup(html):
    assert isinstance(H.main_text(html), str)


def test_long_page_and_extract(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (3, "v", "<article>" + "".join(f"<p>paragraph number {i} here</p>" for i in range(5000)))]
    got = H.extract_text(spark.createDataFrame(rows, PAGES)).collect()
    assert len(got) == 4 and {r["n_chars"] for r in got if r["page_id"] == 2} == {0}
    long = next(r["text"] for r in got if r["page_id"] == 3)
    assert long.count("\n\n") == 4999
    assert H.extract_text(spark.createDataFrame([], PAGES)).collect() == []


TEXTS = ["", " ", "a  b", " a b ", "don't <|endoftext|> stop", "x\n\n\ny", "12 ３４ é́ ñ 日本 語", "a" + " " * 6000 + "b", "\x1c a\x85", "word " * 3000]


@pytest.mark.parametrize("text", TEXTS)
def test_ids_are_the_tokenizers(text):
    bpe = byte_bpe()
    assert bpe.ids(text).tolist() == bpe.exact.encode(text, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=80))
def test_ids_of_any_text(text):
    bpe = byte_bpe()
    assert bpe.ids(text).tolist() == bpe.exact.encode(text, add_special_tokens=False).ids


def test_long_texts_are_cut_at_borders(monkeypatch):
    from spendwatch.llm import packing

    bpe, text = byte_bpe(), "some words here, and more of them. " * 50
    monkeypatch.setattr(packing, "STRETCH", 40)
    assert bpe.ids(text).tolist() == bpe.exact.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("limits", [Limits(), Limits(segments=4), Limits(loss=700)])
def test_packing_places_each_id_once(docs_of, limits):
    texts = {i: "tok " * ((i * 37) % 900) + f"end {i}" for i in range(150)}
    texts |= {200: None, 201: "", 202: "long text " * 9000}
    docs = docs_of([*texts.items(), (200, None)])
    rows = pack_documents(docs, limits).collect()
    bpe = byte_bpe()
    ids = {d: np.append(bpe.ids(t or "").astype("<u4"), np.uint32(0)).astype("<u4") for d, t in texts.items()}
    seen = {}
    for r in rows:
        piece = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert zlib.crc32(piece.tobytes()) == r["ids_crc32"] and r["doc_tokens"] == len(ids[r["doc_id"]])
        seen.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
    for d, spans in seen.items():
        copies = 2 if d == 200 else 1
        assert sum(n for _, n in spans) == copies * len(ids[d])
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append(r)
    used = 0
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= limits.tokens and len(pieces) <= limits.segments and sum(r["loss_tokens"] for r in pieces) <= limits.loss
        used += at
    if limits == Limits():
        assert all(n & (n - 1) == 0 for n in (sum(r["length"] for r in p) for p in sequences.values()))


def test_prompt_tokens_bear_no_loss(docs_of):
    from pyspark.sql import functions as F

    docs = docs_of([(i, "a b c d e f g h") for i in range(60)])
    rows = pack_documents(docs, Limits(loss=40), prompt_tokens=F.lit(4)).collect()
    assert sum(r["loss_tokens"] for r in rows) == sum(r["length"] for r in rows) - 60 * 4
    assert pack_documents(docs_of([])).collect() == []
