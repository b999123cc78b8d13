"""Fill-in-the-middle: cuts against a plain form, lanes against sums, round trips, odd rows against DuckDB."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spendwatch.llm.fim import FimParams, SkipList, fim_digests, fim_sql, fim_transform, restored, token_widths, transformed

from .conftest import duck_over, rows_of, sql_rows

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=" \t\nabé日\U0001f600\x85\xa0<PSM>", max_size=60), st.integers(1, 9))
def test_widths_are_those_of_the_pattern(text, size):
    assert token_widths(text, size).tolist() == [len(t) for t in TOKEN.findall(text)]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=300), st.integers(0, 5))
def test_every_rank_has_its_place(widths, seed):
    lanes = SkipList(np.array(widths, np.int64), seed)
    places = np.concatenate(([0], np.cumsum(widths, dtype=np.int64)))
    assert [lanes.place(k) for k in range(len(widths) + 1)] == places.tolist()
    assert all(u.sum() == len(widths) and p.sum() == sum(widths) for u, p in zip(lanes.units, lanes.points))


def plain_form(doc_id, text):
    h = [int(hashlib.sha256(f"42:{doc_id}".encode()).hexdigest()[k : k + 8], 16) for k in (0, 8, 16, 24)]
    words = TOKEN.findall(text)
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 50:
        return len(words), "plain", None, None, text
    a, b = sorted((h[0] % (len(words) + 1), h[1] % (len(words) + 1)))
    p, m, s = ("".join(x) for x in (words[:a], words[a:b], words[b:]))
    if h[3] % 100 < 80:
        return len(words), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(words), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 10**6), st.text(alphabet=" \nab<PSM>é\U0001f600", max_size=60))
def test_forms(doc_id, text):
    assert transformed(doc_id, text, FimParams()) == plain_form(doc_id, text)


ODD = [(None, "no id at all"), (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "a <P> mark"), (6, "<S<P <M"), (6, "<S<P <M")]
ODD += [(7, "Ünïcode № 42 — 日本語 \U0001f600 text\x0bwith\x0cspaces\x85kept   x "), (8, "long  words " * 300_000), (9, "w" * 2_000_000)]
ODD += [(10 + k, f"< text > {k} <P" + " S> tail" * k + "<") for k in range(60)]


@pytest.mark.parametrize("rows", [ODD, []], ids=["odd", "empty"])
def test_odd_rows_match_sql(docs_of, rows):
    docs = docs_of(rows).withColumns({c: F.lit("x") for c in ("n", "form", "output")})
    names, want = sql_rows(duck_over(documents=docs), fim_sql())
    got = fim_digests(docs)
    assert sorted(got.columns) == names and rows_of(got) == want


def test_other_sentinels_and_shares_come_back(docs_of):
    params = FimParams(seed=7, fim_percent=100, spm_percent=50, prefix="[pre]", suffix="[suf]", middle="[mid]")
    docs = docs_of([r for r in ODD if r[0] is not None and r[0] != 6])
    made = fim_transform(docs, params)
    forms = {r["form"] for r in made.select("form").distinct().collect()}
    back = made.select("doc_id", restored(F.col("output"), F.col("form"), params).alias("back"))
    both = back.join(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), "doc_id")
    assert forms == {"plain", "psm", "spm"} and both.where("back <> text").isEmpty()
