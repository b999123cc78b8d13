"""Licence scan: wrapped and embedded notices, one match a notice, inputs that come from a shuffle."""

import random

import pytest
from pyspark.sql import functions as F

from spendwatch.llm.licenses import TEMPLATES, anchors, license_matches, license_scan, license_sql, template_bigrams, template_words

from .conftest import SF0001, duck_over, rows_of, sql_rows

BODY = " ".join(f"filler{k} text" for k in range(80))


def wrapped(text, words=7):
    w = text.split()
    return "\n".join(" ".join(w[k : k + words]) for k in range(0, len(w), words))


@pytest.mark.parametrize("name", ["mit-text", "gpl-3.0-notice", "apache-2.0-header"])
def test_wrapped_texts_are_found_once(docs_of, name):
    text = f"{BODY}\n/* {wrapped(TEMPLATES[name])} */\n{BODY}"
    (m,) = license_matches(docs_of([(1, text)])).collect()
    assert (m["unit"], m["license"]) == (-2, name) and m["dice_percent"] >= 95


def test_embedded_notices_are_found(docs_of):
    rows = [
        (1, "Copyright 2020 Foo. Released under the MIT License. See LICENSE."),
        (2, f"{BODY} Licensed under CC BY-NC 4.0. {BODY} Released under the BSD 3-Clause License. {BODY}"),
        (3, f"{BODY}\nThis work is licensed under the GNU General\nPublic License, version 3.\n{BODY}"),
        (4, BODY + "\nthe general version of this work is public and under a licence that was released"),
        (5, f"Licensed under CC BY 4.0.\n{BODY} licensed under cc by 4 0 {BODY}"),
    ]
    found = {r["doc_id"]: (r["n_matches"], r["licenses"]) for r in license_scan(docs_of(rows)).collect()}
    assert found == {1: (1, "mit"), 2: (2, "bsd-3-clause,cc-by-nc-4.0"), 3: (1, "gpl-3.0"), 4: (0, ""), 5: (2, "cc-by-4.0")}


def test_input_from_a_shuffle_gives_the_same(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    moved = docs.repartition(7, "text").groupBy("doc_id").agg(F.first("text").alias("text"))
    plain = rows_of(license_scan(docs))
    assert rows_of(license_scan(moved)) == plain and any(r[2] for r in plain)


def test_random_texts_match_sql(docs_of):
    draw = random.Random(5)
    words = sorted({w for t in TEMPLATES.values() for w in template_words(t)})
    rows = []
    for k in range(60):
        text = []
        for _ in range(draw.randint(0, 4)):
            w = TEMPLATES[draw.choice(sorted(TEMPLATES))].split()
            for _ in range(draw.randint(0, 3)):
                w[draw.randrange(len(w))] = draw.choice(words)
            text += [*draw.choices(words, k=draw.randint(0, 5)), draw.choice(["\n", ""]), *w[draw.randint(0, 1) :], draw.choice(["\n", ""])]
        rows.append((k, draw.choice([" ", "\n", "  "]).join(text) if k % 3 else wrapped(" ".join(text), 5)))
    docs = docs_of([*rows, rows[0], (None, rows[1][1]), (91, None), (92, "")])
    names, want = sql_rows(duck_over(documents=docs), license_sql())
    got = license_scan(docs)
    assert sorted(got.columns) == names and rows_of(got) == want


def test_anchors_are_in_their_templates():
    for body in TEMPLATES.values():
        w = template_words(body)
        assert anchors(body, 80) and all(w[at] == word for word, at in anchors(body, 80))
        assert template_bigrams(body)
