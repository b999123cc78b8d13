"""The queries that SQL can express: whole tables, and small tables of odd rows, against DuckDB."""

import pytest
from pyspark.sql import types as T

from spendwatch.llm import queries as Q
from spendwatch.llm.decontam import decontaminate, decontaminate_sql, proximity_matches
from spendwatch.llm.licenses import TEMPLATES, license_matches, license_scan, license_sql, template_bigrams
from spendwatch.llm.quality import QualityParams, quality_rules, quality_sql
from spendwatch.llm.sharding import grown, shard_documents, shard_sql, tree

from .conftest import SF0001, duck, duck_over, rows_of, sql_rows


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_query_matches_sql(spark, name):
    df = Q.queries()[name](spark, SF0001)
    names, want = sql_rows(duck(SF0001), Q.oracle_sql()[name])
    assert sorted(df.columns) == names
    assert rows_of(df) == want


LINE = "Share this page with your friends."
ODD = [
    (None, "no id at all " * 20, None),
    (1, None),
    (2, ""),
    (3, " \n\t\r\n "),
    (4, "one two three one two three one two three " * 15),
    (5, "\n".join(f"a line of its own number word{i} and more words here" for i in range(30)) + "\n" + LINE),
    (5, "the same id, another text " * 20),
    (6, "Ünïcode № 42 — ÀÉ ß 日本語 text\x0bwith\x0cspaces\x85kept"),
    (7, "x" * 5000 + " # * $ % & | < >"),
    (8, "long " * 30000),
    (9, "long " * 30000),
    (9, "long " * 30000),
]
ODD += [(20 + i, f"{LINE}\n{LINE}\nbody {i} " + f"w{i} " * (60 if i % 2 else 4), "hot") for i in range(30)]


@pytest.mark.parametrize("rows", [ODD, []], ids=["odd", "empty"])
def test_quality_of_odd_rows(docs_of, rows):
    docs = docs_of(rows)
    params = QualityParams(min_docs=5)
    names, want = sql_rows(duck_over(documents=docs), quality_sql(params))
    got = quality_rules(docs, params).drop("text_key")
    assert sorted(got.columns) == names and rows_of(got) == want


def test_copies_are_not_boilerplate(docs_of):
    """A document is not rejected for being copied; one that is boilerplate for the most part is."""
    text = "\n".join(" ".join(f"{w}{k}" for k in range(9)) for w in "abcdefghijkl")
    rows = [(i, text) for i in range(40)] + [(100 + i, " ".join(f"word{i}x{k}" for k in range(60)) + f"\n{LINE}") for i in range(40)]
    rows += [(200, "\n".join([LINE] * 20) + "\nand little else to say")]
    kept = {r["doc_id"]: r["kept"] for r in quality_rules(docs_of(rows)).collect()}
    assert all(kept[i] for i in range(40)) and not kept[200]


@pytest.mark.parametrize("rows", [ODD, []], ids=["odd", "empty"])
def test_sharding_of_odd_rows(docs_of, rows):
    docs = docs_of(rows)
    names, want = sql_rows(duck_over(documents=docs), shard_sql())
    got = shard_documents(docs)
    assert sorted(got.columns) == names
    # rows equal in id and text may swap their slots
    assert rows_of(got) == want


def test_sharding_moves_rows_only_into_the_new_shard(docs_of):
    got = shard_documents(docs_of([(i, "t") for i in range(4000)])).collect()
    assert all(r["grown_shard"] in (r["shard"], 8) for r in got)
    moved = sum(r["grown_shard"] == 8 for r in got)
    assert 4000 / 9 * 0.8 < moved < 4000 / 9 * 1.2
    for s in range(8):
        slots = sorted(r["slot"] for r in got if r["shard"] == s)
        assert slots == list(range(len(slots))) and 400 < len(slots) < 600
    assert grown(tree(8), 8).weight == 9.0


@pytest.mark.parametrize("rows", [ODD, []], ids=["odd", "empty"])
def test_licences_of_odd_rows(docs_of, rows):
    rows = rows + [
        (70, "Some text.\nLicensed under the Apache License, Version 2.0.\n ALL RIGHTS RESERVED "),
        (71, TEMPLATES["mit-text"]),
        (72, TEMPLATES["mit-text"].replace("sublicense", "resell").replace(". ", ".\n")),
        (73, "This work is licensed under the GNU General Public License, version 3, or later."),
    ] if rows else rows
    docs = docs_of(rows)
    names, want = sql_rows(duck_over(documents=docs), license_sql())
    got = license_scan(docs)
    assert sorted(got.columns) == names and rows_of(got) == want


def test_licence_matches_name_unit_and_template(docs_of):
    text = "Words.\n" + TEMPLATES["cc-by-nc-4.0"] + "\nMore."
    (m,) = license_matches(docs_of([(1, text)])).collect()
    assert (m["unit"], m["license"], m["dice_percent"]) == (1, "cc-by-nc-4.0", 100.0)
    assert template_bigrams("A b a b") == ["a b", "b a"]


ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())])
PHRASE = " ".join(f"q{i}" for i in range(20))


@pytest.mark.parametrize("empty", ["none", "documents", "items"])
def test_decontamination_of_odd_rows(spark, docs_of, empty):
    short = [r for r in ODD if len(r[1] or "") < 20_000]  # the SQL copies a text's words for each window
    rows = short + [
        (80, f"before {PHRASE.upper()} after"),
        (81, "x " * 300 + " ".join(f"q{i}" for i in range(3, 16)) + " y" * 300),
        (82, " ".join(f"q{i}" for i in range(12))),
        (83, "Short item here, and a short item here again"),
        (84, f"{PHRASE} {PHRASE}"),
        (84, f"{PHRASE} other text under the same id"),
        (85, "na " * 40),
    ]
    items = [(1, PHRASE), (2, "short ITEM"), (2, "short item"), (3, None), (4, "..."), (None, "again"), (5, "na " * 15), (6, PHRASE)]
    docs = docs_of([] if empty == "documents" else rows)
    tests = spark.createDataFrame([] if empty == "items" else items, ITEMS)
    names, want = sql_rows(duck_over(documents=docs, benchmark=tests), decontaminate_sql())
    got = decontaminate(docs, tests).drop("text_key")
    assert sorted(got.columns) == names and rows_of(got) == want


def test_decontamination_without_broadcast(spark, docs_of, monkeypatch):
    from spendwatch.llm import decontam

    docs, tests = docs_of([(1, f"a {PHRASE} b"), (2, "c")]), spark.createDataFrame([(7, PHRASE)], ITEMS)
    plain = rows_of(decontaminate(docs, tests))
    monkeypatch.setattr(decontam, "MAX_BROADCAST", -1)
    assert rows_of(decontaminate(docs, tests)) == plain


def test_proximity_matches(spark, docs_of):
    docs = docs_of([(1, "red fox x x jumps over"), (2, "red x x x x x x x x fox jumps"), (3, "jumps fox red"), (4, "red fox")])
    found = proximity_matches(docs, spark.createDataFrame([(1, "red fox jumps")], ITEMS), slop=2).collect()
    assert {r["doc_id"] for r in found} == {1, 3}
