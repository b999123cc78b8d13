"""The quality stage removes frequent lines from the documents that it keeps."""

import corpus_pipeline as P


def test_frequent_lines_are_removed(spark, docs_of):
    line = "Share page 12 with your friends."
    body = lambda i: f"Title {chr(97 + i)}\n\n" + " ".join(f"w{i}x{k}" for k in range(60))
    rows = [(i, f"{line}\n{body(i)}\n  SHARE page {i}   with your friends.\nlast{i} line of {'ab' * (i + 1)}", "hot") for i in range(20)]
    rows += [(50, f"{line}\n{body(20)}", "other"), (5, rows[5][1], "other"), (None, f"{body(21)}\n{line}", "hot"), (60, line, "hot")]
    got = {(r["doc_id"], r["source"]): r for r in P.quality(spark, docs_of(rows), "").collect()}
    assert len(got) == len(rows) - 1
    for i in range(20):
        assert got[(i, "hot")]["text"] == f"{body(i)}\nlast{i} line of {'ab' * (i + 1)}"
        assert got[(i, "hot")]["n_chars"] == len(got[(i, "hot")]["text"])
    assert got[(50, "other")]["text"] == rows[20][1] and got[(5, "other")]["text"] == rows[5][1]
    assert got[(None, "hot")]["text"] == body(21)


def test_long_lines_are_boilerplate_and_names_do_not_clash(docs_of):
    """Lines of any length count; columns of the rows may have any name."""
    from pyspark.sql import functions as F

    from spendwatch.llm.quality import without_boilerplate

    notice = " ".join(f"notice{k}" for k in "abcdefghijklmnopqrstuvwxyz" * 2)
    body = lambda i: " ".join(f"w{i}x{k}" for k in range(80))
    docs = docs_of([(i, f"{body(i)}\n{notice}", "hot") for i in range(15)])
    odd = docs.withColumns({c: F.lit("z") for c in ("_id", "_key", "_gone", "_host", "_row", "_text", "_text_key", "_text_host", "_whole")})
    got = without_boilerplate(odd).collect()
    assert {r["doc_id"]: r["text"] for r in got} == {i: body(i) for i in range(15)}
    assert all(r["_gone"] == r["_row"] == "z" and r["n_chars"] == len(r["text"]) for r in got)
