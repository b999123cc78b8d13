"""Product codes: trees against plain distances, whole rounds against plain Python and SQL, odd rows."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendwatch.llm import vectorcodes
from spendwatch.llm.covertree import LEAF, Forest, codes, distances, grown, totals
from spendwatch.llm.vectorcodes import CodeParams, compress_report, compress_sql, compressed

from .conftest import duck_over, rows_of, sql_rows

SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())), T.StructField("label", T.StringType()),
])


@pytest.mark.parametrize("spread", [3, 400, 1 << 24])
@pytest.mark.parametrize("n", [1, 17, 600])
def test_trees_give_plain_results(n, spread):
    draw = np.random.default_rng(n)
    clumps = draw.integers(-spread, spread + 1, (4, 5, 3))
    parts = np.stack([clumps[p][draw.integers(5, size=n)] + draw.integers(-3, 4, (n, 3)) for p in range(4)])
    parts[:, ::7] = parts[:, :1]  # a vector with many copies
    books = np.stack([parts[p][draw.integers(n, size=6)] for p in range(4)])
    forest = Forest.unpacked(grown(parts).packed(), 3)
    found, error = codes(forest, books)
    d = ((parts[:, :, None, :] - books[:, None, :, :]) ** 2).sum(axis=3)
    want = d.argmin(axis=2)
    assert (found.T == want).all() and (error == d.min(axis=2).sum(axis=0)).all()
    counts, sums = totals(forest, books)
    for p in range(4):
        assert (counts[p] == np.bincount(want[p], minlength=6)).all()
        assert all((sums[p, e] == parts[p][want[p] == e].sum(axis=0)).all() for e in range(6))
    # the trees' own promises
    for s, e, r, c, k, total in zip(forest.start, forest.end, forest.radius, forest.child, forest.children, forest.sums):
        run = forest.points[s:e].astype(np.int64)
        assert np.sqrt(distances(run, run[:1])).max() <= r + 1e-6 and (run.sum(axis=0) == total).all()
        if k:
            assert forest.start[c] == s and forest.end[c + k - 1] == e and e - s > LEAF
            heads = forest.points[forest.start[c : c + k]]
            apart = distances(heads, heads)
            assert (apart[np.triu_indices(k, 1)] > (r / 2) ** 2 - 1e-6).all()


def plain(rows, p=CodeParams()):
    """Lloyd rounds in Python integers, point by point."""
    kept = [(i, v, lab) for i, v, lab in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    ids = sorted({i for i, _, _ in kept if i is not None})[: p.entries]
    first = {i: min(v for j, v, _ in kept if j == i) for i in ids}
    length = len(first[ids[0]])
    kept = [r for r in kept if len(r[1]) == length]
    width = -(-length // p.parts)

    def cut(v):
        whole = [int(np.floor(p.scale * x)) for x in v] + [0] * (width * p.parts - length)
        return [whole[k * width : (k + 1) * width] for k in range(p.parts)]

    books = [[cut(first[i])[k] for i in ids if len(first[i]) == length] for k in range(p.parts)]
    parts = [cut(v) for _, v, _ in kept]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(p.rounds):
        for k in range(p.parts):
            own = {}
            for v in parts:
                own.setdefault(near(v[k], books[k])[1], []).append(v[k])
            for e, xs in own.items():
                books[k][e] = [sum(c) // len(xs) for c in zip(*xs)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    made = [[near(v[k], books[k]) for k in range(p.parts)] for v in parts]
    by_label = {}
    for (_, _, lab), ds in zip(kept, made):
        by_label[lab] = by_label.get(lab, 0) + sum(d for d, _ in ds)
    return sorted(
        (("".join(f"{e:02x}" for _, e in ds), digest, sum(d for d, _ in ds), by_label[lab], i) for (i, _, lab), ds in zip(kept, made)), key=repr
    )


def odd(length, n=70):
    draw = random.Random(length)
    rows = [(k * 3 % 101, [draw.choice([draw.gauss(0, 1), 0.25, -0.1]) for _ in range(length)], draw.choice(["a", "b", None])) for k in range(n)]
    rows += [(500 + k, rows[5][1], "a") for k in range(40)] + [rows[7], rows[7], (None, rows[3][1], "b"), (2, None, "a")]
    rows += [(0, [None] + [0.0] * (length - 1), "c"), (0, [float("nan")] * length, "c"), (0, [float("-inf")] * length, "c")]
    return rows


@pytest.mark.parametrize("length", [13, 3])
def test_rounds_match_plain_python(spark, monkeypatch, length):
    monkeypatch.setattr(vectorcodes, "BLOCK", 23)
    rows = odd(length)
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("n", "part", "entry", "code", "error", "_salt")})
    assert rows_of(compress_report(df)) == plain(rows)


def test_odd_rows_match_sql(spark):
    rows = [r for r in odd(16) if r[1] is None or len(r[1]) == 16]
    rows = [r for k, r in enumerate(rows) if r[0] is None or r[0] not in {q[0] for q in rows[:k]} or r[1] is None]
    df = spark.createDataFrame(rows, SCHEMA)
    names, want = sql_rows(duck_over(embeddings=df), compress_sql(width=2))
    got = compress_report(df)
    assert sorted(got.columns) == names and rows_of(got) == want == plain(rows)


def test_few_and_no_vectors(spark):
    rows = [(4, [0.5] * 8, "x"), (9, [0.5] * 8, None), (11, [1.0] * 7, "x"), (12, [3e9] * 8, "x")]
    got = compress_report(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["vec_id"] for r in got} == {4, 9, 12}
    for few in ([], [(None, [1.0] * 8, "x")], [(1, None, "x")]):
        assert compress_report(spark.createDataFrame(few, SCHEMA)).collect() == []


def test_codebooks_are_given(spark):
    seen = []
    compressed(spark.createDataFrame(odd(16), SCHEMA), CodeParams(entries=5, rounds=2), seen=seen.append)
    assert seen[0].shape == (8, 5, 2)
