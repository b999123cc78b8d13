"""Near-dedup, passage dedup, language model and pipeline against brute force and held-out scores."""

import hashlib
import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from spendwatch.llm import bwt, lm, neardup, passages
from spendwatch.llm.components import components
from spendwatch.llm.gru import Gru, log_likelihood, train
from spendwatch.llm.setsketch import estimated, sketches
from spendwatch.llm.shingles import words


def shingles(text):
    w = words(text)
    return frozenset(zip(*[w[k:] for k in range(5)])) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_components(rows, percent=75):
    """doc_id -> (set size, component) by comparing all pairs."""
    sets = {}
    for d, t in rows:
        sets.setdefault(d, shingles(t))
    up = {d: d for d in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            up[y] = x
    return {d: (len(s), root(d)) for d, s in sets.items()}


def near_copies(seed=3, base=120, copies=70):
    """Edited copies around the limit, copies of copies, exact copies, strangers and a passage that many hold."""
    r = random.Random(seed)
    word = lambda: f"w{r.randrange(4000)}"
    first = [word() for _ in range(base)]
    passage = " ".join(word() for _ in range(30))
    rows = [(0, " ".join(first))]
    for i in range(1, copies):
        t = list(first)
        for _ in range(r.choice([1, 2, 3, 4, 5, 7])):
            t[r.randrange(base)] = word()
        rows.append((i, " ".join(t)))
    second = rows[5][1].split()
    second[40:60] = [word() for _ in range(20)]
    rows += [(1000 + i, " ".join(second[:k] + [word()] + second[k + 1 :])) for i, k in enumerate(range(0, 100, 3))]
    rows += [(2000 + i, rows[i][1].upper().replace(" ", "\n ")) for i in range(0, 60, 2)]
    rows += [(3000 + i, passage + " " + " ".join(word() for _ in range(15 + i % 12))) for i in range(60)]
    return rows


@pytest.mark.parametrize("small", [32, 2])
def test_near_duplicates_match_brute_force(docs_of, monkeypatch, small):
    monkeypatch.setattr(neardup, "SMALL", small)
    rows = near_copies()
    want = brute_components(rows)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(docs_of(rows)).collect()}
    assert got == want
    assert len({c for _, c in want.values()}) > 20


def test_near_duplicates_of_odd_rows(docs_of):
    long = "word " * 200_000
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A  b"), (6, "a b c"), (7, long), (8, long), (9, "x y z u v"), (9, "x y z u v"),
            (None, "x y z u v"), (None, None), (10, "é a ß b c d"), (11, "É a ß b c d")]
    got = {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in neardup.near_duplicates(docs_of(rows)).collect()}
    assert got == {(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False), (6, 1, 6, True), (7, 1, 7, True),
                   (8, 1, 7, False), (9, 1, 9, True), (None, 1, 9, False), (None, 0, None, True), (10, 2, 10, True), (11, 2, 11, True)}
    assert neardup.near_duplicates(docs_of([])).collect() == []


def test_sketches_merge_and_estimate():
    r = np.random.default_rng(1)
    for n, j in ((200, 0.75), (1000, 0.5), (40, 0.8)):
        both = int(round(2 * n * j / (1 + j)))
        likes = []
        for _ in range(40):
            e = r.integers(0, 2**63, 2 * n - both, dtype=np.uint64)
            a, b = e[:n], e[n - both :]
            s = sketches(np.concatenate([a, b, e]), np.repeat([0, 1, 2], [n, n, len(e)]), 3)
            assert (s[2] == np.maximum(s[0], s[1])).all()
            likes.append(estimated(s[:1], s[1:2], np.array([float(n)]), np.array([float(n)]))[0])
        assert abs(np.mean(likes) - j) < 0.03 and min(likes) > j - 0.25


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i + 1, i) for i in range(1, 40)] + [(100, 101), (102, 101)], "a long, b long")
    got = {r["node"]: r["component"] for r in components(links, "a", "b").collect()}
    assert got == {i: 1 for i in range(2, 41)} | {101: 100, 102: 100}


def brute_repeats(rows, width=100):
    """doc order -> (bytes, removed, runs, hash of what is left)."""
    seen, out = set(), []
    for _, t in sorted(rows, key=lambda r: r[0]):
        data = (t or "").encode()
        gone = np.zeros(len(data) + 1, int)
        for i in range(len(data) - width + 1):
            w = data[i : i + width]
            if w in seen:
                gone[i : i + width] = 1
            seen.add(w)
        gone = gone[: len(data)]
        runs = int((np.diff(np.concatenate(([0], gone))) == 1).sum())
        out.append((len(data), int(gone.sum()), runs, hashlib.sha256(bytes(b for b, g in zip(data, gone) if not g)).hexdigest()))
    return out


def repeated_texts(seed=5):
    r = random.Random(seed)
    text = lambda n: "".join(r.choice("abcdé \n") for _ in range(n))
    a, b = text(400), text(130)
    rows = [(1, a), (2, text(50) + a[100:260] + text(40)), (3, b + text(20) + b), (4, a), (5, "z" * 350), (6, a[:99]), (7, text(10) + a[200:300]),
            (8, text(10) + a[200:299] + "#"), (9, None), (10, ""), (11, b[:60] + "!" + b[60:])]
    rows += [(20 + i, text(30) + b[:90] + text(40)) for i in range(25)]
    return rows


@pytest.mark.parametrize("most", [8192, 3])
def test_passages_match_brute_force(docs_of, most):
    rows = repeated_texts()
    got = passages.without_repeats(docs_of(rows), ["doc_id"], most_chunks=most).collect()
    assert [tuple(r)[1:] for r in sorted(got)] == brute_repeats(rows)


def test_passages_of_long_texts(docs_of, monkeypatch):
    """A text longer than what is read together, with a repeat inside and across its parts."""
    monkeypatch.setattr(passages, "TOGETHER", 1 << 9)
    r = random.Random(2)
    body = "".join(r.choice("abcdefgh") for _ in range(3000))
    rows = [(1, body), (2, body[700:1900]), (3, "q" + body + "q" + body)]
    got = passages.without_repeats(docs_of(rows), ["doc_id"]).collect()
    assert [tuple(x)[1:] for x in sorted(got)] == brute_repeats(rows)


def test_passages_of_odd_rows(docs_of):
    a = "0123456789" * 15
    rows = [(None, a), (1, a), (1, a), (2, "é" * 100), (3, "x" + "é" * 100)]
    got = passages.without_repeats(docs_of(rows), ["doc_id"], with_text=True).collect()
    by = {(r["doc_id"], r["n_bytes"]): r for r in got}
    assert by[(None, 150)]["n_removed"] == 150  # comes last
    assert [r["n_removed"] for r in got if r["doc_id"] == 1] == [140, 140]  # the period repeats inside; equal rows do not cover each other
    assert by[(3, 201)]["kept_text"] == "x"
    assert passages.without_repeats(docs_of([]), ["doc_id"]).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=30).map(lambda b: bytes(x % 3 for x in b)), min_size=1, max_size=8), st.integers(2, 9))
def test_transform_classes(strings, width):
    starts, number = bwt.classes(strings, width)
    text = b"".join(s + b"\xff" for s in strings)
    want = [i for i in range(len(text)) if len(text[i : i + width]) == width and b"\xff" not in text[i : i + width]]
    assert starts.tolist() == want
    by_text, by_number = {}, {}
    for i, k in zip(want, number.tolist()):
        by_text.setdefault(text[i : i + width], set()).add(i)
        by_number.setdefault(k, set()).add(i)
    assert sorted(map(sorted, by_text.values())) == sorted(map(sorted, by_number.values()))


def test_scores_beat_the_unigram_on_held_out_documents(docs_of):
    r = random.Random(4)
    tongues = [[f"{a}{k}" for k in range(60)] for a in "xyz"]
    rows = [(i, " ".join(r.choice(tongues[i % 3]) + ("." if r.random() < 0.1 else "") for _ in range(r.randrange(5, 60)))) for i in range(400)]
    rows += [(500, None), (501, ""), (502, "neverseen words only"), (502, "neverseen words only"), (None, "X1 y1")]
    got = lm.score_documents(docs_of(rows)).collect()
    assert len(got) == len(rows)
    tokens = [(d, words(t) + [b""]) for d, t in rows]
    count = Counter(w for d, ws in tokens if not lm.held_out(d) for w in ws)
    n, v = sum(count.values()), len(count)
    want = sorted((-1 if d is None else d, lm.held_out(d), len(ws), sum(count[w] > 0 for w in ws), n) for d, ws in tokens)
    assert sorted((-1 if g["doc_id"] is None else g["doc_id"], g["held_out"], g["n_tokens"], g["n_known"], g["train_tokens"]) for g in got) == want
    base = {d: sum(math.log10((count[w] + 1) / (n + v + 1)) for w in ws) for d, ws in tokens}
    assert all(abs(g["base_score"] - base[g["doc_id"]]) < 1e-6 for g in got)
    assert sum(g["score"] for g in got if g["held_out"]) > sum(g["base_score"] for g in got if g["held_out"])
    assert lm.held_out(2) == (zlib.crc32(b"2") % 7 == 2)
    assert lm.score_documents(docs_of([])).collect() == []


def test_model_is_a_distribution_and_learns():
    r = np.random.default_rng(0)
    c = 6
    model = Gru.fresh(np.log(np.full(c, 1 / c)), 8)
    runs = [np.array([(s + k) % c for k in range(40)], np.uint8) for s in r.integers(0, c, 300)]
    before = log_likelihood(model, runs[:5], 0).sum()
    for rate in (0.05, 0.05, 0.02):
        model = train(model, runs, 0, rate, 16, np.random.default_rng(1))
    assert log_likelihood(model, runs[:5], 0).sum() > before + 50
    every = [np.array(x, np.uint8) for x in itertools.product(range(c), repeat=3)]
    assert abs(np.exp(log_likelihood(model, every, 0)).sum() - 1.0) < 1e-3
    whole = np.concatenate(runs[:9])  # one long text by many windows, alone and beside short ones
    assert abs(log_likelihood(model, [whole], 0)[0] - log_likelihood(model, [whole[:3], whole, whole[:50]], 0)[1]) < 1e-3


def test_pipeline_stages(spark, tmp_path):
    """Each stage against the brute-force version of its rule, on what its predecessor kept."""
    import corpus_pipeline as P

    from .conftest import DOCUMENTS

    r = random.Random(9)
    word = lambda: f"w{r.randrange(3000)}"
    clean = [(i, " ".join(word() for _ in range(120))) for i in range(30)]
    item = " ".join(f"b{k}" for k in range(30))
    passage = " ".join(word() for _ in range(70))
    rows = clean + [(100, clean[3][1]), (101, clean[4][1].replace(" ", "  ") + " x"), (102, "short"), (103, None), (104, "a b c " * 90)]
    rows += [(110, " ".join(word() for _ in range(60)) + " " + item), (111, passage + " " + " ".join(word() for _ in range(100))),
             (112, " ".join(word() for _ in range(100)) + " " + passage)]
    full = [(d, t, "en", "s", 0) for d, t in rows]
    spark.createDataFrame(full, DOCUMENTS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = []
    for k, (name, stage) in enumerate(P.STAGES[:-1]):
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / f"stage{k}"))
        docs = spark.read.parquet(str(tmp_path / f"stage{k}"))
        kept.append({x["doc_id"]: x["text"] for x in docs.collect()})
    all_ids = {d for d, _ in rows}
    assert set(kept[0]) == all_ids - {102, 103, 104}
    assert set(kept[1]) == set(kept[0]) - {100, 101}
    assert set(kept[2]) == set(kept[1]) and passage[10:-10] in kept[2][111] and passage[10:-10] not in kept[2][112]
    want = brute_repeats(sorted(kept[1].items()))
    assert [hashlib.sha256(kept[2][d].encode()).hexdigest() for d in sorted(kept[2])] == [w[3] for w in want]
    assert set(kept[3]) == set(kept[2]) - {110}
    packed = P.STAGES[-1][1](spark, docs, str(tmp_path))
    direct = P.run(spark, str(tmp_path))
    assert {x["doc_id"] for x in packed.collect()} == set(kept[3])
    total = lambda df: sorted((x["doc_id"], x["doc_tokens"]) for x in df.select("doc_id", "doc_tokens").distinct().collect())
    assert total(packed) == total(direct)
