"""Large buckets of documents that share a passage: only shingles that can decide a link make buckets, and rounds end when few pairs are left."""

import random

from spendwatch.llm import neardup

from .test_dedup_lm_pipeline import brute_components
from .test_neardup_clusters import traced


def sharing(share, n=60, words=100, seed=2):
    """Documents of which a passage takes ``share``; the rest of each is its own."""
    r = random.Random(seed)
    word = lambda: f"w{r.randrange(10**9)}"
    passage = [word() for _ in range(int(share * words))]
    return [(i, " ".join(passage + [word() for _ in range(words - len(passage))])) for i in range(n)]


def run(docs_of, monkeypatch, rows):
    monkeypatch.setattr(neardup, "SMALL", 4)
    stored = traced(monkeypatch)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(docs_of(rows)).collect()}
    assert got == brute_components(rows)
    return stored


def test_a_passage_too_short_for_a_link_makes_no_buckets(docs_of, monkeypatch):
    """Every document is a part; none has enough shingles that others hold, whatever their hashes."""
    stored = run(docs_of, monkeypatch, sharing(0.7))
    assert stored["named"][0].count() > 0
    assert stored["met"][0].count() == 0 and len(stored["centred"]) == 1


def test_links_beside_the_passage_are_found(docs_of, monkeypatch):
    """Pairs that share more than the passage, among many that share only it; the hooks are read from a table of their own."""
    r = random.Random(3)
    rows = sharing(0.7)
    rows += [(100 + i, " ".join(t.split()[:-4] + [f"z{r.randrange(10**9)}" for _ in range(4)])) for i, t in rows[::3]]
    rows += [(200 + i, " ".join(t.split()[:-7] + [f"z{r.randrange(10**9)}" for _ in range(7)])) for i, t in rows[1:60:3]]
    stored = run(docs_of, monkeypatch, rows)
    assert stored["named"] and len(stored["hooks"]) == len(stored["parts"])
