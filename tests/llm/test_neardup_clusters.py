"""Large buckets of the near-dedup: clusters hold all documents of their buckets, no link is lost, copies share a centre."""

import pytest

from spendwatch.llm import neardup

from .test_dedup_lm_pipeline import brute_components, near_copies


def traced(monkeypatch):
    stored = {}
    plain = neardup.written

    def written(df, name):
        out = plain(df, name)
        stored.setdefault(name, []).append(out)
        return out

    monkeypatch.setattr(neardup, "written", written)
    return stored


@pytest.mark.parametrize("small,rounds", [(3, 1)])
def test_no_link_is_lost_by_size_or_rounds(docs_of, monkeypatch, small, rounds):
    monkeypatch.setattr(neardup, "SMALL", small)
    monkeypatch.setattr(neardup, "ROUNDS", rounds)
    rows = near_copies()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(docs_of(rows)).collect()}
    assert got == brute_components(rows)


def test_known_documents_stay_in_second_clusters(docs_of, monkeypatch):
    """Overlapping clusters: what an earlier round compared is not compared again, and is in the later cluster."""
    monkeypatch.setattr(neardup, "SMALL", 2)
    stored = traced(monkeypatch)
    neardup.near_duplicates(docs_of(near_copies())).collect()
    pairs = lambda df: {(r[0], r[1]) for r in df.collect()}
    seen: set = set()
    for star, made, named in zip(stored["centred"], stored["clusters"], stored["named"]):
        asked = pairs(star.where("doc_id <> centre").select("doc_id", "centre"))
        new = pairs(made.select("doc_id", "centre"))
        assert new == asked - seen
        seen |= new
        assert pairs(named.select("doc_id", "centre")) <= asked
    assert len(stored["clusters"]) > 1


def test_copies_share_a_centre(docs_of, monkeypatch):
    """A group of copies in many large buckets makes about one cluster, not one a band."""
    monkeypatch.setattr(neardup, "SMALL", 4)
    stored = traced(monkeypatch)
    base = [f"w{k}" for k in range(120)]
    rows = [(i, " ".join(base[:i] + ["x"] + base[i + 1 :] if i else base)) for i in range(60)]
    got = neardup.near_duplicates(docs_of(rows)).collect()
    assert {r["component_id"] for r in got} == {0}
    # one part: nothing to compare beyond the stars
    assert not stored.get("clusters") or stored["clusters"][0].select("centre").distinct().count() <= 1
