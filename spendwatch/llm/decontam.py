r"""Benchmark decontamination by a distributed positional inverted index (native).

1. Terms of the test items are counted over all training documents.
2. Each window of an item (``width`` consecutive words; a shorter item is one window) is
   probed by its rarest term; one probe often serves many windows.
3. The probe terms' postings over all documents are stored in the shared folder: term,
   document row, position, and the terms on either side up to ``width - 1`` places, which are
   the entries that the other terms' lists have at the adjusted offsets.
4. A posting meets its probes (item, offset). The lists of the other terms are
   intersected outwards from the probe until a term differs; a run of at least one window is an
   exact phrase match, and its span of document words is hit. Spans are united per document.

``proximity_matches`` gives the looser form: all terms of a phrase within ``slop``
extra words.

The test items' terms are broadcast only if their measured size is under
``MAX_BROADCAST``; above it the same joins shuffle. A posting group is never collected:
hits are pre-aggregated in the task that read the document.

Rows: a NULL text has no words; an item without words has no window; a NULL item_id
is hit but not listed; repeated documents are each judged; repeated item_ids are
one item in n_items; empty tables give no hits or no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendwatch.llm.common import ascii_lower, written

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Bytes of test terms that are broadcast at most.
MAX_BROADCAST = 64 << 20


def lowered(text: Column) -> Column:
    """A-Z lowered; texts of ASCII alone take the faster function, which does the same there."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(ascii_lower(text))


def tokens(text: Column) -> Column:
    """Words of ASCII letters, digits and all other characters; none for NULL."""
    return F.array_remove(F.split(lowered(F.coalesce(text, F.lit(""))), NOT_WORD), "")


def small(df: DataFrame, measured: int) -> DataFrame:
    """Broadcast if the measured bytes allow it; else the planner's shuffle join."""
    return F.broadcast(df) if measured <= MAX_BROADCAST else df


def item_terms(items: DataFrame) -> DataFrame:
    """(item, item_id, words): the items that have words; ``item`` tells equal ids apart."""
    return items.select("item_id", tokens(F.col("text")).alias("words")).where(F.size("words") > 0).select(
        F.xxhash64("item_id", "words").alias("item"), "item_id", "words"
    ).distinct()


def _rows(docs: DataFrame) -> DataFrame:
    """Documents with a key that tells rows with equal ids and different texts apart."""
    return docs.select("doc_id", F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("text_key"), tokens(F.col("text")).alias("words"))


def term_counts(docs: DataFrame, vocabulary: DataFrame, measured: int) -> DataFrame:
    """How often each term of the vocabulary occurs in all documents."""
    return (
        docs.select(F.explode(tokens(F.col("text"))).alias("term"))
        .join(small(vocabulary, measured), "term")
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def probes(items: DataFrame, counts: DataFrame, width: int) -> DataFrame:
    """For each window its rarest term: (term, item, item_id, at, left, right, need).

    ``left`` and ``right`` are the item's words going outwards from the probe; ``need`` is the run that makes a match.
    """
    placed = items.select("item", "item_id", "words", F.posexplode("words").alias("at", "term")).join(counts, "term")
    listed = placed.groupBy("item", "item_id", "words").agg(F.array_sort(F.collect_list(F.struct("at", "n", "term"))).alias("places"))
    # terms that no document has are missing: their windows cannot occur
    size = F.size("words")
    first = F.sequence(F.lit(0), F.greatest(size - width, F.lit(0)))
    spans = F.transform(
        first,
        lambda s: F.filter("places", lambda p: (p["at"] >= s) & (p["at"] < s + width)),
    )
    whole = F.filter(spans, lambda x: F.size(x) == F.least(F.lit(width), size))
    rarest = F.transform(whole, lambda x: F.array_min(F.transform(x, lambda p: F.struct(p["n"], p["at"], p["term"]))))
    chosen = listed.select("item", "item_id", "words", F.explode(F.array_distinct(rarest)).alias("p"))
    at = F.col("p")["at"]
    start = F.greatest(at - (width - 1), F.lit(0))
    return chosen.select(
        F.col("p")["term"].alias("term"),
        "item",
        "item_id",
        F.reverse(F.slice("words", start + 1, at - start)).alias("left"),
        F.slice("words", at + 2, F.lit(width - 1)).alias("right"),
        F.least(F.lit(width), size).alias("need"),
    )


def postings(docs: DataFrame, terms: DataFrame, measured: int, width: int) -> DataFrame:
    """The stored index: every occurrence of the terms with its neighbours on either side."""
    placed = _rows(docs).select("doc_id", "text_key", "words", F.posexplode("words").alias("pos", "term"))
    start = F.greatest(F.col("pos") - (width - 1), F.lit(0))
    return placed.join(small(terms, measured), "term").select(
        "term",
        "doc_id",
        "text_key",
        "pos",
        F.reverse(F.slice("words", start + 1, F.col("pos") - start)).alias("before"),
        F.slice("words", F.col("pos") + 2, F.lit(width - 1)).alias("after"),
    )


def _run(a: str, b: str) -> Column:
    """How many leading entries of two lists agree."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    stop = F.array_position(same, F.lit(False))
    return F.when(stop > 0, stop - 1).otherwise(F.size(same)).cast("int")


def phrase_matches(index: DataFrame, probe_rows: DataFrame, measured: int) -> DataFrame:
    """Exact phrase matches: the document, the item, and the span of words from first to last."""
    met = index.join(small(probe_rows, measured), "term").select(
        "doc_id", "text_key", "item_id", "pos", "need", _run("before", "left").alias("l"), _run("after", "right").alias("r")
    )
    return met.where(F.col("l") + 1 + F.col("r") >= F.col("need")).select(
        "doc_id", "text_key", "item_id", (F.col("pos") - F.col("l")).alias("first"), (F.col("pos") + F.col("r")).alias("last")
    )


def covered(spans: str) -> Column:
    """Words in the union of (first, last) spans; the array is sorted."""
    empty = F.struct(F.lit(-1).alias("end"), F.lit(0).cast("long").alias("n"))

    def step(a: Column, s: Column) -> Column:
        new = F.greatest(s["last"] - F.greatest(s["first"] - 1, a["end"]), F.lit(0))
        return F.struct(F.greatest(a["end"], s["last"]).alias("end"), (a["n"] + new).alias("n"))

    return F.aggregate(spans, empty, step)["n"]


def measure(df: DataFrame, column: str) -> int:
    """Bytes of a column of terms with 64 for each row."""
    row = df.agg(F.coalesce(F.sum(F.octet_length(column) + 64), F.lit(0)).alias("n")).first()
    return int(row["n"])


def decontaminate(docs: DataFrame, items: DataFrame, width: int = 13, percent: int = 5) -> DataFrame:
    """Hit words, items and verdict of every document."""
    terms = item_terms(items)
    vocabulary = written(terms.select(F.explode("words").alias("term")).distinct(), "test-terms")
    bytes_of_terms = measure(vocabulary, "term")
    counts = term_counts(docs, vocabulary, bytes_of_terms)
    chosen = written(probes(terms, counts, width), "probes")
    probe_terms = chosen.select("term").distinct()
    index = written(postings(docs, probe_terms, bytes_of_terms, width), "postings")
    bytes_of_probes = measure(chosen.select("term", F.concat_ws(" ", "left", "right").alias("near")), "near")
    hits = (
        phrase_matches(index, chosen, bytes_of_probes * 4)
        .groupBy("doc_id", "text_key")
        .agg(
            F.array_sort(F.collect_set(F.struct("first", "last"))).alias("spans"),
            F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"),
        )
        .select(
            F.col("doc_id").alias("_doc"),
            F.col("text_key").alias("_key"),
            covered("spans").alias("n_hit"),
            F.size("items").cast("long").alias("n_items"),
            F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        )
    )
    rows = _rows(docs).select("doc_id", "text_key", F.size("words").cast("long").alias("n_words"))
    met = rows.join(hits, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("text_key") == F.col("_key")), "left")
    none = F.sha2(F.lit("").cast("binary"), 256)
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return met.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", none).alias("items_sha256"),
        ((n_hit > 0) & (100 * n_hit >= percent * F.col("n_words"))).alias("contaminated"),
        "text_key",
    )


def proximity_matches(docs: DataFrame, items: DataFrame, slop: int = 4, width: int = 13) -> DataFrame:
    """Documents where all distinct terms of an item (of at most ``width`` words) lie within its length plus ``slop`` words.

    Postings of the rarest term carry the neighbourhood in which the other terms' lists are intersected.
    Returns (doc_id, item_id, pos) of the rarest term's occurrences.
    """
    terms = item_terms(items).where(F.size("words") <= width)
    vocabulary = written(terms.select(F.explode("words").alias("term")).distinct(), "test-terms")
    n = measure(vocabulary, "term")
    counts = term_counts(docs, vocabulary, n)
    rarest = (
        terms.select("item", "item_id", "words", F.explode("words").alias("term"))
        .join(counts, "term")
        .groupBy("item", "item_id", "words")
        .agg(F.min(F.struct("n", "term"))["term"].alias("term"))
    )
    index = postings(docs, rarest.select("term").distinct(), n, width + slop)
    reach = F.size("words") + slop
    # every stretch of the reach that holds the probe
    near = F.concat(F.reverse(F.slice("before", F.lit(1), reach - 1)), F.array("term"), F.slice("after", F.lit(1), reach - 1))
    starts = F.sequence(F.lit(1), F.greatest(F.size("near") - F.col("reach") + 1, F.lit(1)))
    inside = F.exists(
        starts, lambda s: F.size(F.array_except(F.array_distinct("words"), F.slice("near", s, F.col("reach")))) == 0
    )
    return (
        index.join(rarest, "term")
        .select("doc_id", "item_id", "pos", "words", near.alias("near"), reach.alias("reach"))
        .where(inside)
        .select("doc_id", "item_id", "pos")
    )


def decontaminate_sql(width: int = 13, percent: int = 5) -> str:
    """DuckDB SQL of ``decontaminate``: all windows of both sides, joined."""
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    low = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS id, doc_id, regexp_extract_all({low}, '{word}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({low}, '{word}') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(w), {width}) AS n, array_to_string(w[s : s + {width - 1}], ' ') AS phrase
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {width}, 0) + 2)) AS s FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT id, s, n, array_to_string(w[s : s + n - 1], ' ') AS phrase
  FROM (SELECT id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n)
), hits AS (SELECT id, s, n, item_id FROM dw JOIN bw USING (n, phrase)),
words AS (SELECT id, count(DISTINCT p) AS n_hit FROM (SELECT id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY id),
found AS (SELECT id, count(DISTINCT item_id) AS n_items, array_to_string(list_sort(list(DISTINCT item_id::VARCHAR)), ',') AS ids FROM hits GROUP BY id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 100 * n_hit >= {percent} * len(w) AS contaminated
FROM d LEFT JOIN words USING (id) LEFT JOIN found USING (id)"""
