r"""Quality rules by cross-document line frequency (native).

Base figures are made per row from the whole text with array functions. The method's
verdict: every line is normalised (lower case, white space as one space, and in lines of up to ``DIGITS`` words digit runs
as 0, as in counters and dates) and hashed; for each host the distinct documents that hold a line are
counted; lines of any length held by more than ``min_docs`` documents and more than one in
``share`` of the host's documents are boilerplate; a document that loses more than
half of its words with them is depleted and rejected. ``without_boilerplate`` gives the kept
documents' texts without these lines, which the pipeline goes on with; the figures are of the whole text.

Documents with equal texts count once, so a document is not rejected for having copies. One read of the text feeds both parts; it
is stored with hashed lines in the shared folder. Hot lines and hosts meet
partial aggregates.

Extra columns of any name are kept by ``without_boilerplate``; ``quality_rules`` reads three columns alone.
There are no ties: limits are compared as counts.

Rows: a NULL text has no words and fails the base rules; a NULL host is a
host of its own; repeated rows each get their figures; an empty table gives an empty result.
Windows are compared by a 64-bit hash of their three words, within one document.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendwatch.llm.common import written

#: Words of a line in which digit runs do not count.
DIGITS = 20

SPACE = r"[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class QualityParams:
    min_words: int = 50
    max_repeat_percent: int = 50
    min_docs: int = 10
    share: int = 100


def words(text: Column) -> Column:
    """Runs of anything but ASCII white space."""
    return F.array_remove(F.split(text, SPACE), "")


def repeat_words(df: DataFrame, w: str, out: str) -> DataFrame:
    """Adds the number of words in 3-word windows that the array ``w`` holds twice or more.

    Windows are sorted by hash, so equal ones are neighbours; a position counts up
    to three words, or as many as lie before the next repeated position.
    """
    last = F.size(w) - 3
    at = lambda i: F.get(F.col(w), i)
    windows = F.when(
        last >= 1,
        F.transform(
            F.sequence(F.lit(0), last),
            lambda i: F.struct(F.xxhash64(at(i), at(i + 1), at(i + 2)).alias("h"), i.alias("i")),
        ),
    )
    df = df.withColumn("_sorted", F.array_sort(windows))
    hash_at = lambda k: F.get(F.col("_sorted"), k)["h"]
    twice = F.transform(
        "_sorted", lambda x, k: F.when((x["h"] == hash_at(k - 1)) | (x["h"] == hash_at(k + 1)), x["i"])
    )
    df = df.withColumn("_places", F.sort_array(F.array_compact(twice))).drop("_sorted")
    each = F.transform("_places", lambda p, k: F.least(F.lit(3), F.coalesce(F.get(F.col("_places"), k + 1) - p, F.lit(3))))
    return df.withColumn(out, F.coalesce(F.aggregate(each, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long")).drop("_places")


def _host() -> Column:
    return F.coalesce("source", F.lit("\u0000none"))


def _normal(line: Column) -> Column:
    """Lower case, white space as one space; digit runs as 0 in short lines (longer ones are text, which its numbers tell apart)."""
    plain = F.array(F.trim(F.regexp_replace(F.lower(line), SPACE, " ")))
    few = lambda x: F.size(F.split(x, " ")) <= DIGITS
    return F.transform(plain, lambda x: F.when(few(x), F.regexp_replace(x, "[0-9]+", "0")).otherwise(x))[0]


def _described(docs: DataFrame) -> DataFrame:
    """Base figures and hashed distinct lines (hash, words in all its places) of each row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    df = docs.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        _host().alias("host"),
        F.xxhash64(text).alias("doc"),
        text.alias("text"),
        words(text).alias("w"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    df = repeat_words(df, "w", "n_repeat_words")
    return df.select(
        "row",
        "doc_id",
        "host",
        "doc",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.transform("lines", _normal).alias("lines"),
    ).withColumn("lines", F.transform("lines", lambda x: F.struct(F.xxhash64(x).alias("line"), F.size(F.split(x, " ")).alias("n"))))


def _judged(docs: DataFrame, params: QualityParams) -> DataFrame:
    """Base figures and verdict of every document, with its host and the hashes of its frequent lines."""
    rows = written(_described(docs), "quality")
    held = (
        rows.select("host", "doc", F.explode(F.array_distinct("lines")).alias("l"))
        .select("host", "doc", "l.line", "l.n")
        .distinct()
        .groupBy("host", "line")
        .agg(F.count(F.lit(1)).alias("docs"))
        .where(F.col("docs") > params.min_docs)
    )
    hosts = rows.select("host", "doc").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("host_docs"))
    frequent = held.join(hosts, "host").where(F.col("docs") * params.share > F.col("host_docs")).select("host", "line")
    lost = (
        rows.select("row", "host", F.explode("lines").alias("l"))
        .select("row", "host", "l.line", "l.n")
        .join(frequent, ["host", "line"])
        .groupBy("row")
        .agg(F.sum("n").alias("lost"), F.sort_array(F.collect_set("line")).alias("gone"))
    )
    failed = (F.col("n_words") < params.min_words) | (
        100 * F.col("n_repeat_words") > params.max_repeat_percent * F.col("n_words")
    )
    depleted = 2 * F.coalesce("lost", F.lit(0)) > F.col("n_words")
    return rows.drop("lines").join(lost, "row", "left").select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & ~depleted).alias("kept"),
        F.coalesce("lost", F.lit(0)).cast("long").alias("n_boilerplate_words"),
        F.col("doc").alias("text_key"),
        "host",
        "gone",
    )


def quality_rules(docs: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    """Base figures and verdict of every document."""
    return _judged(docs, params).drop("host", "gone")


def without_boilerplate(docs: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    """The kept rows of ``docs``, with their texts (and n_chars) less the frequent lines of their hosts."""
    good = _judged(docs, params).where("kept")
    good = good.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), F.col("host").alias("_host"), F.col("gone").alias("_gone")).distinct()
    # the row is one column, so that no name of it can clash
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.struct("*").alias("_row"), F.xxhash64(text).alias("_text_key"), _host().alias("_text_host"))
    row = F.col("_row")
    same = row["doc_id"].eqNullSafe(F.col("_id")) & (F.col("_text_key") == F.col("_key")) & (F.col("_text_host") == F.col("_host"))
    blank = lambda x: ~x.rlike(r"[^\x20\x09-\x0D]")
    left = F.filter(F.split(row["text"], "\n"), lambda x: blank(x) | ~F.array_contains("_gone", F.xxhash64(_normal(x))))
    text = F.when(F.col("_gone").isNull(), row["text"]).otherwise(F.array_join(left, "\n"))
    met = rows.join(good, same).select(row, text.alias("_text"), F.col("_gone").isNull().alias("_whole"))
    n_chars = F.when(F.col("_whole"), row["n_chars"]).otherwise(F.length("_text").cast("long"))
    new = {"text": F.col("_text"), "n_chars": n_chars}
    return met.select(*[new.get(c, row[c]).alias(c) for c in docs.columns])


def quality_sql(params: QualityParams = QualityParams()) -> str:
    """DuckDB SQL of ``quality_rules``, by rows instead of arrays."""
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text, coalesce(source, '\0none') AS host FROM documents
), w AS (
  SELECT id, unnest(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS w,
    generate_subscripts(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), 1) AS i FROM d
), three AS (
  SELECT id, i, w, lead(w) OVER o AS w2, lead(w, 2) OVER o AS w3 FROM w WINDOW o AS (PARTITION BY id ORDER BY i)
), often AS (
  SELECT id, i FROM three WHERE w3 IS NOT NULL QUALIFY count(*) OVER (PARTITION BY id, w, w2, w3) > 1
), repeated AS (
  SELECT id, count(DISTINCT i + k) AS n FROM often, range(3) AS r(k) GROUP BY id
), counted AS (
  SELECT id, count(*) AS n_words, sum(length(w)) AS word_chars FROM w GROUP BY id
), lines AS (
  SELECT id, host, text, unnest(string_split(text, chr(10))) AS raw FROM d
), plain AS (
  SELECT id, host, text, raw, trim(regexp_replace(lower(raw), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS line
  FROM lines WHERE regexp_matches(raw, '[^\x20\x09-\x0D]')
), normal AS (
  SELECT id, host, text, raw, CASE WHEN len(string_split(line, ' ')) <= {DIGITS} THEN regexp_replace(line, '[0-9]+', '0', 'g') ELSE line END AS line
  FROM plain
), sized AS (SELECT *, len(string_split(line, ' ')) AS n FROM normal),
dups AS (SELECT id, count(*) - count(DISTINCT raw) AS n FROM normal GROUP BY id),
held AS (SELECT host, line, count(DISTINCT text) AS docs FROM sized GROUP BY ALL),
hosts AS (SELECT host, count(DISTINCT text) AS docs FROM d GROUP BY host),
lost AS (
  SELECT id, sum(n) AS lost FROM sized JOIN held USING (host, line) JOIN hosts USING (host)
  WHERE held.docs > {params.min_docs} AND held.docs * {params.share} > hosts.docs GROUP BY id
), f AS (
  SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(dups.n, 0)::BIGINT AS n_dup_lines,
    coalesce(repeated.n, 0)::BIGINT AS n_repeat_words, coalesce(lost, 0)::BIGINT AS n_boilerplate_words
  FROM d LEFT JOIN counted USING (id) LEFT JOIN dups USING (id) LEFT JOIN repeated USING (id) LEFT JOIN lost USING (id)
)
SELECT *, n_words < {params.min_words} OR 100 * n_repeat_words > {params.max_repeat_percent} * n_words AS base_failed,
  NOT base_failed AND 2 * n_boilerplate_words <= n_words AS kept
FROM f"""
