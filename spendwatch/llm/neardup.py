"""Near-duplicate detection by SetSketch registers, banded, estimated by likelihood, then verified.

1. One pass over the texts gives each document's shingle set size, a 128-bit name of the set,
   and its sketch (``setsketch``), stored in the shared folder. Texts are not stored.
2. Documents with equal sets are one class; the smallest id stands for it.
3. Representatives are banded: ``ROWS`` registers a band. Documents of similarity s share a
   register with a chance of at least s, so a link at 0.75 is missed by all 32 bands with a chance of 5e-6.
4. Stars: a bucket's documents are paired with its smallest id only. Pairs whose
   likelihood estimate is above ``ESTIMATE`` (five standard errors below the limit) are
   verified on the full sets, computed anew from the texts; linked documents are joined to parts of components.
5. Open buckets (of several parts) of up to ``SMALL`` documents: every pair across parts is
   estimated and verified likewise, at most ``SMALL - 1`` a document. Pairs inside a part can add nothing and are never made.
6. Larger open buckets are never paired out. Their documents are compared with one centre c, the least document of the
   part that holds most of the bucket: buckets of one group of copies share it, so a document is in about one cluster a group,
   whatever the number of bands. The exact overlaps with c bound the documents' own: x and y share at
   most ``min(|x & c|, |y & c|)`` shingles of c, and the link needs ``3 (|x| + |y|) / 7`` in all. So
   either the bound alone reaches the limit, which is decided on the few (size, overlap) classes of a cluster before any
   documents are paired; or they share shingles outside c, which documents of several parts hold. Only these are counted, the
   rarest first: a document can be linked by a shingle as its first shared one if c and the shingles from there on hold enough of
   its set, so most documents have none. Such shingles become new buckets. These go through 5 or, if larger, through 6 again with a centre of their
   own. Once all pairs of the large buckets are no more than the documents, or after ``ROUNDS`` rounds, they are paired as in 5,
   if the bound allows, so that no link is lost.
7. Components are made of all links at the end.

Rows: a NULL text or one without words has an empty set, links with nothing and stands alone; repeated
rows share a class; rows with one id are one document; a NULL id takes the component of an
equal set, if any (kept is false then, else true); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spendwatch.llm.common import salted_min, sliced, written
from spendwatch.llm.components import components
from spendwatch.llm.setsketch import REGISTERS, estimated, sketches
from spendwatch.llm.shingles import WordHashes, overlap, set_key, shingle_set

ROWS = 4
ESTIMATE = 0.55
#: Documents of a bucket that are paired with each other at most.
SMALL = 16
#: Rounds of centres for large buckets.
ROUNDS = 3
#: Shingles that are sketched together.
TOGETHER = 1 << 18


def sketched(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, n_shingles, set_key, registers) of every row; set key and registers NULL for an empty set."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        ids: list = []
        keys: list = []
        sets: list[np.ndarray] = []
        held = 0

        def out() -> pa.RecordBatch:
            sizes = np.array([len(s) for s in sets], np.int64)
            made = sketches(np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes), len(sets))
            columns = [
                pa.array(ids, pa.int64()),
                pa.array(keys, pa.int64()),
                pa.array(sizes),
                pa.array([set_key(s) if len(s) else None for s in sets], pa.binary()),
                pa.array([r.tobytes() if n else None for r, n in zip(made, sizes)], pa.binary()),
            ]
            ids.clear()
            keys.clear()
            sets.clear()
            return pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "n_shingles", "set_key", "registers"])

        for batch in batches:
            for doc, text, key in zip(*(batch.column(k) for k in range(3))):
                ids.append(doc.as_py())
                keys.append(key.as_py())
                sets.append(shingle_set(text.as_py(), hashes))
                held += len(sets[-1]) + 64
                if held > TOGETHER:
                    yield out()
                    held = 0
        if ids:
            yield out()

    rows = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"))
    return rows.mapInArrow(read, "doc_id long, text_key long, n_shingles long, set_key binary, registers binary")


def _estimate(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that size and likelihood leave."""
    side = lambda x: reps.select(
        F.col("doc_id").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("registers").alias(f"r_{x}")
    )
    rows = pairs.join(side("b"), "b").join(side("a"), "a")
    rows = rows.where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            regs = [np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, REGISTERS) for k in (4, 5)]
            sizes = [batch.column(k).to_numpy().astype(np.float64) for k in (2, 3)]
            like = estimated(*regs, *sizes) >= min(ESTIMATE, percent / 100 - 0.2)
            yield batch.select([0, 1]).filter(pa.array(like))

    return rows.select("a", "b", "n_a", "n_b", "r_a", "r_b").mapInArrow(read, "a long, b long")


def _with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b, t_a, t_b) of pairs."""
    side = lambda x: texts.select(F.col("doc_id").alias(x), F.col("text").alias(f"t_{x}"))
    return pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "t_a", "t_b")


class _Sets:
    """Sets of texts; those of the last few second texts, the star centres, are kept."""

    def __init__(self) -> None:
        self.hashes = WordHashes()
        self.last: dict[str, np.ndarray] = {}

    def both(self, a: str, b: str) -> tuple[np.ndarray, np.ndarray]:
        if b not in self.last:
            if len(self.last) >= 8:
                self.last.clear()
            self.last[b] = shingle_set(b, self.hashes)
        return shingle_set(a, self.hashes), self.last[b]


def _verify(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets are similar enough."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = _Sets()
        for batch in sliced(batches):
            keep = []
            for ta, tb in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                sa, sb = sets.both(ta, tb)
                both = overlap(sa, sb)
                keep.append(100 * both >= percent * (len(sa) + len(sb) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return _with_texts(pairs, texts).mapInArrow(read, "a long, b long")


_COMPARED = "doc_id long, centre long, n long, n_centre long, common long, outside array<long>"


def _compared(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Documents (a) with their centres (b): sizes, overlap, and the shingles outside the centre."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = _Sets()
        for batch in sliced(batches):
            rows = []
            for ta, tb in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                sa, sb = sets.both(ta, tb)
                out = np.setdiff1d(sa, sb, assume_unique=True)
                rows.append((len(sa), len(sb), len(sa) - len(out), out.view(np.int64)))
            columns = [batch.column(0), batch.column(1), *(pa.array([r[k] for r in rows], pa.int64()) for k in range(3))]
            columns.append(pa.array([r[3] for r in rows], pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in _COMPARED.split(", ")])

    return _with_texts(pairs, texts).mapInArrow(read, _COMPARED)


def hooked(links: DataFrame) -> DataFrame:
    """(doc_id, part): a part of each linked document's component: its least neighbour, that one's, and so on for four steps.

    Documents of one part are connected; a component can have several parts, which only leaves more pairs to try.
    """
    both = links.select(F.explode(F.array(F.struct(F.col("a").alias("doc_id"), "b"), F.struct(F.col("b").alias("doc_id"), F.col("a").alias("b")))).alias("s"))
    up = both.groupBy("s.doc_id").agg(F.min("s.b").alias("b")).select("doc_id", F.least("doc_id", "b").alias("up"))
    up = written(up, "hooks")  # the joins below read it four times
    for _ in range(2):
        # each join doubles the steps
        above = up.select(F.col("doc_id").alias("up"), F.col("up").alias("top"))
        up = up.join(above, "up", "left").select("doc_id", F.coalesce("top", "up").alias("up"))
    return written(up.select("doc_id", F.col("up").alias("part")), "parts")


def _ordered_pairs(pairs: DataFrame) -> DataFrame:
    """Distinct pairs with the greater id first."""
    return pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()


def _linked(rows: DataFrame, percent: int) -> DataFrame:
    """The links among documents that were compared with their centres."""
    near = 100 * F.col("common") >= percent * (F.col("n") + F.col("n_centre") - F.col("common"))
    return rows.where(near).select(F.col("doc_id").alias("a"), F.col("centre").alias("b"))


def _part_of(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """Adds each document's part; one without links is its own."""
    return rows.join(parts, "doc_id", "left").withColumn("part", F.coalesce("part", "doc_id"))


def _across(rows: DataFrame, allowed: Column | None = None) -> DataFrame:
    """All pairs across parts within small buckets (bucket, doc_id, part), if ``allowed`` by their columns."""
    right = rows.select(*[F.col(c).alias("bucket" if c == "bucket" else f"{c}_2") for c in rows.columns])
    pairs = rows.join(right, "bucket").where("part < part_2")
    pairs = pairs if allowed is None else pairs.where(allowed)
    return _ordered_pairs(pairs.select(F.col("doc_id").alias("a"), F.col("doc_id_2").alias("b")))


def _reachable(percent: int) -> Column:
    """Whether two documents of a cluster can be linked if this is their first shared shingle in order.

    They share at most the lesser overlap inside the centre, and what comes from this place on outside.
    """
    most = F.least("common", "common_2") + F.least("rest", "rest_2")
    return (100 + percent) * most >= percent * (F.col("n") + F.col("n_2"))


def _centred(rows: DataFrame, parts: DataFrame, turn: int) -> DataFrame:
    """(bucket, doc_id, centre) of open buckets.

    At first the centre is the least document of the part that most rows are in, which other buckets share; later it is one of
    the bucket's own, another one each turn, so that the shingle that made the bucket is inside the centre.
    """
    named = _part_of(rows, parts)
    if turn == 0:
        held = named.groupBy("bucket", "part").agg(F.count(F.lit(1)).alias("n"))
        best = F.max_by("part", F.struct("n", -F.col("part")))
        centres = held.groupBy("bucket").agg(best.alias("centre"), F.count(F.lit(1)).alias("of")).where("of > 1")
    else:
        drawn = F.min_by("doc_id", F.struct(F.xxhash64("doc_id", F.lit(turn)), "doc_id"))
        centres = named.groupBy("bucket").agg(drawn.alias("centre"), F.min("part").alias("p0"), F.max("part").alias("p1")).where("p0 < p1")
    return named.select("bucket", "doc_id").join(centres.select("bucket", "centre"), "bucket")


def _named(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """Clusters with their parts, without those that are one part."""
    named = _part_of(rows, parts)
    centre = parts.select(F.col("doc_id").alias("centre"), F.col("part").alias("centre_part"))
    named = named.join(centre, "centre", "left").withColumn("centre_part", F.coalesce("centre_part", "centre"))
    several = named.groupBy("centre").agg(F.count_if(F.col("part") != F.col("centre_part")).alias("apart")).where("apart > 0")
    return written(named.join(several.select("centre"), "centre"), "named")


def _by_bound(named: DataFrame, percent: int) -> DataFrame:
    """Pairs of a cluster across parts whose overlaps with the centre alone can reach the limit.

    Decided on the cluster's distinct (size, overlap) classes; a class can only take part if the
    centre holds ``percent`` of its shingles, and one of the two is outside the centre's part.
    """
    inside = named.where(100 * F.col("common") >= percent * F.col("n"))
    kinds = inside.groupBy("centre", "n", "common").agg(F.max((F.col("part") != F.col("centre_part")).cast("int")).alias("apart"))
    other = kinds.select("centre", F.col("n").alias("m"), F.col("common").alias("shared"))
    enough = (100 + percent) * F.least("common", "shared") >= percent * (F.col("n") + F.col("m"))
    near = kinds.where("apart = 1").join(other, "centre").where(enough).select("centre", "n", "common", "m", "shared")
    left = inside.where("part <> centre_part").select("centre", "n", "common", F.col("doc_id").alias("a"), "part")
    right = inside.select(
        "centre", F.col("n").alias("m"), F.col("common").alias("shared"), F.col("doc_id").alias("b"), F.col("part").alias("other")
    )
    pairs = left.join(near, ["centre", "n", "common"]).join(right, ["centre", "m", "shared"]).where("part <> other")
    return _ordered_pairs(pairs.select("a", "b"))


def _by_shingle(named: DataFrame, percent: int) -> DataFrame:
    """Documents of a cluster that can be linked by shingles outside the centre with a document of another part.

    (bucket, size, doc_id, part, n, common, rest): documents that share a shingle. ``rest`` counts those of the document's outside shingles that
    several parts of the cluster hold, from the shared one on, in an order that all documents use: the rarest come first. A link shares
    at least ``percent`` of a document's set, inside the centre and in the shingles counted by ``rest`` at its first shared one.
    Shingles that the same documents share (a passage) are one bucket, with the most that any of them leaves.
    """
    spread = named.select("centre", "doc_id", "part", "n", "common", F.explode("outside").alias("shingle"))
    held = spread.groupBy("centre", "shingle").agg(
        F.min("part").alias("p0"), F.max("part").alias("p1"), F.count(F.lit(1)).alias("held"), F.expr("bit_xor(xxhash64(doc_id, 1))").alias("who"),
        F.expr("bit_xor(xxhash64(doc_id, 2))").alias("whose"),
    )
    shared = held.where("p0 < p1").select("centre", "shingle", "held", "who", "whose")
    last = Window.partitionBy("centre", "doc_id").orderBy(F.desc("held"), F.desc("shingle"))
    met = spread.join(shared, ["centre", "shingle"]).withColumn("rest", F.row_number().over(last).cast("long"))
    met = met.where(100 * (F.col("common") + F.col("rest")) >= percent * F.col("n"))
    bucket = F.xxhash64("centre", "held", "who", "whose").alias("bucket")
    met = written(met.groupBy(bucket, "doc_id", "part", "n", "common").agg(F.max("rest").alias("rest")), "first-shared")
    several = met.groupBy("bucket").agg(F.min("part").alias("p0"), F.max("part").alias("p1"), F.count(F.lit(1)).alias("size"))
    several = several.where("p0 < p1").select("bucket", "size")
    return met.join(several, "bucket").select("bucket", "size", "doc_id", "part", "n", "common", "rest")


def near_duplicates(docs: DataFrame, percent: int = 75) -> DataFrame:
    """Set size, component and verdict of every document; links are those of at least ``percent`` similarity.

    ``text_key`` and ``set_key`` tell rows with equal ids apart.
    """
    made = written(sketched(docs), "sketches")
    full = salted_min(made.where("n_shingles > 0").select("doc_id", "n_shingles", "set_key"), ["n_shingles", "set_key"], "doc_id", "rep")
    classes = written(full.select("doc_id", "n_shingles", "set_key", "rep").distinct(), "classes")
    chosen = classes.where("doc_id = rep").select(F.col("doc_id").alias("id"), F.col("set_key").alias("key"))
    reps = written(
        made.join(chosen, (F.col("doc_id") == F.col("id")) & (F.col("set_key") == F.col("key")))
        .select("doc_id", "n_shingles", "registers")
        .distinct(),
        "representatives",
    )
    texts = docs.select("doc_id", "text")
    bands = REGISTERS // ROWS
    spread = reps.select("doc_id", "registers", F.explode(F.sequence(F.lit(0), F.lit(bands - 1))).alias("band"))
    members = spread.select("doc_id", F.xxhash64("band", F.expr(f"substring(registers, band * {ROWS} + 1, {ROWS})")).alias("bucket"))
    crowded = members.groupBy("bucket").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.count(F.lit(1)).alias("n"))
    crowded = crowded.where("least < most").select("bucket", "least", (F.col("n") > SMALL).alias("large"))
    buckets = written(members.join(crowded, "bucket"), "buckets")

    def tried(pairs: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
        """Pairs as they were tried, and the links among them."""
        pairs = written(_ordered_pairs(pairs), name)
        return pairs, written(_verify(_estimate(pairs, reps, percent), texts, percent), "links")

    pairs, links = tried(buckets.select(F.col("doc_id").alias("a"), F.col("least").alias("b")), "pairs")
    parts = hooked(links)
    small = _across(_part_of(buckets.where("not large").select("bucket", "doc_id"), parts))
    links = links.union(tried(small.join(pairs, ["a", "b"], "left_anti"), "pairs")[1])
    open_rows = buckets.where("large").select("bucket", "doc_id")
    known = None
    for turn in range(ROUNDS):
        if open_rows.isEmpty():
            break
        star = written(_centred(open_rows, parts, turn).select("doc_id", "centre").distinct(), "centred")
        asked = star.where("doc_id <> centre").select(F.col("doc_id").alias("a"), F.col("centre").alias("b"))
        if known is None:
            known = rows = written(_compared(asked, texts), "clusters")
        else:
            # what an earlier round compared is in the cluster by its figures of then
            new = _compared(asked.join(known.select(F.col("doc_id").alias("a"), F.col("centre").alias("b")), ["a", "b"], "left_anti"), texts)
            new = written(new, "clusters")
            rows = new.unionByName(known.join(star, ["doc_id", "centre"], "left_semi"))
            known = known.unionByName(new)
        links = links.union(_linked(rows, percent))
        parts = hooked(links)
        named = _named(rows, parts)
        met = written(_by_shingle(named, percent), "met")
        crossing = met.where(F.col("size") > SMALL).agg(F.sum(F.col("size") - 1) / 2).first()[0] or 0
        last = turn == ROUNDS - 1 or crossing <= reps.count()
        paired = F.lit(True) if last else F.col("size") <= SMALL
        direct = _across(met.where(paired).drop("size"), _reachable(percent))
        links = links.union(tried(_by_bound(named, percent).union(direct), "pairs")[1])
        if last:
            break
        open_rows = written(met.where(~paired).select("bucket", "doc_id"), "open")
    joined = components(links, "a", "b")
    best = joined.select(F.col("node").alias("rep"), "component")
    placed = classes.join(best, "rep", "left").select(
        F.col("doc_id").alias("_id"),
        F.col("set_key").alias("_key"),
        F.coalesce("component", "rep").alias("component_id"),
    )
    rows = made.select("doc_id", "text_key", "n_shingles", "set_key").join(
        placed, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("set_key") == F.col("_key")), "left"
    )
    component = F.coalesce("component_id", "doc_id")
    return rows.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"),
        "text_key",
        "set_key",
    )
