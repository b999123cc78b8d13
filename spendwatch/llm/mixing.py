r"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

1. Size of a document: its words. Sources in code point order, NULL last, get the weights in turn; the mix is ``percent``
   of all sizes. A target stops at ``most`` times its source's size; what is over goes to the others by weight, until none is above.
2. A source's documents, in a hashed order, are one stream of words, cut into blocks. Its quota of blocks is exact: whole passes
   over the stream, then blocks of one more pass, the last cut to the word, so that the target is met within half a word.
3. The quotas of all sources are split among the output shards by a tree: a node has as many blocks as its shards hold, and a
   multivariate hypergeometric draw says how many of each source go left. Sources are split in two steps, groups of
   ``GROUP`` neighbours on the driver and then, with each group's shares fixed, the sources of a group in a task of its own.
4. In each pass a source's blocks are permuted (a keyed Feistel network, computed where it is needed), and shards take disjoint
   runs of them. A document's pieces follow from its place in the stream; ``order_key`` shuffles the pieces of a shard.

A source may hold any share of the rows: its stream is ordered in about the square root of its documents hashed ranges, whose
totals are added up first. The driver holds a row per range-sorted partition of the sources, and per group of sources.

Rows: a NULL text has size 0; documents without words get nothing; a NULL source is one source; repeated rows are documents of their
own, equal ones in either order; NULL ids are ordered first; long texts become several pieces; an empty table gives
an empty result. Only ``doc_id``, ``text``, ``source`` and the columns named in ``keep`` are read; ``keep`` must not name columns that
the result adds.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spendwatch.llm.common import written
from spendwatch.llm.shingles import mixed

WORD = r"[^\x20\x09-\x0D]+"
#: Sources that are split among shards in one task.
GROUP = 4096
#: Blocks of the mix at most (numpy draws from fewer than 10^9), besides one a source; blocks grow beyond.
MOST_BLOCKS = 1 << 28


@dataclass(frozen=True)
class MixParams:
    weights: tuple[int, ...] = (3, 1, 2)
    percent: int = 150
    most: int = 2
    shards: int = 64
    block_words: int = 4096
    seed: int = 42


# -- sources, targets, quotas ------------------------------------------------


def _sized(docs: DataFrame, params: MixParams, keep: Sequence[str]) -> DataFrame:
    """(doc_id, source, size, h, kept columns); ``h`` orders the documents of a source."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    h = F.xxhash64(F.lit(params.seed), "doc_id", "source", "text")
    return docs.select("doc_id", "source", size.alias("size"), h.alias("h"), *keep)


def _ranked(sources: DataFrame) -> DataFrame:
    """Adds ``rank``, the place in code point order: places in sorted partitions, moved by the rows of those before."""
    # stored, so that row numbers are those of one run
    rows = written(
        sources.orderBy(F.col("source").asc_nulls_last()).withColumn("at", F.monotonically_increasing_id()), "sources"
    ).withColumn("run", F.shiftright("at", 33))
    counts = sorted(rows.groupBy("run").agg(F.count(F.lit(1)).alias("n")).collect())
    before, runs = 0, []
    for run, n in counts:
        runs.append((run, before))
        before += n
    moved = rows.sparkSession.createDataFrame(runs, "run long, before long")
    rank = F.col("at") - F.shiftleft("run", 33) + F.col("before")
    return rows.join(moved, "run").withColumn("rank", rank).drop("at", "run", "before")


def _targets(sources: DataFrame, params: MixParams) -> DataFrame:
    """Adds ``weight`` and ``target``; each step caps the sources that the present level puts at or above their limit."""
    weight = F.element_at(F.array(*map(F.lit, params.weights)), (F.col("rank") % len(params.weights) + 1).cast("int"))
    rows = sources.withColumn("weight", weight.cast("double"))
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    limit = params.most * F.col("source_size").cast("double")
    all_words = total * params.percent / 100.0
    capped, rest, open_weight = -1, all_words, rows.agg(F.sum("weight")).first()[0] or 0.0
    while True:
        share = F.lit(rest) * F.col("weight") / F.lit(open_weight) if open_weight else limit
        over = share >= limit
        now = rows.agg(F.count_if(over), F.sum(F.when(over, limit)), F.sum(F.when(~over, F.col("weight")))).first()
        if now[0] == capped:
            return rows.withColumn("target", F.least(share, limit))
        capped, rest, open_weight = now[0], all_words - (now[1] or 0.0), now[2] or 0.0


def _quotas(sources: DataFrame, params: MixParams) -> DataFrame:
    """Adds block length, blocks, whole passes, the words of the last pass, its blocks, and the quota in blocks."""
    total = sources.agg(F.sum("target")).first()[0] or 0.0
    length = max(params.block_words, int(-(-total // MOST_BLOCKS)))
    rows = sources.withColumns({
        "length": F.lit(length).cast("long"),
        "blocks": F.ceil(F.col("source_size") / F.lit(length)).cast("long"),
        "words": F.floor(F.col("target") + F.lit(0.5)).cast("long"),
    })
    size = F.greatest("source_size", F.lit(1))
    rows = rows.withColumn("passes", F.floor(F.col("words") / size).cast("long"))

    def last_pass(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in frames:
            x["rest"] = x["words"] - x["passes"] * x["source_size"]
            rank, rest, blocks = (x[c].to_numpy(np.int64) for c in ("rank", "rest", "blocks"))
            least = -(-rest // length)
            begins = before(least, rank, x["passes"].to_numpy(np.int64), blocks, x["source_size"].to_numpy(np.int64), length, params.seed)
            x["last_blocks"] = np.where(begins < rest, least + 1, least)
            x["quota"] = x["passes"] * x["blocks"] + x["last_blocks"]
            yield x

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", rest long, last_blocks long, quota long"
    return rows.mapInPandas(last_pass, schema)


# -- permuted blocks ---------------------------------------------------------


def place(block: np.ndarray, blocks: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Place of each block in a keyed permutation of its ``blocks`` (a Feistel network, walked until inside)."""
    blocks = np.maximum(blocks, 1).astype(np.uint64)
    half = np.maximum((np.ceil(np.log2(blocks.astype(np.float64))).astype(np.uint64) + np.uint64(2)) // np.uint64(2), 1).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    x = block.astype(np.uint64)
    todo = np.arange(len(x))
    while len(todo):
        h, m, k = half[todo], mask[todo], key[todo]
        left, right = x[todo] >> h, x[todo] & m
        for turn in range(4):
            left, right = right, left ^ (mixed(right + k + np.uint64(turn * 0x9E3779B97F4A7C15 % 2**64)) & m)
        x[todo] = (left << h) | right
        todo = todo[x[todo] >= blocks[todo]]
    return x.astype(np.int64)


def pass_key(rank: np.ndarray, turn: np.ndarray, seed: int) -> np.ndarray:
    return mixed(mixed(rank.astype(np.uint64) + np.uint64(seed)) + turn.astype(np.uint64))


def before(at: np.ndarray, rank: np.ndarray, turn: np.ndarray, blocks: np.ndarray, size: np.ndarray, length: int, seed: int) -> np.ndarray:
    """Words in the first ``at`` places of a pass: all blocks are of one length but the stream's last."""
    last = place(np.maximum(blocks - 1, 0), blocks, pass_key(rank, turn, seed))
    return at * length - (at > last) * (blocks * length - size)


# -- the splitting tree ------------------------------------------------------


def split(quotas: np.ndarray, room: np.ndarray, key: Sequence[int]) -> np.ndarray:
    """(quotas, shards): how many blocks of each quota every shard gets; columns add up to ``room``, rows to ``quotas``."""
    made = np.zeros((len(quotas), len(room)), np.int64)
    nodes = [(quotas.astype(np.int64), 0, len(room))]
    while nodes:
        have, low, high = nodes.pop()
        if high - low == 1:
            made[:, low] = have
            continue
        middle = (low + high) // 2
        draw = np.random.default_rng([*key, low, high])
        left = draw.multivariate_hypergeometric(have, int(room[low:middle].sum()), method="marginals")
        nodes += [(left, low, middle), (have - left, middle, high)]
    return made


def _planned(quotas: DataFrame, params: MixParams) -> DataFrame:
    """Adds ``ends``, the running totals of a source's blocks over the shards."""
    rows = quotas.withColumn("group", F.floor(F.col("rank") / GROUP).cast("long"))
    groups = sorted(rows.groupBy("group").agg(F.sum("quota").alias("n")).collect())
    total = sum(r["n"] for r in groups)
    room = np.array([total // params.shards + (k < total % params.shards) for k in range(params.shards)], np.int64)
    shares = split(np.array([r["n"] for r in groups], np.int64), room, (params.seed, 0))
    given = rows.sparkSession.createDataFrame(
        [(r["group"], row.tolist()) for r, row in zip(groups, shares)], "group long, room array<long>"
    )

    def one(x: pd.DataFrame) -> pd.DataFrame:
        x = x.sort_values("rank")
        group, room = int(x["group"].iloc[0]), np.array(x["room"].iloc[0], np.int64)
        x["ends"] = list(np.cumsum(split(x["quota"].to_numpy(np.int64), room, (params.seed, 1, group)), axis=1))
        return x.drop(columns=["group", "room"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in quotas.schema) + ", ends array<long>"
    return rows.join(given, "group").groupBy("group").applyInPandas(one, schema)


def mix_plan(sized: DataFrame, params: MixParams = MixParams()) -> DataFrame:
    """One row a source: rank, size, target, quota and the shards' shares of it."""
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    targets = written(_targets(_ranked(sources), params), "targets")
    return written(_planned(_quotas(targets, params), params), "plan")


# -- documents ---------------------------------------------------------------


def _streamed(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """Adds the source's rank and the document's first word in its source's stream."""
    near = plan.select(F.col("source").alias("_of"), "rank", F.ceil(F.sqrt("docs")).cast("long").alias("ranges"))
    rows = sized.join(near, sized["source"].eqNullSafe(near["_of"])).drop("_of")
    rows = rows.withColumn("range", F.pmod("h", "ranges")).drop("ranges")
    sums = rows.groupBy("rank", "range").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("rank").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("rank", "range", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("rank", "range").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("offset") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    return rows.join(sums, ["rank", "range"]).withColumn("first", first).drop("range", "offset")


PIECES = "array<struct<shard:int,order_key:long,turn:int,first_word:long,words:long>>"


def _pieces(x: dict[str, np.ndarray], ends: np.ndarray, params: MixParams) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Pieces of a batch's documents: number of each piece's document, and the columns of the pieces."""
    size, first, length = x["size"], x["first"], x["length"]
    low = first // length
    many = np.where(size > 0, (first + size - 1) // length - low + 1, 0)
    doc = np.repeat(np.arange(len(size)), many)
    block = np.repeat(low, many) + np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
    # whole passes and the last one
    doc, block = np.repeat(doc, params.most + 1), np.repeat(block, params.most + 1)
    turn = np.tile(np.arange(params.most + 1), len(doc) // (params.most + 1))
    near = turn <= x["passes"][doc]
    doc, block, turn = doc[near], block[near], turn[near]
    g = {name: x[name][doc] for name in ("size", "first", "length", "rank", "blocks", "source_size", "passes", "rest", "h")}
    at = place(block, g["blocks"], pass_key(g["rank"], turn, params.seed))
    begin = block * g["length"]
    step = int(length[0]) if len(length) else 1
    spent = before(at, g["rank"], turn, g["blocks"], g["source_size"], step, params.seed)
    until = np.where(turn < g["passes"], g["length"], np.clip(g["rest"] - spent, 0, g["length"]))
    start = np.maximum(g["first"], begin)
    words = np.minimum(g["first"] + g["size"], begin + until) - start
    used = words > 0
    shard = (ends[doc[used]] <= (turn * g["blocks"] + at)[used][:, None]).sum(axis=1)
    key = mixed(mixed(g["h"].astype(np.uint64) + start.astype(np.uint64)) + turn.astype(np.uint64))
    return doc[used], {
        "shard": shard.astype(np.int32),
        "order_key": key[used].view(np.int64),
        "turn": turn[used].astype(np.int32),
        "first_word": (start - g["first"])[used],
        "words": words[used],
    }


def drawn(docs: DataFrame, params: MixParams = MixParams(), keep: Sequence[str] = ()) -> DataFrame:
    """Every document with its size, its source's size and target, and the pieces of it that the mix takes."""
    sized = written(_sized(docs, params, keep), "sizes")
    plan = mix_plan(sized, params)
    facts = plan.select("rank", "source_size", "target", "length", "blocks", "passes", "rest", "ends")
    rows = _streamed(sized, plan).join(facts, "rank")
    numbers = ["size", "first", "length", "rank", "blocks", "source_size", "passes", "rest", "h"]
    given = ["doc_id", "source", "size", "source_size", "target", *keep]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            x = {name: batch.column(name).to_numpy(zero_copy_only=False) for name in numbers}
            ends = batch.column("ends").flatten().to_numpy(zero_copy_only=False).reshape(n, params.shards)
            doc, pieces = _pieces(x, ends, params)
            offsets = np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=n)))).astype(np.int32)
            made = pa.StructArray.from_arrays([pa.array(c) for c in pieces.values()], list(pieces))
            lists = pa.ListArray.from_arrays(pa.array(offsets), made)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in given), lists], [*given, "pieces"])

    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join(f"`{c}` {types[c]}" for c in given) + f", pieces {PIECES}"
    return rows.select(*given, *[c for c in [*numbers, "ends"] if c not in given]).mapInArrow(read, schema)


def taken(pieces: Column) -> Column:
    """Words in pieces."""
    return F.aggregate(pieces, F.lit(0).cast("long"), lambda a, p: a + p["words"])


def mixture(docs: DataFrame, params: MixParams = MixParams()) -> DataFrame:
    """The mix itself: (shard, order_key, doc_id, source, turn, text), a row a piece.

    A whole document keeps its text; words of a part are one space apart.
    """
    rows = drawn(docs, params, ["text"])
    rows = rows.select("doc_id", "source", "size", "text", F.explode("pieces").alias("p")).select("*", "p.*")
    part = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(f"({WORD})")), F.col("first_word") + 1, F.col("words")), " ")
    text = F.when(F.col("words") == F.col("size"), F.col("text")).otherwise(part)
    return rows.select("shard", "order_key", "doc_id", "source", "turn", text.alias("text"))


def write_mixture(spark: SparkSession, docs: DataFrame, path: str, params: MixParams = MixParams()) -> None:
    """The mix as Parquet, a folder a shard; the files of a shard are sorted ranges of its shuffled order."""
    rows = mixture(docs, params).repartitionByRange("shard", "order_key").sortWithinPartitions("shard", "order_key")
    rows.write.partitionBy("shard").parquet(path)


def mix_report(docs: DataFrame, params: MixParams = MixParams()) -> DataFrame:
    """Size, target and taken words of every document, with the shards that hold its pieces."""
    return drawn(docs, params).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        taken(F.col("pieces")).alias("taken"),
        F.size("pieces").cast("long").alias("n_pieces"),
        F.array_sort(F.array_distinct(F.transform("pieces", lambda p: p["shard"]))).alias("shards"),
    )
