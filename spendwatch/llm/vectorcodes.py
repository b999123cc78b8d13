"""Product codes of vectors: Lloyd rounds in integers, assigned through cover trees.

1. Vectors become integers, ``floor(scale * x)``, and are cut into ``parts`` equal consecutive parts.
2. Each task builds cover trees (``covertree``) over blocks of ``BLOCK`` of its vectors, one tree a part, with cumulative
   sums, and writes them to the shared folder once: the rounds read trees, not vectors.
3. A round assigns whole subtrees by the triangle inequality and compares only what stays open; tasks send at most one row per
   part and entry, Spark adds them up, and the driver holds the codebooks alone (parts x entries, a fixed bound).
4. After the last round the parts are assigned again; codes and errors are stored, and the errors of a label are summed over
   salted groups.

A lost executor costs its tasks of one round; trees and codes are in the shared folder.

Rows: a NULL vector, or one with NULL, NaN or infinite components, is dropped, and so is one whose length differs from that of the
first start vector; a length that the parts do not divide is filled up with zeros; integers beyond 2^26 in size stay
there, so that errors fit a long. A NULL id is coded but starts no entry; of rows with one id the least vector starts one;
fewer ids than entries give a smaller codebook. Ties go to the lower entry. Repeated rows each get a row. NULL labels are one
label. An empty table gives an empty result. Only the id, vector and label columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendwatch.llm.common import written
from spendwatch.llm.covertree import TYPES, Forest, codes, grown, totals

#: Vectors of a block; a stored row number has 16 bits.
BLOCK = 8192
MOST = 1 << 26
#: Parts that a label's rows are dealt to.
SALTS = 64


@dataclass(frozen=True)
class CodeParams:
    parts: int = 8
    entries: int = 16
    rounds: int = 6
    scale: int = 4096


def usable(vectors: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is there and finite throughout."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.where(F.col(vector).isNotNull() & ~bad)


def whole(values: np.ndarray, params: CodeParams) -> np.ndarray:
    """Integers of components (n, length) as (parts, n, width)."""
    n, length = values.shape
    width = max(1, -(-length // params.parts))
    made = np.zeros((n, params.parts * width), np.int64)
    made[:, :length] = np.clip(np.floor(values * float(params.scale)), -MOST, MOST)
    return np.ascontiguousarray(made.reshape(n, params.parts, width).transpose(1, 0, 2))


def start_books(kept: DataFrame, vec_id: str, vector: str, params: CodeParams) -> tuple[np.ndarray | None, int]:
    """The parts of the vectors of the least ids, (parts, entries, width), and the length of vectors."""
    ids = kept.where(F.col(vec_id).isNotNull()).select(vec_id).distinct().orderBy(vec_id).limit(params.entries).collect()
    if not ids:
        return None, 0
    rows = kept.where(F.col(vec_id).isin([r[0] for r in ids])).groupBy(vec_id).agg(F.min(vector)).collect()
    first = [np.array(r[1], np.float64) for r in sorted(rows, key=lambda r: r[0])]
    length = len(first[0])
    return whole(np.array([v for v in first if len(v) == length]), params), length


_TREE = T.StructType([T.StructField("n", T.LongType()), *[T.StructField(name, T.BinaryType()) for name in TYPES]])


def tree_blocks(rows: DataFrame, length: int, params: CodeParams) -> DataFrame:
    """(ids, labels, trees) per block of the rows (id, vector, label)."""
    id_type, label_type = rows.schema[0].dataType, rows.schema[2].dataType
    schema = T.StructType([T.StructField("ids", T.ArrayType(id_type)), T.StructField("labels", T.ArrayType(label_type)), *_TREE])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            ids, vectors, labels = (pa.concat_arrays([b.column(k) for b in held]) for k in range(3))
            forest = grown(whole(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(ids), length), params))
            lists = [pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a) for a in (ids, labels)]
            columns = [*lists, pa.array([len(ids)], pa.int64()), *[pa.array([b], pa.binary()) for b in forest.packed()]]
            return pa.RecordBatch.from_arrays(columns, schema.names)

        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                take = batch.slice(at, BLOCK - size)
                held.append(take)
                at += take.num_rows
                size += take.num_rows
                if size == BLOCK:
                    yield made(held)
                    held, size = [], 0
        if held:
            yield made(held)

    return rows.mapInArrow(read, schema)


def _forests(width: int, batch: pa.RecordBatch, at: int) -> Iterator[tuple[int, Forest]]:
    for k in range(batch.num_rows):
        yield k, Forest.unpacked([batch.column(at + i)[k].as_buffer() for i in range(len(TYPES))], width)


def lloyd_round(trees: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one assignment of all parts."""
    parts, entries, width = books.shape

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros((parts, entries), np.int64), np.zeros(books.shape, np.int64)
        for batch in batches:
            for _, forest in _forests(width, batch, 0):
                c, s = totals(forest, books)
                counts += c
                sums += s
        p, e = np.nonzero(counts)
        columns = [pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(counts[p, e]), pa.array(list(sums[p, e]), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["part", "entry", "n", "sums"])

    rows = trees.select(*TYPES).mapInArrow(read, "part int, entry int, n long, sums array<long>")
    added = rows.groupBy("part", "entry").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i].cast("decimal(38,0)")) for i in range(width)]).alias("sums")
    )
    after = books.copy()
    for r in added.collect():  # at most parts x entries rows
        after[r["part"], r["entry"]] = [int(x) // r["n"] for x in r["sums"]]
    return after


def coded(trees: DataFrame, books: np.ndarray, names: tuple[str, str]) -> DataFrame:
    """(id, label, code, error) of every vector."""
    width = books.shape[2]
    id_type, label_type = (trees.schema[k].dataType.elementType for k in range(2))
    schema = T.StructType([
        T.StructField(names[0], id_type), T.StructField(names[1], label_type),
        T.StructField("code", T.StringType()), T.StructField("error", T.LongType()),
    ])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, forest in _forests(width, batch, 2):
                found, error = codes(forest, books)
                text = [row.tobytes().hex() for row in found]
                columns = [batch.column(0)[k].values, batch.column(1)[k].values, pa.array(text, pa.string()), pa.array(error)]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return trees.select("ids", "labels", *TYPES).mapInArrow(read, schema)


def with_label_error(rows: DataFrame, label: str) -> DataFrame:
    """Adds the errors summed over equal labels; a label may hold any share of the rows, so its rows are dealt to salts."""
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).cast("int"))
    parts = salted.groupBy(label, "_salt").agg(F.sum("error").alias("_part"))
    met = parts.groupBy(label).agg(F.sum("_part").alias("label_error"), F.collect_list("_salt").alias("_salts"))
    back = met.select(F.col(label).alias("_label"), "label_error", F.explode("_salts").alias("_of"))
    on = salted[label].eqNullSafe(back["_label"]) & (F.col("_salt") == F.col("_of"))
    return salted.join(back, on).drop("_salt", "_label", "_of")


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of the entries' components in decimal, by part, entry and place."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def compressed(
    vectors: DataFrame,
    params: CodeParams = CodeParams(),
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    seen: Callable[[np.ndarray], None] | None = None,
) -> DataFrame:
    """(id, label, code, error, codebooks_sha256) of every usable vector. ``seen`` gets the final codebooks."""
    kept = usable(vectors.select(vec_id, vector, label), vector)
    books, length = start_books(kept, vec_id, vector, params)
    if books is None:
        # without ids there are no entries
        empty = kept.where(F.lit(False)).select(vec_id, label)
        return empty.select("*", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit("").alias("codebooks_sha256"))
    trees = written(tree_blocks(kept.where(F.size(vector) == length), length, params), "trees")
    for _ in range(params.rounds):
        books = lloyd_round(trees, books)
    if seen:
        seen(books)
    return written(coded(trees, books, (vec_id, label)), "codes").withColumn("codebooks_sha256", F.lit(books_digest(books)))


def compress_report(vectors: DataFrame, params: CodeParams = CodeParams()) -> DataFrame:
    """Code, error and label error of every vector, with the digest of the codebooks."""
    rows = with_label_error(compressed(vectors, params).select("vec_id", "label", "code", "error", "codebooks_sha256"), "label")
    return rows.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def compress_sql(params: CodeParams = CodeParams(), width: int = 8) -> str:
    """DuckDB SQL of ``compress_report`` for vectors of ``parts * width`` components: every part meets every entry."""
    p = params
    steps = range(1, width + 1)
    gap = " + ".join(f"(x[{i}] - e[{i}]) * (x[{i}] - e[{i}])" for i in steps)
    sql = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS id, vec_id, label, list_transform(embedding, lambda c: floor({p.scale} * c::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL
    AND list_count(embedding) = len(embedding) AND len(list_filter(embedding, lambda c: NOT isfinite(c))) = 0
), cut AS MATERIALIZED (
  SELECT id, vec_id, part, v[part * {width} + 1:part * {width} + {width}] AS x FROM kept, range({p.parts}) r(part)
), firsts AS (
  SELECT DISTINCT vec_id FROM kept WHERE vec_id IS NOT NULL ORDER BY vec_id LIMIT {p.entries}
), book0 AS MATERIALIZED (
  SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, x AS e FROM cut WHERE vec_id IN (FROM firsts)
)"""
    for k in range(p.rounds + 1):
        sql += f""", near{k} AS MATERIALIZED (
  SELECT id, part, x, min({{'d': {gap}, 'entry': entry}}) AS best FROM cut JOIN book{k} USING (part) GROUP BY ALL
)"""
        if k < p.rounds:
            mean = ", ".join(f"floor(sum(x[{i}])::DOUBLE / count(*))::BIGINT" for i in steps)
            sql += f""", book{k + 1} AS MATERIALIZED (
  SELECT part, entry, coalesce(m, e) AS e FROM book{k} LEFT JOIN (
    SELECT part, best.entry AS entry, [{mean}] AS m FROM near{k} GROUP BY ALL) USING (part, entry)
)"""
    return sql + f""", code AS (
  SELECT id, string_agg(printf('%02x', best.entry), '' ORDER BY part) AS code, sum(best.d)::BIGINT AS error FROM near{p.rounds} GROUP BY id
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY part, entry)) FROM book{p.rounds}) AS codebooks_sha256
FROM code JOIN kept USING (id)"""
