"""Sharding by a hierarchical weighted hash tree: region, rack, shard (native).

A row descends the tree by weighted hash draws: at a node each child gets
``-ln(u) / weight`` with ``u`` drawn from the child's path and the row's key,
and the least draw wins. A child's draw depends on nothing but its own path,
weight and the key, so a changed weight moves rows only into or out of the
subtree that holds it. A cluster grows by a new region, so with one
more shard rows move only into that shard (the ``key`` law).

Rows: NULL doc_ids are one key, NULL texts have no bytes (size 1, CRC-32 0), repeated
rows get slots of their own, an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Parts of a shard within which slots are numbered; bounds the offset table at shards x parts rows.
SLOT_PARTS = 4096


@dataclass(frozen=True)
class Node:
    """A leaf holds a shard number; an inner node its children. The path names the node in the draws."""

    path: str
    weight: float
    shard: int | None = None
    children: tuple["Node", ...] = ()


def region(name: str, shards: list[int], per_rack: int = 2, weight: float = 1.0) -> Node:
    """A region of racks of ``per_rack`` shards each; weights add up to the root."""
    racks = []
    for r in range(0, len(shards), per_rack):
        path = f"{name}/rack{r // per_rack}"
        leaves = tuple(Node(f"{path}/shard{s}", weight, s) for s in shards[r : r + per_rack])
        racks.append(Node(path, weight * len(leaves), None, leaves))
    return Node(name, sum(x.weight for x in racks), None, tuple(racks))


def tree(shards: int = 8, per_region: int = 4) -> Node:
    """Regions of ``per_region`` equal shards."""
    regions = tuple(
        region(f"region{i // per_region}", list(range(i, min(i + per_region, shards)))) for i in range(0, shards, per_region)
    )
    return Node("", float(shards), None, regions)


def grown(root: Node, shard: int, weight: float = 1.0) -> Node:
    """The tree with one more shard, in a region of its own: every other subtree keeps its weight."""
    new = region(f"region-of-shard{shard}", [shard], 1, weight)
    return Node("", root.weight + weight, None, (*root.children, new))


def hash_52(text: Column) -> Column:
    """52 bits of MD5 as a long; the same in any engine."""
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


def _draw(node: Node, key: Column) -> Column:
    u = (hash_52(F.concat(F.lit(node.path + "|"), key)) + F.lit(0.5)) / F.lit(float(2**52))
    return -F.log(u) / F.lit(node.weight)


def placed(node: Node, key: Column) -> Column:
    """The shard that ``key`` descends to."""
    if node.shard is not None:
        return F.lit(node.shard)
    if len(node.children) == 1:
        return placed(node.children[0], key)
    draws = F.array(*[F.struct(_draw(c, key).alias("draw"), F.lit(i).alias("child")) for i, c in enumerate(node.children)])
    won = F.array_min(draws)["child"]
    steps = F.when(won == 0, placed(node.children[0], key))
    for i, c in enumerate(node.children[1:], 1):
        steps = steps.when(won == i, placed(c, key))
    return steps


def shard_documents(docs: DataFrame, shards: int = 8, parts: int = SLOT_PARTS) -> DataFrame:
    """Each document's shard, its gapless slot there, and its shard in a cluster grown by one.

    Slots are numbered within (shard, part of the id's hash) and shifted by the
    rows of the parts before it: no task sees a whole shard.
    Only doc_id is read for the offsets.
    """
    root = tree(shards)
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    part = F.pmod(hash_52(F.concat(F.lit("slot|"), key)), F.lit(parts)).cast("int")
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        placed(root, key).alias("shard"),
        part.alias("part"),
        placed(grown(root, shards), key).alias("grown_shard"),
    )
    counts = docs.select(placed(root, key).alias("shard"), part.alias("part")).groupBy("shard", "part").count()
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("shard", "part").orderBy("doc_id", "size", "text_crc32")
    numbered = rows.withColumn("place", F.row_number().over(within) - 1)
    return numbered.join(offsets, ["shard", "part"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        F.col("shard").cast("int"),
        (F.col("offset") + F.col("place")).cast("long").alias("slot"),
        F.col("grown_shard").cast("int"),
    )


def _sql_hash(text: str) -> str:
    return f"('0x' || substr(md5({text}), 1, 13))::BIGINT"


def _sql_placed(node: Node, key: str) -> str:
    if node.shard is not None:
        return str(node.shard)
    if len(node.children) == 1:
        return _sql_placed(node.children[0], key)
    draws = [f"(-ln(({_sql_hash(f"'{c.path}|' || {key}")} + 0.5) / {2**52}.0) / {c.weight})" for c in node.children]
    cases = " ".join(
        f"WHEN list_position([{', '.join(draws)}], list_min([{', '.join(draws)}])) = {i + 1} THEN {_sql_placed(c, key)}"
        for i, c in enumerate(node.children)
    )
    return f"CASE {cases} END"


def shard_sql(shards: int = 8, parts: int = SLOT_PARTS) -> str:
    """DuckDB SQL of ``shard_documents``; CRC-32 as a fold over bytes with a table made by rule."""
    root = tree(shards)
    step = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END"
    return f"""
WITH RECURSIVE bits(i, k, c) AS (
  SELECT range, 0, range::BIGINT FROM range(256) UNION ALL SELECT i, k + 1, {step} FROM bits WHERE k < 8
), crc_table AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
d AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce(doc_id::VARCHAR, 'null') AS k FROM documents
), r AS (
  SELECT doc_id, strlen(text) + 1 AS size,
    xor(list_reduce(list_prepend(4294967295::BIGINT,
        list_transform(regexp_extract_all(hex(text), '..'), lambda h: ('0x' || h)::BIGINT)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::BIGINT) AS text_crc32,
    {_sql_placed(root, "k")} AS shard, {_sql_hash("'slot|' || k")} % {parts} AS part,
    {_sql_placed(grown(root, shards), "k")} AS grown_shard
  FROM d, crc_table
)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'key' AS law, shard::INT AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY part, doc_id, size, text_crc32) - 1 AS slot, grown_shard::INT AS grown_shard
FROM r"""
