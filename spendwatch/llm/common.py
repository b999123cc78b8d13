"""Helpers shared by the training-data operators: inputs, shared folders, salted group minima."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, which driver and executors share.

    Only a local session (tests, one machine) that names none gets a folder of this
    process, set as the checkpoint folder; on a cluster it is an error, as executors would write where others cannot read.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
        if not base:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
            base = "file://" + tempfile.mkdtemp(prefix="spark-checkpoint-")
            spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder as Parquet and read again: cuts lineage and survives lost executors."""
    path = shared_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def salted_min(df: DataFrame, keys: list[str], value: str, out: str, salts: int = 256) -> DataFrame:
    """``df`` with ``out``: the least ``value`` of the row's group of equal ``keys`` (NULLs equal), and ``out_n``, its rows.

    A group may hold any share of the rows: each is dealt to ``salts`` parts by
    a hash of ``value``, so counts and minima are made per (group, part), the few part rows
    of a group are met once, and only parts that exist are joined back.
    """
    salt = "_salt_of_group"
    df = df.withColumn(salt, F.pmod(F.xxhash64(value), F.lit(salts)).cast("int"))
    parts = df.groupBy(*keys, salt).agg(F.min(value).alias("_least"), F.count(F.lit(1)).alias("_rows"))
    met = parts.groupBy(*keys).agg(
        F.min("_least").alias(out), F.sum("_rows").alias(f"{out}_n"), F.collect_list(salt).alias("_salts")
    )
    back = met.select(*[F.col(k).alias(f"_k_{k}") for k in keys], out, f"{out}_n", F.explode("_salts").alias("_salt_back"))
    on = F.col(salt) == F.col("_salt_back")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return df.join(back, on, "left").drop(salt, "_salt_back", *[f"_k_{k}" for k in keys])


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``rows`` rows, so that what Python makes of one stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def ascii_lower(text: Column) -> Column:
    """Only A-Z lowered, as the contracts ask; other letters stay."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def utf8_bytes(text: str | None) -> bytes:
    """A text's bytes; NULL is empty."""
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def data_path(name: str) -> str:
    """A public tokenizer's file; the folder can be named by ``TOKENIZERS_DIR``."""
    folder = os.environ.get("TOKENIZERS_DIR")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)
