"""The registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from spendwatch.llm.common import table
from spendwatch.llm.decontam import decontaminate, decontaminate_sql
from spendwatch.llm.fim import fim_digests, fim_sql
from spendwatch.llm.html import extract_text
from spendwatch.llm.licenses import license_scan, license_sql
from spendwatch.llm.lm import score_documents
from spendwatch.llm.mixing import mix_report
from spendwatch.llm.neardup import near_duplicates
from spendwatch.llm.packing import pack_documents
from spendwatch.llm.passages import without_repeats
from spendwatch.llm.quality import quality_rules, quality_sql
from spendwatch.llm.sharding import shard_documents, shard_sql
from spendwatch.llm.vectorcodes import compress_report, compress_sql
from spendwatch.llm.warc import warc_round_trip, warc_sql


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A WARC record for each page, written and read back."""
    return warc_round_trip(table(spark, sf_dir, "pages"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in all documents."""
    return license_scan(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base figures and line-frequency verdict of all documents."""
    return quality_rules(table(spark, sf_dir, "documents")).drop("text_key")


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract_text(table(spark, sf_dir, "pages"))


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return near_duplicates(table(spark, sf_dir, "documents")).drop("text_key", "set_key")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 tokens."""
    return pack_documents(table(spark, sf_dir, "documents"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents placed in 8 shards by the hash tree."""
    return shard_documents(table(spark, sf_dir, "documents"))


def op8_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without bytes of 100-byte strings that start earlier."""
    return without_repeats(table(spark, sf_dir, "documents"), ["doc_id"])


def op9_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model scores of all documents."""
    return score_documents(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items."""
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_key")


def op11_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents cut and reordered for fill-in-the-middle training, and rebuilt."""
    return fim_digests(table(spark, sf_dir, "documents"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings as product codes of trained codebooks."""
    return compress_report(table(spark, sf_dir, "embeddings"))


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to target weights of their sources."""
    return mix_report(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_warc": op1_warc,
        "op2_license_scan": op2_license_scan,
        "op3_quality": op3_quality,
        "op4_html": op4_html,
        "op5_minhash": op5_minhash,
        "op6_packing": op6_packing,
        "op7_sharding": op7_sharding,
        "op8_suffix_array": op8_suffix_array,
        "op9_language_model": op9_language_model,
        "op10_decontamination": op10_decontamination,
        "op11_fim": op11_fim,
        "op12_vector_codes": op12_vector_codes,
        "op13_mixing": op13_mixing,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_warc": warc_sql(),
        "op2_license_scan": license_sql(),
        "op3_quality": quality_sql(),
        "op7_sharding": shard_sql(),
        "op10_decontamination": decontaminate_sql(),
        "op11_fim": fim_sql(),
        "op12_vector_codes": compress_sql(),
    }
