import os

import pytest
from pyspark.sql import types as T

SF0001 = "/root/testdata/sf0.001"

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture
def docs_of(spark):
    """Documents from (doc_id, text[, source]); with a few columns that clash with inner names."""

    def make(rows, extra=True):
        from pyspark.sql import functions as F

        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, DOCUMENTS)
        return df.withColumns({c: F.lit(9) for c in ("doc", "sum", "bucket", "shard", "part", "row", "line")}) if extra else df

    return make


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "embeddings"):
        p = os.path.join(sf_dir, f"{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p + '/*.parquet' if os.path.isdir(p) else p}')")
    return con


def duck_over(**tables):
    """DuckDB with the given Spark tables."""
    import duckdb

    con = duckdb.connect()
    for name, df in tables.items():
        con.register(name, df.toArrow())
    return con


def rows_of(df, columns=None):
    got = df.select(*columns) if columns else df
    return sorted((tuple(r[c] for c in sorted(got.columns)) for r in got.collect()), key=repr)


def sql_rows(con, sql):
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    return sorted(names), sorted((tuple(v for _, v in sorted(zip(names, r))) for r in res.fetchall()), key=repr)
