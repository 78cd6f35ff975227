from __future__ import annotations

import pytest
from pyspark.sql import types as T


@pytest.fixture
def documents(spark):
    """Makes a documents table; rows are (doc_id, text) or (doc_id, text, lang)."""

    def make(*rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, "doc_id bigint, text string, lang string, source string, n_chars bigint")

    return make


@pytest.fixture
def clashing():
    """Adds columns whose names the operators use themselves."""

    def add(df):
        from pyspark.sql import functions as F

        for name in ["p", "h", "n", "c", "doc", "row", "root", "words", "kept", "ids_", "size", "shard"]:
            df = df.withColumn(name, F.lit("x"))
        return df

    return add


def schema_of(df):
    return [(f.name, f.dataType.simpleString()) for f in df.schema if isinstance(f, T.StructField)]
