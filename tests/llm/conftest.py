from __future__ import annotations

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Documents from ``(doc_id, text)`` pairs, with columns of names that operators use inside."""

    def build(*rows: tuple, extra: bool = True):
        df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCUMENTS)
        if extra:
            for name in ("node", "word", "row", "region", "length", "rank", "score", "shard", "size", "_id", "_doc", "host"):
                df = df.selectExpr("*", f"'x' AS {name}")
        return df

    return build


@pytest.fixture
def staging(spark):
    from slumptrace.llm.common import Staging

    return Staging(spark, "test")
