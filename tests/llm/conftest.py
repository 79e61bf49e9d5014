"""Whole-table fixtures and tiny frames for the text operators."""

import pytest

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def documents(spark):
    """Builds a documents table; every row (doc_id, text[, lang]) gets clashing extra columns."""

    def build(rows, ddl="doc_id bigint, text string, lang string"):
        width = len(ddl.split(","))
        whole = [tuple(r) + (None,) * (width - len(r)) for r in rows]
        df = spark.createDataFrame(whole, ddl)
        return df.selectExpr("*", "'x' AS source", "7 AS score", "'y' AS shard", "0 AS component_id", "1.5 AS _hash")

    return build
