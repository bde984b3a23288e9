import pytest


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source), with columns whose names clash."""
    def make(rows):
        full = [(*r, *[None, None][: max(0, 4 - len(r))])[:4] for r in rows]
        ddl = "doc_id long, text string, lang string, source string"
        df = spark.createDataFrame(full, ddl)
        return df.selectExpr(
            "*", "1 AS key", "2 AS kept", "'x' AS node", "3 AS size", "'y' AS digest", "0 AS quality",
            "4 AS taken", "'z' AS word", "5 AS base_failed",
        )
    return make
