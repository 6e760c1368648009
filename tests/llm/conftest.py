import pytest

from footfall.llm.common import prepare


@pytest.fixture(scope="session")
def ready(spark):
    return prepare(spark)


@pytest.fixture(scope="session")
def make(ready):
    """Rows (doc_id, text) as documents whose other columns clash with the operators' names."""

    def build(rows, schema="doc_id long, text string"):
        return ready.createDataFrame(rows, schema).selectExpr(
            "*", "'x' AS kept", "1 AS h", "2 AS node", "map('a', 1) AS rest", "'de' AS lang_pred", "0 AS `n_hit.x`"
        ).repartition(3)

    return build
