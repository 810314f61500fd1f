import pytest

from cardlens.llm.common import ship

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, size string, target string, _text string"


@pytest.fixture(scope="session")
def workers(spark):
    ship(spark)
    return spark


@pytest.fixture(scope="session")
def make(workers):
    def build(rows, schema=DOCS):
        width = schema.count(",") + 1
        return workers.createDataFrame([tuple(r) + (None,) * (width - len(r)) for r in rows], schema)

    return build
