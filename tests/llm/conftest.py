import pytest

DDL = "doc_id long, text string, n_words int, kept string, component_id string"


@pytest.fixture
def frame(spark):
    """Documents with extra columns whose names clash with those of results; all columns may be null."""

    def make(rows):
        return spark.createDataFrame([(i, t, 7, None, "x") for i, t in rows], DDL)

    return make
