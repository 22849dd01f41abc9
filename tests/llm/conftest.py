import pytest

from basketry.session import get_spark


@pytest.fixture(scope="session")
def spark():
    return get_spark(master="local[4]", shuffle_partitions=4)


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) pairs, with clashing extra columns."""
    def make(rows):
        return spark.createDataFrame(
            [(i, t, "x", 0, "a", 1) for i, t in rows],
            "doc_id long, text string, sequence_id string, n_words int, shard string, piece int")
    return make
