import pytest
from pyspark.sql import functions as F

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that operators use inside.
CLASHING = (
    "row id words digest fp seed at label kept text_ row_in_place spans base random item_id n_tokens number block place hits every clean "
    "passed score rule doc_ids value cell first size"
).split()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tidemark.session import local_session

    session = local_session(cpus=4, checkpoints=str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


@pytest.fixture
def documents(spark):
    """Rows of documents from (doc_id, text) pairs."""
    return lambda pairs: spark.createDataFrame([(i, t, None, None, None) for i, t in pairs], DOC)


@pytest.fixture
def clashing():
    """A frame with extra columns named like those the operators use."""
    return lambda df: df.withColumns({name: F.lit("x") for name in CLASHING if name not in df.columns})
