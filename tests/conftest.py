import pytest

from reknit.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[4]", **{
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "4",
        "spark.driver.memory": "4g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    from reknit.sources.tables import values

    return lambda schema, *rows: values(spark, rows, schema)


@pytest.fixture
def rows():
    """The rows of a table as sorted tuples."""
    def as_tuples(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(row) for row in picked.collect()), key=repr)
    return as_tuples
