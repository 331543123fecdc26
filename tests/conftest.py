import pytest

from voxloom.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("tests", 4, "4g")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


def rows(df, *cols):
    """Rows as a sorted list of tuples."""
    picked = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def value(spark, make, **inputs):
    """Value of one expression over literal strings."""
    from pyspark.sql import functions as F

    return spark.range(1).select(make(**{k: F.lit(v) for k, v in inputs.items()}).alias("x")).first()[0]
