import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from palmares.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "6g"})
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def frame(spark):
    """Small frame from rows and a DDL schema, with known statistics."""
    from palmares.operators.lookups import small_table

    return lambda rows, schema: small_table(spark, rows, schema)


def values(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)
