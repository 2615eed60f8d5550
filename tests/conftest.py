import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from flowbook.session import build_session, clear_working_folder

    session = build_session(
        "tests", "local[8]", spark_sql_shuffle_partitions="4", spark_ui_enabled="false", spark_driver_memory="6g",
        spark_ui_showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    clear_working_folder(session)
    session.stop()


@pytest.fixture
def rows(spark):
    """Rows from a DDL schema."""
    return lambda schema, *data: spark.createDataFrame(list(data), schema)


@pytest.fixture
def values():
    """Sorted tuples of a frame."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
