import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

FIXTURES = os.path.join(ROOT, "tests", "fixtures")


@pytest.fixture(scope="session")
def spark():
    from palimpsest.session import build_session

    session = build_session(
        "tests",
        "local[8]",
        spark_sql_shuffle_partitions="4",
        spark_driver_memory="6g",
        spark_default_parallelism="4",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def fixtures():
    return FIXTURES


def plan_of(rows):
    """Formatted physical plan of a DataFrame."""
    import contextlib
    import io

    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        rows.explain("formatted")
    return out.getvalue()


def tuples(rows, *columns):
    """Sorted rows as plain tuples."""
    chosen = rows.select(*columns) if columns else rows
    return sorted((tuple(r) for r in chosen.collect()), key=repr)
