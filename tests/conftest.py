import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from orderloom import session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = session.build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="6g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__log__level="ERROR",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    yield s
    s.stop()


@pytest.fixture(scope="session")
def staging(spark):
    from orderloom.sources import star_tables

    return star_tables.typed_tables(spark, SMALL)


def rows(df, *columns):
    """Sorted tuples, NULLs first."""
    picked = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(picked, key=lambda r: [(v is not None, str(v)) for v in r])
