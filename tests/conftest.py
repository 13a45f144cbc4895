import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from checks.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    return local_session(8, spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")))


@pytest.fixture(scope="session")
def tables(spark):
    from checks.supplied import SuppliedTables

    return SuppliedTables(spark, SMALL)


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples."""

    def sorted_rows(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda t: [(v is None, str(v)) for v in t])

    return sorted_rows
