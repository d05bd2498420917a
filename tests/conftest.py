import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from paritas.session import ensure_checkpoint_dir, local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores=4, shuffle_partitions=4, app="paritas-tests")
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s


@pytest.fixture(scope="session")
def tables(spark):
    from paritas.sources.tables import TableSet
    return TableSet(spark, SF_SMALL)


def rows(df, *cols):
    """Sorted list of tuples (selected columns or all)."""
    d = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in d.collect()), key=repr)
