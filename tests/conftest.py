import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from verbscope.session import get_spark
    s = get_spark("local[*]", shuffle_partitions=8, extra={"spark.driver.memory": "4g"})
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted list of tuples of the given columns (all when none)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
