import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tripmart.session import build_session
    s = build_session("local[4]", shuffle_partitions=4, app_name="tripmart-tests",
                      extra={"spark.driver.memory": "6g"})
    yield s
    s.stop()


def rows(df, *cols):
    """Collected rows as tuples (optionally only some columns)."""
    if cols:
        df = df.select(*cols)
    return [tuple(r) for r in df.collect()]
