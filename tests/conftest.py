import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from lastmile.session import build_session
    scratch = tempfile.mkdtemp(prefix="lastmile-tests-")
    session = build_session("local[4]", app_name="lastmile-tests", shuffle_partitions=8,
                            extra={"spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
                                   "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse")})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def scratch_dir():
    return tempfile.mkdtemp(prefix="lastmile-test-out-")


def rows(df, *cols):
    """Collect ``cols`` (all by default) as a list of tuples, in row order."""
    sel = df.select(*cols) if cols else df
    return [tuple(r) for r in sel.collect()]
