import os
import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from staylens.session import get_session
    s = get_session(master="local[2]", shuffle_partitions=8,
                    extra={"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None) and not s.sparkContext.getCheckpointDir():
        # unset only outside a configured cluster; the context accepts a folder at runtime
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="staylens-test-ckpt-"))
    yield s


@pytest.fixture
def tmpdir_path():
    return tempfile.mkdtemp(prefix="staylens-test-")


def rows(df, *cols):
    cols = cols or df.columns
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def has_data():
    return os.path.exists(f"{SF_SMALL}/lineitem.parquet")
