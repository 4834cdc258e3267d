import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tierflow.session import build_session  # noqa: E402

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session(
        "local[*]",
        shuffle_partitions=8,
        conf={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="tierflow-test-ckpt-")},
    )
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="tierflow-test-")


def write_text(path: str, text: str) -> str:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)
    return path


def rows(df, *cols, order=None):
    out = df.select(*cols) if cols else df
    res = [tuple(r) for r in out.collect()]
    return sorted(res, key=repr) if order is None else res
