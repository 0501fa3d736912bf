import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from helioframe.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app="helioframe-tests", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="hf-test-ckpt-")})
    yield s
    s.stop()


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="hf-test-")


def write_files(root, files: dict):
    """Write text files (name -> content) under root; returns root."""
    for name, content in files.items():
        path = os.path.join(root, name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w", encoding="utf-8") as f:
            f.write(content)
    return root
