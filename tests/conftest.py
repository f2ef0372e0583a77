import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from yarnscope.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=4)
    yield s


@pytest.fixture
def write_text(tmp_path):
    """Write ``text`` verbatim to a file and return its path."""
    def _w(name: str, text: str) -> str:
        p = tmp_path / name
        p.write_text(text)
        return str(p)
    return _w
