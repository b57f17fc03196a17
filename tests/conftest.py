import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from reviewloom.session import build_session

    return build_session(
        "reviewloom-tests", cpus=4, spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse"))
    )
