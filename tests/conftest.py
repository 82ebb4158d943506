import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from encore.session import build_session

    session = build_session("local[4]", 4, app_name="encore-tests")
    yield session
    session.stop()


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)
