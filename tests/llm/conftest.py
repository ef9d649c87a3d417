import os
import pathlib

import pytest


@pytest.fixture(scope="session")
def sf_small() -> str:
    folder = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    if not pathlib.Path(folder).exists():
        pytest.skip("needs the given tables")
    return folder
