import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

from oracle import FOLDER  # noqa: E402

from docsearch.session import local_session  # noqa: E402

SESSION = local_session("tests", memory="4g")


@pytest.fixture(scope="session")
def spark():
    return SESSION


@pytest.fixture(scope="session")
def folder():
    return FOLDER
