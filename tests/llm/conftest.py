import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)


@pytest.fixture(autouse=True)
def _package(spark):
    from munimetrics.llm.queries import share_package

    share_package(spark)


@pytest.fixture
def folder():
    return "/root/testdata/sf0.001"
