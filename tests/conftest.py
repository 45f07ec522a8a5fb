from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]


@pytest.fixture(scope="session")
def spark():
    from docferry.session import local_session

    return local_session("*", 8)


@pytest.fixture
def out_dir(tmp_path):
    return str(tmp_path)


def rows(df):
    return [tuple(r) for r in df.collect()]
