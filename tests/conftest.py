import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from trainyard.session import get_session
    s = get_session("local[4]", app="trainyard-tests", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path_factory):
    return str(tmp_path_factory.mktemp("ty"))


def write(root, rel, text):
    p = os.path.join(root, rel)
    os.makedirs(os.path.dirname(p), exist_ok=True)
    with open(p, "w", encoding="utf-8") as f:
        f.write(text)
    return p
