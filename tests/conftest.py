from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from quarrystone.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", shuffle_partitions=8, app="tests")
    yield session
    session.stop()


@pytest.fixture()
def conf(spark):
    """Set runtime settings for one test."""
    before = {}

    def set_all(settings: dict[str, str]) -> None:
        for key, value in settings.items():
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield set_all
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)
