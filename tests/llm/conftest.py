from __future__ import annotations

import pytest
from odd_rows import documents


@pytest.fixture(scope="session")
def ready(spark):
    from plantmart.llm.registry import prepare

    return prepare(spark)


@pytest.fixture(scope="session")
def odd(ready):
    return documents(ready)


@pytest.fixture(scope="session")
def empty(ready):
    return documents(ready, [])
