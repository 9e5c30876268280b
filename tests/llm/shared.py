"""The folder that operators share with executors, for the tests' local session."""

import pytest

from martwright.llm.queries import work_locally


@pytest.fixture(autouse=True, scope="session")
def checkpoint_folder(spark):
    work_locally(spark)
