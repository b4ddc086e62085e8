import pytest

from tallyworks.llm.shared import ship_package


@pytest.fixture(autouse=True, scope="session")
def package_on_executors(spark):
    ship_package(spark)
