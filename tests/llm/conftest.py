import pytest

from lodestar.session import ship_package


@pytest.fixture(autouse=True)
def package_on_workers(spark):
    ship_package(spark)
