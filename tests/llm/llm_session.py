"""The session that the tests of this folder share."""

import pytest


@pytest.fixture(scope="module")
def llm(spark):
    from quarry.llm.common import ready

    ready(spark)
    return spark

SF001 = "/root/testdata/sf0.001"
