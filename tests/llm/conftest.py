import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def llm(spark):
    from mulberry.llm.common import ship

    ship(spark)
    return spark


@pytest.fixture(scope="session")
def odd(llm, sf_dir):
    from helpers import odd_documents

    return odd_documents(llm, sf_dir).cache()


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")
