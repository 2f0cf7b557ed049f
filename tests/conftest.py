import pytest

from checks.run import session
from headway.session import configure


@pytest.fixture(scope="session")
def spark():
    spark = configure(session())
    spark.sparkContext.setLogLevel("ERROR")
    return spark
