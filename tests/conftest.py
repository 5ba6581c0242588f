import sys
import uuid
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from refinery.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "4g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def database(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS checks")
    return "checks"


@pytest.fixture
def new_table(database):
    """Names of tables that nothing has used yet."""
    return lambda label="t": f"{database}.{label}_{uuid.uuid4().hex[:12]}"
