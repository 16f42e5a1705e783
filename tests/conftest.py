import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from checks.compare import session  # noqa: E402

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    return session(8)


@pytest.fixture
def catalogue(spark, tmp_path):
    from assortment.sources.tables import Catalogue

    return Catalogue(spark, str(tmp_path / "catalogue"))
