import pathlib
import sys
import tempfile

import pytest

ROOT = pathlib.Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tools"), str(ROOT / "tests")]

from turnstile.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="turnstile-warehouse-")
    return local_session(
        8,
        **{"spark.sql.warehouse.dir": warehouse, "spark.sql.shuffle.partitions": "4"},
    )
