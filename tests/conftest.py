import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyframe.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="tallyframe-warehouse-")
    s = get_session("local[*]", 8, app_name="tallyframe-tests", extra={"spark.sql.warehouse.dir": warehouse})
    yield s

