import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from vigil.session import get_session
    s = get_session("local[4]", 8, app="vigil-tests",
                    extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="vigil-test-ckpt-")})
    yield s
    s.stop()


def ts(s):
    import datetime as dt
    return dt.datetime.fromisoformat(s)
