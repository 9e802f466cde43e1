import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from millrace.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "millrace-tests",
        "local[8]",
        spark__sql__shuffle__partitions=4,
        spark__python__sql__dataFrameDebugging__enabled="false",
        spark__driver__memory="6g",
        spark__sql__maxMetadataStringLength=5000,
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
