import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from celltrace.session import build_session, drop_cuts  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    drop_cuts(session)
    session.stop()


def rows(df, *columns):
    """Rows as a sorted list of tuples, for small results."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))
