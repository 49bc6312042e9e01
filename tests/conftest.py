import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))


@pytest.fixture(scope="session")
def spark():
    from claimtide.session import build_session
    session = build_session("tests", "local[8]", {
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="claimtide-ckpt-")})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def frame(spark):
    """Build a small DataFrame: ``frame("a int, b string", (1, "x"), ...)``."""
    def build(schema, *rows):
        return spark.createDataFrame([tuple(r) for r in rows], schema)
    return build
