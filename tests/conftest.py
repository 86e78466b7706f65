import sys
from datetime import datetime
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from tidelot.session import CHECKPOINT_DIR, builder  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        builder("tests").master("local[8]")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.codegen.wholeStage", "false")
        .config("spark.sql.codegen.factoryMode", "NO_CODEGEN")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "America/New_York")
        .config(CHECKPOINT_DIR, str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(text: str) -> datetime:
    """A naive UTC time."""
    return datetime.fromisoformat(text)
