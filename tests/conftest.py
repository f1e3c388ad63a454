from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from samples import AIRCRAFT, AIRPORTS, FLIGHTS, write_csv, write_json  # noqa: E402
from tarmac import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def feed_root(tmp_path: Path) -> Path:
    """The three sample feeds in both formats."""
    for feed, rows in (
        ("flight_operations", FLIGHTS),
        ("airports", AIRPORTS),
        ("aircraft_reference", AIRCRAFT),
    ):
        write_csv(tmp_path / "data" / "raw" / feed, f"{feed}.csv", rows)
        write_json(tmp_path / "data" / "raw_json" / feed, f"{feed}.jsonl", rows)
    return tmp_path
