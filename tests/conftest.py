from __future__ import annotations

import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from shopstream.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[4]",
        **{
            "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "4", "spark.default.parallelism": "4",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def topic(spark):
    """A batch of raw records: dicts or texts, arriving in the given order."""

    def make(*records):
        rows = [(r if r is None or isinstance(r, str) else json.dumps(r), i) for i, r in enumerate(records)]
        return spark.createDataFrame(rows, "value STRING, arrival BIGINT")

    return make


def log(mid="1", ts=0, page_id="home", last=None, is_new="0", **more):
    page = {"page_id": page_id}
    if last is not None:
        page["last_page_id"] = last
    return {"common": {"mid": mid, "is_new": is_new}, "page": page, "ts": ts, **more}
