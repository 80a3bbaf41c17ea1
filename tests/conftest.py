import sys
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from burstwatch.schemas import COMMENTS  # noqa: E402

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)


@pytest.fixture(scope="session")
def spark():
    from burstwatch.session import local_session

    s = local_session(cores=8, shuffle_partitions=8, app="burstwatch-tests")
    yield s
    s.stop()


def at(seconds: float) -> datetime:
    return T0 + timedelta(seconds=seconds)


def comments_df(spark, rows):
    """rows: (comment_id, video_id, author_id, text, sentiment, seconds after T0)."""
    data = [(cid, vid, aid, txt, float(sent), at(sec), at(sec))
            for cid, vid, aid, txt, sent, sec in rows]
    return spark.createDataFrame(data, COMMENTS)


@pytest.fixture
def make_comments(spark):
    return lambda rows: comments_df(spark, rows)
