import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from emberline import schemas  # noqa: E402
from emberline.session import build_session  # noqa: E402

AS_OF = dt.datetime(2024, 1, 31)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = build_session(
        "tests",
        **{
            "spark.master": "local[4]",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(shared),
            "spark.sql.warehouse.dir": str(shared / "warehouse"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def hours_before(hours: float) -> dt.datetime:
    return AS_OF - dt.timedelta(hours=hours)


COMMON_DEFAULTS = dict(
    id="a", title="A long enough title", selftext="body", subreddit="s", author="someone",
    created_ts=hours_before(3), url="u", permalink="p", over_18=False, spoiler=False, link_flair_text="f",
    score=60, ups=60, downs=0, ratio=0.9, num_comments=10, num_awards=0, is_video=False, has_media=False,
    text_combined="a long enough title body", text_length=24, title_length=19,
    engagement_score=33.0, comment_to_score_ratio=0.1, content_type="text",
    hour_of_day=1, day_of_week=2, is_weekend=0,
    processing_date=dt.date(2024, 1, 30), processed_ts=hours_before(2), data_source="stream",
)
LISTING_DEFAULTS = dict(
    id="a", title="A long enough title", selftext="body", subreddit="s", author="someone",
    created_utc=1706600000.0, url="u", permalink="p", over_18=False, spoiler=False, link_flair_text=None,
    score=60, ups=60, downs=0, upvote_ratio=0.9, num_comments=10, total_awards_received=0,
    is_video=False, is_self=True, is_original_content=False,
    fetch_timestamp="2024-01-30T20:00:00", fetch_source="hot",
)


def _frame(spark, schema, defaults, rows):
    filled = [{**defaults, **row} for row in rows]
    return spark.createDataFrame([tuple(row[f.name] for f in schema.fields) for row in filled], schema)


def common(spark, *rows):
    return _frame(spark, schemas.COMMON, COMMON_DEFAULTS, rows)


def silver(spark, *rows):
    return _frame(spark, schemas.SILVER, COMMON_DEFAULTS, rows)


def listing(spark, *rows):
    return _frame(spark, schemas.LISTING, LISTING_DEFAULTS, rows)


def values(df, *names):
    """Rows as sorted tuples (single values if one column is asked for)."""
    rows = [tuple(r) for r in df.select(*names).collect()]
    if len(names) == 1:
        rows = [r[0] for r in rows]
    return sorted(rows, key=lambda r: str(r))
