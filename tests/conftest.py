import json
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from trendlens.session import get_session

    session = get_session("local[*]", app_name="trendlens-tests", shuffle_partitions=8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


# FIXTURES.md section 1: three posts (one of each purpose) plus one broken line.
POSTS = [
    {
        "id": 1, "text": "Apple love #Apple", "created_at": "2015-01-01T00:00:00Z", "lang": "en",
        "source": "web", "user": {"id": 7, "screen_name": "alice"},
        "user_mentions": [{"id": 11, "screen_name": "a"}, {"id": 12, "screen_name": "b"},
                          {"id": 11, "screen_name": "a"}],
        "hashtags": [{"text": "Apple"}, {"text": "apple"}],
        "urls": [{"expanded_url": "http://x/a", "url": "http://t/1"}, {"expanded_url": None, "url": "http://t/2"}],
        "retweeted_status": {"id": 90, "user": {"id": 91}},
        "in_reply_to_status_id": 80, "in_reply_to_user_id": 81,
        "place": {"country_code": "US", "full_name": "Raleigh, NC"},
    },
    {
        "id": 2, "text": "nothing here", "created_at": "2015-01-01T00:00:01Z", "lang": "en",
        "source": None, "user": {"id": 8, "screen_name": "bob"},
        "user_mentions": [], "hashtags": None, "urls": [],
        "retweeted_status": None, "in_reply_to_status_id": 0, "in_reply_to_user_id": -1, "place": None,
    },
    {
        "id": 3, "text": "apple", "created_at": "2015-01-01T00:00:02Z", "lang": "fr",
        "source": "web", "user": {"id": 9, "screen_name": "carol"},
        "user_mentions": None, "hashtags": [], "urls": [],
        "retweeted_status": None, "in_reply_to_status_id": None, "in_reply_to_user_id": None, "place": None,
    },
]


@pytest.fixture()
def posts_path(tmp_path):
    path = tmp_path / "posts.json"
    with open(path, "w") as fh:
        for p in POSTS:
            fh.write(json.dumps(p) + "\n")
    return str(path)


@pytest.fixture()
def raw_posts_path(tmp_path):
    path = tmp_path / "raw_posts.json"
    with open(path, "w") as fh:
        for p in POSTS:
            fh.write(json.dumps(p) + "\n")
        fh.write("{bad\n")
    return str(path)
