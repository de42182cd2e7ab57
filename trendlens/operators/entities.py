"""Entity extraction: one post in, one row per distinct entity out.

Every post builds one ``array<struct<content_type, content_name>>`` from its
mentions, retweet, reply ids, URLs, hashtags, client and place; absent parts
contribute nothing, duplicates collapse, and the array is exploded.  All of it
is array expressions inside one projection: no join, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendlens.functions.hashing import content_id

ENTITY = T.StructType([T.StructField("content_type", T.StringType()),
                       T.StructField("content_name", T.StringType())])
ENTITIES = T.ArrayType(ENTITY)

# Content type names.
ACCOUNT_MENTIONED = "account_mentioned"
ACCOUNT_RETWEETED = "account_retweeted"
STATUS_RETWEETED = "status_retweeted"
REPLY_TO_ACCOUNT = "reply_to_account"
REPLY_TO_STATUS = "reply_to_status"
URL = "url"
HASHTAG = "hashtag"
SOURCE = "source"
PLACE_COUNTRY_CODE = "place_country-code"
PLACE_FULLNAME = "place_fullname"


def _entity(kind: str, name: Column) -> Column:
    return F.struct(F.lit(kind).alias("content_type"), name.cast("string").alias("content_name"))


def _empty() -> Column:
    return F.array().cast(ENTITIES)


def _when(cond: Column, *items: Column) -> Column:
    return F.when(cond, F.array(*items)).otherwise(_empty())


def _each(arr: str, fn) -> Column:
    return F.coalesce(F.transform(F.col(arr), fn), _empty())


def entity_array() -> Column:
    """E1-E11 as one array column (distinct entities of a post)."""
    rt = F.col("retweeted_status")
    place = F.col("place")
    parts = [
        _each("user_mentions", lambda m: _entity(ACCOUNT_MENTIONED, m["id"])),                    # E1
        _when(rt.isNotNull(), _entity(ACCOUNT_RETWEETED, rt["user"]["id"]),                       # E2
              _entity(STATUS_RETWEETED, rt["id"])),                                               # E3
        _when(F.coalesce(F.col("in_reply_to_user_id"), F.lit(0)) > 0,
              _entity(REPLY_TO_ACCOUNT, F.col("in_reply_to_user_id"))),                          # E4
        _when(F.coalesce(F.col("in_reply_to_status_id"), F.lit(0)) > 0,
              _entity(REPLY_TO_STATUS, F.col("in_reply_to_status_id"))),                         # E5
        _each("urls", lambda u: _entity(URL, F.coalesce(u["expanded_url"], u["url"]))),          # E6, F8
        _each("hashtags", lambda h: _entity(HASHTAG, F.lower(h["text"]))),                        # E7
        _when(F.col("source").isNotNull(), _entity(SOURCE, F.col("source"))),                    # E8
        _when(place.isNotNull(), _entity(PLACE_COUNTRY_CODE, place["country_code"]),              # E9
              _entity(PLACE_FULLNAME, place["full_name"])),                                       # E10
    ]
    return F.array_distinct(F.concat(*parts))                                                     # E11


def extract_entities(posts: DataFrame) -> DataFrame:
    """``tweet_id, user_id, created_at, content_type, content_name, content_id``.

    A post without entities yields no row.
    """
    exploded = posts.select(F.col("id").alias("tweet_id"), F.col("user.id").alias("user_id"),
                            F.col("created_at"), F.explode(entity_array()).alias("e"))
    return exploded.select("tweet_id", "user_id", "created_at",
                           F.col("e.content_type").alias("content_type"),
                           F.col("e.content_name").alias("content_name"),
                           content_id(F.col("e.content_type"), F.col("e.content_name")).alias("content_id"))
