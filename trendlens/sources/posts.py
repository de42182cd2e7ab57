"""Post sources and adapters from the test tables.

A post is a row of ``POST_SCHEMA``.  Live API clients are out of scope: posts
land as JSON lines (or arrive as Kafka values) and are read with an explicit
schema, batch or streaming.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

USER = T.StructType([T.StructField("id", T.LongType()), T.StructField("screen_name", T.StringType())])

POST_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("user", USER),
    T.StructField("user_mentions", T.ArrayType(USER)),
    T.StructField("hashtags", T.ArrayType(T.StructType([T.StructField("text", T.StringType())]))),
    T.StructField("urls", T.ArrayType(T.StructType([
        T.StructField("expanded_url", T.StringType()), T.StructField("url", T.StringType())]))),
    T.StructField("retweeted_status", T.StructType([
        T.StructField("id", T.LongType()),
        T.StructField("user", T.StructType([T.StructField("id", T.LongType())]))])),
    T.StructField("in_reply_to_status_id", T.LongType()),
    T.StructField("in_reply_to_user_id", T.LongType()),
    T.StructField("place", T.StructType([
        T.StructField("country_code", T.StringType()), T.StructField("full_name", T.StringType())])),
])

CORRUPT_COL = "_corrupt"


def read_posts(spark: SparkSession, path: str) -> DataFrame:
    """S1 batch: JSON-lines posts with the fixed schema (no inference pass)."""
    return spark.read.schema(POST_SCHEMA).json(path)


def read_posts_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                      max_bytes_per_trigger: str | None = None) -> DataFrame:
    """S1 + S3 streaming: JSON-lines files landing in ``path``.

    Micro-batch size is bounded by files or bytes per trigger instead of a
    fixed record count; nothing is dropped under load.
    """
    reader = spark.readStream.schema(POST_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return reader.json(path)


def parse_raw_posts(df: DataFrame, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """Parse a string column of raw JSON into posts.

    Returns ``(posts, corrupt)``: good rows with the post columns, and rows
    whose JSON did not parse with the raw text in ``_corrupt``.  A bad line
    never fails the job and never reaches later operators as a null post.
    """
    schema = T.StructType(POST_SCHEMA.fields + [T.StructField(CORRUPT_COL, T.StringType())])
    parsed = df.select(F.from_json(F.col(value_col), schema,
                                   {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COL}).alias("p"))
    bad = F.col(f"p.{CORRUPT_COL}").isNotNull() | F.col("p").isNull()
    posts = parsed.where(~bad).select([F.col(f"p.{f.name}").alias(f.name) for f in POST_SCHEMA.fields])
    corrupt = parsed.where(bad).select(F.coalesce(F.col(f"p.{CORRUPT_COL}"), F.lit(None)).alias(CORRUPT_COL))
    return posts, corrupt


def posts_from_kafka(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """S1 from a message bus: Kafka-shaped rows (binary ``value``) parsed as posts.

    Works on ``spark.readStream.format("kafka")...load()`` (with the Kafka
    connector on the classpath) or on any batch of such rows; bad messages go
    to the second frame, as in ``parse_raw_posts``.
    """
    return parse_raw_posts(records.select(F.col("value").cast("string").alias("value")), "value")


def _null(dt: T.DataType) -> Column:
    return F.lit(None).cast(dt)


def _post(**cols: Column) -> list[Column]:
    """All POST_SCHEMA columns, taking the given ones and null for the rest."""
    out = []
    for field in POST_SCHEMA.fields:
        c = cols.get(field.name)
        out.append((c.cast(field.dataType) if c is not None else _null(field.dataType)).alias(field.name))
    return out


def documents_as_posts(documents: DataFrame) -> DataFrame:
    """``documents`` (doc_id, text, lang, source) as posts; the source names the user."""
    return documents.select(*_post(
        id=F.col("doc_id"), text=F.col("text"), lang=F.col("lang"), source=F.col("source"),
        user=F.struct(_null(T.LongType()).alias("id"), F.col("source").alias("screen_name")),
        urls=F.array().cast(POST_SCHEMA["urls"].dataType)))


def conversations_as_posts(conversations: DataFrame) -> DataFrame:
    """``conversations`` as posts: id = conv_id*1000+turn, each turn > 0 replies to the previous one."""
    post_id = F.col("conv_id") * 1000 + F.col("turn")
    return conversations.select(*_post(
        id=post_id, text=F.col("text"),
        user=F.struct(_null(T.LongType()).alias("id"), F.col("role").alias("screen_name")),
        urls=F.array().cast(POST_SCHEMA["urls"].dataType),
        in_reply_to_status_id=F.when(F.col("turn") > 0, post_id - 1)))


# Fixed value: how links are read out of a page's HTML.
HREF_PATTERN = r'href="([^"]*)"'


def pages_as_posts(pages: DataFrame) -> DataFrame:
    """``pages`` as posts whose URL entities are the page's ``href`` targets."""
    links = F.regexp_extract_all(F.col("html"), F.lit(HREF_PATTERN), 1)
    urls = F.transform(links, lambda u: F.struct(u.alias("expanded_url"), u.alias("url")))
    return pages.select(*_post(
        id=F.col("page_id"), text=F.col("url"),
        user=F.struct(_null(T.LongType()).alias("id"), _null(T.StringType()).alias("screen_name")),
        urls=urls))


def events_as_posts(events: DataFrame) -> DataFrame:
    """``events`` as posts: the event's user is mentioned and replied to, its type is a hashtag."""
    user = F.struct(F.col("user_id").cast("bigint").alias("id"), _null(T.StringType()).alias("screen_name"))
    return events.select(*_post(
        id=F.col("event_id"), created_at=F.col("ts"), text=F.col("props"), user=user, user_mentions=F.array(user),
        hashtags=F.array(F.struct(F.upper("event_type").alias("text"))),
        in_reply_to_user_id=F.col("user_id"), urls=F.array().cast(POST_SCHEMA["urls"].dataType)))


def lineitems_as_posts(lineitem: DataFrame) -> DataFrame:
    """``lineitem`` as posts: an order line passes on the part (a status) of its supplier (an account)."""
    none = F.struct(_null(T.LongType()).alias("id"), _null(T.StringType()).alias("screen_name"))
    return lineitem.select(*_post(
        id=F.col("l_orderkey") * 10 + F.col("l_linenumber"), text=F.lit(""), user=none,
        retweeted_status=F.struct(F.col("l_partkey").cast("bigint").alias("id"),
                                  F.struct(F.col("l_suppkey").cast("bigint").alias("id")).alias("user")),
        urls=F.array().cast(POST_SCHEMA["urls"].dataType)))


def customers_as_posts(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """``customer`` joined to ``nation`` as posts placed in the customer's nation."""
    placed = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    place = F.when(F.col("n_name").isNotNull(), F.struct(
        F.col("n_nationkey").cast("string").alias("country_code"), F.col("n_name").alias("full_name")))
    return placed.select(*_post(
        id=F.col("c_custkey"), text=F.col("c_name"), place=place,
        user=F.struct(F.col("c_custkey").cast("bigint").alias("id"), F.col("c_name").alias("screen_name")),
        urls=F.array().cast(POST_SCHEMA["urls"].dataType)))
