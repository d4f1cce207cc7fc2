"""Column sets of the click event and of the tables between the jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A click as it arrives.  Scalars are read as text, so one that does not cast
# falls back to its default instead of spoiling the whole click.
_TEXT_FIELDS = [
    "articleId", "host", "cat", "isAPP", "contentType", "isGroup", "url",
    "catIdHash", "publishTime", "author", "channel", "geoLocation", "isIndia",
    "group", "referer", "agentType", "pgDownloadTime", "count", "pgAccess5Min",
]
_LIST_FIELDS = ["subcat", "catIds", "tags"]

CORRUPT = "_corrupt"

RAW_CLICK = T.StructType(
    [T.StructField(name, T.StringType()) for name in _TEXT_FIELDS]
    + [T.StructField(name, T.ArrayType(T.StringType())) for name in _LIST_FIELDS]
    + [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.StringType()),
        T.StructField(CORRUPT, T.StringType()),
    ]
)

# Keys and first-seen attributes of the article tables.
ARTICLE_KEYS = ["article_id", "host", "is_app"]
ARTICLE_ATTRS = [
    "content_type", "cat", "subcat", "url", "publish_time", "author", "channel",
    "cat_ids", "is_group", "cat_id_hash",
]
# Attributes of the tag tables.
TAG_ATTRS = ["cat", "cat_ids", "cat_id_hash"]
# Keys of the dashboard pre-aggregate.
DASHBOARD_KEYS = ["host", "geo_location", "is_india", "referer", "grp", "article_id"]

# The agent dimension.
AGENT_FIELDS = [
    "browser_name", "browser_version", "browser_type", "device_category",
    "os_name", "os_family",
]
AGENT_DIM = T.StructType(
    [
        T.StructField("user_agent", T.StringType()),
        T.StructField(
            "detail", T.StructType([T.StructField(f, T.StringType()) for f in AGENT_FIELDS])
        ),
    ]
)

# Kafka offsets of a batch.
OFFSET_RANGE = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("from_offset", T.LongType()),
        T.StructField("until_offset", T.LongType()),
        T.StructField("description", T.StringType()),
        T.StructField("run", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)

# The field names under which the stored documents are read by
# their consumers.
DOCUMENT_NAMES = {
    "article_id": "articleId",
    "is_app": "isAPP",
    "content_type": "contentType",
    "publish_time": "publishTime",
    "cat_ids": "catIds",
    "is_group": "isGroup",
    "cat_id_hash": "catIdHash",
    "tag": "tags",
    "c_tag": "cTag",
    "is_india": "isIndia",
    "geo_location": "geoLocation",
    "grp": "group",
    "tot_tm": "totTm",
    "exec_ts": "execTs",
    "device": "Device",
    "browser": "Browser",
    "avg_time": "AVG",
    "from_offset": "fromOffset",
    "until_offset": "untilOffset",
    "user_agent": "UserAgent",
}


def epoch_seconds(ts: Column | str) -> Column:
    """Timestamp to epoch seconds."""
    return F.unix_seconds(F.col(ts) if isinstance(ts, str) else ts)


def epoch_millis(ts: Column | str) -> Column:
    """Timestamp to epoch milliseconds."""
    return F.unix_millis(F.col(ts) if isinstance(ts, str) else ts)


def to_documents(df: DataFrame, slice_col: str = "slice", unit: str = "s",
                 time_name: str = "timeStamp", date_name: str | None = None) -> DataFrame:
    """Table row to stored document: names of the documents, time as a long.

    ``unit`` is ``ms`` for the 5-minute tables and counters, ``s`` from the hour up; counters
    also carry their time as a date, named ``date_name`` (``tsd``).
    """
    out = df.withColumn(date_name, F.col(slice_col)) if date_name else df
    if slice_col in df.columns:
        stamp = epoch_millis(slice_col) if unit == "ms" else epoch_seconds(slice_col)
        out = out.withColumn(slice_col, stamp).withColumnRenamed(slice_col, time_name)
    drop = [c for c in ("first_ts", "part") if c in out.columns]
    return out.drop(*drop).withColumnsRenamed(DOCUMENT_NAMES)
