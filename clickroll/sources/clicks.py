"""Click messages: where they come from and how a message becomes a row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickroll.functions.clean import clean_tags, is_error_doc, to_flag, to_long
from clickroll.schemas import CORRUPT, RAW_CLICK


def read_click_stream(
    spark: SparkSession,
    fmt: str,
    options: dict[str, str],
    schema=None,
    starting_offsets: str = "latest",
) -> DataFrame:
    """Unbounded click source with text columns ``key`` and ``value``, and ``timestamp``.

    ``timestamp`` is when the source got the message: the broker's time, a column of
    the files, or else the time of the file.

    ``fmt="kafka"`` needs ``kafka.bootstrap.servers`` and ``subscribe`` among
    the options and the Kafka connector on the class path; ``starting_offsets``
    is ``latest``, ``earliest`` or the JSON that ``resume_offsets`` returns.  File formats
    take ``path`` and a schema that holds ``value``.
    """
    reader = spark.readStream.format(fmt).options(**options)
    if fmt == "kafka":
        reader = reader.option("startingOffsets", starting_offsets)
        return reader.load().select(
            F.col("key").cast("string").alias("key"),
            F.col("value").cast("string").alias("value"),
            "topic", "partition", "offset", "timestamp",
        )
    if schema is not None:
        reader = reader.schema(schema)
    rows = reader.load()
    if "timestamp" in rows.columns:
        return rows
    return rows.select("*", F.col("_metadata.file_modification_time").alias("timestamp"))


def parse_clicks(messages: DataFrame, value: str = "value") -> DataFrame:
    """Click fields of a JSON message, its text, and ``_corrupt`` for a bad one.

    The struct is unpacked by a generator, not by field access: a projection
    would be merged with the filters behind it, and the message parsed again
    for each.
    """
    parsed = F.from_json(
        F.col(value), RAW_CLICK,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    )
    others = [c for c in messages.columns if c not in (value, *RAW_CLICK.names)]
    return messages.select(*others, F.col(value).alias("_value"), F.inline(F.array(parsed)))


def event_time(rows: DataFrame) -> Column:
    """When the click was: its own time, or else when the source got it.

    A number is epoch milliseconds; text that is no time counts as none.
    """
    text = F.btrim("ts")
    number = F.timestamp_millis(text.try_cast("double").try_cast("bigint"))
    # years of four digits: what lies beyond is no time of a click
    own = F.when(text.rlike("^[+-]?[0-9]+([.][0-9]*)?([eE][+]?[0-9]+)?$"), number).otherwise(text.try_cast("timestamp"))
    own = F.when(F.year(own).between(1, 9999), own)
    return F.coalesce(own, F.col("timestamp").cast("timestamp")) if "timestamp" in rows.columns else own


def is_bad(parsed: DataFrame, time: Column | None = None) -> Column:
    """True for a message that is no JSON object, or has no time of any kind; ``time`` is where that is known."""
    # A single odd field marks a row corrupt too, but its other fields are there
    # and the click counts, so only marked rows are looked at again.
    text = F.btrim("_value", F.lit(" \t\r\n"))
    no_object = F.get_json_object("_value", "$").isNull() | ~text.startswith("{")
    return (
        F.col("_value").isNull() | (text == "") | (F.col(CORRUPT).isNotNull() & no_object)
        | (event_time(parsed) if time is None else time).isNull()
    )


def marked_clicks(parsed: DataFrame) -> DataFrame:
    """Parsed messages with ``_time`` and ``_bad``, each worked out once for all that reads them."""
    timed = parsed.withColumn("_time", event_time(parsed))
    return timed.withColumn("_bad", is_bad(parsed, F.col("_time")))


def good_clicks(parsed: DataFrame) -> DataFrame:
    """Messages that are JSON objects, with their time as ``ts``; they may be marked already."""
    if "_bad" in parsed.columns:
        return parsed.where(~F.col("_bad")).withColumn("ts", F.col("_time")).drop("_value", CORRUPT, "_time", "_bad")
    return parsed.where(~is_bad(parsed)).withColumn("ts", event_time(parsed)).drop("_value", CORRUPT)


def quarantined_clicks(parsed: DataFrame) -> DataFrame:
    """Messages that are not, with their text; they take no part in any count."""
    return parsed.where(is_bad(parsed)).select(F.col("_value").alias("value"))


def normalise_clicks(raw: DataFrame) -> DataFrame:
    """Typed click row with the defaults of the article jobs."""
    return raw.select(
        "event_id",
        "ts",
        F.col("articleId").alias("article_id"),
        "host",
        to_long("isAPP", 0).alias("is_app"),
        to_long("contentType", 1).alias("content_type"),
        "cat",
        "subcat",
        "url",
        to_long("publishTime", 0).alias("publish_time"),
        F.coalesce("author", F.lit("")).alias("author"),
        F.coalesce("channel", F.lit("")).alias("channel"),
        F.col("catIds").alias("cat_ids"),
        to_flag("isGroup").alias("is_group"),
        to_long("catIdHash").alias("cat_id_hash"),
        clean_tags("tags").alias("tags"),
        F.col("geoLocation").alias("geo_location"),
        F.col("isIndia").alias("is_india"),
        F.col("group").alias("grp"),
        "referer",
        F.col("agentType").alias("agent_type"),
        to_long("pgDownloadTime", 0).alias("dnld_time"),
    )


def normalise_agent_events(raw: DataFrame) -> DataFrame:
    """Rows of the agent job: every message is one element, whatever its count."""
    return raw.select(
        "event_id",
        "ts",
        "host",
        F.col("agentType").alias("agent_type"),
        to_long("count", 1).alias("sent_count"),
        F.lit(1).cast("bigint").alias("count"),
        to_long("pgDownloadTime", 0).alias("dnld_time"),
        F.lit(1).cast("bigint").alias("elements"),
    )


def page_access(messages: DataFrame, value: str = "value") -> DataFrame:
    """Five-minute access count and url of a page-access message."""
    parsed = F.from_json(F.col(value), "pgAccess5Min int, url string")
    # what is no JSON has no access count; a missing field alone drops nothing
    json = messages.where(F.get_json_object(F.col(value), "$").isNotNull())
    return json.select(parsed.alias("m")).select(
        F.col("m.pgAccess5Min").alias("pg_access_5min"), "m.url"
    )


def flag_error_docs(clicks: DataFrame, keys: list[str], empty_too: bool = False) -> DataFrame:
    """Add ``is_error_doc`` for rows that lack a key; they are kept."""
    return clicks.withColumn("is_error_doc", is_error_doc(*keys, empty_too=empty_too))
