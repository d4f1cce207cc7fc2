"""The supplied tables seen as clicks, messages, hosts and agents.

Each view comes twice, for Spark and for DuckDB, with equal rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickroll.session import work_dir

# Agent texts given to the 15 user groups of the events table.
AGENTS = [
    "Mozilla/5.0 (Windows NT 6.1) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/41.0.2227.1 Safari/537.36",
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64; rv:40.0) Gecko/20100101 Firefox/40.0",
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_10_3) AppleWebKit/600.5.17 (KHTML, like Gecko) Version/8.0.5 Safari/600.5.17",
    "Mozilla/5.0 (iPhone; CPU iPhone OS 8_3 like Mac OS X) AppleWebKit/600.1.4 (KHTML, like Gecko) Version/8.0 Mobile/12F70 Safari/600.1.4",
    "Mozilla/5.0 (iPad; CPU OS 8_3 like Mac OS X) AppleWebKit/600.1.4 (KHTML, like Gecko) Version/8.0 Mobile/12F69 Safari/600.1.4",
    "Mozilla/5.0 (Linux; Android 5.0; SM-G900V) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/43.0.2357.78 Mobile Safari/537.36",
    "Mozilla/5.0 (Linux; Android 4.4.2; SM-T530) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/42.0.2311.111 Safari/537.36",
    "Mozilla/5.0 (compatible; MSIE 9.0; Windows NT 6.1; Trident/5.0)",
    "Opera/9.80 (J2ME/MIDP; Opera Mini/7.1.32052/36.2592; U; en) Presto/2.12.423 Version/12.16",
    "Mozilla/5.0 (compatible; Googlebot/2.1; +http://www.google.com/bot.html)",
    "Mozilla/5.0 (Windows NT 10.0) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/42.0.2311.135 Safari/537.36 Edge/12.10240",
    "Mozilla/5.0 (Linux; U; Android 4.2.2; en-US; Micromax A110) AppleWebKit/534.30 (KHTML, like Gecko) UCBrowser/10.5.0.575 Mobile",
    "Mozilla/5.0 (X11; Linux x86_64; rv:38.0) Gecko/20100101 Firefox/38.0",
    "Mozilla/5.0 (Windows NT 6.1; WOW64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/42.0.2311.90 Safari/537.36 OPR/29.0.1795.47",
    "curl/7.38.0",
]
_AGENT_CASE = (
    "CASE CAST(user_id % 15 AS INT) "
    + " ".join(f"WHEN {i} THEN '{a}'" for i, a in enumerate(AGENTS))
    + " END"
)

_SPARK_CLICKS = f"""
SELECT event_id, ts, epoch_s, event_type AS host, CAST(user_id AS STRING) AS article_id,
  CAST(event_id % 3 AS BIGINT) AS is_app,
  concat('c', CAST(k % 8 AS STRING)) AS cat,
  CASE WHEN k % 11 = 0 THEN NULL
       ELSE array(concat('t', CAST(k % 10 AS STRING)),
                  CASE WHEN k % 5 = 0 THEN '' ELSE concat('t', CAST(k % 7 AS STRING)) END) END AS tags,
  concat('g', CAST(user_id % 12 AS STRING)) AS geo_location,
  CAST(CASE WHEN user_id % 12 < 8 THEN 1 ELSE 0 END AS INT) AS is_india,
  CASE WHEN k % 9 = 0 THEN NULL WHEN k % 9 = 1 THEN ''
       ELSE concat('r', CAST(k % 9 AS STRING)) END AS referer,
  CASE WHEN value <= 5 THEN '5' WHEN value <= 10 THEN '10' WHEN value <= 15 THEN '15'
       WHEN value <= 20 THEN '20' ELSE '>20' END AS grp,
  CAST(floor(value) AS BIGINT) AS dnld_time,
  concat('ua', CAST(user_id % 15 AS STRING)) AS agent_type,
  {_AGENT_CASE} AS agent_text,
  CAST(event_id % 3 + 1 AS BIGINT) AS content_type,
  array(concat('s', CAST(k % 4 AS STRING))) AS subcat,
  concat('http://', event_type, '/', CAST(user_id AS STRING)) AS url,
  CAST(1400000000 + user_id AS BIGINT) AS publish_time,
  CASE WHEN k % 6 = 0 THEN '' ELSE concat('a', CAST(k % 6 AS STRING)) END AS author,
  concat('ch', CAST(user_id % 3 AS STRING)) AS channel,
  array(concat('c', CAST(k % 8 AS STRING)), concat('d', CAST(k % 3 AS STRING))) AS cat_ids,
  k % 2 = 0 AS is_group,
  CASE WHEN k % 7 = 0 THEN NULL ELSE CAST(k AS BIGINT) * 1000003 END AS cat_id_hash
FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k,
        timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', CAST(ts AS TIMESTAMP_NTZ)) AS epoch_s
      FROM {{events}})
"""

DUCK_CLICKS = f"""
SELECT event_id, ts, epoch_s, event_type AS host, CAST(user_id AS VARCHAR) AS article_id,
  CAST(event_id % 3 AS BIGINT) AS is_app,
  concat('c', CAST(k % 8 AS VARCHAR)) AS cat,
  CASE WHEN k % 11 = 0 THEN NULL
       ELSE [concat('t', CAST(k % 10 AS VARCHAR)),
             CASE WHEN k % 5 = 0 THEN '' ELSE concat('t', CAST(k % 7 AS VARCHAR)) END] END AS tags,
  concat('g', CAST(user_id % 12 AS VARCHAR)) AS geo_location,
  CAST(CASE WHEN user_id % 12 < 8 THEN 1 ELSE 0 END AS INT) AS is_india,
  CASE WHEN k % 9 = 0 THEN NULL WHEN k % 9 = 1 THEN ''
       ELSE concat('r', CAST(k % 9 AS VARCHAR)) END AS referer,
  CASE WHEN value <= 5 THEN '5' WHEN value <= 10 THEN '10' WHEN value <= 15 THEN '15'
       WHEN value <= 20 THEN '20' ELSE '>20' END AS grp,
  CAST(floor(value) AS BIGINT) AS dnld_time,
  concat('ua', CAST(user_id % 15 AS VARCHAR)) AS agent_type,
  {_AGENT_CASE} AS agent_text,
  CAST(event_id % 3 + 1 AS BIGINT) AS content_type,
  [concat('s', CAST(k % 4 AS VARCHAR))] AS subcat,
  concat('http://', event_type, '/', CAST(user_id AS VARCHAR)) AS url,
  CAST(1400000000 + user_id AS BIGINT) AS publish_time,
  CASE WHEN k % 6 = 0 THEN '' ELSE concat('a', CAST(k % 6 AS VARCHAR)) END AS author,
  concat('ch', CAST(user_id % 3 AS VARCHAR)) AS channel,
  [concat('c', CAST(k % 8 AS VARCHAR)), concat('d', CAST(k % 3 AS VARCHAR))] AS cat_ids,
  k % 2 = 0 AS is_group,
  CASE WHEN k % 7 = 0 THEN NULL ELSE CAST(k AS BIGINT) * 1000003 END AS cat_id_hash,
  coalesce(list_sort(list_distinct(list_filter(tags, lambda t: t IS NOT NULL AND t <> ''))), []) AS ctags
FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k,
        CAST(floor(epoch(ts)) AS BIGINT) AS epoch_s
      FROM events)
"""


def duck(body: str, *ctes: str) -> str:
    """DuckDB query over the view ``clicks`` and further table expressions."""
    return ",\n".join([f"WITH clicks AS ({DUCK_CLICKS})", *ctes]) + "\n" + body


# Columns of the supplied tables in use.  Their times carry no zone; declared as
# timestamps they are read as UTC instants right in the scan, so that filters on
# them reach the Parquet row groups.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string",
    "orders": "o_orderkey bigint, o_orderdate timestamp, o_orderstatus string",
    "documents": "doc_id bigint, text string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "customer": "c_custkey bigint, c_name string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A supplied table."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def as_clicks(events: DataFrame) -> DataFrame:
    """Events as clicks; works on a stream too."""
    return events.sparkSession.sql(_SPARK_CLICKS, events=events)


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as clicks."""
    return as_clicks(table(spark, sf_dir, "events"))


def click_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events file as a stream of clicks."""
    return as_clicks(event_stream(spark, sf_dir))


def event_stream(spark: SparkSession, sf_dir: str, name: str = "events") -> DataFrame:
    """A table as a stream, be it one file or a folder of files."""
    # streams take a single file only by a pattern
    return spark.readStream.schema(SCHEMAS[name]).parquet(f"{sf_dir}/[{name[0]}]{name[1:]}.parquet")


BAD_MESSAGE = 7
"""Messages with event_id % 50 equal to this are no JSON."""


def as_messages(events: DataFrame) -> DataFrame:
    """Clicks written as the JSON messages the stream would carry.

    The scalars come in the forms the cleaning rules have to deal with.
    """
    c = as_clicks(events)
    app = F.expr(
        "CASE event_id % 4 WHEN 0 THEN concat(is_app, '.0') WHEN 1 THEN 'x' ELSE CAST(is_app AS STRING) END"
    )
    body = F.to_json(
        F.struct(
            F.col("article_id").alias("articleId"), "host", "cat", app.alias("isAPP"),
            F.expr("CASE WHEN event_id % 5 = 0 THEN NULL ELSE content_type END").alias("contentType"),
            F.expr("CASE WHEN is_group THEN 'TRUE' ELSE 'no' END").alias("isGroup"),
            F.expr("CASE WHEN event_id % 13 = 0 THEN NULL ELSE url END").alias("url"), F.col("cat_id_hash").alias("catIdHash"),
            F.expr("CASE WHEN event_id % 6 = 0 THEN '1.4E9' ELSE CAST(publish_time AS STRING) END")
            .alias("publishTime"),
            F.expr("nullif(author, '')").alias("author"), "channel",
            F.col("geo_location").alias("geoLocation"), F.col("is_india").alias("isIndia"),
            F.col("grp").alias("group"), "referer", F.col("agent_type").alias("agentType"),
            F.col("dnld_time").alias("pgDownloadTime"),
            F.expr("CASE WHEN event_id % 3 = 0 THEN '2.0' END").alias("count"),
            F.expr("CAST(dnld_time % 100 AS INT)").alias("pgAccess5Min"),
            "subcat", F.col("cat_ids").alias("catIds"), "tags", "event_id",
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"),
        )
    )
    bad = F.col("event_id") % 50 == BAD_MESSAGE
    return c.select(
        F.when(bad, F.concat(F.lit("bad "), F.col("event_id"))).otherwise(body).alias("value")
    )


def message_folder(spark: SparkSession, sf_dir: str) -> str:
    """The messages of the events table in a folder of their own, as a topic holds them.

    The table may lie in a few large row groups, each of them one task; the messages are dealt evenly, as to
    the partitions of a topic, so that making and parsing them takes every core.
    """
    path = work_dir(spark, "messages")
    events = table(spark, sf_dir, "events").repartition(2 * spark.sparkContext.defaultParallelism)
    as_messages(events).write.parquet(path)
    return path


# The same messages as rows, bad ones left out, in the raw text forms.
DUCK_RAW = f"""raw AS (
SELECT event_id, epoch_s, article_id AS "articleId", host, cat,
  CASE event_id % 4 WHEN 0 THEN concat(is_app, '.0') WHEN 1 THEN 'x' ELSE CAST(is_app AS VARCHAR) END AS "isAPP",
  CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(content_type AS VARCHAR) END AS "contentType",
  CASE WHEN is_group THEN 'TRUE' ELSE 'no' END AS "isGroup",
  CASE WHEN event_id % 13 = 0 THEN NULL ELSE url END AS url, CAST(cat_id_hash AS VARCHAR) AS "catIdHash",
  CASE WHEN event_id % 6 = 0 THEN '1.4E9' ELSE CAST(publish_time AS VARCHAR) END AS "publishTime",
  nullif(author, '') AS author, channel, tags, ctags, referer, agent_type, dnld_time,
  CASE WHEN event_id % 3 = 0 THEN '2.0' END AS "count", CAST(dnld_time % 100 AS INT) AS access
FROM clicks WHERE event_id % 50 <> {BAD_MESSAGE})"""


def hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Allow-list of hosts: all event types but errors; clicks and views are big."""
    names = table(spark, sf_dir, "events").select(F.col("event_type").alias("host")).distinct()
    return names.where(F.col("host") != "error").select(
        "host", F.col("host").isin("click", "view").alias("is_big")
    )


KNOWN_AGENTS = 10
"""User groups below this have their agent in the dimension."""


def agent_dim(clicks_: DataFrame) -> DataFrame:
    """Agent dimension: the agents of the first user groups, as named by an earlier run."""
    known = clicks_.where(F.col("user_group") < KNOWN_AGENTS).select("agent_text").distinct()
    name = F.concat(F.lit("known "), F.length("agent_text"))
    device = F.when(F.length("agent_text") % 2 == 0, "Smartphone").otherwise("Personal computer")
    detail = F.struct(
        name.alias("browser_name"), F.lit("1").alias("browser_version"),
        F.lit("BROWSER").alias("browser_type"), device.alias("device_category"),
        F.lit("os").alias("os_name"), F.lit("family").alias("os_family"),
    )
    return known.select(F.col("agent_text").alias("user_agent"), detail.alias("detail"))


def with_user_group(clicks_: DataFrame) -> DataFrame:
    """Clicks with the number of their agent text."""
    return clicks_.withColumn("user_group", F.substring("agent_type", 3, 2).cast("int"))


def join_list(items: Column | str, sep: str = ",") -> Column:
    """Sorted list as text, for comparison."""
    return F.array_join(F.sort_array(items), sep)
