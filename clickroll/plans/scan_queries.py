"""Sources, scans, cleaning rules and filters."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickroll.functions.clean import clean_tags, default_referer
from clickroll.functions.hashing import java_string_hash
from clickroll.functions.slices import day_shard, slice_start
from clickroll.operators import articles, dashboard, filters, tags, words
from clickroll.plans.article_queries import DAY, HOUR, MIN5, daily_rows, duck_articles, shown
from clickroll.plans.counter_queries import (
    _TAG_OUT, _shown_tags, duck_counter, duck_hash, duck_tags,
)
from clickroll.plans.inputs import (
    DUCK_RAW, clicks, duck, hosts, join_list, message_folder, table,
)
from clickroll.plans.registry import query
from clickroll.schemas import epoch_seconds, to_documents
from clickroll.session import work_dir
from clickroll.sinks.append import with_partition, write_partitions
from clickroll.sources import clicks as messages
from clickroll.sources import offsets, scans

# A slice the scans look back from, and the seconds DuckDB compares with.
NOW = datetime(2024, 1, 15)
NOW_S = 1705276800
ALLOWED = "('click', 'view', 'purchase', 'signup')"


def _epoch(rows: DataFrame) -> DataFrame:
    return rows.withColumn("slice", epoch_seconds("slice"))


# --- scans -------------------------------------------------------------
def _interval(name: str, interval: str, seconds: int) -> None:
    sql = duck(f"SELECT event_id, host, epoch_s FROM clicks WHERE ts >= make_timestamp({(NOW_S - seconds) * 1000000})"
               f" AND ts < make_timestamp({NOW_S * 1000000})")

    @query(name, sql)
    def run(spark, sf_dir):
        rows = scans.interval_scan(clicks(spark, sf_dir), NOW, interval)
        return rows.select("event_id", "host", "epoch_s")


_interval("src_interval_scan", "WEEK", 302400)
_interval("src_interval_scan_hour", "HOUR", 1800)
_interval("src_interval_scan_month", "MONTH", 1296000)


_LAST = "CAST(epoch(date_trunc('minute', (SELECT max(ts) FROM clicks))) AS BIGINT) + 60"


@query(
    "src_interval_scan_minute",
    duck(f"SELECT event_id, host, epoch_s FROM clicks WHERE epoch_s >= {_LAST} - 300 AND epoch_s < {_LAST}"),
)
def src_interval_scan_minute(spark, sf_dir):
    # the end of the last minute with clicks, so that there are some at any size
    source = clicks(spark, sf_dir)
    end = F.unix_seconds(F.date_trunc("minute", F.max("ts"))) + 60
    now = datetime(1970, 1, 1) + timedelta(seconds=source.agg(end.alias("s")).first().s)
    return scans.interval_scan(source, now, "MINUTE").select("event_id", "host", "epoch_s")


@query(
    "src_hourly_articles",
    duck(f"""SELECT * FROM rows_ WHERE slice > {NOW_S - 3600} AND slice <= {NOW_S} AND host IN {ALLOWED}""",
         f"rows_ AS ({duck_articles(MIN5)})"),
)
def src_hourly_articles(spark, sf_dir):
    # the table is kept by day, and the scan takes the two days the hour touches
    path = work_dir(spark, "timed")
    write_partitions(articles.article_5min(clicks(spark, sf_dir)), path)
    timed = spark.read.parquet(path)
    return shown(scans.hourly_articles(timed, NOW, hosts(spark, sf_dir)).drop("dt"))


@query(
    "src_daily_articles",
    duck(f"""SELECT * FROM rows_ WHERE slice > {NOW_S - 86400} AND slice <= {NOW_S} AND "count" >= 1
         AND host IN {ALLOWED}""", f"rows_ AS ({duck_articles(HOUR)})"),
)
def src_daily_articles(spark, sf_dir):
    hourly = articles.article_hourly(articles.article_5min(clicks(spark, sf_dir)))
    rows = scans.daily_articles(hourly, NOW - timedelta(days=1), NOW, hosts(spark, sf_dir))
    return shown(rows)


@query(
    "src_hourly_tags",
    duck(f"SELECT * FROM ({_TAG_OUT}) WHERE slice >= {NOW_S - 3600} AND slice < {NOW_S}", duck_tags(MIN5)),
)
def src_hourly_tags(spark, sf_dir):
    return _shown_tags(scans.hourly_tags(tags.tag_article_5min(clicks(spark, sf_dir)), NOW))


@query(
    "src_hour_equality_scan",
    duck(f"SELECT * FROM ({duck_counter('location')}) WHERE slice = {NOW_S}"),
)
def src_hour_equality_scan(spark, sf_dir):
    keyed = dashboard.dashboard_keys(clicks(spark, sf_dir))
    rows = scans.hour_rows(dashboard.location_counts(keyed), NOW)
    return _epoch(rows).drop("first_ts")


@query(
    "src_pushdown_scan",
    "SELECT event_id, user_id, value FROM events WHERE event_type = 'click' AND user_id = 2",
)
def src_pushdown_scan(spark, sf_dir):
    wanted = (F.col("event_type") == "click") & (F.col("user_id") == 2)
    return scans.pushdown_scan(table(spark, sf_dir, "events"), ["event_id", "user_id", "value"], wanted)


@query("limit_scan", "SELECT event_id, user_id FROM events WHERE event_type = 'click' ORDER BY event_id LIMIT 5")
def limit_scan(spark, sf_dir):
    wanted = F.col("event_type") == "click"
    return scans.pushdown_scan(table(spark, sf_dir, "events"), ["event_id", "user_id"], wanted, 5, ["event_id"])


@query(
    "src_lookup_load",
    duck("SELECT agent_text, arg_max(host, event_id) AS host FROM clicks GROUP BY 1"),
)
def src_lookup_load(spark, sf_dir):
    return scans.load_lookup(clicks(spark, sf_dir), "agent_text", "host", "event_id")


@query(
    "src_day_shard",
    duck("""SELECT event_id,
strftime(make_timestamp((epoch_s - epoch_s % 300 - 300) * 1000000), '%Y%m%d') AS minute_shard,
strftime(make_timestamp((epoch_s - epoch_s % 3600 - 1800) * 1000000), '%Y%m%d') AS hour_shard,
strftime(make_timestamp((epoch_s - (epoch_s - 259200) % 604800 - 43200) * 1000000), '%Y%m%d') AS week_shard,
strftime(date_trunc('month', ts) - INTERVAL 12 HOUR, '%Y%m%d') AS month_shard FROM clicks"""),
)
def src_day_shard(spark, sf_dir):
    return clicks(spark, sf_dir).select(
        "event_id",
        day_shard(slice_start("min5", "ts"), "MINUTE").alias("minute_shard"),
        day_shard(slice_start("hour", "ts"), "HOUR").alias("hour_shard"),
        day_shard(slice_start("week", "ts"), "WEEK").alias("week_shard"),
        day_shard(slice_start("month", "ts"), "MONTH").alias("month_shard"),
    )


@query(
    "src_page_access",
    duck("SELECT access AS pg_access_5min, url FROM raw", DUCK_RAW),
)
def src_page_access(spark, sf_dir):
    return messages.page_access(spark.read.parquet(message_folder(spark, sf_dir)))


# --- offsets -----------------------------------------------------------
_DUCK_LEDGER = """ledger AS (SELECT host AS topic, CAST(event_id % 4 AS INT) AS "partition",
epoch_s - epoch_s % 86400 AS committed_at, min(event_id) AS from_offset, max(event_id) + 1 AS until_offset
FROM clicks GROUP BY 1, 2, 3)"""


def offset_ledger(spark, sf_dir) -> DataFrame:
    """A ledger with an entry per day: event ids as offsets, hosts as topics."""
    day = slice_start("day", "ts")
    return clicks(spark, sf_dir).groupBy(
        F.col("host").alias("topic"), (F.col("event_id") % 4).cast("int").alias("partition"),
        epoch_seconds(day).alias("committed_at"),
    ).agg(F.min("event_id").alias("from_offset"), (F.max("event_id") + 1).alias("until_offset"))


@query(
    "src_offset_resume",
    duck("""SELECT topic, '{' || string_agg('"' || "partition" || '":' || until_offset, ',' ORDER BY "partition") || '}'
AS starting_offsets FROM (SELECT topic, "partition", arg_max(until_offset, committed_at) AS until_offset
FROM ledger GROUP BY 1, 2) GROUP BY 1""", _DUCK_LEDGER),
)
def src_offset_resume(spark, sf_dir):
    return offsets.starting_offsets(offset_ledger(spark, sf_dir))


@query(
    "sort_latest_offsets",
    duck('SELECT * FROM ledger ORDER BY committed_at DESC, topic, "partition"', _DUCK_LEDGER),
)
def sort_latest_offsets(spark, sf_dir):
    return offsets.sort_latest(offset_ledger(spark, sf_dir))


# --- messages and cleaning ---------------------------------------------
def raw_clicks(spark, sf_dir) -> DataFrame:
    return messages.parse_clicks(spark.read.parquet(message_folder(spark, sf_dir)))


@query(
    "parse_click_json",
    duck("""SELECT event_id, epoch_s, "articleId", host, cat, "isAPP", "contentType", "isGroup", "catIdHash", "publishTime",
array_to_string(list_transform(tags, lambda t: '<' || t || '>'), '') AS tags, NULL AS bad FROM raw
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'bad ' || event_id
FROM clicks WHERE event_id % 50 = 7""", DUCK_RAW),
)
def parse_click_json(spark, sf_dir):
    parsed = raw_clicks(spark, sf_dir)
    marked = F.transform("tags", lambda t: F.concat(F.lit("<"), t, F.lit(">")))
    good = messages.good_clicks(parsed).select(
        "event_id", epoch_seconds("ts").alias("epoch_s"), "articleId", "host", "cat", "isAPP",
        "contentType", "isGroup", "catIdHash", "publishTime", F.array_join(marked, "").alias("tags"),
    )
    bad = messages.quarantined_clicks(parsed).withColumnRenamed("value", "bad")
    return good.unionByName(bad, allowMissingColumns=True)


@query(
    "normalise_clicks",
    duck("""SELECT event_id, epoch_s, "articleId" AS article_id, host,
CASE "isAPP" WHEN 'x' THEN 0 ELSE CAST(CAST("isAPP" AS DOUBLE) AS BIGINT) END AS is_app,
coalesce(CAST("contentType" AS BIGINT), 1) AS content_type,
CAST(CAST("publishTime" AS DOUBLE) AS BIGINT) AS publish_time, coalesce(author, '') AS author,
coalesce(channel, '') AS channel, "isGroup" = 'TRUE' AS is_group, CAST("catIdHash" AS BIGINT) AS cat_id_hash,
array_to_string(ctags, ',') AS tags FROM raw""", DUCK_RAW),
)
def normalise_clicks(spark, sf_dir):
    rows = messages.normalise_clicks(messages.good_clicks(raw_clicks(spark, sf_dir)))
    return rows.select(
        "event_id", epoch_seconds("ts").alias("epoch_s"), "article_id", "host", "is_app",
        "content_type", "publish_time", "author", "channel", "is_group", "cat_id_hash",
        join_list("tags").alias("tags"),
    )


@query(
    "normalise_agent_events",
    duck("""SELECT event_id, host, agent_type, CASE WHEN "count" IS NULL THEN 1::BIGINT ELSE 2::BIGINT END AS sent_count,
1::BIGINT AS "count", dnld_time, 1::BIGINT AS elements FROM raw""", DUCK_RAW),
)
def normalise_agent_events(spark, sf_dir):
    return messages.normalise_agent_events(messages.good_clicks(raw_clicks(spark, sf_dir))).drop("ts")


_TIMED = """timed AS (SELECT event_id, CASE event_id % 5 WHEN 0 THEN epoch_s * 1000
WHEN 1 THEN epoch_s * 1000 WHEN 4 THEN NULL ELSE 1441953000000 END AS epoch_ms FROM clicks)"""


@query("parse_click_time", duck("SELECT event_id, epoch_ms FROM timed WHERE epoch_ms IS NOT NULL", _TIMED))
def parse_click_time(spark, sf_dir):
    # times as text and as milliseconds; none and junk, where the source's time counts; no time of
    # any kind goes to quarantine
    when = F.expr("""CASE event_id % 5 WHEN 0 THEN date_format(ts, 'yyyy-MM-dd HH:mm:ss')
        WHEN 1 THEN CAST(unix_seconds(ts) * 1000 AS STRING) WHEN 2 THEN NULL ELSE 'no time' END""")
    body = F.to_json(F.struct("event_id", when.alias("ts")))
    source = F.when(F.col("event_id") % 5 != 4, F.timestamp_seconds(F.lit(1441953000)))
    sent = clicks(spark, sf_dir).select(body.alias("value"), source.alias("timestamp"))
    good = messages.good_clicks(messages.parse_clicks(sent))
    return good.select("event_id", F.unix_millis("ts").alias("epoch_ms"))


@query("clean_tags", duck("SELECT event_id, array_to_string(ctags, ',') AS tags FROM clicks"))
def clean_tags_query(spark, sf_dir):
    return clicks(spark, sf_dir).select("event_id", join_list(clean_tags("tags")).alias("tags"))


@query(
    "default_referer",
    duck("SELECT event_id, CASE WHEN referer IS NULL OR referer = '' THEN 'none' ELSE referer END AS referer FROM clicks"),
)
def default_referer_query(spark, sf_dir):
    return clicks(spark, sf_dir).select("event_id", default_referer("referer").alias("referer"))


# Keys whose lack makes an error document, per job, as columns of the clicks view.
ERROR_KEYS = {
    "dashboard": ["geo_location", "host", "is_india", "referer", "grp", "article_id"],
    "article": ["host", "article_id"],
    "device": ["host", "agent_type"],
}


def _holes(text: str) -> list[str]:
    """Each key with rows that lack it and rows where it is empty."""
    keys = ["geo_location", "host", "is_india", "referer", "grp", "article_id", "agent_type"]
    return [f"CASE event_id % {17 + 2 * i} WHEN 0 THEN NULL WHEN 1 THEN '' ELSE CAST({k} AS {text}) END AS {k}"
            for i, k in enumerate(keys)]


@query(
    "flag_error_docs",
    duck(" UNION ALL ".join(
        f"SELECT '{job}' AS job, event_id, " + " OR ".join(f"coalesce({k}, '') = ''" for k in keys) + " AS is_error_doc FROM holes"
        for job, keys in ERROR_KEYS.items()),
        f"holes AS (SELECT event_id, {', '.join(_holes('VARCHAR'))} FROM clicks)"),
)
def flag_error_docs(spark, sf_dir):
    rows = clicks(spark, sf_dir).selectExpr("event_id", *_holes("STRING"))
    out = None
    for job, keys in ERROR_KEYS.items():
        flagged = messages.flag_error_docs(rows, keys, empty_too=True).select(
            F.lit(job).alias("job"), "event_id", "is_error_doc")
        out = flagged if out is None else out.unionByName(flagged)
    return out


@query(
    "tag_hash",
    duck(f"""SELECT DISTINCT tag, {duck_hash('tag')} AS c_tag
FROM (SELECT unnest(string_split(text, ' ')) AS tag FROM conversations)"""),
)
def tag_hash(spark, sf_dir):
    texts = table(spark, sf_dir, "conversations").select(F.explode(F.split("text", " ")).alias("tag"))
    return texts.distinct().select("tag", java_string_hash("tag").alias("c_tag"))


_LINES = "lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)"


@query(
    "split_words",
    rf"""WITH {_LINES} SELECT doc_id, word FROM (SELECT doc_id,
unnest(regexp_split_to_array(line, '[ \t\n\x0B\f\r]+')) AS word FROM lines) WHERE word <> ''""",
)
def split_words(spark, sf_dir):
    lines = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("line"))
    return words.split_words(lines)


@query("explode_tags", duck("SELECT event_id, host, unnest(ctags) AS tag FROM clicks"))
def explode_tags(spark, sf_dir):
    return tags.explode_tags(clicks(spark, sf_dir).select("event_id", "host", "tags"))


# --- filters -----------------------------------------------------------
_DAYS = """days AS (SELECT epoch_s - epoch_s % 86400 AS slice, article_id, host, count(*) AS "count"
FROM clicks GROUP BY 1, 2, 3)"""


def day_counts(spark, sf_dir) -> DataFrame:
    return clicks(spark, sf_dir).groupBy(
        slice_start("day", "ts").alias("slice"), "article_id", "host"
    ).agg(F.count(F.lit(1)).alias("count"))


@query("filter_hosts", duck(f"SELECT event_id, host FROM clicks WHERE host IN {ALLOWED}"))
def filter_hosts(spark, sf_dir):
    rows = clicks(spark, sf_dir).select("event_id", "host")
    return filters.in_hosts(rows, hosts(spark, sf_dir)).select("event_id", "host")


@query("filter_min_count", duck('SELECT * FROM days WHERE "count" >= 2', _DAYS))
def filter_min_count(spark, sf_dir):
    return _epoch(filters.min_count(day_counts(spark, sf_dir), 2))


@query(
    "filter_big_host_noise",
    duck("""SELECT * FROM days WHERE NOT (host IN ('click', 'view') AND "count" < 2)""", _DAYS),
)
def filter_big_host_noise(spark, sf_dir):
    return _epoch(filters.drop_big_host_noise(day_counts(spark, sf_dir), hosts(spark, sf_dir)))


@query(
    "filter_time_range",
    duck(f"""SELECT event_id, 'left' AS ends FROM clicks WHERE epoch_s - epoch_s % 60 >= {NOW_S - 86400}
AND epoch_s - epoch_s % 60 < {NOW_S} UNION ALL
SELECT event_id, 'right' AS ends FROM clicks WHERE epoch_s - epoch_s % 60 > {NOW_S - 86400}
AND epoch_s - epoch_s % 60 <= {NOW_S}"""),
)
def filter_time_range(spark, sf_dir):
    rows = clicks(spark, sf_dir).select("event_id", slice_start("minute", "ts").alias("minute"))
    start = NOW - timedelta(days=1)
    left = filters.time_range(rows, "minute", start, NOW, "[)").select("event_id", F.lit("left").alias("ends"))
    right = filters.time_range(rows, "minute", start, NOW, "(]").select("event_id", F.lit("right").alias("ends"))
    return left.unionByName(right)


@query("filter_host_count_eq", duck("""SELECT * FROM days WHERE host = 'click' AND "count" = 2""", _DAYS))
def filter_host_count_eq(spark, sf_dir):
    return _epoch(filters.host_with_count(day_counts(spark, sf_dir), "click", 2))


@query(
    "partition_by_octet",
    "SELECT event_id, '192.168.2.' || (user_id % 255) AS ip, CAST((user_id % 255) % 5 AS INT) AS \"partition\" FROM events",
)
def partition_by_octet(spark, sf_dir):
    ip = F.concat(F.lit("192.168.2."), (F.col("user_id") % 255).cast("string"))
    rows = table(spark, sf_dir, "events").select("event_id", ip.alias("ip"))
    return with_partition(rows, "ip", 5)


_DOC_NAMES = """article_id AS "articleId", host, is_app AS "isAPP", "count", tags, content_type AS "contentType", cat,
subcat, url, publish_time AS "publishTime", author, channel, cat_ids AS "catIds", is_group AS "isGroup",
cat_id_hash AS "catIdHash\""""


def _documents(start: str, stamp: str, name: str) -> str:
    return f'SELECT {stamp} AS "{name}", {_DOC_NAMES} FROM ({duck_articles(start)})'


def _flat(rows: DataFrame) -> DataFrame:
    return rows.withColumns({c: join_list(c) for c in ("tags", "subcat", "catIds")})


@query("to_documents", duck(_documents(MIN5, "slice * 1000", "timeStamp")))
def documents(spark, sf_dir):
    return _flat(to_documents(articles.article_5min(clicks(spark, sf_dir)), unit="ms"))


@query("to_documents_hour", duck(_documents(HOUR, "slice", "timeStamp")))
def documents_hour(spark, sf_dir):
    hourly = articles.article_hourly(articles.article_5min(clicks(spark, sf_dir)))
    return _flat(to_documents(hourly))


@query("to_documents_day", duck(_documents(DAY, "slice", "ts")))
def documents_day(spark, sf_dir):
    return _flat(to_documents(daily_rows(spark, sf_dir), time_name="ts"))


@query(
    "to_documents_counter",
    duck(f"""SELECT slice * 1000 AS "timeStamp", article_id AS "articleId", host, referer, "count", tot_tm AS "totTm", cat,
strftime(make_timestamp(slice * 1000000), '%Y-%m-%d %H:%M:%S') AS tsd FROM ({duck_counter('referer')})"""),
)
def documents_counter(spark, sf_dir):
    rows = dashboard.referer_counts(dashboard.dashboard_counts(clicks(spark, sf_dir)))
    return to_documents(rows, unit="ms", date_name="tsd").withColumn("tsd", F.date_format("tsd", "yyyy-MM-dd HH:mm:ss"))
