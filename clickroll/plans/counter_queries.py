"""Tags, dashboard counters and devices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickroll.functions.hashing import java_string_hash
from clickroll.functions.maps import map_to_list, merge_count_maps
from clickroll.operators import dashboard, devices, grouping, tags
from clickroll.plans.article_queries import HOUR, MIN5, totals
from clickroll.plans.inputs import (
    AGENTS, KNOWN_AGENTS, agent_dim, clicks, duck, join_list, with_user_group,
)
from clickroll.plans.registry import query
from clickroll.schemas import epoch_seconds
from clickroll.session import stored, work_dir
from clickroll.sinks.upserts import UpsertTable


# --- tags --------------------------------------------------------------
def duck_hash(text: str) -> str:
    """Hash of a text of basic-plane characters."""
    total = (
        f"list_reduce(list_prepend(0::BIGINT, list_transform(string_split({text}, ''), "
        "lambda c: ord(c)::BIGINT)), lambda a, c: (a * 31 + c) % 4294967296)"
    )
    return (
        f"CASE WHEN {text} IS NULL OR {text} = '' THEN NULL "
        f"WHEN {total} >= 2147483648 THEN CAST({total} - 4294967296 AS INT) ELSE CAST({total} AS INT) END"
    )


def duck_tags(start: str) -> str:
    return f"""long AS (SELECT {start} AS slice, host, unnest(ctags) AS tag, article_id, ts, event_id,
    cat, cat_ids, coalesce(cat_id_hash, 0) AS cat_id_hash FROM clicks),
per_article AS (SELECT slice, host, tag, article_id, count(*) AS n FROM long GROUP BY ALL),
lists AS (SELECT slice, host, tag, CAST(sum(n) AS BIGINT) AS "count",
    count(*) AS n FROM per_article GROUP BY 1, 2, 3),
firsts AS (SELECT slice, host, tag, arg_min({{'cat': cat, 'cat_ids': cat_ids, 'h': cat_id_hash}}, (ts, event_id)) AS f
    FROM long GROUP BY 1, 2, 3)"""


# One row per article of a tag, as the tables hold it.
_TAG_OUT = f"""SELECT slice, host, tag, article_id, count(*) AS "count", {duck_hash('tag')} AS c_tag,
arg_min({{'c': cat}}, (ts, event_id)).c AS cat,
array_to_string(list_sort(arg_min({{'c': cat_ids}}, (ts, event_id)).c), ',') AS cat_ids,
arg_min({{'h': cat_id_hash}}, (ts, event_id)).h AS cat_id_hash FROM long GROUP BY slice, host, tag, article_id"""


def _shown_tags(rows: DataFrame) -> DataFrame:
    return rows.select(
        epoch_seconds("slice").alias("slice"), "host", "tag", "article_id", "count", java_string_hash("tag").alias("c_tag"),
        "cat", join_list("cat_ids").alias("cat_ids"), F.coalesce("cat_id_hash", F.lit(0).cast("bigint")).alias("cat_id_hash"),
    )


def _hourly_tags(spark, sf_dir) -> DataFrame:
    return tags.tag_article_hourly(tags.tag_article_5min(clicks(spark, sf_dir)))


@query("agg_tag_5min", duck(_TAG_OUT, duck_tags(MIN5)))
def agg_tag_5min(spark, sf_dir):
    return _shown_tags(tags.tag_article_5min(clicks(spark, sf_dir)))


@query("agg_tag_hourly", duck(_TAG_OUT, duck_tags(HOUR)))
def agg_tag_hourly(spark, sf_dir):
    return _shown_tags(_hourly_tags(spark, sf_dir))


@query(
    "agg_tag_totals",
    duck(f"""SELECT l.slice, l.host, l.tag, l."count", l.n AS articles, {duck_hash('l.tag')} AS c_tag, f.cat AS cat,
array_to_string(list_sort(f.cat_ids), ',') AS cat_ids, f.h AS cat_id_hash
FROM lists l JOIN firsts USING (slice, host, tag)""", duck_tags(HOUR)),
)
def agg_tag_totals(spark, sf_dir):
    rows = tags.tag_totals(_hourly_tags(spark, sf_dir))
    return rows.withColumns({"slice": epoch_seconds("slice"), "cat_ids": join_list("cat_ids")}).drop("first_ts")


@query(
    "nest_tag_articles",
    duck("""SELECT slice, host, tag, article_id, per_article.n AS "count", l."count" AS total
FROM per_article JOIN lists l USING (slice, host, tag)""", duck_tags(HOUR)),
)
def nest_tag_articles(spark, sf_dir):
    # lists in fixed parts, each with the total of its tag, taken apart again
    nested = tags.nest_articles(_hourly_tags(spark, sf_dir))
    rows = nested.select("slice", "host", "tag", "total", F.inline("articles"))
    return rows.withColumn("slice", epoch_seconds("slice"))


@query(
    "merge_article_counts",
    duck('SELECT host, tag, article_id, n AS "count" FROM per_article',
        """per_article AS (SELECT host, tag, article_id, count(*) AS n
FROM (SELECT host, unnest(ctags) AS tag, article_id FROM clicks) GROUP BY ALL)""",
    ),
)
def merge_article_counts(spark, sf_dir):
    # the maps of two halves of a tag's clicks, merged row by row; a map holds the
    # articles of one hash part, so no group gathers all articles of a tag
    exploded = tags.explode_tags(clicks(spark, sf_dir).select("host", "article_id", "tags", "event_id"))
    counted = exploded.groupBy("host", "tag", "article_id").agg(
        F.count_if(F.col("event_id") % 2 == 0).alias("even"),
        F.count_if(F.col("event_id") % 2 == 1).alias("odd"),
    )
    entry = lambda n: F.when(F.col(n) > 0, F.struct("article_id", n))
    part = F.pmod(F.xxhash64("article_id"), F.lit(tags.PARTS)).alias("part")
    maps = counted.groupBy("host", "tag", part).agg(
        F.map_from_entries(F.collect_list(entry("even"))).alias("even"),
        F.map_from_entries(F.collect_list(entry("odd"))).alias("odd"),
    )
    merged = map_to_list(merge_count_maps(F.col("even"), F.col("odd")))
    return maps.select("host", "tag", F.inline(merged))


# --- dashboard ---------------------------------------------------------
_KEYED = f"""SELECT {HOUR} AS slice, host, geo_location, is_india, referer, grp, article_id, count(*) AS "count",
CAST(sum(dnld_time) AS BIGINT) AS tot_tm, arg_min({{'c': cat}}, (ts, event_id)).c AS cat FROM clicks GROUP BY 1, 2, 3, 4, 5, 6, 7"""


@query("agg_dashboard_keys", duck(_KEYED))
def agg_dashboard_keys(spark, sf_dir):
    keyed = dashboard.dashboard_keys(clicks(spark, sf_dir))
    return keyed.withColumn("slice", epoch_seconds("slice")).drop("first_ts")


def duck_counter(output: str) -> str:
    """Counter rows of an output: stamped with the end of the hour."""
    key = {
        "referer": "coalesce(nullif(referer, ''), 'none') AS referer",
        "response": "grp",
        "location": "is_india, geo_location AS location",
    }[output]
    groups = {"referer": "4", "response": "4", "location": "4, 5"}[output]
    return f"""SELECT {HOUR} + 3600 AS slice, article_id, host, {key}, count(*) AS "count",
CAST(sum(dnld_time) AS BIGINT) AS tot_tm, arg_min({{'c': cat}}, (ts, event_id)).c AS cat FROM clicks GROUP BY 1, 2, 3, {groups}"""


def counter(spark, sf_dir, output: str) -> DataFrame:
    """Counter table built from three batches, one of them delivered twice."""
    from clickroll.streaming.jobs import counter_frames, counter_log, read_counter

    log = counter_log(work_dir(spark, "dashboard"), [output])
    source = clicks(spark, sf_dir)
    for batch in (0, 1, 1, 2):
        part = source.where(F.col("event_id") % 3 == batch)
        log.write(spark, counter_frames(dashboard.dashboard_counts(part), [output]), batch)
    return read_counter(spark, log, output).withColumn("slice", epoch_seconds("slice"))


@query("upsert_referer", duck(duck_counter("referer")))
def upsert_referer(spark, sf_dir):
    return counter(spark, sf_dir, "referer")


@query("upsert_response", duck(duck_counter("response")))
def upsert_response(spark, sf_dir):
    return counter(spark, sf_dir, "response")


@query("upsert_location", duck(duck_counter("location")))
def upsert_location(spark, sf_dir):
    return counter(spark, sf_dir, "location")


def _by_cat(spark, sf_dir, output, rollup) -> DataFrame:
    counts, _ = dashboard.COUNTERS[output]
    rows = rollup(counts(dashboard.dashboard_counts(clicks(spark, sf_dir))))
    return rows.withColumn("slice", epoch_seconds("slice"))


@query(
    "agg_referer_by_cat",
    duck(totals("slice, host, referer", "ROLLUP(cat)", ["count"], "counter", ["cat"]),
         f"counter AS ({duck_counter('referer')})"),
)
def agg_referer_by_cat(spark, sf_dir):
    return _by_cat(spark, sf_dir, "referer", grouping.referer_by_cat)


@query(
    "agg_response_by_cat",
    duck(totals("slice, host, grp", "ROLLUP(cat)", ["count", "tot_tm"], "counter", ["cat"]),
         f"counter AS ({duck_counter('response')})"),
)
def agg_response_by_cat(spark, sf_dir):
    return _by_cat(spark, sf_dir, "response", grouping.response_by_cat)


@query(
    "agg_location_by_cat",
    duck(totals("slice, host, is_india", "CUBE(cat, location)", ["count"], "counter", ["cat", "location"]),
         f"counter AS ({duck_counter('location')})"),
)
def agg_location_by_cat(spark, sf_dir):
    return _by_cat(spark, sf_dir, "location", grouping.location_by_cat)


# --- devices -----------------------------------------------------------
# What the patterns say of the supplied agent texts, written down by hand:
# name, version, type, device, system, family.
_FACTS = [
    ("Chrome", "41.0.2227.1", "BROWSER", "Personal computer", "Windows 7", "Windows"),
    ("Firefox", "40.0", "BROWSER", "Personal computer", "Windows 10", "Windows"),
    ("Safari", "8.0.5", "BROWSER", "Personal computer", "OS X", "OS X"),
    ("Mobile Safari", "8.0", "MOBILE_BROWSER", "Smartphone", "iOS", "iOS"),
    ("Mobile Safari", "8.0", "MOBILE_BROWSER", "Tablet", "iOS", "iOS"),
    ("Chrome Mobile", "43.0.2357.78", "MOBILE_BROWSER", "Smartphone", "Android", "Android"),
    ("Chrome", "42.0.2311.111", "BROWSER", "Tablet", "Android", "Android"),
    ("IE", "9.0", "BROWSER", "Personal computer", "Windows 7", "Windows"),
    ("Opera Mini", "7.1.32052", "MOBILE_BROWSER", "Smartphone", "unknown", "unknown"),
    ("Googlebot", "2.1", "ROBOT", "Other", "unknown", "unknown"),
    ("Edge", "12.10240", "BROWSER", "Personal computer", "Windows 10", "Windows"),
    ("UC Browser", "10.5.0.575", "MOBILE_BROWSER", "Smartphone", "Android", "Android"),
    ("Firefox", "38.0", "BROWSER", "Personal computer", "Linux", "Linux"),
    ("Opera", "29.0.1795.47", "BROWSER", "Personal computer", "Windows 7", "Windows"),
    ("unknown", "unknown", "unknown", "unknown", "unknown", "unknown"),
]
_NAMES = "browser_name, browser_version, browser_type, device_category, os_name, os_family"


def _duck_facts() -> str:
    rows = ", ".join(
        "(" + ", ".join([str(i), *[f"'{v}'" for v in (a, *f)]]) + ")"
        for i, (a, f) in enumerate(zip(AGENTS, _FACTS))
    )
    return f"facts AS (SELECT * FROM (VALUES {rows}) t(user_group, user_agent, {_NAMES}))"


# the dimension knows the first groups under names of its own
_DUCK_DETAIL = f"""detail AS (SELECT user_group, user_agent,
CASE WHEN user_group < {KNOWN_AGENTS} THEN 'known ' || length(user_agent) ELSE browser_name END AS browser_name,
CASE WHEN user_group >= {KNOWN_AGENTS} THEN device_category
  WHEN length(user_agent) % 2 = 0 THEN 'Smartphone' ELSE 'Personal computer' END AS device_category FROM facts),
agents AS (SELECT *, CAST(substr(agent_type, 3) AS INT) AS user_group FROM clicks)"""
_DESKTOP = "CASE WHEN regexp_matches(device_category, 'phone|mobile|Tab|tab') THEN 0 ELSE 1 END"


@query(
    "describe_agents",
    duck(f"SELECT DISTINCT user_agent, {_NAMES} FROM facts JOIN clicks ON user_agent = agent_text", _duck_facts()),
)
def describe_agents(spark, sf_dir):
    rows = devices.describe_agents(clicks(spark, sf_dir), "agent_text")
    return rows.select("user_agent", "detail.*")


@query(
    "classify_device",
    duck(f"SELECT DISTINCT user_agent, device_category, {_DESKTOP} AS device FROM facts JOIN clicks ON user_agent = agent_text",
         _duck_facts()),
)
def classify_device(spark, sf_dir):
    from clickroll.functions.clean import is_desktop

    rows = devices.describe_agents(clicks(spark, sf_dir), "agent_text")
    category = F.col("detail.device_category")
    return rows.select("user_agent", category.alias("device_category"), is_desktop(category).alias("device"))


@query(
    "join_agent_dim",
    duck("SELECT event_id, host, browser_name, device_category FROM agents JOIN detail USING (user_group)",
         _duck_facts(), _DUCK_DETAIL),
)
def join_agent_dim(spark, sf_dir):
    source = with_user_group(clicks(spark, sf_dir))
    rows = devices.join_agent_dim(source, agent_dim(source), "agent_text")
    return rows.select("event_id", "host", "browser_name", "device_category")


def _host_agent(source: DataFrame) -> DataFrame:
    from clickroll.functions.slices import slice_start

    events = source.select(
        "host", F.col("agent_text").alias("agent_type"), "ts", "dnld_time",
        F.lit(1).cast("bigint").alias("elements"),
    )
    sums = devices.host_agent_sums(events, slice_start("hour", "ts"))
    return devices.host_agent(sums, agent_dim(source))


@query(
    "agg_host_agent",
    duck(
        f"""SELECT slice, host, {_DESKTOP} AS device, browser_name AS browser, n AS "count", t AS total_time, t // n AS avg_time FROM (
SELECT {HOUR} AS slice, host, user_group, count(*) AS n, CAST(sum(dnld_time) AS BIGINT) AS t
FROM agents GROUP BY 1, 2, 3) JOIN detail USING (user_group)""",
        _duck_facts(), _DUCK_DETAIL,
    ),
)
def agg_host_agent(spark, sf_dir):
    rows = _host_agent(with_user_group(clicks(spark, sf_dir)))
    return rows.withColumn("slice", epoch_seconds("slice"))


@query(
    "upsert_host_device",
    duck(
        f"""SELECT host, {_DESKTOP} AS device, browser_name AS browser, count(*) AS "count"
FROM agents JOIN detail USING (user_group) GROUP BY 1, 2, 3""",
        _duck_facts(), _DUCK_DETAIL,
    ),
)
def upsert_host_device(spark, sf_dir):
    source = with_user_group(clicks(spark, sf_dir))
    target = UpsertTable(work_dir(spark, "host-device"), ["host", "device", "browser"], ["count"])
    rows = stored(_host_agent(source), "host-agent")
    for batch in (0, 1, 1, 2):
        part = rows.where(F.pmod(F.unix_date(F.to_date("slice")), F.lit(3)) == batch)
        target.upsert(devices.host_device_deltas(part), batch)
    return target.read(spark)
