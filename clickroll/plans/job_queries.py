"""Chains of jobs as queries: messages through a stream, then every hour and day there is."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickroll.functions.hashing import java_string_hash
from clickroll.plans import jobs
from clickroll.plans.article_queries import DAY, HOUR, totals
from clickroll.plans.counter_queries import duck_counter, duck_hash
from clickroll.plans.inputs import BAD_MESSAGE, DUCK_RAW, duck, hosts, message_folder
from clickroll.plans.registry import query
from clickroll.schemas import epoch_seconds
from clickroll.session import work_dir
from clickroll.sources import clicks as messages


def _streamed(spark, sf_dir, *streams) -> jobs.Tables:
    """All messages of the events table through streams of the jobs, each run to its end."""
    folder = message_folder(spark, sf_dir)
    tables = jobs.Tables(work_dir(spark, "jobs"), hosts(spark, sf_dir))
    for stream in streams:
        source = messages.read_click_stream(spark, "parquet", {"path": folder}, "value string")
        stream(source, tables).awaitTermination()
    return tables


def _epoch(rows: DataFrame) -> DataFrame:
    return rows.withColumn("slice", epoch_seconds("slice"))


_APP = """CASE "isAPP" WHEN 'x' THEN 0 ELSE CAST(CAST("isAPP" AS DOUBLE) AS BIGINT) END AS is_app"""
_LISTED = "host IN ('click', 'view', 'purchase', 'signup')"


@query(
    "jobs_article_chain",
    duck(f"""SELECT {DAY} AS slice, "articleId" AS article_id, host, {_APP}, count(*) AS "count" FROM raw
WHERE {_LISTED} GROUP BY ALL""", DUCK_RAW),
)
def jobs_article_chain(spark, sf_dir):
    tables = _streamed(spark, sf_dir, jobs.article_stream)
    jobs.article_chain(spark, tables)
    rows = tables.read(spark, "article_daily")
    return _epoch(rows.select("slice", "article_id", "host", "is_app", F.col("count")))


@query(
    "jobs_tag_chain",
    duck(f"""SELECT slice, host, tag, count(DISTINCT "articleId") AS articles, count(*) AS "count", {duck_hash('tag')} AS c_tag
FROM (SELECT {HOUR} AS slice, host, unnest(ctags) AS tag, "articleId" FROM raw) GROUP BY 1, 2, 3""", DUCK_RAW),
)
def jobs_tag_chain(spark, sf_dir):
    tables = _streamed(spark, sf_dir, jobs.tag_stream)
    jobs.tag_chain(spark, tables)
    rows = tables.read(spark, "tag_totals")
    return _epoch(rows.select("slice", "host", "tag", "articles", F.col("count"), java_string_hash("tag").alias("c_tag")))


_GOOD = f"good AS (SELECT * FROM clicks WHERE event_id % 50 <> {BAD_MESSAGE})"


def _duck_by_cat(output: str, keys: str, sets: str, totalled: list[str], key: str) -> str:
    counted = duck_counter(output).replace("FROM clicks", "FROM good")
    rolled = totals(keys, sets, ["count"], f"({counted})", totalled)
    return f"""SELECT '{output}' AS output, slice, host, {key} AS "key", cat, "count" FROM ({rolled})"""


@query(
    "jobs_dashboard_chain",
    duck(" UNION ALL ".join([
        _duck_by_cat("referer", "slice, host, referer", "ROLLUP(cat)", ["cat"], "referer"),
        _duck_by_cat("response", "slice, host, grp", "ROLLUP(cat)", ["cat"], "grp"),
        _duck_by_cat("location", "slice, host, is_india", "CUBE(cat, location)", ["cat", "location"],
                     "concat_ws('/', is_india, location)"),
    ]), _GOOD),
)
def jobs_dashboard_chain(spark, sf_dir):
    # the category rollups of every hour that the counters hold
    tables = _streamed(spark, sf_dir, jobs.dashboard_stream)
    jobs.category_chain(spark, tables)
    keys = {"referer": F.col("referer"), "response": F.col("grp"), "location": F.concat_ws("/", "is_india", "location")}
    out = None
    for output, key in keys.items():
        rows = tables.read(spark, f"{output}_by_cat").select(
            F.lit(output).alias("output"), "slice", "host", key.alias("key"), "cat", "count")
        out = rows if out is None else out.unionByName(rows)
    return _epoch(out)


@query(
    "jobs_device_chain",
    # messages name their agents by short codes that no pattern knows
    duck("""SELECT host, 1 AS device, 'unknown' AS browser, count(*) AS "count" FROM raw GROUP BY 1""", DUCK_RAW),
)
def jobs_device_chain(spark, sf_dir):
    tables = _streamed(spark, sf_dir, jobs.device_stream)
    jobs.fold(spark, tables, keep=0)
    return jobs.read_devices(spark, tables)
