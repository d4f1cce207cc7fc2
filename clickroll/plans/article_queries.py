"""Articles: 5 minutes to month, rollups by slice and by category."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickroll.operators import articles, grouping, words
from clickroll.operators.rollup import rollup_by_slice
from clickroll.plans.inputs import clicks, duck, hosts, join_list, table
from clickroll.plans.registry import query
from clickroll.schemas import epoch_seconds
from clickroll.session import stored, work_dir
from clickroll.sinks.upserts import UpsertTable
from clickroll.schemas import ARTICLE_ATTRS, ARTICLE_KEYS

TAGS = "array_to_string(list_sort(list_distinct(flatten(list(ctags)))), ',') AS tags"
_FIRST = "arg_min({{{0}}}, (ts, event_id)) AS f".format(
    ", ".join(f"'{a}': {a}" for a in ARTICLE_ATTRS)
)
_ATTRS = ", ".join(
    f"array_to_string(list_sort(f.{a}), ',') AS {a}" if a in ("subcat", "cat_ids") else f"f.{a} AS {a}"
    for a in ARTICLE_ATTRS
)

# Slice starts in epoch seconds, by UTC arithmetic.
MIN5 = "epoch_s - epoch_s % 300"
HOUR = "epoch_s - epoch_s % 3600"
DAY = "epoch_s - epoch_s % 86400"
# 4 January 1970 was a Sunday
WEEK = "epoch_s - (epoch_s - 259200) % 604800"
MONTH = "CAST(epoch(date_trunc('month', ts)) AS BIGINT)"


def duck_articles(start: str, source: str = "clicks") -> str:
    """Article rows of DuckDB for a slice."""
    return f"""SELECT slice, article_id, host, is_app, "count", tags, {_ATTRS} FROM (
SELECT {start} AS slice, article_id, host, is_app, count(*) AS "count", {TAGS}, {_FIRST}
FROM {source} GROUP BY 1, 2, 3, 4)"""


def shown(rows: DataFrame) -> DataFrame:
    """Article rows with plain columns."""
    lists = {c: join_list(c) for c in ("tags", "subcat", "cat_ids") if c in rows.columns}
    return rows.withColumns({"slice": epoch_seconds("slice"), **lists}).drop("first_ts")


@query("agg_article_5min", duck(duck_articles(MIN5)))
def agg_article_5min(spark, sf_dir):
    return shown(articles.article_5min(clicks(spark, sf_dir)))


@query("agg_article_hourly", duck(duck_articles(HOUR)))
def agg_article_hourly(spark, sf_dir):
    return shown(articles.article_hourly(articles.article_5min(clicks(spark, sf_dir))))


def daily_rows(spark, sf_dir) -> DataFrame:
    hourly = articles.article_hourly(articles.article_5min(clicks(spark, sf_dir)))
    return articles.article_daily(hourly)


@query("agg_article_daily", duck(duck_articles(DAY)))
def agg_article_daily(spark, sf_dir):
    return shown(daily_rows(spark, sf_dir))


def trend_table(path: str) -> UpsertTable:
    """Month or week trend of articles."""
    return UpsertTable(path, ["slice", *ARTICLE_KEYS], ["count"], ARTICLE_ATTRS, ["tags"], "first_ts")


def _trend(spark, sf_dir, label, deltas) -> DataFrame:
    # a run per ten days, the second one delivered twice
    daily = stored(daily_rows(spark, sf_dir), "daily")
    trend = trend_table(work_dir(spark, label))
    for batch in (0, 1, 1, 2):
        days = daily.where(F.least(F.floor((F.dayofmonth("slice") - 1) / 10), F.lit(2)) == batch)
        trend.upsert(deltas(days), batch)
    return shown(trend.read(spark))


# days of big hosts with a single click are noise
KEPT_DAYS = f"""kept AS (SELECT * FROM (SELECT *, count(*) OVER
  (PARTITION BY article_id, host, is_app, {DAY}) AS n FROM clicks)
  WHERE NOT (host IN ('click', 'view') AND n < 2))"""


@query("upsert_article_month", duck(duck_articles(MONTH, "kept"), KEPT_DAYS))
def upsert_article_month(spark, sf_dir):
    big = hosts(spark, sf_dir)
    return _trend(spark, sf_dir, "month", lambda d: articles.month_deltas(d, big))


@query("upsert_article_week", duck(duck_articles(WEEK)))
def upsert_article_week(spark, sf_dir):
    return _trend(spark, sf_dir, "week", articles.week_deltas)


# --- rollups by slice --------------------------------------------------
_CLICK_AGGS = 'host, count(*) AS "count", CAST(sum(dnld_time) AS BIGINT) AS tot_tm'


def _rollup_clicks(name: str, start: str, **options) -> None:
    @query(f"rollup_{name}", duck(f"SELECT {start} AS slice, {_CLICK_AGGS} FROM clicks GROUP BY 1, 2"))
    def run(spark, sf_dir):
        aggs = [F.count(F.lit(1)).alias("count"), F.sum("dnld_time").alias("tot_tm")]
        rows = rollup_by_slice(clicks(spark, sf_dir), "ts", name, ["host"], aggs, **options)
        return rows.withColumn("slice", epoch_seconds("slice"))


_rollup_clicks("second", "epoch_s")
_rollup_clicks("min5", MIN5)
_rollup_clicks("minute", "epoch_s - epoch_s % 60")
_rollup_clicks("hour", HOUR)
_rollup_clicks(
    "half_hour",
    "CASE WHEN ts > make_timestamp(((epoch_s - epoch_s % 3600 + 1800) * 1000000)::BIGINT) "
    "THEN epoch_s - epoch_s % 3600 + 3600 ELSE epoch_s - epoch_s % 3600 + 1800 END",
)
_rollup_clicks(
    "hour_n", "epoch_s - epoch_s % 3600 - ((epoch_s // 3600) % 12 % 5) * 3600", n=5
)
_rollup_clicks("day", DAY)

_ORDER_AGGS = 'o_orderstatus AS status, count(*) AS "count", max(o_orderkey) AS last_key'


def _rollup_orders(name: str, start: str, back: int = 0) -> None:
    sql = f"SELECT CAST(epoch({start}) AS BIGINT) AS slice, {_ORDER_AGGS} FROM orders GROUP BY 1, 2"

    @query(f"rollup_{name}", sql)
    def run(spark, sf_dir):
        orders = table(spark, sf_dir, "orders").select(
            F.col("o_orderdate").alias("ts"),
            F.col("o_orderstatus").alias("status"), "o_orderkey",
        )
        aggs = [F.count(F.lit(1)).alias("count"), F.max("o_orderkey").alias("last_key")]
        kind = name.split("_back")[0]
        rows = rollup_by_slice(orders, "ts", kind, ["status"], aggs, back=back)
        return rows.withColumn("slice", epoch_seconds("slice"))


_SUNDAY = "date_trunc('day', o_orderdate) - to_days(CAST(dayofweek(o_orderdate) AS INTEGER))"
_rollup_orders("week", _SUNDAY)
_rollup_orders("month", "date_trunc('month', o_orderdate)")
_rollup_orders("year", "date_trunc('year', o_orderdate)")
_rollup_orders("week_back", f"{_SUNDAY} - INTERVAL 14 DAY", back=2)
_rollup_orders("month_back", "date_trunc('month', o_orderdate) - INTERVAL 3 MONTH", back=3)


# --- by category -------------------------------------------------------
def totals(keys: str, sets: str, sums: list[str], source: str, totalled: list[str]) -> str:
    """Grouping sets of DuckDB, with "All" for what a set leaves out."""
    named = ", ".join(
        f"CASE WHEN grouping({c}) = 1 THEN 'All' ELSE {c} END AS {c}_" for c in totalled
    )
    back = ", ".join(f"{c}_ AS {c}" for c in totalled)
    added = ", ".join(f'CAST(sum("{s}") AS BIGINT) AS "{s}"' for s in sums)
    names = ", ".join(f'"{s}"' for s in sums)
    return (
        f"SELECT {keys}, {back}, {names} FROM (SELECT {keys}, {named}, {added} "
        f"FROM {source} GROUP BY {keys}, {sets})"
    )


@query(
    "agg_clicks_by_cat_hourly",
    duck(
        totals("slice, host", "ROLLUP(cat)", ["count"], "listed", ["cat"]),
        f"rows_ AS ({duck_articles(HOUR)})",
        """listed AS (SELECT * FROM rows_ WHERE "count" >= 1
           AND host IN ('click', 'view', 'purchase', 'signup'))""",
    ),
)
def agg_clicks_by_cat_hourly(spark, sf_dir):
    # at the hour, as the job runs it, with a limit that these tables reach
    rows = articles.article_hourly(articles.article_5min(clicks(spark, sf_dir)))
    out = grouping.clicks_by_cat(rows, hosts(spark, sf_dir), 1)
    return out.withColumn("slice", epoch_seconds("slice"))


@query(
    "agg_clicks_by_cat",
    duck(
        totals("slice, host", "ROLLUP(cat)", ["count"], "listed", ["cat"]),
        f"rows_ AS ({duck_articles(MONTH)})",
        """listed AS (SELECT * FROM rows_ WHERE "count" >= 5
           AND host IN ('click', 'view', 'purchase', 'signup'))""",
    ),
)
def agg_clicks_by_cat(spark, sf_dir):
    # month rows, since hourly ones rarely reach five clicks in these tables
    rows = articles.merge_article_rows(
        articles.article_5min(clicks(spark, sf_dir)), F.date_trunc("month", "slice")
    )
    out = grouping.clicks_by_cat(rows, hosts(spark, sf_dir))
    return out.withColumn("slice", epoch_seconds("slice"))


_TEXT_WORDS = r"""lines AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents),
words AS (SELECT unnest(regexp_split_to_array(line, '[ \t\n\x0B\f\r]+')) AS word FROM lines)"""


@query("word_count", f"WITH {_TEXT_WORDS} SELECT word, count(*) AS \"count\" FROM words WHERE word <> '' GROUP BY 1")
def word_count(spark, sf_dir):
    lines = table(spark, sf_dir, "documents").select(F.col("text").alias("line"))
    return words.word_count(words.split_words(lines))
