"""The whole chain, run as it would be: streams first, then hours, days, categories."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from clickroll.operators import articles, dashboard, devices, grouping, tags
from clickroll.functions.slices import slice_start
from clickroll.operators.filters import in_hosts
from clickroll.plans import jobs
from clickroll.plans.article_queries import shown, trend_table
from clickroll.plans.inputs import as_messages, hosts, table
from clickroll.sources import clicks as messages
from test_streams import same

SF = "/root/testdata/sf0.001"
DAY = datetime(2024, 1, 2)


@pytest.fixture(scope="module", params=["UTC", "Asia/Kolkata"])
def run(request, spark, tmp_path_factory):
    """Two days of messages in two files, through every job; in UTC and on another wall clock."""
    folder = str(tmp_path_factory.mktemp("jobs"))
    events = table(spark, SF, "events").where(F.col("ts") < F.lit("2024-01-03").cast("timestamp"))
    for part in (0, 1):
        as_messages(events.where(F.col("event_id") % 2 == part)).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    tables = jobs.Tables(f"{folder}/out", hosts(spark, SF), request.param)

    def source():
        return messages.read_click_stream(
            spark, "parquet", {"path": f"{folder}/in", "maxFilesPerTrigger": "1"}, "value string")

    logged = []
    jobs.log.info = lambda text, *args: logged.append(args)
    for job in (jobs.article_stream, jobs.tag_stream, jobs.dashboard_stream, jobs.device_stream):
        job(source(), tables).awaitTermination()
    for name in ("article", "tag", "dashboard", "device"):
        own = [(batch, seen) for job, batch, seen in logged if job == name]
        assert [batch for batch, _ in own] == [0, 1]
        assert sum(seen["messages"] for _, seen in own) == events.count()
        assert sum(seen["bad"] for _, seen in own) > 0
        assert name == "dashboard" or sum(seen["error_docs"] for _, seen in own) == 0
    for hour in (DAY, DAY + timedelta(hours=5)):
        for n in range(5):
            jobs.hourly_articles(spark, tables, hour + timedelta(hours=n))
    jobs.daily_articles(spark, tables, DAY)
    jobs.daily_articles(spark, tables, DAY)
    jobs.hourly_tags(spark, tables, DAY + timedelta(hours=3))
    jobs.by_category(spark, tables, DAY + timedelta(hours=3))
    jobs.by_category(spark, tables, DAY + timedelta(hours=3))
    good = messages.good_clicks(messages.parse_clicks(spark.read.parquet(f"{folder}/in").withColumn("timestamp", F.lit(None))))
    return tables, good, messages.normalise_clicks(good).cache()


def wall(tables, when):
    return F.lit(str(tables.utc(when))).cast("timestamp")


def between(tables, clicks, start, hours):
    return clicks.where((F.col("ts") >= wall(tables, start)) & (F.col("ts") < wall(tables, start + timedelta(hours=hours))))


def test_day_and_month(spark, run):
    tables, _, clicks = run
    listed = in_hosts(between(tables, clicks, DAY, 10), tables.hosts)
    want = articles.article_daily(articles.article_5min(listed, tables.zone), tz=tables.zone)
    got = tables.read(spark, "article_daily")
    assert got.count() > 5
    same(shown(got), shown(want))
    same(shown(trend_table(tables.path("article_month")).read(spark)), shown(articles.month_deltas(want, tables.hosts, tables.zone)))
    same(shown(trend_table(tables.path("article_week")).read(spark)), shown(articles.week_deltas(want, tables.zone)))


def test_hours_are_kept_apart(spark, run):
    tables, _, _ = run
    rows = tables.read(spark, "article_hourly")
    assert rows.select("slice").distinct().count() > 3
    hour = tables.read(spark, "article_hourly", None, DAY + timedelta(hours=5))
    assert len({f.rsplit("/", 2)[-2] for f in hour.inputFiles()}) == 1
    assert {r.slice for r in hour.select("slice").collect()} <= {r.slice for r in rows.select("slice").collect()}


def test_many_hours_in_one_job_equal_single_ones(spark, run, tmp_path):
    tables, _, clicks = run
    before = tables.read(spark, "article_hourly").where(F.col("slice") < wall(tables, DAY + timedelta(hours=10))).cache()
    assert before.count() > 5
    jobs.hourly_articles(spark, tables, DAY, 10)
    same(shown(tables.read(spark, "article_hourly")), shown(before))
    # an hour that is run again without its clicks is empty from then on, whatever wrote it
    hour, rows = DAY + timedelta(hours=5), tables.read(spark, "article_hourly")
    tables.write(rows.limit(0), "article_hourly", hour, timedelta(hours=1))
    ended = (F.col("slice") < wall(tables, hour)) | (F.col("slice") >= wall(tables, hour + timedelta(hours=1)))
    same(shown(tables.read(spark, "article_hourly")), shown(before.where(ended)))
    jobs.hourly_articles(spark, tables, hour)
    same(shown(tables.read(spark, "article_hourly")), shown(before))


def test_quarantine_and_tags(spark, run):
    tables, _, clicks = run
    bad = jobs.read_quarantine(spark, tables, "article")
    events = table(spark, SF, "events").where(F.col("ts") < F.lit("2024-01-03").cast("timestamp"))
    want_bad = events.where("event_id % 50 = 7").select(F.concat(F.lit("bad "), "event_id").alias("value"))
    assert bad.count() > 0
    same(bad, want_bad)
    part = between(tables, clicks, DAY + timedelta(hours=3), 1)
    want = tags.tag_article_hourly(tags.tag_article_5min(part, tables.zone), tables.zone)
    got = tables.read(spark, "tag_hourly")
    assert got.count() > 0
    same(got, want)
    same(tables.read(spark, "tag_totals"), tags.tag_totals(want))


def test_counters_and_categories(spark, run):
    tables, _, clicks = run
    want = dashboard.location_counts(dashboard.dashboard_counts(clicks, tables.zone)).drop("first_ts")
    same(jobs.read_counter(spark, tables, "location"), want)
    cats = tables.read(spark, "location_by_cat")
    assert cats.count() > 0
    same(cats, grouping.location_by_cat(want.where(F.col("slice") == wall(tables, DAY + timedelta(hours=4)))))
    ran = spark.read.parquet(tables.path("runs"))
    assert ran.count() == 2 and ran.distinct().count() == 1
    hour = jobs.read_counter(spark, tables, "location", DAY + timedelta(hours=3))
    same(hour, want.where(F.col("slice") == wall(tables, DAY + timedelta(hours=4))))
    # a day without clicks opens no folder
    assert not jobs.read_counter(spark, tables, "location", DAY + timedelta(days=30)).inputFiles()


def test_devices(spark, run):
    tables, good, _ = run
    events = messages.normalise_agent_events(good)
    sums = devices.host_agent_sums(events, slice_start("hour", "ts", tz=tables.zone))
    dim = jobs.read_agents(spark, tables)
    assert dim.count() == dim.select("user_agent").distinct().count() == events.select("agent_type").distinct().count()
    want = devices.host_device_deltas(devices.host_agent(sums, dim))
    same(jobs.read_devices(spark, tables), want)
    jobs.fold(spark, tables, keep=0)
    same(jobs.read_devices(spark, tables), want)


def test_clicks_without_time_and_resumed_offsets(spark, tmp_path):
    sent = [(f'{{"articleId":"a{i % 3}","host":"h"}}', datetime(2024, 1, 2, 3, i), "t", i % 2, i) for i in range(30)]
    frame = spark.createDataFrame(sent, "value string, timestamp timestamp, topic string, partition int, offset bigint")
    frame.write.parquet(f"{tmp_path}/in")
    tables = jobs.Tables(f"{tmp_path}/out", spark.createDataFrame([("h", False)], "host string, is_big boolean"))
    assert jobs.resume_from(spark, tables, "t") == "earliest"
    jobs.article_stream(messages.read_click_stream(spark, "parquet", {"path": f"{tmp_path}/in"}, frame.schema), tables).awaitTermination()
    jobs.hourly_articles(spark, tables, datetime(2024, 1, 2, 3))
    rows = tables.read(spark, "article_hourly").collect()
    assert {r.article_id: r["count"] for r in rows} == {"a0": 10, "a1": 10, "a2": 10}
    assert jobs.resume_from(spark, tables, "t") == '{"t":{"0":29,"1":30}}'


def test_messages_are_dealt_evenly_and_attributes_once(spark, tmp_path):
    """One row group of events: every core has its part of the messages to make and to parse."""
    from clickroll.operators.articles import article_hourly
    from clickroll.plans import inputs

    events = inputs.table(spark, "/root/testdata/sf0.001", "events")
    events.withColumn("props", F.when(F.col("event_id") % 9 == 0, F.lit(None)).otherwise(F.col("props"))).coalesce(1).write.parquet(
        f"{tmp_path}/events.parquet")
    folder = inputs.message_folder(spark, str(tmp_path))
    rows = spark.read.schema("value string").parquet(folder)
    held = [r["count"] for r in rows.groupBy(F.input_file_name().alias("file")).count().collect()]
    assert len(held) >= spark.sparkContext.defaultParallelism and max(held) <= 2 * min(held)
    plain = inputs.as_messages(inputs.table(spark, str(tmp_path), "events"))
    assert rows.exceptAll(plain).isEmpty() and plain.exceptAll(rows).isEmpty()
    # behind the generator, only the first of a row's tags carries count and attributes into the aggregate
    many = spark.createDataFrame([(datetime(2024, 1, 1), "a", "h", 0, 5, ["x", "y", "x", "", None], datetime(2024, 1, 1), "c")],
                                 "slice timestamp, article_id string, host string, is_app bigint, count bigint, tags array<string>, "
                                 "first_ts timestamp, cat string")
    (got,) = article_hourly(many.unionAll(many)).collect()
    assert (got["count"], got.tags, got.cat) == (10, ["x", "y"], "c")
