"""The jobs, from messages to month trends, over tables below one folder.

```
messages -> article_5min -> article_hourly -> article_daily -> article_month, article_week
         |                        \\-> clicks_by_cat
         |-> tag_5min -> tag_hourly -> tag_totals
         |-> referer, response, location -> ..._by_cat
         \\-> host_agent, host_device, agents
```

Streams keep their own checkpoints.  A micro-batch of a stream commits once: its rows, its quarantine
and its offsets count together or not at all.  The batch jobs take the slice they run for, or many from it on,
and replace what was there, also where there is nothing to write, so any of them can be
run again.  Slices are named by their start.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from clickroll.operators import articles, dashboard, devices, grouping, tags
from clickroll.operators.filters import in_hosts, min_count
from clickroll.functions.clean import is_error_doc
from clickroll.functions.slices import slice_start
from clickroll.plans.article_queries import trend_table
from clickroll.schemas import AGENT_DIM
from clickroll.sinks import append, ledgers
from clickroll.sinks.commits import CommitLog, Kind
from clickroll.sinks.upserts import UpsertTable
from clickroll.sources import clicks as messages
from clickroll.sources import offsets
from clickroll.streaming import jobs as streams

log = logging.getLogger(__name__)

_ATTRS = "content_type bigint, cat string, subcat array<string>, url string, publish_time bigint, " \
    "author string, channel string, cat_ids array<string>, is_group boolean, cat_id_hash bigint"
ARTICLES = f"slice timestamp, article_id string, host string, is_app bigint, count bigint, " \
    f"tags array<string>, first_ts timestamp, {_ATTRS}"
TAGS = "slice timestamp, host string, tag string, article_id string, count bigint, " \
    "first_ts timestamp, cat string, cat_ids array<string>, cat_id_hash bigint"


KEEP_OPEN = 8
"""Batches of a run that a fold leaves open."""
FOLD_AT = 32
"""Batches after which a stream folds its tables."""

OFFSETS = "topic string, partition int, from_offset bigint, until_offset bigint, description string"


def _schema(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


@dataclass(frozen=True)
class Tables:
    """Where the tables lie, the host list they are filtered by, and their time zone.

    Days and hours, of slices as of folders, are those of the zone; the hours and days that
    jobs are called with are wall-clock times of it.
    """

    root: str
    hosts: DataFrame
    tz: str = "UTC"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/_checkpoints/{name}"

    @property
    def zone(self) -> str | None:
        return None if self.tz == "UTC" else self.tz

    def utc(self, wall: datetime) -> datetime:
        """A wall-clock time as UTC, without zone."""
        return wall.replace(tzinfo=ZoneInfo(self.tz)).astimezone(timezone.utc).replace(tzinfo=None)

    def log(self, name: str) -> CommitLog:
        """The table a batch job writes; a run replaces the slices it is for.

        Tables of articles lie sorted by host and article, with Bloom filters of the articles, for scans of single ones.
        """
        points = {"sort": ("host", "article_id"), "bloom": ("article_id",)} if name in ("article_hourly", "article_daily") else {}
        return CommitLog(self.path(name), {append.ROWS: Kind("slice", **points)}, owns=True)

    def write(self, rows: DataFrame, name: str, start: datetime, span: timedelta, late: timedelta = timedelta(0)) -> None:
        """Replace the rows of a table from ``start`` on; slices that carry the end of their hour are ``late``."""
        self.log(name).write_span(rows, self.utc(start) + late, self.utc(start + span) + late)

    def read(self, spark: SparkSession, name: str, ddl: str | None = None, start: datetime | None = None,
             span: timedelta = timedelta(hours=1)) -> DataFrame:
        """Rows of a table that a batch job writes, all or those from ``start`` on."""
        ends = (self.utc(start), self.utc(start + span)) if start else (None, None)
        return self.log(name).read(spark, append.ROWS, _schema(ddl) if ddl else None, *ends)

    def streamed(self, spark: SparkSession, job: str, name: str, ddl: str, start: datetime, count: int = 1) -> DataFrame:
        """Rows of ``count`` hours of a table that a stream writes, from the batches that touch them."""
        end = start + timedelta(hours=count)
        return stream_log(self, job).read(spark, name, _schema(ddl), self.utc(start), self.utc(end))


QUARANTINE = "quarantine"


def device_table(tables: Tables) -> UpsertTable:
    """Counter per host, device and browser."""
    return UpsertTable("", ["host", "device", "browser"], ["count"])


def agent_table(tables: Tables) -> UpsertTable:
    """The agent dimension: the first description of an agent stays."""
    return UpsertTable("", ["user_agent"], [], ["detail"], lookup="user_agent")


def stream_log(tables: Tables, job: str) -> CommitLog:
    """The tables a stream writes, with the records of its batches."""
    kinds = {
        "article": {"article_5min": Kind("slice")},
        "tag": {"tag_5min": Kind("slice")},
        "dashboard": {o: streams.counter_table(o).kind for o in dashboard.COUNTERS},
        "device": {"host_agent": Kind("slice"), "host_device": device_table(tables).kind, "agents": agent_table(tables).kind},
    }[job]
    return CommitLog(tables.path(job), {**kinds, QUARANTINE: Kind()})


def _start(stream: DataFrame, write, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or streams.trigger_for(None)))
        .start()
    )


def _watched(batch: DataFrame, batch_id: int, job: str, tables: Tables, keys: list[str],
             frames: Callable[[DataFrame], dict[str, DataFrame]]) -> None:
    """Commit what ``frames`` makes of the good messages of a batch, the bad ones and the offsets.

    Error documents lack one of ``keys``; they are counted and kept.  The messages
    are read again only if the pass before met a bad one.
    """
    log_, spark, seen = stream_log(tables, job), batch.sparkSession, Observation()
    parsed, bad = messages.parse_clicks(batch), F.col("_bad")
    watched = messages.marked_clicks(parsed).observe(
        seen,
        F.count(F.lit(1)).alias("messages"),
        F.count_if(bad).alias("bad"),
        F.count_if(~bad & is_error_doc(*keys, empty_too=True)).alias("error_docs"),
    )
    made = frames(messages.good_clicks(watched))
    log_.write(spark, {**made, QUARANTINE: lambda: messages.quarantined_clicks(parsed) if seen.get["bad"] else None},
               batch_id, append.run_of(batch), offsets=streams.noted_offsets(batch))
    log.info("%s, batch %s: %s", job, batch_id, seen.get)
    if batch_id % FOLD_AT == FOLD_AT - 1:
        log_.fold(spark, keep=KEEP_OPEN)


# --- streams -----------------------------------------------------------
def resume_from(spark: SparkSession, tables: Tables, topic: str, job: str = "article") -> str:
    """Where a stream on a new checkpoint starts: behind what the committed batches of the job have read."""
    noted = stream_log(tables, job).offsets(spark)
    if not noted:
        return "earliest"
    rows = spark.createDataFrame(noted, _schema(OFFSETS))
    # offsets of a partition only grow, so they are their own order
    return offsets.resume_offsets(rows.withColumn("committed_at", F.col("until_offset")), topic)


def kafka_source(spark: SparkSession, tables: Tables, options: dict[str, str], job: str = "article") -> DataFrame:
    """Messages of the topic in ``options["subscribe"]``, resumed from the commits of a job where no checkpoint is."""
    start = resume_from(spark, tables, options["subscribe"], job)
    return messages.read_click_stream(spark, "kafka", options, starting_offsets=start)


def article_stream(source: DataFrame, tables: Tables, trigger: dict | None = None) -> StreamingQuery:
    """Messages to 5-minute article rows; bad messages go to ``quarantine``.

    The rows of a micro-batch are those of its own clicks.  A slice that several
    batches touch has several rows, which the hourly job adds up.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        _watched(batch, batch_id, "article", tables, ["host", "articleId"], lambda good: {
            "article_5min": articles.article_5min(messages.normalise_clicks(good), tables.zone)})

    return _start(source, write, tables.checkpoint("article"), trigger)


def tag_stream(source: DataFrame, tables: Tables, trigger: dict | None = None) -> StreamingQuery:
    """Messages to 5-minute tag rows, in long form."""
    def write(batch: DataFrame, batch_id: int) -> None:
        _watched(batch, batch_id, "tag", tables, ["host", "articleId"], lambda good: {
            "tag_5min": tags.tag_article_5min(messages.normalise_clicks(good), tables.zone)})

    return _start(source, write, tables.checkpoint("tag"), trigger)


def dashboard_stream(source: DataFrame, tables: Tables, outputs: list[int] | None = None,
                     trigger: dict | None = None) -> StreamingQuery:
    """Messages to the referer, response and location counters."""
    chosen = [dashboard.OUTPUTS[o] for o in outputs or list(dashboard.OUTPUTS)]

    def write(batch: DataFrame, batch_id: int) -> None:
        held = []

        def add(good: DataFrame) -> dict[str, DataFrame]:
            keyed = dashboard.dashboard_counts(messages.normalise_clicks(good), tables.zone).persist()
            held.append(keyed)
            return streams.counter_frames(keyed, chosen)

        keys = ["geoLocation", "host", "isIndia", "referer", "group", "articleId"]
        try:
            _watched(batch, batch_id, "dashboard", tables, keys, add)
        finally:
            for df in held:
                df.unpersist()

    return _start(source, write, tables.checkpoint("dashboard"), trigger)


def read_agents(spark: SparkSession, tables: Tables, before: int | None = None, run: str = "0") -> DataFrame:
    """The agent dimension, or what it was before a micro-batch."""
    return stream_log(tables, "device").read(spark, "agents", AGENT_DIM, before=before, run=run)


def read_devices(spark: SparkSession, tables: Tables) -> DataFrame:
    """The counter per host, device and browser."""
    return stream_log(tables, "device").read(spark, "host_device")


def read_quarantine(spark: SparkSession, tables: Tables, job: str) -> DataFrame:
    """Messages that a stream put aside."""
    return stream_log(tables, job).read(spark, QUARANTINE)


def device_stream(source: DataFrame, tables: Tables, trigger: dict | None = None) -> StreamingQuery:
    """Messages to rows per host and agent, device counters and new agents."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark, run, held = batch.sparkSession, append.run_of(batch), []

        def add(good: DataFrame) -> dict[str, DataFrame]:
            events = messages.normalise_agent_events(good)
            sums = devices.host_agent_sums(events, slice_start("hour", "ts", tz=tables.zone)).persist()
            agents = sums.where(F.col("agent_type").isNotNull()).select(F.col("agent_type").alias("user_agent")).distinct().persist()
            # only folders that may have some of these agents are opened; agents that none has are new
            dim, nowhere = stream_log(tables, "device").find(spark, "agents", agents, AGENT_DIM, batch_id, run)
            maybe = agents.exceptAll(nowhere)
            fresh = devices.describe_agents(nowhere.unionByName(maybe.join(dim.select("user_agent"), "user_agent", "left_anti")),
                                            "user_agent").persist()
            rows = devices.described_sums(devices.with_details(sums, dim.unionByName(fresh))).persist()
            held.extend((rows, fresh, agents, sums))
            return {"agents": fresh, "host_agent": rows, "host_device": devices.host_device_deltas(rows)}

        try:
            _watched(batch, batch_id, "device", tables, ["host", "agentType"], add)
        finally:
            for df in held:
                df.unpersist()

    return _start(source, write, tables.checkpoint("device"), trigger)


# --- batch jobs --------------------------------------------------------
def fold(spark: SparkSession, tables: Tables, everything: bool = False, keep: int = KEEP_OPEN) -> None:
    """Fold the open batches of all tables, to be run on a schedule, and remove what no record names any more.

    The newest of each run stay open: a stream may write its last one again, and
    days of the last week may be run again.
    """
    logs = [stream_log(tables, job) for job in ("article", "tag", "dashboard", "device")]
    batch = ("article_hourly", "article_daily", "tag_hourly", "tag_totals", "clicks_by_cat", "location_by_cat",
             "referer_by_cat", "response_by_cat")
    logs += [tables.log(name) for name in batch]
    for log_ in (*logs, trend_table(tables.path("article_month")).log, trend_table(tables.path("article_week")).log):
        log_.fold(spark, keep, everything)
        log_.vacuum(spark)


def hourly_articles(spark: SparkSession, tables: Tables, hour: datetime, count: int = 1) -> None:
    """5-minute rows of listed hosts, merged by hour: one hour, or ``count`` hours from it on in one job."""
    rows = tables.streamed(spark, "article", "article_5min", ARTICLES, hour, count)
    merged = articles.article_hourly(in_hosts(rows, tables.hosts), tz=tables.zone)
    tables.write(merged, "article_hourly", hour, timedelta(hours=count))


def hourly_tags(spark: SparkSession, tables: Tables, hour: datetime, count: int = 1) -> None:
    """5-minute tag rows merged by hour in long form, and the totals of the tags."""
    rows = tables.streamed(spark, "tag", "tag_5min", TAGS, hour, count)
    span = timedelta(hours=count)
    tables.write(tags.tag_article_hourly(rows, tables.zone), "tag_hourly", hour, span)
    tables.write(tags.tag_totals(tables.read(spark, "tag_hourly", TAGS, hour, span)), "tag_totals", hour, span)


def daily_articles(spark: SparkSession, tables: Tables, day: datetime, least: int = 1, count: int = 1) -> None:
    """Hourly rows merged by day, and added to the month and week trends: one day, or ``count`` days from it on.

    The days' numbers are the batch numbers of the trends, so days that are run
    again, as long as they were not folded, replace what they added; once folded it is an error.
    """
    span = timedelta(days=count)
    rows = tables.read(spark, "article_hourly", ARTICLES, day, span)
    merged = articles.article_daily(in_hosts(min_count(rows, least), tables.hosts), tz=tables.zone)
    tables.write(merged, "article_daily", day, span)
    written = tables.read(spark, "article_daily", ARTICLES, day, span)
    number = (day - datetime(1970, 1, 1)).days
    last = number + count - 1
    trend_table(tables.path("article_month")).upsert(
        articles.month_deltas(written, tables.hosts, tables.zone), number, last=last)
    trend_table(tables.path("article_week")).upsert(articles.week_deltas(written, tables.zone), number, last=last)


def streamed_days(spark: SparkSession, tables: Tables, job: str, name: str) -> tuple[datetime, int] | None:
    """First day (wall clock) and number of days that a table of a stream has rows of, from the commit records alone."""
    ends = stream_log(tables, job).span(spark, name)
    if ends is None:
        return None
    first, last = (e.replace(tzinfo=timezone.utc).astimezone(ZoneInfo(tables.tz)).date() for e in ends)
    return datetime(first.year, first.month, first.day), (last - first).days + 1


def article_chain(spark: SparkSession, tables: Tables) -> None:
    """The hourly and daily article jobs over every hour and day that the stream has written."""
    found = streamed_days(spark, tables, "article", "article_5min")
    if found:
        day, count = found
        hourly_articles(spark, tables, day, 24 * count)
        daily_articles(spark, tables, day, count=count)


def tag_chain(spark: SparkSession, tables: Tables) -> None:
    """The hourly tag job over every hour that the stream has written."""
    found = streamed_days(spark, tables, "tag", "tag_5min")
    if found:
        hourly_tags(spark, tables, found[0], 24 * found[1])


def read_counter(spark: SparkSession, tables: Tables, output: str, hour: datetime | None = None, count: int = 1) -> DataFrame:
    """A counter table, or ``count`` of its hours; messages carry the country flag as text."""
    start, end = (tables.utc(hour), tables.utc(hour + timedelta(hours=count))) if hour else (None, None)
    return streams.read_counter(spark, stream_log(tables, "dashboard"), output, start, end, "string")


def by_category(spark: SparkSession, tables: Tables, hour: datetime, count: int = 1) -> None:
    """The four category rollups of one hour or many, and the note that they ran.

    Rows of the counters carry the end of their hour.
    """
    starts, span = [hour + timedelta(hours=h) for h in range(count)], timedelta(hours=count)
    hourly = tables.read(spark, "article_hourly", ARTICLES, hour, span)
    tables.write(grouping.clicks_by_cat(hourly, tables.hosts), "clicks_by_cat", hour, span)
    for output, rollup in (("location", grouping.location_by_cat), ("referer", grouping.referer_by_cat),
                           ("response", grouping.response_by_cat)):
        rows = rollup(read_counter(spark, tables, output, hour, count))
        tables.write(rows, f"{output}_by_cat", hour, span, late=timedelta(hours=1))
    stamps = [(int(tables.utc(s).replace(tzinfo=timezone.utc).timestamp()),) for s in starts]
    ran = spark.createDataFrame(stamps, "exec_ts long").withColumn("job", F.lit("by_category"))
    ledgers.log_runs(ran, tables.path("runs"))


def category_chain(spark: SparkSession, tables: Tables) -> None:
    """The category rollups over every hour that the dashboard stream has counted."""
    found = streamed_days(spark, tables, "dashboard", "location")
    if found:
        # counters carry the end of their hour
        by_category(spark, tables, found[0] - timedelta(days=1), 24 * (found[1] + 1))
