"""Streams, stream joins and sinks, each run until its input is used up."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickroll.operators import articles, dashboard, devices, joins, words
from clickroll.plans.article_queries import (
    DAY, HOUR, MIN5, KEPT_DAYS, MONTH, _TEXT_WORDS, daily_rows, duck_articles, shown, trend_table,
)
from clickroll.plans.counter_queries import _DUCK_DETAIL, _duck_facts, duck_counter
from clickroll.plans.inputs import (
    DUCK_RAW, agent_dim, as_clicks, click_stream, clicks, duck, event_stream, hosts,
    message_folder, table, with_user_group,
)
from clickroll.plans.registry import query
from clickroll.schemas import ARTICLE_KEYS, OFFSET_RANGE, epoch_seconds
from clickroll.session import state_partitions, stored, work_dir
from clickroll.sinks import append, ledgers
from clickroll.sinks.commits import CommitLog
from clickroll.sinks.upserts import UpsertTable
from clickroll.sources import clicks as messages
from clickroll.sources.text import file_lines, text_column_lines
from clickroll.streaming import jobs, late


def _epoch(rows: DataFrame) -> DataFrame:
    return rows.withColumn("slice", epoch_seconds("slice"))


def _state(spark) -> int:
    """State partitions of the streams here: one per core."""
    return spark.sparkContext.defaultParallelism


def run_appended(stream: DataFrame, label: str, transform=None, schema=None) -> DataFrame:
    """Append a stream to a table until its input is used up; the table."""
    spark = stream.sparkSession
    base = work_dir(spark, label)
    with state_partitions(spark, _state(spark)):
        query_ = append.append_stream(stream, f"{base}/table", f"{base}/checkpoint", transform)
    query_.awaitTermination()
    return append.read_appended(spark, f"{base}/table", schema or stream.schema)


def run_latest(rows: DataFrame, label: str, keys: list[str]) -> DataFrame:
    """Run a stateful stream to its end; the last version of each row."""
    spark = rows.sparkSession
    base = work_dir(spark, label)
    jobs.latest_stream(rows, f"{base}/table", f"{base}/checkpoint", keys, partitions=_state(spark)).awaitTermination()
    return jobs.read_latest(spark, f"{base}/table", keys, rows.schema)


# --- sources -----------------------------------------------------------
@query("src_click_stream", duck('SELECT event_id, epoch_s, "articleId" AS article_id, host, cat, url FROM raw', DUCK_RAW))
def src_click_stream(spark, sf_dir):
    source = messages.read_click_stream(
        spark, "parquet", {"path": message_folder(spark, sf_dir)}, "value string"
    )
    rows = messages.normalise_clicks(messages.good_clicks(messages.parse_clicks(source)))
    picked = rows.select(
        "event_id", epoch_seconds("ts").alias("epoch_s"), "article_id", "host", "cat", "url"
    )
    return run_appended(picked, "click-stream")


@query("src_text_lines", "SELECT unnest(string_split(text, chr(10))) AS line FROM documents")
def src_text_lines(spark, sf_dir):
    folder = work_dir(spark, "text")
    table(spark, sf_dir, "documents").select("text").write.option("lineSep", "\n").text(folder)
    return run_appended(file_lines(spark, folder, lineSep="\n"), "text-lines")


# --- streams -----------------------------------------------------------
@query("stream_article_5min", duck(duck_articles(MIN5)))
def stream_article_5min(spark, sf_dir):
    rows = jobs.article_5min_stream(click_stream(spark, sf_dir))
    return shown(run_latest(rows, "article-stream", ["slice", *ARTICLE_KEYS]))


_TIMED_WORDS = """words AS (SELECT epoch_s, unnest([host, cat, host]) AS word FROM clicks)"""


def _timed_words(source: DataFrame) -> DataFrame:
    lines = source.select("ts", F.concat_ws(" ", "host", "cat", "host").alias("line"))
    return words.split_words(lines)


@query(
    "stream_windowed_count",
    duck('SELECT epoch_s - epoch_s % 10 AS slice, word, count(*) AS "count" FROM words GROUP BY 1, 2', _TIMED_WORDS),
)
def stream_windowed_count(spark, sf_dir):
    rows = jobs.windowed_word_count(_timed_words(click_stream(spark, sf_dir)), "ts", "10 seconds")
    return _epoch(run_latest(rows, "tumbling", ["slice", "word"]))


@query(
    "stream_sliding_count",
    duck("""SELECT slice, word, count(*) AS "count" FROM (SELECT unnest([epoch_s - epoch_s % 10 - 20,
epoch_s - epoch_s % 10 - 10, epoch_s - epoch_s % 10]) AS slice, word FROM words) GROUP BY 1, 2""", _TIMED_WORDS),
)
def stream_sliding_count(spark, sf_dir):
    source = _timed_words(click_stream(spark, sf_dir))
    rows = jobs.windowed_word_count(source, "ts", "30 seconds", "10 seconds")
    return _epoch(run_latest(rows, "sliding", ["slice", "word"]))


@query(
    "stream_late_count",
    duck('SELECT epoch_s - epoch_s % 3600 AS slice, word, count(*) AS "count" FROM words GROUP BY 1, 2', _TIMED_WORDS),
)
def stream_late_count(spark, sf_dir):
    # all files hold all times: what comes after the first batch is late but for the last window
    base = work_dir(spark, "late")
    events = table(spark, sf_dir, "events")
    events.repartition(8, "event_id").write.parquet(f"{base}/in")
    source = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(f"{base}/in")
    changes = late.corrected_word_count(_timed_words(as_clicks(source)), "ts", "1 hour")
    keys = ["slice", "word"]
    late.corrected_stream(changes, f"{base}/table", f"{base}/checkpoint", keys, partitions=_state(spark)).awaitTermination()
    return _epoch(late.read_corrected(spark, f"{base}/table", keys, changes.schema).drop("late"))


@query(
    "stream_running_count",
    rf"""WITH {_TEXT_WORDS}, seed AS (SELECT word, count(*) AS n FROM (SELECT unnest(regexp_split_to_array(text,
'[ \t\n\x0B\f\r]+')) AS word FROM conversations) WHERE word <> '' GROUP BY 1),
counted AS (SELECT word, count(*) AS n FROM words WHERE word <> '' GROUP BY 1)
SELECT word, coalesce(c.n, 0) + coalesce(s.n, 0) AS "count" FROM counted c FULL JOIN seed s USING (word)""",
)
def stream_running_count(spark, sf_dir):
    lines = text_column_lines(event_stream(spark, sf_dir, "documents"), "text")
    said = table(spark, sf_dir, "conversations").select(F.col("text").alias("line"))
    seed = words.word_count(words.split_words(said))
    base = work_dir(spark, "running")
    jobs.running_count_stream(
        words.split_words(lines), seed, f"{base}/table", f"{base}/checkpoint", partitions=_state(spark)
    ).awaitTermination()
    return jobs.read_latest(spark, f"{base}/table", ["word"], seed.schema)


@query("stream_restart", duck('SELECT host, count(*) AS "count" FROM clicks GROUP BY 1'))
def stream_restart(spark, sf_dir):
    # two runs from one checkpoint: the second finds the first one's state and
    # only the file that came in between
    base = work_dir(spark, "restart")
    events = table(spark, sf_dir, "events")
    for part in (0, 1):
        events.where(F.col("event_id") % 2 == part).write.mode("append").parquet(f"{base}/in")
        stream = as_clicks(spark.readStream.schema(events.schema).parquet(f"{base}/in"))
        counts = stream.groupBy("host").agg(F.count(F.lit(1)).alias("count"))
        jobs.latest_stream(counts, f"{base}/table", f"{base}/checkpoint", ["host"], partitions=_state(spark)).awaitTermination()
    return jobs.read_latest(spark, f"{base}/table", ["host"], counts.schema)


# --- joins -------------------------------------------------------------
def _sides(source) -> tuple[DataFrame, DataFrame]:
    left = source().where(F.col("host") == "click").withColumnRenamed("event_id", "id")
    right = source().where(F.col("host") == "view").withColumnRenamed("event_id", "id")
    return left, right


_PAIRS = """SELECT a.article_id AS "key", a.event_id AS left_value, b.event_id AS right_value
FROM clicks a JOIN clicks b ON a.article_id = b.article_id AND a.host = 'click' AND b.host = 'view' """


def _pairs(joined: DataFrame, label: str) -> DataFrame:
    pairs = joined.select("key", "left_value", "right_value")
    return run_appended(pairs, label)


@query("join_streams_batch", duck(_PAIRS + "AND a.epoch_s // 3600 = b.epoch_s // 3600"))
def join_streams_batch(spark, sf_dir):
    left, right = _sides(lambda: click_stream(spark, sf_dir))
    hot = joins.heavy_keys(clicks(spark, sf_dir), "article_id")
    pairs = joins.join_same_batch(left, right, "article_id", "ts", "id", 3600, hot=hot)
    return _pairs(pairs, "join-batch")


_NEAR = "AND b.ts > a.ts - INTERVAL 60 MINUTE AND b.ts < a.ts + INTERVAL 20 MINUTE"


@query("join_streams_windowed", duck(_PAIRS + _NEAR))
def join_streams_windowed(spark, sf_dir):
    left, right = _sides(lambda: click_stream(spark, sf_dir))
    hot = joins.heavy_keys(clicks(spark, sf_dir), "article_id")
    pairs = joins.join_windowed(left, right, "article_id", "ts", "id", 1200, 3600, hot=hot)
    return _pairs(pairs, "join-windowed")


@query("join_tables_windowed", duck(_PAIRS + _NEAR))
def join_tables_windowed(spark, sf_dir):
    left, right = _sides(lambda: clicks(spark, sf_dir))
    pairs = joins.join_windowed(left, right, "article_id", "ts", "id", 1200, 3600)
    return pairs.select("key", "left_value", "right_value")


@query(
    "join_stream_static",
    duck("SELECT event_id, article_id, c_name FROM clicks JOIN customer ON c_custkey = CAST(article_id AS BIGINT)"),
)
def join_stream_static(spark, sf_dir):
    fixed = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("article_id"), "c_name"
    )
    rows = click_stream(spark, sf_dir).select("event_id", "article_id")
    return run_appended(joins.join_static(rows, fixed, "article_id").select("event_id", "article_id", "c_name"), "join-static")


# --- sinks -------------------------------------------------------------
@query("sink_append_stream", duck(duck_articles(MIN5)))
def sink_append_stream(spark, sf_dir):
    # every micro-batch appends its own 5-minute rows; here there is one
    schema = articles.article_5min(clicks(spark, sf_dir)).schema
    rows = run_appended(click_stream(spark, sf_dir), "append", articles.article_5min, schema)
    return shown(rows)


@query("sink_append_batch", duck(f"SELECT *, strftime(make_timestamp(slice * 1000000), '%Y%m%d') AS dt FROM ({duck_articles(DAY)})"))
def sink_append_batch(spark, sf_dir):
    path = work_dir(spark, "daily")
    daily = stored(daily_rows(spark, sf_dir), "daily-rows")
    append.write_partitions(daily, path)
    # two days are run again, the first time with no rows: that empties them
    for day in (2, 3):
        rows = daily.where(F.dayofmonth("slice") == day)
        for again in (rows.limit(0), rows):
            append.write_slice(again, path, datetime(2024, 1, day))
    rows = spark.read.schema(T.StructType([*daily.schema.fields, T.StructField("dt", T.StringType())])).parquet(path)
    return shown(rows)


def _four_batches(spark, target: UpsertTable, deltas) -> DataFrame:
    # one run writes batches 1 and 3, 3 twice, and both are folded; then come an older one, and
    # another run that counts from 1 again
    for batch in (1, 3, 3):
        target.upsert(deltas(batch), batch, "a")
    target.compact(spark)
    target.upsert(deltas(0), 0, "a")
    target.upsert(deltas(2), 1, "b")
    return target.read(spark)


@query(
    "sink_upsert_counter",
    duck("""SELECT article_id, host, count(*) AS "count", arg_min({'u': url, 'c': cat}, (ts, event_id)).c AS cat
FROM clicks GROUP BY 1, 2"""),
)
def sink_upsert_counter(spark, sf_dir):
    source = clicks(spark, sf_dir)
    target = UpsertTable(work_dir(spark, "counter"), ["article_id", "host"], ["count"], ["cat"], order="first_ts")

    def deltas(batch: int) -> DataFrame:
        part = source.where(F.col("event_id") % 4 == batch)
        fine = part.groupBy("article_id", "host", "cat").agg(
            F.count(F.lit(1)).alias("count"), F.min("ts").alias("first_ts")
        )
        return fine

    return _four_batches(spark, target, deltas)


@query("sink_upsert_set", duck(duck_articles(MONTH, "kept"), KEPT_DAYS))
def sink_upsert_set(spark, sf_dir):
    daily = stored(daily_rows(spark, sf_dir), "daily-rows")
    big = hosts(spark, sf_dir)
    target = trend_table(work_dir(spark, "set"))
    return shown(_four_batches(
        spark, target,
        lambda batch: articles.month_deltas(daily.where(F.dayofmonth("slice") % 4 == batch), big),
    ))


@query(
    "sink_offset_ledger",
    """SELECT topic, "partition", from_offset, until_offset,
concat_ws(' ', topic, "partition", from_offset, until_offset) AS description FROM (
SELECT event_type AS topic, CAST(event_id % 4 AS INT) AS "partition", min(event_id) AS from_offset,
max(event_id) + 1 AS until_offset FROM events GROUP BY 1, 2)""",
)
def sink_offset_ledger(spark, sf_dir):
    base = work_dir(spark, "offsets")
    source = event_stream(spark, sf_dir).select(
        F.col("event_type").alias("topic"), (F.col("event_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
    )
    jobs.offset_stream(source, f"{base}/table", f"{base}/checkpoint").awaitTermination()
    noted = CommitLog(f"{base}/table", {}).offsets(spark)
    names = ("topic", "partition", "from_offset", "until_offset", "description")
    return spark.createDataFrame(noted, OFFSET_RANGE).select(*names)


@query(
    "sink_new_agents",
    duck("""SELECT user_agent, browser_name, device_category FROM detail WHERE user_agent IN (SELECT agent_text FROM clicks)""",
         _duck_facts(), _DUCK_DETAIL),
)
def sink_new_agents(spark, sf_dir):
    source = with_user_group(clicks(spark, sf_dir))
    target = UpsertTable(work_dir(spark, "agents"), ["user_agent"], [], ["detail"])
    target.upsert(agent_dim(source), 0)
    for batch in (1, 2, 2):
        seen = source.where(F.col("event_id") % 2 == batch % 2).select("agent_text")
        known = target.read(spark, before=batch)
        target.upsert(devices.new_agents(seen, known, "agent_text"), batch)
    return target.read(spark).select("user_agent", "detail.browser_name", "detail.device_category")


@query("sink_run_ledger", duck(f"SELECT DISTINCT 'by-cat' AS job, {HOUR} AS exec_ts FROM clicks"))
def sink_run_ledger(spark, sf_dir):
    path = work_dir(spark, "runs")
    hours = clicks(spark, sf_dir).select(
        F.lit("by-cat").alias("job"), epoch_seconds(F.date_trunc("hour", "ts")).alias("exec_ts")
    ).distinct()
    ledgers.log_runs(hours, path)
    ledgers.log_runs(hours, path)
    return ledgers.runs(spark.read.parquet(path))


def _fan_sql(output: str, key: str) -> str:
    return f"""SELECT '{output}' AS output, slice, article_id, host, {key} AS "key", "count", tot_tm, cat
FROM ({duck_counter(output)})"""


@query(
    "sink_fan_out",
    duck(" UNION ALL ".join([
        _fan_sql("referer", "referer"), _fan_sql("response", "grp"),
        _fan_sql("location", "concat_ws('/', is_india, location)"),
    ])),
)
def sink_fan_out(spark, sf_dir):
    base = work_dir(spark, "fan-out")
    stream = jobs.dashboard_stream(
        click_stream(spark, sf_dir), base, f"{base}/checkpoint", list(dashboard.OUTPUTS)
    )
    stream.awaitTermination()
    keys = {"referer": F.col("referer"), "response": F.col("grp"),
            "location": F.concat_ws("/", F.col("is_india").cast("string"), "location")}
    out, log = None, jobs.counter_log(base)
    for output, key in keys.items():
        rows = jobs.read_counter(spark, log, output).select(
            F.lit(output).alias("output"), epoch_seconds("slice").alias("slice"), "article_id", "host",
            key.alias("key"), "count", "tot_tm", "cat",
        )
        out = rows if out is None else out.unionByName(rows)
    return out


@query("sink_console", duck("SELECT event_id, host, article_id FROM clicks ORDER BY event_id LIMIT 20"))
def sink_console(spark, sf_dir):
    rows = clicks(spark, sf_dir).select("event_id", "host", "article_id").orderBy("event_id").limit(20)
    rows.write.format("console").option("numRows", 20).mode("append").save()
    return rows
