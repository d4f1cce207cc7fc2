"""Streams over several micro-batches give what a batch over all rows gives."""

import os
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from clickroll.operators import articles, dashboard, joins, words
from clickroll.plans.article_queries import shown
from clickroll.plans.inputs import SCHEMAS, as_clicks, clicks, table
from clickroll.schemas import ARTICLE_KEYS
from clickroll.sinks import append
from clickroll.sources.clicks import read_click_stream
from clickroll.sources.text import file_lines, socket_lines
from clickroll.streaming import jobs, late


@pytest.fixture(scope="module")
def split_dir(spark, tmp_path_factory):
    """Four files in time order, as they would have come in."""
    folder = tmp_path_factory.mktemp("events")
    events = table(spark, "/root/testdata/sf0.001", "events")
    for quarter in range(4):
        part = events.where(F.floor((F.dayofmonth("ts") - 1) / 8) == quarter).coalesce(1)
        part.write.mode("append").parquet(str(folder))
    files = sorted(folder.glob("*.parquet"), key=lambda f: f.stat().st_mtime_ns)
    for age, f in enumerate(files):
        os.utime(f, (time.time() - 1000 + age * 10,) * 2)
    assert len(files) == 4
    return str(folder)


def stream(spark, folder):
    reader = spark.readStream.schema(SCHEMAS["events"]).option("maxFilesPerTrigger", 1)
    return as_clicks(reader.parquet(folder))


def same(left, right):
    columns = sorted(left.columns)
    assert columns == sorted(right.columns)
    a, b = left.select(columns), right.select(columns)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_article_stream_equals_batch(spark, sf, split_dir, tmp_path):
    rows = jobs.article_5min_stream(stream(spark, split_dir))
    query = jobs.latest_stream(rows, f"{tmp_path}/t", f"{tmp_path}/c", ["slice", *ARTICLE_KEYS])
    query.awaitTermination()
    assert len(query.recentProgress) >= 4
    got = jobs.read_latest(spark, f"{tmp_path}/t", ["slice", *ARTICLE_KEYS], rows.schema)
    same(shown(got), shown(articles.article_5min(clicks(spark, sf))))


def test_stateless_article_stream_adds_up(spark, sf, split_dir, tmp_path):
    schema = articles.article_5min(clicks(spark, sf)).schema
    append.append_stream(stream(spark, split_dir), f"{tmp_path}/t", f"{tmp_path}/c", articles.article_5min).awaitTermination()
    log = append.read_appended(spark, f"{tmp_path}/t", schema)
    noted = append.append_log(f"{tmp_path}/t").state(spark).batches
    assert [b["first"] for b in noted] == [0, 1, 2, 3] and len({b["run"] for b in noted}) == 1
    same(shown(articles.article_hourly(log)),
         shown(articles.article_hourly(articles.article_5min(clicks(spark, sf)))))


def test_windowed_words_equal_batch(spark, sf, split_dir, tmp_path):
    def timed(source):
        return words.split_words(source.select("ts", F.concat_ws(" ", "host", "cat").alias("line")))

    for length, step in (("10 seconds", None), ("30 seconds", "10 seconds")):
        out = f"{tmp_path}/{length[:2]}"
        rows = jobs.windowed_word_count(timed(stream(spark, split_dir)), "ts", length, step)
        jobs.latest_stream(rows, f"{out}/t", f"{out}/c", ["slice", "word"]).awaitTermination()
        got = jobs.read_latest(spark, f"{out}/t", ["slice", "word"], rows.schema)
        same(got, jobs.windowed_word_count(timed(clicks(spark, sf)), "ts", length, step))


KEYS = ["slice", "word"]


def run_corrected(spark, folder, out, length, step=None, fold_at=32):
    timed = words.split_words(stream(spark, folder).select("ts", F.concat_ws(" ", "host", "cat").alias("line")))
    changes = late.corrected_word_count(timed, "ts", length, step)
    run = late.corrected_stream(changes, f"{out}/t", f"{out}/c", KEYS, partitions=2, fold_at=fold_at)
    run.awaitTermination()
    return run, late.read_corrected(spark, f"{out}/t", KEYS, changes.schema)


@pytest.mark.parametrize("length,step", [("1 hour", None), ("2 hours", "1 hour")])
def test_late_rows_are_corrections(spark, sf, tmp_path, length, step):
    """Files with the newest clicks first: state and corrections together are the batch."""
    events = table(spark, sf, "events")
    for quarter in (3, 1, 0, 2):
        part = events.where(F.floor((F.dayofmonth("ts") - 1) / 8) == quarter).coalesce(1)
        part.write.mode("append").parquet(f"{tmp_path}/in")
    files = sorted((tmp_path / "in").glob("*.parquet"), key=lambda f: f.stat().st_mtime_ns)
    for age, f in enumerate(files):
        os.utime(f, (time.time() - 1000 + age * 10,) * 2)
    query, got = run_corrected(spark, f"{tmp_path}/in", tmp_path, length, step, fold_at=2)
    timed = words.split_words(clicks(spark, sf).select("ts", F.concat_ws(" ", "host", "cat").alias("line")))
    want = jobs.windowed_word_count(timed, "ts", length, step)
    same(got.drop("late"), want)
    # what came in the first file is not late, all that is a day older is
    assert got.where("slice >= '2024-01-26' AND late > 0").isEmpty()
    older = got.where("slice < '2024-01-24'")
    assert older.where("late <> count").isEmpty() and not older.isEmpty()
    # the timers have freed the windows behind the watermark
    left = query.recentProgress[-1].stateOperators[0].numRowsTotal
    assert left < want.count() / 4
    assert query.lastProgress.stateOperators[0].numRowsDroppedByWatermark == 0


def test_corrections_after_a_restart_and_of_a_repeated_batch(spark, tmp_path):
    def click(name, *rows):
        frame = spark.createDataFrame([(datetime.fromisoformat(t), w) for t, w in rows], "ts timestamp, word string")
        frame.coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}")

    def run():
        source = spark.readStream.schema("ts timestamp, word string").parquet(f"{tmp_path}/in")
        changes = late.corrected_word_count(source, "ts", "10 seconds", delay="0 seconds")
        late.corrected_stream(changes, f"{tmp_path}/t", f"{tmp_path}/c", KEYS, partitions=2).awaitTermination()
        rows = late.read_corrected(spark, f"{tmp_path}/t", KEYS, changes.schema).collect()
        return {(f"{r.slice:%M:%S}", r.word): (r["count"], r.late) for r in rows}

    click("in", ("2024-01-01 00:00:01", "a"), ("2024-01-01 00:00:02", "a"), ("2024-01-01 00:01:00", "b"))
    assert run() == {("00:00", "a"): (2, 0), ("01:00", "b"): (1, 0)}
    # the watermark is kept by the checkpoint: a is late, b is not
    click("in", ("2024-01-01 00:00:03", "a"), ("2024-01-01 00:00:03", "c"), ("2024-01-01 00:01:09", "b"), ("2024-01-01 00:01:09", None))
    want = {("00:00", "a"): (3, 1), ("00:00", "c"): (1, 1), ("01:00", "b"): (2, 0)}
    assert run() == want == run()
    # a batch that is written again replaces its versions and its corrections
    log = late.corrected_log(f"{tmp_path}/t", KEYS)
    last = [b for b in log.state(spark).batches if b["tables"]["rows"]["hi"] is None][-1]
    again = spark.createDataFrame([(datetime(2024, 1, 1), "a", None, 5)], "slice timestamp, word string, count bigint, late bigint")
    log.write(spark, {"rows": again}, 500, last["run"])
    log.write(spark, {"rows": again}, 500, last["run"])
    rows = {r.word: (r["count"], r.late) for r in log.read(spark, "rows").collect()}
    assert rows["a"] == (8, 6)
    assert log.fold(spark) >= 2
    assert {r.word: (r["count"], r.late) for r in log.read(spark, "rows").collect()} == rows


def lines_in(tmp_path, name, text):
    (tmp_path / "in").mkdir(exist_ok=True)
    (tmp_path / "in" / name).write_text(text)


def test_running_count_starts_from_the_seed(spark, tmp_path):
    seed = spark.createDataFrame([("hello", 1), ("world", 1)], "word string, count bigint")

    def run():
        said = words.split_words(file_lines(spark, f"{tmp_path}/in"))
        jobs.running_count_stream(said, seed, f"{tmp_path}/t", f"{tmp_path}/c").awaitTermination()
        return {r.word: r["count"] for r in jobs.read_latest(spark, f"{tmp_path}/t", ["word"], seed.schema).collect()}

    lines_in(tmp_path, "a.txt", "hello there hello\n")
    # a seed word that never came is there
    assert run() == {"hello": 3, "there": 1, "world": 1}
    # started again from the checkpoint: state goes on, old lines are not read twice
    lines_in(tmp_path, "b.txt", "world there\n")
    assert run() == {"hello": 3, "there": 2, "world": 2}
    log = jobs.latest_log(f"{tmp_path}/t", ["word"])
    # the seed is a version of its own, and the state goes on from it: nothing is added on reading
    assert {r.word: r["count"] for r in log.read_run(spark, "rows", jobs.SEED, seed.schema).collect()} == {"hello": 1, "world": 1}
    assert [b["run"] == jobs.SEED for b in log.state(spark).batches].count(True) == 1
    assert log.fold(spark) == 3 and run() == {"hello": 3, "there": 2, "world": 2}


def test_running_count_takes_each_word_once_and_no_python(spark, tmp_path):
    seed = spark.createDataFrame([("a", 2), ("a", 3), ("z", 1), (None, 4)], "word string, count bigint")

    def run():
        said = words.split_words(file_lines(spark, f"{tmp_path}/in"))
        query = jobs.running_count_stream(said, seed, f"{tmp_path}/t", f"{tmp_path}/c", partitions=2)
        query.awaitTermination()
        return query, {r.word: r["count"] for r in jobs.read_latest(spark, f"{tmp_path}/t", ["word"], seed.schema).collect()}

    lines_in(tmp_path, "a.txt", "a b\n" * 5000)
    query, got = run()
    assert got == {"a": 5005, "b": 5000, "z": 1, None: 4}
    (held,) = query.lastProgress["stateOperators"]
    assert held["operatorName"] == "stateStoreSave" and held["numRowsTotal"] == 4
    # folded and cleaned, the stream still goes on from its seed, which counts once
    log = jobs.latest_log(f"{tmp_path}/t", ["word"])
    log.fold(spark)
    log.vacuum(spark, age=-60)
    lines_in(tmp_path, "b.txt", "z c\n")
    assert run()[1] == {"a": 5005, "b": 5000, "z": 2, "c": 1, None: 4}


def test_restart_equals_one_run(spark, tmp_path):
    def run():
        counts = words.word_count(words.split_words(file_lines(spark, f"{tmp_path}/in")))
        jobs.latest_stream(counts, f"{tmp_path}/t", f"{tmp_path}/c", ["word"]).awaitTermination()
        rows = jobs.read_latest(spark, f"{tmp_path}/t", ["word"], counts.schema)
        return {r.word: r["count"] for r in rows.collect()}

    lines_in(tmp_path, "a.txt", "a b a\n")
    assert run() == {"a": 2, "b": 1}
    assert run() == {"a": 2, "b": 1}
    lines_in(tmp_path, "b.txt", "b c\n")
    assert run() == {"a": 2, "b": 2, "c": 1}


def test_dashboard_fan_out_equals_batch(spark, sf, split_dir, tmp_path):
    jobs.dashboard_stream(stream(spark, split_dir), f"{tmp_path}/t", f"{tmp_path}/c", [1, 3]).awaitTermination()
    keyed = dashboard.dashboard_keys(clicks(spark, sf))
    same(jobs.read_counter(spark, jobs.counter_log(f"{tmp_path}/t"), "referer"), dashboard.referer_counts(keyed).drop("first_ts"))
    same(jobs.read_counter(spark, jobs.counter_log(f"{tmp_path}/t"), "location"), dashboard.location_counts(keyed).drop("first_ts"))
    assert not (tmp_path / "t" / "data" / "response").exists()


def test_a_new_checkpoint_adds_to_the_table(spark, sf, split_dir, tmp_path):
    """The same stream again, on another checkpoint: its batches do not replace those of the first."""
    for c in ("c1", "c2", "c2"):
        append.append_stream(stream(spark, split_dir).select("event_id"), f"{tmp_path}/t", f"{tmp_path}/{c}").awaitTermination()
    assert append.read_appended(spark, f"{tmp_path}/t", clicks(spark, sf).select("event_id").schema).count() == 2000


def test_tables_of_one_file_and_of_many(spark, sf, tmp_path):
    from clickroll.plans.inputs import event_stream

    table(spark, sf, "events").repartition(4).write.parquet(f"{tmp_path}/events.parquet")
    for n, folder in enumerate((sf, str(tmp_path))):
        rows = event_stream(spark, folder).select("event_id")
        append.append_stream(rows, f"{tmp_path}/t{n}", f"{tmp_path}/c{n}").awaitTermination()
        assert append.read_appended(spark, f"{tmp_path}/t{n}", rows.schema).count() == 1000


@pytest.mark.parametrize("kind", ["windowed", "same"])
def test_stream_joins_equal_batch(spark, sf, split_dir, tmp_path, kind):
    # some keys dealt, the others not
    hot = [r.article_id for r in clicks(spark, sf).select("article_id").distinct().orderBy("article_id").limit(40).collect()]

    def pairs(source):
        left, right = (source().where(F.col("host") == h) for h in ("click", "view"))
        if kind == "windowed":
            out = joins.join_windowed(left, right, "article_id", "ts", "event_id", 1200, 3600, "10 days", hot)
        else:
            out = joins.join_same_batch(left, right, "article_id", "ts", "event_id", 7200, "10 days", hot)
        return out.select("key", "left_value", "right_value")

    live = pairs(lambda: stream(spark, split_dir))
    append.append_stream(live, f"{tmp_path}/t", f"{tmp_path}/c").awaitTermination()
    got = append.read_appended(spark, f"{tmp_path}/t", live.schema)
    want = pairs(lambda: clicks(spark, sf))
    assert want.count() > 0
    same(got, want)


def test_join_state_is_dropped_behind_the_watermark(spark, split_dir, tmp_path):
    left, right = (stream(spark, split_dir).where(F.col("host") == h) for h in ("click", "view"))
    live = joins.join_windowed(left, right, "article_id", "ts", "event_id")
    query = append.append_stream(live, f"{tmp_path}/t", f"{tmp_path}/c")
    query.awaitTermination()
    kept = query.lastProgress["stateOperators"][0]["numRowsTotal"]
    assert kept < 100  # of about 400 rows of both sides, none copied


def test_console_and_triggers(spark, split_dir, tmp_path):
    query = append.console(stream(spark, split_dir).select("event_id"), 5, f"{tmp_path}/c")
    query.awaitTermination()
    assert sum(p["numInputRows"] for p in query.recentProgress) == 1000
    assert "Console" in query.lastProgress["sink"]["description"]
    assert jobs.trigger_for(None) == {"availableNow": True}
    assert jobs.trigger_for("MINUTE") == {"processingTime": "20 seconds"}


def test_sources_take_their_options(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text('{"articleId":"1"}\n')
    messages = read_click_stream(spark, "text", {"path": f"{tmp_path}/in"})
    assert messages.isStreaming and messages.columns == ["value", "timestamp"]
    assert socket_lines.__doc__  # opening one needs a port; not run here
