"""Commit records: retries, crashes, pruning, folding, and jobs that own their time."""

import math
import random
from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickroll.plans import jobs
from clickroll.sinks import commits, files
from clickroll.sinks.append import ROWS, append_log
from clickroll.sinks.commits import CommitLog, Kind
from clickroll.sinks.intervals import added, meets
from clickroll.sinks.upserts import UpsertTable
from clickroll.sources import clicks as messages

HOUR = datetime(2024, 1, 2, 3)
SCHEMA = "slice timestamp, n bigint"


def rows(spark, *pairs):
    return spark.createDataFrame([(HOUR + timedelta(hours=h), n) for h, n in pairs], SCHEMA)


def held(log, spark, **options):
    got = log.read(spark, ROWS, rows(spark, (0, 0)).schema, **options)
    return sorted(((r.slice - HOUR) // timedelta(hours=1), r.n) for r in got.collect())


@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 9))), st.integers(0, 70), st.integers(0, 9))
@settings(max_examples=200, deadline=None)
def test_ranges_are_sets(pairs, first, more):
    ranges, want = [], set()
    for a, n in pairs:
        ranges = added(ranges, a, a + n)
        want |= set(range(a, a + n + 1))
    assert {x for a, b in ranges for x in range(a, b + 1)} == want
    assert all(b + 1 < c for (_, b), (c, _) in zip(ranges, ranges[1:]))
    assert meets(ranges, first, first + more) == bool(want & set(range(first, first + more + 1)))


def test_a_retry_with_fewer_hours_or_none_replaces_all(spark, tmp_path):
    log = append_log(f"{tmp_path}/t", "slice")
    log.write(spark, {ROWS: rows(spark, (1, 1), (2, 2))}, 7)
    log.write(spark, {ROWS: rows(spark, (5, 5))}, 8)
    log.write(spark, {ROWS: rows(spark, (1, 10))}, 7)
    assert held(log, spark) == [(1, 10), (5, 5)]
    log.write(spark, {ROWS: rows(spark, (1, 1)).limit(0)}, 7)
    assert held(log, spark) == [(5, 5)]
    log.fold(spark)
    assert held(log, spark) == [(5, 5)]
    with pytest.raises(ValueError):
        log.write(spark, {ROWS: rows(spark, (1, 1))}, 7)
    with pytest.raises(ValueError):
        append_log(f"{tmp_path}/u").read(spark, ROWS)


def test_one_folder_a_batch_and_only_those_of_the_hour_are_opened(spark, tmp_path):
    log = append_log(f"{tmp_path}/t", "slice")
    for batch in range(6):
        log.write(spark, {ROWS: rows(spark, *[(batch * 10 + h, h) for h in range(10)])}, batch)
    assert len(files.names(spark, f"{tmp_path}/t/data/{ROWS}")) == 6
    start = HOUR + timedelta(hours=23)
    got = log.read(spark, ROWS, None, start, start + timedelta(hours=1))
    assert [r.n for r in got.collect()] == [3]
    assert {f.split("/b-")[1][0] for f in got.inputFiles()} == {"2"}
    assert "PushedFilters: [IsNotNull(slice), GreaterThanOrEqual" in got._jdf.queryExecution().toString()
    assert log.span(spark, ROWS) == (HOUR, HOUR + timedelta(hours=59))
    # folded, the segment is sorted by slice and still pruned as a whole
    log.fold(spark)
    later = HOUR + timedelta(days=9)
    assert not log.read(spark, ROWS, rows(spark, (0, 0)).schema, later, later + timedelta(hours=1)).inputFiles()
    assert len(held(log, spark)) == 60


def test_listing_and_state_do_not_grow_with_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(commits, "FANOUT", 3)
    table = UpsertTable(f"{tmp_path}/t", ["k"], ["count"])
    written = []
    store = CommitLog._store
    monkeypatch.setattr(CommitLog, "_store", lambda self, df, name, folder: (
        written.append(folder), store(self, df, name, folder))[1])
    for batch in range(50):
        table.upsert(spark.createDataFrame([("a", 1), (f"k{batch}", 1)], "k string, count bigint"), batch)
        if batch % 4 == 3:
            table.compact(spark, keep=1)
            # records of folded batches are gone: what is listed is bounded
            assert len(files.names(spark, f"{table.path}/log")) <= 7
    state = table.log.state(spark)
    assert state.ranges == {"0": [[0, 46]]} and len(state.batches) == 3
    levels = [p.level for p in state.segments["rows"]]
    assert len(levels) <= 2 * math.log(50, 3) and max(levels) >= 2
    assert sum(f.startswith("s-") for f in written) == 12
    got = {r.k: r["count"] for r in table.read(spark).collect()}
    assert got["a"] == 50 and len(got) == 51
    assert table.log.vacuum(spark, age=-1) > 40
    assert {r.k: r["count"] for r in table.read(spark).collect()} == got


def test_batches_of_a_range_are_one(spark, tmp_path):
    log = append_log(f"{tmp_path}/t", "slice")
    log.write(spark, {ROWS: rows(spark, (1, 1))}, 10, last=12)
    log.write(spark, {ROWS: rows(spark, (2, 2))}, 10, last=12)
    assert held(log, spark) == [(2, 2)]
    for first, last in ((12, 12), (8, 10), (9, 20), (11, 11)):
        with pytest.raises(ValueError):
            log.write(spark, {ROWS: rows(spark, (3, 3))}, first, last=last)
    log.write(spark, {ROWS: rows(spark, (3, 3))}, 13)
    log.fold(spark)
    assert log.state(spark).ranges == {"0": [[10, 13]]}


def test_jobs_own_their_time(spark, tmp_path):
    log = CommitLog(f"{tmp_path}/t", {ROWS: Kind("slice")}, owns=True)
    rnd, want = random.Random(2), {}
    for step in range(14):
        a = rnd.randrange(12)
        b = a + rnd.choice([1, 1, 3, 6])
        new = {h: step for h in range(a, b) if rnd.random() < 0.7}
        frame = rows(spark, *new.items()) if new else rows(spark, (0, 0)).limit(0)
        log.write_span(frame, HOUR + timedelta(hours=a), HOUR + timedelta(hours=b))
        want = {h: n for h, n in want.items() if not a <= h < b} | new
        if step in (4, 8, 9, 12):
            log.fold(spark, keep=step % 2, everything=step == 12, least=1)
        assert held(log, spark) == sorted(want.items())
    assert len(files.names(spark, f"{tmp_path}/t/log")) <= 4


def sent(spark, folder, part):
    """Messages of one file: 30 clicks with offsets of two partitions."""
    made = [(f'{{"articleId":"a{i % 3}","host":"h"}}' if i % 7 else "bad", datetime(2024, 1, 2, 3, i % 60), "t", i % 2, i)
            for i in range(part * 30, part * 30 + 30)]
    frame = spark.createDataFrame(made, "value string, timestamp timestamp, topic string, partition int, offset bigint")
    frame.coalesce(1).write.mode("append").parquet(folder)
    return frame.schema


@pytest.mark.parametrize("cut", ["rows", "quarantine", "record"])
def test_crash_before_the_record_then_a_new_checkpoint(spark, tmp_path, monkeypatch, cut):
    hosts = spark.createDataFrame([("h", False)], "host string, is_big boolean")
    tables = jobs.Tables(f"{tmp_path}/out", hosts)
    schema = sent(spark, f"{tmp_path}/in", 0)

    def stream(folder):
        return messages.read_click_stream(spark, "parquet", {"path": folder}, schema)

    jobs.article_stream(stream(f"{tmp_path}/in"), tables).awaitTermination()
    sent(spark, f"{tmp_path}/in", 1)
    store, write = CommitLog._store, files.write_json

    def fail(*args):
        raise OSError("cut off")

    with monkeypatch.context() as broken:
        if cut == "record":
            broken.setattr(files, "write_json", fail)
        else:
            name = {"rows": "article_5min", "quarantine": jobs.QUARANTINE}[cut]
            broken.setattr(CommitLog, "_store", lambda self, df, n, folder: fail() if n == name else store(self, df, n, folder))
        with pytest.raises(Exception, match="cut off"):
            jobs.article_stream(stream(f"{tmp_path}/in"), tables).awaitTermination()
    assert files.write_json is write
    # the checkpoint is lost: the next run starts behind what committed batches have read
    assert jobs.resume_from(spark, tables, "t") == '{"t":{"0":29,"1":30}}'
    noted = {o["partition"]: o["until_offset"] for o in jobs.stream_log(tables, "article").offsets(spark)}
    monkeypatch.setattr(jobs.Tables, "checkpoint", lambda self, name: f"{tmp_path}/new/{name}")
    rest = stream(f"{tmp_path}/in").where(F.col("offset") >= F.when(F.col("partition") == 0, noted[0]).otherwise(noted[1]))
    jobs.article_stream(rest, tables).awaitTermination()
    jobs.hourly_articles(spark, tables, HOUR)
    good = [i for i in range(60) if i % 7]
    assert sum(r["count"] for r in tables.read(spark, "article_hourly").collect()) == len(good)
    assert jobs.read_quarantine(spark, tables, "article").count() == 60 - len(good)
    assert jobs.resume_from(spark, tables, "t") == '{"t":{"0":59,"1":60}}'


def rows_scanned(df):
    """Rows that the scans of a plan let through."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()

    def leaves(node):
        kids = node.children()
        return [node] if kids.isEmpty() else [x for i in range(kids.size()) for x in leaves(kids.apply(i))]

    return sum(x.metrics().apply("numOutputRows").value() for x in leaves(plan))


def test_point_scans_skip_row_groups(spark, tmp_path):
    n = 40_000
    made = spark.range(n).select(
        F.lit(HOUR).alias("slice"), F.concat(F.lit("h"), F.col("id") % 4).alias("host"),
        F.sha2(F.col("id").cast("string"), 256).alias("article_id"), F.rand(1).cast("string").alias("pad")).coalesce(1)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.block.size", "65536")
    try:
        for name, kind in (("plain", Kind("slice")), ("points", Kind("slice", ("host", "article_id"), ("article_id",)))):
            log = CommitLog(f"{tmp_path}/{name}", {ROWS: kind}, owns=True)
            log.write_span(made, HOUR, HOUR + timedelta(hours=1))
        one = F.sha2(F.lit("17"), 256)
        key = spark.range(1).select(one.alias("k")).first().k
        scanned = {name: rows_scanned(CommitLog(f"{tmp_path}/{name}", {ROWS: Kind("slice")}, owns=True).read(
            spark, ROWS).where((F.col("host") == "h1") & (F.col("article_id") == key))) for name in ("plain", "points")}
        assert scanned["points"] < n / 10
        got = log.read(spark, ROWS).where(F.col("article_id") == key)
        assert got.count() == 1 and rows_scanned(got) < n / 10
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
        spark.sparkContext._jsc.hadoopConfiguration().unset("parquet.block.size")


def test_bloom_filters_lose_no_key(spark):
    from clickroll.sinks import bloom

    rows = spark.range(5000).select(F.concat(F.lit("agent "), "id").alias("a")).union(spark.createDataFrame([(None,), ("",)], "a string"))
    bits = bloom.built(rows, "a", 5002)
    assert len(bits) * 8 == 65536
    assert rows.where("a IS NOT NULL").where(~bloom.holds(F.col("a"), bits)).count() == 0
    others = spark.range(5000).select(F.concat(F.lit("other "), "id").alias("a"))
    assert others.where(bloom.holds(F.col("a"), bits)).count() < 200
    # a full filter holds everything: it costs reads, never keys
    assert others.where(bloom.holds(F.col("a"), b"\xff" * 4096)).count() == 5000


def test_lookups_open_only_folders_with_their_keys(spark, tmp_path):
    table = UpsertTable(f"{tmp_path}/t", ["user_agent"], [], ["detail"], lookup="user_agent")
    schema = "user_agent string, detail string"
    for batch in range(4):
        table.upsert(spark.createDataFrame([(f"{batch}-{i}", f"d{batch}") for i in range(50)], schema), batch)
    empty = spark.createDataFrame([], schema).schema

    def find(*agents):
        keys = spark.createDataFrame([(a,) for a in agents], "user_agent string")
        found, nowhere = table.log.find(spark, "rows", keys, empty)
        return found, {r.user_agent for r in nowhere.collect()}

    found, nowhere = find("new 1", "new 2", "new 3")
    assert nowhere == {"new 1", "new 2", "new 3"} and not found.inputFiles()
    found, nowhere = find("2-7", "new 1")
    assert nowhere == {"new 1"} and {f.split("/b-")[1][0] for f in found.inputFiles()} == {"2"}
    assert found.where("user_agent = '2-7'").first().detail == "d2"
    table.compact(spark)
    found, nowhere = find("0-1", "3-49", "new 9")
    assert nowhere == {"new 9"} and found.where("user_agent IN ('0-1', '3-49')").count() == 2
    assert table.log.vacuum(spark, age=-1) == 8 and find("0-1")[1] == set()
