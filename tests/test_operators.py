"""Operators on golden cases, and on rows where one group is most of the data."""

from collections import Counter, defaultdict
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from clickroll.operators import articles, dashboard, devices, filters, grouping, joins, tags, words
from clickroll.operators.rollup import rollup_by_slice
from clickroll.sources import offsets, scans
from clickroll.sources.clicks import page_access
from clickroll.sources.text import text_column_lines

HOUR = datetime(2015, 9, 11, 6)


def article_rows(spark, rows):
    """(article_id, host, is_app, count, tags, slice) rows with plain attributes."""
    schema = "article_id string, host string, is_app bigint, count bigint, tags array<string>, slice timestamp"
    return spark.createDataFrame(rows, schema).withColumns({
        "first_ts": F.col("slice"), "cat": F.concat(F.lit("cat-"), F.col("slice").cast("string")),
        "url": F.lit("u"),
    })


def click_rows(spark, rows):
    """(event_id, ts, article_id, host, tags) clicks."""
    schema = "event_id bigint, ts timestamp, article_id string, host string, tags array<string>"
    return spark.createDataFrame(rows, schema).withColumns({
        "is_app": F.lit(0).cast("bigint"),
        "cat": F.concat(F.lit("c"), F.col("event_id")),
        "cat_ids": F.array(F.lit("x")),
        "cat_id_hash": F.lit(None).cast("bigint"),
    })


def test_hourly_golden(spark):
    rows = article_rows(spark, [("35678709", f"site{i}.example", 0, 6, [], HOUR) for i in range(10)])
    out = articles.article_hourly(rows).collect()
    assert len(out) == 10
    assert {(r["count"], tuple(r.tags)) for r in out} == {(6, ())}


def test_daily_golden(spark):
    rows = article_rows(spark, [("22969", "cars.example", 0, 6, None, HOUR)] * 10)
    out = articles.article_daily(rows).collect()
    assert [(r["count"], r.tags, r.slice) for r in out] == [(60, [], datetime(2015, 9, 11))]


def test_tags_unite_and_first_attributes_win(spark):
    later = datetime(2015, 9, 11, 6, 5)
    rows = article_rows(spark, [
        ("1", "h", 0, 2, ["b", "a"], later), ("1", "h", 0, 3, ["c", "a"], HOUR), ("1", "h", 0, 1, None, later),
    ])
    (row,) = articles.article_hourly(rows).collect()
    assert (row["count"], row.tags) == (6, ["a", "b", "c"])
    assert row.cat == "cat-2015-09-11 06:00:00"


def test_null_keys_stay_groups(spark):
    t = datetime(2024, 1, 1)
    clicks = click_rows(spark, [(1, t, None, "h", None), (2, t, None, "h", ["a", "", "a"]), (3, t, "1", None, ["a"])])
    out = {(r.article_id, r.host): (r["count"], r.tags) for r in articles.article_5min(clicks).collect()}
    assert out == {(None, "h"): (2, ["a"]), ("1", None): (1, ["a"])}


def test_both_article_paths_agree(spark, sf):
    from clickroll.functions.slices import slice_start
    from clickroll.plans.inputs import clicks

    rows = clicks(spark, sf)
    two = articles.article_5min(rows)
    one = articles.merge_article_rows(articles.as_counts(rows), slice_start("min5", "ts"))
    assert two.select(sorted(two.columns)).exceptAll(one.select(sorted(two.columns))).isEmpty()
    assert two.count() == one.count()


def test_month_belongs_to_the_day_and_noise_goes(spark):
    hosts = spark.createDataFrame([("big", True), ("small", False)], "host string, is_big boolean")
    rows = article_rows(spark, [
        ("1", "big", 0, 1, ["x"], datetime(2015, 8, 31)),
        ("1", "small", 0, 1, ["y"], datetime(2015, 8, 31)),
        ("1", "big", 0, 60, ["z"], datetime(2015, 9, 1)),
        ("1", None, 0, 1, [], datetime(2015, 9, 1)),
    ])
    out = {(r.host, r.slice.month): (r["count"], r.tags) for r in articles.month_deltas(rows, hosts).collect()}
    assert out == {("small", 8): (1, ["y"]), ("big", 9): (60, ["z"]), (None, 9): (1, [])}
    weeks = {(r.host, r.slice.day): r["count"] for r in articles.week_deltas(rows).collect()}
    assert weeks == {("big", 30): 61, ("small", 30): 1, (None, 30): 1}  # Sunday, 30 August


def brute_tags(rows):
    want = defaultdict(Counter)
    for _, _, article, host, tag_list in rows:
        for tag in {t for t in tag_list or [] if t}:
            want[host, tag][article] += 1
    return {k: dict(v) for k, v in want.items()}


def hot_tag_rows():
    t = datetime(2024, 1, 1, 0, 1)
    rows = [(i, t, f"a{i % 97}", "h", ["hot", "hot", "", f"t{i % 3}"]) for i in range(900)]
    rows += [(900 + i, t, f"a{i}", "g", ["cold"] if i % 2 else None) for i in range(10)]
    return rows


def test_tag_counts_equal_brute_force(spark):
    rows = hot_tag_rows()
    long = tags.tag_article_5min(click_rows(spark, rows))
    got = defaultdict(dict)
    for r in long.collect():
        got[r.host, r.tag][r.article_id] = r["count"]
    assert dict(got) == brute_tags(rows)
    totals = {(r.host, r.tag): (r["count"], r.articles, r.cat_id_hash) for r in tags.tag_totals(long).collect()}
    assert totals == {k: (sum(v.values()), len(v), 0) for k, v in brute_tags(rows).items()}


def test_lists_have_fixed_parts_and_the_whole_total(spark):
    rows = hot_tag_rows()
    want = brute_tags(rows)
    for parts in (tags.PARTS, 5, 1):
        seen, n_parts = defaultdict(dict), Counter()
        nested = tags.nest_articles(tags.tag_article_5min(click_rows(spark, rows)), parts)
        for r in nested.collect():
            n_parts[r.tag] += 1
            assert r["count"] == sum(a["count"] for a in r.articles) and r.total == sum(want[r.host, r.tag].values())
            assert [a.article_id for a in r.articles] == sorted(a.article_id for a in r.articles)
            for a in r.articles:
                assert a.article_id not in seen[r.host, r.tag]
                seen[r.host, r.tag][a.article_id] = a["count"]
        assert dict(seen) == want and max(n_parts.values()) <= parts
        again = tags.nest_articles(tags.tag_article_hourly(nested), parts)
        assert {(r.host, r.tag): r.total for r in again.collect()} == {k: sum(v.values()) for k, v in want.items()}


def test_hourly_tags_merge_several_slices(spark):
    rows = [(i, datetime(2024, 1, 1, 3, i % 60), f"a{i % 5}", "h", ["t"]) for i in range(120)]
    five = tags.tag_article_5min(click_rows(spark, rows))
    assert five.select("slice").distinct().count() == 12
    hour = tags.tag_article_hourly(five).collect()
    assert {(r.article_id, r["count"], r.cat) for r in hour} >= {("a0", 24, "c0")} and len(hour) == 5


def test_cube_keeps_null_category_apart(spark):
    rows = spark.sql("""SELECT * FROM VALUES (1, 'h', 'c1', 'd', 1, 2L), (1, 'h', 'c2', 'd', 1, 3L),
        (1, 'h', NULL, 'e', 0, 4L) AS t(slice, host, cat, location, is_india, count)""")
    out = [(r.is_india, r.cat, r.location, r["count"]) for r in grouping.location_by_cat(rows).collect()]
    assert sorted(out, key=str) == sorted([
        (1, "c1", "d", 2), (1, "c1", "All", 2), (1, "c2", "d", 3), (1, "c2", "All", 3), (1, "All", "d", 5),
        (1, "All", "All", 5), (0, None, "e", 4), (0, None, "All", 4), (0, "All", "e", 4), (0, "All", "All", 4),
    ], key=str)


def test_response_totals_and_click_limits(spark):
    rows = spark.sql("""SELECT * FROM VALUES (1, 'h', '5', 'c', 2L, 10L), (1, 'h', '5', NULL, 1L, 7L)
        AS t(slice, host, grp, cat, count, tot_tm)""")
    out = {(r.cat, r["count"], r.tot_tm) for r in grouping.response_by_cat(rows).collect()}
    assert out == {("c", 2, 10), (None, 1, 7), ("All", 3, 17)}
    hosts = spark.createDataFrame([("h", False)], "host string, is_big boolean")
    hourly = spark.sql("SELECT * FROM VALUES (1, 'h', 'c', 5L), (1, 'h', 'c', 4L), (1, 'x', 'c', 9L) AS t(slice, host, cat, count)")
    assert {(r.cat, r["count"]) for r in grouping.clicks_by_cat(hourly, hosts).collect()} == {("c", 5), ("All", 5)}


def test_dashboard_keeps_null_keys_and_underscores(spark):
    t = datetime(2024, 1, 1, 5, 30)
    rows = spark.createDataFrame(
        [("h_1", None, 1, None, "5", "a_b", 3, t, "c"), ("h_1", None, 1, "", "5", "a_b", 4, t, "c"),
         ("h", "1_x", None, "r", None, None, 5, t, "c")],
        "host string, geo_location string, is_india int, referer string, grp string, article_id string,"
        " dnld_time bigint, ts timestamp, cat string")
    keyed = dashboard.dashboard_keys(rows)
    assert keyed.count() == 3
    out = {(r.host, r.article_id, r.referer): (r["count"], r.tot_tm, r.slice) for r in dashboard.referer_counts(keyed).collect()}
    end = datetime(2024, 1, 1, 6)
    assert out == {("h_1", "a_b", "none"): (2, 7, end), ("h", None, "r"): (1, 5, end)}
    assert dashboard.response_counts(keyed).count() == 2
    assert dashboard.location_counts(keyed).count() == 2


def test_devices_fall_back_to_the_agent_text(spark):
    dim = devices.describe_agents(spark.createDataFrame([("x",)], "agent_type string")).select(
        F.lit("known").alias("user_agent"),
        F.col("detail").withField("browser_name", F.lit("B")).withField("device_category", F.lit("Tablet")).alias("detail"))
    events = spark.createDataFrame(
        [("h", "known", 10, HOUR), ("h", "known", 21, HOUR), ("h", "Chrome/1.2", 7, HOUR), ("h", None, 1, HOUR)],
        "host string, agent_type string, dnld_time bigint, ts timestamp").withColumn("elements", F.lit(1).cast("bigint"))
    sums = devices.host_agent_sums(events, F.col("ts"))
    rows = devices.host_agent(sums, dim)
    out = {(r.device, r.browser, r["count"], r.total_time, r.avg_time) for r in rows.collect()}
    assert out == {(0, "B", 2, 31, 15), (1, "Chrome", 1, 7, 7), (1, "unknown", 1, 1, 1)}
    assert {r.user_agent for r in devices.new_agents(events, dim).collect()} == {"Chrome/1.2"}
    # an empty dimension takes every agent
    assert devices.new_agents(events, dim.limit(0)).count() == 2
    assert devices.host_device_deltas(rows).count() == 3


def test_words_drop_blanks(spark):
    lines = spark.createDataFrame([(" hello there\thello  ",), ("",), (None,)], "line string")
    counts = {r.word: r["count"] for r in words.word_count(words.split_words(lines)).collect()}
    assert counts == {"hello": 2, "there": 1}
    texts = spark.createDataFrame([("a\n\nb",)], "text string")
    assert [r.line for r in text_column_lines(texts, "text").collect()] == ["a", "", "b"]


def sides(spark):
    base = 1_700_000_000
    left = [(f"k{i % 2}", base + i * 7, i) for i in range(200)]
    right = [("k0" if i % 3 else "k1", base + i * 5 + 1, i) for i in range(260)]
    make = lambda rows: spark.createDataFrame(rows, "k string, s double, v bigint").select(
        "k", F.col("s").cast("timestamp").alias("ts"), "v")
    as_rows = lambda rows: [(k, float(s), v) for k, s, v in rows]
    left, right = as_rows(left), as_rows(right)
    return left, right, make(left), make(right)


def test_windowed_join_equals_brute_force(spark):
    left, right, a, b = sides(spark)
    want = sorted((v1, v2) for k1, s1, v1 in left for k2, s2, v2 in right if k1 == k2 and s1 - 60 < s2 < s1 + 20)
    for hot in (None, ["k0"], ["k0", "k1", "no such key"]):
        got = joins.join_windowed(a, b, "k", "ts", "v", hot=hot)
        assert sorted((r.left_value, r.right_value) for r in got.collect()) == want


def test_batch_join_equals_brute_force(spark):
    left, right, a, b = sides(spark)
    want = sorted((v1, v2) for k1, s1, v1 in left for k2, s2, v2 in right if k1 == k2 and s1 // 20 == s2 // 20)
    for hot in (None, ["k0"]):
        got = joins.join_same_batch(a, b, "k", "ts", "v", 20, hot=hot)
        assert sorted((r.left_value, r.right_value) for r in got.collect()) == want


def test_heavy_keys_are_found_and_only_they_are_copied(spark):
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, "warm").otherwise(F.col("id").cast("string")).alias("key"),
        F.col("id").alias("left_value"))
    assert joins.heavy_keys(rows, "key") == ["hot"]
    assert joins.heavy_keys(rows, "key", 0.01) == ["hot", "warm"]
    assert joins.heavy_keys(rows.where("key <> 'hot'"), "key", 0.5) == []
    assert joins.heavy_keys(rows.limit(0), "key") == [] and joins.heavy_keys(rows.select(F.lit(None).cast("string").alias("key")), "key") == []
    for hot, copies in ((None, 0), (["hot"], 10_000 * (joins.SALT - 1))):
        left, right = joins._salted(rows, rows, hot, joins.SALT)
        assert (left.count(), right.count()) == (30_000, 30_000 + copies)
        assert left.join(right, ["key", "salt", "left_value"]).count() == 30_000


def test_range_end_points(spark):
    df = spark.sql("SELECT explode(sequence(timestamp'2024-01-01 00:00:00', timestamp'2024-01-01 02:00:00', interval 1 hour)) AS ts")
    lo, hi = datetime(2024, 1, 1), datetime(2024, 1, 1, 2)
    assert [r.ts.hour for r in filters.time_range(df, "ts", lo, hi, "[)").collect()] == [0, 1]
    assert [r.ts.hour for r in filters.time_range(df, "ts", lo, hi, "(]").collect()] == [1, 2]
    with pytest.raises(ValueError):
        filters.time_range(df, "ts", lo, hi, "[]")


def test_offsets_and_lookup(spark):
    ledger = spark.createDataFrame(
        [("t", 0, 5, 1), ("t", 0, 9, 2), ("t", 1, 4, 1), ("u", 0, 3, 1)],
        "topic string, partition int, until_offset bigint, committed_at bigint")
    assert offsets.resume_offsets(ledger, "t") == '{"t":{"0":9,"1":4}}'
    assert offsets.resume_offsets(ledger, "none") == "earliest"
    assert offsets.sort_latest(ledger).first().committed_at == 2
    table = spark.createDataFrame([("k", "old", 1), ("k", None, 2), ("j", "x", 1)], "k string, v string, n int")
    assert {(r.k, r.v) for r in scans.load_lookup(table, "k", "v", "n").collect()} == {("k", None), ("j", "x")}


def test_limit_and_page_access(spark, sf):
    from clickroll.plans.inputs import table

    rows = scans.pushdown_scan(table(spark, sf, "events"), ["event_id"], F.col("event_type") == "click", 3)
    assert rows.count() == 3
    text = spark.createDataFrame([('{"pgAccess5Min": 4, "url": "u"}',), ('{"pgAccess5Min": 5}',), ("bad",)], "value string")
    assert {tuple(r) for r in page_access(text).collect()} == {(4, "u"), (5, None)}


def test_rollup_back_by_zone(spark):
    df = spark.sql("SELECT timestamp'2024-03-10 20:00:00' AS ts, 1 AS v")  # 11 March in India
    row = rollup_by_slice(df, "ts", "day", [], [F.sum("v").alias("v")], back=1, tz="Asia/Kolkata").first()
    assert row.slice == datetime(2024, 3, 9, 18, 30)
