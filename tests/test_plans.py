"""Physical plans: pushdown, pruning, partial aggregation, no Python, no cross joins."""

import re

import pytest

import __spark_entry__ as entry
from clickroll.functions.slices import slice_start
from clickroll.operators import articles, filters, tags
from clickroll.plans.inputs import clicks, hosts, message_folder
from clickroll.sources.clicks import good_clicks, normalise_clicks, parse_clicks

SF = "/root/testdata/sf0.001"
BATCH = [n for n in entry.queries() if n.startswith(("agg_", "rollup_", "src_", "filter_", "word_", "join_tables", "join_agent"))
         and n not in ("src_click_stream", "src_text_lines")]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_and_no_python(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    for word in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas", "MapPartitions", "Window "):
        assert word not in text, word


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(entry.queries()["src_interval_scan"](spark, SF))
    assert re.search(r"PushedFilters: \[IsNotNull\(ts\), GreaterThanOrEqual\(ts,[^)]+\), LessThan\(ts,", text)
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp,event_type:string>" in text
    text = plan(entry.queries()["src_pushdown_scan"](spark, SF))
    assert "EqualTo(event_type,click), EqualTo(user_id,2)" in text


def test_day_partitions_are_pruned(spark, tmp_path):
    from datetime import datetime

    from clickroll.sinks.append import read_slices, write_partitions
    from clickroll.sources.scans import hourly_articles

    path = str(tmp_path / "t")
    write_partitions(articles.article_5min(clicks(spark, SF)), path)
    rows = hourly_articles(spark.read.parquet(path), datetime(2024, 1, 15), hosts(spark, SF))
    assert re.search(r"PartitionFilters: \[.*20240114.*20240115", plan(rows))
    schema = articles.article_5min(clicks(spark, SF)).schema
    days = read_slices(spark, path, [datetime(2024, 1, 14), datetime(2099, 1, 1)], schema)
    assert len(days.inputFiles()) >= 1 and all("dt=20240114" in f for f in days.inputFiles())
    assert read_slices(spark, path, [datetime(2099, 1, 1)], days.schema).count() == 0
    write_partitions(articles.article_5min(clicks(spark, SF)), path + "-h", hourly=True)
    hours = read_slices(spark, path + "-h", [datetime(2024, 1, 14, h) for h in range(12)], schema, hourly=True)
    assert hours.inputFiles() and all(re.search("dt=20240114/hr=(0.|1[01])/", f) for f in hours.inputFiles())


def test_messages_are_parsed_once(spark):
    source = spark.read.parquet(message_folder(spark, SF))
    rows = normalise_clicks(good_clicks(parse_clicks(source)))
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_every_shuffle_of_an_aggregate_is_behind_a_partial_one(spark):
    text = plan(articles.article_5min(clicks(spark, SF)))
    assert text.count("Exchange hashpartitioning") == 2
    assert text.count("partial_count(1)") == 1 and text.count("partial_collect_set") == 1
    text = plan(tags.tag_article_5min(clicks(spark, SF)))
    # tags are exploded above the first aggregate, so on its result
    assert text.index("Generate explode") < text.index("partial_count(1)")


def test_cube_expands_what_is_summed_already(spark):
    text = plan(entry.queries()["agg_location_by_cat"](spark, SF))
    assert text.index("Expand") < text.index("partial_sum(count", text.index("Expand"))


def test_host_list_is_broadcast_by_size_only(spark):
    rows = clicks(spark, SF).select("event_id", "host")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Broadcast" not in plan(filters.in_hosts(rows, hosts(spark, SF)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan(filters.in_hosts(rows, hosts(spark, SF)))


def test_slices_need_no_interval_arithmetic_per_row(spark):
    rows = clicks(spark, SF).select(slice_start("min5", "ts").alias("slice"))
    assert "make_dt_interval" not in plan(rows)
