"""Column expressions and cleaning rules on golden cases."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from clickroll.functions.clean import (
    clean_tags, default_referer, is_desktop, to_flag, to_long,
)
from clickroll.functions.hashing import java_string_hash, octet_partition
from clickroll.functions.maps import map_to_list, merge_count_maps
from clickroll.functions.slices import (
    INTERVALS, day_key, day_shard, slice_of_interval, slice_start,
)
from clickroll.schemas import to_documents
from clickroll.sources.clicks import (
    flag_error_docs, good_clicks, normalise_agent_events, normalise_clicks,
    parse_clicks, quarantined_clicks,
)


def one(spark, column, value=None, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column).first()[0]


@pytest.mark.parametrize("text,want", [
    ("cricket", 1032299505), ("polygenelubricants", -2147483648), ("a😀b", 57849694), ("", None),
    (None, None), ("a", 97),
])
def test_string_hash(spark, text, want):
    assert one(spark, java_string_hash("v"), text) == want


def test_string_hash_of_devanagari(spark):
    word, want = "क्रिकेट", 0
    for c in word:
        want = (want * 31 + ord(c)) % (1 << 32)
    want -= (1 << 32) if want >= (1 << 31) else 0
    assert one(spark, java_string_hash("v"), word) == want


@pytest.mark.parametrize("key,want", [
    ("192.168.2.77", 2), (".5", 0), ("nodot", 0), ("a.b", 0), (None, 0), ("x.10", 0), ("x.4", 4),
])
def test_octet(spark, key, want):
    assert one(spark, octet_partition("v", 5), key) == want


@pytest.mark.parametrize("text,want", [
    ("1", 1), ("1.0", 1), ("1.4E9", 1400000000), ("x", 7), (None, 7), ("NaN", 7), ("-2.9", -2),
    ("9223372036854775807", 9223372036854775807), ("1e300", 7),
])
def test_to_long(spark, text, want):
    assert one(spark, to_long("v", 7), text) == want


def test_small_cleaners(spark):
    assert one(spark, to_flag("v"), "TRUE") is True
    assert one(spark, to_flag("v"), "yes") is False
    assert one(spark, to_flag("v")) is False
    assert one(spark, default_referer("v"), "") == "none"
    assert one(spark, default_referer("v")) == "none"
    assert one(spark, default_referer("v"), "r") == "r"
    assert one(spark, clean_tags("v"), ["a", "", None, "a", "b"], "array<string>") == ["a", "b"]
    assert one(spark, clean_tags("v"), None, "array<string>") == []


@pytest.mark.parametrize("category,want", [
    ("Smartphone", 0), ("mobile", 0), ("Tablet", 0), ("tab", 0), ("Mobile", 1), ("PHONE", 1),
    ("Personal computer", 1), (None, 1),
])
def test_desktop(spark, category, want):
    assert one(spark, is_desktop("v"), category) == want


def test_maps(spark):
    row = spark.sql("SELECT map('a', 1L, 'b', 2L) AS l, map('b', 3L, 'c', 4L) AS r").select(
        merge_count_maps(F.col("l"), F.col("r")).alias("m"),
        map_to_list(merge_count_maps(F.col("l"), F.lit(None).cast("map<string,bigint>"))).alias("n"),
    ).first()
    assert row.m == {"a": 1, "b": 5, "c": 4}
    assert [(x.article_id, x["count"]) for x in row.n] == [("a", 1), ("b", 2)]


def slices(spark, seconds, tz=None, **options):
    df = spark.createDataFrame([(seconds,)], "s bigint").select(F.timestamp_seconds("s").alias("ts"))
    names = ["minute", "min5", "half_hour", "hour", "hour_n", "day", "week", "month", "year"]
    cols = [F.unix_seconds(slice_start(n, "ts", tz=tz, **options)).alias(n) for n in names]
    return df.select(*cols).first().asDict()


def utc(*parts):
    return int(datetime(*parts, tzinfo=timezone.utc).timestamp())


def test_slices_in_india(spark):
    # 2015-09-11 12:45 in Asia/Kolkata, where hours start at half past in UTC
    noon = 1441953000
    got = slices(spark, noon + 2700, tz="Asia/Kolkata")
    assert got["hour"] == noon
    assert got["half_hour"] == noon + 3600
    assert got["hour_n"] == noon
    assert got["day"] == utc(2015, 9, 10, 18, 30)
    assert got["week"] == utc(2015, 9, 5, 18, 30)
    assert got["month"] == utc(2015, 8, 31, 18, 30)
    assert got["year"] == utc(2014, 12, 31, 18, 30)


def test_slices_in_utc(spark):
    t = utc(2024, 2, 29, 17, 23, 45)
    got = slices(spark, t)
    assert got["minute"] == utc(2024, 2, 29, 17, 23)
    assert got["min5"] == utc(2024, 2, 29, 17, 20)
    assert got["half_hour"] == utc(2024, 2, 29, 17, 30)
    assert got["hour_n"] == utc(2024, 2, 29, 17)  # 5 pm of the 12-hour clock
    assert got["week"] == utc(2024, 2, 25)
    back = slices(spark, t, back=2)
    assert back["min5"] == utc(2024, 2, 29, 17, 10)
    assert back["hour"] == utc(2024, 2, 29, 15)
    assert back["day"] == utc(2024, 2, 27)
    assert back["week"] == utc(2024, 2, 11)
    assert back["month"] == utc(2023, 12, 1)
    assert back["year"] == utc(2022, 1, 1)


def test_half_hour_boundaries(spark):
    half = utc(2024, 1, 1, 3, 30)
    assert slices(spark, half)["half_hour"] == half
    assert slices(spark, half + 1)["half_hour"] == half + 1800
    assert slices(spark, half - 1800)["half_hour"] == half


def test_min5_steps_start_again_each_hour(spark):
    got = slices(spark, utc(2024, 1, 1, 3, 58), n=7)
    assert got["min5"] == utc(2024, 1, 1, 3, 56)


def test_sunday_is_its_own_week(spark):
    assert slices(spark, utc(2024, 1, 7, 1))["week"] == utc(2024, 1, 7)


def test_day_shards(spark):
    df = spark.sql("SELECT timestamp'2024-01-02 00:00:00' AS ts")
    row = df.select(
        *[day_shard("ts", i).alias(i) for i in ("MINUTE", "HOUR", "WEEK", "MONTH")],
        day_key("ts").alias("day"), day_key("ts", fmt="yyyyMM").alias("month"),
        day_key("ts", tz="America/New_York").alias("west"),
    ).first()
    assert [row[i] for i in ("MINUTE", "HOUR", "WEEK", "MONTH")] == ["20240101"] * 4
    assert (row.day, row.month, row.west) == ("20240102", "202401", "20240101")


def test_interval_codes():
    assert INTERVALS[1] == "MINUTE" and slice_of_interval(1) == "min5"
    assert slice_of_interval("WEEK") == "week"
    with pytest.raises(ValueError):
        slice_of_interval(6)


MESSY = [
    "bad", "", None, "[1]", '"x"', "12",
    '{"articleId":12}',
    '{"articleId":"1","host":"h","tags":["a","","a"],"isAPP":"1.0","publishTime":1.4E9,"catIdHash":12}',
    '{"articleId":"2","tags":"x","publishTime":"soon","catIdHash":"zz","isGroup":true}',
]


def test_messy_messages(spark):
    parsed = parse_clicks(spark.createDataFrame([(m, datetime(2024, 1, 1)) for m in MESSY], "value string, timestamp timestamp"))
    bad = [r.value for r in quarantined_clicks(parsed).collect()]
    assert sorted(bad, key=str) == sorted(MESSY[:6], key=str)
    rows = {r.article_id: r for r in normalise_clicks(good_clicks(parsed)).collect()}
    assert set(rows) == {"12", "1", "2"}
    one_ = rows["1"]
    assert (one_.tags, one_.is_app, one_.publish_time, one_.cat_id_hash) == (["a"], 1, 1400000000, 12)
    assert (one_.content_type, one_.is_group, one_.author, one_.channel) == (1, False, "", "")
    two = rows["2"]
    assert (two.tags, two.publish_time, two.cat_id_hash, two.is_group) == ([], 0, None, True)


def test_agent_events_count_once(spark):
    text = ' \n{"host":"h","agentType":"ua","count":"5.0","pgDownloadTime":1200,"tags":1,"ts":1441953000000}'
    parsed = parse_clicks(spark.createDataFrame([(text,)], "value string"))
    row = normalise_agent_events(good_clicks(parsed)).first()
    assert (row.sent_count, row["count"], row.dnld_time, row.elements) == (5, 1, 1200, 1)


def test_error_docs_are_flagged_kept_and_counted(spark):
    df = spark.createDataFrame([("a", None), (None, "h"), ("b", ""), ("c", "h")], "article_id string, host string")
    assert flag_error_docs(df, ["article_id", "host"]).where("is_error_doc").count() == 2
    flagged = flag_error_docs(df, ["article_id", "host"], empty_too=True)
    assert flagged.count() == 4 and flagged.where("is_error_doc").count() == 3


def test_time_of_a_click(spark):
    sent = [('"2024-01-02 03:04:05"', 1704164645), ("1441953000000", 1441953000), ('"1441953000000"', 1441953000),
            ('"soon"', 1), ("null", 1), ('""', 1), ("1e300", 1), ('"2024-01-02T03:04:05Z"', 1704164645)]
    rows = [(i, f'{{"event_id":{i},"ts":{t}}}', datetime(1970, 1, 1, 0, 0, 1)) for i, (t, _) in enumerate(sent)]
    rows += [(90, '{"event_id":90}', None), (91, '{"event_id":91,"ts":"2024-01-02"}', None)]
    parsed = parse_clicks(spark.createDataFrame(rows, "i int, value string, timestamp timestamp"))
    got = {r.event_id: r.s for r in good_clicks(parsed).select("event_id", F.unix_seconds("ts").alias("s")).collect()}
    assert got == {**{i: s for i, (_, s) in enumerate(sent)}, 91: 1704153600}
    assert [r.value for r in quarantined_clicks(parsed).collect()] == ['{"event_id":90}']


def test_document_names(spark):
    df = spark.sql("SELECT timestamp'2024-01-01 00:05:00' AS slice, 'a' AS article_id, 0L AS is_app, "
                   "timestamp'2024-01-01 00:05:01' AS first_ts")
    ms = to_documents(df, unit="ms")
    assert ms.columns == ["timeStamp", "articleId", "isAPP"]
    assert ms.first().timeStamp == 1704067500000
    assert to_documents(df, time_name="ts").first().ts == 1704067500
    row = to_documents(df, unit="ms", date_name="tsd").first()
    assert (row.timeStamp, row.tsd) == (1704067500000, datetime(2024, 1, 1, 0, 5))
