"""Sinks: retries, folding, partitions."""

from datetime import datetime
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from clickroll import work_dir
from clickroll.operators.devices import new_agents
from clickroll.schemas import AGENT_DIM
from clickroll.sinks import append, ledgers
from clickroll.sinks.upserts import UpsertTable


@pytest.fixture
def table(tmp_path):
    return UpsertTable(str(tmp_path / "t"), ["k"], ["count"], ["cat"], ["tags"])


def deltas(spark, rows):
    return spark.createDataFrame(rows, "k string, count bigint, cat string, tags array<string>")


def state(spark, table):
    return {r.k: (r["count"], r.cat, r.tags) for r in table.read(spark).collect()}


def test_retry_counts_once(spark, table):
    first = deltas(spark, [("a", 60, None, ["x"])])
    table.upsert(first, 0)
    assert state(spark, table) == {"a": (60, None, ["x"])}
    table.upsert(first, 0)
    assert state(spark, table) == {"a": (60, None, ["x"])}
    table.upsert(deltas(spark, [("a", 60, "late", ["y", "x"]), (None, 1, "n", None)]), 1)
    # the first-seen category stays, even where it was null; a null key is a key
    assert state(spark, table) == {"a": (120, None, ["x", "y"]), None: (1, "n", [])}


def test_folding_changes_nothing(spark, table):
    for batch in range(4):
        table.upsert(deltas(spark, [("a", batch, f"c{batch}", [f"t{batch}"]), (f"k{batch}", 1, "c", [])]), batch)
    before = state(spark, table)
    assert table.compact(spark) == 4
    assert state(spark, table) == before
    # a retry of a folded batch is an error, not a silent loss
    with pytest.raises(ValueError):
        table.upsert(deltas(spark, [("a", 100, "z", [])]), 2)
    assert state(spark, table) == before
    for batch in (4, 5):
        table.upsert(deltas(spark, [("a", 1, "z", ["new"])]), batch)
    assert table.compact(spark, keep=1) is None
    assert table.compact(spark) == 2
    after = state(spark, table)
    assert after["a"] == (8, "c0", ["new", "t0", "t1", "t2", "t3"])
    assert table.compact(spark) is None
    assert table.compact(spark, everything=True) == 2
    assert state(spark, table) == after
    with pytest.raises(ValueError):
        table.upsert(deltas(spark, [("a", 1, "z", [])]), 4)


def test_late_and_older_batches_count_after_a_fold(spark, table):
    for batch, n in ((10, 1), (12, 1)):
        table.upsert(deltas(spark, [("a", n, "c", [])]), batch)
    assert table.compact(spark) == 2
    for batch, n in ((11, 100), (5, 1000)):
        table.upsert(deltas(spark, [("a", n, "c", [])]), batch)
    assert state(spark, table)["a"][0] == 1102


def test_a_new_checkpoint_is_another_run(spark, table):
    table.upsert(deltas(spark, [("a", 3, "c", [])]), 0, "r1")
    table.upsert(deltas(spark, [("a", 5, "c", [])]), 0, "r2")
    table.upsert(deltas(spark, [("a", 5, "c", [])]), 0, "r2")
    assert state(spark, table)["a"][0] == 8
    assert table.read(spark, before=0, run="r2").first()["count"] == 3
    assert table.compact(spark, keep=1) is None and table.compact(spark) == 2
    with pytest.raises(ValueError):
        table.read(spark, before=0, run="r2")


def test_batches_without_a_record_are_not_read(spark, table, monkeypatch):
    from clickroll.sinks import files

    table.upsert(deltas(spark, [("a", 1, "c", [])]), 0)
    # a batch that is cut off before its record leaves rows that nobody reads
    with monkeypatch.context() as cut:
        cut.setattr(files, "write_json", lambda *args: (_ for _ in ()).throw(OSError("cut off")))
        with pytest.raises(OSError):
            table.upsert(deltas(spark, [("a", 9, "c", [])]), 1)
    assert state(spark, table)["a"][0] == 1
    assert table.log.vacuum(spark) == 0 and table.log.vacuum(spark, age=-1) == 1
    with pytest.raises(ValueError):
        UpsertTable(table.path + "-none", ["k"], ["count"]).read(spark)


def test_day_partitions_are_replaced(spark, tmp_path):
    rows = spark.createDataFrame([(datetime(2024, 1, d), d) for d in (1, 2, 2)], "slice timestamp, n bigint")
    append.write_partitions(rows, str(tmp_path / "p"))
    append.write_partitions(rows.where("n = 2").limit(1), str(tmp_path / "p"))
    out = spark.read.parquet(str(tmp_path / "p"))
    assert sorted((str(r.dt), r.n) for r in out.collect()) == [("20240101", 1), ("20240102", 2)]


def test_a_slice_without_rows_becomes_empty(spark, tmp_path):
    rows = spark.createDataFrame([(datetime(2024, 1, 1, 5), 1)], "slice timestamp, n bigint")
    path, hour = str(tmp_path / "p"), datetime(2024, 1, 1, 5)
    for part, n in ((rows, 1), (rows, 1), (rows.limit(0), 0)):
        append.write_slice(part, path, hour, hourly=True)
        assert append.read_slices(spark, path, [hour, datetime(2024, 1, 1, 6)], rows.schema, hourly=True).count() == n


def test_ledgers(spark, tmp_path):
    batch = spark.createDataFrame([("t", 0, 5), ("t", 0, 9), ("t", 1, 2)], "topic string, partition int, offset bigint")
    got = {(r.partition, r.from_offset, r.until_offset, r.description) for r in ledgers.offset_ranges(batch).collect()}
    assert got == {(0, 5, 10, "t 0 5 10"), (1, 2, 3, "t 1 2 3")}
    log = ledgers.offset_ranges(batch).withColumn("batch_id", F.lit(0)).unionByName(
        ledgers.offset_ranges(batch.where("partition = 0")).withColumns({"batch_id": F.lit(1), "until_offset": F.lit(99).cast("bigint")}))
    assert {(r.partition, r.until_offset) for r in ledgers.latest_ranges(log).collect()} == {(0, 99), (1, 3)}
    done = spark.createDataFrame([("job", 7)], "job string, exec_ts bigint")
    ledgers.log_runs(done, str(tmp_path / "r"))
    ledgers.log_runs(done, str(tmp_path / "r"))
    assert ledgers.runs(spark.read.parquet(str(tmp_path / "r"))).count() == 1


def test_new_agents_are_added_once(spark, tmp_path):
    dim = UpsertTable(str(tmp_path / "dim"), ["user_agent"], [], ["detail"])
    agents = spark.createDataFrame([("Chrome/1",), ("Firefox/2",), ("Chrome/1",)], "agent_type string")

    def add(rows, batch):
        dim.upsert(new_agents(rows, dim.read(spark, before=batch, empty=AGENT_DIM)), batch)

    add(agents, 0)
    add(agents, 0)  # a retry does not see what its first run wrote
    assert {r.user_agent for r in dim.read(spark).collect()} == {"Chrome/1", "Firefox/2"}
    add(agents.union(spark.createDataFrame([("Edge/3",)], "agent_type string")), 1)
    assert dim.compact(spark) == 2
    assert {(r.user_agent, r.detail.browser_name) for r in dim.read(spark).collect()} == {
        ("Chrome/1", "Chrome"), ("Firefox/2", "Firefox"), ("Edge/3", "Edge")}


def test_work_dir_follows_the_session(spark, tmp_path, monkeypatch):
    def session(folder, master):
        held = {"spark.checkpoint.dir": folder, "spark.master": master}
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: held[key]))

    assert work_dir(session("hdfs://n/shared/", "yarn"), "x").startswith("hdfs://n/shared/x-")
    monkeypatch.setattr("tempfile.tempdir", str(tmp_path))
    for master in ("local", "local[*]"):
        assert work_dir(session(None, master), "x").startswith(f"{tmp_path}/clickroll-")
    for master in ("yarn", "spark://n:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            work_dir(session(None, master), "x")
    assert work_dir(spark, "x") != work_dir(spark, "x")


def test_octet_sink_column(spark):
    rows = append.with_partition(spark.createDataFrame([("1.2.3.9",)], "key string"), "key", 4)
    assert rows.first().partition == 1
