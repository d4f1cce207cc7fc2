"""Suffix-array dedup against a plain search, and its defined cases."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickroll.llm import suffixes

DOCS = "doc_id long, text string, id string, raw int, fp string, spans int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, "y", 2) for i, t in rows], DOCS)


def plain(texts, window):
    """Spans of each text, from all windows of all texts."""
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i:i + window] for r in raws for i in range(len(r) - window + 1))
    out = []
    for r in raws:
        spans = []
        for i in range(len(r) - window + 1):
            if seen[r[i:i + window]] > 1:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + window
                else:
                    spans.append([i, i + window])
        out.append(spans)
    return out


def corpus(seed=1, n=60):
    rnd = random.Random(seed)
    letters = "abcdefg hé\n"
    part = lambda k: "".join(rnd.choice(letters) for _ in range(k))
    passage, texts = part(90), []
    for i in range(n):
        t = part(rnd.randint(0, 150))
        if i % 3 == 0:
            t = part(rnd.randint(0, 40)) + passage + part(rnd.randint(0, 40))
        if i % 5 == 0:
            k = rnd.randint(0, 50)
            t += passage[k:k + rnd.randint(30, 40)] + part(5)
        if i % 7 == 0 and texts:
            t = texts[rnd.randrange(len(texts))] or ""
        if i % 11 == 0:
            t = t[:50] + "#" + t[51:]
        texts.append(t)
    return [*texts, None, "", passage[:31], "ab" * 100, "\0" * 70, passage + "\0" * 40, "z" * 32, "y" * 33]


def spans_of(df):
    return sorted((r.n_bytes, tuple((s.a, s.b) for s in r.spans), bytes(r.kept)) for r in df.select("n_bytes", "spans", "kept").collect())


def cut(text, spans):
    raw, kept, at = (text or "").encode(), [], 0
    for a, b in spans:
        kept.append(raw[at:a])
        at = b
    return b"".join([*kept, raw[at:]])


@pytest.mark.parametrize("window, hot", [(32, 20000), (32, 2), (48, 5)])
def test_every_repeated_byte_goes_and_no_other(spark, window, hot):
    texts = corpus(window + hot)
    got = spans_of(suffixes.remove_repeats(frame(spark, list(enumerate(texts))), window=window, hot=hot))
    spans = plain(texts, window)
    want = sorted((len((t or "").encode()), tuple(map(tuple, s)), cut(t, s)) for t, s in zip(texts, spans))
    assert got == want and sum(map(len, spans)) > 30


def test_ids_may_repeat_or_be_missing(spark):
    a, b = "".join(random.Random(1).choices("abcd", k=60)), "".join(random.Random(2).choices("abcd", k=60))
    rows = [(1, a), (1, a), (None, b), (1, b + "x"), (2, None), (None, None), (3, "q" + a[:40])]
    got = suffixes.remove_repeats(frame(spark, rows), window=32).select("_row.doc_id", "_row.text", "spans").collect()
    found = sorted((r.doc_id or 0, r.text or "", tuple((s.a, s.b) for s in r.spans)) for r in got)
    assert found == sorted([(1, a, ((0, 60),)), (1, a, ((0, 60),)), (0, b, ((0, 60),)), (1, b + "x", ((0, 60),)),
                            (2, "", ()), (0, "", ()), (3, "q" + a[:40], ((1, 41),))])
    assert suffixes.remove_repeats(frame(spark, [])).count() == 0


def test_windows_have_anchors_that_hang_on_their_bytes_alone(monkeypatch):
    monkeypatch.setattr(suffixes, "_STRETCH", 100)
    rnd, shape = random.Random(4), suffixes.Shape(48)
    raw = bytes(rnd.choice(b"ab") for _ in range(700))
    begin, lo, hi = suffixes.blocks_of(raw, shape)
    covered = sorted(b - x for b, y, z in zip(begin.tolist(), lo.tolist(), hi.tolist()) for x in range(y, z + 1))
    assert covered == list(range(len(raw) - 47))
    own = {b - x: x for b, y, z in zip(begin.tolist(), lo.tolist(), hi.tolist()) for x in range(y, z + 1)}
    for s, x in own.items():
        alone, y, _ = suffixes.blocks_of(raw[s:s + 48], shape)
        assert alone[0] == x == y[0]


def test_blocks_of_a_frequent_core_reach_the_sort_from_many_tasks(spark, monkeypatch):
    rnd, most, sort = random.Random(6), [], suffixes._sorted_cover
    part = lambda k: "".join(rnd.choices("abcdefgh", k=k))
    passage = part(40)
    texts = [part(30) + passage + part(30) for _ in range(400)]

    def counted(blocks, shape):
        at = blocks.select("core", F.spark_partition_id().alias("at")).collect()
        most.extend([max(Counter(r.core for r in at).values()), max(Counter((r.core, r.at) for r in at).values())])
        return sort(blocks, shape)

    monkeypatch.setattr(suffixes, "_sorted_cover", counted)
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = suffixes.remove_repeats(frame(spark, list(enumerate(texts))), window=32).select("spans").collect()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert sorted([(s.a, s.b) for s in r.spans] for r in got) == sorted([tuple(s) for s in x] for x in plain(texts, 32))
    assert most[0] > 300 and most[1] < most[0] / 2


def test_multikey_order():
    rnd = np.random.default_rng(1)
    rows = rnd.integers(0, 2, (500, 13)).astype(np.uint8)
    rows[::7] = rows[0]
    order, prefix = suffixes.multikey_order(rows)
    texts = [rows[i].tobytes() for i in order]
    assert texts == sorted(texts)
    for i in range(1, 500):
        n = next((j for j in range(13) if texts[i][j] != texts[i - 1][j]), 13)
        assert prefix[i] == n


def test_long_texts(spark):
    rnd = random.Random(9)
    shared = "".join(rnd.choices("abcdefgh ", k=900))
    long = "".join(rnd.choices("abcdefgh ", k=3_000_000))
    rows = [(1, long[:1_000_000] + shared + long[1_000_000:]), (2, shared[100:800])]
    got = {r.doc_id: [(s.a, s.b) for s in r.spans] for r in suffixes.remove_repeats(frame(spark, rows)).select("_row.doc_id", "spans").collect()}
    assert got == {1: [(1_000_100, 1_000_800)], 2: [(0, 700)]}


def test_the_query_against_the_contract(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    spans = plain([r.text for r in rows], 400)
    want = {}
    for r, s in zip(rows, spans):
        want[r.doc_id] = (len((r.text or "").encode()), sum(b - a for a, b in s), len(s),
                          hashlib.sha256(cut(r.text, s)).hexdigest())
    got = suffixes.op11_suffixes(spark, sf)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert {r[0]: tuple(r[1:]) for r in got.collect()} == want
    assert got.where(F.col("n_removed") > 0).count() > 3
