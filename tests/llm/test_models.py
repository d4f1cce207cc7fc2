"""Classifier, personal data and nearest neighbours."""

import random
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from clickroll.llm import ann, pii, quality


# --- quality ----------------------------------------------------------------------------
def labelled(spark):
    rnd = random.Random(1)
    docs, labels = [], []
    for i in range(400):
        good = i % 3 != 0
        words = [f"w{rnd.randrange(80)}" for _ in range(rnd.randint(5, 60))]
        text = " ".join(words) if good else " ".join(w.upper() + "$$$" for w in words)
        docs.append((i, text, len(text), "s", "score"))
        labels.append((i, int(good)))
    docs += [(1000, None, None, None, None), (1001, "", 0, None, None), (1002, "word " * 200_000, -5, None, None)]
    return (spark.createDataFrame(docs, "doc_id long, text string, n_chars long, _t string, _k string"),
            spark.createDataFrame([*labels, (5, None), (6, 7), (None, 1), (9999, 1)], "doc_id long, quality int"))


def test_quality_learns(spark):
    docs, labels = labelled(spark)
    seen = labels.where(~quality.held_out())
    model = quality.train(docs, seen, quality.Settings(buckets=512, epochs=15, metadata=("n_chars",)))
    out = quality.scored(docs, model)
    assert out.columns == [*docs.columns, "score"]
    got = {r.doc_id: r.score for r in out.collect()}
    assert len(got) == 403 and all(0 <= s <= 1 for s in got.values())
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(held) > 50 and all((got[i] >= 0.7) == (i % 3 != 0) for i in held)
    again = quality.train(docs.repartition(5), seen.repartition(3), model.settings)
    assert {r.doc_id: r.score for r in quality.scored(docs, again).collect()} == got


def test_quality_score_is_the_machine():
    rng = np.random.default_rng(3)
    s = quality.Settings(buckets=64, rank=3)
    n = 64 + len(quality.STRUCTURE)
    m = quality.Model(s, 0.3, rng.normal(size=n) / 9, rng.normal(size=(n, 3)) / 9, np.zeros(n - 64), np.ones(n - 64))
    at, x, dense = quality.inputs(b"some words and some More", (), quality.word_buckets(64))
    at, x = np.concatenate([at, np.arange(64, n)]), np.concatenate([x, np.clip(dense, -4, 4)])
    z = m.bias + m.linear[at] @ x + sum(
        m.factors[at[i]] @ m.factors[at[j]] * x[i] * x[j] for i in range(len(at)) for j in range(i))
    got = m.score(*quality.inputs(b"some words and some More", (), quality.word_buckets(64)))
    assert abs(got - 1 / (1 + np.exp(-z))) < 1e-12


def test_quality_without_labels(spark):
    docs, labels = labelled(spark)
    for some, want in ((labels.limit(0), 0.5), (labels.where("quality = 1"), 1.0)):
        scores = quality.scored(docs.limit(3), quality.train(docs, some)).collect()
        assert all(abs(r.score - want) < 1e-9 for r in scores)
    assert quality.scored(docs.limit(0), quality.train(docs.limit(0), labels)).count() == 0


# --- personal data ------------------------------------------------------------------------
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def valid(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        total = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits)))
        return 14 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def test_patterns():
    rnd = random.Random(2)
    for _ in range(20_000):
        text = "".join(rnd.choice(["a", "@", "b.c", ".", "1", "25", "255", "0", "+", "-", " ", "(", "é", "4111111111111111",
                                   "٣"]) for _ in range(rnd.randint(0, 16)))
        want = sorted((m.start(), i, m.end(), k) for i, (k, p) in enumerate(PATTERNS.items())
                      for m in re.finditer(p, text) if valid(k, m[0]))
        assert pii.spans_text(pii.pattern_spans(text)) == ",".join(f"{k}:{a}:{b}" for a, _, b, k in want)


def test_patterns_take_long_runs():
    for run in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+1" + " " * 300_000, "@" * 100_000, "a@b" * 100_000):
        pii.pattern_spans(run)


def test_skip_chain(spark):
    rnd = random.Random(4)
    rows = [(i, f"call +49 30 {rnd.randrange(10**6, 10**7)} or write a{i}@b.org, order {rnd.randrange(10**9)} of {i}")
            for i in range(120)]
    rows += [(200, None), (201, ""), (202, "clean 2019 text 4 5 and 123456789012"),
             (203, "first +49 30 1234567 then again 49 30 1234567 and 555 666 777"), (204, "x " * 100_000 + "a@b.org")]
    docs = spark.createDataFrame([(i, t, "c") for i, t in rows], "doc_id long, text string, f string")
    field = pii.train(docs, pii.Settings(train_rows=50))
    got = {r.doc_id: r.f for r in docs.select("doc_id", pii.personal_data(F.col("text"), field).alias("f")).collect()}
    assert got[203].spans == got[203].base + ",phone:32:45" and got[203].n_phone == 1
    assert [got[i].spans for i in (200, 201, 202)] == ["", "", ""] and got[204].n_email == 1
    assert all(got[i].spans == got[i].base != "" for i in range(120))
    assert pii.train(docs.limit(0)).skip == 4.0


def test_messages_are_exact_on_a_chain():
    rng = np.random.default_rng(5)
    k = pii.NONE + 1
    f = pii.Field(pii.Settings(rounds=200), rng.normal(size=(pii.N_FEATURES, k)), rng.normal(size=(k, k)), 1.0)
    x = rng.normal(size=(3, pii.N_FEATURES))
    g = pii.Graph([(0, 1)] * 3, x, np.array([-1, -1, 2]), np.array([[0, 1], [1, 2]]), np.zeros((0, 2), np.int64))
    own = x @ f.unary
    table = np.zeros((k, k, k))
    for a in range(k):
        for b in range(k):
            for c in range(k):
                table[a, b, c] = np.exp(own[0, a] + own[1, b] + f.chain[a, b] + f.chain[b, c]) * (c == 2)
    table /= table.sum()
    assert np.allclose(f.marginals(g)[:2], [table.sum(axis=(1, 2)), table.sum(axis=(0, 2))], atol=1e-3)


# --- neighbours -----------------------------------------------------------------------------
def test_neighbours(spark):
    rng = np.random.default_rng(6)
    v = rng.normal(size=(1500, 24)).astype(np.float32)
    v[900:1200] = v[10]                       # a vector of many rows
    v[1200:1250] = v[1200:1250] * 0.02 + v[20]
    v[1250] = v[30] * 2                       # the same direction
    rows = [(i, [float(x) for x in r], "h") for i, r in enumerate(v)]
    odd = [(2000, None), (2050, []), (2100, [0.0] * 24), (2150, [float("nan")] * 24), (2200, [1.0, None]),
           (None, [1.0] * 24), (2250, [1.0, 2.0]), (2300, [1.0, 2.5])]
    rows += [(i, x, "h") for i, x in odd]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, h string")
    got = {}
    for r in ann.nearest_neighbours(df, F.col("vec_id") % 50 == 0, settings=ann.Settings(block_rows=400)).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.match_id, r.score))
    e = v.astype(float)
    norms = np.sqrt((e * e).sum(axis=1))
    hits = total = 0
    for q in range(0, 1500, 50):
        scores = (e @ e[q]) / (norms * norms[q])
        scores[q] = -9
        best = np.lexsort((np.arange(1500), -np.round(scores, 12)))[:5]
        found = sorted(got.pop(q))
        assert [r for r, _, _ in found] == [1, 2, 3, 4, 5]
        assert all(abs(scores[m] - s) < 1e-12 for _, m, s in found)
        hits += len({m for _, m, _ in found} & set(best.tolist()))
        total += 5
    assert hits / total > 0.95
    assert {q: [m for _, m, _ in x] for q, x in got.items()} == {2250: [2300], 2300: [2250]}
    empty = ann.nearest_neighbours(df.limit(0), F.lit(True))
    assert empty.count() == 0


def test_neighbours_of_repeated_ids(spark):
    """An id repeated more than k+1 times hides no other; an id of several vectors mixes no queries."""
    a, b, c = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.6, 0.8, 0.0]
    near = [[0.0, 1.0, 0.01 * i] for i in range(1, 5)]
    rows = [(7, a)] * 9 + [(9, a), (20, c)] + [(30, a), (30, b)] + [(30, x) for x in near] + [(40, c)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in ann.nearest_neighbours(df, F.col("vec_id").isin(9, 30), k=3).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.match_id, round(r.score, 6)))
    assert sorted(got[9]) == [(1, 7, 1.0), (2, 30, 1.0), (3, 20, 0.6)]
    ranks = sorted(got[30])
    assert [m for r, m, _ in ranks if r == 1].count(7) == 1 and [m for r, m, _ in ranks if r == 1].count(20) == 5
    assert all([r for r, _, _ in ranks].count(n) == 6 for n in (1, 2, 3)) and all(m != 30 for _, m, _ in ranks)


def test_recall_over_several_blocks(spark):
    """20,000 vectors without any grouping, and a family of near copies: nearly all true neighbours are found."""
    rng = np.random.default_rng(8)
    v = rng.normal(size=(20_000, 32))
    v[5_000:6_000] = v[5_000] + 0.05 * rng.normal(size=(1_000, 32))
    at = np.arange(len(v), dtype=np.int64)
    df = spark.createDataFrame(pa.table({"vec_id": at, "embedding": pa.array(v.tolist())}))
    found = ann.nearest_neighbours(df, F.col("vec_id") % 50 == 0, settings=ann.Settings(block_rows=6_000)).toPandas()
    got = {q: set(g.match_id) for q, g in found.groupby("query_id")}
    unit = v / np.sqrt((v * v).sum(axis=1))[:, None]
    asked = np.arange(0, len(v), 50)
    cosines = unit[asked] @ unit.T
    cosines[np.arange(len(asked)), asked] = -9
    true = np.argsort(-cosines, axis=1, kind="stable")[:, :5]
    assert sum(len(got[q] & set(t.tolist())) for q, t in zip(asked.tolist(), true, strict=True)) >= 0.99 * true.size


def test_search_ends_with_all_vectors():
    """With no close vector the windows widen to everything, and the answer is exact."""
    rng = np.random.default_rng(7)
    v = rng.normal(size=(300, 8))
    block = ann.Block(np.arange(300), v, ann.Settings(projections=16, sure=0.9999999))
    q = rng.normal(size=8)
    at, cosines = block.nearest(q, 300)
    assert len(at) == 300 and (np.diff(cosines) <= 1e-12).all()
