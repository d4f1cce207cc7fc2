"""Near duplicates, lines and substrings against brute force, and their defined cases."""

import hashlib
import random

import numpy as np
import pytest
import xxhash

from clickroll.llm import lines, simhash, substrings
from clickroll.llm.components import components

DOCS = "doc_id long, text string, _id string, label int, gone string"
"""Columns whose names the operators use inside."""


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], DOCS)


def corpus(n=120, seed=5):
    """Texts with copies, near copies, a passage in a third of them, and odd cases."""
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    passage = " ".join(rnd.choice(words) for _ in range(30))
    rows = []
    for i in range(n):
        text = " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 60)))
        if i % 3 == 0:
            text = f"{text}\n{passage}\nsecond line {passage}\n{rnd.choice(words)}"
        if i % 7 == 0 and rows:
            text = rows[rnd.randrange(len(rows))][1] or ""
        if i % 11 == 0:
            text = text.replace("w1 ", "w2 ", 1)
        rows.append((i, text))
    return [*rows, (n, None), (n + 1, ""), (n + 2, " \n\t "), (None, passage), (3, rows[3][1]), (5, passage)]


def test_components(spark):
    rnd = random.Random(1)
    edges = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(120)] + [(500, 500 + i) for i in range(90)] + [(7, 7)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for x in parent if any(x in e and e[0] != e[1] for e in edges)}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def slow_print(text, size=4):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))]
    counts = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g, 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(grams))


def test_fingerprints():
    rnd = random.Random(2)
    for n in (0, 1, 3, 4, 5, 200):
        text = " ".join(rnd.choice(["A", "b", "É", "cc\x0bD"]) for _ in range(n))
        assert simhash.fingerprint_of(text.encode()) % 2**64 == slow_print(text)
    long = "a b c d e " * 30_000
    assert simhash.fingerprint_of(long.encode()) % 2**64 == slow_print(long)


@pytest.mark.parametrize("distance", [0, 1, 2, 3, 4, 6])
def test_segments(distance):
    cuts = simhash.segments(distance)
    assert sum(n for _, n in cuts) == 64 and distance // len(cuts) <= 1


def brute_components(rows):
    prints = [slow_print(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                parent[find(i)] = find(j)
    first = {}
    for i, (key, _) in enumerate(rows):
        root = find(i)
        if key is not None:
            first[root] = min(first.get(root, key), key)
    return sorted((str(k), f"{p:016x}", str(first.get(find(i)))) for i, ((k, _), p) in enumerate(zip(rows, prints)))


def test_near_duplicates(spark):
    rows = corpus()
    got = simhash.near_duplicates(frame(spark, rows)).collect()
    assert sorted((str(r.doc_id), f"{r.fp % 2**64:016x}", str(r.component_id)) for r in got) == brute_components(rows)


def test_a_chain_of_near_fingerprints_is_one_group(spark):
    """Links between fingerprints whatever the cheap links found: random walks in few bits."""
    rnd = random.Random(3)
    prints = []
    for _ in range(5):
        p = rnd.getrandbits(64)
        for _ in range(80):
            for _ in range(rnd.randint(1, 4)):
                p ^= 1 << rnd.randrange(64)
            prints.append(p - 2**64 if p >= 2**63 else p)
    labelled = spark.createDataFrame([(p, p) for p in set(prints)], "fp long, label long")
    links = {(r.u, r.v) for r in simhash._label_links(labelled, 4).collect()}
    links = {tuple(sorted(x)) for x in links}
    want = {(a, b) for a in set(prints) for b in set(prints) if a < b and ((a ^ b) % 2**64).bit_count() <= 4}
    assert links == want


def test_unique_documents(spark):
    rows = corpus()
    docs = frame(spark, rows)
    want = {int(c) for k, _, c in brute_components(rows) if c != "None"}
    kept = simhash.unique_documents(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(want) and ids.count(None) == 1
    assert simhash.unique_documents(frame(spark, [])).count() == 0


# --- lines ------------------------------------------------------------------------------
def slow_chunks(text):
    rows = text.split("\n")
    hashes = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in rows]
    chunks, now = [], []
    for i, row in enumerate(rows):
        now.append(row)
        if i and (hashes[i] * lines.ROLL + hashes[i - 1]) % lines.MODULUS % lines.CHUNK_LINES == 0 or i == len(rows) - 1:
            chunks.append(now)
            now = []
    return chunks


def test_lines(spark):
    rnd = random.Random(4)
    block = [f"shared {i}" for i in range(40)]
    rows = []
    for i in range(60):
        own = [f"own {rnd.random()}" for _ in range(rnd.randint(0, 12))]
        at = rnd.randrange(30)
        rows.append((i, "\n".join(own + (block[at:at + 10] if i % 2 else []) + own[:2])))
    rows += [(60, None), (61, ""), (62, "\n\n\n"), (63, "\n\n\n"), (64, "a\r\nb"), (3, rows[3][1]), (None, rows[1][1])]
    docs = frame(spark, rows)
    seen, want = {}, []
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    for i in order:
        key, text = rows[i]
        kept = None
        if text is not None:
            kept = []
            for n, chunk in enumerate(slow_chunks(text)):
                if len(chunk) < 2 or seen.setdefault("\n".join(chunk), (key, n)) == (key, n):
                    kept += chunk
        want.append((str(key), "\n".join(kept) if kept is not None else None))
    out = lines.dedup_lines(docs)
    assert out.columns == [*docs.columns, "_n_lines", "_n_removed"]
    got = out.collect()
    assert sorted(((str(r.doc_id), r.text) for r in got), key=repr) == sorted(want, key=repr)
    assert all(r._id == "x" and r.gone == "y" for r in got) and any(r._n_removed for r in got)
    assert lines.dedup_lines(frame(spark, [])).count() == 0


def test_line_boundaries_shift_with_the_lines(spark):
    rows = [f"line {i}" for i in range(60)]
    a, b = slow_chunks("\n".join(rows)), slow_chunks("\n".join(["new"] + rows))
    assert len({tuple(x) for x in a} - {tuple(x) for x in b}) <= 2


def test_line_plan_has_no_python(spark):
    plan = lines.dedup_lines(frame(spark, corpus()))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


# --- substrings -------------------------------------------------------------------------
def slow_substrings(rows, window=13):
    first = {}
    split = [(k, (t or "").encode().split()) for k, t in rows]
    for k, w in split:
        for i in range(len(w) - window + 1):
            if k is not None:
                g = tuple(w[i:i + window])
                first[g] = min(first.get(g, k), k)
    out = []
    for k, w in split:
        hit = set()
        for i in range(len(w) - window + 1):
            if k is not None and first[tuple(w[i:i + window])] < k:
                hit.update(range(i, i + window))
        kept = [x for i, x in enumerate(w) if i not in hit]
        out.append((str(k), len(w), len(hit), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out)


def test_substrings(spark, monkeypatch):
    rows = corpus(150, 8)
    rnd = random.Random(9)
    base = [f"v{i}" for i in range(40)]
    for i in range(200, 320):       # stretches of one text with changed borders
        a = rnd.randrange(25)
        cut = base[a:a + rnd.randint(11, 16)]
        rows.append((i, " ".join([f"x{rnd.randrange(3)}"] * rnd.randint(0, 3) + cut + [f"y{rnd.randrange(3)}"] * rnd.randint(0, 2))))
    rows += [(400, "z " * 3000), (401, "z " * 12), (402, "z " * 13)]
    got = substrings.dedup_substrings(frame(spark, rows)).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got) == slow_substrings(rows)
    for r in got:
        assert hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256
        assert sum(s.b - s.a for s in r.spans) == r.n_removed
    assert substrings.dedup_substrings(frame(spark, [])).count() == 0


def test_blocks_hold_every_window_once():
    rnd = random.Random(6)
    for n in (0, 12, 13, 14, 400):
        words = substrings.Words([rnd.choice([b"a", b"b", b"c"]) for _ in range(n)])
        _, _, first, counts = words.blocks()
        assert [w for f, c in zip(first, counts) for w in range(f, f + c)] == list(range(max(0, n - 12)))
        assert not len(counts) or counts.max() <= 10


def test_settled_rows_have_an_earlier_document():
    keys, ids = np.array([1, 1, 2, 1], np.uint64), np.array([5, 3, 1, 3])
    assert substrings._settle([keys], ids).tolist() == [True, False, False, False]


def _brute_passages(rows, over):
    """Lines with words in some run of over ``over`` words that stands at an earlier, not overlapping place."""
    first, left = {}, {}
    for doc, text in sorted(rows):
        all_lines = text.split("\n")
        gone = set()
        for a in range(len(all_lines)):
            for b in range(a, len(all_lines)):
                run = all_lines[a:b + 1]
                if not run[0].split() or not run[-1].split() or sum(len(x.split()) for x in run) <= over:
                    continue
                at = first.setdefault("\n".join(run), (doc, b))
                if at[0] != doc or a > at[1]:
                    gone.update(range(a, b + 1))
        kept = [i for i, x in enumerate(all_lines) if x.split() and i not in gone]
        left[doc] = [all_lines[i] for i in kept]
    return left


def test_passages_are_cut_wherever_they_stand(spark):
    rnd = random.Random(8)
    words = [f"w{i}" for i in range(4000)]

    def line(n):
        return " ".join(rnd.choice(words) for _ in range(n))

    planted = [[line(rnd.randint(9, 40)) for _ in range(rnd.randint(2, 6))] for _ in range(25)]
    planted = [p for p in planted if sum(len(x.split()) for x in p) > 50] + [[line(60)], [line(30), "", line(30)]]
    rows = []
    for i in range(120):
        body = [line(rnd.randint(0, 30)) for _ in range(rnd.randint(2, 12))]
        at = rnd.randint(0, len(body))
        rows.append((i, "\n".join(body[:at] + planted[i % len(planted)] + body[at:])))
    rows += [(200, rows[3][1]), (201, "\n".join([line(10)] * 40))]
    out = dict(lines.cut_passages(frame(spark, rows)).select("doc_id", "text").collect())
    assert {i: [x for x in t.split("\n") if x.split()] for i, t in out.items()} == _brute_passages(rows, 50)
    late = [(i, planted[i % len(planted)]) for i in range(len(planted), 120)]
    assert all(x not in out[i].split("\n") for i, p in late for x in p if x)
    assert out[200] == ""
    odd = [(1, None), (2, ""), (None, "a\nb"), (3, "\n\n")]
    assert sorted(lines.cut_passages(frame(spark, odd)).select("doc_id", "text").collect(), key=str) == sorted(odd, key=str)
    assert lines.cut_passages(frame(spark, [])).count() == 0
    plan = lines.cut_passages(frame(spark, rows))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
