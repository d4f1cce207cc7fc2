"""Collocations by stripes against plain counting, and their defined cases."""

import random
import re
from collections import Counter, defaultdict

import pytest

from clickroll.llm import collocations

DOCS = "doc_id long, text string, lang string, next string, count int, w string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, g, "x", 1, "y") for i, (t, g) in enumerate(rows)], DOCS)


def plain(rows, least, top):
    counts = defaultdict(Counter)
    for text, lang in rows:
        raw = (text or "").encode().lower()
        for piece in re.split(rb"[.,;:!?\n-\r]", raw):
            words = [w.decode() for w in re.split(rb"[ \t]+", piece) if w]
            for k in (1, 2, 3):
                counts[lang or "und"].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        n = sum(v for g, v in f.items() if len(g) == 1)
        some = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        found = []
        for g, a in some.items():
            if any(len(h) == 3 and g in (h[:2], h[1:]) and 100 * b >= 50 * a for h, b in some.items()) and len(g) == 2:
                continue
            score, _, left, right = min((1_000_000 * a * a // (f[g[:k]] * f[g[k:]]), k, f[g[:k]], f[g[k:]]) for k in range(1, len(g)))
            found.append((-score, -a, " ".join(g).encode(), left, right))
        for i, (score, a, phrase, left, right) in enumerate(sorted(found)[:top]):
            out.append((lang, i + 1, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def corpus(seed, n=150):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(12)] + ["Ünder", "ÉT\x85é", "a b", "new", "York", "city"]
    rows = []
    for i in range(n):
        text = " ".join(rnd.choice(words[: 6 + i % 13]) + rnd.choice(["", "", "", ",", ".", "\n", "\t", " ;"]) for _ in range(rnd.randint(0, 40)))
        if i % 3 == 0:
            text += " New York city hall new york new york"
        rows.append((text, rnd.choice(["en", "fr", None])))
    return [*rows, (None, "en"), ("", None), (" .,\n ", "en"), ("lone", "xx"), ("same same same same same " * 9, "xx")]


def found(spark, rows, **options):
    got = collocations.collocations(frame(spark, rows), **options).collect()
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in got)


@pytest.mark.parametrize("least, top, bits", [(10, 2000, (1 << 15, 1 << 15)), (2, 9, (1 << 25, 1 << 27)), (40, 2000, (1 << 25, 1 << 27))])
def test_phrases_equal_plain_counts(spark, least, top, bits):
    # with a bitmap of 2^15 places colliding pairs are followed in vain and change nothing
    rows = corpus(least)
    want = plain(rows, least, top)
    assert found(spark, rows, least=least, top=top, bits=bits) == want
    assert len(want) > 2 and any(x[2].count(" ") == 2 for x in want)


def test_stripes_are_the_same_however_they_are_sent(spark, monkeypatch):
    monkeypatch.setattr(collocations, "_SLICE", 50)
    monkeypatch.setattr(collocations, "_BUFFER", 7)
    rows = corpus(5)
    assert found(spark, rows, least=5, held=3) == plain(rows, 5, 2000)


def test_prefix_totals_count_what_is_not_followed(spark):
    rows = [("a b. a c a b, a", "en")] * 12 + [("a rare", "en")]
    every = collocations.stripes(frame(spark, rows), 0)
    assert {r.next: r["count"] for r in every.collect()} == {"a": 49, "b": 24, "c": 12, "rare": 1}
    hashes = every.where("count >= 10").select(collocations._word_hash("lang", "next").alias("h"))
    words = collocations._bitmap(hashes, 1 << 20)
    one = collocations.stripes(frame(spark, rows), 1, words).where("p1 = 'a'")
    assert {r.next: r["count"] for r in one.collect()} == {"b": 24, "c": 12, None: 13}


def test_defined_cases(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, None), ("one", "en")]) == []
    # counts whose squares pass 64 bits
    big = spark.sql("SELECT 6000000000L AS a, 6100000000L AS l, 7000000000L AS r")
    assert big.selectExpr("cast(1000000 as decimal(38,0)) * a * a div (cast(l as decimal(38,0)) * r) AS s").first().s == \
        1_000_000 * 6_000_000_000 ** 2 // (6_100_000_000 * 7_000_000_000)
    long = "Tick tock " * 200_000
    assert found(spark, [(long, "en")], top=1) == plain([(long, "en")], 10, 1)
