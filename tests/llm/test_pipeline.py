"""The corpus pipeline: each stage against a plain version, and a whole run over small tables."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F
from test_dedup import slow_print

import corpus_pipeline
from clickroll.llm import quality
from clickroll.session import stored

DOCS = "doc_id long, text string, lang string, source string, n_chars long, _score double, ids string, n_tokens int"
STAGES = dict(corpus_pipeline.STAGES)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 7.5, "i", 3) for i, t in rows], DOCS)


def words(rnd, n, size=400):
    return [f"w{rnd.randrange(size)}" for _ in range(n)]


@pytest.fixture(scope="module")
def corpus(sf_dir="/root/testdata/sf0.001"):
    import duckdb

    rows = duckdb.sql(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet' ORDER BY 1").fetchall()
    top = max(i for i, _ in rows)
    odd = [(top + 1, None), (top + 2, ""), (top + 3, rows[0][1]), (top + 4, (rows[1][1] or "") * 3), (None, rows[2][1])]
    return rows + odd


def test_stages_are_the_operators_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "lines", "simhash", "benchmark", "pieces"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_quality_keeps_what_is_not_rejected(spark, sf, corpus):
    docs = frame(spark, corpus)
    kept = STAGES["quality"](spark, docs, sf)
    assert kept.columns == docs.columns
    scores = quality.scored(docs, quality.quality_model(spark, sf), out="s").select("doc_id", "text", "s").collect()
    want = sorted((str(r.doc_id), r.text or "") for r in scores if r.s >= 0.7)
    got = kept.collect()
    assert sorted((str(r.doc_id), r.text or "") for r in got) == want and 0 < len(want) < len(scores)
    assert {r._score for r in got} == {7.5}


def test_lines_leave_no_repeated_passage(spark, sf):
    rnd = random.Random(3)
    passage = "\n".join(" ".join(words(rnd, 12, 10**6)) + "." for _ in range(6))
    rows = [(i, "\n".join([" ".join(words(rnd, 9, 10**6)), passage if i % 2 else "short", " ".join(words(rnd, 9, 10**6))])) for i in range(40)]
    rows += [(40, None), (41, ""), (42, passage), (43, "a\na\na")]
    out = STAGES["lines"](spark, frame(spark, rows), sf)
    got = {r.doc_id: r for r in out.collect()}
    assert len(got) == len(rows) and out.columns == frame(spark, []).columns
    # the passage, of 72 words, stays where it is first
    assert [i for i, r in got.items() if passage in (r.text or "")] == [1]
    for i, text in rows:
        own = [x for x in (text or "").split("\n") if x not in passage]
        assert all(x in (got[i].text or "") for x in own)
        assert got[i].n_chars == (None if got[i].text is None else len(got[i].text))
    bare = frame(spark, rows).drop("n_chars")
    assert STAGES["lines"](spark, bare, sf).columns == bare.columns


def test_simhash_keeps_one_of_each_group(spark, sf, corpus):
    rnd = random.Random(5)
    base = words(rnd, 300)
    near = [base[:k] + ["changed"] + base[k + 1:] for k in range(0, 290, 29)]
    rows = corpus + [(10_000 + i, " ".join(t)) for i, t in enumerate([base, *near])]
    rows = [(i, t) for i, t in rows if i is not None]
    prints = [slow_print(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 4:
                root[max(find(i), find(j))] = min(find(i), find(j))
    want = sorted({min(rows[j][0] for j in range(len(rows)) if find(j) == find(i)) for i in range(len(rows))})
    kept = STAGES["simhash"](spark, frame(spark, rows), sf)
    assert sorted(r.doc_id for r in kept.collect()) == want and len(want) < len(rows)
    assert kept.columns == frame(spark, []).columns


def test_benchmark_drops_contaminated_documents_alone(spark, sf, corpus):
    item = spark.read.parquet(f"{sf}/benchmark.parquet").orderBy("item_id").first().text
    split = lambda t: [w.decode() for w in re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").encode().lower())]
    rnd = random.Random(6)
    rows = corpus + [(20_000, " ".join(words(rnd, 40)) + " " + item), (20_001, " ".join(words(rnd, 6000)) + " " + item),
                     (20_002, " ".join(words(rnd, 50)))]
    windows = set()
    for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect():
        w = split(r.text)
        windows |= {tuple(w[i:i + 13]) for i in range(max(1, len(w) - 12))} if w else set()
    sizes = {len(w) for w in windows}

    def dirty(text):
        w, hit = split(text), set()
        for k in sizes:
            for i in range(len(w) - k + 1):
                if tuple(w[i:i + k]) in windows:
                    hit |= set(range(i, i + k))
        return bool(hit) and 20 * len(hit) >= len(w)

    want = sorted(str(i) for i, t in rows if not dirty(t))
    kept = STAGES["benchmark"](spark, frame(spark, rows), sf)
    assert sorted(str(r.doc_id) for r in kept.collect()) == want
    assert "20000" not in want and "20002" in want and kept.columns == frame(spark, []).columns


def test_pieces_equal_the_library(spark, sf, corpus):
    import public_tokenizers
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    out = STAGES["pieces"](spark, frame(spark, corpus), sf)
    want = []
    for i, t in corpus:
        ids = library.encode(t or "")
        want.append((str(i), ids, hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert sorted((str(r.doc_id), r.ids, r.decoded_sha256) for r in out.collect()) == sorted(want)


def test_stages_take_empty_tables(spark, sf):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, frame(spark, []), sf).count() == 0, name


def test_a_whole_run_is_the_stages_one_after_the_other(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, sf), "stage")
    out = corpus_pipeline.run(spark, sf)
    assert out.columns == docs.columns and 0 < out.count() < spark.read.parquet(f"{sf}/documents.parquet").count()
    key = F.struct("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert sorted(out.select(key).collect()) == sorted(docs.select(key).collect())
