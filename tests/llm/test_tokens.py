"""Pieces, token files, chat windows and benchmark passages."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clickroll.llm import chat, decontaminate, pieces, token_files

MODEL = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
ODD = [None, "", " ", "\n", "  a", "a\n b  c\n\n", "▁x▁▁", "\x00\x1c\x85", "👍🏽 é <s> <|endoftext|> it's 1234", "a" * 5000, "w " * 50_000]


@pytest.fixture(scope="module")
def tokenizer():
    with open(BYTES, "rb") as f:
        return f.read()


def texts(n, alphabet, seed=1):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 14))) for _ in range(n)]


# --- pieces -------------------------------------------------------------------------------
def test_ids_and_spans_are_the_library_s():
    library, codec = sentencepiece.SentencePieceProcessor(model_file=MODEL), pieces.Codec(pieces.read_model(MODEL))
    assert codec.by_unit
    for text in texts(5000, "ab  \n\n▁é\t👍\x00.Thing 1\r　") + [t for t in ODD if t]:
        ids, name, sizes = codec.ids(text)
        assert ids.tolist() == library.encode(text) and name.decode() == "".join(f"{i}," for i in ids)
        begins, ends = codec.spans(text, sizes)
        if text:
            want = [(p.begin, p.end) for p in library.encode(text, return_type="proto").pieces]
            assert list(zip(begins.tolist(), ends.tolist())) == want
    codec.by_unit = False
    assert codec.ids("a  b\n▁ c")[0].tolist() == library.encode("a  b\n▁ c")


@pytest.mark.parametrize("rule", ["nfkc", "nmt_nfkc", "nfkc_cf", "identity"])
def test_compiled_character_maps(rule):
    library = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    from sentencepiece import sentencepiece_model_pb2 as pb
    spec = pb.ModelProto.FromString(library.serialized_model_proto()).normalizer_spec
    own = pieces.Normaliser(spec.precompiled_charsmap, spec.add_dummy_prefix, spec.remove_extra_whitespaces,
                            spec.escape_whitespaces)
    for text in texts(3000, "ab  \n\té👍.1①ﬁ\r　Ａẛ̣가각ｶﾞ½"):
        out, source = own(text.encode())
        assert out.decode() == library.normalize(text)
        assert len(source) == len(out) + 1 and (np.diff(source) >= 0).all() and source[-1] <= len(text.encode())


def test_pieces_of_a_table(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    model = pieces.read_model(MODEL)
    docs = spark.createDataFrame([(i, t, "p", "old") for i, t in enumerate(ODD)], "doc_id long, text string, _pieces string, ids string")
    out = pieces.with_pieces(docs, model, "ids", "begins", "ends", "decoded", "decoded_sha256", "ids_sha256")
    again = {r.doc_id: r.t for r in out.select("doc_id", pieces.decode(F.col("ids"), model).alias("t")).collect()}
    for r in out.collect():
        ids = library.encode(ODD[r.doc_id] or "")
        assert r.ids == ids and r.decoded == library.decode(ids) == again[r.doc_id]
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert len(r.begins) == len(r.ends) == len(ids)
    assert pieces.with_pieces(docs.limit(0), model).count() == 0


# --- token files ----------------------------------------------------------------------------
def test_byte_ids_are_the_library_s(tokenizer):
    library, own = Tokenizer.from_file(BYTES), token_files.ByteEncoder(tokenizer)
    some = texts(5000, ["a", "b ", " ", "\n", "'s", "é", "1", "½", "　", "\x1c", "\xa0", "_", "!", "<|endoftext|>", "👍", "\r\n",
                        "Ⅷ", "\x85"]) + [t for t in ODD if t]
    assert [np.frombuffer(own.encode(t), own.kind).tolist() for t in some] == [library.encode(t, add_special_tokens=False).ids for t in some]


def test_single_pieces_need_no_split(tokenizer, monkeypatch):
    library = Tokenizer.from_file(BYTES)
    some = [f"Word{'abcdefghij'[i % 10]} wört{'xyz'[i % 3]}lich, 4929348385146306 ### {i}... (\n\t_-~ ÿ\u024f end{'q' * (i % 25)}" for i in range(60)]
    want = [library.encode(t, add_special_tokens=False).ids for t in some]
    monkeypatch.setattr(token_files.ByteEncoder, "_unit", lambda self, unit: self.pack(library.encode(unit, add_special_tokens=False).ids))
    own = token_files.ByteEncoder(tokenizer, memo=40)
    own.library = None          # new plain words do not go through its split
    for group in (some[:5], some, some[30:]):
        for t, units in zip(group, own.split(group), strict=True):
            assert np.frombuffer(own.encode(t, units), own.kind).tolist() == want[some.index(t)]


def test_perfect_hash():
    for n in (0, 1, 2, 1000, 20_000):
        hashes = token_files.key_hashes([str(i) for i in range(n)])
        table = token_files.PerfectHash.build(hashes)
        assert sorted(table.slots(hashes).tolist()) == list(range(n))
    with pytest.raises(ValueError):
        token_files.PerfectHash.build(np.array([5, 5], np.uint64))


def test_token_files(spark, tmp_path, tokenizer):
    library = Tokenizer.from_file(BYTES)
    rows = [(i, t) for i, t in enumerate(ODD)] + [(i, f"text {i}") for i in range(100, 160)]
    rows += [(130, "again"), (130, "again"), (-4, "negative"), (None, "no key")]
    docs = spark.createDataFrame([(i, t, "k") for i, t in rows], "doc_id long, text string, _k string")
    folder = str(tmp_path / "t")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        manifest = token_files.write_shards(docs, folder, tokenizer).persist()
        assert manifest.count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    got = token_files.read_shards(manifest, folder).orderBy("start").collect()
    ids = {}
    for k, t in rows:
        ids.setdefault(k, []).append([*library.encode(t or "", add_special_tokens=False).ids, 0])
    order = [r.key for r in got]
    assert order == sorted(order, key=lambda k: (k is not None, int(k or 0))) and len(got) == len(rows)
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    crc = lambda x: zlib.crc32(np.array(x, "<u4").tobytes())
    assert sorted((str(r.key), r.n_tokens, r.ids_crc32) for r in got) == sorted(
        (str(k), len(x), crc(x)) for k, xs in ids.items() for x in xs)
    store = token_files.TokenStore(manifest, folder)
    for key in (None, "130", "-4", "107", "1"):
        want = ids[None if key is None else int(key)]
        assert sorted(x.tolist() for x in store.ids(key)) == sorted(want)
    assert store.ids("131072") == store.ids("77") == []
    assert not [p for p in (tmp_path / "t").iterdir() if p.name.startswith("_")]
    none = token_files.write_shards(docs.limit(0), folder + "0", tokenizer)
    assert token_files.read_shards(none, folder + "0").count() == 0


# --- chat -----------------------------------------------------------------------------------
def test_template_is_reversible():
    for text in texts(4000, ["\\", "#", "### ", "</turn>", "<", "/turn>", "\n", "a", ": ", "user"]):
        whole = chat.turn_head(text) + chat.escape(text) + chat.END + chat.turn_head("b") + chat.END
        assert [(r, t) for r, t, _, _ in chat.parsed(whole)] == [(text, text), ("b", "")]


@pytest.mark.parametrize("budget,history", [(1, 0), (60, 20), (60, 0), (10_000, 100)])
def test_chat_windows(spark, tokenizer, budget, history):
    rnd = random.Random(budget)
    rows = []
    for c in range(12):
        for n in range(rnd.randint(1, 14)):
            role = "system" if n == 0 and c % 2 else ["user", "assistant"][n % 2]
            rows.append((c, n, role, " ".join(["### word"] * rnd.randint(0, 12))))
    rows += [(50, 0, None, None), (50, None, "assistant", "</turn>"), (None, 0, "assistant", "x"), (60, 0, "system", "alone"),
             (70, 1, "user", "b"), (70, 1, "user", "a"), (70, 1, "assistant", "z"), (80, 0, "assistant", "long " * 3000)]
    table = spark.createDataFrame([(*r, "e") for r in rows], "conv_id long, turn long, role string, text string, loss string")
    out = chat.format_conversations(table, tokenizer, budget=budget, history=history).persist()
    groups = {}
    for c, n, r, t in sorted(rows, key=lambda x: (x[1] is not None, x[1] or 0, x[2] or "", x[3] or "")):
        groups.setdefault(c, []).append((r or "", t or ""))
    windows = {}
    for r in out.orderBy("window").collect():
        windows.setdefault(r.conv, []).append(r)
    assert set(windows) == set(groups)
    for c, turns in groups.items():
        at, said = 0, []
        for n, w in enumerate(windows[c]):
            got = [(r, t) for r, t, _, _ in chat.parsed(w.text)]
            fixed = turns[:1] if turns[0][0] == "system" and n else []
            back = w.repeated - len(fixed)
            assert got == fixed + turns[at - back:at + w.turns - w.repeated]
            at += w.turns - w.repeated
            said += [chat.unescape(w.text[s.a:s.b]) for s in w.loss]
            assert w.tokens <= budget or w.turns - w.repeated <= 1 + (n == 0 and turns[0][0] == "system")
        assert at == len(turns) and said == [t for r, t in turns if r == "assistant"]
    for r in chat.read_back(out).collect():
        turns = groups[r.conv]
        assert r.n_turns == len(turns)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        loss = "".join(b for a, b in turns if a == "assistant")
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.format_conversations(table.limit(0), tokenizer).count() == 0


# --- benchmark ------------------------------------------------------------------------------
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slow_hits(docs, items, window=13):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    parts = {}
    for key, text in items:
        w = split(text)
        for i in range(max(1, len(w) - window + 1)) if w else []:
            parts.setdefault(tuple(w[i:i + window]), set()).add(key)
    out = []
    for key, text in docs:
        w, hit, ids = split(text), set(), set()
        for size in {len(p) for p in parts}:
            for i in range(len(w) - size + 1):
                if tuple(w[i:i + size]) in parts:
                    hit.update(range(i, i + size))
                    ids |= parts[tuple(w[i:i + size])]
        out.append((str(key), len(w), len(hit), ",".join(sorted(str(i) for i in ids if i is not None))))
    return sorted(out)


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_decontamination(spark, block_bytes):
    rnd = random.Random(3)
    words = ["the", "of", "Écu", "x1", "B", "rare"] + [f"w{i}" for i in range(12)]
    some = lambda n: [rnd.choice(words) for _ in range(n)]
    items = [(i, " ".join(some(rnd.randint(1, 30)))) for i in range(8)] + [
        (8, "the of"), (8, "the " * 20), (9, ""), (10, None), (None, "rare x1 rare"), (11, "never seen words here")]
    docs = []
    for i in range(80):
        item = rnd.choice(items)[1] or ""
        part = item.split()[rnd.randint(0, 3):]
        docs.append((i, " ".join(some(rnd.randint(0, 30)) + (part if i % 3 else []) + some(rnd.randint(0, 30))).replace(" ", rnd.choice([" ", "-", "\n"]))))
    docs += [(80, None), (81, ""), (82, "the " * 3000), (3, docs[3][1]), (5, "the of"), (None, "rare x1 rare")]
    frame = spark.createDataFrame([(i, t, "a", 1) for i, t in docs], "doc_id long, text string, _id string, n_hit int")
    bench = spark.createDataFrame([(i, t) for i, t in items], "item_id long, text string")
    found = decontaminate.decontaminate(frame, bench, block_bytes=block_bytes)
    got = sorted((str(r._id), r.n_words, r.n_hit, ",".join(r["items"])) for r in found.collect())
    assert got == slow_hits(docs, items)
    clean = decontaminate.clean_documents(frame, bench, block_bytes=block_bytes)
    want = sorted(k for k, n, h, _ in slow_hits(docs, items) if not (h and 20 * h >= n))
    assert clean.columns == frame.columns and sorted(str(r.doc_id) for r in clean.collect()) == want
    assert decontaminate.decontaminate(frame.limit(0), bench).count() == 0
    assert {r.n_hit for r in decontaminate.decontaminate(frame, bench.limit(0)).collect()} == {0}


def test_proximity(spark):
    frame = spark.createDataFrame([(1, "zeta one two alpha " + "pad " * 50), (2, "alpha " + "pad " * 60 + "zeta")],
                                  "doc_id long, text string")
    bench = spark.createDataFrame([(1, "alpha pad zeta")], "item_id long, text string")
    got = {r._id: (r.n_near, r.n_hit) for r in decontaminate.decontaminate(frame, bench).collect()}
    assert got == {"1": (1, 0), "2": (0, 0)}


def test_intersection():
    lists = [(0, np.array([1, 5, 9])), (2, np.array([3, 11, 12]))]
    assert decontaminate.intersect(lists).tolist() == [1, 9]
    assert decontaminate.near([np.array([1, 50]), np.array([60, 70])], 11) and not decontaminate.near([np.array([1]), np.array([9])], 8)
