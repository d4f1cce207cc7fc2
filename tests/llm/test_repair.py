"""Repair of conversations against a plain search, in small chunks, and its defined cases."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from clickroll.llm import repair

SAY = {0: "u", 1: "u", 2: "a", 3: "u"}
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}


def plain(rows):
    """Report and repaired digest of the rows of one conversation, in order: (turn, role, text)."""
    seen, faults = set(), []
    for _, role, text in rows:
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated"
        faults.append(fault)
        seen.add((role, text))
    n = len(rows)
    best = {}
    for i in range(n, -1, -1):
        level = {q: [(0, "", ())] if i == n and q in (0, 3) else [] for q in range(4)}
        if i < n:
            role, fault, more = rows[i][1], faults[i], 5 if faults[i] == "truncated" else 0
            for q in range(4):
                cost, letters, said = best[i + 1][q]
                level[q].append((cost + 2, "D" + letters, said))
                if fault in ("blank", "duplicate"):
                    continue
                then = STEP.get((q, role[:1]))
                if then is not None:
                    cost, letters, said = best[i + 1][then]
                    level[q].append((cost + more, "K" + letters, ((role, rows[i][2]), *said)))
                cost, letters, said = best[i + 1][STEP[q, SAY[q]]]
                level[q].append((cost + 1 + more, "R" + letters, ((SAY[q], rows[i][2]), *said)))
        for _ in range(4):
            for q in range(4):
                then = STEP[q, SAY[q]]
                if level[then]:
                    cost, letters, said = min(level[then], key=lambda x: x[:2])
                    level[q].append((cost + 5, "I" + letters, ((SAY[q], ""), *said)))
        best[i] = {q: min(level[q], key=lambda x: x[:2]) for q in range(4)}
    cost, letters, said = best[0][0]
    names = {"u": "user", "a": "assistant"}
    body = "\n".join(f"{names.get(r, r)}:{t}" for r, t in said)
    turns = {t for t, _, _ in rows if t is not None}
    bad = sum(x[1][:1] + y[1][:1] not in ("su", "ua", "au") for x, y in zip(rows, rows[1:]))
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
            bad, cost, letters, hashlib.sha256(body.encode()).hexdigest())


def talks(n, seed, roles=("user", "assistant", "system", "tool", "user", "assistant")):
    rnd = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rnd.choice([0, 1, 2, 5, 9, 40])):
            if rnd.random() < 0.9:
                text = rnd.choice(["yes.", "no", "What?", " \n", "", "ok. ", "fine!\n"]) if rnd.random() < 0.6 else f"{t} words."
                rows.append((c, t * rnd.choice([1, 1, 1, 2]), rnd.choice(roles), text))
    return rows


def found(spark, rows, schema="conv_id long, turn long, role string, text string"):
    report, lines = repair.repair_conversations(spark.createDataFrame(rows, schema))
    got = report.join(repair._digests(lines), "k", "left").collect()
    empty = hashlib.sha256().hexdigest()
    return {r.k: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256 or empty) for r in got}


def in_order(rows):
    """By turn, and equal turns as the operator has them: by role, then by a hash of the text."""
    import xxhash
    signed = lambda t: (h := xxhash.xxh64_intdigest(t.encode(), 42)) - (h >> 63 << 64)
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], signed(r[2])))


@pytest.mark.parametrize("bits", [1, 2, 12])
def test_reports_and_turns_equal_a_plain_search(spark, monkeypatch, bits):
    monkeypatch.setattr(repair, "CHUNK_BITS", bits)
    rows = talks(40, bits)
    want = {}
    for c in {r[0] for r in rows}:
        want[f"v{c}"] = plain(in_order([r[1:] for r in rows if r[0] == c]))
    assert found(spark, rows) == want


def test_one_long_conversation_lies_in_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(repair, "CHUNK_BITS", 4)
    # every turn but the last of the user: what is cheapest at the start hangs on the end
    rows = [(1, t, "user", f"{t}.") for t in range(700)] + [(1, 700, "assistant", "end.")]
    rnd = random.Random(3)
    rows += [(2, t, rnd.choice(["user", "assistant"]), f"{t}{rnd.choice(['.', ''])}") for t in range(900)]
    want = {f"v{c}": plain(in_order([r[1:] for r in rows if r[0] == c])) for c in (1, 2)}
    assert found(spark, rows) == want
    faults = repair._faults(repair._sorted_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"),
                                                 "conv_id", "turn", "role", "text"))
    chunks, passes = repair._settled(repair._chunks(faults))
    assert chunks.count() > 90 and 0 < passes < 60


def test_fix_up_passes_stop_where_costs_meet():
    costs = repair._Costs()
    codes = "".join(random.Random(1).choice("bcbcjk") for _ in range(300))
    front = costs.front(codes, repair._LAST)
    for after in ((0, 10, 5, 0), (0, 0, 0, 0), (3, 0, 5, 2)):
        assert costs.front(codes, after, repair._LAST, front) == costs.front(codes, after)


def test_defined_cases(spark):
    rows = [(None, None, None, None), (None, 1, "user", "x."), (7, None, "user", "a."), (7, None, "assistant", "b."),
            (8, -9223372036854775808, "user", "a."), (8, 9223372036854775807, "assistant", "b."),
            (9, 1, "", "no role."), (10, 1, "user", "a." * 300000)] + [(11, 1, "user", "same.")] * 50
    got = found(spark, rows)
    assert got["n"][1:7] == (1, 0, 0, 1, 4, "DD")
    # without numbers turns go by role: assistant, user
    assert got["v7"][:7] == (0, 0, 0, 0, 0, 2, "RR")
    assert got["v8"][0] is not None and got["v9"][6] == "D" and got["v10"][6] == "D"
    assert got["v11"][2] == 49 and got["v11"][6] == "D" * 50
    assert found(spark, [], "conv_id long, turn long, role string, text string") == {}
    other = spark.createDataFrame([("x y", 1, "user", "a.", 1, "q")], "conv string, no int, who string, text string, k int, at string")
    report, _ = repair.repair_conversations(other, conv="conv", turn="no", role="who")
    assert report.first().k == "vx y"


def test_the_query_against_the_contract(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = {}
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{c}:{t}".encode()) % 20
        out = want.setdefault(c, [])
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(t, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    got = repair.op12_repair(spark, sf)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert {r[0]: tuple(r[1:]) for r in got.collect()} == {c: plain(in_order(v)) for c, v in want.items()}
    assert any(not v for v in want.values()) or len(want) == spark.read.parquet(f"{sf}/conversations.parquet").select(
        F.countDistinct("conv_id")).first()[0]
