import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from trolley.llm import audit

# Workers get the functions with the sizes that a test sets.
cloudpickle.register_pickle_by_value(audit)

ROLES = ["user", "assistant", "system", "tool", ""]


def cheapest(rows):
    """Cost and audit of rows ``initial, gone, truncated`` by all audits with up to two insertions at a place."""
    # Audit, roles written and cost; none is compared with another before the end.
    layers = [("", "", 0)]
    for row in [*rows, None]:
        put = {(a, r): c for a, r, c in layers}
        for _ in range(2):
            put |= {(a + "I", r + n): c + 5 for (a, r), c in list(put.items()) for n in "ua"}
        layers = [(a, r, c) for (a, r), c in put.items() if re.fullmatch("s?(ua)*u?", r)]
        if row is None:
            break
        initial, gone, truncated = row
        now = []
        for a, r, c in layers:
            now.append((a + "D", r, c + 2))
            if not gone:
                now += [(a + "K", r + initial, c + 5 * truncated)] * bool(initial)
                now += [(a + "R", r + n, c + 1 + 5 * truncated) for n in "ua"]
        layers = [x for x in now if re.fullmatch("s?(ua)*u?", x[1])]
    done = [(c, a, r) for a, r, c in layers if re.fullmatch("(s?(ua)+)?", r)]
    cost, text, _ = min(done)
    return cost, text


def test_least_audits_of_short_conversations():
    random.seed(3)
    kinds = [("u", False, False), ("a", False, False), ("s", False, False), ("t", False, False), ("", False, False), ("u", False, True), ("a", False, True), ("u", True, False)]
    cases = [list(c) for n in range(4) for c in itertools.product(kinds, repeat=n)]
    cases = random.sample(cases, 150) + [[random.choice(kinds) for _ in range(5)] for _ in range(12)]
    for rows in cases:
        want = cheapest(rows)
        assert audit.whole_audit([audit.transfers(rows, (0,))] if rows else []) == want
        for cut in range(1, len(rows)):
            slices = [audit.transfers(rows[:cut], (0,)), audit.transfers(rows[cut:], (0, 1, 2, 3))]
            assert audit.whole_audit(slices) == want


def test_equal_hashes_do_no_harm(monkeypatch):
    random.seed(8)
    kinds = [("u", False, False), ("a", False, True), ("s", False, False), ("t", False, True), ("u", True, False)]
    rows = [[random.choice(kinds) for _ in range(40)] for _ in range(30)]
    want = [audit.whole_audit([audit.transfers(r, (0,))]) for r in rows]
    monkeypatch.setattr(audit, "MODULUS", 2)
    assert [audit.whole_audit([audit.transfers(r, (0,))]) for r in rows] == want


def plain(rows):
    """The contract, row by row: rows of conv_id, turn, role, text."""
    out = {}
    for conv in {r[0] for r in rows}:
        kept = []
        for _, turn, role, text in (r for r in rows if r[0] == conv):
            role, text = " " if role is None else role, " " if text is None else text
            key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
            draw = zlib.crc32(key.encode()) % 20
            text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
            role = "user" if draw == 4 else role
            kept += [(turn, role, text)] * (0 if draw == 0 else 2 if draw == 3 else 1)
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns = {t for t, _, _ in kept if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        seen, states, counts = set(), [], [0, 0, 0]
        for _, role, text in kept:
            bare = text.strip(" \t\n\v\f\r")
            fault = 0 if not bare else 1 if (role, text) in seen else 2 if bare[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            states.append((role[:1], fault in (0, 1), fault == 2))
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in itertools.pairwise(states))
        cost, text = audit.whole_audit([audit.transfers(states, (0,))] if states else [])
        lines, at, last = [], 0, ""
        for edit in text:
            role, body = (kept[at][1], kept[at][2]) if edit != "I" else ("", "")
            at += edit != "I"
            if edit != "D":
                role = role if edit == "K" else "assistant" if last == "u" else "user"
                lines.append(f"{role}:{body}")
                last = role[0]
        out[conv] = (gaps, *counts, illegal, cost, text, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def found_of(df):
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    rows = df.collect()
    assert len({r["conv_id"] for r in rows}) == len(rows)
    return {r["conv_id"]: tuple(r[c] for c in names) for r in rows}


def test_given_conversations(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in df.collect()]
    assert found_of(audit.damaged_and_repaired(df)) == plain(rows)


@pytest.mark.parametrize("size", [audit.SLICE, 7])
def test_odd_rows_and_a_very_long_conversation(spark, monkeypatch, size):
    random.seed(5)
    texts = ["Yes.", "No", " \t", "", None, "A b?\n", "\xa0", "x" * 50_000 + ".", "é!", "?!."]
    rows = [(c, random.choice([None, *range(12)]), random.choice([*ROLES, "User", None]), random.choice(texts)) for c in [None, -1, *range(25)] for _ in range(random.randint(1, 9))]
    rows += rows[:40:3] + [(99, t, ("user", "assistant")[t % 2], f"Text {t % 37}.") for t in range(700)]
    rows += [(98, 5, "user", "Same.")] * 60
    alone = next(k for k in range(200, 900) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    rows.append((alone, 0, "user", "Dropped."))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.withColumns({c: F.lit(1) for c in ("place", "mark", "later", "head", "again", "audit", "draw", "copy", "first")})
    monkeypatch.setattr(audit, "SLICE", size)
    want = plain(rows)
    assert want[alone] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert found_of(audit.damaged_and_repaired(df.repartition(5))) == want
    assert audit.damaged_and_repaired(df.limit(0)).count() == 0
