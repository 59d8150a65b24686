"""Repair of conversations against a plain search over all edits."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from chatloom.llm import structure_repair as repair

BLANKS = " \t\n\x0b\x0c\r"


def plain(conv_id, rows):
    """The contract row by row: the best (cost, letters) for each state, with every insert tried."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    after = []
    for turn, role, text in rows:
        fault = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else "".join(c for c in text if c not in ".!?") if fault == 2 else text
        after += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    after.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
    turns = {t for t, _, _ in after if t is not None}
    counts = {"blank": 0, "duplicate": 0, "truncated": 0}
    seen, kinds = set(), []
    for _, role, text in after:
        bare = text.strip(BLANKS)
        kind = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        kinds.append(kind)
        if kind:
            counts[kind] += 1
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(after, after[1:], strict=False))

    def insert(best):
        for _ in range(3):
            for state, to in ((0, 2), (1, 2), (2, 3), (3, 2)):
                if state in best:
                    cost, letters, out = best[state]
                    new = (cost + 2, letters + "I", [*out, ("user" if to == 2 else "assistant", "")])
                    if to not in best or new < best[to]:
                        best[to] = new
        return best

    best = insert({0: (0, "", [])})
    for (_, role, text), kind in zip(after, kinds, strict=True):
        new = {}

        def offer(to, cost, letters, out, new=new):
            if to not in new or (cost, letters) < new[to][:2]:
                new[to] = (cost, letters, out)

        for state, (cost, letters, out) in best.items():
            offer(state, cost + 3, letters + "D", out)
            if kind in ("blank", "duplicate"):
                continue
            more, expected = int(kind == "truncated"), "a" if state == 2 else "u"
            to = 3 if state == 2 else 2
            if role[:1] == "s" and state == 0:
                offer(1, cost + more, letters + "K", [*out, (role, text)])
            if role[:1] == expected:
                offer(to, cost + more, letters + "K", [*out, (role, text)])
            offer(to, cost + more + 2, letters + "R", [*out, ("user" if expected == "u" else "assistant", text)])
        best = insert(new)
    cost, audit, out = min(best[s] for s in (0, 3) if s in best)
    if not after:
        cost, audit, out = 0, "", []
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    text = "\n".join(f"{r}:{x}" for r, x in out)
    return (conv_id, gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


COLUMNS = ["conv_id", *repair.COUNTS, "audit", "repaired_sha256"]


def compare(df):
    grouped = {}
    for r in df.select("conv_id", "turn", "role", "text").collect():
        grouped.setdefault(r.conv_id, []).append((r.turn, r.role, r.text))
    want = sorted((plain(c, rows) for c, rows in grouped.items()), key=repr)
    got = repair.reports(repair.damage(df))
    assert got.columns == COLUMNS
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want
    return want


def test_tables_stay_small():
    tables = repair.tables()
    assert len(tables.vectors) < 200 and tables.then.shape == (len(tables.vectors), repair.SYMBOLS**repair.BLOCK)


def test_edits_against_all_scripts():
    """Every edit script of short conversations, without any dynamic program."""
    import re

    rng = random.Random(3)
    for _ in range(400):
        symbols = [rng.randrange(9) for _ in range(rng.randint(0, 3))]
        scripts = []

        def grow(i, letters, roles, cost, inserts, symbols=symbols, scripts=scripts):
            if i == len(symbols) and re.fullmatch("(s?(ua)+)?", roles):
                scripts.append((cost, letters))
            if inserts < 4:
                for role in "ua":
                    grow(i, letters + "I", roles + role, cost + 2, inserts + 1)
            if i < len(symbols):
                grow(i + 1, letters + "D", roles, cost + 3, inserts)
                if symbols[i] != repair.GONE:
                    initial, more = "suax"[symbols[i] // 2], symbols[i] % 2
                    grow(i + 1, letters + "K", roles + initial, cost + more, inserts)
                    for role in "ua":
                        grow(i + 1, letters + "R", roles + role, cost + more + 2, inserts)

        grow(0, "", "", 0, 0)
        assert repair.tables().edits(np.array(symbols, np.int8)) == min(scripts)


def test_random_conversations(spark):
    rng = random.Random(7)
    rows = []
    for conv in range(300):
        for turn in range(rng.randint(1, 14)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "", "unknown"])
            text = rng.choice(["Hello.", "Hi!", "no end", "", None, " \t", "Why?", "a. b", f"own {turn}.", f"own {turn}", "é。"])
            rows.append((conv, rng.choice([turn, turn, turn + 1, None, -turn]), role, text))
    compare(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))


def test_long_conversation(spark):
    rng = random.Random(8)
    rows = [(1, t, rng.choice(["user", "assistant", "system"]), f"t{rng.randrange(900)}{rng.choice(['.', ''])}") for t in range(1_500)]
    want = compare(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert len(want[0][7]) > 1_000


def test_odd_rows(spark):
    rows = [(None, 0, "user", "Hi.", 1), (None, 1, "assistant", "x " * 50_000 + ".", 1), (None, None, None, None, 1),
            (5, None, "user", "a.", 2), (5, None, "user", "a.", 2), (5, None, "assistant", "b", 2), (6, 3, "user", None, 3)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, copies int")
    compare(df)
    assert repair.reports(repair.damage(df.filter("false"))).count() == 0
    dropped = next(t for t in range(1_000) if zlib.crc32(f"9:{t}".encode()) % 20 == 0)
    got = compare(spark.createDataFrame([(9, dropped, "user", "Hi.")], "conv_id long, turn long, role string, text string"))
    assert got == [(9, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_repaired_rows(spark, small):
    df = small["conversations"]
    rows = repair.repair(repair.damage(df)).collect()
    by = {}
    for r in sorted(rows, key=lambda r: (r.conv_id, r.position)):
        by.setdefault(r.conv_id, []).append(r)
    for r in repair.reports(repair.damage(df)).collect():
        own = by.get(r.conv_id, [])
        assert hashlib.sha256("\n".join(f"{x.role}:{x.text}" for x in own).encode()).hexdigest() == r.repaired_sha256
        assert "".join(x.edit for x in own) == r.audit.replace("D", "")


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_given_tables(spark, sf):
    from chatloom.llm.registry import table

    compare(table(spark, f"/root/testdata/sf{sf}", "conversations"))
