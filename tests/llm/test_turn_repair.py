"""Repairs against all ways to edit, and whole results against a plain version."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from lotkeeper.llm import turn_repair as T

LEGAL = re.compile(r"(s?(ua)+)?")


def every_repair(letters):
    """(cost, audit) of the best repair, trying every edit of every row with up to two inserts in each gap."""
    initials, faults = T._read(letters)
    best = None
    for inserts in itertools.product(range(3), repeat=len(letters) + 1):
        for edits in itertools.product("KRD", repeat=len(letters)):
            if any(e != "D" and f >= 2 for e, f in zip(edits, faults)):
                continue
            for roles in itertools.product("ua", repeat=sum(inserts) + edits.count("R")):
                roles, out, audit, cost = iter(roles), "", "", 0
                for gap in range(len(letters) + 1):
                    for _ in range(inserts[gap]):
                        out, audit, cost = out + next(roles), audit + "I", cost + 2
                    if gap < len(letters):
                        e = edits[gap]
                        audit += e
                        cost += {"K": 0, "R": 2, "D": 3}[e] + (e != "D" and faults[gap] == 1)
                        out += {"K": "suax"[initials[gap]], "R": "", "D": ""}[e]
                        if e == "R":
                            out += next(roles)
                if LEGAL.fullmatch(out) and (best is None or (cost, audit) < best):
                    best = (cost, audit)
    return best


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_best_of_all_repairs(n):
    rng = random.Random(n)
    for _ in range(12 if n == 3 else 60):
        letters = "".join(T.letter(rng.randrange(4), rng.choice([0, 0, 1, 2, 3])) for _ in range(n))
        assert T.repair(letters) == every_repair(letters), letters


def by_states(letters):
    """The cheapest (cost, audit) for every state after every row; equal to the above, and quick."""
    initials, faults = T._read(letters)
    best = {0: (0, "")}

    def grown(table):
        table = dict(table)
        for _ in range(3):
            for s, (c, a) in list(table.items()):
                table[T._NEXT[s]] = min(table.get(T._NEXT[s], (10**9, "")), (c + 2, a + "I"))
        return table

    for initial, fault in zip(initials, faults):
        fresh = {}
        for s, (c, a) in grown(best).items():
            for e, step, price, after in T._edges(initial, fault, s):
                if step:
                    fresh[after] = min(fresh.get(after, (10**9, "")), (c + price, a + e))
        best = fresh
    return min(v for s, v in grown(best).items() if s in (0, 3))


def test_long_conversations():
    rng = random.Random(5)
    for n in (8, 9, 30, 500):
        for _ in range(30):
            letters = "".join(T.letter(rng.choice([0, 1, 1, 2, 2, 3]), rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(n))
            assert T.repair(letters) == by_states(letters)
            assert min(T.bounds(*T._read(letters))[0][:1]) <= T.repair(letters)[0]
    assert len(T.repair("E" * 50_000)[1]) >= 50_000


def plain(rows):
    """The contract, conversation by conversation."""
    out = {}
    for conv in {r[0] for r in rows}:
        kept = []
        for _, turn, role, text in sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0)):
            d = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            role, text = " " if role is None else role, " " if text is None else text
            if d:
                text = "" if d == 1 else re.sub("[.!?]", "", text) if d == 2 else text
                kept += [(turn, "user" if d == 4 else role, text)] * (2 if d == 3 else 1)
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        letters, seen, counts = "", set(), [0] * 4
        for _, role, text in kept:
            solid = text.rstrip(" \t\n\x0b\x0c\r")
            fault = 2 if not solid else 3 if (role, text) in seen else 1 if solid[-1] not in ".!?" else 0
            seen.add((role, text))
            counts[fault] += 1
            letters += T.letter("sua".find(role[:1]) % 4 if role else 3, fault)
        cost, audit = by_states(letters)
        made, state, at = [], 0, 0
        for e in audit:
            if e in "IR":
                state = T._NEXT[state]
                made.append(("user" if state == T.USER else "assistant") + ":" + ("" if e == "I" else kept[at][2]))
            elif e == "K":
                made.append(f"{kept[at][1]}:{kept[at][2]}")
                state = "sua".index(kept[at][1][0]) + 1
            at += e != "I"
        turns = [t for t, _, _ in kept if t is not None]
        pairs = [a[1][:1] + b[1][:1] for a, b in itertools.pairwise(kept)]
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, counts[2], counts[3], counts[1],
                     sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(made).encode()).hexdigest())
    return out


def rows(seed):
    rng = random.Random(seed)
    out = []
    for conv in [None, *range(40)]:
        for turn in range(rng.randint(1, 12)):
            role = rng.choice(["system", "user", "user", "assistant", "assistant", "tool", None, ""])
            text = rng.choice(["Hello.", "Hello.", "Why?", "cut off", None, "", " \n", "Ünï \U0001f600!", "x" * 50_000 + "."])
            out.append((conv, rng.choice([turn, turn, turn, turn + 3, None]), role, text))
    return out + out[:25] + [(99, 1, "user", "Hi.")] * 7


@pytest.mark.parametrize("seed", [1, 2])
def test_whole_results(spark, seed):
    data = rows(seed)
    frame = spark.createDataFrame(data, "conv_id long, turn long, role string, text string").repartition(3)
    for name in ("conv", "pos", "copies", "audit", "cost", "dropped", "fault", "initial", "again", "illegal"):
        frame = frame.withColumn(name, F.lit("x"))
    found = T.repaired(frame).collect()
    assert found[0].asDict().keys() == {"conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"}
    assert {r[0]: tuple(r)[1:] for r in found} == plain(data)
    assert len(found) == len({r[0] for r in data})


def test_nothing_left_and_nothing_there(spark):
    lost = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    found = T.repaired(spark.createDataFrame([(lost, 0, "user", "Hi.")], "conv_id long, turn long, role string, text string"))
    assert [tuple(r) for r in found.collect()] == [(lost, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert T.repaired(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_repaired_rows_are_legal():
    work = T.Repaired("IKRD", keep=True)
    for initial, role in ((2, "assistant"), (2, "assistant"), (0, "system")):
        work.row(initial, role, "text")
    work.inserts()
    assert work.rows == [("user", ""), ("assistant", "text"), ("user", "text")]
