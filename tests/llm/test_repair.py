"""Operator 12 against a search over all edits and a plain version of the whole contract."""

import hashlib
import itertools
import random
import zlib

import pytest

from pitwall.llm import repair
from pitwall.llm.common import table
from pitwall.llm.op12 import op12_conversation_repair
from tests.conftest import SMALL

BLANKS = " \t\n\x0b\x0c\r"


def cheapest(codes):
    """(cost, audit) by brute force: all edits, kept per (row, state) as the least (cost, audit)."""
    best = {0: (0, "")}

    def inserted(states):
        for _ in range(3):
            for s, (c, a) in list(states.items()):
                to = {0: 2, 1: 2, 2: 3, 3: 2}[s]
                states[to] = min(states.get(to, (10**9, "")), (c + 5, a + "I"))
        return states

    for code in codes:
        kind, fault = divmod(code, 3)
        after = {}
        for s, (c, a) in inserted(best).items():
            moves = [("D", 2, s)]
            if fault != 2:
                more = 5 * (fault == 1)
                to = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (3, 1): 2, (2, 2): 3}.get((s, kind))
                if to is not None:
                    moves.append(("K", more, to))
                moves.append(("R", 1 + more, 3 if s == 2 else 2))
            for m, cost, to in moves:
                after[to] = min(after.get(to, (10**9, "")), (c + cost, a + m))
        best = after
    return min(v for s, v in inserted(best).items() if s in (0, 3))


def test_edits_are_the_least_of_the_cheapest():
    for n in range(4):
        for codes in itertools.product(range(12), repeat=n):
            cost, audit = cheapest(codes)
            assert repair.walk(bytes(codes), 0, repair.FINISH)[0] == audit, codes
    rnd = random.Random(3)
    for n in (5, 17, 64, 400):
        for _ in range(40):
            codes = bytes(rnd.choice([0, 1, 3, 3, 3, 4, 5, 6, 6, 6, 7, 8, 9, 10]) for _ in range(n))
            cost, audit = cheapest(codes)
            v = repair.FINISH
            for c in reversed(codes):
                v = repair.back(c, v)
            assert (v[0], repair.walk(codes, 0, repair.FINISH)[0]) == (cost, audit)


def test_cut_runs_give_the_same_edits():
    """Segments: vectors from matrices, states from exits, audits joined."""
    rnd = random.Random(5)
    for _ in range(60):
        codes = bytes(rnd.randrange(12) for _ in range(rnd.randint(2, 40)))
        cut = sorted(rnd.sample(range(1, len(codes)), min(3, len(codes) - 1)))
        parts = [codes[a:b] for a, b in zip([0, *cut], [*cut, len(codes)])]
        v, ends = repair.FINISH, []
        for p in reversed(parts):
            ends.append(v)
            m = repair.matrix(p)
            v = repair._closed([min(m[s][t] + v[t] for t in range(4)) for s in range(4)])
        state, audit = 0, ""
        for i, (p, end) in enumerate(zip(parts, reversed(ends))):
            piece, state = repair.walk(p, state, end, i == len(parts) - 1)
            audit += piece
        assert audit == repair.walk(codes, 0, repair.FINISH)[0]


def plain(given):
    """The whole contract, conversation by conversation."""
    convs = {}
    for conv, turn, role, text in given:
        rows = convs.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        how = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if how == 0:
            continue
        if how == 1:
            text = ""
        if how == 2:
            text = "".join(c for c in text if c not in ".!?")
        if how == 4:
            role = "user"
        rows += [(turn, role, text)] * (2 if how == 3 else 1)
    out = {}
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, codes, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in rows:
            kind = {"s": 0, "u": 1, "a": 2}.get(role[:1], 3)
            left = text.strip(BLANKS)
            fault = "blank" if not left else "duplicate" if (role, text) in seen else "truncated" if left[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            codes.append(3 * kind + {None: 0, "truncated": 1}.get(fault, 2))
        initials = [r[1][:1] for r in rows]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        turns = {t for t, _, _ in rows if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        cost, audit = cheapest(codes)
        state, row, lines = 0, 0, []
        for m in audit:
            fresh = "assistant" if state == 2 else "user"
            if m == "I":
                lines.append(f"{fresh}:")
                state = 3 if state == 2 else 2
                continue
            _, role, text = rows[row]
            row += 1
            if m == "K":
                lines.append(f"{role}:{text}")
                state = {"s": 1, "u": 2, "a": 3}[role[:1]]
            elif m == "R":
                lines.append(f"{fresh}:{text}")
                state = 3 if state == 2 else 2
        out[conv] = (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def got(df):
    rows = df.collect()
    out = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in rows}
    assert len(out) == len(rows)
    return out


def test_given_conversations(spark):
    given = [tuple(r) for r in table(spark, SMALL, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert got(op12_conversation_repair(spark, SMALL)) == plain(given)


def odd():
    rnd = random.Random(11)
    texts = ["Yes.", "No!", "Why?", "cut short", "", " \t\n", None, "end. \r\n", "été ñ。", "a" * 3000 + ".", "x.y"]
    roles = ["user", "assistant", "system", None, "", "tool", "User", "support", "assistant", "user"]
    rows = []
    for conv in [*range(60), None, None, -7, 2**62]:
        for turn in range(rnd.randint(1, 9)):
            rows.append((conv, rnd.choice([turn, turn, turn, None, 2 * turn, -turn]), rnd.choice(roles), rnd.choice(texts)))
    rows += rnd.sample(rows, 40)  # repeated rows
    # one conversation with most of the rows, over several tasks and pieces
    rows += [(500, t // 2, rnd.choice(["user", "assistant", "assistant"]), rnd.choice(texts + [f"line {t}."] * 12)) for t in range(9000)]
    rows += [(501, None, "user", "one text.")] * 700
    return rows


SCHEMA = "conv_id long, turn long, role string, text string, n int, audit string, part int, kind string"


@pytest.mark.parametrize("tasks", ["true", "false"])
def test_odd_conversations(spark, tasks):
    """In one task, and dealt over several so that conversations are cut."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", tasks)
    try:
        check_odd(spark)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def check_odd(spark):
    rows = odd()
    given = spark.createDataFrame([(*r, 1, "x", 2, "y") for r in rows], SCHEMA).repartition(8)
    want = plain(rows)
    assert got(repair.audited(repair.damaged(given), given)) == want
    # the repaired rows themselves give the digests
    lines = {}
    for r in repair.repaired(repair.damaged(given)).orderBy("conv_id", "place").collect():
        lines.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    for conv, line in want.items():
        assert hashlib.sha256("\n".join(lines.get(conv, [])).encode()).hexdigest() == line[-1]


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert got(repair.audited(repair.damaged(none), none)) == {}
