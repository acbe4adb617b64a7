"""Conversation repair against a plain search over (cost, audit) pairs, in one block and in many."""

import hashlib
import random
import re
import zlib

import pytest

from riskmart.llm import repairs

NEXT = {"z": "u", "s": "u", "u": "a", "a": "u"}


def slow_damage(rows):
    """{conv: [(turn, role, text)]} in order."""
    out = {}
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind:
            row = (turn, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)
            kept += [row] * (2 if kind == 3 else 1)
    digest = lambda r: hashlib.sha256(f"{len(r[1])}:{r[1]}:{r[2]}".encode()).hexdigest()
    return {c: sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, digest(r))) for c, v in out.items()}


def slow_repair(rows):
    seen, faults = set(), []
    for _, role, text in rows:
        bare = text.rstrip(" \t\n\r\x0b\x0c")
        faults.append("b" if not bare else "d" if (role, text) in seen else "" if bare[-1] in ".!?" else "t")
        if bare:
            seen.add((role, text))
    best = {"z": (0, "", ())}

    def put(nodes, at, way):
        if at not in nodes or way < nodes[at]:
            nodes[at] = way

    def inserted(nodes):
        nodes = dict(nodes)
        for _ in range(4):
            for at, (c, e, t) in list(nodes.items()):
                put(nodes, NEXT[at], (c + 5, e + "I", (*t, {"u": "user:", "a": "assistant:"}[NEXT[at]])))
        return nodes

    for (_, role, text), fault in zip(rows, faults):
        after = {}
        for at, (c, e, t) in inserted(best).items():
            put(after, at, (c + 2, e + "D", t))
            if fault in ("", "t"):
                more = 5 * (fault == "t")
                if role[:1] == NEXT[at] or role[:1] == "s" and at == "z":
                    put(after, role[:1], (c + more, e + "K", (*t, f"{role}:{text}")))
                put(after, NEXT[at], (c + 1 + more, e + "R", (*t, f"{'user' if NEXT[at] == 'u' else 'assistant'}:{text}")))
        best = after
    cost, audit, lines = min(v for k, v in inserted(best).items() if k in "za")
    turns = [r[0] for r in rows if r[0] is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return {"gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, "blank": faults.count("b"), "duplicate": faults.count("d"), "truncated": faults.count("t"),
            "illegal": sum(p not in ("su", "ua", "au") for p in pairs), "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest()}


def made_rows(seed=3):
    rng = random.Random(seed)
    rows = []
    for conv in range(150):
        for turn in range(rng.choice((1, 2, 3, 6, 11))):
            role = rng.choice(("user", "user", "assistant", "assistant", "system", "tool", None, "", "umpire"))
            text = rng.choice(("Yes.", "No!", "Why", "  ", None, "Well?\n", "ähm …", "So.", "So"))
            rows.append((conv, None if rng.random() < 0.1 else turn * rng.choice((1, 1, 3)), role, text))
    rows += [(777, i, "user", f"only users {i % 40}.") for i in range(300)] + [(888, 0, "assistant", "x" * 200_000)] + [(None, i, "user", "no conversation.") for i in range(9)]
    rows += [(999, 5, "user", "one turn.")] * 40 + [(1000, None, None, None)] * 3
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block, fan", [(256, 64), (3, 2)])
def test_repair(spark, block, fan):
    rows = made_rows()
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "conv_id long, turn long, role string, text string, _place int, audit string, _conv int").repartition(5)
    got = {r["conv_id"]: r.asDict() for r in repairs.repair(df, block, fan).collect()}
    want = slow_damage(rows)
    assert set(got) == set(want)
    for conv, kept in want.items():
        assert {k: v for k, v in got[conv].items() if k != "conv_id"} == slow_repair(kept), conv


def test_no_conversations(spark):
    assert repairs.repair(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []


def test_weights_order_as_cost_then_audit():
    """One row more of the same: the integers of two ways sort as (cost, audit) does."""
    for codes in ("u.", "u.u.", "s.a.u.", "utatut", "xbx.xd", "a.a.u.s.", "u." * 9):
        cut = repairs.block_ways(codes, [repairs.START])
        for n in range(2, len(codes), 2):
            parts = [repairs.block_ways(codes[:n], [repairs.START]), repairs.block_ways(codes[n:], range(4))]
            assert repairs.whole_way(repairs.joined_ways(parts)) == repairs.whole_way(cut)
