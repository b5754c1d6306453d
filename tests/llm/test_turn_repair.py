"""Operator 13 against a plain search of all edits."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from functools import lru_cache

import pytest
from llm_fixtures import SF, result
from pyspark.sql import functions as F

from farelens.llm import turn_repair

ORDER = re.compile("(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string"


def every_edit(rows):
    """(cost, edits, repaired turns) of the best way, by the definition: all
    strings of edits whose roles match, cheapest first, then ASCII."""

    @lru_cache(None)
    def rest(i, roles):  # roles: the last two initials, which decide what may follow
        ends = []

        def go(i, tail, cost, edits, turns, inserts):
            if i == len(rows) and tail in ("", "ua"):
                ends.append((cost, edits, turns))
            if inserts < 3:
                for role in ("user", "assistant"):
                    if (then := follow(tail, role[0])) is not None:
                        go(i, then, cost + 3, edits + "I", (*turns, (role, "")), inserts + 1)
            if i == len(rows):
                return
            (role, text), fault = rows[i]
            steps = [(4, "D", tail, ())]
            if fault in "ft":
                extra = 3 * (fault == "t")
                if role and (then := follow(tail, role[0])) is not None:
                    steps.append((extra, "K", then, ((role, text),)))
                steps += [(3 + extra, "R", then, ((new, text),)) for new in ("user", "assistant") if (then := follow(tail, new[0])) is not None]
            for more, edit, then, turn in steps:
                c, e, t = rest(i + 1, then)
                ends.append((cost + more + c, edits + edit + e, (*turns, *turn, *t)))

        go(i, roles, 0, "", (), 0)
        return min(ends)

    def follow(tail, x):
        grown = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "ua"}, "ua": {"u": "u"}}
        return grown[tail].get(x)

    return rest(0, "")


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        last = re.sub(r"[\x20\x09-\x0D]+$", "", text)[-1:]
        out.append("b" if not last else "d" if (role, text) in seen else "f" if last in ".!?" else "t")
        seen.add((role, text))
    return out


def expected(rows):
    """Of (turn, role, text) in order, after damage."""
    turns = [t for t, _, _ in rows if t is not None]
    pairs = [(r, x) for _, r, x in rows]
    found = faults(pairs)
    cost, edits, repaired = every_edit(tuple(zip(pairs, found, strict=True)))
    assert ORDER.fullmatch("".join(r[0] for r, _ in repaired))
    initials = [r[:1] for r, _ in pairs]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(found.count(f) for f in "bdt"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, edits,
            hashlib.sha256("\n".join(f"{r}:{x}" for r, x in repaired).encode()).hexdigest())


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        name = lambda x: " " if x is None else str(x)
        kind = zlib.crc32(f"{name(conv)}:{name(turn)}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind:
            row = (conv, turn, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)
            out += [row, row] if kind == 3 else [row]
    return out


def report(rows):
    held = defaultdict(list)
    for conv, turn, role, text in damage(rows):
        held[conv].append((turn, role, text))
    order = lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest())
    return {conv: expected(sorted(held[conv], key=order)) for conv in {r[0] for r in rows}}


def check(rows, out):
    want = report(rows)
    assert len(out) == len(want)
    for r in out:
        assert (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) == want[r.conv_id], r.conv_id


def test_search_is_exact():
    rng = random.Random(5)
    for _ in range(600):
        rows = [(rng.choice("suaax"), rng.choice("ffffbdt")) for _ in range(rng.randint(0, 3 * turn_repair.STRIDE))]
        cost, edits, _ = every_edit(tuple(((x, ""), f) for x, f in rows))
        assert turn_repair.Search(rows).solve() == (cost, edits), rows


def test_search_of_a_long_conversation():
    rng = random.Random(6)
    rows = [("ua"[k % 2] if rng.random() < 0.8 else rng.choice("sux"), rng.choice("fffffbdt")) for k in range(20_000)]
    cost, edits = turn_repair.Search(rows).solve()
    assert len(edits) - edits.count("I") == len(rows) and cost > 10_000


def test_repair_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    check(rows, result(spark, "op13_turn_repair"))


def edge_rows():
    rng = random.Random(7)
    rows = [(k // 7, None if rng.random() < 0.1 else rng.randint(-2, 6), rng.choice(["user", "assistant", "system", "tool", "", None]),
             rng.choice(["Yes.", "no", "", " \t", None, "a?\n", "é" * 5000 + "!"])) for k in range(700)]
    rows += [(None, k, "user", f"t{k}.") for k in range(4)] + [rows[0]] * 3 + [(None, None, None, None)]
    return rows + [(2_000_000 + k, 1, "user", "Hi.") for k in range(60)]  # some lose their one row


@pytest.mark.parametrize("rows", [edge_rows(), [], [(1, 1, "user", "x" * 3_000_000 + ".")]])
def test_repair_edges(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    for c in ("audit", "digest", "fault", "part", "cost", "place", "fl_conv"):
        df = df.withColumn(c, F.lit("x"))
    check(rows, turn_repair.repair_report(turn_repair.damaged(df), df).collect())


def test_repaired_turns(spark):
    rows = [(1, 0, "user", "Hi."), (1, 2, "user", "Still there?"), (1, 3, "assistant", "Yes."), (1, 3, "assistant", "Yes."), (2, 0, "assistant", ""),
            (3, 5, "system", "Be brief."), (3, 6, "user", "Well")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    audits = turn_repair.audit(df)
    got = sorted(map(tuple, turn_repair.repaired(df, audits).collect()))
    assert {r.conv_id: r.audit for r in audits.collect()} == {1: "KIKKD", 2: "D", 3: "KKI"}
    assert got == [(1, 0, "user", "Hi."), (1, 1, "assistant", ""), (1, 2, "user", "Still there?"), (1, 3, "assistant", "Yes."),
                   (3, 0, "system", "Be brief."), (3, 1, "user", "Well"), (3, 2, "assistant", "")]
