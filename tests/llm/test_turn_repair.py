"""Repairs against an exhaustive search."""

import random
import re
from itertools import product

import pytest

from tidemark.llm.turn_repair import damaged, repair_turns

SCHEMA = "conv_id long, turn long, role string, text string, audit string, `a.b` string"
GOOD = re.compile(r"(s?(ua)+)?")


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        tail = text.rstrip(" \t\n\x0b\x0c\r")[-1:]
        out.append("blank" if not tail else "duplicate" if (role, text) in seen else
                   "truncated" if tail not in ".!?" else None)
        seen.add((role, text))
    return out


def search(rows):
    """Every choice of edits with up to two insertions before each turn and at the end."""
    options, marks = [], faults(rows)
    for (role, text), fault in zip(rows, marks):
        extra = 3 if fault == "truncated" else 0
        ways = [("D", 4, [])]
        if fault not in ("blank", "duplicate"):
            ways += [("K", extra, [(role, text)])] + [
                ("R", 3 + extra, [(new, text)]) for new in ("user", "assistant")]
        options += [[("", 0, [])] + [
            ("I" * n, 3 * n, [(r, "") for r in roles])
            for n in (1, 2) for roles in product(("user", "assistant"), repeat=n)], ways]
    options.append(options[0] if rows else [("", 0, [])])
    best = None
    for way in product(*options):
        said = [x for part in way for x in part[2]]
        if GOOD.fullmatch("".join(role[:1] or "-" for role, _ in said)):
            found = sum(part[1] for part in way), "".join(part[0] for part in way), said
            best = found if best is None else min(best, found, key=lambda x: x[:2])
    return best


def expected(rows):
    """``rows``: (turn, role, text) of one conversation."""
    rows = sorted(((n, r if r is not None else " ", t if t is not None else " ") for n, r, t in rows),
                  key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode()))
    said = [row[1:] for row in rows]
    marks, numbers = faults(said), {row[0] for row in rows} - {None}
    cost, audit, after = search(said)
    first = [role[:1] for role, _ in said]
    return (
        max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0,
        *[marks.count(x) for x in ("blank", "duplicate", "truncated")],
        sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:])), cost, audit, after)


def results(df):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit,
                        list(zip(r.roles, r.texts))) for r in df.collect()}


def test_as_searched(spark):
    pick, rows = random.Random(5), []
    for conv in range(90):
        for turn in range(pick.randint(1, 3)):
            rows.append((
                conv if conv else None, pick.choice([turn, turn, 2 * turn, turn - 3, None]),
                pick.choice(["system", "user", "assistant", "user", "assistant", "tool", "", "ümlaut", None]),
                pick.choice(["One.", "Two!", "cut off", "", " \t", "three? ", "End. ", None]), "x", "y"))
    found = results(repair_turns(spark.createDataFrame(rows, SCHEMA).repartition(5)))
    for conv in {row[0] for row in rows}:
        assert found.pop(conv) == expected([row[1:4] for row in rows if row[0] == conv])
    assert not found


def test_long_conversations_and_large_numbers(spark):
    big = 2**60
    rows = [(big + 1, big + i, "ua"[i % 2].replace("u", "user").replace("a", "assistant"), f"{i}.", "", "")
            for i in range(30_000)]
    rows += [(big, None, "user", "x." * 100_000, "", ""), (None, 0, None, None, "", "")]
    found = results(repair_turns(spark.createDataFrame(rows, SCHEMA)))
    assert found[big + 1][:6] == (0, 0, 0, 0, 0, 0) and found[big + 1][6] == "K" * 30_000
    assert found[big][5:7] == (3, "KI") and found[None][1] == 1 and found[None][6] == "D"


def test_empty(spark):
    assert repair_turns(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize(("conv", "turn"), [(1, 2), (None, 7), (12345678901, None)])
def test_damage(spark, conv, turn):
    import zlib
    shown = [" " if x is None else str(x) for x in (conv, turn)]
    fault = zlib.crc32(":".join(shown).encode()) % 20
    rows = damaged(spark.createDataFrame([(conv, turn, None, "A. b!", "", "")], SCHEMA)).collect()
    assert len(rows) == {0: 0, 3: 2}.get(fault, 1)
    for row in rows:
        assert row.role == ("user" if fault == 4 else " ")
        assert row.text == {1: "", 2: "A b"}.get(fault, "A. b!")
