import hashlib
import itertools
import random
import re
import zlib

import pytest

from gridloom.llm import conversations
from gridloom.llm.common import table

ROWS = "conv_id long, turn int, role string, text string"
BLANK = re.compile(r"[^\x20\x09-\x0D]")


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        say = lambda x: " " if x is None else str(x)
        kind = zlib.crc32(f"{say(conv)}:{say(turn)}".encode()) % 20
        role, text = say(role), say(text)
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def brute(rows):
    """All findings of one conversation's rows; the audit by a search over (cost, audit) of whole paths."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    turns = [r[1] for r in rows if r[1] is not None]
    faults, seen = [], set()
    for _, _, role, text in rows:
        shown = BLANK.findall(text)
        faults.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else "")
        seen.add((role, text))
    illegal = sum((a[2][:1] + b[2][:1]) not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    from functools import cache

    @cache
    def best(i, state, inserts):
        """The least (cost, audit, lines) from here."""
        found = [(0, "", ())] if i == len(rows) and state in ("", "a") else []
        if inserts < 3:
            for role in ("user", "assistant"):
                if (state, role[0]) in step:
                    c, a, t = best(i, step[state, role[0]], inserts + 1)
                    found.append((c + 3, "I" + a, ((role, ""), *t)))
        if i < len(rows):
            _, _, role, text = rows[i]
            c, a, t = best(i + 1, state, 0)
            found.append((c + 4, "D" + a, t))
            if faults[i] not in ("blank", "duplicate"):
                more = 3 * (faults[i] == "truncated")
                for letter, price, to in (("K", 0, role), ("R", 3, "user"), ("R", 3, "assistant")):
                    if (state, to[:1]) in step:
                        c, a, t = best(i + 1, step[state, to[:1]], 0)
                        found.append((c + price + more, letter + a, ((to, text), *t)))
        return min(found, default=(10**9, "", ()))

    cost, audit, lines = best(0, "", 0)
    digest = hashlib.sha256("\n".join(f"{a}:{b}" for a, b in lines).encode()).hexdigest()
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, digest


NOTHING = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def expected(rows):
    by_conv = {}
    for r in damage(rows):
        by_conv.setdefault(r[0], []).append(r)
    return {c: brute(by_conv[c]) if c in by_conv else NOTHING for c in {r[0] for r in rows}}


def found(spark, rows, size=conversations.SEGMENT):
    made = spark.createDataFrame(rows, ROWS).withColumn("conv_key", conversations.F.lit("clash"))
    out = conversations.repaired_digests(made, conversations.damaged(made), size).collect()
    assert len({r["conv_id"] for r in out}) == len(out)
    return {r["conv_id"]: tuple(r)[1:] for r in out}


def made_up(seed, n, turns):
    draw = random.Random(seed)
    rows = []
    for c in range(n):
        for k in range(draw.randint(1, turns)):
            role = draw.choice(["user", "assistant", "system", "tool", "user", "assistant", None, "", "ußer"])
            text = draw.choice(["Yes.", "No", "And?\n", "", " \t", None, "a:b!", "One. Two", "é。", "Yes."])
            rows.append((c if c else None, draw.choice([k, k, k, None, k * 2]), role, text))
    return rows


def test_every_conversation_of_the_table(spark, small):
    rows = [tuple(r) for r in table(spark, small, "conversations").select("conv_id", "turn", "role", "text").collect()]
    got = {r["conv_id"]: tuple(r)[1:] for r in conversations.op13_conversation_repair(spark, small).collect()}
    assert got == expected(rows)


@pytest.mark.parametrize("size", [conversations.SEGMENT, 3, 1])
def test_odd_rows_in_segments_of_any_size(spark, size):
    """Nulls in any column, unknown roles, repeated and equal turns: one segment or many give what brute force gives."""
    rows = made_up(7, 60, 9)
    assert found(spark, rows, size) == expected(rows)


def test_one_long_conversation(spark):
    """A conversation of many segments beside short ones, with a line that stands on most of its turns."""
    draw = random.Random(1)
    rows = [(1, k, draw.choice(["user", "assistant", "system"]), draw.choice(["Same."] * 4 + [f"Turn {k}.", f"Cut {k}"])) for k in range(700)]
    rows += made_up(2, 5, 4)
    import sys

    sys.setrecursionlimit(10_000)
    assert found(spark, rows, 50) == expected(rows)


def test_nothing_left_and_the_empty_table(spark):
    gone = next(c for c in range(10_000) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    assert found(spark, [(gone, 1, "user", "Yes.")]) == {gone: NOTHING}
    assert found(spark, []) == {}


def test_repeated_rows_are_deleted_once_less(spark):
    rows = [(5, 3, "user", "Yes.")] * 6
    assert found(spark, rows) == expected(rows)
