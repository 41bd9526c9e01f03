"""Repair of conversations: the auction against all paths, and whole tables against a plain version of the contract."""

from __future__ import annotations

import random
import re
import zlib
from hashlib import sha256
from heapq import heappop, heappush

import pytest

from freshet.llm import repair

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id bigint, turn bigint, role string, text string"
BLACK = re.compile(r"[^\x20\x09-\x0D]")
GRAMMAR = re.compile(r"(s?(ua)+)?")


def cheapest_plain(faults: list[str], initials: list[str]) -> tuple[int, str]:
    """Least (cost, audit) by a search over (rows passed, grammar state), ordered by cost and then by the string."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, audit, i, g = heappop(heap)
        if i == len(faults) and g in ("", "a"):
            return cost, audit
        if (i, g) in done:
            continue
        done.add((i, g))
        for new in "ua":
            if (g, new) in step:
                heappush(heap, (cost + 3, audit + "I", i, new))
                if i < len(faults) and faults[i] in ".T":
                    heappush(heap, (cost + 3 + 3 * (faults[i] == "T"), audit + "R", i + 1, new))
        if i < len(faults):
            heappush(heap, (cost + 4, audit + "D", i + 1, g))
            if faults[i] in ".T" and (g, initials[i]) in step:
                heappush(heap, (cost + 3 * (faults[i] == "T"), audit + "K", i + 1, step[g, initials[i]]))


def write_plain(rows, initials, audit):
    lines, g, i = [], "", 0
    for label in audit:
        if label == "K":
            g = initials[i]
            lines.append(f"{rows[i][0]}:{rows[i][1]}")
        elif label in "IR":
            g = "a" if g == "u" else "u"
            lines.append({"u": "user", "a": "assistant"}[g] + ":" + (rows[i][1] if label == "R" else ""))
        i += label != "I"
    assert i == len(rows) and GRAMMAR.fullmatch("".join(line[0] for line in lines))
    return "\n".join(lines)


def plain(table: list[tuple]) -> dict:
    convs: dict = {}
    for conv, turn, role, text in table:
        rows = convs.setdefault(conv, [])
        role, text = (" " if v is None else v for v in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        rows += [(turn, role, text)] * (2 if kind == 3 else 1)
    found = {}
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns = [t for t, _, _ in rows if t is not None]
        said = [(r, t) for _, r, t in rows]
        faults = []
        for i, (_, text) in enumerate(said):
            black = BLACK.findall(text)
            faults.append("B" if not black else "D" if said[i] in said[:i] else "." if black[-1] in ".!?" else "T")
        initials = [r[:1] for r, _ in said]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit = cheapest_plain(faults, initials)
        found[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("B"), faults.count("D"), faults.count("T"),
            illegal, cost, audit, sha256(write_plain(said, initials, audit).encode()).hexdigest(),
        )
    return found


def run(spark, table, segment):
    df = spark.createDataFrame(table, SCHEMA)
    rows = repair.repaired(repair.damaged(df), segment).collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r)[1:] for r in rows}


def test_auction_against_all_paths():
    rng = random.Random(4)
    for n in [0, 1, 2, 3, 5, 9, 40] * 12:
        faults = [rng.choice("....TBD") for _ in range(n)]
        initials = [rng.choice("suuaax") for _ in range(n)]
        code = "".join(i + f.translate(str.maketrans("BD", "FF")) for i, f in zip(initials, faults))
        ((audit, _, cost),) = repair.solved(code, repair.FINAL, True, True)
        assert (cost, audit) == cheapest_plain(faults, initials)


def test_many_states_and_a_long_conversation():
    code = "".join(random.Random(n).choice("suuaa") + random.Random(-n).choice("....TF") for n in range(400))
    ((audit, _, cost),) = repair.solved(code, repair.FINAL, True, True)
    assert (cost, audit) == cheapest_plain(list(code[1::2].replace("F", "B")), list(code[::2]))


def conversation(rng, conv, n):
    texts = ["Yes.", "No!", "What is it", " ", "", None, "Long text. " * 30, "é ß 漢?", "tail. \t\n"]
    return [
        (conv, rng.choice([None, t, t, t, t + 1]), rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None]),
         rng.choice(texts) if rng.random() < 0.4 else f"Turn {rng.randrange(n)} of {conv}.")
        for t in range(n)
    ]


@pytest.mark.parametrize("segment", [2, 5, 512])
def test_conversations_against_plain_version(spark, segment):
    rng = random.Random(segment)
    table = [r for c in range(12) for r in conversation(rng, c, rng.choice([1, 2, 4, 8]))]
    table += conversation(rng, 99, 70)
    table += [(None, None, None, None), (None, 1, "user", "Hm?"), (1000, None, "user", "a."), (1000, None, None, "a.")]
    rng.shuffle(table)
    assert run(spark, table, segment) == plain(table)


def test_lost_conversations_and_empty_tables(spark):
    lost = next(c for c in range(100) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    assert run(spark, [(lost, 1, "user", "Yes.")], 512) == {lost: (0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest())}
    assert run(spark, [], 512) == {}


def test_query_on_the_table(spark):
    table = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows = repair.op11_auction_repair(spark, SF).collect()
    assert {r.conv_id: tuple(r)[1:] for r in rows} == plain(table) and rows
    assert rows[0].asDict().keys() == {
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256",
    }


def test_other_columns_do_not_matter(spark):
    table = [(c, t, "user" if t % 2 == 0 else "assistant", f"Turn {t}.", "x", 1) for c in range(3) for t in range(4)]
    df = spark.createDataFrame(table, SCHEMA + ", conv string, _id int")
    got = {r.conv_id: tuple(r)[1:] for r in repair.repaired(repair.damaged(df)).collect()}
    assert got == plain([r[:4] for r in table])
