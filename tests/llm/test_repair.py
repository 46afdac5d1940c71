import hashlib
import random
import zlib
from itertools import product

import duckdb
import pytest

from tidemark.llm import queries, repair, sql

ROWS = "conv_id bigint, turn bigint, role string, text string"
WHITE = " \t\n\x0b\x0c\r"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if k == 1:
            text = ""
        elif k == 2:
            text = "".join(c for c in text if c not in ".!?")
        out += [(conv, turn, "user" if k == 4 else role, text)] * {0: 0, 3: 2}.get(k, 1)
    return out


def brute_edits(rows, faults):
    """The least (cost, audit, turns) by a table over all prefixes, every least audit kept whole."""
    after = {"": "u", "s": "u", "u": "a", "a": "u"}
    name = {"u": "user", "a": "assistant"}

    def grow(best):
        for _ in range(3):
            for q, (cost, audit, turns) in list(best.items()):
                to = after[q]
                new = (cost + 3, audit + "I", [*turns, f"{name[to]}:"])
                if to not in best or new[:2] < best[to][:2]:
                    best[to] = new
        return best

    best = grow({"": (0, "", [])})
    for (_, _, role, text), fault in zip(rows, faults):
        nexts = {}

        def put(q, new):
            if q not in nexts or new[:2] < nexts[q][:2]:
                nexts[q] = new

        for q, (cost, audit, turns) in best.items():
            put(q, (cost + 4, audit + "D", turns))
            if fault in ("blank", "duplicate"):
                continue
            more, to = 3 * (fault == "truncated"), after[q]
            put(to, (cost + 3 + more, audit + "R", [*turns, f"{name[to]}:{text}"]))
            if role[:1] == to or (role[:1] == "s" and q == ""):
                put(role[:1], (cost + more, audit + "K", [*turns, f"{role}:{text}"]))
        best = grow(nexts)
    return min((best[q] for q in ("", "a") if q in best), key=lambda b: b[:2])


def brute(rows):
    by = {conv: [] for conv, *_ in rows}
    for r in damaged(rows):
        by[r[0]].append(r)
    out = []
    for conv, own in by.items():
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.sha256(r[3].encode()).digest()))
        seen, faults = set(), []
        for _, _, role, text in own:
            said = text.rstrip(WHITE)
            faults.append("blank" if not said else "duplicate" if (role, text) in seen else "" if said[-1] in ".!?" else "truncated")
            seen.add((role, text))
        turns = {r[1] for r in own if r[1] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        bad = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, done = brute_edits(own, faults)
        digest = hashlib.sha256("\n".join(done).encode()).hexdigest()
        out.append((conv, gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], bad, cost, audit, digest))
    return sorted(out, key=repr)


def check(spark, rows, tmp_path, name):
    path = str(tmp_path / name)
    odd = "struct(1 as a) AS digest, 7 AS copies, 'x' AS audit"
    spark.createDataFrame(rows, ROWS).selectExpr("*", odd.split(", ")[0], "7 AS copies", "'x' AS audit").repartition(3).write.parquet(f"{path}/conversations.parquet")
    want = brute(rows)
    assert sorted((tuple(r) for r in queries.op13_conversation_repair(spark, path).collect()), key=repr) == want
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW conversations AS SELECT conv_id, turn, role, text FROM '{path}/conversations.parquet/*.parquet'")
    assert sorted(duck.sql(sql.REPAIR).fetchall(), key=repr) == want


def test_random_conversations(spark, tmp_path):
    """Roles, repeats, blanks, cut texts and missing turns in any mixture, against brute force and SQL."""
    dice = random.Random(13)
    roles, texts = ["user", "assistant", "system", "tool", "a", None, "Übung"], ["Yes.", "No!", "What", "", " \t", None, "End. \n", "cut…"]
    rows = [
        (conv, dice.choice([turn, turn, turn + 3, None, 0]), dice.choice(roles[: 3 + conv % 5]), dice.choice(texts))
        for conv in range(120)
        for turn in range(dice.randrange(1, 9))
    ]
    check(spark, rows, tmp_path, "random")


def test_ties_nulls_and_repeated_rows(spark, tmp_path):
    rows = [(None, None, None, None)] * 3 + [(None, 1, "user", "Hi.")] + [(4, 2, "user", "Same.")] * 30 + [(4, 2, "assistant", "Same.")] * 5
    rows += [(5, 9, "", "No role."), (6, 1, "user", "x" * 200_000), (6, 1, "assistant", " " * 200_000 + "y."), (7, -3, "system", "Only.")]
    rows += [(conv, turn, "user", "t.") for conv in range(20, 60) for turn in (0,)]
    assert any(zlib.crc32(f"{conv}:0".encode()) % 20 == 0 for conv in range(20, 60))
    check(spark, rows, tmp_path, "ties")


def test_empty_table(spark, tmp_path):
    check(spark, [], tmp_path, "empty")


@pytest.mark.parametrize("n", range(6))
def test_search_on_all_short_conversations(n):
    """Every sequence of initials and faults up to five rows."""
    kinds = [repair.USER, repair.ASSISTANT, repair.SYSTEM, repair.START, repair.GO, repair.USER | repair.CUT, repair.ASSISTANT | repair.CUT]
    role = {repair.USER: "user", repair.ASSISTANT: "assistant", repair.SYSTEM: "system", repair.START: "tool"}
    dice = random.Random(n)
    for codes in product(kinds, repeat=n):
        if n == 5 and dice.random() > 0.2:
            continue
        rows = [(1, i, role[c & 3], "t.") for i, c in enumerate(codes)]
        faults = ["blank" if c & repair.GO else "truncated" if c & repair.CUT else "" for c in codes]
        assert repair.cheapest(bytes(codes)) == brute_edits(rows, faults)[:2]


def test_search_stays_linear():
    """Nodes met per row do not grow, on the worst mixtures known."""
    dice = random.Random(5)
    for kinds in ([repair.USER], [repair.START], [repair.USER | repair.CUT], [repair.ASSISTANT, repair.SYSTEM], list(range(16))):
        codes = bytes(dice.choice(kinds) for _ in range(40_000))
        cost, audit = repair.cheapest(codes)
        assert sum(e != "I" for e in audit) == len(codes)
        assert cost == repair.bounds(codes)[0][repair.START]


def test_repaired_turns(spark):
    rows = spark.createDataFrame(
        [(1, 0, "assistant", "First."), (1, 1, "user", "Second."), (1, 2, "tool", "Third."), (2, 0, "user", "")], ROWS
    )
    found = repair.plans(rows)
    got = {r.conv_id: (r.cost, r.audit) for r in found.collect()}
    assert got == {1: (6, "IKKR"), 2: (4, "D")}
    turns = sorted(tuple(r) for r in repair.repaired(rows, found).collect())
    assert turns == [(1, 0, "user", "", "I"), (1, 1, "assistant", "First.", "K"), (1, 2, "user", "Second.", "K"), (1, 3, "assistant", "Third.", "R")]
