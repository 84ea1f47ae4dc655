"""Conversation repair against a search over all edits, cheapest first, and damage written in plain Python."""

import hashlib
import heapq
import random
import re
import zlib

import duckdb
import pandas as pd
from check_oracle import compare, duck

from tapedeck.llm import chat_repair, queries
from tapedeck.llm.common import Workspace

SPACE = " \t\n\v\f\r"


def damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind, role, text = zlib.crc32(key.encode()) % 20, role if role is not None else " ", text if text is not None else " "
        role, text = "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        kept += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.strip(SPACE)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, wrong):
    """Uniform-cost search; of equal costs the least audit comes off the heap first."""
    heap, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, roles, out = heapq.heappop(heap)
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            return cost, audit, out
        key = (i, roles[-1:], roles[:1] == "s" and len(roles) == 1)
        if key in done:
            continue
        done.add(key)
        legal = [r for r in "sua" if roles + r == "s" or (r == "u" and roles[-1:] in ("", "s", "a")) or (r == "a" and roles[-1:] == "u")]
        for name in ("user", "assistant"):
            if name[0] in legal:
                heapq.heappush(heap, (cost + 5, audit + "I", i, roles + name[0], (*out, (name, ""))))
        if i == len(rows):
            continue
        heapq.heappush(heap, (cost + 2, audit + "D", i + 1, roles, out))
        if wrong[i] in ("blank", "duplicate"):
            continue
        more, (_, role, text) = 5 * (wrong[i] == "truncated"), rows[i]
        if role[:1] in legal:
            heapq.heappush(heap, (cost + more, audit + "K", i + 1, roles + role[:1], (*out, (role, text))))
        for name in ("user", "assistant"):
            if name[0] in legal:
                heapq.heappush(heap, (cost + 1 + more, audit + "R", i + 1, roles + name[0], (*out, (name, text))))


def brute_force(table):
    got = {}
    for conv, rows in damage(table).items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns, wrong = [t for t, _, _ in rows if t is not None], faults(rows)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        cost, audit, out = cheapest(rows, wrong)
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
        got[conv] = (gaps, wrong.count("blank"), wrong.count("duplicate"), wrong.count("truncated"), illegal, cost, audit, digest)
    return got


def odd_tables():
    rnd, rows = random.Random(5), []
    for conv in [*range(150), None]:
        for turn in range(rnd.randint(1, 7)):
            role = rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rnd.choice(["Yes.", "No!", "cut off", "", None, " \x0b", f"Say {rnd.random()}.", f"Say {rnd.random()}?\n", "Yes. \x1c", "ü!"])
            rows.append((conv, rnd.choice([turn, turn, turn, turn + 3, None]), role, text))
    rows += rows[:40]
    # Long ones whose chunks never converge, only go, or alternate as they should.
    rows += [(900, t, "user", f"turn {t}.") for t in range(90)] + [(901, t, "user", "same.") for t in range(70)]
    rows += [(902, t, ("user", "assistant")[t % 2], f"turn {t}" + ".?!"[t % 3]) for t in range(120)] + [(903, 7, "system", "same.")] * 50
    return rows + [(904, None, "tool", f"turn {t}.") for t in range(40)]


def test_repair_equals_a_search_over_all_edits(spark):
    table = odd_tables()
    frame = spark.createDataFrame(table, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as key", "'x' as chunk", "9 as copies")
    want = brute_force(table)
    for most in (3, chat_repair.CHUNK_ROWS):
        got = chat_repair.repair_damaged(frame.drop("copies"), Workspace(spark), most).collect()
        assert len(got) == len(want)
        for r in got:
            assert tuple(r)[1:] == want[r["conv_id"]], r["conv_id"]
    assert chat_repair.repair_damaged(frame.limit(0), Workspace(spark)).count() == 0


def test_repaired_rows_and_very_long_texts(spark):
    long = "word " * 300_000 + "end."
    rows = [("x", 1, "assistant", long), ("x", 2, "user", "Thanks."), ("x", 3, "assistant", long + "!"), ("y", 1, "user", "cut")]
    frame = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")
    pieces = chat_repair.traced(frame, Workspace(spark), 2)
    got = [(r["key"], r["role"], r["text"]) for r in chat_repair.repaired_rows(pieces).orderBy("key", "chunk", "place").collect()]
    assert got == [("cx", "user", "Thanks."), ("cx", "assistant", long + "!")]
    assert {r["key"]: r["audit"] for r in pieces.groupBy("key").agg({"audit": "max"}).toDF("key", "audit").collect()}["cy"] == "D"


def test_every_class_comes_from_the_one_at_the_end():
    known, steps = chat_repair.vectors()
    assert len(known) < 64 and all(0 <= q < len(known) for row in steps for q in row)
    assert all(chat_repair.lefts(codes)[0] == chat_repair.lefts(codes[:1])[chat_repair.lefts(codes[1:])[0]] for codes in ([3, 5, 0, 3], [3, 3, 6, 1]))


def test_sql_equals_the_search_and_the_query(spark, sf_dir):
    table = pd.DataFrame(odd_tables(), columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"})
    con = duckdb.connect()
    con.register("conversations", table)
    want = brute_force(odd_tables())
    rows = con.execute(chat_repair.SQL).fetchall()
    assert len(rows) == len(want) and all(r[1:] == want[r[0]] for r in rows)
    for name in ("op11_filter_audit", "op12_chat_repair"):
        note, _, ok = compare(spark, duck(sf_dir), name, queries.QUERIES[name], queries.ORACLES[name], sf_dir)
        assert ok, note
