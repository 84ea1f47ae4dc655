"""The filter audit against a walk over documents, one order after another."""

from itertools import permutations

from tapedeck.llm import filter_audit
from tapedeck.llm.common import Workspace

WORDS = " ".join(f"w{k}" for k in range(220))
DOCS = [
    (1, WORDS, "a", "x"), (2, WORDS, "a", "x"), (2, WORDS, "b", "x"), (3, None, "b", None), (4, "", None, "x"), (5, "A B C $ A A A A A", "", "x"),
    (None, WORDS, "a", "x"), (None, None, None, None), (6, "same " * 300, "b", "x"), (6, "same " * 300, "b", "x"), (7, "same " * 300, "b", "x"),
    (8, " \x0b\x1cX " * 210, "a", "x"), (9, "word " * 40_000 + "$", "c", "x"),
]
LABELS = [(1, 1, 0), (1, 0, 1), (2, 1, None), (3, None, 1), (5, 1, 1), (None, 1, 1), (7, 1, 1), (99, 1, 1)]


def brute_force(docs, labels):
    import re

    failed = []
    for doc_id, text, part, _ in docs:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        smaller = doc_id is not None and any(d[0] is not None and d[0] < doc_id and (d[1] or "") == t for d in docs)
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
            "D": bool(re.search("[#$%&*|]", t)), "E": smaller,
        }
        good, toxic = (doc_id is not None and any(r[0] == doc_id and r[k] == 1 for r in labels) for k in (1, 2))
        failed.append((part or "", {f for f in fails if fails[f]}, good, toxic))
    out, totals = {}, {}
    for part in {p for p, *_ in failed}:
        rows = [r for r in failed if r[0] == part]
        for order in permutations("ABCDE"):
            alive = rows
            for step, f in enumerate(order, 1):
                gone = [r for r in alive if f in r[1]]
                alive = [r for r in alive if f not in r[1]]
                failing = [r for r in rows if f in r[1]]
                totals[part, f] = totals.get((part, f), 0) + len(gone)
                out[part, "".join(order), step] = [len(alive), len(gone), len(failing) - len(gone), sum(r[1] == {f} for r in rows), sum(r[2] for r in gone), sum(r[3] for r in gone)]
    return {(p, o, s): (*v, totals[p, o[s - 1]]) for (p, o, s), v in out.items()}


def test_filter_audit_of_odd_rows(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, source string, part string").selectExpr("*", "1 as mask", "2 as n", "'d' as digest", "true as first")
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int").selectExpr("*", "1 as good", "2 as n")
    got = filter_audit.filter_audit(docs, labels, Workspace(spark))
    assert {(r[0], r[1], r[2]): tuple(r[3:]) for r in got.collect()} == brute_force(DOCS, LABELS)
    assert filter_audit.filter_audit(docs.limit(0), labels, Workspace(spark)).count() == 0
    assert filter_audit.filter_audit(docs, labels.limit(0), Workspace(spark)).selectExpr("sum(good_lost + toxic_lost)").first()[0] == 0


def test_path_counts():
    reach, leave = filter_audit.path_counts(4)
    assert reach[0b1111] == leave[0] == 24 and reach[0b0101] == 2 and leave[0b0001] == 6
    assert all(sum(w for _, g, w in filter_audit._edges(4) if g == f) == 24 for f in range(4))
