"""Pipeline stages on odd rows, chat transcripts against all paths, and spans of secrets against a plain merge."""

import random
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tapedeck.llm import chat, secret_scan, simhash
from tapedeck.llm.common import Workspace

PROSE = "the quick brown fox jumps over the lazy dog and then it runs back to the river where all the other foxes wait for it to come home again"
TEXTS = [PROSE, PROSE.upper(), None, "", PROSE + " password=abcdef123", "x " * 2000, "Ω"]


def odd_docs(spark):
    rows = [(k % 5 if k % 4 else None, TEXTS[k % len(TEXTS)], "en", "s", None, 1, 2, "d") for k in range(21)]
    columns = "doc_id long, text string, lang string, source string, n_chars int, __lang int, component_id long, __scan string"
    return spark.createDataFrame(rows, columns).withColumn("m", F.create_map(F.lit("a"), F.lit(1)))


def test_one_row_of_each_group_stays_also_without_ids(spark):
    docs, work = odd_docs(spark), Workspace(spark)
    kept = simhash.one_of_each(docs, work)
    assert kept.columns == docs.columns
    texts = [r["text"] for r in kept.collect()]
    # Upper case, null and empty fall together with what they are like.
    assert sorted(len(t or "") for t in texts) == sorted([0, len(TEXTS[0]), len(TEXTS[4]), 4000, 1])
    ids = {r["text"]: r["doc_id"] for r in kept.collect()}
    of_prose = [r["doc_id"] for r in docs.collect() if r["text"] in TEXTS[:2] and r["doc_id"] is not None]
    assert next(ids[t] for t in TEXTS[:2] if t in ids) == min(of_prose)
    nameless = docs.withColumn("doc_id", F.lit(None).cast("long"))
    assert simhash.one_of_each(nameless, work).count() == len(texts) and simhash.one_of_each(docs.limit(0), work).count() == 0


def test_every_stage_takes_odd_rows_and_empty_tables(spark, sf_dir):
    docs = odd_docs(spark)
    for name, stage in corpus_pipeline.STAGES:
        for rows in (docs, docs.limit(0)):
            out = stage(spark, rows, sf_dir)
            assert name == "packing" or out.columns == docs.columns
            assert out.count() >= 0


def test_language_stage_rejects_what_is_surely_mislabelled(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("lang = 'fr' and length(text) > 300").limit(6)
    wrong = docs.withColumn("lang", F.lit("en")).unionByName(docs).unionByName(docs.withColumn("lang", F.lit(None).cast("string")))
    kept = corpus_pipeline.keep_known_languages(spark, wrong, sf_dir)
    assert sorted(str(r["lang"]) for r in kept.collect()) == ["None"] * docs.count() + ["fr"] * docs.count()


def test_spans_are_merged_as_one_by_one():
    rnd = random.Random(3)

    def plain(base, found, steps):
        free = [f for f in sorted(found) if f[3] <= steps.get(f[2], -1) and not any(b < f[1] and f[0] < e for _, b, e in base)]
        out = []
        for start, end, *_ in free:
            if out and out[-1][2] > start:
                out[-1] = (3, out[-1][1], max(out[-1][2], end))
            else:
                out.append((3, start, end))
        return sorted([*base, *out], key=lambda s: (s[1], s[0]))

    for _ in range(500):
        base = [(rnd.randint(0, 2), a, a + rnd.randint(1, 9)) for a in rnd.sample(range(200), rnd.randint(0, 12))]
        found = [(a, a + rnd.randint(1, 12), rnd.randint(0, 2), rnd.randint(0, 4)) for a in rnd.sample(range(200), rnd.randint(0, 20))]
        assert secret_scan.all_spans(base, found, {0: 2, 1: 4}) == plain(base, found, {0: 2, 1: 4})
    many = [(0, 10 * k, 10 * k + 4) for k in range(100_000)]
    assert len(secret_scan.all_spans(many, [(10 * k + 5, 10 * k + 9, 0, 0) for k in range(100_000)], {0: 0})) == 200_000


def test_long_runs_are_not_remembered():
    before = secret_scan._known_step.cache_info().currsize
    for k in range(20):
        secret_scan.step_of("aB3" * 5000 + str(k), "base64")
    assert secret_scan._known_step.cache_info().currsize == before


@pytest.fixture(scope="module")
def model():
    talks = [[("user", f"User: ask {k}?\nmore"), ("assistant", f"Assistant: say {k}.\n\nContext: a file\nAnswer: 42\nfine."), ("user", "\nand bare?"), ("assistant", "Assistant: yes.\n")] for k in range(40)]
    return chat.fit(talks)


def test_piecewise_paths_are_the_best_of_all(spark, model):
    rnd, work = random.Random(8), Workspace(spark)
    lines = ["User: a?", "Assistant: b.", "Context: a file", "plain", "", "Answer: 42"]
    talks = [[rnd.choice(lines) for _ in range(5)] for _ in range(12)]
    chunks = [(t, k, "\n".join(talk[2 * k : 2 * k + 2])) for t, talk in enumerate(talks) for k in range(3)]
    got = chat.parse(spark.createDataFrame(chunks, "conv_id long, seq long, text string"), model, work).collect()
    for t, talk in enumerate(talks):
        e = model.emissions(talk)
        paths = list(product(range(chat.STATES), repeat=5))
        score = [model.start[p[0]] + sum(model.follow[a, b] for a, b in zip(p, p[1:])) + sum(e[k, s] for k, s in enumerate(p)) for p in paths]
        best = {p for p, x in zip(paths, score, strict=True) if x >= max(score) - 1e-9}
        turns = [r["role"] for r in sorted((r for r in got if r["conv_id"] == t), key=lambda r: r["turn"])]
        assert any(turns == ([chat.ROLES[s // 2] for s in p if s % 2 == 0] or [chat.ROLES[p[0] // 2]]) for p in best), talk


def test_lines_that_go_on_are_kept_whole_and_blank_lines_begin_nothing(spark, model):
    chunks = [(1, 0, "User: ask?\n"), (1, 1, "Assistant: say this.\n\nContext: a file\nAnswer: 42\nfine.\n"), (1, 2, "\n\nand bare?\n\n")]
    chunks += [(2, None, "User: a?"), (2, None, "Assistant: b.")] + [(3, None, f"line {k:03d}.") for k in range(50)]
    rows = chat.parse(spark.createDataFrame(chunks, "conv_id long, seq long, text string"), model, Workspace(spark)).collect()
    first = [(r["role"], r["text"]) for r in sorted((r for r in rows if r["conv_id"] == 1), key=lambda r: r["turn"])]
    assert all(text for _, text in first) and "Context: a file\nAnswer: 42\nfine." in first[1][1]
    assert [r["role"] for r in sorted((r for r in rows if r["conv_id"] == 2), key=lambda r: r["turn"])] == ["assistant", "user"]
    rest = "\n".join(r["text"] for r in sorted((r for r in rows if r["conv_id"] == 3), key=lambda r: r["turn"]))
    assert rest == "\n".join(f"line {k:03d}." for k in range(50))


def test_blocks_hold_rows_by_their_number(spark):
    rows = spark.createDataFrame([(k % 2, None if k % 3 else 5, f"t{k:03d}") for k in range(60)], "conv_id long, seq long, text string")
    got = chat.in_blocks(rows, 7).collect()
    assert len(got) == 60 and max(r["place"] for r in got) == 7 and len({(r["block"], r["place"]) for r in got}) == 60
    for c in (0, 1):
        mine = [(r["seq"] or -1, r["text"]) for r in sorted((r for r in got if r["conv_id"] == c), key=lambda r: (r["block"], r["place"]))]
        assert mine == sorted(mine)
    assert {r["conv_id"] for r in got if r["block"] == got[0]["block"]} == {got[0]["conv_id"]}


def test_turns_of_transcripts_that_the_model_has_not_seen(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/conversations.parquet")
    learned = chat.learn(turns.where("conv_id % 2 = 0"))
    odd = turns.where("conv_id % 2 = 1")
    got = chat.parse(chat.as_transcript(odd), learned, Workspace(spark)).toPandas()
    true = odd.toPandas()
    pairs = {(c, r, t.strip()) for c, r, t in zip(true.conv_id, true.role, true.text, strict=True)}
    hits = sum((c, r, t) in pairs for c, r, t in zip(got.conv_id, got.role, got.text, strict=True))
    print("recall", hits / len(true), "precision", hits / len(got), "empty", int((got.text == "").sum()))
    assert (got.text == "").sum() <= 0.01 * len(got) and hits / len(true) >= 0.9 and hits / len(got) >= 0.9
    assert np.isclose(len(got), len(true), rtol=0.1)
