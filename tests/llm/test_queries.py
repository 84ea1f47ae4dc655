"""The operators in Spark: odd rows, empty tables, and the given tables against brute force."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tapedeck.llm import ann, chat, html_text, langid, license_scan, packing, pieces, quality, queries, secret_scan, simhash
from tapedeck.llm.common import Workspace, table
from tapedeck.llm.components import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, component_id long, length long, spans string"
LONG = "word " * 30_000 + "\nLicensed under the MIT License."
ROWS = [
    (1, "alpha beta gamma delta epsilon", "x", None, None, 0.5, 9, 1, "s"), (2, "Alpha beta gamma delta epsilon", "x", None, None, 0.5, 9, 1, "s"),
    (3, None, None, None, None, None, None, None, None), (4, "", "y", "s", 0, None, None, None, None), (5, LONG, "y", "s", 1, None, None, None, None),
    (5, LONG, "y", "s", 1, None, None, None, None), (None, "password=abcdef123", None, None, None, None, None, None, None),
    (7, "Licensed under the Apache License, Version 2.0.\n\nplain", "x", "s", 3, None, None, None, None),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS)


@pytest.fixture(scope="module")
def work(spark):
    return Workspace(spark)


@pytest.fixture(scope="module")
def tokenizers():
    return pytest.importorskip("public_tokenizers").path


def test_components(spark, work):
    edges = [(1, 2), (2, 3), (3, 3), (10, 11), *[(100, k) for k in range(101, 140)], *[(k, k + 1) for k in range(200, 240)]]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long"), work).collect()}
    groups = pd.Series(got).groupby(pd.Series(got)).apply(lambda s: frozenset(s.index))
    assert set(groups) == {frozenset({1, 2, 3}), frozenset({10, 11}), frozenset(range(100, 140)), frozenset(range(200, 241))}


def test_near_duplicates_of_odd_rows(docs, work):
    rows = simhash.near_duplicates(docs, work).collect()
    assert len(rows) == len(ROWS)
    by = {r["doc_id"]: r for r in rows}
    assert by[1]["component_id"] == by[2]["component_id"] == 1 and by[3]["component_id"] == by[4]["component_id"] == 3
    assert by[3]["fingerprint"] == "0" * 16 and by[None]["component_id"] is None
    assert simhash.near_duplicates(docs.limit(0), work).count() == 0


def test_plain_operators_on_odd_rows(docs, work, tokenizers):
    samples = langid.learn(docs.fillna({"lang": "x"}))
    told = {r["doc_id"]: r for r in langid.identify(docs, samples).collect()}
    assert told[3]["lang_pred"] == told[4]["lang_pred"] == "und" and told[3]["score"] == 0 and not told[None]["held_out"]
    assert langid.learn(docs.limit(0)) == ()

    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    judged = quality.quality_rules(docs, quality.fit(docs, labels)).collect()
    assert len(judged) == len(ROWS) and {r["n_words"] for r in judged if r["doc_id"] in (3, 4)} == {0} and not any(r["kept"] for r in judged)
    assert quality.quality_rules(docs.limit(0), quality.fit(docs.limit(0), labels.limit(0))).count() == 0

    ids = {r["doc_id"]: r for r in pieces.digests(docs, tokenizers("piece_bpe_32k.model")).collect()}
    assert ids[3]["n_tokens"] == ids[4]["n_tokens"] == 2 and ids[3]["ids_sha256"] == ids[4]["ids_sha256"]
    assert pieces.encode(docs.limit(2), tokenizers("piece_bpe_32k.model")).first()["decoded"] == ROWS[0][1]

    packed = packing.pack(docs, tokenizers("word_bpe_49k.json"), work, block=20).toPandas()
    assert packed[packed.doc_id == 3].length.tolist() == [1] and (packed[packed.doc_id == 5].groupby("piece").size() == 2).all()
    ordered = packed.sort_values(["sequence_id", "offset"])
    assert (ordered.groupby("sequence_id").length.cumsum() - ordered.length == ordered.offset).all()
    assert packed.groupby("sequence_id").length.sum().max() <= 2048
    assert packing.pack(docs.limit(0), tokenizers("word_bpe_49k.json"), work).count() == 0


def test_scans_of_odd_rows(docs, work):
    found = {r["doc_id"]: r for r in secret_scan.find_secrets(docs, work).collect()}
    assert found[None]["n_assign"] == 1 and found[None]["spans"] == "assign:0:18" and found[3]["spans"] == ""
    assert secret_scan.find_secrets(docs.limit(0), work).count() == 0
    model = license_scan.fit(license_scan.plain_paragraphs(docs))
    licences = license_scan.scan(docs, model, work)
    assert sorted((r["doc_id"], r["paragraph"], r["family"]) for r in licences.collect()) == [(5, 1, "MIT"), (5, 1, "MIT"), (7, 0, "Apache-2.0")]
    assert license_scan.scan(docs.limit(0), model, work).count() == 0
    plan = licences._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_pages_and_chats_of_odd_rows(spark, work):
    pages = spark.createDataFrame([(1, "u", None, "t"), (1, "u", "", "t"), (None, None, "<article><p>Some text here.</p></article>", None)], "page_id long, url string, html string, text string")
    got = html_text.extract(pages, html_text.fit(pages)).collect()
    assert sorted((r["text"], r["n_chars"]) for r in got) == [("", 0), ("", 0), ("Some text here.", 15)]
    assert html_text.extract(pages.limit(0), html_text.fit(pages.limit(0))).count() == 0

    chunks = [(1, 0, "User: hello?"), (1, 0, "User: hello?"), (1, 1, "Assistant: yes.\nmore"), (1, 2, "and more"), (1, 5000, "User: bye"), (None, None, None), (2, 0, "")]
    frame = spark.createDataFrame(chunks, "conv_id long, seq long, text string").withColumn("turn", F.lit("x"))
    rows = chat.parse(frame, chat.fit([]), work).collect()
    first = sorted((r["turn"], r["role"], r["text"]) for r in rows if r["conv_id"] == 1)
    assert first == [(0, "user", "hello?"), (1, "assistant", "yes.\nmore\nand more"), (2, "user", "bye")]
    assert next(r["rendered"] for r in rows if r["text"] == "bye") == "<|im_start|>user\nbye<|im_end|>\n"
    assert {r["conv_id"] for r in rows} == {1, 2, None}
    assert chat.parse(frame.limit(0), chat.fit([]), work).count() == 0


def test_wrapped_licence_notices(spark, work):
    apache = "# This file is licensed under the Apache\n# License, Version 2.0.\n#\n# code"
    gpl = (" * This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU General Public License as published by\n"
           " * the Free Software Foundation, either version {} of the License, or\n * (at your option) any later version.\n *\n")  # fmt: skip
    isc = "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice appear in all copies."
    texts = [apache, gpl.format(3), gpl.format(2), isc, "plain\n\n" + apache + "\n\n" + isc, "foo: MIT License\nbar: Apache License Version 2.0, January 2004\nReleased under the Foobar Community License"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = license_scan.fit(["Plain prose about cats.", "Another paragraph."])
    got = sorted((r["doc_id"], r["paragraph"], r["family"]) for r in license_scan.scan(docs, model, work).collect())
    assert got == [(0, 0, "Apache-2.0"), (1, 0, "GPL-3.0"), (2, 0, "GPL-2.0"), (3, 0, "ISC"), (4, 2, "Apache-2.0"), (4, 7, "ISC"),
                   (5, 0, "MIT"), (5, 1, "Apache-2.0"), (5, 2, "unknown")]


def test_notices_that_begin_or_end_in_a_long_line(spark, work):
    prose = "one of the many things that we have to say here is said in a line that nobody has wrapped and that goes on for quite a while before it comes"
    prose = f"{prose} to an end about rivers and hills and the animals there which is why this file is"
    assert len(prose.split()) >= 45
    texts = [
        f"{prose} licensed under the Apache\nLicense, Version 2.0.\nplain", f"This file is licensed under the Apache\nLicense, Version 2.0. {prose}",
        f"{prose} free.\n{prose} open.", f"{prose}\n\nThis file is licensed under the Apache License, Version 2.0.",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = license_scan.fit(["Plain prose about cats.", "Another paragraph.", prose])
    got = sorted((r["doc_id"], r["paragraph"], r["family"]) for r in license_scan.scan(docs, model, work).collect())
    assert got == [(0, 0, "Apache-2.0"), (1, 0, "Apache-2.0"), (3, 2, "Apache-2.0")]


def test_secrets_behind_names_and_in_paths_are_reported_once(spark, work):
    rnd = np.random.default_rng(3)
    letters = list(secret_scan.ALPHABETS["base64"][:62])
    keys = ["".join(rnd.choice(letters, 40)) for _ in range(60)]
    forms = ["SOME_NAME={}", "x.io/cb?sig={}&n=1", "x.io/services/T00-a/{}"]
    prose = " ".join("".join(rnd.choice(list("etaoinshr"), 6)) for _ in range(30_000))
    rows = [(k, forms[k % 3].format(key)) for k, key in enumerate(keys)] + [(100 + k, prose[k:]) for k in range(80)]
    got = secret_scan.find_secrets(spark.createDataFrame(rows, "doc_id long, text string"), work).where("doc_id < 100").collect()
    hidden = [r for r in got if r["n_random"] == 1 and int(r["spans"].split(":")[1]) <= rows[r["doc_id"]][1].index(keys[r["doc_id"]])]
    assert len(hidden) >= 50 and all(r["n_random"] <= 1 for r in got)


def test_neighbours_of_odd_rows(spark, work):
    rng = np.random.default_rng(1)
    rows = [(k, [float(x) for x in rng.normal(size=8)]) for k in range(60)]
    rows += [(100 + k, rows[0][1]) for k in range(40)] + [rows[1], (200, None), (201, [0.0] * 8), (202, [float("nan")] * 8), (203, [1.0]), (None, rows[2][1])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(1))
    got = ann.search(frame, F.col("vec_id") % 20 == 0, work).toPandas()
    kept = {k: np.array(v, np.float32).astype(float) for k, v in rows if k is not None and k < 200}
    ids = np.array(sorted(kept))
    want = ann.brute_force(ids, np.array([kept[k] for k in ids]), [k for k in ids if k % 20 == 0])
    assert {q: g.sort_values("rank").vec_id.tolist() for q, g in got.groupby("query_id")} == want
    assert ann.search(frame.limit(0), F.col("vec_id") % 20 == 0, work).count() == 0


def test_held_out_languages_and_kept_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").toPandas()
    told = queries.op3_language(spark, sf_dir).toPandas().merge(docs, on="doc_id")
    assert (told[told.held_out].lang == told[told.held_out].lang_pred).mean() >= 0.95
    labels = table(spark, sf_dir, "labels").toPandas()
    judged = queries.op10_quality(spark, sf_dir).toPandas().merge(labels, on="doc_id", suffixes=("", "_label"))
    clean = judged[(judged.quality_label == 1) & ~judged.base_failed]
    assert clean.kept.mean() >= 0.95 and judged[judged.quality_label == 0].kept.mean() <= 0.1


def test_pipeline_keeps_its_promises(spark, sf_dir, work):
    docs = table(spark, sf_dir, "documents")
    assert [len(s) for s in corpus_pipeline.STAGES] == [2] * 5 and corpus_pipeline.ORACLE_SQL is None
    kept = corpus_pipeline.keep_one_of_each_group(spark, docs, sf_dir)
    assert kept.columns == docs.columns and kept.select("doc_id").distinct().count() == kept.count()
    groups = {r["component_id"] for r in simhash.near_duplicates(docs, work).collect()}
    assert {r["doc_id"] for r in kept.collect()} == groups
    clean = corpus_pipeline.replace_secrets(spark, docs, sf_dir)
    assert clean.columns == docs.columns and clean.count() == docs.count()
    assert secret_scan.find_secrets(clean, work).filter("spans <> ''").count() == 0


def test_quality_of_documents_that_the_trees_did_not_see(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.01", n) for n in ("documents", "labels"))
    seen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    judged = quality.quality_rules(docs, quality.fit(docs, labels.where(seen))).withColumnRenamed("quality", "p")
    unseen = judged.join(labels.where(~seen), "doc_id").where("not base_failed").toPandas()
    assert len(unseen) > 100 and (unseen.kept == (unseen.quality == 1)).mean() >= 0.95
