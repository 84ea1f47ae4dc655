"""Licence scans: a trained paragraph classifier over sparse word n-grams, confirmed against templates.

The classifier is a multinomial logistic regression over words and word pairs, fitted here on paragraphs made by
rule from public licence notices, on notices of made-up licences (`unknown`) and on a bounded sample of paragraphs
(`none`). A temperature fitted on rows kept aside calibrates its probabilities; a family whose probability
stays below the level that nearly all made-up notices stay under is `unknown`, too. A family counts as confirmed if
a template of it is contained in the paragraph.

Notices may be wrapped: a line is judged alone and joined with its neighbours up to a blank line.

Scoring is Spark SQL only: paragraphs with a word of the vocabulary are split into n-grams, which meet the weights (bounded
by the templates, not by the data) in a broadcast join and are summed per paragraph.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapedeck.llm.common import Workspace

#: Rows of `none` taken from documents at most, the first by a hash of their doc_id.
SAMPLE = 300
#: Words that a template's pair of neighbours must share with a paragraph, as a share of the template's.
CONTAINED = 0.6
SHINGLE = 2
#: Words of a longer line that are joined with its neighbours, at either end; lines that one joined with others reaches to, and words: as many as two
#: such ends and more than the longest template.
WRAPPED, LINES, WINDOW = 40, 24, 112

# Names and key sentences of public licences.
TEMPLATES = {
    "Apache-2.0": ["licensed under the Apache License, Version 2.0", "Apache License Version 2.0, January 2004", "Apache 2.0 license"],
    "MIT": [
        "released under the MIT License", "MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    ],
    "GPL-3.0": ["GNU General Public License, version 3", "GNU General Public License as published by the Free Software Foundation, either version 3", "GPL v3"],
    "GPL-2.0": ["GNU General Public License, version 2", "GNU General Public License as published by the Free Software Foundation, either version 2", "GPL v2"],
    "LGPL": ["GNU Lesser General Public License", "LGPL version 2.1"],
    "AGPL-3.0": ["GNU Affero General Public License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "Redistribution and use in source and binary forms, with or without modification, are permitted"],
    "BSD-2-Clause": ["BSD 2-Clause License", "Simplified BSD License"],
    "MPL-2.0": ["Mozilla Public License, version 2.0", "subject to the terms of the Mozilla Public License, v. 2.0"],
    "CC-BY-4.0": ["licensed under CC BY 4.0", "Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA-4.0": ["licensed under CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-NC-4.0": ["licensed under CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC0-1.0": ["CC0 1.0 Universal", "dedicated to the public domain under CC0"],
    "ISC": ["ISC License", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"],
    "Unlicense": ["This is free and unencumbered software released into the public domain"],
    "EPL-2.0": ["Eclipse Public License, version 2.0"],
}
_LEADS = ["", "this work is", "this file is", "copyright the authors,", "distributed under the terms of the", "see the", "the code is covered by the"]
_TAILS = ["", "you may obtain a copy of it", "all other rights reserved", "see the file for details"]
_MADE_UP = ["acme", "example community", "open harbour", "northwind", "fair use", "research only", "house", "vendor", "trial", "partner"]
_MADE_UP_FORMS = [
    "licensed under the {} license", "this work is licensed under the {} terms, version 1", "released under the {} license agreement",
    "distributed under the {} public license, version 5", "use is subject to the {} license", "{} end user license agreement, all rights reserved",
]
#: Words that say nothing about licences on their own; an n-gram needs another word.
_PLAIN = set(
    "a all and any are as at be by copy either for free from in is it its may of on or other see that the this to under use was with you your"
    " version work file files details public person person's charge no not terms any purpose people rights without forms source".split()
)
NONE, UNKNOWN = "none", "unknown"


def tokens(text: str) -> list[str]:
    return [w for w in re.split("[^a-z0-9]+", text.lower()) if w]


def ngrams(words: list[str]) -> set[str]:
    """Words and pairs of neighbours that hold a telling word."""
    pairs = [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]
    return {g for g in [*words, *pairs] if not set(g.split()) <= _PLAIN and not g.isdigit()}


@dataclass
class Model:
    classes: list[str]
    vocabulary: list[str]
    weights: np.ndarray  # n-grams x classes, divided by the temperature
    bias: np.ndarray
    least: float  # probability that a family needs

    def probabilities(self, texts: list[str]) -> np.ndarray:
        place = {g: k for k, g in enumerate(self.vocabulary)}
        scores = np.array([self.bias + sum((self.weights[place[g]] for g in ngrams(tokens(t)) if g in place), np.zeros(len(self.bias))) for t in texts])
        return _softmax(scores)


def _softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(plain: list[str], steps: int = 400) -> Model:
    """The classifier from the templates and `plain` paragraphs, which carry no licence."""
    rows = [(f"{lead} {t} {tail}", family) for family, own in TEMPLATES.items() for t in own for lead in _LEADS for tail in _TAILS]
    rows += [(f"{lead} {form.format(name)}", UNKNOWN) for name in _MADE_UP for form in _MADE_UP_FORMS for lead in _LEADS[:4]]
    rows += [(t, NONE) for t in [*plain, *_LEADS, *_TAILS, "see the terms of use", "an apache helicopter", "the public version of the work", "general software"]]
    classes = [NONE, UNKNOWN, *TEMPLATES]
    vocabulary = sorted(set().union(*(ngrams(tokens(t)) for t, c in rows if c != NONE)))
    place = {g: k for k, g in enumerate(vocabulary)}
    x = np.zeros((len(rows), len(vocabulary) + 1))
    x[:, -1] = 1
    for k, (text, _) in enumerate(rows):
        x[k, [place[g] for g in ngrams(tokens(text)) if g in place]] = 1
    y = np.eye(len(classes))[[classes.index(c) for _, c in rows]]
    aside = np.arange(len(rows)) % 5 == 2
    each = 1 / y[~aside].sum(axis=0)  # classes weigh the same
    weigh = (y[~aside] * each).sum(axis=1, keepdims=True) * (~aside).sum() / len(classes)
    w = np.zeros((x.shape[1], len(classes)))
    for _ in range(steps):
        w += 2.0 * (x[~aside].T @ (weigh * (y[~aside] - _softmax(x[~aside] @ w))) / (~aside).sum() - 2e-4 * w)
    scores = x[aside] @ w
    losses = {t: -np.log((_softmax(scores / t) * y[aside]).sum(axis=1) + 1e-12).mean() for t in np.geomspace(0.2, 5, 40)}
    w /= min(losses, key=losses.get)
    strange = _softmax(x[aside] @ w)[y[aside][:, 1] == 1][:, 2:].max(axis=1)
    return Model(classes, vocabulary, w[:-1], w[-1], float(max(0.5, np.quantile(strange, 0.99))))


def plain_paragraphs(docs: DataFrame, count: int = SAMPLE) -> list[str]:
    """First paragraphs of at most `count` documents by a hash of their doc_id, without those that speak of licences."""
    chosen = docs.where(F.col("text").isNotNull()).orderBy(F.xxhash64("doc_id"), "doc_id").limit(count)
    rows = chosen.select(F.split("text", "\n")[0].alias("t")).where("not lower(t) rlike 'licen[cs]|copyright|permission'").collect()
    return sorted(r["t"] for r in rows)


# ------------------------------------------------------------ scoring, in Spark alone


def word_array(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")


def _pairs(words: Column) -> Column:
    rest = F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0)))
    first = F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0)))
    return F.zip_with(first, rest, lambda a, b: F.concat_ws(" ", a, b))


def _literal_rows(spark: SparkSession, rows: list[dict], kind: str) -> DataFrame:
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{kind}>>")))


def scan(docs: DataFrame, model: Model, work: Workspace) -> DataFrame:
    """doc_id, text -> doc_id, paragraph, family, probability, similarity, confirmed: a row for each paragraph that speaks of a licence.

    A paragraph is a line, counted from 0, or a notice wrapped over lines, which counts as its first line that speaks of a licence
    (see `_joined`). Documents without such a line, null and empty texts have no rows; a repeated row has its own. Of equally
    likely classes the first in the model wins. Other columns are ignored.
    """
    spark = work.spark
    telling = F.array(*[F.lit(w) for w in sorted({w for g in model.vocabulary for w in g.split()} - _PLAIN)])
    lines = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), F.transform(F.split("text", "\n"), word_array).alias("lines"))
    places = F.filter(F.sequence(F.lit(0), F.size("lines") - 1), lambda k: F.arrays_overlap(F.col("lines")[k], telling))
    units = F.transform(places, lambda k: F.struct(k.alias("paragraph"), F.col("lines")[k].alias("alone"), _joined(F.col("lines"), k).alias("joined")))
    told = lines.where("size(lines) > 0").select("doc_id", "row", F.inline(units))
    # Written aside: few, and what follows must see the same row numbers in every attempt.
    told = work.keep(told)
    both = F.array(F.struct(F.lit(False).alias("wrapped"), F.col("alone").alias("words")), F.struct(F.lit(True).alias("wrapped"), F.col("joined").alias("words")))
    told = told.select("doc_id", "row", "paragraph", F.inline(F.filter(both, lambda u: F.size(u["words"]) > 0)))
    unit = ["row", "paragraph", "wrapped"]
    grams = told.select(*unit, F.explode(F.array_distinct(F.concat("words", _pairs(F.col("words"))))).alias("gram"))
    size = len(model.classes)
    weights = _literal_rows(spark, [{"gram": g, "w": w.tolist()} for g, w in zip(model.vocabulary, model.weights, strict=True)], "gram:string,w:array<double>")
    sums = grams.join(F.broadcast(weights), "gram").groupBy(*unit).agg(*[F.sum(F.col("w")[k]).alias(f"s{k}") for k in range(size)])
    scores = F.array(*[F.col(f"s{k}") + F.lit(float(model.bias[k])) for k in range(size)])
    e = sums.select(*unit, scores.alias("s")).withColumn("top", F.array_max("s"))
    e = e.withColumn("p", 1 / F.aggregate("s", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top"))))
    names = F.array(*[F.lit(c) for c in model.classes])
    e = e.select(*unit, "p", names[F.array_position("s", F.col("top")).cast("int") - 1].alias("best")).where(F.col("best") != NONE)

    templates = [{"best": f, "template": _shingles(t)} for f, own in TEMPLATES.items() for t in own]
    found = told.join(e, unit)
    own = F.array_distinct(_pairs(F.col("words")))
    compared = found.select("*", own.alias("own")).join(F.broadcast(_literal_rows(spark, templates, "best:string,template:array<string>")), "best", "left")
    share = F.size(F.array_intersect("own", "template")) / F.size("template")
    best = compared.groupBy("doc_id", *unit, "best", "p").agg(F.coalesce(F.max(share), F.lit(0.0)).alias("similarity"))
    sure = (F.col("p") >= model.least) & (F.col("best") != UNKNOWN)
    family = F.when(sure & (F.col("similarity") >= CONTAINED), F.col("best")).otherwise(UNKNOWN)
    judged = best.select("doc_id", *unit, F.struct(family.alias("family"), F.col("p").alias("probability"), "similarity").alias("found"))
    once = judged.groupBy("row", "paragraph").agg(
        F.first("doc_id").alias("doc_id"), *[F.max(F.when(F.col("wrapped") == w, F.col("found"))).alias(n) for n, w in (("alone", False), ("joined", True))]
    )
    named = lambda c: F.coalesce(F.col(c)["family"] != UNKNOWN, F.lit(False))
    around = Window.partitionBy("row").orderBy("paragraph").rangeBetween(-1, LINES)
    near = once.withColumn("near", F.collect_list(F.when(named("alone"), F.col("alone"))).over(around))
    own = F.filter("near", lambda x: x["family"] == F.col("joined")["family"])
    # A line of a wrapped notice: joined with its neighbours it holds more of the template than any of them alone.
    more = F.coalesce(F.array_max(F.transform(own, lambda x: x["similarity"])) < F.col("joined")["similarity"], F.lit(True))
    better = ~named("alone") | (F.col("alone")["similarity"] < F.col("joined")["similarity"])
    near = near.withColumn("wrapped", named("joined") & more & better)
    chosen = near.select("doc_id", "row", "paragraph", "wrapped", F.when(F.col("wrapped"), F.col("joined")).otherwise(F.col("alone")).alias("x"))
    # The first line of a notice has its row.
    before = F.lag("paragraph").over(Window.partitionBy("row", "wrapped", "x.family").orderBy("paragraph"))
    follows = F.col("wrapped") & F.coalesce(F.col("paragraph") - F.col("before") <= 2, F.lit(False))
    rows = chosen.where("x is not null").withColumn("before", before).where(~follows)
    return rows.select("doc_id", "paragraph", "x.*", (F.col("x.family") != UNKNOWN).alias("confirmed"))


def _joined(lines: Column, k: Column) -> Column:
    """The words of the line before `k`, of `k` and of those after it, up to a line without words.

    A line of more than WRAPPED words takes part with so many at its end, where a notice may begin, or at its beginning, where one may go on;
    nothing behind it is joined. No words if `k` stands alone.
    """
    head = lambda words: F.slice(words, F.lit(1), F.lit(WRAPPED))
    tail = lambda words: F.slice(words, F.greatest(F.size(words) - WRAPPED, F.lit(0)) + 1, F.lit(WRAPPED))
    is_long = lambda words: F.size(words) > WRAPPED
    until = lambda found, test: F.array_position(F.transform(found, test), F.lit(True)).cast("int")
    after = F.slice(lines, k + 2, LINES)
    end = until(after, lambda w: F.size(w) == 0)
    after = F.when(end > 0, F.slice(after, F.lit(1), F.greatest(end - 1, F.lit(0)))).otherwise(after)
    last = until(after, is_long)
    after = F.transform(F.when(last > 0, F.slice(after, F.lit(1), F.greatest(last, F.lit(0)))).otherwise(after), head)
    before = F.filter(F.when(k > 0, F.slice(lines, F.greatest(k, F.lit(1)), F.lit(1))).otherwise(F.slice(lines, 1, 0)), lambda w: F.size(w) > 0)
    none = F.slice(lines[k], 1, 0)
    own = F.when(is_long(lines[k]), F.concat(head(lines[k]), tail(lines[k]))).otherwise(lines[k])
    words = F.flatten(F.concat(F.transform(before, tail), F.array(own), after))
    longest = WINDOW + F.greatest(F.size(own) - WRAPPED, F.lit(0))
    return F.when((F.size(lines[k]) > 0) & (F.size(before) + F.size(after) > 0), F.slice(words, F.lit(1), longest)).otherwise(none)


def _shingles(text: str) -> list[str]:
    words = tokens(text)
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})
