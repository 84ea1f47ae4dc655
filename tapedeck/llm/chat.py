"""Chat formatting: roles recovered from raw transcripts by a hidden Markov model.

A transcript comes as chunks of lines in order. A state is a role and whether the line begins a turn or goes on with it;
a line is seen through its speaker marker, its length, its end and whether the line before it is blank. Start, transition
and emission probabilities are counted on a bounded sample of conversations with known roles.

Viterbi runs on pieces: every chunk is reduced to the best scores from each state before it to each state after it, chunks
to blocks, and blocks to a transcript. Going back down, the best states at the borders fix each block, then each chunk, then
its lines, so that no task needs more of a transcript than `BLOCK` chunks or its list of blocks. A block holds the next `BLOCK` chunks in order,
whatever their sequence numbers are. A blank line never begins a turn, and a line that goes on with one is kept whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapedeck.llm.common import Workspace

ROLES = ["system", "user", "assistant"]
#: State 2 * role begins a turn of the role, 2 * role + 1 goes on with it.
STATES = 2 * len(ROLES)
#: Chunks whose matrices are multiplied in one row of work.
BLOCK = 4096
#: Conversations that the model is counted on at most, and how long one of them may be: longer ones are not drawn.
SAMPLE, SAMPLE_TURNS, SAMPLE_CHARS = 1500, 64, 100_000
#: What a blank line costs as the beginning of a turn.
_NO_TURN = -1e6

# Names that dumps use for speakers.
_SPEAKERS = [
    ("system", "system|instructions?|context"),
    ("user", "user|human|q|question|customer|me|prompt"),
    ("assistant", "assistant|ai|bot|a|answer|model|agent"),
]
_NAMES = "|".join(f"(?P<{role}>{names})" for role, names in _SPEAKERS)
_MARKER = re.compile(rf"\s*(?:<\|im_start\|>\s*(?:{_NAMES.replace('(?P<', '(?P<t_')})\s*|(?:\#{{1,4}}\s*|\*\*|\[|<\|?)?(?:{_NAMES})(?:\*\*|\]|\|?>)?\s*[:>]\s?(?:\*\*)?\s?)", re.I)
_OTHER = re.compile(r"\s*[A-Z][\w .]{0,24}:\s")
_END = re.compile(r"\s*<\|im_end\|>\s*$")
MARKS = 6  # none, other, system, user, assistant, end
LENGTHS, ENDS = 4, 3


def marker_of(line: str) -> tuple[int, str]:
    """The kind of speaker marker in front of a line, and the line without it."""
    m = _MARKER.match(line)
    if m:
        role = next(k for k, v in m.groupdict().items() if v is not None).removeprefix("t_")
        return 2 + ROLES.index(role), _END.sub("", line[m.end() :])
    if _END.search(line):
        return 5, _END.sub("", line)
    return int(bool(_OTHER.match(line))), line


def observations(lines: list[str]) -> list[tuple[int, int, int, int]]:
    out, blank = [], 0
    for line in lines:
        mark, body = marker_of(line)
        size = len(body.strip())
        ends = 2 if body.rstrip().endswith("?") else int(body.rstrip().endswith((".", "!", ":")))
        out.append((mark, (size > 0) + (size > 60) + (size > 300), ends, blank))
        blank = int(size == 0)
    return out


class Model:
    """Logarithms of counted probabilities."""

    def __init__(self, start: np.ndarray, follow: np.ndarray, parts: list[np.ndarray]):
        self.start, self.follow = _logs(start), _logs(follow)
        self.parts = [_logs(p) for p in parts]

    def emissions(self, lines: list[str]) -> np.ndarray:
        seen = np.array(observations(lines), int)
        scores = sum(p[:, seen[:, k]] for k, p in enumerate(self.parts)).T
        scores[(seen[:, 0] < 2) & (seen[:, 1] == 0), ::2] += _NO_TURN
        return scores

    def matrix(self, text: str | None) -> np.ndarray:
        """Best score from each state before these lines to each state at their last one."""
        total = None
        for e in self.emissions((text or "").split("\n")):
            step = self.follow + e
            total = step if total is None else times(total, step)
        return total

    def states(self, text: str | None, before: int, after: int) -> list[int]:
        """The best states of the lines between the given borders. before = -1: the transcript begins here."""
        e = self.emissions((text or "").split("\n"))
        score, back = (self.start if before < 0 else self.follow[before]) + e[0], []
        for row in e[1:]:
            every = score[:, None] + self.follow
            back.append(every.argmax(axis=0))
            score = every.max(axis=0) + row
        out = [after if after >= 0 else int(score.argmax())]
        for pointers in reversed(back):
            out.append(int(pointers[out[-1]]))
        return out[::-1]


def _logs(counts: np.ndarray) -> np.ndarray:
    counts = np.asarray(counts, float) + 0.1
    return np.log(counts / counts.sum(axis=-1, keepdims=True))


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a[:, :, None] + b[None, :, :]).max(axis=1)


def borders(matrices: list[np.ndarray], first: np.ndarray | None, before: int, after: int) -> list[tuple[int, int]]:
    """(state before, state at the end) of each matrix on the best path. `first` is the row vector of a transcript's beginning."""
    score, back = (first if before < 0 else matrices[0][before]), []
    for m in matrices[1:]:
        every = score[:, None] + m
        back.append(every.argmax(axis=0))
        score = every.max(axis=0)
    ends = [after if after >= 0 else int(score.argmax())]
    for pointers in reversed(back):
        ends.append(int(pointers[ends[-1]]))
    ends.reverse()
    return list(zip([before, *ends[:-1]], ends, strict=True))


def fit(labelled: list[list[tuple[str, str]]]) -> Model:
    """Counted on conversations given as (role, raw chunk) in order; every line of a chunk has its role."""
    start, follow = np.zeros(STATES), np.zeros((STATES, STATES))
    parts = [np.zeros((STATES, n)) for n in (MARKS, LENGTHS, ENDS, 2)]
    # What holds without any sample: a marker starts its speaker's turn, and turns go on more often than not.
    for r in range(len(ROLES)):
        parts[0][2 * r, 2 + r] += 8
        parts[0][2 * r + 1, [0, 5]] += 4
        follow[[2 * r, 2 * r + 1], 2 * r + 1] += 2
    start[::2] += 1
    for conversation in labelled:
        states, lines = [], []
        for role, chunk in conversation:
            if role in ROLES:
                own, state = chunk.split("\n"), 2 * ROLES.index(role)
                # Blank lines in front belong to the turn before.
                ahead = next((k for k, line in enumerate(own) if line.strip()), 0) if states else 0
                states += [states[-1] | 1 if states else state] * ahead + [state] + [state + 1] * (len(own) - ahead - 1)
                lines += own
        if states:
            start[states[0]] += 1
            np.add.at(follow, (states[:-1], states[1:]), 1)
            for k, column in enumerate(np.array(observations(lines), int).T):
                np.add.at(parts[k], (states, column), 1)
    return Model(start, follow, parts)


def rendered(role: Column, text: Column) -> Column:
    """The canonical form of a turn."""
    return F.concat(F.lit("<|im_start|>"), role, F.lit("\n"), text, F.lit("<|im_end|>\n"))


def in_blocks(rows: DataFrame, most: int = BLOCK) -> DataFrame:
    """conv_id, seq, text -> with `block` and `place` (from 1): a conversation's rows in the order of seq, nulls first, then text, `most` to a block.

    Partitions are ranges of that order, so that a long conversation, or one whose rows have no seq, spreads over many.
    """

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, place, last = TaskContext.get().partitionId() << 32, 0, None
        for batch in batches:
            blocks, places = [], []
            for key in batch["key"]:
                if place == most or (last is not None and key != last):
                    block, place = block + 1, 0
                place, last = place + 1, key
                blocks.append(block)
                places.append(place)
            yield batch.drop(columns="key").assign(block=blocks, place=places)

    key = F.when(F.col("conv_id").isNull(), "").otherwise(F.concat(F.lit("c"), F.col("conv_id").cast("string")))
    order = [F.col("key"), F.col("seq").asc_nulls_first()]
    spread = rows.withColumn("key", key).repartitionByRange(*order, F.substring("text", 1, 200)).sortWithinPartitions(*order, "text")
    kind = rows.schema["conv_id"].dataType.simpleString()
    return spread.mapInPandas(number, f"conv_id {kind}, seq long, text string, block long, place int")


def parse(chunks: DataFrame, model: Model, work: Workspace) -> DataFrame:
    """conv_id, seq, text -> conv_id, turn (from 0), role, text, rendered: the turns of each transcript.

    Chunks are taken by (seq, text), nulls first; exact repeats of a chunk count once, null texts as empty lines, and rows with
    a null conv_id form one transcript. Turns of nothing but white space are returned with an empty text. Other columns are ignored.
    """
    rows = in_blocks(chunks.select("conv_id", F.col("seq").cast("long").alias("seq"), F.coalesce("text", F.lit("")).alias("text")).distinct())

    @F.pandas_udf("array<double>")
    def matrix(texts: pd.Series) -> pd.Series:
        return pd.Series([model.matrix(t).ravel() for t in texts], dtype=object)

    @F.pandas_udf("array<double>")
    def opening(texts: pd.Series) -> pd.Series:
        """The scores after a chunk that begins a transcript."""
        out = []
        for text in texts:
            e = model.emissions(text.split("\n"))
            score = model.start + e[0]
            for row in e[1:]:
                score = (score[:, None] + model.follow).max(axis=0) + row
            out.append(score)
        return pd.Series(out, dtype=object)

    scored = work.keep(rows.withColumn("m", matrix.asNondeterministic()("text")).withColumn("o", opening.asNondeterministic()("text")))
    entry = F.struct("place", "m", "o")
    blocks = scored.groupBy("conv_id", "block").agg(F.array_sort(F.collect_list(entry)).alias("own"))
    blocks = work.keep(blocks.select("conv_id", "block", F.col("own.m").alias("ms"), F.col("own")[0]["o"].alias("o")))

    def product(ms) -> np.ndarray:
        total = None
        for m in ms:
            m = np.asarray(m).reshape(STATES, STATES)
            total = m if total is None else times(total, m)
        return total

    @F.pandas_udf("m array<double>, o array<double>")
    def whole(ms: pd.Series, os: pd.Series) -> pd.DataFrame:
        """A block's matrix, and its scores if it begins the transcript."""
        out = []
        for own, o in zip(ms, os, strict=True):
            rest = product(own[1:]) if len(own) > 1 else None
            first = np.asarray(own[0]).reshape(STATES, STATES)
            opened = np.asarray(o) if rest is None else times(np.asarray(o)[None, :], rest)[0]
            out.append(((first if rest is None else times(first, rest)).ravel(), opened))
        return pd.DataFrame(out, columns=["m", "o"])

    @F.pandas_udf("array<struct<before:int, after:int>>")
    def path(ms: pd.Series, os: pd.Series, before: pd.Series, after: pd.Series) -> pd.Series:
        out = []
        for own, o, b, a in zip(ms, os, before, after, strict=True):
            matrices = [np.asarray(m).reshape(STATES, STATES) for m in own]
            out.append([{"before": x, "after": y} for x, y in borders(matrices, np.asarray(o), int(b), int(a))])
        return pd.Series(out, dtype=object)

    joint = blocks.select("conv_id", "block", whole.asNondeterministic()("ms", "o").alias("w")).select("conv_id", "block", "w.*")
    lists = joint.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("block", "m", "o"))).alias("own"))
    ends = path.asNondeterministic()(F.col("own.m"), F.col("own")[0]["o"], F.lit(-1), F.lit(-1))
    fixed = lists.select("conv_id", F.col("own.block").alias("bs"), ends.alias("e")).select("conv_id", F.inline(F.arrays_zip("bs", "e")))
    fixed = fixed.select(F.col("conv_id").alias("c"), F.col("bs").alias("b"), "e")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b"))
    inner = path.asNondeterministic()("ms", "o", "e.before", "e.after")
    inside = blocks.join(fixed, same).select("conv_id", "block", inner.alias("p"))
    inside = inside.select(F.col("conv_id").alias("c"), F.col("block").alias("b"), F.posexplode("p").alias("at", "e"))

    @F.pandas_udf("array<struct<state:int, text:string>>")
    def segments(texts: pd.Series, before: pd.Series, after: pd.Series) -> pd.Series:
        out = []
        for text, b, a in zip(texts, before, after, strict=True):
            found: list[dict] = []
            for line, state in zip(text.split("\n"), model.states(text, int(b), int(a)), strict=True):
                # What looks like a marker inside a turn is part of it.
                body = _END.sub("", line) if state % 2 else marker_of(line)[1]
                if found and state % 2:
                    found[-1]["text"] += "\n" + body
                else:
                    found.append({"state": state, "text": body})
            out.append(found)
        return pd.Series(out, dtype=object)

    chosen = scored.select("conv_id", "block", "place", "text").join(inside, same & (F.col("place") == F.col("at") + 1))
    told = chosen.select("conv_id", "block", "place", segments.asNondeterministic()("text", "e.before", "e.after").alias("s"))
    told = work.keep(told.select("conv_id", "block", "place", F.posexplode("s").alias("part", "s")).select("conv_id", "block", "place", "part", "s.*"))
    # A line that goes on belongs to the turn before it, in an earlier chunk if need be. Turns are numbered by block, then within.
    begins = (F.col("state") % 2 == 0).cast("int")
    counts = told.groupBy("conv_id", "block").agg(F.sum(begins).alias("n"))
    earlier = F.coalesce(F.sum("n").over(Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    before = counts.select(F.col("conv_id").alias("c"), F.col("block").alias("b"), earlier.alias("earlier"))
    running = F.sum(begins).over(Window.partitionBy("conv_id", "block").orderBy("place", "part"))
    numbered = told.withColumn("k", running).join(before, same).withColumn("turn", F.greatest(F.col("earlier") + F.col("k") - 1, F.lit(0)))
    parts = F.array_sort(F.collect_list(F.struct("block", "place", "part", "state", "text")))
    turns = numbered.groupBy("conv_id", "turn").agg(parts.alias("p"))
    # What goes on in front of the first turn, as blank lines do, is part of it.
    state = F.coalesce(F.get(F.filter("p", lambda x: x["state"] % 2 == 0), F.lit(0))["state"], F.col("p")[0]["state"])
    role = F.array(*[F.lit(r) for r in ROLES])[F.floor(state / 2).cast("int")]
    text = F.regexp_replace(F.array_join(F.col("p.text"), "\n"), r"^\s+|\s+$", "")
    done = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    return done.withColumn("rendered", rendered(F.col("role"), F.col("text")))


# ------------------------------------------------------------ transcripts of conversations whose roles are known

_STYLES = [
    {"system": "System: ", "user": "User: ", "assistant": "Assistant: "},
    {"system": "### Instructions:\n", "user": "### Human:\n", "assistant": "### Assistant:\n"},
    {"system": "Instructions: ", "user": "Q: ", "assistant": "A: "},
    {"system": "", "user": "Me: ", "assistant": ""},
]


def as_transcript(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text -> conv_id, seq, text, true_role: raw chunks in one of four styles, some without their marker."""
    style = F.pmod(F.xxhash64("conv_id"), F.lit(len(_STYLES))).cast("int")
    names = F.array(*[F.create_map(*[F.lit(x) for pair in s.items() for x in pair]) for s in _STYLES])
    bare = (F.pmod(F.xxhash64("conv_id", "turn"), F.lit(9)) == 0) & (F.col("turn") > 0)
    mark = F.when(bare, "\n").otherwise(F.coalesce(names[style][F.col("role")], F.lit("")))
    tail = F.when(style == 3, "\n").otherwise("")
    return turns.select(
        "conv_id", F.col("turn").alias("seq"), F.concat(mark, F.coalesce("text", F.lit("")), tail).alias("text"), F.col("role").alias("true_role")
    )


def learn(turns: DataFrame, count: int = SAMPLE) -> Model:
    """The model from at most `count` whole conversations, the first by a hash of conv_id of those with at most SAMPLE_TURNS turns and SAMPLE_CHARS characters."""
    raw = as_transcript(turns)
    sizes = raw.groupBy("conv_id").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))
    chosen = sizes.where((F.col("n") <= SAMPLE_TURNS) & (F.col("chars") <= SAMPLE_CHARS)).select("conv_id").orderBy(F.xxhash64("conv_id"), "conv_id").limit(count)
    rows = raw.join(F.broadcast(chosen), "conv_id").select("conv_id", "seq", "true_role", "text").collect()  # both bounded by `count`
    found: dict = {}
    for row in sorted(rows, key=lambda r: (str(r["conv_id"]), r["seq"] is not None, r["seq"] or 0, r["text"])):
        found.setdefault(row["conv_id"], []).append((row["true_role"], row["text"]))
    return fit(list(found.values()))
