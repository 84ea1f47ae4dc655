"""Conversation structure repair: the cheapest edits that give a conversation legal roles, by a parallel Viterbi.

Legal are the role initials (s?(ua)+)?; every row is kept, given another role or deleted, and empty turns are inserted. Costs to
go are a vector over the grammar's four states, and a row turns the vector behind it into the one before it. Vectors that
differ by a constant choose the same edits, so that a vector stands for its whole class, and only a few dozen classes
can ever occur: a row is one look-up, and "differs only by a constant" is "has the same number".

A conversation is cut into chunks of bounded size, however long it is. Every chunk starts from all the vectors that
may stand at its end (`ends`), the speculative ones, and most chunks come out with one vector whatever they started from: their ranks have
converged, and the chunk before them can start. Fix-up passes serve the rest: each joins a chunk with the one it waits for,
twice as far ahead as the last time, until all know the vector at their end, so that a chain of k waiting chunks takes log2 k
passes. The chunks then trace the least audit forward from the stitched costs; the state at a chunk's start is found likewise.

The digest and the audit of a conversation are single values over all its rows; they are made by one pass over its chunks in order, which
holds a chunk and the audit so far, but no conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache, partial

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapedeck.llm.common import Workspace

#: Rows and characters at which a chunk is closed.
CHUNK_ROWS = 1024
CHUNK_CHARS = 1 << 20

REROLE, DELETE, INSERT, CUT_OFF = 1, 2, 5, 5
_NEVER = 1 << 40
#: States: nothing yet, after the system turn, after a user turn, after an assistant turn. A user turn leads to 2, an assistant turn to 3.
_NEXT, _ENDS = [2, 2, 3, 2], (0, 3)
_ROLES = {2: "user", 3: "assistant"}
#: Codes of rows: 0 must go; 1 + 2 * (place in "sua", 3 for any other initial) + (1 if cut off).
_INITIALS = "sua"
_SPACE = r"[\x20\x09-\x0D]"


def _row_choices(code: int, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, state after) of the edits that use a row up, by letter."""
    choices = [("D", DELETE, state)]
    if code:
        role, cut = divmod(code - 1, 2)
        kept = 1 if role == 0 and state == 0 else _NEXT[state] if role in (1, 2) and _NEXT[state] == role + 1 else None
        if kept is not None:
            choices.append(("K", CUT_OFF * cut, kept))
        choices.append(("R", REROLE + CUT_OFF * cut, _NEXT[state]))
    return choices


def _with_inserts(costs: list[int]) -> tuple[int, ...]:
    for _ in range(3):
        costs = [min(c, INSERT + costs[_NEXT[s]]) for s, c in enumerate(costs)]
    return tuple(costs)


def _before(vector: tuple[int, ...], code: int) -> tuple[int, ...]:
    return _with_inserts([min(cost + vector[to] for _, cost, to in _row_choices(code, s)) for s in range(4)])


@cache
def vectors() -> tuple[list[tuple[int, ...]], list[list[int]]]:
    """All classes of vectors, the one behind the last row first, and for each code the class before it by the class behind it."""
    known = [_with_inserts([0 if s in _ENDS else _NEVER for s in range(4)])]
    number, steps = {known[0]: 0}, [[] for _ in range(9)]
    for vector in known:
        for code in range(9):
            new = _before(vector, code)
            new = tuple(c - min(new) for c in new)
            if new not in number:
                number[new] = len(known)
                known.append(new)
            steps[code].append(number[new])
    return known, steps


@cache
def _edits(code: int, state: int, behind: int) -> tuple[str, int, int]:
    """The least letters up to and with the edit that uses this row up, their cost, and the state after it."""
    vector, letters, cost = vectors()[0][behind], "", 0
    here = _before(vector, code)
    while True:
        left = here[state]
        options = [(letter, c, to) for letter, c, to in _row_choices(code, state) if c + vector[to] == left]
        if INSERT + here[_NEXT[state]] == left:
            options.append(("I", INSERT, _NEXT[state]))
        letter, c, state = min(options)
        letters, cost = letters + letter, cost + c
        if letter != "I":
            return letters, cost, state


def lefts(codes: list[int]) -> list[int]:
    """The class before the first row by the class behind the last one."""
    steps = vectors()[1]
    now = list(range(len(steps[0])))
    place = now[:]
    for code in reversed(codes):
        step = steps[code]
        new = [step[q] for q in now]
        if len(set(new)) < len(now):
            now = sorted(set(new))
            at = {q: k for k, q in enumerate(now)}
            place = [at[new[k]] for k in place]
        else:
            now = new
    return [now[k] for k in place]


def _behind(codes: list[int], end: int) -> list[int]:
    """The class behind each row."""
    steps, out, q = vectors()[1], [], end
    for code in reversed(codes):
        out.append(q)
        q = steps[code][q]
    return out[::-1]


def moves(codes: list[int], end: int) -> list[int]:
    """The state after the last row by the state before the first one."""
    behind, now = _behind(codes, end), [0, 1, 2, 3]
    for code, q in zip(codes, behind, strict=True):
        now = [_edits(code, s, q)[2] for s in now]
    return now


def trace(codes: list[int], copies: list[int], roles: list[str], texts: list[str], end: int, state: int, last: bool) -> tuple[str, int, list[str], list[str]]:
    """Audit, its cost, and roles and texts of the repaired rows; `last` is true for a conversation's last chunk."""
    audit, cost, out = [], 0, []
    for code, n, role, text, q in zip(codes, copies, roles, texts, _behind(codes, end), strict=True):
        letters, c, after = _edits(code, state, q)
        for _ in letters[:-1]:
            state = _NEXT[state]
            out.append((_ROLES[state], ""))
        if letters[-1] != "D":
            out.append((role if letters[-1] == "K" else _ROLES[after], text))
        # All copies but the first, if that isn't one itself, must go.
        audit.append(letters + "D" * (n - 1))
        cost, state = cost + c + DELETE * (n - 1), after
    while last and state not in _ENDS:
        state = _NEXT[state]
        out.append((_ROLES[state], ""))
        audit.append("I")
        cost += INSERT
    return "".join(audit), cost, [r for r, _ in out], [t for _, t in out]


def key_of(conv_id: Column) -> Column:
    return F.when(conv_id.isNull(), "").otherwise(F.concat(F.lit("c"), conv_id.cast("string")))


def as_rows(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text (, copies) -> key, turn, role, text, copies, without nulls in role and text."""
    copies = F.col("copies") if "copies" in turns.columns else F.lit(1)
    return turns.select(
        key_of(F.col("conv_id")).alias("key"), "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
        copies.cast("long").alias("copies"),
    )


def faulted(rows: DataFrame) -> DataFrame:
    """Rows put together with their exact copies, and the code of each. `fault`: 1 blank, 2 seen earlier, 3 cut off, else 0.

    Texts are shuffled once, with their digest and turn in the key, so that a text that comes all the time is spread by its turns.
    """
    digest = F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    at = F.coalesce(F.col("turn").cast("string"), F.lit(""))
    marked = rows.withColumn("digest", digest).withColumn("at", at)
    runs = marked.groupBy("key", "at", "role", "digest").agg(F.max("turn").alias("turn"), F.max("text").alias("text"), F.sum("copies").alias("copies"))
    least = F.when(F.max(F.col("turn").isNull()), "").otherwise(F.min("turn").cast("string"))
    first = marked.groupBy("key", "role", "digest").agg(least.alias("at")).withColumn("first", F.lit(True))
    initial = F.substring("role", 1, 1)
    role = F.coalesce(F.nullif(F.instr(F.lit(_INITIALS), initial) * F.length(initial), F.lit(0)) - 1, F.lit(3))
    fault = (
        F.when(~F.col("text").rlike(_SPACE.replace("[", "[^")), 1).when(F.col("first").isNull(), 2)
        .when(~F.col("text").rlike(rf"[.!?]{_SPACE}*\z"), 3).otherwise(0)
    )
    joined = runs.join(first, ["key", "at", "role", "digest"], "left").withColumn("fault", fault)
    code = F.when(F.col("fault").isin(1, 2), 0).otherwise(1 + 2 * role + (F.col("fault") == 3).cast("int"))
    return joined.select("key", "turn", "role", "text", "copies", "fault", code.cast("int").alias("code"))


_CHUNK = (
    "key string, part int, chunk long, codes array<int>, copies array<long>, roles array<string>, texts array<string>, lefts array<int>,"
    " blank long, duplicate long, truncated long, illegal long, head string, tail string"
)


def _cut(batches: Iterator[pd.DataFrame], most: int) -> Iterator[pd.DataFrame]:
    """Sorted rows to chunks, each of one conversation and of at most that many rows."""
    part, made, key, held, chars = TaskContext.get().partitionId(), 0, None, [], 0
    names = [field.split()[0] for field in _CHUNK.split(", ")]

    def close() -> tuple:
        role, text, copies, fault, code = (list(c) for c in zip(*held, strict=True))
        initials = [r[:1] for r in role]
        blank = sum(n for n, f in zip(copies, fault, strict=True) if f == 1)
        again = sum(n if f == 2 else n - 1 for n, f in zip(copies, fault, strict=True) if f != 1)
        illegal = sum(copies) - len(copies) + sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        return key, part, (part << 32) + made, code, copies, role, text, lefts(code), blank, again, fault.count(3), illegal, initials[0], initials[-1]

    for batch in batches:
        done = []
        for k, *row in zip(batch["key"], batch["role"], batch["text"], batch["copies"], batch["fault"], batch["code"], strict=True):
            if held and (k != key or len(held) >= most or chars >= CHUNK_CHARS):
                done.append(close())
                held, chars, made = [], 0, made + 1
            key = k
            held.append(row)
            chars += len(row[1])
        if done:
            yield pd.DataFrame(done, columns=names)
    if held:
        yield pd.DataFrame([close()], columns=names)


def chunked(rows: DataFrame, most: int = CHUNK_ROWS) -> DataFrame:
    """Rows in the order of key, turn (nulls first), role and text, cut into chunks whose numbers follow that order.

    Partitions are ranges of that order, so that a long conversation spreads over many.
    """
    order = [F.col("key"), F.col("turn").asc_nulls_first(), F.col("role")]
    spread = rows.repartitionByRange(*order, F.substring("text", 1, 200)).sortWithinPartitions(*order, "text")
    return spread.mapInPandas(partial(_cut, most=most), _CHUNK)


def linked(chunks: DataFrame) -> DataFrame:
    """key, chunk, ahead, back: the numbers of a conversation's next and last chunk. A window holds one partition's chunks, or one row a partition."""
    inside, across = Window.partitionBy("key", "part").orderBy("chunk"), Window.partitionBy("key").orderBy("part")
    near = chunks.select("key", "part", "chunk", F.lead("chunk").over(inside).alias("ahead"), F.lag("chunk").over(inside).alias("back"))
    parts = chunks.groupBy("key", "part").agg(F.min("chunk").alias("low"), F.max("chunk").alias("high"))
    far = parts.select("key", "part", F.lead("low").over(across).alias("low"), F.lag("high").over(across).alias("high"))
    return near.join(far, ["key", "part"]).select("key", "chunk", F.coalesce("ahead", "low").alias("ahead"), F.coalesce("back", "high").alias("back"))


def chained(nodes: DataFrame, towards: str, work: Workspace) -> DataFrame:
    """key, chunk, table, `towards` -> key, chunk, value: what enters each chunk from the one that `towards` names.

    A chunk turns the value that enters it into its table's entry; 0 enters where there is none to wait for. A chunk waits
    until what lies between it and a known value is the same for all values; each pass looks twice as far.
    """

    def settled(known: Column, table: Column) -> Column:
        return F.coalesce(known, F.when(F.size(F.array_distinct(table)) == 1, table[0]))

    source = nodes.select("key", F.col("chunk").alias("wait"), F.col("table").alias("through"))
    first = nodes.select("key", "chunk", F.col(towards).alias("wait")).join(source, ["key", "wait"], "left")
    start = F.when(F.col("wait").isNull(), 0)
    now = work.keep(first.select("key", "chunk", "wait", "through", settled(start, F.col("through")).cast("int").alias("value")))
    while not (waiting := now.where("value is null")).isEmpty():
        other = now.select("key", F.col("chunk").alias("wait"), F.col("wait").alias("wait2"), F.col("through").alias("through2"), F.col("value").alias("value2"))
        both = waiting.drop("value").join(other, ["key", "wait"])
        value = F.get("through", F.col("value2"))
        through = F.transform("through2", lambda x: F.get("through", x))
        moved = both.select("key", "chunk", F.col("wait2").alias("wait"), through.alias("through"), settled(value, through).cast("int").alias("value"))
        now = work.keep(now.where("value is not null").union(moved))
    return now.select("key", "chunk", "value")


def traced(turns: DataFrame, work: Workspace, most: int = CHUNK_ROWS) -> DataFrame:
    """conv_id, turn, role, text (, copies) -> one row for each chunk of a conversation, in the order of `chunk`.

    Columns: key (see `key_of`), chunk, audit, cost, roles and texts of the repaired rows, counts of faults, and the initials at both ends.
    Null role and text are one space. Rows of equal turn are ordered by role, then text; exact repeats are copies.
    Other columns are ignored; an empty table gives no rows.
    """
    chunks = work.keep(chunked(faulted(as_rows(turns)), most))
    links = work.keep(linked(chunks.select("key", "part", "chunk")))
    ends = chained(links.join(chunks.select("key", "chunk", F.col("lefts").alias("table")), ["key", "chunk"]), "ahead", work).withColumnRenamed("value", "end")

    @F.pandas_udf("array<int>")
    def moved(codes: pd.Series, end: pd.Series) -> pd.Series:
        return pd.Series([moves(list(c), e) for c, e in zip(codes, end, strict=True)], dtype=object)

    known = links.join(ends, ["key", "chunk"])
    table = known.join(chunks.select("key", "chunk", "codes"), ["key", "chunk"]).select("key", "chunk", "back", moved("codes", "end").alias("table"))
    states = chained(work.keep(table), "back", work).withColumnRenamed("value", "state")
    plan = known.select("key", "chunk", "end", F.col("ahead").isNull().alias("last")).join(states, ["key", "chunk"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [
                trace(list(c), list(n), list(r), list(t), *rest)
                for c, n, r, t, *rest in zip(b["codes"], b["copies"], b["roles"], b["texts"], b["end"], b["state"], b["last"], strict=True)
            ]
            made = pd.DataFrame(found, columns=["audit", "cost", "roles", "texts"], index=b.index)
            yield pd.concat([b[["key", "chunk", "blank", "duplicate", "truncated", "illegal", "head", "tail"]], made], axis=1)

    schema = (
        "key string, chunk long, blank long, duplicate long, truncated long, illegal long, head string, tail string,"
        " audit string, cost long, roles array<string>, texts array<string>"
    )
    return chunks.drop("lefts", "part").join(plan, ["key", "chunk"]).mapInPandas(run, schema)


def repaired_rows(pieces: DataFrame) -> DataFrame:
    """What `traced` gives -> key, chunk, place, role, text: the repaired conversations, in the order of chunk and place."""
    row = F.posexplode(F.arrays_zip("roles", "texts")).alias("place", "row")
    return pieces.select("key", "chunk", row).select("key", "chunk", "place", F.col("row.roles").alias("role"), F.col("row.texts").alias("text"))


_REPORT = "key string, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _reported(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted chunks to one row a conversation."""
    key, sums, audit, digest, begun, tail = None, [0] * 5, [], hashlib.sha256(), False, ""
    names = [field.split()[0] for field in _REPORT.split(", ")]
    for batch in batches:
        done = []
        for row in batch.itertuples(index=False):
            if row.key != key:
                if key is not None:
                    done.append((key, *sums, "".join(audit), digest.hexdigest()))
                key, sums, audit, digest, begun = row.key, [0] * 5, [], hashlib.sha256(), False
            elif tail + row.head not in ("su", "ua", "au"):
                sums[3] += 1
            tail = row.tail
            sums = [a + b for a, b in zip(sums, (row.blank, row.duplicate, row.truncated, row.illegal, row.cost), strict=True)]
            audit.append(row.audit)
            if len(row.roles):
                lines = "\n".join(f"{r}:{t}" for r, t in zip(row.roles, row.texts, strict=True))
                digest.update((("\n" if begun else "") + lines).encode("utf-8", "surrogatepass"))
                begun = True
        if done:
            yield pd.DataFrame(done, columns=names)
    if key is not None:
        yield pd.DataFrame([(key, *sums, "".join(audit), digest.hexdigest())], columns=names)


def repair_report(turns: DataFrame, work: Workspace, most: int = CHUNK_ROWS) -> DataFrame:
    """One row for each conversation that has rows: key, counts of faults, cost, audit and digest of the repaired rows."""
    return traced(turns, work, most).repartition("key").sortWithinPartitions("key", "chunk").mapInPandas(_reported, _REPORT)


def damaged(turns: DataFrame) -> DataFrame:
    """conversations with faults put in by a hash of conv_id and turn: copies 0 (dropped) to 2; nulls but turn and conv_id are one space."""
    spaced = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(spaced[0], F.lit(":"), spaced[1]).cast("binary")) % 20
    text = F.coalesce("text", F.lit(" "))
    return turns.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def repair_damaged(turns: DataFrame, work: Workspace, most: int = CHUNK_ROWS) -> DataFrame:
    """conversations -> conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation after `damaged`.

    A null conv_id is a conversation of its own. Conversations that lose all rows have zeros and the digest of nothing.
    """
    rows = damaged(turns)
    turn = F.when(F.col("copies") > 0, F.col("turn"))
    gaps = F.coalesce(F.max(turn) - F.min(turn) + 1 - F.count_distinct(turn), F.lit(0)).cast("long")
    every = rows.groupBy("conv_id").agg(gaps.alias("gaps")).withColumn("key", key_of(F.col("conv_id")))
    found = every.join(repair_report(rows.where("copies > 0"), work, most), "key", "left")
    numbers = [F.coalesce(c, F.lit(0)).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = F.lit(hashlib.sha256().hexdigest())
    return found.select("conv_id", "gaps", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"))


# ------------------------------------------------------------ the same in DuckDB, row by row from the end


def _cell(cost: str, audit: str, rows: str) -> str:
    return f"{{'c': {cost}, 'a': {audit}, 'r': {rows}}}"


def _sql_choices(state: int) -> str:
    """The cheapest way to use a row up in this state, of equal ones the least audit: structs compare by cost, then audit."""
    to, far = _NEXT[state], "(1::bigint << 40)"
    own, behind = f"w[{state + 1}]", f"w[{to + 1}]"
    kept, name = "(role || ':' || body)", _ROLES[to]
    cells = [
        _cell(f"2 + {own}.c", f"'D' || {own}.a", f"{own}.r"),
        _cell(f"case when fault < 2 and role[1:1] = '{name[0]}' then 5 * fault + {behind}.c else {far} end", f"'K' || {behind}.a", f"list_prepend({kept}, {behind}.r)"),
        _cell(f"case when fault < 2 then 1 + 5 * fault + {behind}.c else {far} end", f"'R' || {behind}.a", f"list_prepend('{name}:' || body, {behind}.r)"),
    ]
    if state == 0:
        cells.append(_cell(f"case when fault < 2 and role[1:1] = 's' then 5 * fault + w[2].c else {far} end", "'K' || w[2].a", f"list_prepend({kept}, w[2].r)"))
    return f"list_min([{', '.join(cells)}])"


def _sql_inserts(source: str) -> str:
    def one(state: int) -> str:
        to = f"{source}[{_NEXT[state] + 1}]"
        inserted = _cell(f"5 + {to}.c", f"'I' || {to}.a", f"list_prepend('{_ROLES[_NEXT[state]]}:', {to}.r)")
        return f"list_min([{source}[{state + 1}], {inserted}])"

    return f"[{', '.join(one(s) for s in range(4))}]"


#: Faults: 3 blank, 2 seen earlier, 1 cut off.
SQL = f"""
with recursive bytes as (
  select list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)), lambda c, k: case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end)) as crc),
keyed as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as body,
    coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as k from conversations),
kinds as (
  select conv_id, turn, role, body, xor(4294967295, list_reduce(list_concat([4294967295], list_transform(range(1, strlen(k) + 1), lambda i: ascii(k[i]))),
    lambda c, b: xor(crc[(xor(c, b) & 255) + 1], c >> 8))) % 20 as kind
  from keyed, bytes),
damaged as (
  select conv_id, turn, case when kind = 4 then 'user' else role end as role,
    case kind when 1 then '' when 2 then regexp_replace(body, '[.!?]', '', 'g') else body end as body,
    unnest(case kind when 0 then [] when 3 then [1, 2] else [1] end) as copy
  from kinds),
placed as (
  select *, row_number() over w as i, lag(role) over w as before from damaged
  window w as (partition by conv_id order by turn nulls first, role, body, copy)),
ranked as (
  select *, row_number() over (partition by conv_id, role, body order by i) as nth,
    rtrim(body, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as bare from placed),
rows_ as (
  select *, case when bare = '' then 3 when nth > 1 then 2 when not regexp_matches(bare, '[.!?]$') then 1 else 0 end as fault from ranked),
counts as (
  select conv_id, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = 3) as blank,
    count(*) filter (fault = 2) as duplicate, count(*) filter (fault = 1) as truncated,
    count(*) filter (before is not null and before[1:1] || role[1:1] not in ('su', 'ua', 'au')) as illegal
  from rows_ group by conv_id),
path as (
  select conv_id, n as i, [{{'c': 0::bigint, 'a': '', 'r': []::varchar[]}}, {{'c': 10, 'a': 'II', 'r': ['user:', 'assistant:']}},
    {{'c': 5, 'a': 'I', 'r': ['assistant:']}}, {{'c': 0, 'a': '', 'r': []}}] as w from counts
  union all
  select conv_id, i - 1, {_sql_inserts(_sql_inserts('u'))} from (
    select p.conv_id, p.i, [{", ".join(_sql_choices(s) for s in range(4))}] as u
    from path p join rows_ r on r.conv_id is not distinct from p.conv_id and r.i = p.i))
select c.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate,
  coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal, coalesce(w[1].c, 0)::bigint as cost, coalesce(w[1].a, '') as audit,
  sha256(coalesce(array_to_string(w[1].r, chr(10)), '')) as repaired_sha256
from (select distinct conv_id from conversations) c
left join counts n on c.conv_id is not distinct from n.conv_id
left join path p on p.conv_id is not distinct from c.conv_id and p.i = 0
"""
