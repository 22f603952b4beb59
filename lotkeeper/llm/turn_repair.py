"""Repair of conversations at the least cost, by depth-first branch and bound.

A conversation is read as a string of letters, one for each row: the role's initial and the row's fault. The search
goes through its rows in order; a node is (rows read, what the last kept role was), and its edges are the edits. An
explicit stack takes edges in the order of their initials, so the first of several cheapest repairs is the one that sorts
first. A prefix goes no further when another one reached its node at no more cost, or when its cost and the lower
bound of the rows left can't beat the incumbent; when the stack is empty, the incumbent is proved optimal. The bounds
are tight, so the search visits about as many nodes as a conversation has rows, however long it is.

Rows stream through the tasks in order and are never gathered: faults are found by windows, the letters of a
conversation make its plan, and a second stream of the rows behind their plan makes the digest of the repaired text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import repeat

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotkeeper.llm.sharding import CRC_TABLE_SQL, crc32_sql
from lotkeeper.llm.words import BLANKS
from lotkeeper.session import written

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: What was kept last: nothing, a system row, a user row, an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
_INITIALS, _FAULTS = "sua", ("", "truncated", "blank", "duplicate")
#: The state after a user or assistant row that may come next, by the state before it.
_NEXT = (USER, USER, ASSISTANT, USER)
_FAR = 1 << 60


def letter(initial: int, fault: int) -> str:
    return chr(65 + 4 * initial + fault)


def _read(letters: str) -> tuple[list[int], list[int]]:
    codes = [ord(x) - 65 for x in letters]
    return [c >> 2 for c in codes], [c & 3 for c in codes]


def _edges(initial: int, fault: int, state: int) -> list[tuple[str, int, int, int]]:
    """Edits at a node: (initial, rows read, cost, next state), in the order of initials."""
    edges = [("D", 1, DELETE, state), ("I", 0, INSERT, _NEXT[state])]
    if fault < 2:
        extra = TRUNCATED if fault else 0
        if (initial == 0 and state == START) or (initial in (1, 2) and initial + 1 == _NEXT[state]):
            edges.append(("K", 1, KEEP + extra, initial + 1))
        edges.append(("R", 1, REROLE + extra, _NEXT[state]))
    return edges


def bounds(initials: list[int], faults: list[int]) -> list[list[int]]:
    """What the rows from each place on cost at least, by the state before them. Costs alone, worked out from the end; which
    of several cheapest edits sorts first is left to the search."""
    n = len(initials)
    out = [[0, _FAR, _FAR, 0]] * (n + 1)
    for i in range(n, -1, -1):
        if i < n:
            out[i] = [min(price + out[i + 1][after] for _, step, price, after in _edges(initials[i], faults[i], state) if step)
                      for state in range(4)]
        once = [min(out[i][s], INSERT + out[i][_NEXT[s]]) for s in range(4)]
        out[i] = [min(once[s], INSERT + once[_NEXT[s]]) for s in range(4)]
    return out


def repair(letters: str) -> tuple[int, str]:
    """The least cost and the first audit in ASCII order that has it."""
    initials, faults = _read(letters)
    n = len(letters)
    low = bounds(initials, faults)
    edges = lambda i, state: _edges(initials[i], faults[i], state) if i < n else [("I", 0, INSERT, _NEXT[state])]
    # a first repair, always taking the edge that looks cheapest; only its cost is used
    i, state, cost = 0, START, 0
    while i < n or state in (SYSTEM, USER):
        _, step, price, state = min(edges(i, state), key=lambda e: (e[2] + low[i + e[1]][e[3]], -e[1]))
        i, cost = i + step, cost + price
    limit, found = cost + 1, -1
    seen = [[_FAR] * 4 for _ in range(n + 1)]  # least cost at which each node was reached
    trail: list[tuple[int, str]] = []  # every edit taken, with the one before it
    stack = [(0, START, 0, -1)]
    while stack:
        i, state, cost, at = stack.pop()
        if cost >= seen[i][state] or cost + low[i][state] >= limit:
            continue
        seen[i][state] = cost
        if i == n and state in (START, ASSISTANT):
            limit, found = cost, at
            continue
        for initial, step, price, after in reversed(edges(i, state)):
            if cost + price < seen[i + step][after] and cost + price + low[i + step][after] < limit:
                trail.append((at, initial))
                stack.append((i + step, after, cost + price, len(trail) - 1))
    audit = []
    while found >= 0:
        found, initial = trail[found]
        audit.append(initial)
    return limit, "".join(reversed(audit))


def _rows(conversations: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Rows after damage, equal ones of a turn as one with their number, in order of ``pos``; a conversation that lost all
    its rows keeps one of number 0."""
    key = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col(turn_col).cast("string"), F.lit(" ")))
    damage = F.crc32(key.cast("binary")) % 20
    dropped = damage == 0
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(" "))
    text = F.when(dropped | (damage == 1), F.lit("")).when(damage == 2, F.translate(text, ".!?", "")).otherwise(text)
    role = F.when(dropped, "").when(damage == 4, "user").otherwise(F.coalesce(F.col(role_col).cast("string"), F.lit(" ")))
    rows = conversations.select(
        F.col(id_col).alias("conv"), F.when(~dropped, F.col(turn_col)).alias("turn"), role.alias("role"), text.alias("text"),
        dropped.alias("dropped"), F.when(dropped, 0).when(damage == 3, 2).otherwise(1).alias("copies"))
    rows = rows.groupBy("conv", "dropped", "turn", "role", "text").agg(F.sum("copies").alias("copies")).repartition("conv")
    same = Window.partitionBy("conv", "dropped", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    order = Window.partitionBy("conv").orderBy("dropped", F.col("turn").asc_nulls_first(), "role", "text")
    solid = F.expr(f"trim(TRAILING '{BLANKS}' FROM text)")
    fault = (F.when(solid == "", 2).when(F.col("again") > 1, 3).when(~F.right(solid, F.lit(1)).isin(".", "!", "?"), 1).otherwise(0))
    first = F.substring("role", 1, 1)
    initial = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    return (rows.withColumn("again", F.row_number().over(same)).withColumn("pos", F.row_number().over(order))
            .select("conv", "pos", "turn", "role", "text", "copies", fault.alias("fault"), initial.alias("initial")))


_PLAN = "conv {0}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _plan(turns: list, letters: str) -> tuple:
    initials, faults = _read(letters)
    illegal = sum(pair not in ((0, 1), (1, 2), (2, 1)) for pair in zip(initials, initials[1:]))
    gaps = turns[1] - turns[0] + 1 - turns[2] if turns else 0
    return (gaps, *(faults.count(f) for f in (2, 3, 1)), illegal, *repair(letters))


def _plans(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows in order of conversation and place to one plan each."""
    out: list[tuple] = []
    current, open_, turns, letters = None, False, [], []

    def close() -> None:
        if open_:
            out.append((current, *_plan(turns, "".join(letters))))

    def flush() -> pa.RecordBatch:
        columns = list(zip(*out)) or [[] for _ in schema]
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, schema)], schema=schema)

    for batch in batches:
        for conv, turn, copies, fault, initial in zip(*[batch.column(c).to_pylist() for c in ("conv", "turn", "copies", "fault", "initial")]):
            if not open_ or conv != current:
                close()
                current, open_, turns, letters = conv, True, [], []
            if not copies:
                continue
            if turn is not None:  # turns come in order: first, last, how many
                turns = [turns[0], turn, turns[2] + (turn != turns[1])] if turns else [turn, turn, 1]
            letters.append(letter(initial, fault) + letter(initial, 2 if fault == 2 else 3) * (copies - 1))
        if len(out) >= 10_000:
            yield flush()
    close()
    yield flush()


class Repaired:
    """Rows of one conversation in, edits of its plan applied: digest and, if wanted, the rows."""

    def __init__(self, audit: str, keep: bool = False):
        self.audit, self.at, self.state = audit, 0, START
        self.digest, self.rows, self.keep, self.begun = hashlib.sha256(), [], keep, False

    def _put(self, role: str, text: str) -> None:
        self.digest.update((("\n" if self.begun else "") + role + ":" + text).encode())
        self.begun = True
        if self.keep:
            self.rows.append((role, text))

    def _role(self) -> str:
        self.state = _NEXT[self.state]
        return "user" if self.state == USER else "assistant"

    def inserts(self) -> None:
        while self.audit[self.at:self.at + 1] == "I":
            self._put(self._role(), "")
            self.at += 1

    def row(self, initial: int, role: str, text: str) -> None:
        self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = initial + 1
            self._put(role, text)
        elif edit == "R":
            self._put(self._role(), text)


def _digests(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Plans, each before the rows of its conversation, to plans with the digest of the repaired text."""
    out: list[tuple] = []
    work: Repaired | None = None
    names = [f.name for f in schema][:-1]

    def close() -> None:
        if work is not None:
            work.inserts()
            out[-1] = (*out[-1], work.digest.hexdigest())

    def flush(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [[] for _ in schema]
        return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, schema)], schema=schema)

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("pos", "initial", "role", "text", "copies", *names)]
        for pos, initial, role, text, copies, *plan in zip(*columns):
            if pos == 0:
                close()
                out.append(tuple(plan))
                work = Repaired(plan[-1])
            else:
                for _ in repeat(None, copies):
                    work.row(initial, role, text)
        if len(out) >= 10_000:
            yield flush(out[:-1])
            del out[:-1]
    close()
    yield flush(out)


def repaired(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text") -> DataFrame:
    """Faults, cheapest repair and its digest for every conversation, after the contract's damage.

    Null roles and texts are one space, and so are null ids and turns in the damage key; a null id is a conversation
    of its own, null turns come first. Rows of one turn stand in the order of role and text, equal ones side by side, the
    second one a duplicate. A role that starts with none of s, u and a can't be kept. A conversation without rows
    after damage has zeros, an empty audit and the digest of the empty string; an empty table gives no rows. One
    conversation's letters (a byte a row) are held by one task, its texts are not.
    """
    kind = conversations.schema[id_col].dataType.simpleString()
    rows = written(_rows(conversations, id_col, turn_col, role_col, text_col), "turns")
    order = ["conv", "pos"]
    plan_schema = _PLAN.format(kind)
    arrow = [("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()),
             ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string())]

    def plans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = iter(batches)
        head = next(batches, None)
        if head is not None:
            schema = pa.schema([("conv", head.schema.field("conv").type), *arrow])
            yield from _plans(_chain(head, batches), schema)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = iter(batches)
        head = next(batches, None)
        if head is not None:
            schema = pa.schema([("conv", head.schema.field("conv").type), *arrow, ("repaired_sha256", pa.string())])
            yield from _digests(_chain(head, batches), schema)

    narrow = rows.select("conv", "pos", "turn", "copies", "fault", "initial").repartition("conv").sortWithinPartitions(*order)
    made = written(narrow.mapInArrow(plans, plan_schema), "plans")
    both = made.withColumn("pos", F.lit(0)).unionByName(
        rows.where("copies > 0").select("conv", "pos", "initial", "role", "text", "copies"), allowMissingColumns=True)
    out = both.repartition("conv").sortWithinPartitions(*order).mapInArrow(digests, plan_schema + ", repaired_sha256 string")
    return out.withColumnRenamed("conv", id_col)


def _chain(head: pa.RecordBatch, rest: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield head
    yield from rest


def repaired_sql(source: str = "conversations") -> str:
    """The same by the cheapest prefix for every row and state."""
    key = "coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')"
    solid = r"regexp_replace(text, '[\x20\x09-\x0D]+$', '')"
    best = "row_number() OVER (PARTITION BY conv_id, state ORDER BY cost, audit)"
    inserts = """(VALUES (0, 0, 0, '', 0, ''), (0, 1, 2, 'I', 2, 'user:'), (0, 2, 3, 'II', 4, 'user:
assistant:'), (1, 0, 1, '', 0, ''), (1, 1, 2, 'I', 2, 'user:'), (1, 2, 3, 'II', 4, 'user:
assistant:'), (2, 0, 2, '', 0, ''), (2, 1, 3, 'I', 2, 'assistant:'), (3, 0, 3, '', 0, ''), (3, 1, 2, 'I', 2, 'user:'))
  AS i(before, k, after, letters, price, put)"""
    add = lambda a, b: f"CASE WHEN {b} = '' THEN {a} WHEN {a} = '' THEN {b} ELSE {a} || chr(10) || {b} END"
    return rf"""
WITH RECURSIVE crc AS (SELECT {CRC_TABLE_SQL} AS crc_table),
hit AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc32_sql(key)} % 20 AS d FROM {source}, crc),
damaged AS (SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
  CASE d WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN d = 3 THEN 2 ELSE 1 END)) FROM hit WHERE d <> 0),
ordered AS (SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS j FROM damaged),
r AS (SELECT *, CASE WHEN {solid} = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY j) > 1 THEN 'd'
  WHEN right({solid}, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
  CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'x' END AS c FROM ordered),
f AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
  count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated, count(*) AS n,
  count(*) FILTER (before IS NOT NULL AND before || c NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT *, lag(c) OVER (PARTITION BY conv_id ORDER BY j) AS before FROM r) GROUP BY 1),
dp AS (SELECT conv_id, 0::BIGINT AS j, 0 AS state, 0::BIGINT AS cost, '' AS audit, '' AS put FROM f UNION ALL
  SELECT conv_id, j, state, cost, audit, put FROM (
    SELECT o.conv_id, o.j, state, cost, audit, put FROM (
      SELECT dp.conv_id, r.j, CASE e WHEN 'D' THEN after WHEN 'K' THEN CASE c WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END ELSE CASE WHEN after = 2 THEN 3 ELSE 2 END END AS state,
        cost + price + CASE e WHEN 'D' THEN 3 WHEN 'K' THEN 0 ELSE 2 END + CASE WHEN e <> 'D' AND fault = 't' THEN 1 ELSE 0 END AS cost,
        audit || letters || e AS audit,
        {add(add('dp.put', 'i.put'), "CASE e WHEN 'D' THEN '' WHEN 'K' THEN r.role || ':' || r.text ELSE CASE WHEN after = 2 THEN 'assistant:' ELSE 'user:' END || r.text END")} AS put
      FROM dp JOIN r ON dp.conv_id IS NOT DISTINCT FROM r.conv_id AND r.j = dp.j + 1 JOIN {inserts} ON before = state, (VALUES ('D'), ('K'), ('R')) AS x(e)
      WHERE e = 'D' OR (fault NOT IN ('b', 'd') AND (e = 'R' OR (c = 's' AND after = 0) OR (c = 'u' AND after IN (0, 1, 3)) OR (c = 'a' AND after = 2)))) o
    QUALIFY {best} = 1)),
ends AS (SELECT dp.conv_id, cost + price AS cost, audit || letters AS audit, {add('dp.put', 'i.put')} AS put
  FROM dp JOIN f ON dp.conv_id IS NOT DISTINCT FROM f.conv_id AND dp.j = f.n JOIN {inserts} ON before = state AND after IN (0, 3)
  QUALIFY row_number() OVER (PARTITION BY dp.conv_id ORDER BY cost + price, audit || letters) = 1)
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(put, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM {source}) a LEFT JOIN f ON a.conv_id IS NOT DISTINCT FROM f.conv_id
LEFT JOIN ends e ON a.conv_id IS NOT DISTINCT FROM e.conv_id"""
