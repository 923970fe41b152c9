"""Operator 12: repair of the turn structure of conversations.

A repaired conversation reads ``(s?(ua)+)?`` in the initials of its roles. Its turns are aligned to the alternating
strings of every feasible length by Wagner and Fischer's table: ``below[i][r]`` is the least cost of turning rows i and on
into the last r places of such a string, which all lengths share, as each ends in ``ua``. Ukkonen's band leaves out cells
from which no string can cost as little as the incumbent, a repair made in one pass. Lengths that tie are walked in
lockstep: their audits are compared place by place, and those that fall behind leave.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from stakeflow.llm.common import table

#: Costs of the edits, and of leaving a truncated turn in.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: Characters that a blank text has at most, and that a text may end in after its stop.
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
NEVER = 1 << 40
#: Cells of the table that are held at once; beyond them every so many rows are kept, and those between made again.
HELD_CELLS = 8_000_000
#: Turns of conversations that are handed on at a time.
BATCH_TURNS = 2_000

TURN = pa.struct([("role", pa.string()), ("text", pa.string())])
SCHEMA = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in ("n_turns", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string()), ("repaired", pa.list_(TURN))])


class Alignment:
    """The table of one conversation: ``initials`` of its rows, which of them must go, and which are cut off."""

    def __init__(self, initials: list[str], gone: list[bool], cut: list[bool]):
        self.initials, self.gone, self.cut, self.n = initials, gone, cut, len(initials)
        self.left = np.concatenate((np.cumsum([not g for g in gone][::-1])[::-1], [0])).astype(np.int64)  # rows that may stay, from i on
        least = DELETE * sum(gone) + TRUNCATED * sum(c and not g for c, g in zip(cut, gone))
        self.band = (self._one_pass() - least) // min(INSERT, DELETE - TRUNCATED) + 2
        self.places = np.arange(-self.band, self.band + 1)
        self.systems = any(c == "s" and not g for c, g in zip(initials, gone))
        width = len(self.places) * (1 + self.systems)
        self.stride = self.n + 1 if (self.n + 1) * width <= HELD_CELLS else max(1, int((self.n + 1) ** 0.5))
        last = INSERT * self.places
        self.kept = {self.n: (np.where(self.places < 0, NEVER, last), np.full(len(last), NEVER))}
        for i in range(self.n - 1, -1, -1):
            row = self._above(i, row if i < self.n - 1 else self.kept[self.n])
            if i % self.stride == 0 or self.stride > self.n:
                self.kept[i] = row

    def _one_pass(self) -> int:
        """The cost of a repair that keeps every row that may stay, and puts in or renames where a role is out of turn."""
        cost, want, first = 0, "u", True
        for c, gone, cut in zip(self.initials, self.gone, self.cut):
            if gone:
                cost += DELETE
                continue
            cost += TRUNCATED * cut
            if first and c == "s":
                first = False
                continue
            if c in "ua" and c:
                if c != want:
                    cost += INSERT
                want = "a" if c == "u" else "u"
            else:
                cost += REROLE
                want = "a" if want == "u" else "u"
            first = False
        return cost + (INSERT if want == "a" else 0) + (2 * INSERT if "s" in self.initials else 0)

    def _above(self, i: int, row: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Row i of the table, for places u, a, u, a... and for those with a system turn first, from row i + 1."""
        below, system = row
        r = self.places + self.left[i]
        if self.gone[i]:
            best, first = DELETE + below, DELETE + system
        else:
            longer = np.append(below[1:], NEVER)
            kept = below + TRUNCATED * self.cut[i] + np.where(np.where(r % 2 == 0, "u", "a") == self.initials[i], 0, REROLE)
            best = np.minimum(DELETE + longer, np.where(r > 0, kept, NEVER))
            first = DELETE + np.append(system[1:], NEVER)
            if self.initials[i] == "s":
                first = np.minimum(first, longer + TRUNCATED * self.cut[i])
        best = np.where(r < 0, NEVER, best)
        steps = INSERT * self.places
        return np.minimum(np.minimum.accumulate(best - steps) + steps, NEVER), np.minimum(first, NEVER)

    def _rows(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The rows from the first on; those that aren't kept are made again, a stride at a time."""
        for at in range(0, self.n + 1, self.stride):
            end = min(at + self.stride, self.n)
            if self.stride > self.n:
                yield from (self.kept[i] for i in range(self.n + 1))
                return
            part = {end: self.kept[end]}
            for i in range(end - 1, at, -1):
                part[i] = self._above(i, part[i + 1])
            yield self.kept[at]
            yield from (part[i] for i in range(at + 1, end if end < self.n or end == at else end + 1))

    def audit(self) -> tuple[int, str]:
        """The least cost over all lengths, and the least audit of that cost."""
        rows = self._rows()
        now = next(rows)
        r = self.places + self.left[0]
        fits = (r >= 0) & (r % 2 == 0)
        plain, system = now[0][fits], now[1][fits & (r > 0)] if self.systems else np.zeros(0, np.int64)
        cost = int(min(plain.min(initial=NEVER), system.min(initial=NEVER)))
        open_, first = r[fits][plain == cost], r[fits & (r > 0)][system == cost] if self.systems else r[:0]
        out, i, rest, nxt = [], 0, cost, next(rows, None)

        def at(row: np.ndarray, i: int, r: np.ndarray) -> np.ndarray:
            j = r - self.left[i] + self.band
            inside = (j >= 0) & (j < len(row))
            return np.where(inside, row[np.clip(j, 0, len(row) - 1)], NEVER)

        while rest or i < self.n:
            moved = None
            if i < self.n:
                a, b = open_[at(nxt[0], i + 1, open_) + DELETE == rest], first[at(nxt[1], i + 1, first) + DELETE == rest]
                if len(a) or len(b):
                    moved = ("D", a, b, DELETE)
            if moved is None:
                a = open_[at(now[0], i, open_ - 1) + INSERT == rest] - 1
                if len(a):
                    moved = ("I", a, first[:0], INSERT)
            if moved is None:
                more = TRUNCATED * self.cut[i]
                fit = np.where(open_ % 2 == 0, "u", "a") == self.initials[i]
                to = at(nxt[0], i + 1, open_ - 1) + more
                a = open_[fit & (to == rest)] - 1
                if self.initials[i] == "s":
                    a = np.concatenate((a, first[at(nxt[0], i + 1, first) + more == rest]))
                moved = ("K", a, first[:0], more) if len(a) else ("R", open_[~fit & (to + REROLE == rest)] - 1, first[:0], more + REROLE)
            op, open_, first, paid = moved
            out.append(op)
            rest -= paid
            if op != "I":
                i, now, nxt = i + 1, nxt, next(rows, None)
        return cost, "".join(out)


def repaired(roles: list[str], texts: list[str], audit: str) -> list[dict]:
    """The turns that an audit leaves, renames and puts in."""
    out, i, want = [], 0, "user"
    for op in audit:
        role = want if op in "IR" else roles[i]
        if op != "D":
            out.append({"role": role, "text": "" if op == "I" else texts[i]})
            want = "assistant" if role[:1] == "u" else "user"
        i += op != "I"
    return out


def checked(conv_id: int | None, turns: list[tuple]) -> dict:
    """The row of a conversation from its rows (turn, role, text, blank, cut) in order."""
    seen, gone, cut, n = set(), [], [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text, blank, short in turns:
        fault = "blank" if blank else "duplicate" if (role, text) in seen else "truncated" if short else None
        seen.add((role, text))
        if fault:
            n[fault] += 1
        gone.append(fault in ("blank", "duplicate"))
        cut.append(fault == "truncated")
    initials = [t[1][:1] for t in turns]
    numbers = [t[0] for t in turns if t[0] is not None]
    cost, audit = Alignment(initials, gone, cut).audit()
    return {
        "conv_id": conv_id, "n_turns": len(turns), "gaps": max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0, **n,
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        "cost": cost, "audit": audit, "repaired": repaired([t[1] for t in turns], [t[2] for t in turns], audit),
    }


def repair(turns: DataFrame, only_named: Column | None = None) -> DataFrame:
    """One row per conversation of ``turns`` (conv_id, turn, role, text): its faults, and its cheapest repair.

    Columns of SCHEMA. Turns go by number, nulls first, then by role and text, so that repeated rows stand together. Null
    roles and texts count as one space. A role's first character is its initial; one that is no s, u or a can't be kept.
    A null conv_id is a conversation like any other. Rows for which ``only_named`` holds only name their conversation: one
    without any other row has zeros, an empty audit and no turns. An empty table gives no rows; other columns aren't read.

    A conversation's rows meet in one task, one conversation at a time, as its repair is one row; its table holds a band of
    places whose width is that of its faults."""
    named = F.lit(False) if only_named is None else only_named
    text = F.coalesce("text", F.lit(" "))
    rows = turns.select("conv_id", "turn", F.when(~named, F.coalesce("role", F.lit(" "))).alias("role"), F.when(~named, text).alias("text"), named.alias("named"))
    bare = F.rtrim(F.col("text"), F.lit(SPACES))
    rows = rows.withColumns({"blank": bare == "", "short": ~F.right(bare, F.lit(1)).isin(".", "!", "?")})
    sorted_ = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, turns_, out, n = NEVER, [], [], 0
        for batch in batches:
            cols = [batch.column(k).to_pylist() for k in range(7)]
            for conv, turn, role, said, only, blank, short in zip(*cols):
                if here is NEVER or conv != here:
                    if here is not NEVER:
                        out.append(checked(here, turns_))
                        n += len(turns_)
                    here, turns_ = conv, []
                    if n >= BATCH_TURNS:
                        yield pa.RecordBatch.from_pylist(out, schema=SCHEMA)
                        out, n = [], 0
                if not only:
                    turns_.append((turn, role, said, blank, short))
        if here is not NEVER:
            out.append(checked(here, turns_))
            yield pa.RecordBatch.from_pylist(out, schema=SCHEMA)

    return sorted_.mapInArrow(run, from_arrow_schema(SCHEMA))


def damaged(turns: DataFrame) -> DataFrame:
    """``turns`` with one in four rows damaged by the checksum of conversation and turn: dropped (``dropped`` is true, as the
    conversation has to stay known), emptied, without its stops, repeated, or said by the user. Nulls are one space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text"))
    role = F.when(kind == 4, "user").otherwise(space("role"))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), (kind == 0).alias("dropped"), F.when(kind == 3, 2).otherwise(1).alias("copies"))
    return rows.withColumn("copies", F.explode(F.sequence(F.lit(1), "copies"))).drop("copies")


def op12_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repair(damaged(table(spark, sf_dir, "conversations")), F.col("dropped"))
    said = F.array_join(F.transform("repaired", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    return found.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.sha2(said, 256).alias("repaired_sha256"))


#: The same by another way: the least (cost, audit) of each state of the grammar's automaton, row by row from the last.
OP12_SQL = r"""
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_concat([b], range(8)),
         lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t
), keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations
), summed AS (
  SELECT k, xor(list_reduce(list_concat([4294967295], list_transform(range(1, length(k) + 1), lambda p: CAST(ascii(substr(k, p, 1)) AS BIGINT))),
         lambda c, b: xor(c // 256, t[(xor(c, b) % 256) + 1])), 4294967295) % 20 AS kind
  FROM (SELECT DISTINCT k FROM keyed), crc_table
), rows AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM keyed JOIN summed USING (k), (SELECT unnest([1, 2]) AS copy) WHERE kind <> 0 AND (copy = 1 OR kind = 3)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
         trim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare, left(role, 1) AS c FROM rows
), counted AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS again FROM placed
), faults AS (
  SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN again > 1 THEN 'duplicate' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         lag(c) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM counted
), chats AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || c NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY conv_id
), walk(conv_id, i, e, a, p, s) AS (
  SELECT conv_id, n, '000000000', '000000002I', '000000004II', '000000000' FROM chats
  UNION ALL
  SELECT conv_id, i, least(e0, e1), least(a0, a1), least(p0, e1), least(s0, e1) FROM (
    SELECT conv_id, i, e0, a0, p0, s0, lpad(CAST(CAST(left(a0, 9) AS INT) + 2 AS VARCHAR), 9, '0') || 'I' || substr(a0, 10) AS e1,
           lpad(CAST(CAST(left(e0, 9) AS INT) + 2 AS VARCHAR), 9, '0') || 'I' || substr(e0, 10) AS a1 FROM (
      SELECT w.conv_id, w.i - 1 AS i,
        least(lpad(CAST(CAST(left(e, 9) AS INT) + 3 AS VARCHAR), 9, '0') || 'D' || substr(e, 10),
              CASE WHEN stays THEN lpad(CAST(CAST(left(a, 9) AS INT) + more + CASE WHEN c = 'u' THEN 0 ELSE 2 END AS VARCHAR), 9, '0') || CASE WHEN c = 'u' THEN 'K' ELSE 'R' END || substr(a, 10) ELSE '9' END) AS e0,
        least(lpad(CAST(CAST(left(a, 9) AS INT) + 3 AS VARCHAR), 9, '0') || 'D' || substr(a, 10),
              CASE WHEN stays THEN lpad(CAST(CAST(left(e, 9) AS INT) + more + CASE WHEN c = 'a' THEN 0 ELSE 2 END AS VARCHAR), 9, '0') || CASE WHEN c = 'a' THEN 'K' ELSE 'R' END || substr(e, 10) ELSE '9' END) AS a0,
        least(lpad(CAST(CAST(left(p, 9) AS INT) + 3 AS VARCHAR), 9, '0') || 'D' || substr(p, 10),
              CASE WHEN stays THEN lpad(CAST(CAST(left(a, 9) AS INT) + more + CASE WHEN c = 'u' THEN 0 ELSE 2 END AS VARCHAR), 9, '0') || CASE WHEN c = 'u' THEN 'K' ELSE 'R' END || substr(a, 10) ELSE '9' END) AS p0,
        least(lpad(CAST(CAST(left(s, 9) AS INT) + 3 AS VARCHAR), 9, '0') || 'D' || substr(s, 10),
              CASE WHEN stays THEN lpad(CAST(CAST(left(a, 9) AS INT) + more + CASE WHEN c = 'u' THEN 0 ELSE 2 END AS VARCHAR), 9, '0') || CASE WHEN c = 'u' THEN 'K' ELSE 'R' END || substr(a, 10) ELSE '9' END,
              CASE WHEN stays AND c = 's' THEN lpad(CAST(CAST(left(p, 9) AS INT) + more AS VARCHAR), 9, '0') || 'K' || substr(p, 10) ELSE '9' END) AS s0
      FROM walk w JOIN (SELECT conv_id, i, c, fault NOT IN ('blank', 'duplicate') AS stays, CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END AS more FROM faults) f
        ON w.conv_id IS NOT DISTINCT FROM f.conv_id AND w.i = f.i))
), best AS (SELECT conv_id, CAST(left(s, 9) AS BIGINT) AS cost, substr(s, 10) AS audit FROM walk WHERE i = 0
), ops AS (
  SELECT conv_id, pos, substr(audit, pos, 1) AS op, length(replace(left(audit, pos), 'I', '')) AS i, length(replace(left(audit, pos), 'D', '')) AS e
  FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS pos FROM best)
), told AS (
  SELECT o.conv_id, o.pos, o.op, o.e, f.role, f.text, first_value(o.op = 'K' AND f.c = 's') OVER (PARTITION BY o.conv_id ORDER BY o.pos) AS system_first
  FROM ops o LEFT JOIN faults f ON o.conv_id IS NOT DISTINCT FROM f.conv_id AND o.i = f.i AND o.op <> 'I' WHERE o.op <> 'D'
), said AS (
  SELECT conv_id, string_agg(CASE WHEN op = 'K' THEN role WHEN (e - CASE WHEN system_first THEN 1 ELSE 0 END) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' ||
         CASE WHEN op = 'I' THEN '' ELSE text END, chr(10) ORDER BY pos) AS said FROM told GROUP BY conv_id
)
SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(said, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) ids
LEFT JOIN chats ON ids.conv_id IS NOT DISTINCT FROM chats.conv_id LEFT JOIN best ON ids.conv_id IS NOT DISTINCT FROM best.conv_id
LEFT JOIN said ON ids.conv_id IS NOT DISTINCT FROM said.conv_id
"""
