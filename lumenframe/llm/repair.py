"""Structure repair of conversations: the cheapest edits that give a legal order of roles.

Legal are the role initials `(s?(ua)+)?`. Edits: Keep costs 0, Rerole to user or assistant 2, Delete 3,
Insert of an empty user or assistant turn 2; a truncated row that isn't deleted adds 1, and blank and
duplicate rows must be deleted. Of all cheapest lists of edits the one with the ASCII-least initials
is taken.

1. Rows are dealt by conversation once, and sorted inside their partitions from a conversation's end to
   its beginning. `_backward` streams through them and keeps four numbers: the cost to go from each
   state of the grammar. Every row gets the letter of its least cost-tight edit in each state.
2. The same partitions, sorted the other way without another shuffle, are walked forward: in its state
   a row's letter is the edit, and inserts go before it. `edits` returns a row an edit.
3. `report` streams through the edits, whose order is kept, and sums and hashes them.

No task holds a conversation: rows stream through sorts that spill, and only an audit (a letter a row)
grows with it. A conversation's digest is over all its text in order, so one task reads it. A
duplicate is found by its group's first turn (counts are combined before their shuffle, and groups of
one row aren't joined), and among rows that are equal in all by the row before.

Cases: null roles and texts count as one space, a null conv_id is one conversation, null turns come first; rows of one turn are ordered by role and
text; repeated rows are duplicates; texts of any length stay whole; extra columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_hot, materialize

WHITE = " \t\n\x0b\f\r"
#: What edits cost.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: States: nothing yet, after the system turn, after a user turn, after an assistant turn. What an inserted or reroled turn is in each, and the state after it.
GIVES, THEN = ("user", "user", "assistant", "user"), (2, 2, 3, 2)
#: The state after a kept turn with an initial.
KEEPS = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
#: Cost to go when no row is left: after a system turn two inserts, after a user turn one.
END = (0, 2 * INSERT, INSERT, 0)
LEGAL = {"su", "ua", "au"}
FIRST = -(1 << 63)


@lru_cache(maxsize=4096)
def step(after: tuple[int, ...], initial: str, fault: str | None) -> tuple[tuple[int, ...], str]:
    """Costs to go before a row, less their least, from those after it; and each state's letter of the ASCII-least tight edit."""
    late = TRUNCATED if fault == "truncated" else 0
    gone = fault in ("blank", "duplicate")
    options = []
    for q in range(4):
        own = {"D": DELETE + after[q]}
        if not gone:
            own["R"] = REROLE + late + after[THEN[q]]
            if (initial, q) in KEEPS:
                own["K"] = late + after[KEEPS[initial, q]]
        options.append(own)
    costs = [min(x.values()) for x in options]
    for _ in range(2):  # a third insert in a row would come back to a state that was left
        costs = [min(costs[q], INSERT + costs[THEN[q]]) for q in range(4)]
    letters = ""
    for q in range(4):
        options[q]["I"] = INSERT + costs[THEN[q]]
        letters += min(k for k, v in options[q].items() if v == costs[q])
    least = min(costs)
    return tuple(c - least for c in costs), letters


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, lost: rows damaged by the crc32 of `conv_id:turn`; a row that is dropped stays as a mark that its conversation was there."""
    rows = conversations.select("conv_id", "turn", *(F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")))
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    kind = F.crc32(key.cast("binary")) % 20
    rows = rows.withColumn("_kind", kind).withColumn("role", F.when(F.col("_kind") == 4, "user").otherwise(F.col("role")))
    text = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.array_repeat(F.col("_kind") == 0, F.when(F.col("_kind") == 3, 2).otherwise(1))
    return rows.withColumn("text", text).select("conv_id", "turn", "role", "text", F.explode(copies).alias("lost"))


def _digest(*columns: Column) -> Column:
    """128 bits of values that hold their lengths, so that no two lists of values run together."""
    return F.unhex(F.md5(F.concat(*(F.concat(F.coalesce(F.char_length(c), F.lit(-1)).cast("string"), F.lit(":"), F.coalesce(c, F.lit(""))) for c in columns)).cast("binary")))


def with_faults(rows: DataFrame) -> DataFrame:
    """Adds initial, blank, late (truncated, were it not blank or a duplicate), again (equal to a row of an earlier turn) and at (turn, nulls first)."""
    cut = F.rtrim(F.col("text"), F.lit(WHITE))
    rows = rows.withColumn("at", F.coalesce(F.col("turn").cast("long"), F.lit(FIRST))).withColumn("same", _digest(F.col("conv_id").cast("string"), F.col("role"), F.col("text")))
    groups = rows.filter(~F.col("lost")).groupBy("same").agg(F.count("*").alias("_n"), F.min("at").alias("_first")).filter("_n > 1").select("same", "_first")
    joined = join_hot(rows, materialize(groups, "repeated-turns"), ["same"])
    return joined.withColumn("initial", F.left("role", F.lit(1))).withColumn("blank", cut == "").withColumn("late", ~F.right(cut, F.lit(1)).isin(".", "!", "?")).withColumn("again", F.coalesce(F.col("at") > F.col("_first"), F.lit(False)))


ROW = "conv_id {id}, turn long, role string, text string, lost boolean, fault string, back long, letters string"
EDIT = "conv_id {id}, at long, edit string, turn long, role string, text string, was string, fault string"


def _backward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From a conversation's last row to its first: each row's fault, its place from the end, and its letters."""
    held, costs, back = None, END, 0  # the row that waits for the one before it
    out: list[list] = [[] for _ in range(8)]
    kinds: list[pa.DataType] = []

    def settle(before: tuple | None) -> None:
        nonlocal costs, back
        conv, turn, role, text, lost, initial, blank, late, again, same = held
        fault = letters = None
        if not lost:
            equal = before is not None and not before[4] and before[0] == conv and before[1] == turn and before[9] == same
            fault = "blank" if blank else "duplicate" if again or equal else "truncated" if late else None
            costs, letters = step(costs, initial, fault)
        for column, value in zip(out, (conv, turn, role, text, lost, fault, back, letters), strict=True):
            column.append(value)
        back += 1

    def flush() -> pa.RecordBatch:
        types = [kinds[0], pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.string(), pa.int64(), pa.string()]
        batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=["conv_id", "turn", "role", "text", "lost", "fault", "back", "letters"])
        for c in out:
            c.clear()
        return batch

    for batch in batches:
        kinds[:] = [batch.column("conv_id").type]
        for row in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "lost", "initial", "blank", "late", "again", "same")), strict=True):
            if held is not None:
                settle(row)
                if row[0] != held[0]:
                    costs, back = END, 0
            held = row
        if out[0]:
            yield flush()
    if held is not None:
        settle(None)
        yield flush()


def _forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From a conversation's first row to its last: its edits in order, each with the turn that it gives. was: the role of the row before the edit, null for inserts."""
    state, at, last, begun = 0, 0, None, False
    names = ["conv_id", "at", "edit", "turn", "role", "text", "was", "fault"]
    out: list[list] = [[] for _ in names]
    kind = pa.int64()

    def put(*values) -> None:
        nonlocal at
        for column, value in zip(out, (values[0], at, *values[1:]), strict=True):
            column.append(value)
        at += 1

    def insert(conv) -> None:
        nonlocal state
        put(conv, "I", None, GIVES[state], "", None, None)
        state = THEN[state]

    def finish(conv) -> None:
        while END[state]:
            insert(conv)
        if not at:  # all rows were dropped: a mark without an edit
            put(conv, None, None, None, None, None, None)

    def flush() -> pa.RecordBatch:
        types = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string()]
        batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=names)
        for c in out:
            c.clear()
        return batch

    for batch in batches:
        kind = batch.column("conv_id").type
        for conv, turn, role, text, lost, fault, letters in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "lost", "fault", "letters")), strict=True):
            if not begun or conv != last:
                if begun:
                    finish(last)
                state, at, last, begun = 0, 0, conv, True
            if lost:
                continue
            while letters[state] == "I":
                insert(conv)
            edit = letters[state]
            put(conv, edit, turn, GIVES[state] if edit == "R" else role, text, role, fault)
            if edit == "K":
                state = KEEPS[role[:1], state]
            elif edit == "R":
                state = THEN[state]
        if out[0]:
            yield flush()
    if begun:
        finish(last)
        yield flush()


def edits(rows: DataFrame) -> DataFrame:
    """conv_id, at, edit (K, R, D or I), turn, role, text, was, fault: every conversation's cheapest edits in order.

    rows: conv_id, turn, role, text and lost (marks of conversations without rows). A conversation
    whose rows are all marks has one row with a null edit. Rows of a conversation follow each other in
    one partition.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    faulty = with_faults(rows).select("conv_id", "turn", "at", "role", "text", "lost", "initial", "blank", "late", "again", "same")
    down = [F.col(c).desc() for c in ("at", "role", "text", "lost")]
    ended = faulty.repartition("conv_id").sortWithinPartitions("conv_id", *down)
    planned = ended.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text", "lost", "initial", "blank", "late", "again", "same").mapInArrow(_backward, ROW.format(id=kind))
    return planned.sortWithinPartitions("conv_id", F.col("back").desc()).mapInArrow(_forward, EDIT.format(id=kind))


def repaired(edited: DataFrame) -> DataFrame:
    """conv_id, at, role, text: the turns that edits leave, in order of at."""
    return edited.filter("edit <> 'D'").select("conv_id", "at", "role", "text")


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def report(edited: DataFrame) -> DataFrame:
    """A row a conversation: its faults, the edits' cost and letters, and the digest of its repaired turns. edited: what `edits` returned, in its partitions and order."""
    kind = edited.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: dict | None = None
        done: list[dict] = []
        id_type = pa.int64()

        def close() -> None:
            turns = now["turns"]
            done.append({"conv_id": now["conv_id"], **{c: now[c] for c in COUNTS}, "audit": "".join(now["audit"]), "repaired_sha256": now["sha"].hexdigest()})
            if turns:
                done[-1]["gaps"] = now["high"] - now["low"] + 1 - turns

        def flush() -> pa.RecordBatch:
            types = [("conv_id", id_type), *((c, pa.int64()) for c in COUNTS), ("audit", pa.string()), ("repaired_sha256", pa.string())]
            batch = pa.RecordBatch.from_pylist(done, pa.schema(types))
            done.clear()
            return batch

        for batch in batches:
            id_type = batch.column("conv_id").type
            for conv, edit, turn, role, text, was, fault in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "edit", "turn", "role", "text", "was", "fault")), strict=True):
                if now is None or now["conv_id"] != conv:
                    if now:
                        close()
                    now = {"conv_id": conv, **dict.fromkeys(COUNTS, 0), "audit": [], "sha": hashlib.sha256(), "empty": True, "before": None, "low": None, "high": None, "turns": 0}
                if edit is None:
                    continue
                now["audit"].append(edit)
                now["cost"] += {"K": 0, "R": REROLE, "D": DELETE, "I": INSERT}[edit] + (TRUNCATED if fault == "truncated" and edit != "D" else 0)
                if edit != "D":
                    now["sha"].update(("" if now["empty"] else "\n").encode() + f"{role}:{text}".encode())
                    now["empty"] = False
                if edit == "I":
                    continue
                if fault:
                    now[fault] += 1
                if now["before"] is not None and now["before"] + was[:1] not in LEGAL:
                    now["illegal"] += 1
                now["before"] = was[:1]
                if turn is not None and turn != now["high"]:
                    now["low"] = turn if now["low"] is None else now["low"]
                    now["high"] = turn
                    now["turns"] += 1
            if done:
                yield flush()
        if now:
            close()
            yield flush()

    schema = f"conv_id {kind}, {', '.join(f'{c} long' for c in COUNTS)}, audit string, repaired_sha256 string"
    return edited.mapInArrow(run, schema)


def cheapest(rows: list[tuple[str, str | None]]) -> tuple[int, str]:
    """Cost and letters of one small conversation, given as (role, fault): the two passes on a list."""
    costs, plan = END, []
    for role, fault in reversed(rows):
        costs, letters = step(costs, role[:1], fault)
        plan.append(letters)
    state, out, cost = 0, "", 0
    for (role, fault), letters in zip(rows, reversed(plan), strict=True):
        while letters[state] == "I":
            out, cost, state = out + "I", cost + INSERT, THEN[state]
        edit = letters[state]
        out, cost = out + edit, cost + {"K": 0, "R": REROLE, "D": DELETE}[edit] + (TRUNCATED if fault == "truncated" and edit != "D" else 0)
        state = KEEPS[role[:1], state] if edit == "K" else THEN[state] if edit == "R" else state
    while END[state]:
        out, cost, state = out + "I", cost + INSERT, THEN[state]
    return cost, out


#: DuckDB SQL: the table of crc32 by its rule, and the crc32 of a text's bytes.
CRC_TABLE = "SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS crcs"
CRC32 = "xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(1, 2 * octet_length(encode({0})), 2), lambda i: CAST('0x' || hex(encode({0}))[i:i+1] AS BIGINT))), lambda c, b: xor(crcs[1 + (xor(c, b) & 255)], c >> 8)))"

#: DuckDB SQL for op11, over the same rows.
SQL = rf"""
WITH RECURSIVE crc AS ({CRC_TABLE}), keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations
), kinds AS (SELECT conv_id, turn, role, text, {CRC32.format("k")} % 20 AS kind FROM keyed, crc),
rows_in AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM kinds
), placed AS (
  SELECT *, row_number() OVER w AS pos, count(*) OVER (PARTITION BY conv_id) AS n, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS cut, left(role, 1) AS ini, lag(left(role, 1)) OVER w AS ini_before
  FROM rows_in WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)
), faults AS (
  SELECT *, CASE WHEN cut = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN right(cut, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM placed
), f AS (SELECT *, CASE WHEN fault IN ('blank', 'duplicate') THEN 1000000000 ELSE 0 END AS no, CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END AS late FROM faults),
back AS (
  SELECT conv_id, n + 1 AS pos, [0, 4, 2, 0] AS c FROM f WHERE pos = n
  UNION ALL
  SELECT conv_id, pos, [least(b[1], 2 + b[3], 4 + b[4]), least(b[2], 2 + b[3], 4 + b[4]), least(b[3], 2 + b[4]), least(b[4], 2 + b[3])] FROM (
    SELECT f.conv_id, f.pos, [
      least(3 + c[1], no + late + least(2 + c[3], CASE ini WHEN 's' THEN c[2] WHEN 'u' THEN c[3] ELSE 1000000000 END)),
      least(3 + c[2], no + late + least(2 + c[3], CASE ini WHEN 'u' THEN c[3] ELSE 1000000000 END)),
      least(3 + c[3], no + late + least(2 + c[4], CASE ini WHEN 'a' THEN c[4] ELSE 1000000000 END)),
      least(3 + c[4], no + late + least(2 + c[3], CASE ini WHEN 'u' THEN c[3] ELSE 1000000000 END))] AS b
    FROM back JOIN f ON f.conv_id IS NOT DISTINCT FROM back.conv_id AND f.pos = back.pos - 1)
), go AS (
  SELECT f.conv_id, f.pos, f.n, f.role, f.text, ini, no, late, x.c AS here, y.c AS after FROM f JOIN back x ON x.conv_id IS NOT DISTINCT FROM f.conv_id AND x.pos = f.pos JOIN back y ON y.conv_id IS NOT DISTINCT FROM f.conv_id AND y.pos = f.pos + 1
  UNION ALL SELECT conv_id, n + 1, n, '', '', '', 1000000000, 0, [0, 4, 2, 0], [1000000000, 1000000000, 1000000000, 1000000000] FROM f WHERE pos = n
), walk AS (
  SELECT conv_id, CAST(1 AS BIGINT) AS pos, 1 AS q, '' AS audit, CAST([] AS VARCHAR[]) AS turns, false AS over FROM f WHERE pos = 1
  UNION ALL
  SELECT conv_id, CASE WHEN edit IN ('I', '') THEN pos ELSE pos + 1 END, CASE edit WHEN 'K' THEN kept WHEN 'D' THEN q WHEN '' THEN q ELSE nxt END, audit || edit,
         CASE edit WHEN 'K' THEN list_append(turns, role || ':' || text) WHEN 'R' THEN list_append(turns, gives || ':' || text) WHEN 'I' THEN list_append(turns, gives || ':') ELSE turns END, edit = ''
  FROM (SELECT w.conv_id, w.pos, q, nxt, kept, gives, audit, turns, role, text,
          CASE WHEN w.pos > n AND here[q] = 0 THEN '' WHEN here[q] = 3 + after[q] THEN 'D' WHEN here[q] = 2 + here[nxt] THEN 'I' WHEN no = 0 AND kept > 0 AND here[q] = late + after[kept] THEN 'K' ELSE 'R' END AS edit
        FROM (SELECT walk.*, [3, 3, 4, 3][q] AS nxt, CASE WHEN q = 3 THEN 'assistant' ELSE 'user' END AS gives, go.role, go.text, n, no, late, here, after,
                CASE WHEN ini = 's' AND q = 1 THEN 2 WHEN ini = 'u' AND q <> 3 THEN 3 WHEN ini = 'a' AND q = 3 THEN 4 ELSE 0 END AS kept
              FROM walk JOIN go ON go.conv_id IS NOT DISTINCT FROM walk.conv_id AND go.pos = walk.pos WHERE NOT over) w)
), counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (ini_before IS NOT NULL AND ini_before || ini NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY 1
), costs AS (SELECT conv_id, c[1] AS cost FROM back WHERE pos = 1)
SELECT i.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       CAST(coalesce(cost, 0) AS BIGINT) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(turns, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) i LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM i.conv_id LEFT JOIN costs k ON k.conv_id IS NOT DISTINCT FROM i.conv_id LEFT JOIN (SELECT * FROM walk WHERE over) w ON w.conv_id IS NOT DISTINCT FROM i.conv_id
"""
