"""Conversation structure repair by Viterbi decoding with survivor coalescence.

A conversation is whole if its role initials read ``(s?(ua)+)?``.  Edits of its
rows, in order of turn: Keep (0), Rerole to user or assistant (2), Delete (3; the
only edit of a blank or duplicate row) and Insert of an empty user or assistant
row anywhere (2).  A truncated row that is not deleted costs 1 more.  Of the
cheapest edit sequences the one whose initials are least in ASCII order is taken.

The decoder walks the rows with one survivor for each state: nothing said yet
(``0``), system (``s``), user (``u``) or assistant (``a``) spoken last.  In a
given state an edit leads to just one next state, so the initials name the path.

* Survivors are leaves of a tree of back pointers.  A node counts what refers to
  it; a path that loses is freed up to its last fork.
* Once all survivors descend from one child of the root, that edit is decided: it
  is emitted (with its row) and leaves the tree.  What is held is the undecided
  suffix, whatever the length of the conversation.
* Survivors of equal cost are compared over their whole undecided suffixes: skip
  pointers find the last common node in a logarithmic number of steps, and the
  edits after it decide.  None is a prefix of another of equal cost, for what it
  lacks would be inserts, and these cost.
* A survivor that a cheaper one could imitate at less than the difference of
  their costs can never win and is dropped, so the tree does not keep hopeless
  paths alive.

Rows reach the decoder in one shuffle by conversation and two sorts (by role and
text, for duplicates; by turn), both of which spill; a task streams its
conversations, so one with a third of all rows is never held.

Defined cases: a null role or text is one space (so a null text is blank); null
turns come first; ties of a turn go by role, then text; rows equal in conversation,
role and text are duplicates of the first; a null conv_id is a conversation of its
own; a role that starts with none of s, u, a (or is empty) cannot be kept; very
long texts travel whole; a conversation without rows has zeros, an empty audit
and the digest of the empty string; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from convometrics.llm.common import crc_sql, small_batches

KEEP, REROLE, DELETE, INSERT = "KRDI"
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
TRUNCATED_COST = 1
SPACES = " \t\n\v\f\r"
ENDS = (".", "!", "?")

# The state after a row whose role starts with this letter, by the state before; None: not allowed.
NEXT = {
    "0": {"s": "s", "u": "u"},
    "s": {"u": "u"},
    "u": {"a": "a"},
    "a": {"u": "u"},
}
ROLES = {"u": "user", "a": "assistant"}
WHOLE = ("0", "a")  # states in which a conversation may end

# What it costs at most to go on from the first state as from the second: inserting the missing
# turn, deleting a system row that the second could keep, or (from s) closing what cannot end there.
IMITATE = {
    "0": {"s": 0, "u": 2, "a": 0},
    "s": {"0": 4, "u": 2, "a": 4},
    "u": {"0": 5, "s": 2, "a": 2},
    "a": {"0": 3, "s": 0, "u": 2},
}


class Node:
    """An edit on a path: its letter, the row it leaves (None if deleted) and how many nodes and survivors refer to it."""

    __slots__ = ("parent", "jump", "depth", "edit", "row", "refs", "kids")

    def __init__(self, parent, jump, depth, edit, row):
        self.parent, self.jump, self.depth, self.edit, self.row = parent, jump, depth, edit, row
        self.refs, self.kids = 0, []


class PathTree:
    """Back pointers of the survivors, without what is decided."""

    def __init__(self):
        self.root = Node(None, None, 0, "", None)
        self.size = 1

    def extend(self, parent: Node, edit: str, row) -> Node:
        """A new path, referred to once (by its survivor)."""
        one = parent.jump
        two = one.jump if one is not None else None
        # two jumps of equal length make one of their sum and one: distances as in the skew binary numbers
        jump = two if two is not None and parent.depth - one.depth == one.depth - two.depth else parent
        node = Node(parent, jump, parent.depth + 1, edit, row)
        parent.refs += 1
        parent.kids.append(node)
        node.refs = 1
        self.size += 1
        return node

    def release(self, node: Node) -> None:
        """Drop a survivor's reference; what nothing refers to any more is freed."""
        node.refs -= 1
        while not node.refs and node is not self.root:
            above = node.parent
            above.kids.remove(node)
            above.refs -= 1
            node.parent = node.jump = None
            self.size -= 1
            node = above

    def _up(self, node: Node, depth: int) -> Node:
        floor = self.root.depth
        while node.depth > depth:
            jump = node.jump
            node = jump if jump is not None and jump.depth >= max(depth, floor) else node.parent
        return node

    def less(self, one: Node, two: Node) -> bool:
        """Whether the first path's letters come before the second's."""
        depth = min(one.depth, two.depth)
        a, b = self._up(one, depth), self._up(two, depth)
        if a is b:
            return one.depth < two.depth
        floor = self.root.depth
        while a.parent is not b.parent:
            # jumps made before and after the root moved may differ in length
            if a.jump is not b.jump and a.jump.depth == b.jump.depth >= floor:
                a, b = a.jump, b.jump
            else:
                a, b = a.parent, b.parent
        return a.edit < b.edit

    def decided(self):
        """Edits that all survivors share, in order; they leave the tree."""
        while self.root.refs == 1 and len(self.root.kids) == 1:
            node = self.root.kids[0]
            self.root.kids = []
            node.parent = node.jump = None
            self.root = node
            self.size -= 1
            yield node.edit, node.row


class Decoder:
    """Repairs one conversation: ``push`` its rows, then ``finish``; both yield (edit, row) once decided.

    A row is (role, text, turn); an inserted row has no turn, a deleted one is None.
    """

    def __init__(self):
        self.tree = PathTree()
        self.tree.root.refs += 1  # the survivor in state 0
        self.survivors = {"0": (0, self.tree.root)}
        self.cost = 0

    def _offer(self, best: dict, state: str, cost: int, parent: Node, edit: str, row) -> bool:
        held = best.get(state)
        if held is not None and held[0] < cost:
            return False
        node = self.tree.extend(parent, edit, row)
        if held is not None:
            if held[0] == cost and not self.tree.less(node, held[1]):
                self.tree.release(node)
                return False
            self.tree.release(held[1])
        best[state] = (cost, node)
        return True

    def _inserts(self) -> None:
        """Let survivors insert rows: each insert moves to the other speaker, three reach every state that inserts reach."""
        best = self.survivors
        fresh = list(best)
        while fresh:
            found = []
            for state in fresh:
                cost, node = best[state]
                for to, role in ROLES.items():
                    if to in NEXT[state] and self._offer(best, to, cost + COST[INSERT], node, INSERT, (role, "", None)):
                        found.append(to)
            fresh = found

    def push(self, role: str, text: str, turn, must_go: bool, truncated: bool):
        self._inserts()
        extra = TRUNCATED_COST if truncated else 0
        initial = role[:1]
        best: dict = {}
        for state, (cost, node) in self.survivors.items():
            self._offer(best, state, cost + COST[DELETE], node, DELETE, None)
            if must_go:
                continue
            follow = NEXT[state]
            if initial in follow:
                self._offer(best, follow[initial], cost + COST[KEEP] + extra, node, KEEP, (role, text, turn))
            for to, name in ROLES.items():
                if to in follow:
                    self._offer(best, to, cost + COST[REROLE] + extra, node, REROLE, (name, text, turn))
        for _, node in self.survivors.values():
            self.tree.release(node)
        for state in [x for x in best if any(best[x][0] > best[y][0] + IMITATE[y][x] for y in best if y != x)]:
            self.tree.release(best.pop(state)[1])
        self.survivors = best
        yield from self.tree.decided()

    def finish(self):
        self._inserts()
        ends = [self.survivors[s] for s in WHOLE if s in self.survivors]
        cost, node = ends[0]
        for other_cost, other in ends[1:]:
            if other_cost < cost or (other_cost == cost and self.tree.less(other, node)):
                cost, node = other_cost, other
        self.cost = cost
        for _, other in self.survivors.values():
            if other is not node:
                self.tree.release(other)
        self.survivors = {}
        path = []
        while node is not self.tree.root:
            path.append((node.edit, node.row))
            node = node.parent
        yield from reversed(path)


def fault_of(text: str, repeated: bool) -> str | None:
    """The first fault of a row: blank, duplicate, truncated or none."""
    said = text.strip(SPACES)
    if not said:
        return "blank"
    if repeated:
        return "duplicate"
    return None if said.endswith(ENDS) else "truncated"


def in_order(rows: DataFrame) -> DataFrame:
    """Rows of a conversation together, by turn, with ``repeated``: the role and text occurred earlier.  One shuffle.

    ``present`` is false for a row that only says that its conversation exists.
    """
    typed = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        (F.col("present") if "present" in rows.columns else F.lit(True)).alias("present"),
    )
    alike = Window.partitionBy("conv_id", "role", "text", "present").orderBy(F.col("turn").asc_nulls_first())
    together = typed.repartition("conv_id").withColumn("repeated", F.row_number().over(alike) > 1)
    return together.sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text", "repeated")


class Tally:
    """What an audit says of one conversation, kept up row by row."""

    def __init__(self, conv_id):
        self.conv_id, self.decoder = conv_id, Decoder()
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal = self.turns = 0
        self.low = self.high = self.initial = None
        self.audit, self.repaired, self.said = [], hashlib.sha256(), False

    def note(self, edits):
        for edit, row in edits:
            self.audit.append(edit)
            if row is not None:
                self.repaired.update(f"{chr(10) if self.said else ''}{row[0]}:{row[1]}".encode())
                self.said = True
            yield edit, row

    def push(self, role, text, turn, repeated):
        fault = fault_of(text, repeated)
        if fault:
            self.faults[fault] += 1
        if self.initial is not None and self.initial + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = role[:1]
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = turn
        yield from self.note(self.decoder.push(role, text, turn, fault in ("blank", "duplicate"), fault == "truncated"))

    def finish(self):
        yield from self.note(self.decoder.finish())

    def row(self):
        return {
            "conv_id": self.conv_id,
            "gaps": 0 if self.low is None else self.high - self.low + 1 - self.turns,
            **self.faults,
            "illegal": self.illegal,
            "cost": self.decoder.cost,
            "audit": "".join(self.audit),
            "repaired_sha256": self.repaired.hexdigest(),
        }


def _conversations(batches):
    """(tally, its newly decided edits, whether it ended) as the rows of a sorted partition stream by."""
    tally = None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "present", "repeated")]
        for conv_id, turn, role, text, present, repeated in zip(*columns):
            if tally is None or tally.conv_id != conv_id:
                if tally is not None:
                    yield tally, tally.finish(), True
                tally = Tally(conv_id)
            if present:
                yield tally, tally.push(role, text, turn, repeated), False
    if tally is not None:
        yield tally, tally.finish(), True


AUDIT_SCHEMA = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
TURNS_SCHEMA = "conv_id long, seq long, edit string, turn long, role string, text string"
FLUSH = 1 << 20  # characters


def audits(rows: DataFrame) -> DataFrame:
    """One row for each conversation: its gaps, faults, the cost and initials of its repair, and the digest of the result."""
    small_batches(rows.sparkSession)
    arrow = pa.schema([(n, pa.string() if t == "string" else pa.int64()) for n, t in (f.split() for f in AUDIT_SCHEMA.split(", "))])

    def run(batches):
        made, held = [], 0
        for tally, edits, ended in _conversations(batches):
            for _ in edits:
                pass
            if ended:
                made.append(tally.row())
                held += 200 + len(tally.audit)
                if held > FLUSH:
                    yield pa.RecordBatch.from_pylist(made, schema=arrow)
                    made, held = [], 0
        if made:
            yield pa.RecordBatch.from_pylist(made, schema=arrow)

    return in_order(rows).mapInArrow(run, AUDIT_SCHEMA)


def repaired_turns(rows: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, seq (from 0), edit (K, R or I), turn (null if inserted), role, text."""
    small_batches(rows.sparkSession)
    arrow = pa.schema([(n, pa.string() if t == "string" else pa.int64()) for n, t in (f.split() for f in TURNS_SCHEMA.split(", "))])

    def run(batches):
        made, held, seq = [], 0, 0
        for tally, edits, ended in _conversations(batches):
            for edit, row in edits:
                if row is None:
                    continue
                role, text, turn = row
                made.append({"conv_id": tally.conv_id, "seq": seq, "edit": edit, "turn": turn, "role": role, "text": text})
                seq += 1
                held += 100 + len(text)
                if held > FLUSH:
                    yield pa.RecordBatch.from_pylist(made, schema=arrow)
                    made, held = [], 0
            if ended:
                seq = 0
        if made:
            yield pa.RecordBatch.from_pylist(made, schema=arrow)

    return in_order(rows).mapInArrow(run, TURNS_SCHEMA)


def damaged(rows: DataFrame) -> DataFrame:
    """Rows damaged by crc32(``conv_id:turn``) % 20: dropped, emptied, without ``.!?``, repeated or made the user's.

    A dropped row stays with ``present`` false, so that its conversation is not forgotten.
    """
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.pmod(F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")), F.lit(20))
    text = F.coalesce("text", F.lit(" "))
    made = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), text.alias("text"), fate.alias("fate"))
    copies = F.array_repeat(F.col("fate") != 0, F.when(F.col("fate") == 3, 2).otherwise(1))
    return made.select(
        "conv_id",
        "turn",
        F.when(F.col("fate") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("fate") == 1, F.lit("")).when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(copies).alias("present"),
    )


def _oracle() -> str:
    """The same repair with whole strings: a recursive step for each row, the least (cost, edits) of each state."""
    part = lambda c: f"coalesce(CAST({c} AS VARCHAR), ' ')"
    key = f"{part('conv_id')} || ':' || {part('turn')}"

    def go(path: str, cost: str, edit: str, said: str | None) -> str:
        text = f"{path}.t" if said is None else f"CASE WHEN {path}.t IS NULL THEN {said} ELSE {path}.t || chr(10) || {said} END"
        return f"CASE WHEN {path} IS NOT NULL THEN {{'c': {path}.c + {cost}, 'a': {path}.a || '{edit}', 't': {text}}} END"

    def least(*paths: str) -> str:
        return f"list_min([{', '.join(paths)}])"

    add = lambda path, role: go(path, "2", "I", f"'{role}:'")
    closed = f"""
  w1 AS (SELECT * REPLACE ({least("u", add("z", "user"), add("s", "user"), add("a", "user"))} AS u) FROM %s),
  w2 AS (SELECT * REPLACE ({least("a", add("u", "assistant"))} AS a) FROM w1),
  w3 AS (SELECT * REPLACE ({least("u", add("a", "user"))} AS u) FROM w2)"""
    may = lambda initial, path: f"CASE WHEN NOT gone AND substr(role, 1, 1) = '{initial}' THEN {go(path, 'extra', 'K', 'role || chr(58) || txt')} END"
    rerole = lambda role, path: f"CASE WHEN NOT gone THEN {go(path, '2 + extra', 'R', chr(39) + role + ':' + chr(39) + ' || txt')} END"
    drop = lambda path: go(path, "3", "D", None)
    user = [f(x, p) for p in "zsa" for f, x in ((may, "u"), (rerole, "user"))]
    return f"""
WITH RECURSIVE c AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS txt,
         {crc_sql(f"list_transform(regexp_extract_all(hex({key}), '..'), lambda x: ('0x' || x)::UBIGINT)")} % 20 AS fate
  FROM conversations
),
r AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
         CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(txt, '[.!?]', '', 'g') ELSE txt END AS txt,
         unnest(range(CASE WHEN fate = 3 THEN 2 ELSE 1 END)) AS copy
  FROM c WHERE fate <> 0
),
f AS (
  SELECT *, row_number() OVER o AS i, regexp_extract(txt, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) AS said,
         row_number() OVER (PARTITION BY conv_id, role, txt ORDER BY turn NULLS FIRST, copy) > 1 AS again,
         lag(substr(role, 1, 1)) OVER o || substr(role, 1, 1) AS pair
  FROM r WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, txt, copy)
),
k AS (
  SELECT *, said = '' OR again AS gone, CASE WHEN said IN ('', '.', '!', '?') OR again THEN 0 ELSE 1 END AS extra FROM f
),
told AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (said = '') AS blank, count(*) FILTER (said <> '' AND again) AS duplicate, sum(extra) AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM k GROUP BY conv_id
),
v AS (
  SELECT conv_id, 0::BIGINT AS i, {{'c': 0::BIGINT, 'a': '', 't': NULL::VARCHAR}} AS z, NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR) AS s,
         NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR) AS u, NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR) AS a
  FROM told
  UNION ALL
  SELECT * FROM (WITH {closed % "v"}
  SELECT w3.conv_id, k.i, {drop("z")} AS z, {least(drop("s"), may("s", "z"))} AS s, {least(drop("u"), *user)} AS u,
         {least(drop("a"), may("a", "u"), rerole("assistant", "u"))} AS a
  FROM w3 JOIN k ON k.conv_id IS NOT DISTINCT FROM w3.conv_id AND k.i = w3.i + 1)
),
done AS (SELECT v.* FROM v JOIN told ON told.conv_id IS NOT DISTINCT FROM v.conv_id AND told.n = v.i),
{closed.strip() % "done"},
best AS (SELECT conv_id, {least("z", "a")} AS b FROM w3)
SELECT ids.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(b.c, 0)::BIGINT AS cost,
       coalesce(b.a, '') AS audit, sha256(coalesce(b.t, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) ids
LEFT JOIN told ON told.conv_id IS NOT DISTINCT FROM ids.conv_id
LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM ids.conv_id
"""


ORACLE = _oracle()
