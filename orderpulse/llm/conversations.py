"""Repair of conversations by a Viterbi search that gives out edits as soon as they are certain.

A repaired conversation has the role initials (s?(ua)+)?. Rows are kept, given another role or
deleted, and empty messages are inserted, at the least total cost; of several cheapest ways the
one whose edits, written as initials, come first in ASCII order.

Rows stream through a task in the order of their conversation. For each of the four states
(nothing yet, after the system message, after a user, after an assistant) one survivor is kept:
the cheapest way there, ties decided on the whole of the edits that are not yet certain. The
survivors are leaves of one tree of backpointers, whose nodes hold the edits of a stretch
without branches and count who refers to them. A node nobody refers to is freed; a node with
one reference grows together with the next. Where the survivors share an ancestor, its edits
are certain, go out with their rows, and are forgotten. So a task holds only the rows since the
point where the survivors parted, whatever the length of the conversation.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from orderpulse.llm.common import chained, slices

#: White space that does not count as text, and the ends of a whole message.
BLANKS, ENDS = " \t\n\x0b\x0c\r", (".", "!", "?")
FAULTS = ("", "blank", "duplicate", "truncated")
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
RE_ROLE, DELETE, INSERT, CUT = 3, 4, 3, 3

START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after a message of a role in each state; None if it may not stand there.
NEXT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
#: The role that stands next in each state, other than a first system message.
WANTED = ("user", "user", "assistant", "user")
D, I, K, R = b"DIKR"


class Node:
    """Edits of a stretch of ways that all go on from here; ``refs`` counts who refers to it."""

    __slots__ = ("parent", "edits", "refs")

    def __init__(self, parent: Node | None, edits: bytes = b""):
        self.parent, self.edits, self.refs = parent, bytearray(edits), 0
        if parent is not None:
            parent.refs += 1

    def release(self) -> None:
        """One reference less; frees what nobody refers to."""
        node = self
        node.refs -= 1
        while node.refs == 0 and node.parent is not None:
            node = node.parent
            node.refs -= 1

    def path(self) -> list[Node]:
        """Nodes from the root to this one."""
        out, node = [], self
        while node is not None:
            out.append(node)
            node = node.parent
        return out[::-1]


def earlier(a: Node, x: int | None, b: Node, y: int | None) -> bool:
    """True if the edits up to ``a`` and then ``x`` come before those up to ``b`` and then ``y``.

    Ways part at a node, and its children begin with different edits, so the first edit after
    the last shared node decides."""
    one, two = a.path(), b.path()
    n = 0
    while n < len(one) and n < len(two) and one[n] is two[n]:
        n += 1
    first = one[n].edits[0] if n < len(one) else x
    second = two[n].edits[0] if n < len(two) else y
    return (-1 if first is None else first) < (-1 if second is None else second)


class Survivors:
    """The cheapest way to each state, after the rows so far."""

    def __init__(self):
        root = Node(None)
        root.refs = 1
        self.leaves: list[tuple[int, Node] | None] = [(0, root), None, None, None]
        self._insert()

    def _insert(self) -> None:
        """Inserted messages after the rows so far. A way with one more pair of them than
        another is dearer, so one pass over the states is enough."""
        for state, to in ((START, USER), (SYSTEM, USER), (ASSISTANT, USER), (USER, ASSISTANT)):
            if self.leaves[state] is None:
                continue
            cost, node = self.leaves[state]
            old = self.leaves[to]
            if old is None or cost + INSERT < old[0] or (
                    cost + INSERT == old[0] and earlier(node, I, old[1], None)):
                made = Node(node, bytes([I]))
                made.refs = 1
                self.leaves[to] = cost + INSERT, made
                if old is not None:
                    old[1].release()

    def step(self, initial: str, fault: int) -> None:
        """Take one row: its role's initial (none: no state takes it) and its first fault."""
        best: list[tuple[int, Node, int] | None] = [None] * 4

        def offer(to: int, cost: int, node: Node, edit: int) -> None:
            own = best[to]
            if own is None or cost < own[0] or cost == own[0] and earlier(
                    node, edit, own[1], own[2]):
                best[to] = cost, node, edit

        cut = CUT if fault == TRUNCATED else 0
        for state, leaf in enumerate(self.leaves):
            if leaf is None:
                continue
            cost, node = leaf
            offer(state, cost + DELETE, node, D)
            if fault in (BLANK, DUPLICATE):
                continue
            to = NEXT[state].get(initial)
            if to is not None:
                offer(to, cost + cut, node, K)
            offer(NEXT[state][WANTED[state][0]], cost + cut + RE_ROLE, node, R)
        before = self.leaves
        self.leaves = [None] * 4
        for to, own in enumerate(best):
            if own is not None:
                made = Node(own[1], bytes([own[2]]))
                made.refs = 1
                self.leaves[to] = own[0], made
        for leaf in before:
            if leaf is not None:
                leaf[1].release()
        self._insert()
        self._drop_hopeless()

    def _drop_hopeless(self) -> None:
        """Ways that can't come out cheapest. After an assistant message all may follow that may
        follow a system message; what may follow nothing may too, but for one system message,
        and deleting that costs DELETE."""
        done = self.leaves[ASSISTANT]
        for state, more in ((SYSTEM, 0), (START, DELETE)):
            leaf = self.leaves[state]
            if done is not None and leaf is not None and done[0] + more < leaf[0]:
                self.leaves[state] = None
                leaf[1].release()

    def certain(self) -> bytes:
        """Edits that all survivors share and that were not given out yet."""
        root = None
        for leaf in self.leaves:
            node = leaf[1] if leaf is not None else None
            while node is not None and node.parent is not None:
                above = node.parent
                if above.refs > 1:
                    node = above
                    continue
                above.edits += node.edits
                node.edits, node.parent, above.parent = above.edits, above.parent, None
            root = node or root
        out = bytes(root.edits)
        root.edits.clear()
        return out

    def end(self) -> tuple[int, bytes]:
        """Cost of the cheapest repaired conversation, and the edits not given out yet."""
        left = [self.leaves[state] for state in (START, ASSISTANT)]
        left = [leaf for leaf in left if leaf is not None]
        best = left[0]
        for other in left[1:]:
            if other[0] < best[0] or other[0] == best[0] and earlier(
                    other[1], None, best[1], None):
                best = other
        for leaf in self.leaves:
            if leaf is not None and leaf is not best:
                leaf[1].release()
        self.leaves = [best, None, None, None]
        return best[0], self.certain()


def edits_of(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(edit, turn, old role, role, text, fault, cost) of each edit of one conversation.

    ``rows`` are (turn, role, text, fault) in order. An edit comes as soon as it is certain;
    only the rows whose edit is not are held."""
    found, held, state = Survivors(), deque(), START

    def given(edits: bytes) -> Iterator[tuple]:
        nonlocal state
        for edit in edits:
            if edit == I:
                role = WANTED[state]
                state = NEXT[state][role[0]]
                yield "insert", None, None, role, "", "", INSERT
                continue
            turn, old, text, fault = held.popleft()
            if edit == D:
                yield "delete", turn, old, None, text, FAULTS[fault], DELETE
                continue
            role = WANTED[state] if edit == R else old
            state = NEXT[state][role[0]]
            yield ("rerole" if edit == R else "keep", turn, old, role, text, FAULTS[fault],
                   (RE_ROLE if edit == R else 0) + (CUT if fault == TRUNCATED else 0))

    for row in rows:
        held.append(row)
        found.step(row[1][:1], row[3])
        yield from given(found.certain())
    yield from given(found.end()[1])


def fault_of(text: Column, seen: Column) -> Column:
    """Number of the first fault of a row; 0 if it has none."""
    body = F.rtrim(text, F.lit(BLANKS))
    return (F.when(body == "", BLANK).when(seen, DUPLICATE)
            .when(~F.right(body, F.lit(1)).isin(*ENDS), TRUNCATED).otherwise(0))


def in_order(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, fault): the rows of a conversation one after another in one
    partition, by turn, role and text, a null turn first. Null role and text are one space."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    own = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), blank("role"),
                      blank("text")).repartition("conv_id")
    what = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    # The rows of a conversation are together already, so this window moves nothing.
    first = Window.partitionBy("conv_id", "what").orderBy(F.asc_nulls_first("turn"))
    seen = own.withColumn("what", what).withColumn("nth", F.row_number().over(first))
    return (seen.select("conv_id", "turn", "role", "text",
                        fault_of(F.col("text"), F.col("nth") > 1).alias("fault"), "nth")
            .sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text", "nth")
            .drop("nth"))


EDITS = ("edit string, turn long, old_role string, role string, text string, fault string, "
         "cost long")
NAMES = ("edit", "turn", "old_role", "role", "text", "fault", "cost")
KINDS = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64())


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for part in slices(batches):
        yield from zip(*(c.to_pylist() for c in part.columns))


def _conversations(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(first column, the rest of the rows that share it, one after another)."""
    row = next(rows, None)
    while row is not None:
        own, more = row[0], [row]

        def rest():
            nonlocal row
            yield more.pop()[1:]
            for row in rows:
                if row[0] != own:
                    return
                yield row[1:]
            row = None

        yield own, rest()


def _edit_batches(kind: pa.DataType):
    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), (kind, pa.int64(), *KINDS))],
            ["conv_id", "step", *NAMES])

    def run(batches):
        out, size = [], 0
        for conv, rows in _conversations(_rows(batches)):
            for n, edit in enumerate(edits_of(rows)):
                out.append((conv, n, *edit))
                size += len(edit[4])
                if len(out) == 4096 or size > 1 << 20:
                    yield batch(out)
                    out, size = [], 0
        if out:
            yield batch(out)
    return run


def _kind(rows: DataFrame) -> tuple[str, pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_type

    kind = rows.schema["conv_id"].dataType
    return kind.simpleString(), to_arrow_type(kind)


def repair(rows: DataFrame) -> DataFrame:
    """(conv_id, step, edit, turn, old_role, role, text, fault, cost): the edits that make each
    conversation legal at the least cost, in order of ``step``.

    ``rows`` are (conv_id, turn, role, text). An edit keeps a row (0), gives it another role (3),
    deletes it (4, always for blank and repeated rows) or inserts an empty message (3); a cut-off
    row that is not deleted costs 3 more. ``role`` is null for deleted rows, ``turn`` and
    ``old_role`` for inserted ones. Faults are blank, duplicate (role and text stood before) and
    truncated, of which the first counts; the empty text is none.

    Null roles and texts count as one space, a null conv_id is a conversation of its own, null
    turns come first, and rows of one turn go by role and text. A message without a role can't be
    kept. Repeated rows are duplicates. No row gives no edit; other columns are not looked at.
    """
    name, kind = _kind(rows)
    return in_order(rows).mapInArrow(_edit_batches(kind), f"conv_id {name}, step long, {EDITS}")


def repaired(edits: DataFrame) -> DataFrame:
    """(conv_id, step, role, text): the messages of the repaired conversations."""
    return edits.filter("role is not null").select("conv_id", "step", "role", "text")


SUMMARY = ("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
           "audit string, repaired_sha256 string")
FOLLOWS = ("su", "ua", "au")


def summary_of(edits: Iterator[tuple]) -> tuple:
    """The columns of SUMMARY from the edits of one conversation, in order."""
    faults = dict.fromkeys(FAULTS, 0)
    first = last = before = None
    turns = illegal = cost = 0
    audit, digest = bytearray(), hashlib.sha256()
    empty = True
    for edit, turn, old, role, text, fault, spent in edits:
        audit += edit[0].upper().encode()
        cost += spent
        if edit != "insert":
            faults[fault] += 1
            if turn is not None and turn != last:
                first, last, turns = turn if first is None else first, turn, turns + 1
            illegal += before is not None and before + old[:1] not in FOLLOWS
            before = old[:1]
        if role is not None:
            digest.update(f"{'' if empty else '\n'}{role}:{text}".encode())
            empty = False
    gaps = min(last - first + 1 - turns, (1 << 63) - 1) if turns else 0
    return (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost,
            audit.decode(), digest.hexdigest())


def _summary_batches(kind: pa.DataType):
    long, text = pa.int64(), pa.string()
    kinds = (kind, long, long, long, long, long, long, text, text)
    names = ["conv_id", *(c.split()[0] for c in SUMMARY.split(", "))]

    def run(batches):
        out = []
        for conv, rows in _conversations(_rows(batches)):
            out.append((conv, *summary_of(row[1:] for row in rows)))
            if len(out) == 1024:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)
    return run


def summaries(rows: DataFrame) -> DataFrame:
    """One row for each conv_id of ``rows`` with the columns of SUMMARY.

    ``gaps`` are the turns missing between the least and the greatest, ``illegal`` the pairs of
    neighbours that may not follow one another, ``audit`` the initials of the edits. The digest
    is that of the repaired ``role:text``, joined by newlines. The edits are summed up in the
    task that finds them. A conversation's digest needs its messages in order, so they pass
    through one task, one after another.
    """
    name, kind = _kind(rows)
    return in_order(rows).mapInArrow(chained(_edit_batches(kind), _summary_batches(kind)),
                                     f"conv_id {name}, {SUMMARY}")
